"""Check queries: the library run over the driver's tables, with SQL to compare against."""
