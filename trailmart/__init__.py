"""Access-log analytics and recommendation marts on Spark DataFrames."""
