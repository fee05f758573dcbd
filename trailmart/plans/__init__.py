"""The data products: operators put together, still DataFrame -> DataFrame."""
