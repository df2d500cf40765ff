"""Market-data analytics on PySpark."""
