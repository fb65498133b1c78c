"""Event analytics on Spark tables and streams."""
