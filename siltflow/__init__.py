"""Change-data ingestion and analytics on Spark DataFrames."""
