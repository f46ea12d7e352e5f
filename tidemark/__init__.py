"""Market-data ingestion, merging and integrity checks, and training-data operators, on Spark."""
