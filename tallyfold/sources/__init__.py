"""Reading and writing the Parquet history."""
