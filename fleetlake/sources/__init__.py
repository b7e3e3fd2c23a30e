"""Reading and writing: CSV sources and Parquet layers."""
