"""Yearly CSV files, cleaned Parquet, and the loaded tables partitioned by month."""
