"""Readers and writers. The table format is a string: parquet here, delta where it is installed."""
