"""DataFrame operators: they take and return DataFrames and do no I/O unless named write_*."""
