"""Sources (scans of delimited text, lookups, Parquet) and sinks."""
