"""Sources (parquet / CSV scans), contract checks and sinks."""
