"""Landing-file scans, the Parquet warehouse and sinks."""
