"""Sources and sinks: parquet/catalog scans, the logical-table mapping,
CSV and JSON ingestion, partitioned sinks."""
