"""Sources and sinks: parquet test tables, JSON documents, text logs."""
