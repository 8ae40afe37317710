"""Sources and sinks: versioned Parquet tables, event-log streams, JDBC."""
