"""Sources and sinks: match documents, given tables, live snapshots, Parquet/JDBC."""
