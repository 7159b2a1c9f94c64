"""Sources and sinks: CSV / Parquet / JDBC scans and writes, and the mapping of
the driver's test tables onto the canonical silver datasets."""
