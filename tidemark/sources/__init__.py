"""Sources and sinks: CSV edges, layered Parquet datasets, driver-table views."""
