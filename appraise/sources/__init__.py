"""Sources and sinks: declared schemas, CSV / parquet scans, checkpoints, CSV sink, model persistence,
and the stand-in property / sale tables over the driver's test data."""
