"""Sources and sinks: the supplied tables, the fixture feed, CSV/Parquet readers and writers."""
