"""Sources and sinks: delimited text, label files, arrivals extracts, Parquet tables."""
