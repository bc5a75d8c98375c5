"""Sources and sinks: JSON lines, parquet, CSV/JSON reports, driver tables."""
