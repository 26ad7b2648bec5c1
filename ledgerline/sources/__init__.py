"""Sources and sinks: Parquet, JSON, JDBC, and stand-in inputs."""
