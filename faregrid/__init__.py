"""faregrid: trip analytics as plain Spark DataFrame, SQL and streaming jobs."""
