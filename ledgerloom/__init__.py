"""Case-study analytics as plain Spark DataFrame jobs."""
