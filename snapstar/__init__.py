"""Daily JSON snapshots to a star schema, as plain Spark DataFrame jobs."""
