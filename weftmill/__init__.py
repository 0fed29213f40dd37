"""Token and vector analytics as Spark DataFrame jobs."""
