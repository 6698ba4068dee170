"""Customer and revenue analytics as Spark DataFrame jobs."""
