"""Farm-production analytics as Spark DataFrame jobs."""
