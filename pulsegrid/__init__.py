"""Personal-health analytics as Spark DataFrame jobs."""
