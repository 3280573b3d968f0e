"""End-of-day market analytics as Spark jobs."""
