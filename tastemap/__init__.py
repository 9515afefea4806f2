"""Rating and review-sentiment analytics as Spark DataFrame operators and jobs."""
