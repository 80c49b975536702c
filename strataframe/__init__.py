"""Time-lapse image analytics and corpus preparation as Spark DataFrame jobs."""
