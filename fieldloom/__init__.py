"""Feature engineering, model fitting and evaluation as Spark DataFrame jobs."""
