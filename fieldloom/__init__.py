"""Field-mapping analytics on Spark."""
