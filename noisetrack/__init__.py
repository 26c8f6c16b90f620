"""Aircraft-noise analytics on Spark."""
