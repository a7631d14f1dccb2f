"""Page-corpus analytics on Spark."""
