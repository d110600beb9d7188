"""Hospital-operations analytics on Spark: Bronze, Silver, Gold, history, streams and serving queries."""
