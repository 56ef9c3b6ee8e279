"""Timeline analytics on Spark: ingest, intervals, as-of context, nested documents, training rows."""
