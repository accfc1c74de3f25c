"""On-time analytics for airline flights, in batch and as a stream, on PySpark."""
