"""Retail lakehouse analytics on Spark: layers, metrics, guarded SQL, run scoring."""
