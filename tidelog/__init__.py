"""Event-log analytics on PySpark: streams, tables, windows, joins, patterns and detectors."""
