"""Sources and sinks: raw CSV scans, the Parquet lake, derived tables, JSON.

``fixture`` derives raw scorecard frames from the driver's TPC-H-style
tables, so every query's work grows with those tables.
"""
