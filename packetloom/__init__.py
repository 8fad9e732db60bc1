"""Network-security analytics as PySpark DataFrame and Structured Streaming jobs.

Every operator takes DataFrames and returns a DataFrame; the caller decides
when to act on it. Thresholds, word lists and column names are arguments.
"""
