"""Threadmill: corpus curation on PySpark DataFrames."""
