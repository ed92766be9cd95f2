"""Millrace: record linkage and corpus preparation as lazy PySpark plans."""
