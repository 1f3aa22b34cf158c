"""Effective-dated (temporal) warehouse operators as plain PySpark DataFrame code."""
