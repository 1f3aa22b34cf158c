"""Operators of a training-data pipeline over text corpora and vectors. Nothing else in the package imports this."""
