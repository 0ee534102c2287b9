"""Operators: DataFrame in, DataFrame out; no action inside except the
checkpoint of the id dictionary and model fits."""
