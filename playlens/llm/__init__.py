"""Training-data operators: quality, deduplication, mixing, packing, scans.

One module per operator; ``queries`` holds the registered queries.  Nothing
else in the library imports this package.
"""
