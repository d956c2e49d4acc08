"""Training-data operators (language ID, mixing, dedup, extraction, scans).

Nothing outside this package imports it; ``__spark_entry__`` adds its
queries only when the package can be imported.
"""
