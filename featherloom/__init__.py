"""Feature tables, profiling, encoding, kNN joins and model scoring on PySpark."""

__version__ = "0.1.0"
