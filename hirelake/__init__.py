"""hirelake: Spark-native analytics over large tables of job postings."""

__version__ = "0.1.0"
