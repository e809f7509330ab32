"""bitextra: preparation of parallel text corpora as Spark DataFrame jobs."""

__version__ = "0.1.0"
