"""Turn pages, documents, file listings and tables into checked benchmark packages on Spark."""

__version__ = "0.1.0"
