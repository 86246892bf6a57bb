"""Analytics over file-system evidence and documents, written for Spark."""

__version__ = "0.1.0"
