"""Document-intelligence analytics on PySpark: operators are ``DataFrame -> DataFrame``."""

__version__ = "0.1.0"
