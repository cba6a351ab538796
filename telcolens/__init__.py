"""telcolens: mobile-operator analytics as Spark DataFrame jobs (see README)."""

__version__ = "0.1.0"
