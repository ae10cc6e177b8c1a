"""inkloom: a Spark-first engine for long serialized text."""

__version__ = "0.1.0"
