"""martwright: a retail star-schema warehouse as PySpark DataFrame operators."""

__version__ = "0.1.0"
