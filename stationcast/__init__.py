"""Point-forecast archiving and verification as lazy Spark DataFrame operators."""

__version__ = "0.1.0"
