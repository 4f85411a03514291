"""riskmart: a PySpark-native data mart for snapshot-based risk models."""

__version__ = "0.1.0"
