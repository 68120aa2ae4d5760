"""Event and bar time-series analytics as Spark DataFrame operators."""
