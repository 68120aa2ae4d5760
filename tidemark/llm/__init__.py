"""Operators for training-data pipelines over text tables. Nothing else in the library imports this subpackage."""
