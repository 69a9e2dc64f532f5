"""Repeat-event analytics on Spark: nested clinical JSON to validated, historised, queryable facts."""

__version__ = "0.1.0"
