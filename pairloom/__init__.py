"""Pair-spread time-series analytics expressed as Spark DataFrame functions."""
