"""Metric functions ``(Tables, as_of) -> DataFrame``."""
