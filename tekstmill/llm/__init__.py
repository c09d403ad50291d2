"""Operators of a training-data pipeline, each usable on any DataFrame with the named columns."""
