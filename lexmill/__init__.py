"""Corpus preparation and count-based language-model evaluation on Spark DataFrames."""

from lexmill.session import local_session

__all__ = ["local_session"]
