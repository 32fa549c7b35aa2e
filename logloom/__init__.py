"""Behavioural-log, text and recommendation analytics as plain PySpark."""

from logloom.session import get_session

__all__ = ["get_session"]
