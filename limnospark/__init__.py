"""Gauging analytics as Spark DataFrame jobs."""

from limnospark.session import get_session

__all__ = ["get_session"]
