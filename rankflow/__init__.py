"""Personalised feeds from interaction logs, as plain Spark DataFrame jobs."""

from rankflow.config import FeedConfig

__all__ = ["FeedConfig"]
