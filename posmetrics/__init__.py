"""Retail and point-of-sale analytics as Spark jobs."""

from posmetrics.engine import Engine
from posmetrics.session import configure

__all__ = ["Engine", "configure"]
