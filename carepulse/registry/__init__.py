"""Every operator as a runnable query over the supplied tables, with SQL to check it by."""

from . import checks, expressions, relational, scans, serving, streams, tables  # noqa: F401
from .core import QUERIES

__all__ = ["QUERIES"]
