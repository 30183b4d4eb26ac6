"""Every operator as a query over the driver's tables, with its SQL where SQL can say it."""

from . import extract, files, layouts, rowops, versions  # noqa: F401  (fill the registry)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
