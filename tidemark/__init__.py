"""Lakehouse table operations as Spark jobs: change capture, merge, versions, layout."""

from .plans.change_table import ChangeTable
from .session import build_session

__all__ = ["ChangeTable", "build_session"]
