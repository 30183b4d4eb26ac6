from .change_table import ChangeTable
from .incremental import (FrameSource, JdbcBookmarks, JdbcSource, TableBookmarks, bookmark_advance,
                          extract_full, extract_since, read_bookmark, run_incremental)
from .maintained import MaintainedCounts

__all__ = [
    "ChangeTable", "FrameSource", "JdbcBookmarks", "JdbcSource", "MaintainedCounts", "TableBookmarks", "bookmark_advance",
    "extract_full", "extract_since", "read_bookmark", "run_incremental",
]
