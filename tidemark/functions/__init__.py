from .columns import bookmark_text, derive_amount, fill_default, parse_times, stamp_ingest
from .schema import add_missing, align, check_assignable, evolved, fits, quoted

__all__ = [
    "add_missing", "align", "bookmark_text", "check_assignable", "derive_amount",
    "evolved", "fill_default", "fits", "parse_times", "quoted",
    "stamp_ingest",
]
