from .merge_stream import merge_stream, newest_changes

__all__ = ["merge_stream", "newest_changes"]
