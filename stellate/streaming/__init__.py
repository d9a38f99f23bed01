from .files import stream_files

__all__ = ["stream_files"]
