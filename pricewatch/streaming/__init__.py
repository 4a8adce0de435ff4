"""Event-driven entry."""
from .unify_stream import stream_unify

__all__ = ["stream_unify"]
