"""Spark-native analytics over product price observations."""

from tidemark.session import checkpoint_root, make_session, prepare

__all__ = ["checkpoint_root", "make_session", "prepare"]
