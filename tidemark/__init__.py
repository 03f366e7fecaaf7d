"""tidemark: load, inventory, reconcile and validate business records on Spark."""

from tidemark.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
