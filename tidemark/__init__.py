"""tidemark: a medallion warehouse with fraud analytics, written as Spark jobs."""

from tidemark.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
