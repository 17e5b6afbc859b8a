"""Expected-outcome analytics on Spark DataFrames."""

from xoutcome.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
