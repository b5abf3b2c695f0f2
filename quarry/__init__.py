"""quarry: batch text and table analytics on Spark DataFrames."""

from quarry.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
