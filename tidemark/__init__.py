"""tidemark: Spark operators for scored, dated archives of nested news items."""

from .config import Settings

__all__ = ["Settings"]
