"""pressloom: captured press-release pages in, clean release tables out, on Spark."""

from pressloom.session import build_session

__all__ = ["build_session"]
