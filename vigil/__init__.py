"""vigil: incremental security-inventory feeds as Spark jobs."""

from .session import build_session

__all__ = ["build_session"]
