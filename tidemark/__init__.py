"""Daily demand-uplift analytics expressed as Spark DataFrame jobs."""

from tidemark.config import Settings

__all__ = ["Settings"]
