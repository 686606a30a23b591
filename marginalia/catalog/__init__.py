from .registry import QUERIES, query
from . import structure, quality, scalars, classify, files, matching, rewrite, assemble  # noqa: F401

__all__ = ["QUERIES", "query"]
