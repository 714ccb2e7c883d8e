"""Imports every module that registers a query."""

from millrace.llm import audit, jaccard, language, licenses, lines, packing, pieces, pii, quality, repeats, secrets, spelling, vectors
from millrace.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "audit", "jaccard", "language", "licenses", "lines", "packing", "pieces", "pii", "quality", "repeats", "secrets", "spelling", "vectors"]
