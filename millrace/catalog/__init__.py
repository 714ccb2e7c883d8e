"""All registered queries."""

from millrace.catalog import joins, keyed, rows, streams, windowed, carried  # isort: skip
from millrace.catalog.base import REGISTRY

__all__ = ["REGISTRY", "carried", "joins", "keyed", "rows", "streams", "windowed"]
