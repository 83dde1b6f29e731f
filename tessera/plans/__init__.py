"""Named queries: each maps (spark, sf_dir) -> DataFrame, most with a DuckDB twin."""

from . import q_assemble, q_code, q_graph, q_retrieve, q_text  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401
