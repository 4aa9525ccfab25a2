"""All registered queries of the engine's own operators."""

from . import check_queries, extra_queries, metric_queries, record_queries, retrieval_queries, source_queries, text_queries  # noqa: F401
from .registry import ORACLES, QUERIES

FLAGSHIP = "vector_topk_precision"

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]
