"""All queries outside the subpackage for large text collections, with their SQL."""

from ..operators import delivery_queries
from . import pipeline_queries, similarity_queries, source_queries, text_queries

_MODULES = (delivery_queries, text_queries, similarity_queries, pipeline_queries, source_queries)
QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
ORACLES = {k: v for m in _MODULES for k, v in m.ORACLES.items()}
