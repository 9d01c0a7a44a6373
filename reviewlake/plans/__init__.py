"""Registered queries and the multi-step plans."""

from reviewlake.plans import (feature_queries, quality_queries, source_queries, stream_queries, table_queries,
                              text_queries)
from reviewlake.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
