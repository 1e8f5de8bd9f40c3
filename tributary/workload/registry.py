"""All checked queries by name."""

from __future__ import annotations

from tributary.workload import columns, jobs, relational
from tributary.workload.products import PRODUCT_QUERIES
from tributary.workload.query import Query, collect_queries

QUERIES: dict[str, Query] = {
    **collect_queries(vars(columns)),
    **collect_queries(vars(relational)),
    **collect_queries(vars(jobs)),
    **PRODUCT_QUERIES,
}
