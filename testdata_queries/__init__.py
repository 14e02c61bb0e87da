"""One query per operator on the generated tables, each next to its SQL counterpart."""

from __future__ import annotations

from testdata_queries import (  # noqa: F401  (importing a module registers its queries)
    checks,
    expressions,
    files,
    intervals,
    jobs,
    named_joins,
    shapes,
    summaries,
    trees,
)
from testdata_queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
