"""Equi joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def lookup_join(facts: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join facts, whose keys may be skewed, to a lookup (``inner`` or ``left``).

    A lookup below the broadcast threshold, or facts below it in an inner join, are broadcast by
    Catalyst. Otherwise it is a shuffle join whose oversized partitions Spark splits at run time by
    map output (``skewJoin``, which ``session`` forces on), so exact copies of one row are split as
    well. ``on`` columns come first in the result, as with ``DataFrame.join(on=...)``.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"lookup_join does inner and left joins, not {how!r}")
    return facts.join(lookup, list(on), how)
