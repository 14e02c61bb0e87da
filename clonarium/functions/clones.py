"""Clone labels and clone-level flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The virtual root of every clone tree, the label prefix.
VIRTUAL_ROOT = "diploid"
CLONE_PREFIX = "clone"

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def clone_from_number(col: Column) -> Column:
    """``1.0`` to ``clone1``; null and NaN to null; a fraction is cut off."""
    absent = col.isNull() | F.isnan(col.cast("double"))
    return F.when(~absent, F.concat(F.lit(CLONE_PREFIX), col.cast("bigint").cast("string")))


def clone_from_text(col: Column, null_fails: bool = False) -> Column:
    """``clone3`` is kept, ``"3"`` and ``"3.0"`` give ``clone3``, other text fails.

    ``null_fails`` is the stricter form: it trims the text first and also fails
    on a missing label.
    """
    text = F.trim(col.cast("string")) if null_fails else col.cast("string")
    whole = text.cast("double").cast("bigint").cast("string")
    label = (
        F.when(text.startswith(CLONE_PREFIX), text)
        .when(text.rlike(_NUMBER), F.concat(F.lit(CLONE_PREFIX), whole))
        .when(
            text.isNotNull(),
            F.raise_error(F.concat(F.lit("not a clone label: "), text)).cast("string"),
        )
    )
    if null_fails:
        return F.when(
            col.isNull(), F.raise_error(F.lit("clone label is missing")).cast("string")
        ).otherwise(label)
    return label


def clone_prefixed(col: Column) -> Column:
    """Put the prefix before a label that lacks it."""
    text = col.cast("string")
    return F.when(text.startswith(CLONE_PREFIX), text).otherwise(
        F.concat(F.lit(CLONE_PREFIX), text)
    )


def is_root(parent: Column) -> Column:
    return parent == VIRTUAL_ROOT


def is_event_clone(doublings: Column) -> Column:
    return doublings > 0


def has_event_ancestor(cumulative_doublings: Column) -> Column:
    return cumulative_doublings > 0
