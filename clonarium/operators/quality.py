"""Checks. Each returns its offenders as a DataFrame; ``require_none`` turns one into an error."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class CheckFailed(ValueError):
    """A check found offenders."""


def require_none(offenders: DataFrame, what: str) -> None:
    """Fail with the first five offenders, if there are any."""
    first = offenders.limit(5).collect()
    if first:
        raise CheckFailed(f"{what}; first offenders: {[r.asDict() for r in first]}")


def require_columns(df: DataFrame, needed: Iterable[str], what: str = "table") -> None:
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise CheckFailed(f"{what} lacks columns {missing}; it has {df.columns}")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return (
        df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
    )


def malformed(df: DataFrame, column: str, pattern: str, null_is_bad: bool = False) -> DataFrame:
    """Rows whose value does not match the pattern; a null passes unless stated."""
    bad = ~F.col(column).rlike(pattern)
    return df.where(F.coalesce(bad, F.lit(null_is_bad)))


def key_set_difference(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Distinct keys present on one side only, with the side.

    One aggregation over both sides instead of two anti joins: the distinct keys are
    combined map side and shuffled once.
    """
    both = left.select(*key, F.lit(1).alias("_side")).unionByName(
        right.select(*key, F.lit(2).alias("_side"))
    )
    sides = both.groupBy(*key).agg(F.bit_or("_side").alias("_side"))
    return sides.where(F.col("_side") != 3).select(
        *key, F.when(F.col("_side") == 1, "left_only").otherwise("right_only").alias("side")
    )


def list_length_mismatch(
    df: DataFrame, lists: Sequence[str], declared: str, separator: str = ";"
) -> DataFrame:
    """Rows where a delimited list does not have the declared number of items; nulls pass."""
    lengths = {c: F.size(F.split(F.col(c), separator)) for c in lists}
    wrong = reduce(
        lambda a, b: a | b,
        [
            F.when(F.col(c).isNotNull(), n != F.col(declared)).otherwise(F.lit(False))
            for c, n in lengths.items()
        ],
    )
    return df.where(F.coalesce(wrong, F.lit(False)))


def unexpected_values(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """Values outside the allowed set, with their row count; null is always allowed."""
    return (
        df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(allowed)))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def orphans(
    child: DataFrame, parent: DataFrame, on: Sequence[tuple[str, str]] | Sequence[str]
) -> DataFrame:
    """Distinct child keys without a parent row; a key with a null part is not checked."""
    pairs = [(k, k) if isinstance(k, str) else tuple(k) for k in on]
    child_keys = [c for c, _ in pairs]
    wanted = child.select(*child_keys).dropna().distinct()
    known = parent.select(*[F.col(p).alias(c) for c, p in pairs])
    return wanted.join(known, child_keys, "left_anti")


def varying_within(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys for which a column that should be constant has several non-null values.

    A column varies when its minimum and maximum differ, which needs no distinct.
    """
    spread = df.groupBy(*key).agg(
        *[(F.min(c) != F.max(c)).alias(f"{c}_varies") for c in columns]
    )
    any_varies = reduce(lambda a, b: a | b, [F.col(f"{c}_varies") for c in columns])
    return spread.where(any_varies)


def outside_bounds(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows whose value is below ``low``, above ``high`` or NaN; null passes."""
    value = F.col(column)
    return df.where((value < low) | (value > high) | F.isnan(value.cast("double")))


def sum_mismatch(
    df: DataFrame, key: Sequence[str], value: str, declared: str, tolerance: float = 0.0
) -> DataFrame:
    """Keys where the sum of a column differs from a total repeated on every row."""
    sums = df.groupBy(*key).agg(
        F.sum(value).alias("found"), F.min(declared).alias("declared_min"), F.max(declared).alias("declared_max")
    )
    off = (F.abs(F.col("found") - F.col("declared_min")) > tolerance) | (
        F.abs(F.col("found") - F.col("declared_max")) > tolerance
    )
    return sums.where(off)


def shared_key_count(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: the number of distinct keys the two tables share."""
    both = left.select(*key, F.lit(1).alias("_side")).unionByName(
        right.select(*key, F.lit(2).alias("_side"))
    )
    sides = both.dropna(subset=list(key)).groupBy(*key).agg(F.bit_or("_side").alias("_side"))
    return sides.agg(F.count_if(F.col("_side") == 3).alias("n_shared"))


def violation_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(check, n_rows, n_bad) per rule, all rules in one pass.

    A rule is a condition that holds for bad rows; null counts as good.
    """
    one_row = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(rule).alias(f"_{i}") for i, rule in enumerate(rules.values())],
    )
    checks = F.array(
        *[
            F.struct(F.lit(name).alias("check"), F.col("_n").alias("n_rows"), F.col(f"_{i}").alias("n_bad"))
            for i, name in enumerate(rules)
        ]
    )
    return one_row.select(F.inline(checks))
