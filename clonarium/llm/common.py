"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clonarium.session import materialize, scratch_path

__all__ = ["block_count", "documents", "materialize", "scratch_path", "ship", "sliding", "spread", "table", "with_positions"]

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship(spark: SparkSession) -> SparkSession:
    """Let the Python workers of this session import the package.

    On a cluster the package is installed or sent with ``--py-files``; where it lies in a
    checkout, as in tests, that folder is put on the workers' path.
    """
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, known)])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def documents(df: DataFrame, *columns: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` as long, ``text`` with null as empty, and further columns by name.

    Everything else, extra columns included, stays behind, so no name can clash.
    """
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        *columns,
    )


def spread(df: DataFrame, *keys: str | Column, floor: int = 1) -> DataFrame:
    """Shuffle by ``keys`` into as many partitions as the session's shuffles have."""
    return df.repartition(block_count(df.sparkSession, floor), *keys)


def block_count(spark: SparkSession, floor: int = 1) -> int:
    """The partitions a shuffle of this session starts with."""
    return max(floor, int(spark.conf.get("spark.sql.shuffle.partitions")))


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over each window of ``width`` values."""
    out, size = values, 1
    while size * 2 <= width:
        out, size = pick(out[:-size], out[size:]), size * 2
    rest = width - size
    return pick(out[:-rest], out[rest:]) if rest else out


def with_positions(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``rows`` with a distinct long ``_position`` that rises with id, then text.

    It is the id itself where ids are distinct and not null; otherwise the rows are sorted and
    numbered, null ids first, and written, so that the numbers stay what they are.
    """
    ids = rows.select(F.col(id_col).cast("long").alias("id"))
    if ids.groupBy("id").count().where("count > 1 or id is null").isEmpty():
        return rows.withColumn("_position", F.col(id_col).cast("long"))
    ordered = rows.sort(F.col(id_col).cast("long"), "text")
    return materialize(ordered.withColumn("_position", F.monotonically_increasing_id()), "positions")
