"""Delimited and Parquet scans with explicit types."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clonarium.functions.labels import without_markers
from clonarium.operators.quality import require_columns
from clonarium.operators.reshape import quoted
from clonarium.sources.blockgzip import block_gzip_files, unpacked_lines
from clonarium.sources.records import TextFiles, cells, open_files, open_lines

# Null markers by kind of file.
MARKERS_PLAIN = ["NA", ""]
MARKERS_NAN = ["NA", "", "nan"]
MARKERS_SCORES = ["NA", "", "-", "nan"]


def read_text_columns(
    spark: SparkSession,
    path: str | list[str],
    sep: str = "\t",
    names: Sequence[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Every column as text, with the header's names or, for a file without header, ``names``.

    Null markers other than the empty cell, which is null, are left in place: a marker has to be
    gone before the cast. Gzip is unpacked by the file name. Several files must share one header.
    A record with more or fewer cells than the header fails the job. ``partitions``: see
    ``read_delimited``; for records and quotes see ``records``.
    """
    files = _spread(spark, path, sep, names is None, partitions) if partitions else open_files(spark, path, sep, has_header=names is None)
    if names is None:
        names = _shared_header(files, sep)
    split = files.body.select("path", cells(F.col("record"), sep).alias("cells"))
    given = F.concat(F.size("cells").cast("string"), F.lit(f" cells instead of {len(names)} in "), F.col("path"))
    checked = F.when(F.size("cells") == len(names), F.col("cells")).otherwise(F.raise_error(F.concat(F.lit("malformed record: "), given)))
    # One array a row, checked once, then its cells.
    return split.select(checked.alias("cells")).select(
        *[F.nullif(F.get("cells", F.lit(i)), F.lit("")).alias(name) for i, name in enumerate(names)]
    )


def _spread(spark: SparkSession, path: str | list[str], sep: str, has_header: bool, partitions: int) -> TextFiles:
    """The records of the files, those of gzip files in so many tasks."""
    blocked = block_gzip_files(spark, path)
    files = open_files(spark, path, sep, blocked, has_header)
    body = files.body.repartition(partitions)
    if not blocked:
        return TextFiles(files.headers, body)
    unpacked = open_lines(unpacked_lines(spark, path, blocked, partitions), sep, has_header)
    return TextFiles(files.headers.unionByName(unpacked.headers), body.unionByName(unpacked.body))


def _shared_header(files: TextFiles, sep: str) -> list[str]:
    """The one header of all files; a column without a name is called by its place."""
    found = files.headers.groupBy("header").agg(F.min("path").alias("path")).limit(2).select(cells(F.col("header"), sep).alias("names"), "path").collect()
    if len(found) > 1 and found[0].names != found[1].names:
        raise ValueError(f"{found[0].path} and {found[1].path} have different headers")
    names = [name or f"_c{i}" for i, name in enumerate(found[0].names if found else [])]
    if len(set(names)) < len(names):
        raise ValueError(f"{found[0].path} repeats a column")
    return names


def typed(df: DataFrame, types: dict[str, str], markers: list[str]) -> DataFrame:
    """The named columns, markers turned to null, cast to their types.

    A value that does not fit its type fails the job. Columns not named are dropped.
    """
    require_columns(df, types, "source")
    return df.select(
        *[_cell(F.col(quoted(name)), kind, markers).alias(name) for name, kind in types.items()]
    )


def typed_all(df: DataFrame, types: dict[str, str], markers: list[str]) -> DataFrame:
    """As ``typed``, but columns without a type are kept as text."""
    return typed(df, {c: types.get(c, "string") for c in df.columns}, markers)


def _cell(col: Column, kind: str, markers: list[str]) -> Column:
    value = without_markers(col, markers)
    return value if kind == "string" else value.cast(kind)


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    types: dict[str, str],
    *,
    sep: str = "\t",
    markers: list[str] = MARKERS_PLAIN,
    names: Sequence[str] | None = None,
    keep_others: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """A typed table from one file, or from several files with the same header.

    ``partitions`` is for gzip files, which Spark can only unpack in one task each: the
    records are spread over that many tasks first and taken apart there; block gzip is unpacked
    there too. It changes no row.
    """
    text = read_text_columns(spark, path, sep, names, partitions)
    return (typed_all if keep_others else typed)(text, types, markers)


def read_parquet_columns(spark: SparkSession, path: str, needed: Sequence[str] = ()) -> DataFrame:
    """A Parquet table that must have the named columns."""
    df = spark.read.parquet(path)
    require_columns(df, needed, path)
    return df
