"""Incremental form of the per-entity scan: only files not seen before are read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clonarium.session import job_scratch
from clonarium.sources.headed import read_entity_columns
from clonarium.sources.store import table_path


def append_new_files(
    spark: SparkSession,
    directory: str,
    store: str,
    table: str,
    key_column: Column,
    columns: dict[str, str],
    checkpoint: str,
    *,
    key: str = "entity",
    sep: str = "\t",
    markers: list[str],
    files_per_batch: int = 1000,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> None:
    """Append the rows of the files that were added since the last call, then stop.

    The file source keeps its list of seen files in ``checkpoint``. Each batch holds the
    paths of at most ``files_per_batch`` files, which the batch reader then reads, since
    their headers differ. Every batch writes its own directory under the table, which it overwrites
    when it is repeated after a failure, so no row is written twice.
    """
    paths = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(directory)
        .select("path")
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        found = [r.path for r in batch.toLocalIterator()]
        if not found:
            return
        with job_scratch(batch.sparkSession):
            rows = read_entity_columns(
                batch.sparkSession, found, key_column, columns, key=key, sep=sep, markers=markers
            )
            prepare(rows).write.mode("overwrite").parquet(f"{table_path(store, table)}/batch={batch_id}")

    query = (
        paths.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()


def appended(spark: SparkSession, store: str, table: str) -> DataFrame:
    """All batches of a table so far."""
    return spark.read.parquet(table_path(store, table)).drop(F.col("batch"))
