"""Session settings, scratch tables and size checks shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators count on. They are SQL settings, so they can be
# put on a session somebody else has built.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a join partition that is far above the median by map output, which
    # also works when one key, or exact copies of one row, fill the partition.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # A bad cast or an unknown id must fail the job, not turn into null.
    "spark.sql.ansi.enabled": "true",
}


def local_session(scratch: str, cores: int | str = "*", app_name: str = "clonarium") -> SparkSession:
    """A single-machine session for tests and bench runs; ``scratch`` holds intermediate tables."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.checkpoint.dir", scratch)
        # Recording the call site of every Column makes wide plans slow to build.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Put the runtime settings above on an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


_JOB: ContextVar[tuple[str, ...]] = ContextVar("job", default=())


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[None]:
    """A scratch folder of its own for a job that leaves nothing unread; deleted at the end."""
    token = _JOB.set((*_JOB.get(), f"job-{uuid.uuid4().hex}"))
    try:
        yield
    finally:
        clear_scratch(spark)
        _JOB.reset(token)


def scratch_folder(spark: SparkSession) -> str:
    """This application's, or the running job's, folder for intermediate tables.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``, so that the
    tables outlive any executor; where that is unset, as in tests, in the warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return "/".join([base.rstrip("/"), spark.sparkContext.applicationId, *_JOB.get()])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table."""
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a scratch table and read it back.

    This cuts the lineage of iterative jobs. Unlike an RDD checkpoint it computes
    the plan once, and the next plan sees the true size of the data.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Bytes of input a shuffle partition should start from.
SHUFFLE_BYTES = 128 << 20


@contextmanager
def job_settings(spark: SparkSession, input_bytes: int = 0) -> Iterator[int]:
    """The settings above, and shuffles sized for the input, for the length of a job.

    Spark merges small partitions at run time but never starts more than it is told to,
    and the default of 200 would mean half a terabyte each for 100 TB. Yields the number
    that shuffles start with; the caller's settings are put back at the end.
    """
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(least, -(-input_bytes // SHUFFLE_BYTES))
    settings = {**RUNTIME_SETTINGS, "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(wanted)}
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield wanted
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, or of the running job."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's own size estimate of the optimised plan, the one it broadcasts by."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))
