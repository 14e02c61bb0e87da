"""Near-duplicate vectors by Euclidean p-stable hashing (operator 2).

Vectors are scaled to unit length, so cosine 0.95 is a Euclidean distance of 0.316. Each table
hashes a vector by several random Gaussian projections, shifted, divided by the bucket width
and rounded down; only vectors that share a bucket in some table are compared, by the exact
cosine in double precision. The numbers of tables and of projections are parameters, the same at
every size: ``table_count`` gives the tables that find a pair right at the threshold with
probability ``RECALL``, and closer pairs are found more often. More projections, with the tables that
go with them, keep strangers out of the buckets of larger tables: of n vectors far from it a vector
meets n * collision(sqrt(2)) ** projections in each table. With ``PROJECTIONS`` these are one in 100,000.

Near copies share most of their buckets, often with the same company. Buckets of the same members are
told by their number and 128 bits, and only the first of them, in order of table, is compared.

Exact copies share one entry with a weight. A bucket of more than ``BLOCK_ROWS`` vectors is
split into blocks, and every two blocks meet in a task of their own: all its pairs are
compared, no pair is emitted, only counts and a spanning set of links. A pair that shares
several buckets counts in the first of them.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing;
vectors of different lengths never link. A null id never names a component unless all ids in
it are null; rows with one id are vectors of their own. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clonarium.llm.common import block_count, materialize
from clonarium.llm.components import components

COSINE, WIDTH, RECALL, PROJECTIONS = 0.95, 2.0, 0.99, 16
BLOCK_ROWS = 2048
ENTRY_SCHEMA = "key long, vec_id long, digest binary, vector binary"


def collision(distance: float, width: float = WIDTH) -> float:
    """The probability that one projection puts two vectors at this distance into one bucket."""
    r = width / distance
    below = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def table_count(projections: int = PROJECTIONS, cosine: float = COSINE) -> int:
    """The tables that a pair right at the threshold needs to share a bucket with probability RECALL."""
    near = collision(math.sqrt(2 - 2 * cosine))
    return math.ceil(math.log(1 - RECALL) / math.log1p(-(near**projections)))


class Tables:
    """The hash functions of all tables for one vector length."""

    def __init__(self, tables: int, projections: int, dimension: int, width: float = WIDTH):
        drawn = np.random.default_rng([7, dimension])
        self.shape, self.width = (tables, projections), width
        self.directions = drawn.standard_normal((dimension, tables * projections))
        self.shifts = drawn.uniform(0, width, tables * projections)
        self.weights = drawn.integers(1 << 62, size=(tables, projections), dtype=np.int64).astype(np.uint64) | np.uint64(1)
        self.salts = np.arange(1, tables + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(dimension)

    def buckets(self, unit: np.ndarray) -> np.ndarray:
        """A key per vector and table."""
        cells = np.floor((unit @ self.directions + self.shifts) / self.width).astype(np.int64).view(np.uint64)
        h = (cells.reshape(len(unit), *self.shape) * self.weights).sum(axis=2, dtype=np.uint64) + self.salts
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return (h ^ (h >> np.uint64(29))).view(np.int64)


def _unit(vectors: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def component_kind(vectors: DataFrame, vector_col: str) -> str:
    """How components are carried: as they are if they are floats, else as doubles."""
    return "<f4" if vectors.schema[vector_col].dataType == T.ArrayType(T.FloatType()) else "<f8"


def _entries(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(key, vec_id, digest, vector) with distinct keys; no vector where nothing can link."""
    kind = component_kind(vectors, vector_col)
    wide = F.col(vector_col).cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce(~bad & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), wide.alias("v"))
    rows = rows.select("vec_id", F.when(usable, F.col("v")).alias("v"))

    def encode(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = [None if v is None else np.array(v, kind) + np.zeros(1, kind) for v in batch.column("v").to_pylist()]
            raw = [None if v is None else v.tobytes() for v in listed]
            digests = [None if r is None else hashlib.blake2b(r, digest_size=16).digest() for r in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("vec_id"), pa.array(digests, pa.binary()), pa.array(raw, pa.binary())],
                names=["key", "vec_id", "digest", "vector"],
            )

    # A key per row; the table is written so that the keys stay what they are.
    keyed = rows.select(F.monotonically_increasing_id().alias("key"), "vec_id", "v")
    return materialize(keyed.mapInArrow(encode, ENTRY_SCHEMA), "vectors")


def vector_links(
    distinct: DataFrame, kind: str, cosine: float = COSINE, projections: int = PROJECTIONS, tables: int | None = None
) -> DataFrame:
    """(key, n, root) per vector and bucket with links: linked weights, least key reached.

    ``distinct`` has one row per distinct vector: key, weight, vector, with components of a ``kind``.
    """
    spark = distinct.sparkSession
    tables = table_count(projections, cosine) if tables is None else tables
    width = int(kind[-1])

    def deal(batches) -> Iterator[pa.RecordBatch]:
        made: dict[int, Tables] = {}
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column("vector").to_pylist()])
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size))
                raw = part.column("vector").to_pylist()
                if size not in made:
                    made[size] = Tables(tables, projections, size // width)
                keys = made[size].buckets(_unit(raw, kind))
                repeat = pa.array(np.repeat(np.arange(len(raw)), tables))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(np.tile(np.arange(tables, dtype=np.int32), len(raw))),
                     part.column("key").take(repeat)],
                    names=["bucket", "place", "key"],
                )

    dealt = distinct.mapInArrow(deal, "bucket long, place int, key long")
    # Only buckets with company matter, the first of those with the same, and only large ones are split.
    marks = [F.bit_xor(F.xxhash64("key", F.lit(i))).alias(f"mark{i}") for i in range(2)]
    sizes = dealt.groupBy("bucket").agg(F.count("*").alias("m"), F.min("place").alias("place"), *marks).where("m > 1")
    firsts = sizes.groupBy("m", "mark0", "mark1").agg(F.min(F.struct("place", "bucket")).alias("first"))
    shared = dealt.join(firsts.select(F.col("first.bucket").alias("bucket"), "m"), "bucket").select("bucket", "place", "key", "m")
    all_keys = shared.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("place", "bucket", "m"))).alias("shared"))
    rows = distinct.join(all_keys, "key").select("key", "weight", "vector", "shared")
    n = F.ceil(F.col("s.m") / BLOCK_ROWS).cast("int")
    spread = rows.select("*", F.explode("shared").alias("s")).select(
        F.col("s.bucket").alias("bucket"), F.col("s.place").alias("place"),
        n.alias("blocks"), F.pmod(F.xxhash64("key"), n).cast("int").alias("block"), "key", "weight", "vector",
        # The buckets of the tables before this one, to count a pair once.
        F.transform(F.filter("shared", lambda x: x["place"] < F.col("s.place")), lambda x: x["bucket"]).alias("before"),
    )
    meet = spread.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    meet = meet.select(
        "bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "key", "weight", "vector", "before",
    )

    def compare(batches) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            found = _compare_group(group, kind, cosine)
            if found:
                yield found

    placed = meet.repartition(block_count(spark), "bucket", "low", "high")
    return placed.sortWithinPartitions("bucket", "low", "high").mapInArrow(compare, "key long, n long, root long")


def _groups(batches) -> Iterator[pa.Table]:
    """Tables of the rows of one (bucket, low, high), from sorted rows."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        names = np.stack([table.column(c).to_numpy() for c in ("bucket", "low", "high")], axis=1)
        edges = [0, *(np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1).tolist(), len(names)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            name = tuple(names[a])
            if last is not None and name != last:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(a, b - a))
            last = name
    if held:
        yield pa.concat_tables(held)


def _compare_group(group: pa.Table, kind: str, cosine: float) -> pa.RecordBatch | None:
    """Compare all pairs of a block pair; across blocks only, where there are two."""
    key, weight, block = (group.column(c).to_numpy() for c in ("key", "weight", "block"))
    low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
    raw = group.column("vector").to_pylist()
    order = np.argsort(key, kind="stable")
    unit = _unit(raw, kind)
    before = group.column("before").to_pylist()
    n, root = np.zeros(len(key), np.int64), np.full(len(key), -1)
    linked = np.zeros((len(key), len(key)), bool)
    for a in range(0, len(key), 512):
        linked[a : a + 512] = unit[a : a + 512] @ unit.T >= cosine
    np.fill_diagonal(linked, False)
    if low != high:
        linked &= block[:, None] != block[None, :]
    if not linked.any():
        return None
    if any(before):
        # Pairs that met in an earlier bucket count there; only linked rows matter here.
        rows = np.flatnonzero(linked.any(axis=1))
        members: dict[int, list[int]] = {}
        for i in rows.tolist():
            for bucket in before[i]:
                members.setdefault(bucket, []).append(i)
        fresh = linked.copy()
        for group_rows in {tuple(m) for m in members.values() if len(m) > 1}:
            fresh[np.ix_(group_rows, group_rows)] = False
        n = fresh @ weight
    else:
        n = linked @ weight
    unseen = linked.any(axis=1)
    for one in order.tolist():  # the least key first, so that it names what it reaches
        if not unseen[one]:
            continue
        waiting = [one]
        unseen[one] = False
        root[one] = key[one]
        while waiting:
            found = np.flatnonzero(linked[waiting.pop()] & unseen)
            unseen[found] = False
            root[found] = key[one]
            waiting += found.tolist()
    rows = np.flatnonzero(root >= 0)
    return pa.RecordBatch.from_arrays([pa.array(key[rows]), pa.array(n[rows]), pa.array(root[rows])], names=["key", "n", "root"])


def near_duplicates(
    vectors: DataFrame,
    cosine: float = COSINE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    projections: int = PROJECTIONS,
    tables: int | None = None,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` (the least id reachable) and ``kept``."""
    entries = _entries(vectors, id_col, vector_col)
    distinct = materialize(
        entries.where("digest is not null").groupBy("digest").agg(
            F.min("key").alias("key"), F.count("*").alias("weight"), F.min("vec_id").alias("least"), F.first("vector").alias("vector")
        ),
        "distinct-vectors",
    )
    kind = component_kind(vectors, vector_col)
    found = vector_links(distinct.select("key", "weight", "vector"), kind, cosine, projections, tables)
    links = materialize(found, "vector-links")
    counts = links.groupBy("key").agg(F.sum("n").alias("n"))
    groups = components(links.select(F.col("key").alias("a"), F.col("root").alias("b")))
    members = (
        distinct.select("digest", "key", "weight", "least")
        .join(counts, "key", "left")
        .join(groups.withColumnRenamed("node", "key"), "key", "left")
        .select(
            "digest", "least", F.coalesce("component", "key").alias("root"),
            (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        )
    )
    members = materialize(members, "members")
    names = members.groupBy("root").agg(F.min("least").alias("component_id"))
    answers = members.join(names, "root").select("digest", "n_links", "component_id")
    joined = entries.select("vec_id", "digest").join(answers, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
