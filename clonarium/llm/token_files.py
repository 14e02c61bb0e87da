"""Token ids as bit-plane files with a chunk index (operator 9).

Documents are encoded in ascending id order, one shard per range of ids. A chunk holds whole
documents; its ids are cut into blocks of fixed size, each block is transposed into four byte
planes, and each plane is compressed by itself, which leaves the two upper planes almost
empty. A chunk's row carries the index: where each plane ends, the chunk's first id within the
shard, and the ids and sizes of its documents. Shards are Parquet files, so Spark commits them
whole and any task can read any of them.

Null text counts as empty. Repeated ids are ordered by text, a null id comes first. An empty
table gives an empty store.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clonarium.llm.bpe import encoder
from clonarium.llm.common import block_count, documents

CHUNK_IDS, BLOCK_IDS = 1 << 18, 1 << 16
STORE_SCHEMA = """shard int, first long, n_ids long, doc_ids binary, null_ids binary, doc_sizes binary,
                  plane_ends array<long>, planes binary"""


def to_planes(ids: np.ndarray, block: int = BLOCK_IDS) -> tuple[list[int], bytes]:
    """Compressed byte planes of each block of ids, and where each plane ends."""
    compress = zstandard.ZstdCompressor(level=3).compress
    planes = [
        compress(plane.tobytes())
        for begin in range(0, len(ids), block)
        for plane in ids[begin : begin + block].astype("<u4").view(np.uint8).reshape(-1, 4).T
    ]
    return np.cumsum([len(p) for p in planes], dtype=np.int64).tolist(), b"".join(planes)


def from_planes(ends: list[int], planes: bytes) -> np.ndarray:
    """The ids that ``to_planes`` was given."""
    decompress = zstandard.ZstdDecompressor().decompress
    parts = [
        np.frombuffer(decompress(planes[a:b]), np.uint8) for a, b in zip([0, *ends[:-1]], ends, strict=True)
    ] if ends else []
    blocks = [np.stack(parts[i : i + 4], axis=1).reshape(-1).view("<u4") for i in range(0, len(parts), 4)]
    return np.concatenate(blocks) if blocks else np.empty(0, "<u4")


def with_end(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Put ``end_id`` behind each document's ids."""
    ends = np.cumsum(sizes + 1)
    out = np.empty(len(ids) + len(sizes), np.uint32)
    out[ends - 1] = end_id
    inside = np.ones(len(out), bool)
    inside[ends - 1] = False
    out[inside] = ids
    return out, sizes + 1


def write_tokens(docs: DataFrame, vocabulary: str, end_id: int, path: str) -> None:
    """Encode all documents in id order and write the store at ``path``."""

    def chunk(batches) -> Iterator[pa.RecordBatch]:
        shard, before = TaskContext.get().partitionId(), 0
        held_ids, held_docs, held_sizes, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(held_ids)
            ends, planes = to_planes(ids)
            squeeze = zstandard.ZstdCompressor().compress
            # Nulls cannot lie in a plane of numbers; a bit for each document tells them.
            absent = np.array([d is None for d in held_docs])
            names = np.array([d or 0 for d in held_docs], "<i8")
            return pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([shard], pa.int32()),
                    "first": pa.array([before], pa.int64()),
                    "n_ids": pa.array([len(ids)], pa.int64()),
                    "doc_ids": pa.array([squeeze(names.tobytes())], pa.binary()),
                    "null_ids": pa.array([squeeze(np.packbits(absent).tobytes())], pa.binary()),
                    "doc_sizes": pa.array([squeeze(np.concatenate(held_sizes).astype("<i8").tobytes())], pa.binary()),
                    "plane_ends": pa.array([ends], pa.list_(pa.int64())),
                    "planes": pa.array([planes], pa.binary()),
                }
            )

        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            begin = 0
            while begin < len(texts):
                end, chars = begin, 0
                while end < len(texts) and (end == begin or chars + len(texts[end]) <= 2 * CHUNK_IDS):
                    chars += len(texts[end])
                    end += 1
                ids, sizes = with_end(*encoder(vocabulary).encode(texts[begin:end]), end_id)
                held_ids.append(ids)
                held_docs += names[begin:end]
                held_sizes.append(sizes)
                held += len(ids)
                begin = end
                if held >= CHUNK_IDS:
                    yield flush()
                    before += held
                    held_ids, held_docs, held_sizes, held = [], [], [], 0
        if held:
            yield flush()

    ordered = documents(docs).repartitionByRange(block_count(docs.sparkSession), "doc_id")
    ordered.sortWithinPartitions("doc_id", "text").mapInArrow(chunk, STORE_SCHEMA).write.option(
        "compression", "none"
    ).parquet(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` (and its ids)."""
    store = spark.read.schema(STORE_SCHEMA).parquet(path)

    def restore(batches) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row in batch.to_pylist():
                ids = from_planes(row["plane_ends"], row["planes"])
                names = np.frombuffer(expand(row["doc_ids"]), "<i8")
                absent = np.unpackbits(np.frombuffer(expand(row["null_ids"]), np.uint8), count=len(names)).astype(bool)
                ends = np.cumsum(np.frombuffer(expand(row["doc_sizes"]), "<i8"))
                starts = np.concatenate([[0], ends[:-1]])
                raw = memoryview(ids.tobytes())
                bodies = [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = {
                    "shard": pa.array(np.full(len(names), row["shard"], np.int32)),
                    "doc_id": pa.array(names, mask=absent),
                    "at": pa.array(starts + row["first"], pa.int64()),
                    "n_tokens": pa.array(ends - starts, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(b) for b in bodies], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array([np.frombuffer(b, "<u4").astype(np.int64) for b in bodies], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)

    schema = "shard int, doc_id long, at long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    rows = store.mapInArrow(restore, schema)
    # One row per shard; their number is that of the partitions written, not of documents.
    totals = store.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    starts = totals.select("shard", F.coalesce(before, F.lit(0)).alias("base"))
    columns = ["doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"]
    return rows.join(starts, "shard").select(*columns, *(["ids"] if with_ids else []))
