"""Packing documents into sequences by shortest-pack-first over the length histogram (operator 10).

Documents are encoded and cut into pieces of at most the sequence length; whole-length pieces
are sequences by themselves. The histogram of piece lengths (as many rows as there are
lengths) is packed longest first, each time onto the open pattern that is shortest, keeping a
count per pattern instead of one pack per sequence. The finished patterns are rank ranges per
length; each piece finds its sequence by its rank among the pieces of its length.

Ranks need no global sort: every encoding task numbers its own pieces by length, and a
(task, length) table of counts shifts them. Null text counts as empty; every document has at
least its end token. Repeated rows are packed like any others.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clonarium.llm.bpe import encoder
from clonarium.llm.common import documents, materialize
from clonarium.llm.token_files import with_end

PIECES_SCHEMA = """doc_id long, start long, length long, ids_crc32 long, doc_tokens long,
                   task long, place long"""
PACKED_SCHEMA = """doc_id long, start long, length long, ids_crc32 long, doc_tokens long,
                   sequence_id long, offset long"""
_TEXTS_AT_ONCE = 2000


def pack_histogram(counts: dict[int, int], limit: int) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, first rank, number, first sequence, offset) that place all pieces.

    The pieces of a length with ranks first ... first + number - 1 go, one each, to as many
    consecutive sequences at the same offset.
    """
    # Open patterns by free space: (number of sequences, [(length, first rank), ...]).
    space: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    closed: list[tuple[int, list[tuple[int, int]]]] = []

    def put(free: int, number: int, parts: list[tuple[int, int]]) -> None:
        if free:
            space.setdefault(free, []).append((number, parts))
        else:
            closed.append((number, parts))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            widest = max((f for f, open_ in space.items() if open_), default=0)
            if widest < length:
                # As many sequences as the rest needs when each takes several pieces.
                number = -(-left // (limit // length))
                put(limit - length, number, [(length, rank)])
                left, rank = left - number, rank + number
                continue
            number, parts = space[widest].pop()
            if number > left:
                put(widest, number - left, [(size, first + left) for size, first in parts])
                number = left
            put(widest - length, number, [*parts, (length, rank)])
            left, rank = left - number, rank + number
    closed += [pattern for open_ in space.values() for pattern in open_]
    slots, sequence = [], 0
    for number, parts in closed:
        offset = 0
        for size, first in parts:
            slots.append((size, first, number, sequence, offset))
            offset += size
        sequence += number
    return slots


def cut_pieces(docs: DataFrame, vocabulary: str, limit: int, end_id: int) -> DataFrame:
    """Encode and cut; ``place`` is a piece's rank among its task's pieces of its length."""

    def cut(batches) -> Iterator[pa.RecordBatch]:
        task, used = TaskContext.get().partitionId(), np.zeros(limit + 1, np.int64)
        for batch in batches:
            for part in (batch.slice(i, _TEXTS_AT_ONCE) for i in range(0, batch.num_rows, _TEXTS_AT_ONCE)):
                ids, sizes = with_end(*encoder(vocabulary).encode(part.column(1).to_pylist()), end_id)
                per_doc = -(-sizes // limit)
                doc = np.repeat(np.arange(len(sizes)), per_doc)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)) * limit
                length = np.minimum(limit, sizes[doc] - start)
                begin = (np.cumsum(sizes) - sizes)[doc] + start
                order = np.argsort(length, kind="stable")
                ordered = length[order]
                first = np.searchsorted(ordered, ordered)
                place = np.empty(len(doc), np.int64)
                place[order] = np.arange(len(doc)) - first + used[ordered]
                used += np.bincount(length, minlength=limit + 1)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                     pa.array(sizes[doc]), pa.array(np.full(len(doc), task)), pa.array(place)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "place"],
                )

    return documents(docs).mapInArrow(cut, PIECES_SCHEMA)


def pack(docs: DataFrame, vocabulary: str, limit: int = 1024, end_id: int = 0) -> DataFrame:
    """Every piece with its sequence and its offset there."""
    pieces = materialize(cut_pieces(docs, vocabulary, limit, end_id), "pieces")
    by_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    # At most ``limit`` rows come to the driver, whatever the input.
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = sorted(pack_histogram(counts, limit))
    lengths = np.array([s[0] for s in slots], np.int64)
    first, sequence, offset = (np.array([s[i] for s in slots], np.int64) for i in (1, 3, 4))
    bases = np.zeros(limit + 2, np.int64)
    for length, n in counts.items():
        bases[length + 1] = n
    bases = np.cumsum(bases)  # pieces shorter than a length
    slot_ranks = bases[lengths] + first

    before = F.sum("n").over(
        Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = by_task.select("task", "length", F.coalesce(before, F.lit(0)).alias("shift"))

    def place(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = bases[length] + batch.column("rank").to_numpy()
            slot = np.searchsorted(slot_ranks, rank, "right") - 1
            kept = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            sequence_id = sequence[slot] + rank - slot_ranks[slot]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence_id), pa.array(offset[slot])],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    ranked = pieces.join(shifts, ["task", "length"]).withColumn("rank", F.col("place") + F.col("shift"))
    return ranked.mapInArrow(place, PACKED_SCHEMA)
