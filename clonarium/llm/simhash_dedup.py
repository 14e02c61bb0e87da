"""SimHash near-duplicates through segment popcounts (operator 7).

A fingerprint of 64 bits is cut into 32 segments of two bits; the counts of set bits per
segment are a point in a 32-dimensional grid. Two fingerprints that differ in d bits lie at
Manhattan distance d at most, so that distance is a lower bound to filter by. The range join on
the grid splits the dimensions into six groups: points within distance 3 agree wholly in at
least three groups, so each point is put into 20 cells, one for every three groups, and only
points of one cell are compared; first by Manhattan distance, then bit by bit.

Only distinct fingerprints enter the grid; copies share one. A cell returns a spanning set of
its links, never all pairs. Cells too large to compare at once are searched outwards from one
point at a time, each found point leaving the search, so a cluster around one fingerprint
takes little more than one pass. No task holds a cell of more than ``_TOGETHER`` fingerprints:
it is cut into parts of that size, and every two parts meet in a group of their own.

Null text counts as empty and has no words, hence fingerprint zero, which links like any
other. A null id never names a component unless all its members' ids are null. Repeated rows
are returned once each. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clonarium.llm.common import block_count, documents, materialize, with_positions
from clonarium.llm.components import components

SHINGLE_WORDS, MAX_BITS, SEED = 3, 3, 42
_SEGMENTS = 32
_AT_ONCE = 2048  # fingerprints of a cell that are compared pair by pair
_TOGETHER = 8192  # fingerprints of a cell that one task holds
_GROUPS = np.array_split(np.arange(_SEGMENTS), 2 * MAX_BITS)
_HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str, width: int = SHINGLE_WORDS) -> int:
    """SimHash of a text's shingles of ``width`` words, repeats included."""
    listed = text.encode("utf-8", "surrogatepass").lower().split()
    if not listed:
        return 0
    joined = memoryview(b" ".join(listed))
    ends = np.cumsum(np.fromiter(map(len, listed), np.int64, len(listed)) + 1)
    starts = [0, *ends[:-1].tolist()]
    last = (ends[width - 1 :] - 1).tolist() or [len(joined)]
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), len(last)
    for begin in range(0, n, _HASHES_AT_ONCE):
        spans = zip(starts[begin : begin + _HASHES_AT_ONCE], last[begin : begin + _HASHES_AT_ONCE], strict=False)
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS, id_col: str = "doc_id") -> DataFrame:
    """``doc_id`` and its fingerprint as a signed long."""

    def hash_texts(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "bits"])

    return documents(docs, id_col=id_col).mapInArrow(hash_texts, "doc_id long, bits long")


def segment_counts(bits: np.ndarray) -> np.ndarray:
    """The set bits of each segment, one row per fingerprint."""
    spread = np.unpackbits(bits.astype(np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return spread.reshape(len(bits), _SEGMENTS, -1).sum(axis=2, dtype=np.uint8)


def cells(bits: np.ndarray) -> np.ndarray:
    """The grid cells of each fingerprint: one key for every MAX_BITS of the groups."""
    counts = segment_counts(bits).astype(np.int64)
    base = 64 // _SEGMENTS + 1
    group_keys = np.stack([counts[:, g] @ base ** np.arange(len(g)) for g in _GROUPS], axis=1)
    span = base ** max(map(len, _GROUPS))
    keys = []
    for number, chosen in enumerate(combinations(range(len(_GROUPS)), MAX_BITS)):
        key = np.full(len(bits), number, np.int64)
        for group in chosen:
            key = key * span + group_keys[:, group]
        keys.append(key)
    return np.stack(keys, axis=1)


def cell_links(bits: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """A spanning set of the links among the distinct fingerprints of one cell."""
    counts = segment_counts(bits).astype(np.int8)
    left = np.arange(len(bits))
    links = []

    def near(one: int, others: np.ndarray) -> np.ndarray:
        bound = np.abs(counts[others] - counts[one]).sum(axis=1, dtype=np.int16) <= max_bits
        others = others[bound]
        return others[np.bitwise_count(bits[others] ^ bits[one]) <= max_bits]

    if len(bits) <= _AT_ONCE:
        a, b = np.triu_indices(len(bits), 1)
        for part in range(0, len(a), 1 << 18):
            i, j = a[part : part + (1 << 18)], b[part : part + (1 << 18)]
            bound = np.abs(counts[i] - counts[j]).sum(axis=1, dtype=np.int16) <= max_bits
            i, j = i[bound], j[bound]
            same = np.bitwise_count(bits[i] ^ bits[j]) <= max_bits
            links += zip(i[same].tolist(), j[same].tolist(), strict=True)
        return _spanning(len(bits), links)
    while len(left):
        waiting, left = [int(left[0])], left[1:]
        while waiting and len(left):
            found = near(one := waiting.pop(), left)
            links += [(one, int(f)) for f in found]
            waiting += found.tolist()
            if len(found):
                left = np.setdiff1d(left, found, assume_unique=True)
    return links


def _spanning(n: int, links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    root = list(range(n))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    kept = []
    for a, b in links:
        if (x := top(a)) != (y := top(b)):
            root[x] = y
            kept.append((a, b))
    return kept


def fingerprint_links(distinct: DataFrame, together: int = _TOGETHER) -> DataFrame:
    """(a, b): links that join all distinct ``bits`` within MAX_BITS of each other.

    Cells of more than ``together`` are cut into parts, of which every two are compared.
    """

    def deal(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column(0).to_numpy()
            keys = cells(bits.view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.repeat(bits, keys.shape[1]))], names=["cell", "bits"]
            )

    def compare(limit: int):
        def run(batches) -> Iterator[pa.RecordBatch]:
            for key, part, bits in _cell_groups(batches, limit):
                if part is None:
                    links = np.array(cell_links(bits.view(np.uint64)), np.int64).reshape(-1, 2)
                    a, b = bits[links[:, 0]], bits[links[:, 1]]
                    cell = number = pa.nulls(len(a), pa.int64())
                else:
                    a, b = bits, pa.nulls(len(bits), pa.int64())
                    cell, number = (pa.array(np.full(len(bits), x, np.int64)) for x in (key, part))
                if len(a):
                    yield pa.RecordBatch.from_arrays([cell, number, pa.array(a), pa.array(b)], names=["cell", "part", "a", "b"])

        return run

    n = block_count(distinct.sparkSession)

    def compared(cells: DataFrame, limit: int) -> DataFrame:
        sorted_cells = cells.repartition(n, "cell").sortWithinPartitions("cell")
        return sorted_cells.mapInArrow(compare(limit), "cell long, part long, a long, b long")

    first = materialize(compared(distinct.mapInArrow(deal, "cell long, bits long"), together), "cell-links")
    parts = first.where("cell is not null").select("cell", "part", F.col("a").alias("bits"))
    # One row per cut cell.
    last = F.broadcast(parts.groupBy("cell").agg(F.max("part").alias("last")))
    other = F.explode(F.filter(F.sequence(F.lit(0).cast("long"), F.col("last")), lambda p: p != F.col("part"))).alias("other")
    met = parts.join(last, "cell").select("cell", "part", "bits", other)
    pair = F.xxhash64("cell", F.least("part", "other"), F.greatest("part", "other")).alias("cell")
    pairs = compared(met.select(pair, "bits"), np.iinfo(np.int64).max)
    return first.where("cell is null").select("a", "b").unionByName(pairs.select("a", "b"))


def _cell_groups(batches, limit: int) -> Iterator[tuple[int, int | None, np.ndarray]]:
    """(cell, null, fingerprints) of cells with several from rows sorted by cell; larger ones than
    ``limit`` come in parts with their numbers, at least two."""
    held_keys, held_bits = np.empty(0, np.int64), np.empty(0, np.int64)
    given = 0  # parts of the cell held that have been given

    def whole(key: int, bits: np.ndarray) -> Iterator[tuple[int, int | None, np.ndarray]]:
        if not given and len(bits) <= limit:
            yield key, None, bits
        else:
            for number, begin in enumerate(range(0, len(bits), limit), given):
                yield key, number, bits[begin : begin + limit]

    for batch in batches:
        keys = np.concatenate([held_keys, batch.column(0).to_numpy()])
        bits = np.concatenate([held_bits, batch.column(1).to_numpy()])
        edges = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        edges = np.concatenate([[0], edges, [len(keys)]])
        several = np.diff(edges[:-1]) > 1
        several[:1] |= given > 0
        for i in np.flatnonzero(several).tolist():
            yield from whole(int(keys[edges[i]]), bits[edges[i] : edges[i + 1]])
            given = 0
        if len(several):
            given = 0
        held_keys, held_bits = keys[edges[-2] :], bits[edges[-2] :]
        while len(held_bits) > limit:
            yield int(held_keys[0]), given, held_bits[:limit]
            given, held_keys, held_bits = given + 1, held_keys[limit:], held_bits[limit:]
    if len(held_bits) > 1 or given:
        yield from whole(int(held_keys[0]), held_bits)


def near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS, id_col: str = "doc_id") -> DataFrame:
    """``doc_id``, ``bits`` and ``component_id``, the least id linked directly or in steps."""
    marked = materialize(fingerprints(docs, width, id_col), "fingerprints")
    distinct = materialize(marked.groupBy("bits").agg(F.min("doc_id").alias("least")), "distinct")
    groups = components(fingerprint_links(distinct.select("bits")))
    joined = distinct.join(groups.withColumnRenamed("node", "bits"), "bits", "left").select(
        "bits", "least", F.coalesce("component", "bits").alias("root")
    )
    joined = materialize(joined, "roots")
    names = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    of_bits = joined.join(names, "root").select("bits", "component_id")
    return marked.join(of_bits, "bits").select("doc_id", "bits", "component_id")


def drop_near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` with the row of least id, then text, of each component."""
    # The row goes along as one column, so that no name of its can clash.
    whole = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = with_positions(whole)
    found = near_duplicates(keyed, width, "_position")
    first = found.where("doc_id = component_id").select(F.col("doc_id").alias("_position"))
    return keyed.select("_position", "_row").join(first, "_position", "left_semi").select("_row.*")
