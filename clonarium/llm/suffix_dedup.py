"""Removal of repeated 100-byte strings through a sampled suffix array (operator 8).

A byte goes if a string of ``SPAN`` bytes that covers it also starts earlier: in a smaller
document, or earlier in the same one. Sorting a suffix per byte would move the corpus a
hundredfold, so only sampled suffixes are sorted, chosen so that nothing is lost:

1. Within each window of ``SPAN`` bytes the suffix whose leading gram (``GRAM`` bytes, as a
   fingerprint) is least stands for it. Equal windows choose the same place, and neighbouring
   windows mostly share one, so about one suffix in thirty bytes is kept, with the run of
   windows it stands for. Equal strings therefore always meet under one leading gram.
2. Splitters taken from a sample range-partition the suffixes by leading gram; a gram that
   fills several ranges is split on by what follows. Every bucket is sorted. Of equal runs of
   windows all but the first are repeats. A gram with different runs, or on a bucket's edge,
   is kept as a candidate: its runs may still share some windows.
3. The candidates' bytes are fetched, range-partitioned by gram the same way, and each
   bucket's suffixes are sorted by multikey quicksort over eight-byte words and compared with
   their neighbours byte for byte. A gram with many candidates, such as that of a common line
   among ever different neighbours, is taken apart first: windows with the gram at about the
   same place go under the longer string they must share. Where that crowds as well, the place
   is told more closely, at last for each window. So what a task compares at once is bounded.
4. Repeated windows are merged per document and cut out.

The number of buckets follows the bytes of the texts, which are counted.

Fingerprints only bring suffixes together in step 3. In step 2 equal runs are told by 128
bits, gram and run. Null text counts as empty and loses nothing; a null id sorts before all
others; equal ids are ordered by text, and rows that also have the same text share one
result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clonarium.llm.bpe import _powers, ragged
from clonarium.llm.common import block_count, documents, materialize, sliding, with_positions

SPAN, GRAM = 100, 32
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
# Texts are read in stretches of this size, overlapping by SPAN - 1 bytes.
_STRETCH = 1 << 20
_PLACE = np.uint64((1 << 21) - 1)
_FLUSH_ROWS = 1 << 18
BUCKET_BYTES = 64 << 20  # of text
# Candidates that are compared as one group; larger groups are taken apart.
CROWD = 256
# Windows of a piece of a candidate taken apart; halved while that crowds, so a power of two.
PIECE = 8
# Sampled suffixes for each splitter, about.
DRAWN = 1000
SUFFIX_SCHEMA = "bucket int, gram long, run long, doc_id long, first long, last long, at long"
WINDOW_SCHEMA = "doc_id long, first long, last long"
BODY_SCHEMA = "bucket int, gram long, doc_id long, first long, last long, at long, body binary, piece boolean"
REPEAT_SCHEMA = "bucket int, gram long, doc_id long, first long, last long, at long, settled boolean"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def sampled_suffixes(text: bytes) -> tuple[np.ndarray, ...]:
    """(gram, run, first window, last window, suffix place) of each sampled suffix."""
    parts = []
    for begin in range(0, max(len(text) - SPAN + 1, 0), _STRETCH):
        body = np.frombuffer(text, np.uint8, min(_STRETCH + SPAN - 1, len(text) - begin), begin)
        room = _STRETCH + 2 * SPAN
        sums = np.zeros(len(body) + 1, np.uint64)
        np.cumsum((body.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, room)[: len(body)], out=sums[1:])
        back = _powers(_INVERSE, room)
        grams = _mix((sums[GRAM:] - sums[:-GRAM]) * back[: len(body) - GRAM + 1])
        ranked = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        chosen = (sliding(ranked, SPAN - GRAM + 1, np.minimum) & _PLACE).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(chosen)) + 1])
        last = np.append(first[1:], len(chosen)) - 1
        at = chosen[first]
        shape = np.uint64(0x10001) * (at - first).astype(np.uint64) + (last - first).astype(np.uint64)
        run = _mix(((sums[last + SPAN] - sums[first]) * back[first]) ^ _mix(shape + np.uint64(1)))
        parts.append((grams[at], run, first + begin, last + begin, at + begin))
    if not parts:
        return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


class Splitters:
    """Bucket bounds from sampled leading grams; a gram drawn often gets buckets of its own."""

    def __init__(self, grams: np.ndarray):
        self.grams = np.sort(grams)

    def bucket(self, gram: np.ndarray, run: np.ndarray) -> np.ndarray:
        low = np.searchsorted(self.grams, gram, "left")
        width = np.searchsorted(self.grams, gram, "right") - low
        # A gram that is a bound k times spreads over k + 1 buckets by what follows it.
        share = (run.view(np.uint64) >> np.uint64(40)).astype(np.int64) * (width + 1) >> 24
        return (low + share).astype(np.int32)


def _suffix_batch(columns: list[np.ndarray], splitters: Splitters) -> pa.RecordBatch:
    gram, run, doc, first, last, at = columns
    bucket = splitters.bucket(gram, run)
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket), pa.array(gram), pa.array(run), pa.array(doc), pa.array(first), pa.array(last), pa.array(at)],
        names=["bucket", "gram", "run", "doc_id", "first", "last", "at"],
    )


def _gather(batches) -> Iterator[list[np.ndarray]]:
    """Sampled suffixes of a task's documents, a bounded number of rows at a time."""
    held, rows = [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            gram, run, first, last, at = sampled_suffixes(text.encode("utf-8", "surrogatepass"))
            if not len(gram):
                continue
            key = np.full(len(gram), doc)
            held.append((gram.view(np.int64), run.view(np.int64), key, first, last, at))
            rows += len(gram)
            if rows >= _FLUSH_ROWS:
                yield [np.concatenate(c) for c in zip(*held, strict=True)]
                held, rows = [], 0
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def _firsts(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order by (gram, run, doc, window), and which rows there begin a new (gram, run)."""
    gram, run, doc, first = columns[:4]
    order = np.lexsort((first, doc, run, gram))
    g, r = gram[order], run[order]
    new = np.ones(len(order), bool)
    new[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
    return order, new


def text_size(keyed: DataFrame) -> tuple[int, int]:
    """Documents and bytes of text, counted: the planner's estimate may be off by any factor."""
    row = keyed.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("size")).first()
    return row["n"], row["size"] or 0


def bucket_count(spark: SparkSession, n_bytes: int) -> int:
    """Enough buckets that each, a bucket being sorted in memory, stays small."""
    return block_count(spark, -(-n_bytes // BUCKET_BYTES))


def sampled_bounds(keyed: DataFrame, buckets: int, n_docs: int, n_bytes: int) -> np.ndarray:
    """Leading grams that cut a sample into about ``buckets`` equal parts, in order.

    The sample is counted and sorted by Spark and every so-manieth gram of a partition is a bound,
    as often as it fills a step, so eight bytes a bucket reach the driver.
    """
    if buckets < 2 or not n_docs:
        return np.empty(0, np.int64)

    def sample(batches):
        for columns in _gather(batches):
            yield pa.RecordBatch.from_arrays([pa.array(columns[0])], names=["gram"])

    # A suffix in some 35 bytes; whole documents are drawn, at least 100 a bucket.
    share = max(DRAWN * buckets * 35 / max(n_bytes, 1), 100 * buckets / n_docs, 0.001)
    drawn = keyed.sample(share, seed=1) if share < 1 else keyed
    counted = materialize(drawn.mapInArrow(sample, "gram long").groupBy("gram").count(), "sampled-grams")
    total = counted.agg(F.sum("count")).first()[0] or 0
    step = max(1, total // buckets)

    def pick(batches):
        seen = step // 2
        for batch in batches:
            ends = seen + np.cumsum(batch.column("count").to_numpy())
            steps = ends // step - np.append(seen, ends[:-1]) // step
            seen = ends[-1] if len(ends) else seen
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column("gram").to_numpy(), steps))], names=["gram"])

    picked = counted.sort("gram").mapInArrow(pick, "gram long").toArrow()
    return np.sort(picked.column("gram").to_numpy())


def repeated_suffixes(keyed: DataFrame, buckets: int, n_docs: int, n_bytes: int) -> DataFrame:
    """Steps 1 and 2 over (position, text): settled repeats and candidates."""
    splitters = Splitters(sampled_bounds(keyed, buckets, n_docs, n_bytes))
    # Bounds are about as many as asked for.
    buckets = len(splitters.grams) + 1

    def emit(batches):
        # Combine before the shuffle: only the first of equal runs can be the first of all.
        for columns in _gather(batches):
            order, new = _firsts(columns)
            yield _suffix_batch([c[order[new]] for c in columns], splitters)
            rest = [c[order[~new]] for c in columns]
            if len(rest[0]):
                marked = _suffix_batch(rest, splitters)
                yield marked.set_column(0, "bucket", pa.array(np.full(len(rest[0]), -1, np.int32)))

    suffixes = keyed.mapInArrow(emit, SUFFIX_SCHEMA)
    # Rows known to be repeats need no company; they stay out of the buckets.
    dealt = F.pmod(F.xxhash64("doc_id", "first"), F.lit(buckets)).cast("int")
    home = F.when(F.col("bucket") < 0, dealt).otherwise(F.col("bucket"))
    return suffixes.repartitionById(buckets, home).mapInArrow(_compare, REPEAT_SCHEMA)


def _compare(batches) -> Iterator[pa.RecordBatch]:
    """Sort one bucket and compare neighbours."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    table = pa.Table.from_batches(batches)
    names = ["gram", "run", "doc_id", "first", "last", "at"]
    bucket = table.column("bucket").to_numpy()
    columns = [table.column(n).to_numpy() for n in names]

    def out(rows: np.ndarray, settled: bool) -> pa.RecordBatch:
        gram, _, doc, first, last, at = (c[rows] for c in columns)
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[rows]), pa.array(gram), pa.array(doc), pa.array(first), pa.array(last), pa.array(at),
             pa.array(np.full(len(gram), settled))],
            names=["bucket", "gram", "doc_id", "first", "last", "at", "settled"],
        )

    known = np.flatnonzero(bucket < 0)
    if len(known):
        yield out(known, True)
    here = np.flatnonzero(bucket >= 0)
    if not len(here):
        return
    order, new = _firsts([c[here] for c in columns])
    yield out(here[order[~new]], True)
    heads = here[order[new]]
    gram = columns[0][heads]
    several = np.zeros(len(heads), bool)
    several[1:] = gram[1:] == gram[:-1]
    several[:-1] |= several[1:]
    # A gram on the bucket's edge may go on in the next bucket.
    several |= (gram == gram[0]) | (gram == gram[-1])
    yield out(heads[several], False)


def multikey_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort rows of words by multikey quicksort; True where a row equals the one before it.

    Rows are sorted by one word at a time; only rows still tied go on to the next word. Ties
    keep their given order.
    """
    order = np.argsort(words[:, 0], kind="stable")
    tied = np.zeros(len(order), bool)
    tied[1:] = words[order[1:], 0] == words[order[:-1], 0]
    for depth in range(1, words.shape[1]):
        inside = tied.copy()
        inside[:-1] |= tied[1:]
        rows = np.flatnonzero(inside)
        if not len(rows):
            break
        group = np.cumsum(~tied)[rows]
        column = words[order[rows], depth]
        local = np.lexsort((column, group))
        order[rows] = order[rows[local]]
        column = column[local]
        again = np.zeros(len(rows), bool)
        again[1:] = (group[1:] == group[:-1]) & (column[1:] == column[:-1])
        tied[rows] = again
    return order, tied


def _compare_bytes(batches) -> Iterator[pa.RecordBatch]:
    """Windows of a bucket's candidates that also start earlier, compared byte for byte."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    table = pa.Table.from_batches(batches).combine_chunks()
    gram, doc, first = (table.column(n).to_numpy() for n in ("gram", "doc_id", "first"))
    bodies = table.column("body").to_pylist()
    order = np.lexsort((first, doc, gram))
    # Groups of one gram, which are bounded, are compared a bounded number of windows at a time.
    sizes = np.fromiter((len(bodies[i]) - SPAN + 1 for i in order.tolist()), np.int64, len(order))
    edges = np.flatnonzero(np.append(True, gram[order][1:] != gram[order][:-1]))
    begin = 0
    while begin < len(order):
        total = np.cumsum(sizes[begin:])
        full = np.searchsorted(total, _FLUSH_ROWS) + begin
        after = edges[edges > max(full, begin)]
        end = int(after[0]) if len(after) else len(order)
        rows, counts = order[begin:end], sizes[begin:end]
        begin = end
        joined = np.frombuffer(b"".join(bodies[i] for i in rows.tolist()), np.uint8)
        starts = np.cumsum(counts + SPAN - 1) - (counts + SPAN - 1)
        places = ragged(starts, counts)
        owner = np.repeat(np.arange(len(rows)), counts)
        window = first[rows][owner] + places - starts[owner]
        by_age = np.lexsort((window, doc[rows][owner]))
        places, owner, window = places[by_age], owner[by_age], window[by_age]
        words = np.zeros((len(places), 8 * -(-SPAN // 8)), np.uint8)
        words[:, :SPAN] = np.lib.stride_tricks.sliding_window_view(joined, SPAN)[places]
        found, tied = multikey_order(words.view(">u8").astype(np.uint64))
        repeats = np.sort(found[tied])
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[rows][owner[repeats]]), pa.array(window[repeats]), pa.array(window[repeats])],
            names=["doc_id", "first", "last"],
        )


def _fingerprint(part: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(part, digest_size=8).digest(), "little", signed=True)


def _body_batch(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of BODY_SCHEMA; one without a body tells windows known to be repeats."""
    columns = zip(*rows, strict=True) if rows else ([],) * 8
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        names=["bucket", "gram", "doc_id", "first", "last", "at", "body", "piece"],
    )


def pieces(body: bytes, first: int, at: int, size: int) -> Iterator[tuple[int, int, bytes]]:
    """(gram, first window, bytes) of the pieces of some neighbouring windows of one gram.

    ``body`` begins with window ``first``; the gram lies ``at``. Equal windows hold their gram at the
    same place, ``at`` less the window, so they fall into the same piece of ``size`` windows, all
    of which cover the same SPAN - size + 1 bytes.
    """
    last = first + len(body) - SPAN
    for part in range((at - last) // size, (at - first) // size + 1):
        high = at - size * part
        low = high - size + 1
        begin, end = max(first, low), min(last, high)
        yield _fingerprint(body[high - first : low - first + SPAN]), begin, body[begin - first : end - first + SPAN]


def _piece_rows(runs: list[tuple[int, int, int, bytes]], size: int, buckets: int) -> list[tuple]:
    """Rows for the pieces of (doc, first window, gram's place, bytes), in order of age.

    Of equal pieces only the first need be compared; neighbouring ones known thereby share a row.
    """
    rows, met = [], set()
    for doc, first, at, body in sorted(runs):
        known = None
        for gram, begin, part in pieces(body, first, at, size):
            end = begin + len(part) - SPAN
            if part not in met:
                met.add(part)
                rows.append((gram % buckets, gram, doc, begin, end, at, part, True))
            elif known and known[0] == end + 1:
                known[0] = begin
            else:
                rows += [(0, 0, doc, *known, at, None, False)] if known else []
                known = [begin, end]
        rows += [(0, 0, doc, *known, at, None, False)] if known else []
    return rows


def _body_rows(buckets: int):
    """The bytes of each candidate's windows, for the buckets in which they are compared."""

    def emit_bodies(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, crowded = [], []
            for row in batch.to_pylist():
                raw, doc = row["text"].encode("utf-8", "surrogatepass"), row["position"]
                for c in row["runs"]:
                    body = raw[c["first"] : c["last"] + SPAN]
                    if c["crowded"]:
                        crowded.append((doc, c["first"], c["at"], body))
                    else:
                        rows.append((c["bucket"], c["gram"], doc, c["first"], c["last"], c["at"], body, False))
            yield _body_batch(rows + _piece_rows(crowded, PIECE, buckets))

    return emit_bodies


def _smaller_pieces(buckets: int, size: int):
    """Pieces cut in pieces of ``size`` windows."""

    def emit_pieces(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [(r["doc_id"], r["first"], r["at"], r["body"]) for r in batch.to_pylist()]
            yield _body_batch(_piece_rows(runs, size, buckets))

    return emit_pieces


def _uncrowded(bodies: DataFrame, buckets: int) -> DataFrame:
    """``bodies`` with the pieces that crowd under one gram cut smaller, at most to single windows."""
    done, level, size = bodies.where("not piece"), bodies.where("piece"), PIECE
    while size > 1:
        heavy = level.groupBy("gram").count().where(F.col("count") > CROWD).select("gram")
        heavy = materialize(heavy, "crowded-pieces")
        if heavy.isEmpty():
            break
        size //= 2
        done = done.unionByName(level.join(heavy, "gram", "left_anti"))
        cut = level.join(heavy, "gram", "left_semi").select(bodies.columns)
        made = materialize(cut.mapInArrow(_smaller_pieces(buckets, size), BODY_SCHEMA), "pieces")
        done, level = done.unionByName(made.where("not piece")), made.where("piece")
    return done.unionByName(level)


def repeated_windows(keyed: DataFrame) -> DataFrame:
    """(position, first, last) of all windows of SPAN bytes that also start earlier."""
    keyed = keyed.select("position", "text")
    n_docs, n_bytes = text_size(keyed)
    buckets = bucket_count(keyed.sparkSession, n_bytes)
    found = materialize(repeated_suffixes(keyed, buckets, n_docs, n_bytes), "suffixes")
    open_ = found.where("not settled")
    # A gram whose candidates lie in several buckets is taken apart too, so that its windows meet.
    crowd = open_.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), (F.min("bucket") < F.max("bucket")).alias("apart"))
    crowd = materialize(crowd.where(F.col("apart") | (F.col("n") > CROWD)).select("gram", F.lit(True).alias("crowded")), "crowded")
    crowded = F.coalesce("crowded", F.lit(False)).alias("crowded")
    candidates = (
        open_.join(crowd, "gram", "left")
        .groupBy(F.col("doc_id").alias("position"))
        .agg(F.collect_list(F.struct("bucket", "gram", "first", "last", "at", crowded)).alias("runs"))
    )
    rows = keyed.join(candidates, "position")
    bodies = materialize(rows.mapInArrow(_body_rows(buckets), BODY_SCHEMA), "bodies")
    bodies = _uncrowded(bodies, buckets)
    known = bodies.where("body is null").select("doc_id", "first", "last")
    open_bodies = bodies.where("body is not null").select("bucket", "gram", "doc_id", "first", "body")
    compared = open_bodies.repartitionById(buckets, F.col("bucket")).mapInArrow(_compare_bytes, WINDOW_SCHEMA)
    settled = found.where("settled").select("doc_id", "first", "last").unionByName(known)
    return settled.unionByName(compared).withColumnRenamed("doc_id", "position")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, the removed ``spans`` in bytes, and the bytes ``kept``."""
    keyed = with_positions(documents(docs)).withColumnRenamed("_position", "position")
    windows = repeated_windows(keyed)
    runs = windows.groupBy("position").agg(F.collect_list(F.struct("first", "last")).alias("runs"))

    def cut(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, spans, kept = [], [], []
            runs = batch.column("runs")
            for i, text in enumerate(batch.column("text").to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                found = merged(runs[i]) if runs[i].is_valid else []
                n_bytes.append(len(raw))
                spans.append([{"start": a, "end": b} for a, b in found])
                edges = [0, *(x for span in found for x in span), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if found else raw)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(spans, _SPANS), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )

    schema = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    return keyed.join(runs, "position", "left").mapInArrow(cut, schema)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def merged(runs: pa.ListScalar) -> list[tuple[int, int]]:
    """The maximal byte spans that runs of windows cover."""
    values = runs.values
    first, last = (values.field(n).to_numpy(zero_copy_only=False) for n in ("first", "last"))
    order = np.argsort(first, kind="stable")
    begin, end = first[order], np.maximum.accumulate(last[order] + SPAN)
    new = np.append(True, begin[1:] > end[:-1])
    stops = np.append(np.flatnonzero(new)[1:], len(new)) - 1
    return list(zip(begin[new].tolist(), end[stops].tolist(), strict=True))
