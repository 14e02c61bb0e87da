"""Benchmark decontamination with a distributed positional inverted index (operator 6).

``build_index`` lays the words of documents end to end in segments of about ``SEGMENT_BYTES`` of
text and writes their postings as a table: a row for each word of a segment with the places where
it stands, ascending, and one row that names the segment's documents and their numbers of words.
Any number of searches can read the table.

``search`` makes the test windows with Spark, one row for each different run of words. The words
of all windows are counted over the whole index; a window with a word that never occurs is left
out, and the others are led by their rarest word. A join of leading words with the index gives
the segments a window may occur in. There the postings of the words of windows, sorted by segment,
come first and the windows after them, in batches: candidate starts are the leading word's places
less its offset, and the other words' lists, the rarest in the segment next, are intersected
with them at their own offsets. With ``slop`` 0 these are exact phrases; with a larger one
each word may stand up to ``slop`` words from its place (proximity matches). Words are compared
as they are, not by fingerprint.

Neither documents nor benchmark go through the driver or are broadcast by force. A task holds the
postings of one segment, a batch of windows and at most ``CANDIDATES`` starts at a time, or the list
of one word if that is longer; a document longer than a segment is a segment of its own, at
some tens of bytes a word. A leading word of very many windows and segments is a heavy key of an
ordinary join, which Spark splits at run time.

Null text has no words. Items without words never occur; several rows of one item are items
with one id. A null item id is left out of the benchmark. Repeated documents are answered one
by one, and other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clonarium.llm.bpe import ragged
from clonarium.llm.common import documents, materialize, spread, with_positions

WINDOW = 10
SEGMENT_BYTES = 1 << 23
CANDIDATES = 1 << 21
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_IN_WORD = np.ones(256, bool)
_IN_WORD[:0x80] = False
_IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = True

# ``docs`` is filled in the row that names a segment's documents, ``word`` and what follows in the others.
INDEX = "segment long, docs array<struct<key: long, n_words: int>>, word binary, n int, places binary"
_DOCS = pa.list_(pa.struct([("key", pa.int64()), ("n_words", pa.int32())]))
_RUNS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


# ---- the index


def build_index(docs: DataFrame, key: str, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The postings of ``text`` as a written table. ``key``: a column of distinct longs, none null."""

    def build(batches) -> Iterator[pa.RecordBatch]:
        keys, texts, size = [], [], 0
        for batch in batches:
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if texts and size + len(text) > segment_bytes:
                    yield from _postings(keys, texts)
                    keys, texts, size = [], [], 0
                keys.append(k)
                texts.append(text)
                size += len(text) + 1
        if texts:
            yield from _postings(keys, texts)

    return materialize(docs.select(key, "text").mapInArrow(build, INDEX), "postings")


def _postings(keys: list[int], texts: list[bytes]) -> Iterator[pa.RecordBatch]:
    """A segment's rows. It is named by its first document."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    body = np.frombuffer(b"\n".join(texts).translate(_LOWER), np.uint8)
    inside = np.zeros(len(body) + 2, bool)
    inside[1:-1] = _IN_WORD[body]
    starts, ends = np.flatnonzero(~inside[:-1] & inside[1:]), np.flatnonzero(inside[:-1] & ~inside[1:])
    doc = np.searchsorted(np.cumsum(sizes + 1), starts, "right")
    n_words = np.bincount(doc, minlength=len(texts)).astype(np.int32)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    data = [None, pa.py_buffer(offsets), pa.py_buffer(body[inside[1:-1]])]
    listed = pa.Array.from_buffers(pa.large_binary(), len(starts), data).dictionary_encode()
    codes = listed.indices.to_numpy()
    places = np.argsort(codes, kind="stable").astype("<i4")
    counts = np.bincount(codes, minlength=len(listed.dictionary)).astype(np.int32)
    ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]) * 4
    packed = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(places)])

    named = pa.StructArray.from_arrays([pa.array(keys, pa.int64()), pa.array(n_words)], ["key", "n_words"])
    yield _batch(keys[0], pa.ListArray.from_arrays([0, len(keys)], named).cast(_DOCS), None, None, None)
    for begin in range(0, len(counts), 10_000):
        part = slice(begin, begin + 10_000)
        words, lists = (a[part].cast(pa.binary()) for a in (listed.dictionary, packed))
        yield _batch(keys[0], None, words, pa.array(counts[part]), lists)


def _batch(segment: int, docs, words, n, places) -> pa.RecordBatch:
    size = len(docs if words is None else words)
    types = [pa.int64(), _DOCS, pa.binary(), pa.int32(), pa.binary()]
    given = [pa.array(np.full(size, segment)), docs, words, n, places]
    made = [pa.nulls(size, t) if a is None else a for a, t in zip(given, types, strict=True)]
    return pa.RecordBatch.from_arrays(made, names=["segment", "docs", "word", "n", "places"])


# ---- the windows


def test_windows(benchmark: DataFrame, width: int = WINDOW, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item, words): all runs of ``width`` words of the items; a shorter item is one window."""

    def cut(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                listed = _WORD.findall(text.translate(_LOWER))
                last = max(1, len(listed) - width + 1) if listed else 0
                for begin in range(0, last, 10_000):
                    runs = [listed[i : i + width] for i in range(begin, min(begin + 10_000, last))]
                    made = [pa.array([name] * len(runs), pa.int64()), pa.array(runs, pa.list_(pa.binary()))]
                    yield pa.RecordBatch.from_arrays(made, names=["item", "words"])

    items = documents(benchmark, id_col=item_id, text_col=item_text).where("doc_id is not null")
    return items.mapInArrow(cut, "item long, words array<binary>").distinct()


def _candidates(index: DataFrame, windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(segment, window) where the window's rarest word occurs, and the words of all windows that occur.

    What comes from the benchmark is written first: its size is known to the joins with the
    index then, which leave the index where it is if the benchmark is small.
    """
    terms = windows.select("window", F.explode(F.array_distinct("words")).alias("word"))
    held = index.where("word is not null").select("segment", "word", "n")
    asked = materialize(terms.select("word").distinct(), "words")
    counts = materialize(held.join(asked, "word", "left_semi").groupBy("word").agg(F.sum("n").alias("n")), "counts")
    rarest = (
        terms.join(counts, "word", "left")
        .groupBy("window")
        .agg(F.min(F.struct("n", "word"))["word"].alias("word"), F.bool_and(F.col("n").isNotNull()).alias("_whole"))
        .where("_whole")
        .select("window", "word")
    )
    led = held.select("segment", "word").join(materialize(rarest, "rarest"), "word").select("segment", "window")
    return materialize(led, "candidates"), counts.select("word")


# ---- the search


def search(index: DataFrame, benchmark: DataFrame, width: int = WINDOW, slop: int | None = None, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, runs, items, near) of the documents of ``index`` with a match; see ``find_benchmark``."""
    made = materialize(test_windows(benchmark, width, item_id, item_text), "windows")
    windows = materialize(made.select("words").distinct().select(F.monotonically_increasing_id().alias("window"), "words"), "different-windows")
    named = made.join(windows, "words").select("window", "item")
    led, terms = _candidates(index, windows)

    segments = materialize(led.select("segment").distinct(), "segments")
    wanted = index.join(segments, "segment", "left_semi")
    lists = wanted.where("word is not null").join(terms, "word", "left_semi")
    columns = ["segment", "docs", "word", "places"]
    postings = wanted.where("word is null").select(*columns).unionByName(lists.select(*columns))
    none = {"window": F.lit(None).cast("long"), "words": F.lit(None).cast("array<binary>")}
    tested = led.join(windows, "window").select("segment", "window", "words")
    stream = postings.withColumns(none).unionByName(tested, allowMissingColumns=True)
    # Within a segment postings come before windows.
    sorted_stream = spread(stream, "segment").sortWithinPartitions("segment", F.col("window").isNotNull())
    shape = "key long, window long, exact boolean, runs array<struct<begin: long, end: long>>"
    matches = materialize(sorted_stream.mapInArrow(_matcher(slop), shape), "matches")

    runs = matches.where("window is null").select("key", "runs")
    exact = F.collect_set(F.when(F.col("exact"), F.col("item")))
    items = matches.join(named, "window").groupBy("key").agg(
        F.array_sort(exact).alias("items"), F.array_sort(F.collect_set("item")).alias("near")
    )
    near = F.col("near") if slop is not None else F.expr("cast(array() as array<long>)")
    return items.join(runs, "key", "left").select("key", _or_empty("runs", runs), "items", near.alias("near"))


def _or_empty(name: str, like: DataFrame):
    kind = like.schema[name].dataType.simpleString()
    return F.coalesce(F.col(name), F.expr(f"cast(array() as {kind})")).alias(name)


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    *columns: str,
    width: int = WINDOW,
    slop: int | None = None,
    item_id: str = "item_id",
    item_text: str = "text",
    segment_bytes: int = SEGMENT_BYTES,
) -> DataFrame:
    """Each document with its words counted, the hit ``runs``, the ``items`` whose windows occur
    in it, and, where a ``slop`` is given, the items ``near``: those with a proximity match, exact
    ones included.

    ``columns`` of ``docs`` are carried along.
    """
    rows = documents(docs, *columns)
    keyed = with_positions(rows)
    index = build_index(keyed, "_position", segment_bytes)
    found = search(index, benchmark, width, slop, item_id, item_text)
    found = found.select(F.col("key").alias("_position"), *(F.col(n).alias(f"_{n}") for n in ("runs", "items", "near")))
    sizes = index.where("word is null").select(F.inline("docs")).select(F.col("key").alias("_position"), F.col("n_words").cast("long").alias("_n_words"))
    answered = keyed.join(sizes, "_position").join(found, "_position", "left")
    filled = [_or_empty(f"_{n}", found).alias(n) for n in ("runs", "items", "near")]
    return answered.select(*rows.columns, F.col("_n_words").alias("n_words"), *filled)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """``docs`` without the rows in which a window of ``benchmark`` occurs."""
    # The row goes along as one column, so that no name of its can clash.
    whole = docs.select(F.struct(*docs.columns).alias("_row"), *(F.col(c) for c in ("doc_id", "text")))
    keyed = with_positions(whole.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.coalesce("text", F.lit(""))}))
    hit = search(build_index(keyed, "_position"), benchmark, width).select(F.col("key").alias("_position"))
    return keyed.select("_position", "_row").join(hit, "_position", "left_anti").select("_row.*")


class Segment:
    """The postings of a segment that windows ask for, and what has been found in it."""

    def __init__(self) -> None:
        self.parts: list[pa.RecordBatch] = []
        self.sealed = False

    def seal(self) -> None:
        """Put the lists one after the other."""
        rows, self.parts, self.sealed = pa.Table.from_batches(self.parts).combine_chunks(), [], True
        docs = rows.column("docs").drop_null().combine_chunks().flatten()
        self.keys, self.n_words = docs.field("key").to_numpy(), docs.field("n_words").to_numpy().astype(np.int64)
        self.ends = np.cumsum(self.n_words)
        self.firsts = self.ends - self.n_words
        self.size = int(self.ends[-1])
        lists = rows.filter(pc.is_valid(rows.column("word")))
        self.words = lists.column("word").combine_chunks()
        packed = [np.frombuffer(p, "<i4") for p in lists.column("places").to_pylist()]
        self.counts = np.fromiter(map(len, packed), np.int64, len(packed))
        self.lists = np.cumsum(self.counts) - self.counts
        self.places = np.concatenate([*packed, np.empty(0, "<i4")]).astype(np.int64)
        # (word, place) in one ascending number, for intersections.
        self.postings = np.repeat(np.arange(len(packed)) * (self.size + 1), self.counts) + self.places
        self.hits = np.zeros(self.size + 1, np.int32)

    def holds(self, code: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether a word stands at a place from ``low`` to ``high``."""
        key = code * (self.size + 1)
        return np.searchsorted(self.postings, key + low) < np.searchsorted(self.postings, key + high, "right")

    def search(self, rows: pa.RecordBatch, slop: int | None) -> Iterator[pa.RecordBatch]:
        """Matches (document, window) of a batch of windows."""
        listed = rows.column("words")
        sizes = pc.list_value_length(listed).to_numpy(zero_copy_only=False).astype(np.int64)
        width = int(sizes.max())
        inside = np.arange(width) < sizes[:, None]
        known = np.full(inside.shape, -1, np.int64)
        codes = pc.index_in(listed.flatten(), value_set=self.words)
        known[inside] = pc.fill_null(codes, -1).to_numpy(zero_copy_only=False)
        name = rows.column("window").to_numpy()
        whole = ((known >= 0) | ~inside).all(axis=1)
        name, known, sizes, inside = name[whole], known[whole], sizes[whole], inside[whole]
        if not len(name):
            return
        rarity = np.where(inside, self.counts[known], np.iinfo(np.int64).max)
        order = np.argsort(rarity, axis=1, kind="stable")
        work = np.cumsum(rarity[np.arange(len(name)), order[:, 0]] * (2 * (slop or 0) + 1))
        begin = 0
        while begin < len(name):
            done = work[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(work, done + CANDIDATES, "right")))
            part = slice(begin, end)
            at, start = self.intersect(known[part], order[part], sizes[part], 0)
            size = sizes[part][at]
            np.add.at(self.hits, start, 1)
            np.add.at(self.hits, start + size, -1)
            pairs = np.unique(np.stack([self.document(start), at]), axis=1)
            exact = np.ones(pairs.shape[1], bool)
            if slop:
                at, start = self.intersect(known[part], order[part], sizes[part], slop)
                near = np.unique(np.stack([self.document(start), at]), axis=1)
                exact = _member(near, pairs, end - begin)
                pairs = near
            yield _found(self.keys[pairs[0]], name[part][pairs[1]], exact)
            begin = end

    def document(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, place, "right")

    def intersect(self, known: np.ndarray, order: np.ndarray, sizes: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``known``, place of the window's start) where all its words stand."""
        lead = order[:, 0]
        code = known[np.arange(len(known)), lead]
        n = self.counts[code]
        start = self.places[ragged(self.lists[code], n)] - np.repeat(lead, n)
        at = np.repeat(np.arange(len(known)), n)
        if slop:
            start = np.add.outer(np.arange(-slop, slop + 1), start).ravel()
            at = np.tile(at, 2 * slop + 1)
        fits = (start >= 0) & (start + sizes[at] <= self.size)
        start, at = start[fits], at[fits]
        doc = self.document(start)
        one = start + sizes[at] <= self.ends[doc]
        start, at, doc = start[one], at[one], doc[one]
        # A shifted start may lie in another document than the leading word it comes from.
        for depth in range(0 if slop else 1, known.shape[1]):
            offset = order[at, depth]
            place = start + offset
            low, high = np.maximum(place - slop, self.firsts[doc]), np.minimum(place + slop, self.ends[doc] - 1)
            keep = (depth >= sizes[at]) | self.holds(known[at, offset], low, high)
            start, at, doc = start[keep], at[keep], doc[keep]
        return at, start

    def runs(self) -> Iterator[pa.RecordBatch]:
        """The hit words of each document, as maximal runs."""
        covered = np.cumsum(self.hits[:-1]) > 0
        if not covered.any():
            return
        # A run ends with its document.
        change = np.flatnonzero(covered[1:] != covered[:-1]) + 1
        cuts = np.unique(np.concatenate([[0], change, self.firsts[self.firsts < self.size]]))
        begins = cuts[covered[cuts]]
        ends = np.append(cuts, self.size)[1:][covered[cuts]]
        doc = self.document(begins)
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        base = self.firsts[doc]
        spans = pa.StructArray.from_arrays([pa.array(begins - base), pa.array(ends - base)], ["begin", "end"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(doc)), pa.int32()), spans).cast(_RUNS)
        yield _found(self.keys[doc[first]], None, None, lists)


def _member(pairs: np.ndarray, others: np.ndarray, n: int) -> np.ndarray:
    return np.isin(pairs[0] * n + pairs[1], others[0] * n + others[1])


def _found(keys: np.ndarray, window: np.ndarray | None, exact: np.ndarray | None, runs: pa.Array | None = None) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.bool_(), _RUNS]
    given = [keys, window, exact, runs]
    made = [pa.nulls(len(keys), t) if a is None else pa.array(a, t) if isinstance(a, np.ndarray) else a for a, t in zip(given, types, strict=True)]
    return pa.RecordBatch.from_arrays(made, names=["key", "window", "exact", "runs"])


def _matcher(slop: int | None) -> Callable:
    def run(batches) -> Iterator[pa.RecordBatch]:
        current, segment = Segment(), None
        for batch in batches:
            names = batch.column("segment").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(names)) + 1).tolist(), len(names)]
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                if begin == end:
                    continue
                if names[begin] != segment:
                    if current.sealed:
                        yield from current.runs()
                    current, segment = Segment(), names[begin]
                part = batch.slice(begin, end - begin)
                n = part.column("window").null_count
                if n:
                    current.parts.append(part.slice(0, n))
                if n < part.num_rows:
                    if not current.sealed:
                        current.seal()
                    yield from current.search(part.slice(n), slop)
        if current.sealed:
            yield from current.runs()

    return run
