"""Runs of words that repeat periodically, and texts without the repeats (operator 12).

A run is a stretch of consecutive words whose smallest period is q, at least ``max(LEAST, TIMES * q)``
words long, that no neighbouring word extends keeping the period. It shows as a diagonal: every word
of it, after the first q, equals the word q places before. The online dynamic programme walks over
the words and counts, for the active lag, how many words in a row matched; a diagonal that ends
long enough is a run and is emitted there and then.

The diagonals are kept sparse in two ways that lose no run:

* A word's earlier occurrence counts only if the ``k - 1`` words after each agree as well. k is a
  power of two, and period q is looked for with the k that is at least q (16 at least) and less than
  2q above 16; every run matches over k words somewhere, since ``LEAST`` and ``TIMES`` leave at
  least ``max(LEAST - q, 2 * q)`` matches on its diagonal.
* Of these occurrences only the nearest counts. Were one nearer than q, the stretch between would
  have a period that divides q (theorem of Fine and Wilf), and q would not be the smallest.

So a place has one active lag for each k, a diagonal that is long enough is a whole run with its
smallest period, and n words cost O(n log n) time for each of at most log2(n) values of k, however
often a word or a phrase occurs. Windows are named exactly, not by hashes.

A task takes one text at a time and holds about 150 bytes a word of it. A null text has no words. A
null id is a row like any other, repeated rows get a result each, and other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clonarium.llm.common import documents
from clonarium.llm.words import doubled, may_repeat, numbered, window_names, words_of

LEAST, TIMES = 24, 3
# The shortest window: on no diagonal of a run are there fewer matches, least at period 8.
_WINDOW = 16
# A batch of results is sent on when its texts reach this size.
_FLUSH_BYTES = 16 << 20

RUNS_SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


def active_lags(names: np.ndarray) -> np.ndarray:
    """For each window the distance back to the nearest equal one, 0 where there is none."""
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    lags = np.zeros(len(names), np.int64)
    lags[order[1:][same]] = (order[1:] - order[:-1])[same]
    return lags


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of numbers, by start, then period."""
    n = len(ids)
    if n < LEAST or not may_repeat(ids, _WINDOW):
        return []
    found, names, shortest, width = [], window_names(ids, _WINDOW), 1, _WINDOW
    while True:
        lags = active_lags(names)
        if not lags.any():
            break  # and no longer window occurs twice
        # Neighbouring places of one lag are one diagonal.
        begin = np.flatnonzero(np.append(True, lags[1:] != lags[:-1]))
        end = np.append(begin[1:], len(lags))
        period = lags[begin]
        length = period + (end - begin) + width - 1
        whole = (period >= shortest) & (period <= width) & (length >= np.maximum(LEAST, TIMES * period))
        found += zip((begin - period)[whole].tolist(), length[whole].tolist(), period[whole].tolist(), strict=True)
        shortest = width + 1
        if TIMES * shortest > n:
            break
        names, width = doubled(names, width), 2 * width
    return sorted(found, key=lambda run: (run[0], run[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each word stays: not so if a run contains it after its first period."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:-1]) == 0


def periodic_runs(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """``doc_id``, ``n_words``, the ``runs``, and the ``collapsed`` text of all documents.

    ``collapsed`` holds the words that stay, joined by a space. ``rewrite`` may change the words of
    a document, given its id, before runs are looked for.
    """

    def emit(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = words_of(text.as_py())
                words = rewrite(doc, words) if rewrite else words
                runs = runs_of(numbered(words))
                kept = compress(words, kept_words(len(words), runs).tolist()) if runs else words
                collapsed = b" ".join(kept).decode("utf-8", "surrogatepass")
                rows.append((doc, len(words), runs, collapsed))
                size += len(collapsed)
                if size >= _FLUSH_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)

    return documents(docs).mapInArrow(emit, RUNS_SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    doc, n_words, runs, collapsed = zip(*rows, strict=True)
    listed = [[{"start": s, "length": n, "period": p} for s, n, p in found] for found in runs]
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(n_words, pa.int64()), pa.array(listed, _RUNS), pa.array(collapsed, pa.string())],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def strongest(runs: Column) -> Column:
    """The run of greatest length to period, exactly; of equal ones the first by start, then period."""
    return F.aggregate(
        runs,
        F.get(runs, F.lit(0)),
        lambda best, run: F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best),
    )
