"""Quality rules judged by document and by host (operator 13).

1. Each whole text is counted once: words, their code points, symbols, lines, repeated lines, and
   words in repeated windows of ``WINDOW`` words. The counts are written, some 80 bytes a document.
2. ``RULES`` turn the counts into failures. They are summed by host; the sums are combined map
   side, so a host of any size is a row for each task.
3. For each rule the hosts' failure rates have a beta prior, fitted to them by moments: the mean is
   that of all documents, the strength follows from how much more the rates vary than chance alone
   would make them. A host's rate is shrunk towards the mean: with few documents it says little.
   Where rates vary no more than by chance, every host has the mean.
4. A host of which more than ``HOST_LIMIT`` of the documents must be expected to fail a rule is
   rejected. The rejected hosts are joined back to the documents.

A document is kept if it passes the base rules and its host is not rejected. A null text has no
words and so fails; a null host counts as no host and is never rejected. Repeated rows count and
are judged one by one. Without documents there is no result. Other columns are ignored.

A task takes one text at a time and holds about 120 bytes a word of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clonarium.llm.common import documents, materialize
from clonarium.llm.words import may_repeat, numbered, window_names, words_of

WINDOW = 8
MIN_WORDS, MAX_REPEATED = 20, 0.30
HOST_LIMIT = 0.5
_SPACES, _SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"

_COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
COUNT_SCHEMA = "doc_id long, host string, " + ", ".join(f"{c} long" for c in _COUNTS)

# What fails each rule; the first two are the base rules.
RULES = {
    "short": f"n_words < {MIN_WORDS}",
    "repeated_windows": f"100 * n_repeat_words > {round(100 * MAX_REPEATED)} * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "word_chars < 3 * n_words or word_chars > 10 * n_words",
}
BASE_RULES = ("short", "repeated_windows")


def repeated_words(ids: np.ndarray) -> int:
    """Words covered by windows of WINDOW words that occur twice or more, their first place included."""
    if len(ids) <= WINDOW or not may_repeat(ids, WINDOW):
        return 0
    names = window_names(ids, WINDOW)
    often = np.bincount(names)[names] > 1
    edges = np.zeros(len(ids) + 1, np.int64)
    edges[: len(often)] += often
    edges[WINDOW:] -= often
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def counts_of(text: str) -> tuple[int, ...]:
    """The counts of one text, in the order of ``_COUNTS``."""
    words = words_of(text)
    lines = [line for line in text.split("\n") if line.strip(_SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, _SPACES)),
        sum(map(text.count, _SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(numbered(words)),
    )


def document_counts(docs: DataFrame, host_col: str = "source") -> DataFrame:
    """Step 1: ``doc_id``, ``host`` and the counts of every document."""

    def emit(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counts_of(text.as_py()) for text in batch.column("text")]
            columns = np.array(found, np.int64).reshape(-1, len(_COUNTS)).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("host"), *(pa.array(c) for c in columns)],
                names=["doc_id", "host", *_COUNTS],
            )

    given = documents(docs, F.col(host_col).cast("string").alias("host"))
    return given.mapInArrow(emit, COUNT_SCHEMA)


def host_failures(counted: DataFrame) -> DataFrame:
    """Step 2: ``host``, its documents ``n``, and how many of them fail each rule."""
    fails = [F.sum(F.expr(rule).cast("long")).alias(name) for name, rule in RULES.items()]
    return counted.where("host is not null").groupBy("host").agg(F.count(F.lit(1)).alias("n"), *fails)


def fit_prior(hosts: DataFrame, rule: str) -> tuple[Column, Column]:
    """Mean and strength, in documents, of the beta prior of a rule's rates, as aggregates over hosts.

    The rates' variance about the mean, less what documents drawn by chance add, is the prior's; a
    null strength stands for a variance of zero.
    """
    fails, n, total = F.col(rule).cast("double"), F.col("n").cast("double"), F.sum("n").cast("double")
    mean = F.sum(fails) / total
    chance = mean * (1 - mean)
    between = F.sum(fails * fails / n) / total - mean * mean - chance * F.count(F.lit(1)) / total
    return mean, F.when(between > 0, chance / between - 1)


def host_rates(hosts: DataFrame) -> DataFrame:
    """Step 3: ``hosts`` with the shrunk rate of each rule as ``<rule>_rate``."""
    fitted = {rule: fit_prior(hosts, rule) for rule in RULES}
    prior = hosts.agg(*(c.alias(f"{r}_{p}") for r, pair in fitted.items() for c, p in zip(pair, ("mean", "strength"), strict=True)))
    values = prior.first().asDict()  # one row

    def rate(rule: str) -> Column:
        mean, strength = values[f"{rule}_mean"], values[f"{rule}_strength"]
        if strength is None:
            return F.lit(mean).cast("double")
        return (F.col(rule) + mean * strength) / (F.col("n") + strength)

    return hosts.select("host", "n", *RULES, *(rate(rule).alias(f"{rule}_rate") for rule in RULES))


def rejected_hosts(rates: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """Step 4: the ``host`` values with a rate above ``limit``."""
    return rates.where(F.greatest(*(F.col(f"{rule}_rate") for rule in RULES)) > limit).select("host")


def judge(docs: DataFrame, host_col: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """The counts of all documents, ``base_failed``, ``host_rejected`` and ``kept``."""
    counted = materialize(document_counts(docs, host_col), "rule-counts")
    hosts = materialize(host_failures(counted), "host-failures")
    rejected = materialize(rejected_hosts(host_rates(hosts), limit), "rejected-hosts")
    # The planner knows the written table's size: few hosts are broadcast, many are shuffled, and
    # a host that fills a partition is split there.
    joined = counted.join(rejected.withColumn("host_rejected", F.lit(True)), "host", "left")
    failed = F.expr(" or ".join(f"({RULES[r]})" for r in BASE_RULES))
    judged = joined.withColumn("base_failed", failed).withColumn("host_rejected", F.coalesce("host_rejected", F.lit(False)))
    return judged.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
