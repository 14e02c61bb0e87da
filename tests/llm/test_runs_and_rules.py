"""Periodic runs and quality rules against plain counterparts."""

import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from clonarium.llm import host_rules, periodic_runs

SPACE = r"[^\x20\x09-\x0D]+"


def plain_runs(words):
    """Every stretch under every lag, kept if no smaller lag explains it."""
    known = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    found = []
    for p in range(1, len(ids) // 3 + 1):
        same = np.concatenate([[False], ids[p:] == ids[:-p], [False]])
        edges = np.flatnonzero(np.diff(same))
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            length = end - begin + p
            stretch = ids[begin : begin + length]
            if length >= max(24, 3 * p) and not any((stretch[q:] == stretch[:-q]).all() for q in range(1, p)):
                found.append((begin, length, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def plain_best(runs):
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else None


def periodic_texts():
    drawn = random.Random(21)
    texts = ["", " ", "a", "a " * 23, "a " * 24, "a b " * 12, "x " + "a b c d e f g h " * 3, "a b c d e f g h i " * 3]
    texts += ["a b c d e f g h i " * 2 + "a b c d e f g h", "a b " * 30, "\x0b".join("ab" * 40), "x y " * 20 + "z " + "x y " * 20]
    for alphabet in (1, 2, 3, 5):
        for _ in range(60):
            parts = []
            for _ in range(drawn.randrange(1, 5)):
                unit = [drawn.choice("abcdefgh"[:alphabet]) for _ in range(drawn.randrange(1, 40))]
                parts += unit * drawn.choice([1, 1, 2, 3, 4, 9]) + unit[: drawn.randrange(len(unit))]
            texts.append(" ".join(parts))
    fib = ["a", "b"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    return [*texts, " ".join(fib[-1] * 3), " ".join(map(str, range(40))) + " end " + " ".join(map(str, range(40))) * 5]


def test_runs_against_every_lag():
    from clonarium.llm.words import numbered, words_of

    for text in periodic_texts():
        words = re.findall(SPACE, text)
        assert [w.decode() for w in words_of(text)] == words
        assert periodic_runs.runs_of(numbered(words_of(text))) == plain_runs(words), text


def test_runs_of_documents(spark):
    texts = periodic_texts()[:80]
    rows = [(i, t, 0) for i, t in enumerate(texts)] + [(None, "a " * 30, 0), (7, None, 0), (7, texts[7], 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, runs int").repartition(3)
    found = periodic_runs.periodic_runs(frame).withColumn("best", periodic_runs.strongest("runs")).collect()
    wanted = []
    for doc, text, _ in rows:
        words = re.findall(SPACE, text or "")
        runs = plain_runs(words)
        wanted.append((doc, len(words), runs, plain_collapse(words, runs), plain_best(runs)))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed, tuple(r.best) if r.best else None) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, wanted))
    assert periodic_runs.periodic_runs(frame.where("doc_id > 1000")).collect() == []


def test_long_text_of_few_words(spark):
    n = 600_000
    frame = spark.createDataFrame([(1, "go on " * (n // 2)), (2, " ".join(map(str, range(n))))], "doc_id long, text string")
    one, two = periodic_runs.periodic_runs(frame).orderBy("doc_id").collect()
    assert [tuple(r) for r in one.runs] == [(0, n, 2)] and one.collapsed == "go on"
    assert two.runs == [] and two.n_words == n


def plain_counts(text):
    words = re.findall(SPACE, text)
    lines = [line for line in text.split("\n") if re.search(SPACE, line)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)}
    n_dup = sum(line in lines[:i] for i, line in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines), n_dup, len(hit)


def test_counts_of_texts(texts):
    for text in [*texts[:-2], "ab " * 300, *periodic_texts()[:60], "one\ntwo\none\n \n \n \n \n#*$%&|<>"]:
        assert host_rules.counts_of(text) == plain_counts(text), text


def plain_rates(hosts, rule):
    """{host: shrunk rate}, ``hosts`` being {host: (n, {rule: failures})}."""
    total = sum(n for n, _ in hosts.values())
    mean = sum(f[rule] for _, f in hosts.values()) / total
    spread = sum(n * (f[rule] / n - mean) ** 2 for n, f in hosts.values()) / total
    between = spread - mean * (1 - mean) * len(hosts) / total
    if between <= 1e-12:
        return dict.fromkeys(hosts, mean)
    strength = mean * (1 - mean) / between - 1
    return {h: (f[rule] + mean * strength) / (n + strength) for h, (n, f) in hosts.items()}


def test_hosts_that_mostly_fail_are_rejected(spark):
    drawn = random.Random(4)
    good = [" ".join(drawn.choice(["plain", "words", "of", "some", "text"]) + str(drawn.randrange(99)) for _ in range(40)) for _ in range(120)]
    # Failures of 0 to 10 in 20 pages by host, and of 25 in 40.
    rows = [(i, "too short" if i // 6 < i % 6 * 2 else t, f"host{i % 6}") for i, t in enumerate(good)]
    rows += [(200 + i, "too short" if i < 25 else good[i], "mill") for i in range(40)]
    rows += [(400, "one short page", "small"), (500, good[2], None), (501, "short", None), (502, None, "host1"), (503, None, None)]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, source string, n_words int").repartition(4)
    found = {r.doc_id: r for r in host_rules.judge(frame).collect()}
    assert len(found) == len(rows)
    for doc, text, host in rows:
        r = found[doc]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words) == plain_counts(text or "")
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        # One failure of one page says too little; most failures of many pages say enough.
        assert r.host_rejected == (host == "mill")
        assert r.kept == (not r.base_failed and host != "mill")
    counted = host_rules.document_counts(frame)
    rates = {r.host: r for r in host_rules.host_rates(host_rules.host_failures(counted)).collect()}
    hosts = {h: (r.n, {rule: r[rule] for rule in host_rules.RULES}) for h, r in rates.items()}
    for rule in host_rules.RULES:
        for host, rate in plain_rates(hosts, rule).items():
            assert rates[host][f"{rule}_rate"] == pytest.approx(rate)


def test_rules_without_hosts_or_documents(spark, no_docs, twice):
    assert host_rules.judge(no_docs).collect() == []
    nobody = host_rules.judge(twice.selectExpr("doc_id", "text", "cast(null as string) source")).collect()
    assert len(nobody) == 6 and not any(r.host_rejected for r in nobody)
    one = host_rules.judge(twice).collect()  # half of a single host's documents fail either rule: not most
    assert len(one) == 6 and not any(r.host_rejected or r.kept for r in one)
