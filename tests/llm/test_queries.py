"""The registered queries and the pipeline on the smallest generated tables."""

import hashlib
import os
import re
import zlib

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

import corpus_pipeline
from clonarium.llm import line_crf, queries
from clonarium.llm.bpe import Encoder
from clonarium.llm.common import materialize
from tests.llm.test_dedup import label, plain_fingerprint, plain_removal
from tests.llm.test_runs_and_rules import SPACE, plain_best, plain_collapse, plain_runs
from tests.llm.test_texts import plain_hits, plain_spans

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no generated tables")


def given(name):
    return pq.read_table(f"{SF_DIR}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def found(spark):
    """Results by query, each run once."""
    kept = {}

    def run(name):
        if name not in kept:
            kept[name] = [r.asDict() for r in queries.QUERIES[name](spark, SF_DIR).collect()]
        return kept[name]

    return run


@pytest.fixture(scope="module")
def docs():
    return sorted(given("documents"), key=lambda r: r["doc_id"])


def by_id(rows):
    return sorted(rows, key=lambda r: r["doc_id"])


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_agree_with_sql(found, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in result.description]
    wanted = [dict(zip(columns, r, strict=True)) for r in result.fetchall()]
    rows = found(name)
    assert sorted(rows[0]) == sorted(columns)
    assert sorted(map(str, ([r[c] for c in sorted(r)] for r in rows))) == sorted(map(str, ([r[c] for c in sorted(r)] for r in wanted)))


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))


def test_token_queries(found, docs):
    library = Encoder(queries.VOCABULARY).library
    ids = {d["doc_id"]: library.encode(d["text"] or "", add_special_tokens=False).ids for d in docs}
    for row in found("op3_token_counts"):
        assert row["n_tokens"] == len(ids[row["doc_id"]])
        assert row["over_limit"] == (row["n_tokens"] > 512)
    start = 0
    for row in by_id(found("op9_token_files")):
        whole = [*ids[row["doc_id"]], 2]
        assert (row["start"], row["n_tokens"]) == (start, len(whole))
        assert row["ids_crc32"] == zlib.crc32(np.array(whole, "<u4").tobytes())
        start += len(whole)
    check_packing(found("op10_packing"), ids)


def check_packing(rows, ids):
    taken, sequences = {}, {}
    for row in rows:
        piece = [*ids[row["doc_id"]], 0][row["start"] : row["start"] + row["length"]]
        assert row["ids_crc32"] == zlib.crc32(np.array(piece, "<u4").tobytes())
        assert row["doc_tokens"] == len(ids[row["doc_id"]]) + 1
        taken.setdefault(row["doc_id"], []).append((row["start"], row["length"]))
        sequences.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for doc, tokens in ids.items():
        ends = 0
        for start, length in sorted(taken[doc]):
            assert start == ends
            ends += length
        assert ends == len(tokens) + 1
    used = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
        used += at
    assert used >= 0.98 * 1024 * len(sequences)


def test_quality_query(found, docs):
    labels = {r["doc_id"]: r["quality"] for r in given("labels")}
    rows = found("op5_line_crf")
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    hidden = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in hidden]) >= 0.9


def test_simhash_query(found, docs):
    rows = by_id(found("op7_simhash_dedup"))
    marks = [plain_fingerprint(d["text"]) for d in docs]
    assert [r["fingerprint"] for r in rows] == [f"{m:016x}" for m in marks]
    wanted = label(len(docs), lambda a, b: (marks[a] ^ marks[b]).bit_count() <= 3)
    assert [r["component_id"] for r in rows] == [docs[w]["doc_id"] for w in wanted]


def test_suffix_query(found, docs):
    wanted = [(n, s, g, hashlib.sha256(k).hexdigest()) for n, s, g, k in plain_removal([d["text"] for d in docs])]
    rows = by_id(found("op8_suffix_dedup"))
    assert [(r["n_bytes"], r["n_spans"], r["n_removed"], r["kept_sha256"]) for r in rows] == wanted


def test_periodic_runs_query(found, docs):
    for row, doc in zip(by_id(found("op12_periodic_runs")), docs, strict=True):
        words = re.findall(SPACE, doc["text"] or "")
        n, mark = len(words), zlib.crc32(str(doc["doc_id"]).encode())
        if mark % 10 == 0 and n:
            a, p = mark // 10 % n, 1 + (n - mark // 10 % n) // (3 + mark // 10 % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = plain_runs(words)
        best = plain_best(runs)
        assert (row["n_words"], row["n_runs"]) == (n, len(runs))
        assert (row["start"], row["length"], row["period"]) == (best or (None,) * 3)
        assert row["exponent_milli"] == (best and 1000 * best[1] // best[2])
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        assert row["runs_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(plain_collapse(words, runs).encode()).hexdigest()


def test_pipeline_against_brute_force(spark, docs):
    model = queries.quality_model(spark, SF_DIR)
    library = Encoder(queries.VOCABULARY).library
    scores = model.score([d["text"] or "" for d in docs])[0]
    kept = [d for d, s in zip(docs, scores, strict=True) if s >= corpus_pipeline.MIN_QUALITY]
    marks = [plain_fingerprint(d["text"]) for d in kept]
    names = label(len(kept), lambda a, b: (marks[a] ^ marks[b]).bit_count() <= 3)
    kept = [d for i, d in enumerate(kept) if names[i] == i]
    hits = plain_hits([d["text"] for d in kept], [(r["item_id"], r["text"]) for r in given("benchmark")], 10)
    kept = [d for d, (_, n, _) in zip(kept, hits, strict=True) if not n]
    assert 0 < len(kept) < len(docs)

    frame = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = frame.dtypes
        frame = materialize(stage(spark, frame, SF_DIR), name.replace(" ", "-"))
        assert frame.dtypes == columns
    left = {r.doc_id: r for r in frame.collect()}
    assert sorted(left) == [d["doc_id"] for d in kept]
    for d in kept:
        row, text = left[d["doc_id"]], d["text"]
        if not plain_spans(text):
            assert row.text == text and row.n_chars == d["n_chars"]
        else:
            assert not plain_spans(row.text) and row.n_chars == len(row.text)
    rows = [r.asDict() for r in corpus_pipeline.run(spark, SF_DIR).collect()]
    check_packing(rows, {i: library.encode(r.text or "", add_special_tokens=False).ids for i, r in left.items()})


def test_pipeline_stages_take_odd_rows(spark, twice, no_docs):
    odd = twice.selectExpr("*", "1 AS _text", "2 AS score", "3 AS runs", "4 AS _pii", "5 AS _position", "6 AS _row", "7 AS bits")
    empty = no_docs.selectExpr("*", "1 AS _text", "2 AS score", "3 AS runs", "4 AS _pii", "5 AS _position", "6 AS _row", "7 AS bits")
    for name, stage in corpus_pipeline.STAGES:
        for rows in (odd, empty):
            out = stage(spark, rows, SF_DIR)
            assert name == "packing" or out.columns == rows.columns
            found = out.collect()
            assert bool(found) == (rows is odd) or name == "quality classifier"
    pii_stage = dict(corpus_pipeline.STAGES)["pii"](spark, odd, SF_DIR).collect()
    assert sorted(map(str, pii_stage)) == sorted(map(str, odd.collect()))  # nothing personal: rows as they were


def test_xxhash_is_the_engines(spark):
    text = "One two  three"
    from pyspark.sql import functions as F

    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % 2**64 == xxhash.xxh64_intdigest(text.encode(), 42)


def test_model_is_kept_small():
    assert line_crf.TRAIN_DOCS * 2 <= 10_000
