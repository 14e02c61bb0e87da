"""Operators 2, 7 and 8 against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from clonarium.llm import embedding_dedup, simhash_dedup, suffix_dedup
from clonarium.llm.components import components


def label(n, linked):
    """The least reachable number of each of n nodes."""
    found = list(range(n))
    for i in range(n):
        waiting = [i]
        while waiting:
            one = waiting.pop()
            for other in range(n):
                if linked(one, other) and found[other] > found[i]:
                    found[other] = found[i]
                    waiting.append(other)
    return found


# ---- components


def test_components_of_chains_stars_and_pairs(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    links = spark.createDataFrame([*chain, *star, (9, 3), (3, 9), (4, 4)], "a long, b long")
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, **{i: 500 for i in range(500, 560)}, 9: 3, 3: 3}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# ---- embeddings


def vectors(seed=1, n=150, size=24):
    drawn = np.random.default_rng(seed)
    base = drawn.standard_normal((n, size))
    near = np.concatenate([base[:40] + 0.1 * s * drawn.standard_normal((40, size)) for s in (0.5, 1.5, 3.0)])
    hub = base[0] + 0.02 * drawn.standard_normal((60, size))
    return np.concatenate([base, near, hub, base[:10], 3 * base[10:20], -base[20:25]])


def brute_force(x, cosine=0.95):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = unit @ unit.T >= cosine
    np.fill_diagonal(linked, False)
    return linked.sum(axis=1), label(len(x), lambda a, b: linked[a, b])


@pytest.mark.parametrize("block_rows", [2048, 16])
def test_embedding_links(spark, monkeypatch, block_rows):
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", block_rows)
    x = vectors()
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(x)]
    found = sorted(embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect())
    n, component = brute_force(x)
    got = np.array([r.n_links for r in found])
    assert (got <= n).all()  # no link below the threshold
    assert got.sum() >= 0.97 * n.sum()
    assert [r.component_id for r in found] == component
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
            (8, []), (9, [1.0]), (None, [1.0, 0.0]), (2, [1.0, 1e-9]), (10, [1e300, 0.0]), (11, [1e-300, 0.0])]
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in found), key=str)
    linked = [(1, 5, 1, True), (2, 5, 1, False), (2, 5, 1, False), (None, 5, 1, False), (10, 5, 1, False), (11, 5, 1, False)]
    assert got == sorted([*linked, *((i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9))], key=str)


def test_no_vectors(spark):
    for rows in ([], [(1, None)]):
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        assert [tuple(r) for r in embedding_dedup.near_duplicates(frame).collect()] == [(i, 0, i, True) for i, _ in rows]


def test_recall_follows_from_the_tables():
    for projections in (8, embedding_dedup.PROJECTIONS, 30):
        tables = embedding_dedup.table_count(projections)
        found = 1 - (1 - embedding_dedup.collision(0.1**0.5) ** projections) ** tables
        assert found >= embedding_dedup.RECALL


def test_links_do_not_depend_on_the_other_vectors(spark):
    """The hash functions are the same in a small and in a larger table, so are the links found."""
    x = vectors(seed=3, n=60)
    few = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    far = np.random.default_rng(9).standard_normal((400, x.shape[1]))
    more = few.union(spark.createDataFrame([(1000 + i, v.tolist()) for i, v in enumerate(far)], few.schema))
    options = {"projections": 20, "tables": 6}  # few enough to miss some
    found = [{r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(d, **options).collect()} for d in (few, more)]
    assert found[0] == {i: found[1][i] for i in range(len(x))}
    assert sum(n for n, _ in found[0].values()) < brute_force(x)[0].sum()


# ---- simhash


def plain_fingerprint(text):
    words = [w.lower() for w in (text or "").encode().split()]
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components(docs, texts):
    found = sorted(simhash_dedup.near_duplicates(docs).collect())
    marks = [plain_fingerprint(t) for t in [*texts, None]]
    assert [r.bits % 2**64 for r in found] == marks
    wanted = label(len(marks), lambda a, b: (marks[a] ^ marks[b]).bit_count() <= 3)
    assert [r.component_id for r in found] == wanted


@pytest.mark.parametrize("at_once", [2048, 3])
def test_all_fingerprints_within_three_bits_are_linked(spark, monkeypatch, at_once):
    monkeypatch.setattr(simhash_dedup, "_AT_ONCE", at_once)
    drawn = random.Random(8)
    marks = [drawn.getrandbits(64) for _ in range(60)]
    for mark in marks[:30]:
        for bits in range(1, 6):
            marks.append(mark ^ sum(1 << b for b in drawn.sample(range(64), bits)))
    marks = list(dict.fromkeys([*marks, 0, 2**64 - 1, 7, 15]))
    signed = [m - 2**64 if m >= 2**63 else m for m in marks]
    links = simhash_dedup.fingerprint_links(spark.createDataFrame([(s,) for s in signed], "bits long")).collect()
    place = {s: i for i, s in enumerate(signed)}
    joined = {frozenset((place[r.a], place[r.b])) for r in links}
    assert all((marks[a] ^ marks[b]).bit_count() <= 3 for a, b in map(tuple, joined))
    wanted = label(len(marks), lambda a, b: (marks[a] ^ marks[b]).bit_count() <= 3)
    assert label(len(marks), lambda a, b: frozenset((a, b)) in joined) == wanted


def test_manhattan_distance_is_a_lower_bound():
    drawn = np.random.default_rng(2)
    a, b = drawn.integers(0, 1 << 63, (2, 500), dtype=np.uint64)
    counts = [simhash_dedup.segment_counts(x).astype(int) for x in (a, b)]
    assert (np.abs(counts[0] - counts[1]).sum(axis=1) <= np.bitwise_count(a ^ b)).all()


def test_simhash_of_repeated_null_and_no_rows(twice, no_docs):
    found = simhash_dedup.near_duplicates(twice).collect()
    assert len(found) == 6
    assert {(r.doc_id, r.component_id) for r in found if r.bits == 0} == {(None, 3), (3, 3)}
    kept = simhash_dedup.drop_near_duplicates(twice).collect()
    assert len(kept) == len({r.bits for r in found})  # one row of each group, repeated rows included
    assert simhash_dedup.near_duplicates(no_docs).collect() == []
    assert simhash_dedup.drop_near_duplicates(no_docs).collect() == []


# ---- suffixes


def plain_removal(texts):
    seen, out = set(), []
    for text in texts:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 99):
            if (piece := raw[p : p + 100]) in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(piece)
        runs = [r for r in bytes(gone).split(b"\0") if r]
        out.append((len(raw), len(runs), sum(gone), bytes(c for c, g in zip(raw, gone, strict=True) if not g)))
    return out


def removed(frame, key=lambda r: r.doc_id):
    rows = sorted(suffix_dedup.remove_repeats(frame).collect(), key=key)
    return [(r.n_bytes, len(r.spans), sum(s.end - s.start for s in r.spans), bytes(r.kept)) for r in rows]


def test_suffix_dedup(docs, texts):
    assert removed(docs) == plain_removal([*texts, None])


def test_suffix_dedup_in_small_steps(docs, texts, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_STRETCH", 1000)
    monkeypatch.setattr(suffix_dedup, "_FLUSH_ROWS", 50)
    assert removed(docs) == plain_removal([*texts, None])


def test_suffix_dedup_of_a_gram_that_fills_several_buckets(spark, monkeypatch):
    """One line of fewer than 100 bytes in every document, with few and with many neighbours."""
    drawn = random.Random(6)
    line = "This very line, well known and often found, stands in each and every text of this table."
    sides = ["".join(drawn.choice("abcdef ") for _ in range(60)) for _ in range(6)]
    texts = [drawn.choice(sides) + line + drawn.choice(sides) + str(i) * 30 for i in range(300)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert removed(frame) == plain_removal(texts)
    # As if the sample had found nothing but these grams.
    grams = np.concatenate([suffix_dedup.sampled_suffixes(t.encode())[0].view(np.int64) for t in texts])
    values, counts = np.unique(grams, return_counts=True)
    hot = sorted(values[np.argsort(-counts)][:3].tolist())
    monkeypatch.setattr(suffix_dedup, "Splitters", lambda bounds, made=suffix_dedup.Splitters: made(hot))
    assert removed(frame) == plain_removal(texts)


def test_suffix_dedup_takes_crowded_grams_apart(spark, monkeypatch, docs, texts):
    monkeypatch.setattr(suffix_dedup, "CROWD", 3)
    assert removed(docs) == plain_removal([*texts, None])
    drawn = random.Random(8)
    lines = ["One line shorter than a span that many texts hold, no. %d." % i for i in range(2)] + ["A longer one, " * 9]
    crowd = ["".join(drawn.choice("abc ") for _ in range(drawn.randrange(3, 90))) + drawn.choice(lines) + drawn.choice("abc") * 40
             + str(i % 7) * 40 for i in range(200)]
    frame = spark.createDataFrame(list(enumerate(crowd)), "doc_id long, text string").repartition(3)
    assert removed(frame) == plain_removal(crowd)


def test_suffix_dedup_counts_buckets_by_bytes(spark, monkeypatch, texts, no_docs):
    """However the table came about, and whatever the planner thinks of its size."""
    rows = [(i, t) for i, t in enumerate(texts)]
    memory = spark.createDataFrame(rows, "doc_id long, text string")
    joined = memory.join(spark.createDataFrame([(i,) for i in range(len(rows))], "doc_id long"), "doc_id")
    size = sum(len(t.encode()) for t in texts)
    for frame in (memory, joined):
        assert suffix_dedup.text_size(frame) == (len(rows), size)
    assert suffix_dedup.text_size(no_docs) == (0, 0)
    assert suffix_dedup.bucket_count(spark, 0) == suffix_dedup.block_count(spark)
    assert suffix_dedup.bucket_count(spark, 10 << 30) == 160
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 5000)
    assert removed(joined) == plain_removal(texts)


def test_multikey_order():
    words = np.random.default_rng(3).integers(0, 3, (500, 5)).astype(np.uint64)
    order, tied = suffix_dedup.multikey_order(words)
    rows = [tuple(r) for r in words[order].tolist()]
    assert rows == sorted(rows)
    assert tied.tolist() == [False, *(a == b for a, b in zip(rows, rows[1:]))]


def test_suffix_dedup_of_repeated_null_and_no_rows(twice, no_docs):
    rows = sorted(suffix_dedup.remove_repeats(twice).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.n_bytes))
    same = "one two three four five six seven eight nine ten eleven twelve " * 3
    ordered = [None, same, None, "other words stand here, 12 of them", same, same]  # null id first, then 3, then 7
    wanted = plain_removal(ordered)
    assert [(r.n_bytes, bytes(r.kept)) for r in rows] == [(w[0], w[3]) for w in [wanted[i] for i in (0, 1, 2, 3, 4, 5)]]
    assert hashlib.sha256(bytes(rows[0].kept)).hexdigest() == hashlib.sha256(b"").hexdigest()
    assert suffix_dedup.remove_repeats(no_docs).collect() == []


def test_simhash_large_cells_are_cut(spark):
    import pyarrow as pa

    # A crowd 5-15 bits from one fingerprint, which fills cells without linking, and some close ones.
    drawn = random.Random(11)
    center = drawn.getrandbits(64)

    def off(bits):
        return center ^ sum(1 << b for b in drawn.sample(range(64), bits))

    bits = sorted({off(drawn.choice([1, 2, 5, 6, 7, 9, 15])) for _ in range(700)})
    frame = spark.createDataFrame([(b - (1 << 64) if b >> 63 else b,) for b in bits], "bits long")
    links = simhash_dedup.fingerprint_links(frame, together=20).collect()
    number = {b: i for i, b in enumerate(bits)}
    joined = {(number[a % 2**64], number[b % 2**64]) for a, b in ((r.a, r.b) for r in links)}
    assert all((bits[a] ^ bits[b]).bit_count() <= 3 for a, b in joined)
    joined |= {(b, a) for a, b in joined}
    assert label(len(bits), lambda a, b: (a, b) in joined) == label(len(bits), lambda a, b: (bits[a] ^ bits[b]).bit_count() <= 3)

    keys = np.repeat([1, 2, 3, 4, 5, 6], [1, 50, 2, 20, 21, 41])
    rows = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.arange(len(keys)))], names=["cell", "bits"])
    for size in (1, 7, 20, 1000):
        given = list(simhash_dedup._cell_groups((rows.slice(i, size) for i in range(0, len(keys), size)), 20))
        assert [(k, p, len(b)) for k, p, b in given] == [
            (2, 0, 20), (2, 1, 20), (2, 2, 10), (3, None, 2), (4, None, 20), (5, 0, 20), (5, 1, 1), (6, 0, 20), (6, 1, 20), (6, 2, 1),
        ]
        assert np.concatenate([b for _, _, b in given]).tolist() == list(range(1, len(keys)))
