"""Operators 3, 9 and 10 against the tokenizers library."""

import random
import zlib

import numpy as np
import pytest

from clonarium.llm import packing, token_counts, token_files
from clonarium.llm.bpe import Encoder, split_points
from clonarium.llm.common import scratch_path
from clonarium.llm.queries import VOCABULARY


@pytest.fixture(scope="module")
def library():
    return Encoder(VOCABULARY).library


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_pieces_are_the_librarys(library):
    drawn = random.Random(3)
    letters = " \t\n'srevlmdtT!9é　\xa0<|"
    for _ in range(1500):
        text = "".join(drawn.choice(letters) for _ in range(drawn.randrange(1, 25)))
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        wanted = [span[0] for _, span in library.pre_tokenizer.pre_tokenize_str(text)]
        assert split_points(points, np.array([0])).tolist() == wanted, repr(text)


def test_settled_code_points_have_the_librarys_class(library):
    from clonarium.llm.bpe import UNSURE, _classes

    points = [p for p in np.flatnonzero(_classes() != UNSURE).tolist() if not 0xD800 <= p < 0xE000]
    text = "".join(f"a{chr(p)}1 " for p in points)
    found = split_points(np.frombuffer(text.encode("utf-32-le"), np.uint32), np.array([0]))
    assert found.tolist() == [span[0] for _, span in library.pre_tokenizer.pre_tokenize_str(text)]


def test_encoder_gives_the_librarys_ids(library, texts):
    ids, sizes = Encoder(VOCABULARY).encode(texts)
    wanted = [ids_of(library, t) for t in texts]
    assert sizes.tolist() == [len(w) for w in wanted]
    assert ids.tolist() == [i for w in wanted for i in w]


def test_encoder_keeps_within_its_bound(library, texts, monkeypatch):
    encoder = Encoder(VOCABULARY)
    encoder.pool.bound = 50
    for text in texts:
        assert encoder.encode([text])[0].tolist() == ids_of(library, text)


def test_every_prefix_count_is_exact(library):
    drawn = random.Random(4)
    letters = [*" \n'abstrevlmd!<|>1é　", "<|endoftext|>", "the", "  ", "日本"]
    texts = ["".join(drawn.choice(letters) for _ in range(drawn.randrange(40))) for _ in range(250)]
    texts += ["'ll", "x're  y", "a   b", "-" * 60, "Ω" * 30, "<|endoftext|>"]
    counter = token_counts.PrefixCounter(VOCABULARY)
    for text, counts in zip(texts, counter.counts(texts), strict=True):
        assert counts.tolist() == [len(ids_of(library, text[: i + 1])) for i in range(len(text))], repr(text)
        assert token_counts.unpack(token_counts.pack(counts)).tolist() == counts.tolist()


def test_token_counts(docs, library, texts):
    limit = 20
    found = token_counts.budget_answers(token_counts.prefix_counts(docs, VOCABULARY), limit).collect()
    assert len(found) == len(texts) + 1
    for row in found:
        text = texts[row.doc_id] if row.doc_id < len(texts) else ""
        assert row.n_tokens == len(ids_of(library, text))
        assert row.n_bytes == len(text.encode())
        assert row.over_limit == (row.n_tokens > limit)
        assert len(ids_of(library, text[: row.limit_chars])) <= limit
        if len(text) < 400:
            fitting = [i for i in range(len(text) + 1) if len(ids_of(library, text[:i])) <= limit]
            assert row.limit_chars == max(fitting)


def test_planes_round_trip():
    drawn = np.random.default_rng(1)
    for n in (0, 1, 7, 1000, 70000):
        ids = drawn.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
        assert np.array_equal(token_files.from_planes(*token_files.to_planes(ids, 4096)), ids)


def test_token_files(spark, docs, library, texts, monkeypatch):
    monkeypatch.setattr(token_files, "CHUNK_IDS", 500)
    path = scratch_path(spark, "ids")
    token_files.write_tokens(docs, VOCABULARY, 2, path)
    found = sorted(token_files.read_tokens(spark, path, with_ids=True).collect())
    start = 0
    for row, text in zip(found, [*texts, None], strict=True):
        wanted = [*ids_of(library, text), 2]
        assert (row.start, row.n_tokens, row.ids) == (start, len(wanted), wanted)
        assert row.ids_crc32 == zlib.crc32(np.array(wanted, "<u4").tobytes())
        start += len(wanted)


def test_token_files_of_repeated_and_null_ids(spark, twice):
    path = scratch_path(spark, "ids")
    token_files.write_tokens(twice, VOCABULARY, 2, path)
    found = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None, None, 3, 7, 7, 7]
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1]]


def test_histogram_packing_places_every_piece():
    drawn = random.Random(9)
    for limit in (4, 64, 1024):
        counts = {drawn.randrange(1, limit + 1): drawn.randrange(1, 300) for _ in range(50)}
        places = {}
        for length, first, number, sequence, offset in packing.pack_histogram(counts, limit):
            for i in range(number):
                places.setdefault(sequence + i, []).append((offset, length, first + i))
        ranks = {}
        for parts in places.values():
            at = 0
            for offset, length, rank in sorted(parts):
                assert offset == at
                at += length
                ranks.setdefault(length, []).append(rank)
            assert at <= limit
        assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
        assert sorted(places) == list(range(len(places)))


def test_packing(docs, library, texts):
    limit = 64
    found = packing.pack(docs, VOCABULARY, limit, 0).collect()
    every = {i: [*ids_of(library, t), 0] for i, t in enumerate([*texts, None])}
    seen, sequences = {}, {}
    for row in found:
        ids = every[row.doc_id][row.start : row.start + row.length]
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert row.doc_tokens == len(every[row.doc_id])
        seen.setdefault(row.doc_id, []).append((row.start, row.length))
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for doc, ids in every.items():
        assert sum(n for _, n in seen[doc]) == len(ids)
        assert [s for s, _ in sorted(seen[doc])] == list(range(0, len(ids), limit))
    for parts in sequences.values():
        assert [o for o, _ in sorted(parts)] == [0, *np.cumsum([n for _, n in sorted(parts)])[:-1]]
        assert sum(n for _, n in parts) <= limit
    used = sum(map(len, every.values()))
    assert used / (limit * len(sequences)) > 0.97


def test_packing_of_repeated_and_null_ids(twice):
    found = packing.pack(twice, VOCABULARY, 16, 0).collect()
    assert sum(r.length for r in found if r.start == 0 and r.doc_id == 7) >= 3
    assert len({(r.sequence_id, r.offset) for r in found}) == len(found)


def test_empty_tables(spark, no_docs):
    counted = token_counts.prefix_counts(no_docs, VOCABULARY)
    assert token_counts.budget_answers(counted, 9).collect() == []
    path = scratch_path(spark, "ids")
    token_files.write_tokens(no_docs, VOCABULARY, 2, path)
    assert token_files.read_tokens(spark, path).collect() == []
    assert packing.pack(no_docs, VOCABULARY).collect() == []


def test_token_files_keep_the_least_id_and_null_apart(spark, tmp_path):
    least = -(1 << 63)
    rows = [(least, "the least"), (None, "none"), (0, "zero"), (-1, "minus one"), (None, "none either")]
    path = str(tmp_path / "ids")
    token_files.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), VOCABULARY, 2, path)
    found = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None, None, least, -1, 0]
