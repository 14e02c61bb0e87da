"""The manifest against a tree built in one piece."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from clonarium.llm import merkle_manifest as mm

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(nodes):
    """All levels, and each lowest node's siblings from the bottom up."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
    paths = [[level[i >> h ^ 1] for h, level in enumerate(levels[:-1]) if (i >> h ^ 1) < len(level)] for i in range(len(nodes))]
    return levels[-1][0], paths


def plain_manifest(rows):
    """(doc_id, leaf, subroot, proof) of each row, and the root."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        ordered = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[name] = ordered, *plain_tree([plain_leaf(r) for r in ordered])
    root, above = plain_tree([trees[n][1] for n in names])
    found = [
        (row[0], plain_leaf(row), subroot, sha("".join([*path, *up])))
        for n, up in zip(names, above, strict=True)
        for ordered, subroot, paths in [trees[n]]
        for row, path in zip(ordered, paths, strict=True)
    ]
    return root, found


def manifest_of(frame, levels):
    fields = [F.col(c) for c in FIELDS]
    return mm.build_manifest(frame, mm.digest_of(*fields), F.col("lang"), F.col("doc_id"), F.col("doc_id"), levels=levels)


def proofs(manifest, requests):
    path = F.col("path")
    found = mm.find_proofs(manifest, requests)
    return found.select("row.doc_id", "digest", "subroot", mm.proof_digest(path).alias("proof"), mm.folded(F.col("digest"), path).alias("root"))


def comparable(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("levels", [3, 10])
def test_manifest_against_one_tree(spark, levels):
    langs = ["en"] * 41 + ["fr"] * 16 + ["de"] * 9 + [None] * 3 + ["", "Zü", "zü", "日本"]
    rows = [(i * 7 % 101 - 20, f"s{i % 3}", lang, i, "te|xt " * (i % 4) + "é") for i, lang in enumerate(langs)]
    rows += [rows[0]] * 3 + [(None, None, None, None, None)] * 2 + [(5, None, "en", None, ""), (5, "", "en", None, None)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", tree int").repartition(5)
    root, wanted = plain_manifest(rows)
    manifest = manifest_of(frame, levels)
    assert manifest.root == root
    found = proofs(manifest, manifest.leaves).collect()
    assert {r.root for r in found} == {root}
    assert comparable(r[:4] for r in found) == comparable(wanted)
    # Every record is named by its content.
    for record in manifest.tiers[0].collect():
        assert mm.levels_above(record.children, record.height)[-1] == [record.digest]


def test_manifest_of_some_leaves(spark):
    rows = [(i, "s", "en" if i % 5 else "fr", i, f"text {i}") for i in range(90)]
    manifest = manifest_of(spark.createDataFrame(rows, SCHEMA).repartition(3), 3)
    root, wanted = plain_manifest(rows)
    some = manifest.leaves.where("row.doc_id in (0, 3, 44, 89) ")
    found = proofs(manifest, some).collect()
    assert comparable(r[:4] for r in found) == comparable(w for w in wanted if w[0] in (0, 3, 44, 89))
    assert {r.root for r in found} == {root} == {manifest.root}
    assert proofs(manifest, manifest.leaves.where("row.doc_id < 0")).collect() == []


def test_manifest_of_equal_rows_one_row_and_none(spark):
    same = [(None, "s", None, 1, "x")] * 37
    manifest = manifest_of(spark.createDataFrame(same, SCHEMA), 3)
    root, wanted = plain_manifest(same)
    assert comparable(r[:4] for r in proofs(manifest, manifest.leaves).collect()) == comparable(wanted)
    assert manifest.root == root
    # A lone leaf is its group's root, and the root.
    manifest = manifest_of(spark.createDataFrame(same[:1], SCHEMA), 10)
    found = proofs(manifest, manifest.leaves).collect()
    assert [tuple(r) for r in found] == [(None, plain_leaf(same[0]), plain_leaf(same[0]), sha(""), plain_leaf(same[0]))]
    manifest = manifest_of(spark.createDataFrame([], SCHEMA), 10)
    assert manifest.root is None
    assert proofs(manifest, manifest.leaves).collect() == []


def test_a_changed_leaf_does_not_verify(spark):
    rows = [(i, "s", "en", i, "t") for i in range(9)]
    manifest = manifest_of(spark.createDataFrame(rows, SCHEMA), 10)
    found = mm.find_proofs(manifest, manifest.leaves).select(mm.folded(F.sha2(F.lit("other"), 256), F.col("path")).alias("root"))
    assert all(r.root != manifest.root for r in found.collect())


def test_long_text_is_a_leaf(spark):
    text = "é long " * 300_000
    frame = spark.createDataFrame([(1, "s", "en", None, text)], SCHEMA)
    assert manifest_of(frame, 10).root == plain_leaf((1, "s", "en", None, text))
