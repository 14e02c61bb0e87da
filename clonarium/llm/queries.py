"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clonarium.llm import (
    chat_format,
    decontaminate,
    embedding_dedup,
    host_rules,
    line_crf,
    merkle_manifest,
    packing,
    periodic_runs,
    pii,
    simhash_dedup,
    suffix_dedup,
    token_counts,
    token_files,
)
from clonarium.llm.common import materialize, scratch_path, table
from clonarium.llm.oracles import ORACLES  # noqa: F401  (read with QUERIES)

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TOKEN_LIMIT, SEQUENCE_TOKENS, END_OF_DOCUMENT, END_OF_TEXT = 512, 1024, 2, 0
PROXIMITY_SLOP = 1

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(docs).select("doc_id", "pii")
    base = ("email", "ip", "card", "phone")

    def number(kind: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(number(k) for k in base),
        F.sha2(pii.listing(F.filter("pii", lambda s: s["kind"].isin(*base))), 256).alias("base_sha256"),
        pii.listing(F.col("pii")).alias("spans"),
        number("iban"),
        F.aggregate("pii", F.lit(0.0), lambda top, s: F.greatest(top, s["score"])).alias("top_score"),
    )


@register
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@register
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, whether over the limit, and the characters that fit it."""
    counted = token_counts.prefix_counts(table(spark, sf_dir, "documents"), VOCABULARY)
    return token_counts.budget_answers(materialize(counted, "prefix-counts"), TOKEN_LIMIT)


@register
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one made of control strings, formatted and read back."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(tricky).alias("text"),
    )
    events = chat_format.message_events(given.unionByName(extra))
    return chat_format.read_back(chat_format.format_turns(events, dealt=True))


def _held_out() -> Column:
    """Whether a document's label may not be learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quality_model(spark: SparkSession, sf_dir: str):
    """The field fitted on the labels that may be learnt from."""
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return line_crf.train(docs, labels, F.col("doc_id").isNotNull() & ~_held_out())


@register
def op5_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents."""
    found = line_crf.score(table(spark, sf_dir, "documents"), quality_model(spark, sf_dir))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return found.select("doc_id", _held_out().alias("held_out"), "score", predicted, "n_lines", "n_bad_lines")


@register
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the benchmark windows that occur in them, word by word or nearly so."""
    found = decontaminate.find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slop=PROXIMITY_SLOP)
    sizes = F.transform("runs", lambda r: r["end"] - r["begin"])
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate(sizes, F.lit(0).cast("long"), lambda total, n: total + n).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
        F.size("near").cast("long").alias("n_near"),
    )


@register
def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


@register
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the 100-byte strings that also start earlier."""
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    sizes = F.transform("spans", lambda s: s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        F.aggregate(sizes, F.lit(0).cast("long"), lambda total, n: total + n).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@register
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents' ids as bit-plane files and read every document back."""
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), VOCABULARY, END_OF_DOCUMENT, path)
    return token_files.read_tokens(spark, path)


@register
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences."""
    return packing.pack(table(spark, sf_dir, "documents"), VOCABULARY, SEQUENCE_TOKENS, END_OF_TEXT)


@register
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest of all documents, each one's proof, and what its row, changed or not, leads to."""
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    leaf, n_chars = merkle_manifest.digest_of(*fields), fields[3].cast("decimal(20,0)") + 1
    changed = F.when(tampered, merkle_manifest.digest_of(*fields[:3], n_chars, fields[4]))
    manifest = merkle_manifest.build_manifest(
        docs, leaf, F.col("lang"), F.col("doc_id"), F.col("doc_id"), changed.alias("changed")
    )
    found = merkle_manifest.find_proofs(manifest, manifest.leaves)
    claimed = F.coalesce("row.changed", "digest")
    rows = found.select(
        "row.doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(manifest.root).alias("root"),
        merkle_manifest.proof_digest(F.col("path")).alias("proof_sha256"),
        merkle_manifest.folded(claimed, F.col("path")).alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def repeat_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Plants a periodic end in the words of some documents, chosen by their id."""
    mark, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or mark % 10 or not n:
        return words
    begin, times = mark // 10 % n, 3 + mark // 10 % 8
    period = 1 + (n - begin) // times
    unit = words[begin : begin + period]
    return words[:begin] + (unit * (times + 1))[: n - begin]


@register
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of all documents and digests of the texts without the repeats."""
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), rewrite=repeat_tail)
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = found.withColumn("best", periodic_runs.strongest(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(listed, lambda line: F.concat(line, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


@register
def op13_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by the base rules and by their hosts' failure rates."""
    judged = host_rules.judge(table(spark, sf_dir, "documents"))
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_rejected")
    return judged.select("doc_id", *columns)
