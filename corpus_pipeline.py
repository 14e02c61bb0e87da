"""A corpus of documents made into training sequences, stage by stage.

Quality filter, near-duplicate removal, benchmark decontamination, redaction of personal data,
packing. Every stage reads what the one before it wrote; all but the last return the columns of
``documents``. Filtering stages drop whole rows and leave the others as they are, a null text
included; redaction changes texts with personal data only, and their ``n_chars`` with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clonarium.llm import decontaminate, line_crf, packing, pii, queries, simhash_dedup
from clonarium.llm.common import materialize, ship, table

MIN_QUALITY = 0.5


def _carried(docs: DataFrame) -> list[Column]:
    """All of a row but its id and text, under names that cannot clash, to go along with them."""
    others = [c for c in docs.columns if c != "text"]
    return [F.col("text").isNull().alias("_no_text"), *(F.col(c).alias(f"_c{i}") for i, c in enumerate(others))]


def _restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Undo ``_carried``: the columns of ``docs`` in their order and with their types."""
    others = [c for c in docs.columns if c != "text"]
    text = F.when(~F.col("_no_text"), F.col("text")).alias("text")
    return rows.select(*(text if c == "text" else F.col(f"_c{others.index(c)}").alias(c) for c in docs.columns))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = queries.quality_model(spark, sf_dir)
    scored = line_crf.score(docs, model, *_carried(docs))
    return _restored(scored.where(F.col("score") >= MIN_QUALITY), docs)


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash_dedup.drop_near_duplicates(docs)


def benchmark_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of the benchmark occurs."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    spans = "_pii"
    while spans in docs.columns:
        spans += "_"
    found = pii.redact(pii.find_pii(docs, into=spans), spans_col=spans)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.when(F.size(spans) > 0, length).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left and their sequences."""
    return packing.pack(docs, queries.VOCABULARY, queries.SEQUENCE_TOKENS, queries.END_OF_TEXT)


STAGES = [
    ("quality classifier", quality_filter),
    ("simhash near-dedup", near_duplicate_removal),
    ("benchmark decontamination", benchmark_removal),
    ("pii", pii_redaction),
    ("packing", sequence_packing),
]

# The classifier and the tokenizer are beyond SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(ship(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
