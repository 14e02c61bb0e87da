"""Grouped summaries. All use aggregates that combine map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def best_score_per_variant(
    scores: DataFrame,
    key: Sequence[str] = ("tumour_id", "chr", "pos", "alt"),
    score: str = "am_pathogenicity",
    label: str = "am_class",
    labels: Sequence[str] | None = None,
) -> DataFrame:
    """One row per variant: highest score, ignoring null and NaN, and its label.

    Copies of a variant agree on the label; where they do not, the first in
    alphabetical order is taken, and ``varying_within`` reports the variant. Where ``labels``
    lists all there may be, their places are compared: for the least text, Spark would sort the rows.
    """
    known = F.nanvl(F.col(score), F.lit(None).cast("double"))
    if labels is None:
        return scores.groupBy(*key).agg(F.max(known).alias(score), F.min(label).alias(label))
    texts = F.array(*[F.lit(x) for x in sorted(labels)])
    best = scores.groupBy(*key).agg(F.max(known).alias(score), F.min(F.array_position(texts, F.col(label))).alias(label))
    return best.withColumn(label, F.get(texts, F.col(label).cast("int") - 1))


def least_text(text: Column) -> Column:
    """The least text of a group, for a few dozen groups of many rows.

    The set, of one value at most, makes the aggregate one over objects, which keeps its groups in a map.
    With a text in the buffer and no such aggregate, Spark sorts all rows of a task.
    """
    nulls = F.collect_set(F.when(text.isNull(), True))
    return F.when(F.size(nulls) <= 1, F.min(text))


def gene_extents(transcripts: DataFrame, order: str = "line_no") -> DataFrame:
    """One row per gene and chromosome: outer bounds, strand of the first transcript."""
    return transcripts.groupBy("gene_name", "chromosome").agg(
        F.min("tx_start").alias("start"),
        F.max("tx_end").alias("end"),
        F.min_by("strand", order).alias("strand"),
    )


def joined_distinct(
    df: DataFrame, key: Sequence[str], value: str, out: str, separator: str = ";"
) -> DataFrame:
    """The distinct values of a group as one sorted, delimited text.

    Meant for groups with few distinct values, such as the bands under a gene. The
    duplicates are gone before any group is assembled.
    """
    distinct = df.select(*key, value).distinct()
    return distinct.groupBy(*key).agg(
        F.array_join(F.array_sort(F.collect_list(value)), separator).alias(out)
    )


def paired_normals(expression: DataFrame) -> DataFrame:
    """Mean expression of a patient's normal samples per gene, with one sample name."""
    return (
        expression.where(F.col("is_normal"))
        .groupBy("patient_id", "gene_id")
        .agg(
            F.avg("tpm").alias("tpm_normal"),
            F.min("sample_name_hash").alias("normal_sample_name_hash"),
        )
    )


def present_clones(
    proportions: DataFrame,
    threshold: float = 0.05,
    key: Sequence[str] = ("tumour_id", "clone"),
    proportion: str = "proportion",
) -> DataFrame:
    """Clones that reach the threshold in at least one sample, with their maximum."""
    top = proportions.groupBy(*key).agg(F.max(proportion).alias("max_proportion"))
    return top.where(F.col("max_proportion") >= threshold)


def mutation_rollups(mutations: DataFrame, key: Sequence[str] = ("mutation_id",)) -> DataFrame:
    """Cross-sample extremes and any-sample flags per mutation."""
    return mutations.groupBy(*key).agg(
        F.max("var_count").alias("max_var_count"),
        F.min("cov").alias("min_depth"),
        F.max("vaf").alias("max_vaf"),
        F.bool_or("varscan").alias("varscan_any"),
        F.bool_or("mutect").alias("mutect_any"),
        F.bool_or("vaf02").alias("vaf02_any"),
        F.bool_or("is_expressed").alias("is_expressed_any"),
    )


def doublings_per_tumour(tree: DataFrame) -> DataFrame:
    """Doubling events summed over the clones of a tumour."""
    return tree.groupBy("tumour_id").agg(
        F.sum("number_of_gds_at_clone").alias("total_gds_per_tumour")
    )


def composition(
    proportions: DataFrame,
    key: Sequence[str] = ("tumour_id", "sample_id"),
    proportion: str = "proportion",
    tolerance: float = 1e-6,
) -> DataFrame:
    """Sum of the proportions per sample and whether it is 1 within the tolerance."""
    sums = proportions.groupBy(*key).agg(F.sum(proportion).alias("total"))
    return sums.withColumn("is_complete", F.abs(F.col("total") - 1) < tolerance)


# Cohort names and the flag that decides membership.
COHORT_FLAGS = {"primary": "is_primary_clone", "mets": "is_met_clone"}


def cohort_tumours(clone_flags: DataFrame, cohort: str) -> DataFrame:
    """Distinct tumours with at least one clone of the cohort, sorted."""
    if cohort not in COHORT_FLAGS:
        raise ValueError(f"cohort must be one of {sorted(COHORT_FLAGS)}, got {cohort!r}")
    members = clone_flags.where(F.col(COHORT_FLAGS[cohort])).select("tumour_id")
    return members.distinct().orderBy("tumour_id")


def non_tree_clones(clone_flags: DataFrame) -> DataFrame:
    """Number of clones, and of clones left off the tree."""
    return clone_flags.agg(
        F.count(F.lit(1)).alias("n_clones"),
        F.count_if(~F.col("is_tree_clone")).alias("n_non_tree"),
    )
