"""The named joins between cohort tables.

Each puts the table with the repeated key first and the one with the unique key
second, so that ``lookup_join`` can keep a heavy key out of the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clonarium.functions.ids import (
    emit_tumour_id,
    parse_sample_name,
    parse_tumour_id,
    patient_of,
)
from clonarium.operators.aggregates import joined_distinct
from clonarium.operators.intervals import interval_join
from clonarium.operators.quality import CheckFailed, duplicate_keys, key_set_difference, require_none
from clonarium.operators.reshape import packed, text_array
from clonarium.operators.skew import lookup_join


def with_convention(
    df: DataFrame,
    crosswalk: DataFrame,
    convention: str,
    column: str = "tumour_id",
    only_family: str | None = None,
) -> DataFrame:
    """Re-emit tumour ids in the ``ltx`` or ``cruk`` convention.

    The crosswalk (ltx_patient_id, cruk_patient_id) is used for patients of the other
    family only; a patient it lacks fails the job. ``only_family`` also fails ids that
    do not start with it.
    """
    source, target = ("cruk", "ltx") if convention == "ltx" else ("ltx", "cruk")
    emit_tumour_id(F.lit(None), F.lit(None), convention)  # rejects an unknown convention
    family = source.upper()
    lookup = crosswalk.select(
        F.col(f"{source}_patient_id").alias("_patient"),
        F.col(f"{target}_patient_id").alias("_translated"),
    )
    parsed = df.withColumn("_id", parse_tumour_id(F.col(column)))
    if only_family:
        parsed = parsed.withColumn(
            "_id",
            F.when(
                F.col("_id.patient").startswith(only_family) | F.col(column).isNull(), F.col("_id")
            ).otherwise(F.raise_error(F.concat(F.lit(f"not a {only_family} id: "), F.col(column)))),
        )
    parsed = parsed.withColumn("_patient", F.col("_id.patient"))
    joined = lookup_join(parsed, lookup, ["_patient"], "left")
    patient = (
        F.when(~F.col("_patient").startswith(family), F.col("_patient"))
        .when(F.col("_translated").isNotNull(), F.col("_translated"))
        .when(
            F.col("_patient").isNotNull(),
            F.raise_error(F.concat(F.lit("patient not in crosswalk: "), F.col("_patient"))).cast("string"),
        )
    )
    emitted = emit_tumour_id(patient, F.col("_id.ordinal"), convention)
    return joined.select(*[emitted.alias(c) if c == column else F.col(c) for c in df.columns])


def cruk_to_ltx(df: DataFrame, crosswalk: DataFrame, column: str = "tumour_id", **kw) -> DataFrame:
    """CRUK ids to LTX ids; an id of the other family fails."""
    return with_convention(df, crosswalk, "ltx", column, only_family="CRUK", **kw)


def ltx_to_cruk(df: DataFrame, crosswalk: DataFrame, column: str = "tumour_id", **kw) -> DataFrame:
    """LTX ids to CRUK ids; an id of the other family fails."""
    return with_convention(df, crosswalk, "cruk", column, only_family="LTX", **kw)


def require_one_to_one(crosswalk: DataFrame, columns: Sequence[str]) -> None:
    """Fail unless every column of the crosswalk is unique on its own."""
    for column in columns:
        require_none(duplicate_keys(crosswalk, [column]), f"crosswalk: {column} has duplicates")


def patients_missing_from(
    df: DataFrame, crosswalk: DataFrame, convention: str, column: str = "tumour_id"
) -> DataFrame:
    """Patients of the other family that the crosswalk cannot translate."""
    source = "cruk" if convention == "ltx" else "ltx"
    parsed = df.select(parse_tumour_id(F.col(column), strict=False)["patient"].alias("patient"))
    foreign = parsed.where(F.col("patient").startswith(source.upper())).distinct()
    known = crosswalk.select(F.col(f"{source}_patient_id").alias("patient"))
    return foreign.join(known, "patient", "left_anti")


def expression_table(counts: DataFrame, tpm: DataFrame, check_keys: bool = True) -> DataFrame:
    """Long counts and long TPM side by side, with the parts of the sample name.

    Genes and samples must agree between the two, which ``check_keys`` asserts.
    """
    if check_keys:
        def keys(df: DataFrame) -> DataFrame:
            pair = F.array(*[F.struct(F.lit(k).alias("column"), F.col(k).alias("value")) for k in ("gene_id", "sample_name_hash")])
            return df.select(F.explode(pair).alias("k")).select("k.*")

        # Both key columns of a side in one pass over it.
        require_none(key_set_difference(keys(counts), keys(tpm), ["column", "value"]), "counts and tpm differ in a key")
    joined = counts.join(tpm, ["gene_id", "sample_name_hash"], "full")
    return joined.select(
        "sample_name_hash",
        parse_sample_name(F.col("sample_name_hash")).alias("_name"),
        "gene_id",
        "counts",
        "tpm",
    ).select("sample_name_hash", "_name.*", "gene_id", "counts", "tpm")


def unpaired_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, n_left, n_right) of the keys that are not exactly once on both sides, in one aggregation."""
    sides = left.select(key, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(key, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    counted = sides.groupBy(key).agg(F.sum("_l").alias("n_left"), F.sum("_r").alias("n_right"))
    return counted.where("n_left <> 1 or n_right <> 1")


def expression_from_matrices(counts: DataFrame, tpm: DataFrame, gene: str = "gene_id") -> DataFrame:
    """The same table from the two wide matrices, joined before they are melted.

    One row per gene goes through the join instead of one per gene and sample, and the
    sample sets are compared by the column names alone.
    """
    samples = [c for c in counts.columns if c != gene]
    differing = set(samples) ^ {c for c in tpm.columns if c != gene}
    if differing:
        raise CheckFailed(f"counts and tpm differ in samples {sorted(differing)[:5]}")
    require_none(unpaired_keys(counts, tpm, gene), f"counts and tpm differ in {gene}, or repeat it")
    both = packed(counts, [gene], samples, "_counts").join(
        packed(tpm, [gene], samples, "_tpm"), [gene], "full"
    )
    cells = F.arrays_zip(
        F.expr(text_array(samples)).alias("s"), F.col("_counts").alias("c"), F.col("_tpm").alias("t")
    )
    long = both.select(gene, F.explode(cells).alias("_cell")).select(
        F.col("_cell.s").alias("sample_name_hash"),
        F.col(gene).alias("gene_id"),
        F.col("_cell.c").alias("counts"),
        F.col("_cell.t").alias("tpm"),
    )
    # A name is taken apart once, not once for each gene.
    named = counts.sparkSession.range(1).select(F.explode(F.expr(text_array(samples)).cast("array<string>")).alias("sample_name_hash"))
    parts = named.select("sample_name_hash", parse_sample_name(F.col("sample_name_hash")).alias("_name"))
    joined = long.join(F.broadcast(parts), "sample_name_hash")
    return joined.select("sample_name_hash", "_name.*", "gene_id", "counts", "tpm")


def bands_per_gene(genes: DataFrame, bands: DataFrame) -> DataFrame:
    """Genes with the sorted names of the bands they overlap; '' without any.

    Genes (gene_name, chromosome, start, end) and bands (chromosome, band_start,
    band_end, band_name) are both half-open.
    """
    hits = interval_join(
        genes.select("gene_name", "chromosome", "start", "end"),
        bands.select("chromosome", "band_start", "band_end", "band_name"),
        ["chromosome"],
        ("start", "end"),
        ("band_start", "band_end"),
        left_end_open=True,
        right_end_open=True,
    )
    names = joined_distinct(hits, ["gene_name", "chromosome"], "band_name", "cytoband_name")
    return genes.join(names, ["gene_name", "chromosome"], "left").withColumn(
        "cytoband_name", F.coalesce("cytoband_name", F.lit(""))
    )


def mutations_with_scores(mutations: DataFrame, scores: DataFrame, **kw) -> DataFrame:
    """Scores by tumour, chromosome, ``pos`` (never ``start``) and alt; unscored rows stay."""
    return lookup_join(mutations, scores, ["tumour_id", "chr", "pos", "alt"], "left", **kw)


def mutations_on_tree(mutations: DataFrame, tree: DataFrame, how: str = "inner", **kw) -> DataFrame:
    """Tree columns by tumour and clone."""
    return lookup_join(mutations, tree, ["tumour_id", "clone"], how, **kw)


def genes_with_driver_flags(
    genes: DataFrame, drivers: DataFrame, flags: Sequence[str], **kw
) -> DataFrame:
    """All genes with the driver flags; a gene that is no driver gets FALSE."""
    lookup = drivers.select(F.col("Hugo_Symbol").alias("gene_name"), *flags)
    joined = lookup_join(genes, lookup, ["gene_name"], "left", **kw)
    return joined.withColumns({f: F.coalesce(f, F.lit(False)) for f in flags})


def mutations_in_drivers(mutations: DataFrame, drivers: DataFrame, **kw) -> DataFrame:
    """Mutations in driver genes, by gene symbol."""
    lookup = drivers.withColumnRenamed("Hugo_Symbol", "gene")
    return lookup_join(mutations, lookup, ["gene"], "inner", **kw)


def with_patient_record(df: DataFrame, clinical: DataFrame, how: str = "inner", **kw) -> DataFrame:
    """Patient-grain columns on tumour-grain rows; the patient comes from the tumour id."""
    keyed = df.withColumn("patient_id", patient_of(F.col("tumour_id")))
    lookup = clinical.withColumnRenamed("Patient_ID", "patient_id")
    return lookup_join(keyed, lookup, ["patient_id"], how, **kw)


def with_tumour_record(df: DataFrame, per_tumour: DataFrame, how: str = "inner", **kw) -> DataFrame:
    """Tumour-grain clinical columns on tumour-grain rows."""
    return lookup_join(df, per_tumour, ["tumour_id"], how, **kw)


def expression_of_mutations(mutations: DataFrame, expression: DataFrame, gene: str = "gene", **kw) -> DataFrame:
    """Expression of the mutated gene in the same sample."""
    lookup = expression.withColumnRenamed("gene_id", gene)
    return lookup_join(mutations, lookup, ["sample_name_hash", gene], "inner", **kw)


def expression_with_patient(expression: DataFrame, clinical: DataFrame, **kw) -> DataFrame:
    """Patient-grain columns on expression rows."""
    lookup = clinical.withColumnRenamed("Patient_ID", "patient_id")
    return lookup_join(expression, lookup, ["patient_id"], "inner", **kw)


def tumour_against_normal(expression: DataFrame, normals: DataFrame, **kw) -> DataFrame:
    """Tumour samples with the patient's normal expression of the same gene."""
    tumour = expression.where(~F.col("is_normal"))
    return lookup_join(tumour, normals, ["patient_id", "gene_id"], "inner", **kw)


def on_clone(df: DataFrame, clone_table: DataFrame, how: str = "inner", **kw) -> DataFrame:
    """Any clone-grain table by tumour and clone."""
    return lookup_join(df, clone_table, ["tumour_id", "clone"], how, **kw)


def on_tumour(df: DataFrame, tumour_table: DataFrame, how: str = "inner", **kw) -> DataFrame:
    """Any tumour-grain table by tumour."""
    return lookup_join(df, tumour_table, ["tumour_id"], how, **kw)
