"""From source files to canonical tables, one function per table.

A table that is checked before it is returned, or read more than once on the way, is
written to a scratch table first, so that its source is parsed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clonarium.functions.clones import clone_from_number, clone_from_text, clone_prefixed
from clonarium.functions.genome import (
    canonical_chromosome,
    copy_number_summary,
    on_primary_assembly,
    parse_segment,
)
from clonarium.functions.ids import (
    CRUK_PATIENT,
    LTX_PATIENT,
    canonical_tumour_id,
    strict_tumour_id,
    trimmed,
)
from clonarium.functions.labels import (
    PATHOGENICITY_LABELS,
    lenient_boolean,
    mapped_label,
    strict_boolean,
)
from clonarium.operators.aggregates import best_score_per_variant, gene_extents, paired_normals
from clonarium.operators.joins import (
    bands_per_gene,
    expression_from_matrices,
    require_one_to_one,
    with_convention,
)
from clonarium.operators.liftover import lift_mapped_loci, lifted_mutations
from clonarium.operators.quality import (
    duplicate_keys,
    list_length_mismatch,
    malformed,
    require_columns,
    require_none,
    unexpected_values,
)
from clonarium.operators.reshape import lesions_to_tumours, renamed
from clonarium.operators.trees import clone_tree_table
from clonarium.plans import contracts as c
from clonarium.session import materialize
from clonarium.sources.bundles import bundle_rows, read_bundles, split_bundles
from clonarium.sources.chain import read_chain
from clonarium.sources.delimited import (
    MARKERS_NAN,
    MARKERS_PLAIN,
    MARKERS_SCORES,
    read_delimited,
    read_parquet_columns,
    read_text_columns,
    typed,
    typed_all,
)
from clonarium.sources.headed import key_from_file_name, read_entity_columns, read_ragged_matrices

# Fixed value: file name of the per-tumour score files.
SCORE_FILE = "{key}_muttable_alpha.tsv"


def mutations(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """One row per mutation and sample, identifiers in canonical form.

    The source's numeric ``tumour_id`` becomes ``tumour_ordinal`` and frees its name
    for the tumour id proper.
    """
    text = read_text_columns(spark, path, partitions=partitions)
    df = typed_all(text, {k: v for k, v in c.MUTATION_SOURCE.items() if k in text.columns}, MARKERS_PLAIN)
    return renamed(
        df.withColumns(
            {
                "patient_tumour": canonical_tumour_id(F.col("patient_tumour")),
                "mutation_cluster": clone_from_number(F.col("mutation_cluster")),
                "chr": canonical_chromosome(F.col("chr")),
            }
        ),
        {
            "tumour_id": "tumour_ordinal",
            "patient_tumour": "tumour_id",
            "mutation_cluster": "clone",
            "var": "alt",
        },
    )


def mutations_on_new_build(spark: SparkSession, built: DataFrame, chain: str) -> DataFrame:
    """Canonical mutations with their id at the place the chain file moves them to.

    The loci are lifted once, however many samples share them.
    """
    return lifted_mutations(built, lift_mapped_loci(built, materialize(read_chain(spark, chain), "chain")))


def clone_tree(spark: SparkSession, path: str) -> DataFrame:
    """One row per tumour and clone, with row flags and the sum along its ancestors."""
    df = read_delimited(spark, path, c.CLONE_TREE_SOURCE, markers=MARKERS_NAN)
    return clone_tree_table(materialize(df, "clone-tree"))


def variant_scores(spark: SparkSession, path: str, key: Column | None = None) -> DataFrame:
    """One row per tumour and variant, from one annotated file per tumour.

    The tumour comes from the file name, unless ``key`` takes it from ``path`` otherwise.
    """
    key = key_from_file_name(SCORE_FILE) if key is None else key
    raw = read_entity_columns(
        spark, path, key, c.SCORE_SOURCE, key="tumour_id", markers=MARKERS_SCORES
    )
    scores = raw.select(
        strict_tumour_id(F.col("tumour_id")).alias("tumour_id"),
        canonical_chromosome(F.col("chr")).alias("chr"),
        "pos",
        F.col("var").alias("alt"),
        F.col("alpha_missense").alias("am_pathogenicity"),
        mapped_label(F.col("am_class"), PATHOGENICITY_LABELS).alias("am_class"),
    )
    return best_score_per_variant(scores, labels=sorted(set(PATHOGENICITY_LABELS.values())))


def clinical(spark: SparkSession, path: str) -> DataFrame:
    """One row per patient, all source columns under their own names."""
    text = read_text_columns(spark, path)
    return typed_all(text, {k: v for k, v in c.CLINICAL_SOURCE.items() if k in text.columns}, MARKERS_PLAIN)


def clinical_per_tumour(patients: DataFrame) -> DataFrame:
    """One row per patient and tumour ordinal."""
    return lesions_to_tumours(patients)


def drivers(spark: SparkSession, path: str) -> DataFrame:
    """One row per driver gene, with real booleans and bare chromosome names."""
    df = read_delimited(spark, path, c.DRIVER_SOURCE, keep_others=True)
    flags = {f: strict_boolean(F.col(f)) for f in c.DRIVER_FLAGS if f in df.columns}
    places = {k: canonical_chromosome(F.col(k)) for k in ("chr_hg19", "chr_hg38")}
    return df.withColumns({**flags, **places})


def copy_number(spark: SparkSession, path: str) -> DataFrame:
    """One row per tumour, segment and clone, with parsed bounds and summaries."""
    df = read_delimited(spark, path, c.COPY_NUMBER_SOURCE, sep=",")
    parsed = df.withColumn("_segment", parse_segment(F.col("segment")))
    summary = copy_number_summary(F.col("pred_CN_A"), F.col("pred_CN_B"))
    located = parsed.select(
        *df.columns,
        F.col("_segment.chr").alias("segment_chr"),
        F.col("_segment.start").alias("segment_start"),
        F.col("_segment.end").alias("segment_end"),
    )
    totals = {k: summary[k] for k in ("total_cn", "minor_cn", "major_cn")}
    flags = {k: summary[k] for k in ("is_homdel", "is_loh")}
    return located.withColumns(totals).withColumns(flags)


def expression(spark: SparkSession, counts_path: str, tpm_path: str) -> DataFrame:
    """One row per sample and gene, from two wide matrices with the same genes and samples."""
    counts, tpm = (read_parquet_columns(spark, p, ["gene_id"]) for p in (counts_path, tpm_path))
    return expression_from_matrices(counts, tpm)


def normals_per_patient(long_expression: DataFrame) -> DataFrame:
    """One row per patient with a normal sample and gene."""
    return paired_normals(long_expression)


def clone_proportions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(one row per tumour, clone and sample; files left out with the reason)."""
    rows, rejects = read_ragged_matrices(
        spark, path, "clone", key="tumour_id", column="sample_id", value="proportion", markers=MARKERS_PLAIN
    )
    return rows, rejects


def id_crosswalk(spark: SparkSession, path: str) -> DataFrame:
    """One row per patient; both ids checked for form and uniqueness."""
    types = dict.fromkeys(c.CROSSWALK_NAMES, "string")
    df = renamed(read_delimited(spark, path, types, sep=",", markers=MARKERS_NAN), c.CROSSWALK_NAMES)
    df = materialize(df.select(*[trimmed(F.col(n)).alias(n) for n in df.columns]), "id-crosswalk")
    for column, pattern in (("ltx_patient_id", LTX_PATIENT), ("cruk_patient_id", CRUK_PATIENT)):
        require_none(malformed(df, column, pattern), f"id_crosswalk: bad {column}")
    require_one_to_one(df, df.columns)
    return df


def clone_flags(spark: SparkSession, path: str, crosswalk: DataFrame, convention: str = "ltx") -> DataFrame:
    """One row per tumour and clone with its classification flags."""
    text = read_text_columns(spark, path)
    require_columns(text, c.CLONE_FLAG_NAMES, "clone flags")
    types = dict.fromkeys(["tumour_id", *c.CLONE_FLAG_NAMES], "string")
    df = renamed(typed(text, types, MARKERS_NAN), c.CLONE_FLAG_NAMES)
    flags = [n for n in c.CLONE_FLAG_NAMES.values() if n != "clone"]
    df = df.select(
        "tumour_id",
        clone_from_text(F.col("clone"), null_fails=True).alias("clone"),
        *[lenient_boolean(F.col(f)).alias(f) for f in flags],
    )
    df = materialize(with_convention(df, crosswalk, convention), "clone-flags")
    require_none(duplicate_keys(df, ["tumour_id", "clone"]), "clone_flags: duplicate (tumour_id, clone)")
    return df


def seeding(spark: SparkSession, path: str, crosswalk: DataFrame, convention: str = "ltx") -> DataFrame:
    """One row per tumour; the per-metastasis lists are checked against their length."""
    text = read_text_columns(spark, path, " ")
    require_columns(text, c.SEEDING_NAMES, "seeding")
    types = {**dict.fromkeys(["tumour_id", *c.SEEDING_NAMES], "string"), "nRegions": "bigint"}
    df = renamed(typed(text, types, MARKERS_NAN), c.SEEDING_NAMES)
    df = materialize(with_convention(df, crosswalk, convention), "seeding")
    require_none(duplicate_keys(df, ["tumour_id"]), "seeding: duplicate tumour_id")
    lists = ["individual_seeding_clonality", "individual_seeding_phyletic"]
    require_none(
        list_length_mismatch(df, lists, "n_regions").select("tumour_id", "n_regions", *lists),
        "seeding: list length is not n_regions",
    )
    return df


def gene_reference(
    spark: SparkSession, genes_path: str, bands_path: str, partitions: int | None = None
) -> DataFrame:
    """One row per gene and chromosome: outer bounds, strand, overlapped bands."""
    gene_types = {"chrom": "string", "strand": "string", "txStart": "bigint", "txEnd": "bigint", "name2": "string"}
    text = read_text_columns(spark, genes_path, names=c.GENE_SOURCE_COLUMNS).withColumn(
        "line_no", F.monotonically_increasing_id().cast("string")
    )
    if partitions:
        text = text.repartition(partitions)
    transcripts = typed(text, {**gene_types, "line_no": "bigint"}, MARKERS_PLAIN)
    genes = gene_extents(
        transcripts.where(on_primary_assembly(F.col("chrom"))).select(
            F.col("name2").alias("gene_name"),
            F.col("chrom").alias("chromosome"),
            F.col("txStart").alias("tx_start"),
            F.col("txEnd").alias("tx_end"),
            "strand",
            "line_no",
        )
    )
    band_types = {"chrom": "string", "chromStart": "bigint", "chromEnd": "bigint", "band_name": "string"}
    bands = read_delimited(spark, bands_path, band_types, names=c.BAND_SOURCE_COLUMNS, markers=[])
    bands = bands.where(on_primary_assembly(F.col("chrom"))).select(
        F.col("chrom").alias("chromosome"),
        F.col("chromStart").alias("band_start"),
        F.col("chromEnd").alias("band_end"),
        "band_name",
    )
    return bands_per_gene(materialize(genes, "genes"), bands).select(
        "gene_name",
        canonical_chromosome(F.col("chromosome")).alias("chromosome"),
        "start",
        "end",
        "strand",
        "cytoband_name",
    )


def region_tables(
    spark: SparkSession, path: str, crosswalk: DataFrame, convention: str = "ltx"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(CCF rows, clonality rows, rejected bundles), one row per tumour, clone and region."""
    bundles, rejects = split_bundles(read_bundles(spark, path))
    # Read, and its id translated, once a bundle: not for each of its cells, of which it may have none.
    # One without names stays, and fails.
    bundles = bundles.where(F.coalesce((F.size("clones") > 0) & (F.size("regions") > 0), F.lit(True)))
    bundles = materialize(with_convention(bundles, crosswalk, convention, "sample_id"), "bundles")
    tables = []
    for matrix, kind in (("ccf", "int"), ("clonality", "string")):
        rows = bundle_rows(bundles, matrix, matrix)
        rows = rows.select(
            "tumour_id",
            clone_prefixed(F.col("clone")).alias("clone"),
            "region",
            F.col(matrix).cast(kind).alias(matrix),
        )
        rows = materialize(rows, f"region-{matrix}")
        require_none(
            duplicate_keys(rows, ["tumour_id", "clone", "region"]),
            f"{matrix}: duplicate (tumour_id, clone, region)",
        )
        tables.append(rows)
    allowed = c.CONTRACTS["region_clonality"].allowed["clonality"]
    require_none(unexpected_values(tables[1], "clonality", allowed), "clonality: unexpected values")
    return tables[0], tables[1], rejects
