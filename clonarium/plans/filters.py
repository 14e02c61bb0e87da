"""Named filters, one Column expression each, by table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clonarium.functions.genome import on_primary_assembly

# The total copy number from which a segment counts as amplified, the
# TPM from which a gene counts as expressed.
AMPLIFIED_FROM = 5
EXPRESSED_FROM = 1.0


def _c(name: str) -> Column:
    return F.col(name)


def _total_cn() -> Column:
    return _c("pred_CN_A") + _c("pred_CN_B")


FILTERS: dict[str, dict[str, Column]] = {}


def filters() -> dict[str, dict[str, Column]]:
    """All filters by table name; built on first use, as a Column needs a session."""
    if not FILTERS:
        FILTERS.update(
            {
                "mutations": {
                    "present_in_sample": _c("is_present"),
                    "called": _c("CALLED"),
                    "coding_only": _c("func_refgene") == "exonic",
                    "snv_only": _c("is_snv"),
                    "on_tree": _c("tree_cluster") & ~F.coalesce("tree_cn_removed_cluster", F.lit(False)),
                },
                "clone_tree": {
                    "analysis_usable": _c("status") == "resolved",
                    "high_quality": _c("quality") == "High",
                    "clonal_wgd_tumours": _c("class") == "clonal_wgd",
                    "subclonal_wgd_mut_supported": _c("class") == "mut_supported",
                    "subclonal_wgd_ploidy_only": _c("class") == "ploidy_only",
                    "no_wgd_tumours": _c("class") == "no_wgd",
                },
                "variant_scores": {
                    "scored": _c("am_pathogenicity").isNotNull(),
                    "likely_pathogenic": _c("am_class") == "pathogenic",
                    "likely_benign": _c("am_class") == "benign",
                    "ambiguous": _c("am_class") == "ambiguous",
                },
                "copy_number": {
                    "homdel": (_c("pred_CN_A") == 0) & (_c("pred_CN_B") == 0),
                    "loh": ((_c("pred_CN_A") == 0) | (_c("pred_CN_B") == 0)) & (_total_cn() > 0),
                    "amplified": _total_cn() >= AMPLIFIED_FROM,
                    "diploid_heterozygous": (_c("pred_CN_A") == 1) & (_c("pred_CN_B") == 1),
                },
                "drivers": {
                    "snv_drivers_lung": _c("lung_mut_driver"),
                    "snv_drivers_pan": _c("mut_driver"),
                    "cn_drivers_lung": _c("lung_CN_driver"),
                    "cn_drivers_pan": _c("CN_driver"),
                },
                "expression": {
                    "tumour_only": ~_c("is_normal"),
                    "normal_only": _c("is_normal"),
                    "expressed": _c("tpm") >= EXPRESSED_FROM,
                },
                "gene_source": {"primary_assembly": on_primary_assembly(_c("chrom"))},
            }
        )
    return FILTERS


def filtered(df: DataFrame, table: str, name: str) -> DataFrame:
    """Rows of a table that pass one of its named filters."""
    return df.where(filters()[table][name])


def filter_counts(df: DataFrame, table: str) -> DataFrame:
    """(filter, n_rows): how many rows pass each filter of a table, in one pass."""
    named = filters()[table]
    counted = df.agg(*[F.count_if(cond).alias(name) for name, cond in named.items()])
    pairs = F.array(
        *[F.struct(F.lit(n).alias("filter"), F.col(n).alias("n_rows")) for n in named]
    )
    return counted.select(F.inline(pairs))
