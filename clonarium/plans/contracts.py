"""What each canonical table promises: columns, key, allowed values, foreign keys."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clonarium.functions.clones import VIRTUAL_ROOT
from clonarium.functions.ids import CANONICAL_TUMOUR, CRUK_PATIENT, LTX_PATIENT
from clonarium.operators.quality import duplicate_keys, orphans, violation_counts


def _types(**groups: list[str]) -> dict[str, str]:
    """{column: type} from type=[columns]."""
    return {name: kind for kind, names in groups.items() for name in names}


@dataclass(frozen=True)
class ForeignKey:
    """Columns whose values must occur in another table; a key with a null part, or with one
    of the values in ``open_ends``, points nowhere."""

    columns: tuple[str, ...]
    table: str
    references: tuple[str, ...]
    open_ends: tuple[str, ...] = ()


@dataclass(frozen=True)
class TableContract:
    """Key columns and those in ``required`` hold no nulls; ``optional`` columns may be missing."""

    name: str
    key: tuple[str, ...]
    types: dict[str, str]
    optional: dict[str, str] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    allowed: dict[str, tuple] = field(default_factory=dict)
    formats: dict[str, str] = field(default_factory=dict)
    bounds: dict[str, tuple[float, float]] = field(default_factory=dict)
    foreign_keys: tuple[ForeignKey, ...] = ()


# Source columns and types, allowed values, key columns.
MUTATION_SOURCE = _types(
    string=[
        "patient_id", "patient_tumour", "sample_name_hash", "gl_sample_name_hash", "mutation_id", "chr",
        "ref", "var", "gene", "func_refgene", "aachange_refgene", "snp137", "cosmic90_coding", "ljb23_sift",
        "ljb23_pp2hvar", "driver_category", "ffpe_confidence", "cluster_region_clonality", "timing",
    ],
    int=[
        "tumour_id", "var_count", "ref_count", "cov", "max_var_count", "min_depth", "cosmic_count",
        "ith_state", "ith_state_ambiguity1", "rna_var_count", "rna_cov",
    ],
    bigint=["start", "stop", "pos"],
    double=[
        "vaf", "max_vaf", "gnomad211_af", "cn_a", "cn_b", "major_cn", "minor_cn", "mutcpn", "phylo_ccf",
        "obs_ccf", "clone_region_proportion", "mean_cluster_region_ccf", "rna_vaf", "mutation_cluster",
    ],
    boolean=[
        "is_present", "is_snv", "is_indel", "is_mnv", "varscan", "mutect", "vaf02", "varscan_any",
        "mutect_any", "vaf02_any", "cadd13gt10", "CALLED", "PASS", "pan_cancer_driver", "lung_driver",
        "luad_driver", "lusc_driver", "oncogene", "tumor_suppressor", "is_deleterious", "is_driver_mut",
        "ffpe", "is_trunk", "clean_cluster", "tree_cluster", "tree_cn_removed_cluster", "is_cn_fail",
        "is_homogen", "is_artefact_sig_fail", "is_homogen_ambiguity1", "is_expressed", "is_expressed_any",
    ],
)
CLINICAL_SOURCE = _types(
    int=["age", "registration_ECOG"],
    double=[
        "pre_surgery_FEV1", "Number_cigs_perday_use", "Number_years_smoking_use", "pack_years_calculated",
        "pack_years_truncated", "age_start_smoking_survey", "age_start_smoking_exsmoker",
        "age_stop_smoking_exsmoker", "alcohol_years", "alcohol_years_truncated",
        "SizePath_lesion1_central.reviewed", "SizePath_lesion2_central.reviewed", "PrevCancerAge",
    ],
)
CLONE_TREE_SOURCE = _types(
    string=["tumour_id", "clone", "parent", "quality", "status", "class", "sub_class"],
    bigint=["number_of_gds_at_clone", "total_gds_per_tumour"],
)
SCORE_SOURCE = {
    "chr": "string",
    "pos": "bigint",
    "var": "string",
    "alpha_missense": "double",
    "am_class": "string",
}
DRIVER_SOURCE = _types(
    int=["CGC_TIER"], bigint=["start_hg38", "end_hg38", "start_hg19", "end_hg19"]
)
DRIVER_FLAGS = ["driver_gene", "mut_driver", "lung_mut_driver", "CN_driver", "lung_CN_driver"]
COPY_NUMBER_SOURCE = _types(string=["tumour_id", "segment", "clone"], bigint=["pred_CN_A", "pred_CN_B"])
CLONE_FLAG_NAMES = {
    "mutation_cluster": "clone",
    "treeClones": "is_tree_clone",
    "seedingClones": "is_seeding_clone",
    "clonalClones": "is_clonal",
    "sharedClones": "is_shared",
    "primaryClones": "is_primary_clone",
    "metClones": "is_met_clone",
}
SEEDING_NAMES = {
    "seedingClonality": "seeding_clonality",
    "seedingPhyletic": "seeding_phyletic",
    "individualSeedingClonality": "individual_seeding_clonality",
    "individualSeedingPhyletic": "individual_seeding_phyletic",
    "nRegions": "n_regions",
}
CROSSWALK_NAMES = {"PatientID": "ltx_patient_id", "CRUK_ID": "cruk_patient_id"}
GENE_SOURCE_COLUMNS = [
    "bin", "name", "chrom", "strand", "txStart", "txEnd", "cdsStart", "cdsEnd", "exonCount",
    "exonStarts", "exonEnds", "score", "name2", "cdsStartStat", "cdsEndStat", "exonFrames",
]
BAND_SOURCE_COLUMNS = ["chrom", "chromStart", "chromEnd", "band_name", "gie_stain"]

_TREE_KEY = ForeignKey(("tumour_id", "clone"), "clone_tree", ("tumour_id", "clone"))
_PARENT_KEY = ForeignKey(("tumour_id", "parent"), "clone_tree", ("tumour_id", "clone"), open_ends=(VIRTUAL_ROOT,))
_PATIENT_KEY = ForeignKey(("patient_id",), "mutations", ("patient_id",))
_MUTATION_TYPES = {
    name: kind
    for name, kind in MUTATION_SOURCE.items()
    if name not in ("patient_tumour", "mutation_cluster", "var", "tumour_id")
}

CONTRACTS: dict[str, TableContract] = {
    c.name: c
    for c in [
        TableContract(
            "mutations",
            ("mutation_id", "sample_name_hash"),
            _types(
                string=["tumour_id", "clone", "chr", "ref", "alt", "mutation_id", "sample_name_hash"],
                int=["tumour_ordinal"],
                bigint=["start", "stop", "pos"],
            ),
            optional=_MUTATION_TYPES,
            required=("tumour_id", "tumour_ordinal", "chr", "pos"),
            allowed={"cluster_region_clonality": ("clonal", "subclonal")},
            formats={"tumour_id": CANONICAL_TUMOUR, "clone": "^clone", "chr": "^(?!chr)"},
            foreign_keys=(_TREE_KEY,),
        ),
        TableContract(
            "clone_tree",
            ("tumour_id", "clone"),
            {
                **CLONE_TREE_SOURCE,
                **_types(
                    boolean=["is_root", "is_wgd_event_clone", "has_wgd_ancestor"],
                    bigint=["cumulative_gds_to_clone"],
                ),
            },
            required=("is_root", "cumulative_gds_to_clone", "has_wgd_ancestor"),
            allowed={
                "quality": ("High", "Low"),
                "status": ("resolved", "unresolved", "needs_follow_up"),
                "class": ("clonal_wgd", "mut_supported", "ploidy_only", "no_wgd"),
                "sub_class": (
                    "parallel only",
                    "sequential only",
                    "parallel + sequential",
                    "single subclonal GD",
                ),
            },
            formats={"tumour_id": CANONICAL_TUMOUR, "clone": "^clone"},
            foreign_keys=(_PARENT_KEY, ForeignKey(("tumour_id",), "mutations", ("tumour_id",))),
        ),
        TableContract(
            "variant_scores",
            ("tumour_id", "chr", "pos", "alt"),
            _types(string=["tumour_id", "chr", "alt", "am_class"], bigint=["pos"], double=["am_pathogenicity"]),
            allowed={"am_class": ("benign", "ambiguous", "pathogenic")},
            formats={"tumour_id": CANONICAL_TUMOUR, "chr": "^(?!chr)"},
            bounds={"am_pathogenicity": (0.0, 1.0)},
            foreign_keys=(
                ForeignKey(("tumour_id", "chr", "pos", "alt"), "mutations", ("tumour_id", "chr", "pos", "alt")),
            ),
        ),
        TableContract(
            "clinical",
            ("Patient_ID",),
            {"Patient_ID": "string"},
            optional=CLINICAL_SOURCE,
            foreign_keys=(ForeignKey(("Patient_ID",), "mutations", ("patient_id",)),),
        ),
        TableContract(
            "clinical_per_tumour",
            ("Patient_ID", "tumour_ordinal"),
            _types(string=["Patient_ID", "tumour_id"], int=["tumour_ordinal"]),
            formats={"tumour_id": CANONICAL_TUMOUR},
        ),
        TableContract(
            "drivers",
            ("Hugo_Symbol",),
            {"Hugo_Symbol": "string", **{f: "boolean" for f in DRIVER_FLAGS}},
            allowed={"strand_hg38": ("+", "-")},
            formats={"chr_hg19": "^(?!chr)", "chr_hg38": "^(?!chr)"},
        ),
        TableContract(
            "copy_number",
            ("tumour_id", "segment", "clone"),
            {
                **COPY_NUMBER_SOURCE,
                **_types(
                    string=["segment_chr"],
                    bigint=["segment_start", "segment_end", "total_cn", "minor_cn", "major_cn"],
                    boolean=["is_homdel", "is_loh"],
                ),
            },
            formats={"segment_chr": "^(?!chr)"},
            foreign_keys=(_TREE_KEY,),
        ),
        TableContract(
            "expression",
            ("sample_name_hash", "gene_id"),
            _types(
                string=["sample_name_hash", "patient_id", "sample_type", "region_code", "gene_id"],
                boolean=["is_normal"],
                int=["tumour_ordinal", "region_ordinal"],
                double=["counts", "tpm"],
            ),
            required=("patient_id", "is_normal"),
            allowed={"sample_type": ("SU", "BS")},
            foreign_keys=(_PATIENT_KEY, ForeignKey(("patient_id",), "clinical", ("Patient_ID",))),
        ),
        TableContract(
            "paired_normals",
            ("patient_id", "gene_id"),
            _types(string=["patient_id", "gene_id", "normal_sample_name_hash"], double=["tpm_normal"]),
        ),
        TableContract(
            "clone_proportions",
            ("tumour_id", "clone", "sample_id"),
            _types(string=["tumour_id", "clone", "sample_id"], double=["proportion"]),
            formats={"tumour_id": CANONICAL_TUMOUR},
            bounds={"proportion": (0.0, 1.0 + 1e-9)},
            foreign_keys=(_TREE_KEY,),
        ),
        TableContract(
            "id_crosswalk",
            ("ltx_patient_id", "cruk_patient_id"),
            _types(string=["ltx_patient_id", "cruk_patient_id"]),
            formats={"ltx_patient_id": LTX_PATIENT, "cruk_patient_id": CRUK_PATIENT},
        ),
        TableContract(
            "clone_flags",
            ("tumour_id", "clone"),
            _types(
                string=["tumour_id", "clone"],
                boolean=[
                    "is_tree_clone", "is_seeding_clone", "is_clonal", "is_shared", "is_primary_clone", "is_met_clone",
                ],
            ),
            foreign_keys=(ForeignKey(("tumour_id",), "copy_number", ("tumour_id",)),),
        ),
        TableContract(
            "seeding",
            ("tumour_id",),
            _types(
                string=[
                    "tumour_id", "seeding_clonality", "seeding_phyletic", "individual_seeding_clonality",
                    "individual_seeding_phyletic",
                ],
                bigint=["n_regions"],
            ),
        ),
        TableContract(
            "gene_reference",
            ("gene_name", "chromosome"),
            _types(string=["gene_name", "chromosome", "strand", "cytoband_name"], bigint=["start", "end"]),
        ),
        TableContract(
            "mutations_hg38",
            ("mutation_id", "sample_name_hash"),
            _types(string=["mutation_id", "sample_name_hash", "tumour_id", "chr", "mutation_id_hg38"], bigint=["pos"]),
            optional=_MUTATION_TYPES,
            foreign_keys=(ForeignKey(("mutation_id",), "mutations", ("mutation_id",)),),
        ),
        TableContract(
            "region_ccf",
            ("tumour_id", "clone", "region"),
            _types(string=["tumour_id", "clone", "region"], int=["ccf"]),
        ),
        TableContract(
            "region_clonality",
            ("tumour_id", "clone", "region"),
            _types(string=["tumour_id", "clone", "region", "clonality"]),
            allowed={"clonality": ("clonal", "subclonal", "absent")},
        ),
    ]
}


def type_mismatches(df: DataFrame, contract: TableContract) -> list[str]:
    """Columns that are missing or have another type than promised."""
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {**{n: k for n, k in contract.optional.items() if n in found}, **contract.types}
    return [f"{name}: {found.get(name, 'missing')}, not {kind}" for name, kind in wanted.items() if found.get(name) != kind]


def null_rules(df: DataFrame, contract: TableContract) -> dict[str, Column]:
    """What a row must not have: a null in the key or in a required column."""
    return {f"{c} is null": F.col(c).isNull() for c in (*contract.key, *contract.required) if c in df.columns}


def contract_report(
    df: DataFrame, contract: TableContract, others: dict[str, DataFrame] | None = None
) -> DataFrame:
    """(check, n_rows, n_bad): every row rule in one pass, then key and foreign keys.

    ``n_bad`` counts rows for row rules, keys for the key rules and columns for ``column
    types``. A check ``has rows`` is bad for an empty table. Foreign keys are checked against
    the tables given. Rules on columns that are missing are left to ``column types``.
    """
    rules = null_rules(df, contract)
    for column, values in contract.allowed.items():
        rules[f"{column} allowed"] = ~F.col(column).isin(list(values))
    for column, pattern in contract.formats.items():
        rules[f"{column} format"] = ~F.col(column).rlike(pattern)
    for column, (low, high) in contract.bounds.items():
        rules[f"{column} bounds"] = ~F.col(column).between(low, high)
    rules = {name: rule for name, rule in rules.items() if name.rpartition(" ")[0].removesuffix(" is") in df.columns}
    report = violation_counts(df, rules)

    def one(check: str, n_bad: DataFrame) -> DataFrame:
        return n_bad.select(F.lit(check).alias("check"), F.lit(None).cast("bigint").alias("n_rows"), "n_bad")

    def counted(offenders: DataFrame) -> DataFrame:
        return offenders.agg(F.count(F.lit(1)).alias("n_bad"))

    rows = df.agg(F.count(F.lit(1)).alias("n_rows"))
    mismatches = F.lit(len(type_mismatches(df, contract))).cast("bigint")
    report = report.unionByName(
        rows.select(F.lit("has rows").alias("check"), "n_rows", (F.col("n_rows") == 0).cast("bigint").alias("n_bad"))
    ).unionByName(one("column types", rows.select(mismatches.alias("n_bad"))))
    if set(contract.key) <= set(df.columns):
        report = report.unionByName(one("key unique", counted(duplicate_keys(df, contract.key))))
    for fk in contract.foreign_keys:
        parent = df if fk.table == contract.name else (others or {}).get(fk.table)
        if parent is not None and set(fk.columns) <= set(df.columns) and set(fk.references) <= set(parent.columns):
            report = report.unionByName(one(f"{','.join(fk.columns)} in {fk.table}", counted(foreign_key_orphans(df, parent, fk))))
    return report


def foreign_key_orphans(df: DataFrame, parent: DataFrame, fk: ForeignKey) -> DataFrame:
    """The keys of ``df`` that point to no row of ``parent``."""
    pointing = df
    for column in fk.columns if fk.open_ends else ():
        pointing = pointing.where(~F.col(column).isin(list(fk.open_ends)))
    return orphans(pointing, parent, list(zip(fk.columns, fk.references, strict=True)))
