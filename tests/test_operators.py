import pytest
from pyspark.sql import functions as F

from clonarium.operators import aggregates, joins, quality, reshape
from clonarium.plans.contracts import CONTRACTS, contract_report, type_mismatches
from clonarium.plans.filters import filter_counts, filtered


def test_melt_keeps_empty_cells_and_dotted_names(spark, rows):
    wide = spark.createDataFrame([("g1", 1.0, None), ("g2", 3.0, 4.0)], "gene string, `a.1` double, `b c` double")
    expected = [("g1", "a.1", 1.0), ("g1", "b c", None), ("g2", "a.1", 3.0), ("g2", "b c", 4.0)]
    narrow = reshape.melt(wide, ["gene"], variable="s", value="v")
    assert rows(narrow) == sorted(expected, key=str)


def test_lesions(spark, rows):
    clinical = spark.createDataFrame(
        [("LTX1", "LUAD", None, 12.0), ("LTX8", "LUAD", "LUSC", None), ("LTX9", None, None, None)],
        "Patient_ID string, `histology1_central.reviewed` string, `histology2_central.reviewed` string, "
        "`SizePath_lesion1_central.reviewed` double",
    )
    tall = reshape.lesions_to_tumours(clinical)
    assert rows(tall, "Patient_ID", "tumour_ordinal", "histology", "size_path_mm", "pT_stage", "tumour_id") == [
        ("LTX1", 1, "LUAD", 12.0, None, "LTX1-Tumour1"),
        ("LTX8", 1, "LUAD", None, None, "LTX8-Tumour1"),
        ("LTX8", 2, "LUSC", None, None, "LTX8-Tumour2"),
    ]
    assert dict(tall.dtypes)["size_path_mm"] == "double"


def test_paired_lists_of_unequal_length(spark, rows):
    df = spark.createDataFrame([("T1", "a;b", "x;y"), ("T2", "c", "z;w"), ("T3", None, None)], "t string, p string, q string")
    assert rows(reshape.paired_lists_to_rows(df, {"p": "one", "q": "two"})) == [
        ("T1", 0, "a", "x"), ("T1", 1, "b", "y"), ("T2", 0, "c", "z"), ("T2", 1, None, "w"),
    ]


def test_matrix_to_rows(spark, rows):
    df = spark.createDataFrame(
        [("T1", ["1", "2"], ["R1", "R2"], [[1, 2], [3, None]])],
        "t string, clones array<string>, regions array<string>, m array<array<int>>",
    )
    long = reshape.matrix_to_rows(df, ["t"], "clones", "regions", "m", "clone", "region", "ccf")
    assert rows(long) == sorted(
        [("T1", "1", "R1", 1), ("T1", "1", "R2", 2), ("T1", "2", "R1", 3), ("T1", "2", "R2", None)], key=str
    )


def test_rename_may_swap(spark):
    df = spark.createDataFrame([(1, "LTX1_tumour1")], "tumour_id int, patient_tumour string")
    swapped = reshape.renamed(df, {"patient_tumour": "tumour_id", "tumour_id": "tumour_ordinal"})
    assert swapped.columns == ["tumour_ordinal", "tumour_id"]
    assert tuple(swapped.first()) == (1, "LTX1_tumour1")


def test_best_score_skips_nan_and_null(spark, rows):
    data = [("T", "1", 5, "A", 0.2, None), ("T", "1", 5, "A", float("nan"), "benign"), ("T", "1", 5, "A", 0.3, "benign"),
            ("T", "1", 6, "A", float("nan"), None), ("T", "1", 6, "A", None, None)]
    df = spark.createDataFrame(data, "tumour_id string, chr string, pos long, alt string, am_pathogenicity double, am_class string")
    assert rows(aggregates.best_score_per_variant(df)) == [
        ("T", "1", 5, "A", 0.3, "benign"), ("T", "1", 6, "A", None, None),
    ]


def test_gene_extent_takes_first_strand(spark):
    df = spark.createDataFrame(
        [("G", "chr1", 5, 9, "+", 2), ("G", "chr1", 3, 7, "-", 1), ("G", "chrX", 1, 2, "+", 3)],
        "gene_name string, chromosome string, tx_start long, tx_end long, strand string, line_no long",
    )
    got = {tuple(r) for r in aggregates.gene_extents(df).collect()}
    assert got == {("G", "chr1", 3, 9, "-"), ("G", "chrX", 1, 2, "+")}


def test_bands_per_gene(spark, rows):
    genes = spark.createDataFrame(
        [("G1", "chr1", 5, 25, "+"), ("G2", "chr1", 10, 20, "+"), ("G3", "chr2", 5, 6, "-")],
        "gene_name string, chromosome string, start long, end long, strand string",
    )
    bands = spark.createDataFrame(
        [("chr1", 0, 10, "p2"), ("chr1", 10, 20, "p1"), ("chr1", 20, 30, "p2"), ("chr1", 30, 40, "q1")],
        "chromosome string, band_start long, band_end long, band_name string",
    )
    assert rows(joins.bands_per_gene(genes, bands), "gene_name", "cytoband_name") == [
        ("G1", "p1;p2"), ("G2", "p1"), ("G3", ""),
    ]


def test_convention(spark, rows):
    crosswalk = spark.createDataFrame(
        [("LTX0004", "CRUK0022"), ("LTX0008", "CRUK0192")], "ltx_patient_id string, cruk_patient_id string"
    )
    df = spark.createDataFrame([("LTX0004_1", 1), ("CRUK0192-Cluster2", 2), (None, 3)], "tumour_id string, n int")
    assert rows(joins.with_convention(df, crosswalk, "cruk"), "tumour_id", "n") == [
        (None, 3), ("CRUK0022_1", 1), ("CRUK0192_2", 2),
    ]
    assert rows(joins.with_convention(df, crosswalk, "ltx"), "tumour_id", "n") == [
        (None, 3), ("LTX0004-Tumour1", 1), ("LTX0008-Tumour2", 2),
    ]
    unknown = spark.createDataFrame([("LTX0009_1",)], "tumour_id string")
    assert rows(joins.with_convention(unknown, crosswalk, "ltx")) == [("LTX0009-Tumour1",)]
    with pytest.raises(Exception, match="patient not in crosswalk: LTX0009"):
        joins.with_convention(unknown, crosswalk, "cruk").collect()
    assert rows(joins.patients_missing_from(unknown, crosswalk, "cruk")) == [("LTX0009",)]
    with pytest.raises(ValueError, match="convention"):
        joins.with_convention(df, crosswalk, "other")
    with pytest.raises(Exception, match="not a CRUK id"):
        joins.cruk_to_ltx(df, crosswalk).collect()
    with pytest.raises(Exception, match="not a LTX id"):
        joins.ltx_to_cruk(df, crosswalk).collect()


def test_expression_from_either_form(spark, rows):
    a, b = "LTX0004_SU_T1-R1--0a", "LTX0004_SU_N01--0b"
    counts = spark.createDataFrame([("g1", 1.0, None), ("g2", 3.0, 4.0)], f"gene_id string, `{a}` double, `{b}` double")
    tpm = spark.createDataFrame([("g2", 30.0, 40.0), ("g1", 10.0, 20.0)], f"gene_id string, `{b}` double, `{a}` double")
    wide = joins.expression_from_matrices(counts, tpm)
    long = joins.expression_table(
        reshape.melt(counts, ["gene_id"], None, "sample_name_hash", "counts"),
        reshape.melt(tpm, ["gene_id"], None, "sample_name_hash", "tpm"),
    )
    assert wide.columns == long.columns
    assert rows(wide) == rows(long)
    assert rows(wide, "gene_id", "is_normal", "counts", "tpm") == [
        ("g1", False, 1.0, 20.0), ("g1", True, None, 10.0), ("g2", False, 3.0, 40.0), ("g2", True, 4.0, 30.0),
    ]
    assert rows(aggregates.paired_normals(wide)) == [("LTX0004", "g1", 10.0, b), ("LTX0004", "g2", 30.0, b)]
    with pytest.raises(quality.CheckFailed, match="samples"):
        joins.expression_from_matrices(counts, tpm.drop(b))
    with pytest.raises(quality.CheckFailed, match="gene_id"):
        joins.expression_from_matrices(counts, tpm.where("gene_id = 'g1'"))


def test_driver_flags_default_to_false(spark, rows):
    genes = spark.createDataFrame([("TP53",), ("ABC",)], "gene_name string")
    drivers = spark.createDataFrame([("TP53", True, None)], "Hugo_Symbol string, mut_driver boolean, CN_driver boolean")
    assert rows(joins.genes_with_driver_flags(genes, drivers, ["mut_driver", "CN_driver"])) == [
        ("ABC", False, False), ("TP53", True, False),
    ]


def test_scores_join_on_pos_not_start(spark, rows):
    mutations = spark.createDataFrame(
        [("T", "1", 99, 100, "-"), ("T", "1", 50, 50, "A")], "tumour_id string, chr string, pos long, start long, alt string"
    )
    scores = spark.createDataFrame([("T", "1", 99, "-", 0.5)], "tumour_id string, chr string, pos long, alt string, s double")
    assert rows(joins.mutations_with_scores(mutations, scores), "pos", "s") == [(50, None), (99, 0.5)]


def test_clone_summaries(spark, rows):
    cp = spark.createDataFrame(
        [("T", "clone1", "s1", 1.0), ("T", "clone1", "s2", 0.96), ("T", "clone2", "s1", 0.0), ("T", "clone2", "s2", 0.04)],
        "tumour_id string, clone string, sample_id string, proportion double",
    )
    assert rows(aggregates.present_clones(cp)) == [("T", "clone1", 1.0)]
    assert [r[3] for r in rows(aggregates.composition(cp))] == [True, True]
    flags = spark.createDataFrame(
        [("T2", "clone1", True, True, False), ("T1", "clone1", True, True, True), ("T1", "clone2", False, None, False)],
        "tumour_id string, clone string, is_tree_clone boolean, is_primary_clone boolean, is_met_clone boolean",
    )
    assert [r[0] for r in aggregates.cohort_tumours(flags, "primary").collect()] == ["T1", "T2"]
    assert [r[0] for r in aggregates.cohort_tumours(flags, "mets").collect()] == ["T1"]
    with pytest.raises(ValueError, match="cohort"):
        aggregates.cohort_tumours(flags, "other")
    assert tuple(aggregates.non_tree_clones(flags).first()) == (3, 1)


def test_checks_find_offenders(spark, rows):
    df = spark.createDataFrame(
        [("LTX1", "a;b", 2, "x"), ("LTX1", "a", 2, "y"), ("bad", None, 1, None), (None, "a", None, "x")],
        "id string, list string, n int, v string",
    )
    assert rows(quality.duplicate_keys(df, ["id"])) == [("LTX1", 2)]
    assert rows(quality.malformed(df, "id", r"^LTX\d+$"), "id") == [("bad",)]
    assert rows(quality.malformed(df, "id", r"^LTX\d+$", null_is_bad=True), "id") == [(None,), ("bad",)]
    assert rows(quality.list_length_mismatch(df, ["list"], "n"), "id", "list") == [("LTX1", "a")]
    assert rows(quality.unexpected_values(df, "v", ["x"])) == [("y", 1)]
    parents = spark.createDataFrame([("LTX1",)], "pid string")
    assert rows(quality.orphans(df, parents, [("id", "pid")])) == [("bad",)]
    other = parents.withColumnRenamed("pid", "id").union(spark.createDataFrame([("new",)], "id string"))
    assert rows(quality.key_set_difference(df.dropna(), other, ["id"])) == [("new", "right_only")]
    assert rows(quality.shared_key_count(df, other, ["id"])) == [(1,)]
    assert rows(quality.varying_within(df, ["id"], ["v"]), "id") == [("LTX1",)]
    with pytest.raises(quality.CheckFailed, match="LTX1"):
        quality.require_none(quality.duplicate_keys(df, ["id"]), "duplicates")
    with pytest.raises(quality.CheckFailed, match="missing_one"):
        quality.require_columns(df, ["id", "missing_one"])
    numbers = spark.createDataFrame([(0.5,), (1.5,), (-0.1,), (float("nan"),), (None,)], "p double")
    assert quality.outside_bounds(numbers, "p", 0.0, 1.0).count() == 3
    totals = spark.createDataFrame([("a", 1, 3), ("a", 2, 3), ("b", 1, 3)], "k string, g int, t int")
    assert rows(quality.sum_mismatch(totals, ["k"], "g", "t"), "k") == [("b",)]


def test_contract_report(spark):
    tree = spark.createDataFrame([("LTX1-Tumour1", "clone1")], "tumour_id string, clone string")
    cp = spark.createDataFrame(
        [("LTX1-Tumour1", "clone1", "s", 0.5), ("LTX1-Tumour1", "clone1", "s", 2.0), ("LTX2_1", "clone1", None, None)],
        "tumour_id string, clone string, sample_id string, proportion double",
    )
    contract = CONTRACTS["clone_proportions"]
    report = {r.check: r.n_bad for r in contract_report(cp, contract, {"clone_tree": tree}).collect()}
    assert report == {
        "tumour_id is null": 0, "clone is null": 0, "sample_id is null": 1, "tumour_id format": 1,
        "proportion bounds": 1, "has rows": 0, "column types": 0, "key unique": 1, "tumour_id,clone in clone_tree": 1,
    }
    assert type_mismatches(cp, contract) == []
    assert type_mismatches(cp.drop("clone").withColumn("proportion", F.lit("x")), contract) == [
        "clone: missing, not string", "proportion: string, not double",
    ]
    empty = {r.check: r.n_bad for r in contract_report(cp.limit(0), contract).collect()}
    assert empty["has rows"] == 1 and empty["proportion bounds"] == 0


def test_filters_are_pushed_to_the_scan(spark, tmp_path):
    cn = spark.createDataFrame([(0, 0), (0, 2), (2, 3), (1, 1)], "pred_CN_A int, pred_CN_B int")
    assert {r["filter"]: r.n_rows for r in filter_counts(cn, "copy_number").collect()} == {
        "homdel": 1, "loh": 1, "amplified": 1, "diploid_heterozygous": 1,
    }
    path = str(tmp_path / "cn")
    cn.write.parquet(path)
    plan = filtered(spark.read.parquet(path), "copy_number", "homdel")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(pred_CN_A,0)" in plan


def test_least_text_sorts_no_rows(spark):
    df = spark.createDataFrame([(1, "b"), (1, None), (1, "a"), (2, None), (3, "10"), (3, "9")], "k int, t string")
    found = df.groupBy("k").agg(aggregates.least_text(F.col("t")).alias("t"))
    assert "Sort" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.collect())) == [(1, "a"), (2, None), (3, "10")]
