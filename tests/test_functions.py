import math

import pytest
from pyspark.sql import functions as F

from clonarium.functions import clones, genome, ids, labels


def values(spark, data, kind, expr):
    """The expression over column v, in input order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", expr(F.col("v"))).orderBy("i").collect()]


def test_lenient_id_leaves_unknown_forms(spark):
    data = ["LTX0001-Tumour1", "LTX0001_tumour01", "LTX0001_TUMOUR1", "CRUK1_1", "x", None]
    assert values(spark, data, "string", ids.canonical_tumour_id) == [
        "LTX0001-Tumour1", "LTX0001-Tumour01", "LTX0001_TUMOUR1", "CRUK1_1", "x", None,
    ]


def test_strict_id(spark):
    data = ["LTX0001-Tumour1", "LTX0001_Tumour02", "LTX0001_tumour1", None]
    assert values(spark, data, "string", ids.strict_tumour_id) == [
        "LTX0001-Tumour1", "LTX0001-Tumour2", "LTX0001-Tumour1", None,
    ]
    with pytest.raises(Exception, match="unrecognised tumour id"):
        values(spark, ["LTX0001_1"], "string", ids.strict_tumour_id)


def test_parse_all_spellings(spark):
    data = [
        "LTX0001-Tumour1", "LTX0002-Cluster2", "LTX0003_TumouR03", "ltx0003_tumour3", "LTX0004_4",
        "CRUK0005-Tumour5", "CRUK0006-Cluster6", "CRUK0007_7", None,
    ]
    got = values(spark, data, "string", ids.parse_tumour_id)
    assert [tuple(g) for g in got] == [
        ("LTX0001", 1), ("LTX0002", 2), ("LTX0003", 3), ("ltx0003", 3), ("LTX0004", 4),
        ("CRUK0005", 5), ("CRUK0006", 6), ("CRUK0007", 7), (None, None),
    ]


@pytest.mark.parametrize("bad", ["LTX1", "CRUK1_tumour1", "LTX1-tumour1", "LTX1__1", "xLTX1_1", "LTX1_1x", "ltx1_1"])
def test_parse_rejects(spark, bad):
    with pytest.raises(Exception, match="unrecognised tumour id"):
        values(spark, [bad], "string", ids.parse_tumour_id)
    loose = values(spark, [bad], "string", lambda c: ids.parse_tumour_id(c, strict=False))
    assert tuple(loose[0]) == (None, None)


def test_parts_of_canonical_id(spark):
    assert values(spark, ["LTX0001-Tumour2", None], "string", ids.patient_of) == ["LTX0001", None]
    assert values(spark, ["LTX0001-Tumour2", None], "string", ids.ordinal_of) == [2, None]
    for part in (ids.patient_of, ids.ordinal_of):
        with pytest.raises(Exception, match="not a canonical tumour id"):
            values(spark, ["LTX0001_2"], "string", part)


def test_build_tumour_id_propagates_null(spark):
    df = spark.createDataFrame([("LTX1", 2), (None, 1), ("LTX1", None)], "p string, o int")
    built = [r[0] for r in df.select(ids.build_tumour_id(F.col("p"), F.col("o"))).collect()]
    assert built == ["LTX1-Tumour2", None, None]


def test_sample_names(spark):
    data = [
        "LTX0004_SU_T1-R2--00ff", "LTX0004_SU_N01--00ff", "LTX0004_BS_GL--00ff", "LTX0004_SU_T1-Rx--00ff",
        "LTX0004_SU_Tx-R1--00ff", "LTX0004_SU_T1-R1--XYZ", None,
    ]
    got = [tuple(v) for v in values(spark, data, "string", ids.parse_sample_name)]
    assert got == [
        ("LTX0004", "SU", "T1-R2", False, 1, 2),
        ("LTX0004", "SU", "N01", True, None, None),
        ("LTX0004", "BS", "GL", False, None, None),
        ("LTX0004", "SU", "T1-Rx", False, 1, None),
        ("LTX0004", "SU", "Tx-R1", False, None, None),
        (None,) * 6,
        (None,) * 6,
    ]


def test_trim_unicode_space(spark):
    assert values(spark, [" \t LTX1 \r\n", None], "string", ids.trimmed) == ["LTX1", None]


def test_clone_labels(spark):
    assert values(spark, [1.0, 2.9, math.nan, None], "double", clones.clone_from_number) == [
        "clone1", "clone2", None, None,
    ]
    assert values(spark, [3, None], "int", clones.clone_from_number) == ["clone3", None]
    text = ["clone7", "1", "1.0", "1e1", None]
    assert values(spark, text, "string", clones.clone_from_text) == [
        "clone7", "clone1", "clone1", "clone10", None,
    ]
    strict = lambda c: clones.clone_from_text(c, null_fails=True)
    assert values(spark, [" 4 ", " clone4"], "string", strict) == ["clone4", "clone4"]
    for bad in ("x", "nan", "1d", ""):
        with pytest.raises(Exception, match="not a clone label"):
            values(spark, [bad], "string", clones.clone_from_text)
    with pytest.raises(Exception, match="clone label is missing"):
        values(spark, [None], "string", strict)
    assert values(spark, ["1", "clone1", None], "string", clones.clone_prefixed) == ["clone1", "clone1", None]


def test_chromosomes(spark):
    data = ["chr17", "17", "chrX", "M", "chrM", "MT", "chrUn_1", None]
    assert values(spark, data, "string", genome.canonical_chromosome) == [
        "17", "17", "X", "MT", "MT", "MT", "Un_1", None,
    ]
    kept = values(spark, ["chr1", "chr22", "chr23", "chrM", "chr1_random", "1"], "string", genome.on_primary_assembly)
    assert kept == [True, True, False, True, False, False]


def test_segments(spark):
    data = ["chr1_10_20", "X_1_2_extra", "3_5", None]
    got = [tuple(v) for v in values(spark, data, "string", genome.parse_segment)]
    assert got == [("1", 10, 20), ("X", 1, 2), ("3", 5, None), (None, None, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, ["1_a_2"], "string", genome.parse_segment)


def test_copy_number_summary_with_nulls(spark):
    df = spark.createDataFrame([(0, 0), (0, 2), (2, 3), (None, 0), (None, 1)], "a int, b int")
    got = df.select(*genome.copy_number_summary(F.col("a"), F.col("b")).values()).collect()
    assert [tuple(r) for r in got] == [
        (0, 0, 0, True, False), (2, 0, 2, False, True), (5, 2, 3, False, False),
        (None, 0, 0, None, None), (None, 1, 1, False, False),
    ]


def test_score_classes(spark):
    data = [0.0, 0.3399, 0.34, 0.564, 0.5641, 1.0, math.nan, None]
    assert values(spark, data, "double", genome.score_class) == [
        "benign", "benign", "ambiguous", "ambiguous", "pathogenic", "pathogenic", None, None,
    ]


def test_allele_fraction_without_coverage(spark):
    df = spark.createDataFrame([(1, 4), (0, 0), (None, 4)], "v int, c int")
    got = [r[0] for r in df.select(genome.allele_fraction(F.col("v"), F.col("c"))).collect()]
    assert got == [0.25, None, None]


def test_rebuilt_mutation_id(spark):
    df = spark.createDataFrame(
        [("LTX1_1:3:7:A:-", "4", 9, "A", "-"), ("LTX1_1:3:7:A:T", None, None, "A", "T")],
        "m string, c string, p long, r string, a string",
    )
    new = genome.rebuilt_mutation_id(*[F.col(c) for c in "mcpra"])
    assert [r[0] for r in df.select(new).collect()] == ["LTX1_1:4:9:A:-", None]


def test_boolean_text(spark):
    data = ["TRUE", "false", "T", "f", "1", "0", "yes", "", None]
    assert values(spark, data, "string", labels.strict_boolean) == [True, False] + [None] * 7
    assert values(spark, data, "string", labels.lenient_boolean) == [
        True, False, True, False, True, False, None, None, None,
    ]


def test_label_map_is_case_sensitive(spark):
    data = ["Likely benign", "Likely pathogenic", "ambiguous", "likely benign", "not_classified", None]
    mapped = values(spark, data, "string", lambda c: labels.mapped_label(c, labels.PATHOGENICITY_LABELS))
    assert mapped == ["benign", "pathogenic", "ambiguous", None, None, None]
