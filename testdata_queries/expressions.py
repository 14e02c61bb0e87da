"""Identifiers, clone labels, loci and labels, on values minted from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from clonarium.functions import clones, genome, ids, labels
from clonarium.operators import joins
from clonarium.operators.reshape import renamed
from testdata_queries.registry import query


@query("""
    WITH minted AS (
      SELECT c_custkey, CASE c_custkey % 5
        WHEN 0 THEN 'LTX' || c_custkey || '-Tumour' || (c_custkey % 3)
        WHEN 1 THEN 'LTX' || c_custkey || '_tumour' || (c_custkey % 3)
        WHEN 2 THEN 'LTX' || c_custkey || '_TUMOUR' || (c_custkey % 3)
        WHEN 3 THEN 'CRUK' || c_custkey || '_' || (c_custkey % 3) END AS raw_id
      FROM customer)
    SELECT c_custkey, raw_id, CASE WHEN c_custkey % 5 = 1
        THEN 'LTX' || c_custkey || '-Tumour' || (c_custkey % 3) ELSE raw_id END AS tumour_id
    FROM minted
""")
def id_canonical_lenient(t):
    raw = F.expr("""CASE c_custkey % 5
        WHEN 0 THEN 'LTX' || c_custkey || '-Tumour' || (c_custkey % 3)
        WHEN 1 THEN 'LTX' || c_custkey || '_tumour' || (c_custkey % 3)
        WHEN 2 THEN 'LTX' || c_custkey || '_TUMOUR' || (c_custkey % 3)
        WHEN 3 THEN 'CRUK' || c_custkey || '_' || (c_custkey % 3) END""")
    return t.customer.select("c_custkey", raw.alias("raw_id")).withColumn(
        "tumour_id", ids.canonical_tumour_id(F.col("raw_id"))
    )


@query("""
    SELECT c_custkey, 'LTX' || c_custkey || '-Tumour' || (c_custkey % 3) AS tumour_id FROM customer
""")
def id_canonical_strict(t):
    raw = F.expr("""CASE c_custkey % 3
        WHEN 0 THEN 'LTX' || c_custkey || '-Tumour' || (c_custkey % 3)
        WHEN 1 THEN 'LTX' || c_custkey || '_tumour' || (c_custkey % 3)
        ELSE 'LTX' || c_custkey || '_TUMOUR0' || (c_custkey % 3) END""")
    return t.customer.select("c_custkey", ids.strict_tumour_id(raw).alias("tumour_id"))


# The seven accepted spellings, by row.
_SPELLINGS = """CASE {n} % 7
    WHEN 0 THEN 'LTX' || {p} || '-Tumour' || {o}  WHEN 1 THEN 'LTX' || {p} || '-Cluster' || {o}
    WHEN 2 THEN 'LTX' || {p} || '_tumour' || {o}  WHEN 3 THEN 'LTX' || {p} || '_' || {o}
    WHEN 4 THEN 'CRUK' || {q} || '-Tumour' || {o} WHEN 5 THEN 'CRUK' || {q} || '-Cluster' || {o}
    ELSE 'CRUK' || {q} || '_' || {o} END"""


@query(f"""
    WITH minted AS (
      SELECT o_orderkey, {_SPELLINGS.format(n="o_orderkey", p="o_custkey", q="o_custkey", o="(o_orderkey % 4)")} AS raw_id
      FROM orders)
    SELECT o_orderkey, regexp_extract(raw_id, '^([A-Z]+[0-9]+)', 1) AS patient,
           CAST(regexp_extract(raw_id, '([0-9]+)$', 1) AS BIGINT) AS ordinal
    FROM minted
""")
def id_parse(t):
    raw = F.expr(_SPELLINGS.format(n="o_orderkey", p="o_custkey", q="o_custkey", o="(o_orderkey % 4)"))
    return t.orders.select("o_orderkey", ids.parse_tumour_id(raw).alias("id")).select("o_orderkey", "id.*")


@query("""
    SELECT o_orderkey, 'LTX' || o_custkey AS patient, CAST(o_orderkey % 4 AS BIGINT) AS ordinal,
           'LTX' || o_custkey || '-Tumour' || (o_orderkey % 4) AS rebuilt
    FROM orders
""")
def id_parts_and_build(t):
    tumour_id = F.concat(F.lit("LTX"), "o_custkey", F.lit("-Tumour"), F.col("o_orderkey") % 4)
    parts = t.orders.select(
        "o_orderkey",
        ids.patient_of(tumour_id).alias("patient"),
        ids.ordinal_of(tumour_id).alias("ordinal"),
    )
    return parts.withColumn("rebuilt", ids.build_tumour_id(F.col("patient"), F.col("ordinal")))


def _crosswalk(t):
    return t.customer.select(
        F.concat(F.lit("LTX"), "c_custkey").alias("ltx_patient_id"),
        F.concat(F.lit("CRUK"), F.col("c_custkey") * 2 + 1).alias("cruk_patient_id"),
    )


def _tumours(t):
    """Orders as tumours of either id family, in all seven spellings."""
    spelled = _SPELLINGS.format(
        n="o_orderkey", p="o_custkey", q="(o_custkey * 2 + 1)", o="(o_orderkey % 4)"
    )
    return t.orders.select("o_orderkey", F.expr(spelled).alias("tumour_id"))


@query("SELECT o_orderkey, 'LTX' || o_custkey || '-Tumour' || (o_orderkey % 4) AS tumour_id FROM orders")
def id_apply_convention(t):
    return joins.with_convention(_tumours(t), _crosswalk(t), "ltx")


@query("""
    SELECT o_orderkey, 'LTX' || o_custkey || '-Tumour' || (o_orderkey % 4) AS tumour_id
    FROM orders WHERE o_orderkey % 7 >= 4
""")
def id_cruk_to_ltx(t):
    cruk = _tumours(t).where(F.col("tumour_id").startswith("CRUK"))
    return joins.cruk_to_ltx(cruk, _crosswalk(t))


@query("""
    SELECT o_orderkey, 'CRUK' || (o_custkey * 2 + 1) || '_' || (o_orderkey % 4) AS tumour_id
    FROM orders WHERE o_orderkey % 7 < 4
""")
def id_ltx_to_cruk(t):
    ltx = _tumours(t).where(F.col("tumour_id").startswith("LTX"))
    return joins.ltx_to_cruk(ltx, _crosswalk(t))


@query("""
    SELECT DISTINCT 'CRUK' || (o_custkey * 2 + 1) AS patient FROM orders
    WHERE o_orderkey % 7 >= 4 AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 5000)
""")
def crosswalk_missing_patients(t):
    known = t.customer.where("c_acctbal < 5000").select("c_custkey")
    partial = known.select(
        F.concat(F.lit("LTX"), "c_custkey").alias("ltx_patient_id"),
        F.concat(F.lit("CRUK"), F.col("c_custkey") * 2 + 1).alias("cruk_patient_id"),
    )
    return joins.patients_missing_from(_tumours(t), partial, "ltx")


@query("""
    SELECT CASE WHEN l_linenumber > 2 THEN 'clone' || CAST(l_quantity AS BIGINT) END AS clone,
           count(*) AS n_rows
    FROM lineitem GROUP BY 1
""")
def clone_label(t):
    number = F.expr(
        "CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN double('NaN') ELSE l_quantity + 0.25 END"
    )
    return t.lineitem.select(clones.clone_from_number(number).alias("clone")).groupBy("clone").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query("""
    SELECT CASE WHEN l_linenumber > 1 THEN 'clone' || CAST(l_quantity AS BIGINT) END AS clone,
           count(*) AS n_rows
    FROM lineitem GROUP BY 1
""")
def clone_label_mixed(t):
    text = F.expr("""CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN 'clone' || bigint(l_quantity)
        WHEN 3 THEN string(bigint(l_quantity)) ELSE string(l_quantity) END""")
    return t.lineitem.select(clones.clone_from_text(text).alias("clone")).groupBy("clone").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query("SELECT 'clone' || l_linenumber AS clone, count(*) AS n_rows FROM lineitem GROUP BY 1")
def clone_prefix(t):
    text = F.expr("if(l_orderkey % 2 = 0, 'clone', '') || l_linenumber")
    return t.lineitem.select(clones.clone_prefixed(text).alias("clone")).groupBy("clone").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query("""
    WITH numbered AS (SELECT l_suppkey % 28 AS n, l_orderkey % 2 = 0 AS prefixed FROM lineitem),
    named AS (SELECT CASE WHEN n BETWEEN 1 AND 22 THEN CAST(n AS VARCHAR) WHEN n = 23 THEN 'X'
                          WHEN n = 24 THEN 'Y' WHEN n = 25 THEN 'MT' ELSE 'Un_' || n END AS chr,
                     n BETWEEN 1 AND 25 AND prefixed AS on_primary FROM numbered)
    SELECT chr, on_primary, count(*) AS n_rows FROM named GROUP BY chr, on_primary
""")
def chrom_canonical(t):
    raw = F.expr("""if(l_orderkey % 2 = 0, 'chr', '') || CASE
        WHEN l_suppkey % 28 BETWEEN 1 AND 22 THEN string(l_suppkey % 28)
        WHEN l_suppkey % 28 = 23 THEN 'X' WHEN l_suppkey % 28 = 24 THEN 'Y'
        WHEN l_suppkey % 28 = 25 THEN 'M' ELSE 'Un_' || (l_suppkey % 28) END""")
    return (
        t.lineitem.select(raw.alias("raw"))
        .select(
            genome.canonical_chromosome(F.col("raw")).alias("chr"),
            genome.on_primary_assembly(F.col("raw")).alias("on_primary"),
        )
        .groupBy("chr", "on_primary")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


_BOOLEAN_TEXT = """CASE {k} % 8 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'false' WHEN 2 THEN 'T'
    WHEN 3 THEN '1' WHEN 4 THEN 'f' WHEN 5 THEN '0' WHEN 6 THEN 'maybe' END"""


@query(f"""
    SELECT {_BOOLEAN_TEXT.format(k="l_orderkey")} AS raw, l_returnflag,
           count(CASE WHEN l_orderkey % 8 = 0 THEN 1 END) AS n_true,
           count(CASE WHEN l_orderkey % 8 = 1 THEN 1 END) AS n_false
    FROM lineitem GROUP BY 1, 2
""")
def bool_strict(t):
    return _boolean_counts(t, labels.strict_boolean)


@query(f"""
    SELECT {_BOOLEAN_TEXT.format(k="l_orderkey")} AS raw, l_returnflag,
           count(CASE WHEN l_orderkey % 8 IN (0, 2, 3) THEN 1 END) AS n_true,
           count(CASE WHEN l_orderkey % 8 IN (1, 4, 5) THEN 1 END) AS n_false
    FROM lineitem GROUP BY 1, 2
""")
def bool_lenient(t):
    return _boolean_counts(t, labels.lenient_boolean)


def _boolean_counts(t, read):
    raw = F.expr(_BOOLEAN_TEXT.format(k="l_orderkey")).alias("raw")
    return (
        t.lineitem.select(raw, "l_returnflag")
        .withColumn("flag", read(F.col("raw")))
        .groupBy("raw", "l_returnflag")
        .agg(F.count_if("flag").alias("n_true"), F.count_if(~F.col("flag")).alias("n_false"))
    )


_SCORE_TEXT = """CASE {k} % 7 WHEN 0 THEN 'Likely benign' WHEN 1 THEN 'Likely pathogenic'
    WHEN 2 THEN 'ambiguous' WHEN 3 THEN 'benign' WHEN 4 THEN 'pathogenic'
    WHEN 5 THEN 'not_classified' ELSE 'likely benign' END"""


@query(f"""
    SELECT {_SCORE_TEXT.format(k="l_partkey")} AS raw,
           CASE WHEN l_partkey % 7 IN (0, 3) THEN 'benign' WHEN l_partkey % 7 IN (1, 4) THEN 'pathogenic'
                WHEN l_partkey % 7 = 2 THEN 'ambiguous' END AS am_class,
           count(*) AS n_rows
    FROM lineitem GROUP BY 1, 2
""")
def label_map(t):
    raw = F.expr(_SCORE_TEXT.format(k="l_partkey")).alias("raw")
    return (
        t.lineitem.select(raw)
        .withColumn("am_class", labels.mapped_label(F.col("raw"), labels.PATHOGENICITY_LABELS))
        .groupBy("raw", "am_class")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query("""
    SELECT p_partkey, CAST(p_size % 24 AS VARCHAR) AS chr, p_partkey * 50 AS seg_start,
           CASE WHEN p_partkey % 4 = 3 THEN -1 ELSE p_partkey * 50 + p_size END AS seg_end
    FROM part
""")
def segment_parse(t):
    text = F.expr("""if(p_partkey % 2 = 0, 'chr', '') || (p_size % 24) || '_' || (p_partkey * 50) ||
        CASE p_partkey % 4 WHEN 3 THEN '' WHEN 2 THEN '_' || (p_partkey * 50 + p_size) || '_extra'
        ELSE '_' || (p_partkey * 50 + p_size) END""")
    parsed = t.part.select("p_partkey", genome.parse_segment(text).alias("s"))
    return parsed.select(
        "p_partkey",
        F.col("s.chr").alias("chr"),
        F.col("s.start").alias("seg_start"),
        F.coalesce("s.end", F.lit(-1)).alias("seg_end"),
    )


@query("""
    WITH cn AS (SELECT CASE WHEN p_partkey % 11 <> 0 THEN CAST(p_size % 3 AS BIGINT) END AS a,
                       CASE WHEN p_partkey % 13 <> 0 THEN CAST(p_size % 4 AS BIGINT) END AS b FROM part),
    s AS (SELECT a + b AS total_cn, least(a, b) AS minor_cn, greatest(a, b) AS major_cn,
                 a = 0 AND b = 0 AS is_homdel, least(a, b) = 0 AND a + b > 0 AS is_loh FROM cn)
    SELECT coalesce(total_cn, -1) AS total_cn, coalesce(minor_cn, -1) AS minor_cn,
           coalesce(major_cn, -1) AS major_cn, is_homdel, is_loh, count(*) AS n_rows
    FROM s GROUP BY ALL
""")
def cn_summaries(t):
    alleles = t.part.selectExpr(
        "if(p_partkey % 11 <> 0, bigint(p_size % 3), null) AS a",
        "if(p_partkey % 13 <> 0, bigint(p_size % 4), null) AS b",
    )
    summary = genome.copy_number_summary(F.col("a"), F.col("b"))
    numbers = ("total_cn", "minor_cn", "major_cn")
    return (
        alleles.select(
            *[F.coalesce(summary[n], F.lit(-1)).alias(n) for n in numbers],
            summary["is_homdel"].alias("is_homdel"),
            summary["is_loh"].alias("is_loh"),
        )
        .groupBy(*numbers, "is_homdel", "is_loh")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query("""
    WITH k AS (SELECT o_orderkey, o_custkey, o_orderkey % 6 AS form, o_orderkey % 3 + 1 AS tn,
                      o_orderkey % 5 + 1 AS rn FROM orders)
    SELECT o_orderkey,
      CASE WHEN form < 5 THEN 'LTX' || o_custkey END AS patient_id,
      CASE WHEN form = 1 THEN 'BS' WHEN form < 5 THEN 'SU' END AS sample_type,
      CASE WHEN form = 0 THEN 'T' || tn || '-R' || rn WHEN form = 1 THEN 'GL' WHEN form = 2 THEN 'N01'
           WHEN form = 3 THEN 'T' || tn || '-Rx' WHEN form = 4 THEN 'Tx-R' || rn END AS region_code,
      CASE WHEN form < 5 THEN form = 2 END AS is_normal,
      CASE WHEN form IN (0, 3) THEN tn ELSE -1 END AS tumour_ordinal,
      CASE WHEN form = 0 THEN rn ELSE -1 END AS region_ordinal
    FROM k
""")
def sample_name_parse(t):
    name = F.expr("""'LTX' || o_custkey || CASE o_orderkey % 6
        WHEN 0 THEN '_SU_T' || (o_orderkey % 3 + 1) || '-R' || (o_orderkey % 5 + 1) || '--0aff'
        WHEN 1 THEN '_BS_GL--77'
        WHEN 2 THEN '_SU_N01--beef'
        WHEN 3 THEN '_SU_T' || (o_orderkey % 3 + 1) || '-Rx--00'
        WHEN 4 THEN '_SU_Tx-R' || (o_orderkey % 5 + 1) || '--00'
        ELSE '_SU_T1-R1--XYZ' END""")
    parsed = t.orders.select("o_orderkey", ids.parse_sample_name(name).alias("s")).select("o_orderkey", "s.*")
    return parsed.withColumns(
        {c: F.coalesce(F.col(c).cast("bigint"), F.lit(-1)) for c in ("tumour_ordinal", "region_ordinal")}
    )


@query("""
    SELECT s_suppkey AS supplier_ordinal, s_name AS s_suppkey, s_nationkey AS clone FROM supplier
""")
def rename_swap(t):
    swapped = {"s_suppkey": "supplier_ordinal", "s_name": "s_suppkey", "s_nationkey": "clone"}
    return renamed(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), swapped)


@query("SELECT s_suppkey, s_name FROM supplier")
def trim_ids(t):
    padded = F.concat(F.lit(" \t"), "s_name", F.lit(" \r\n "))
    return t.supplier.select("s_suppkey", ids.trimmed(padded).alias("s_name"))


@query("""
    SELECT c_custkey, c_custkey % 10 = 0 AS is_root,
           CASE WHEN c_custkey % 7 <> 0 THEN c_custkey % 3 > 0 END AS is_wgd_event_clone,
           CASE WHEN c_custkey % 7 <> 0 THEN c_custkey % 4 > 0 END AS has_wgd_ancestor
    FROM customer
""")
def row_flags(t):
    return t.customer.select(
        "c_custkey",
        clones.is_root(F.expr("if(c_custkey % 10 = 0, 'diploid', 'clone1')")).alias("is_root"),
        clones.is_event_clone(F.expr("if(c_custkey % 7 = 0, null, c_custkey % 3)")).alias("is_wgd_event_clone"),
        clones.has_event_ancestor(F.expr("if(c_custkey % 7 = 0, null, c_custkey % 4)")).alias("has_wgd_ancestor"),
    )


@query("""
    WITH s AS (SELECT CASE WHEN event_id % 11 > 0 THEN (event_id % 1001) / 1000.0 END AS score FROM events)
    SELECT CASE WHEN score < 0.34 THEN 'benign' WHEN score <= 0.564 THEN 'ambiguous'
                WHEN score > 0.564 THEN 'pathogenic' END AS am_class, count(*) AS n_rows
    FROM s GROUP BY 1
""")
def score_class(t):
    score = F.expr("""CASE event_id % 11 WHEN 0 THEN if(event_id % 2 = 0, null, double('NaN'))
        ELSE (event_id % 1001) / 1000.0D END""")
    return (
        t.events.select(genome.score_class(score).alias("am_class"))
        .groupBy("am_class")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query("""
    WITH l AS (SELECT l_linenumber AS cn_a, CAST(l_suppkey % 5 AS INTEGER) AS cn_b,
                      CAST(l_quantity AS BIGINT) AS var_count, l_partkey % 40 AS cov FROM lineitem)
    SELECT greatest(cn_a, cn_b) AS major_cn, least(cn_a, cn_b) AS minor_cn, count(*) AS n_rows,
           count(CASE WHEN cov > 0 THEN 1 END) AS n_vaf,
           CAST(sum(CASE WHEN cov > 0 THEN CAST(floor(var_count * 1000.0 / cov) AS BIGINT) END) AS BIGINT) AS sum_vaf
    FROM l GROUP BY 1, 2
""")
def locus_formulas(t):
    loci = t.lineitem.selectExpr(
        "l_linenumber AS cn_a", "int(l_suppkey % 5) AS cn_b", "bigint(l_quantity) AS var_count",
        "l_partkey % 40 AS cov",
    )
    major, minor = genome.major_minor(F.col("cn_a"), F.col("cn_b"))
    vaf = genome.allele_fraction(F.col("var_count") * F.lit(1000.0), F.col("cov"))
    return (
        loci.select(major.alias("major_cn"), minor.alias("minor_cn"), vaf.alias("vaf"))
        .groupBy("major_cn", "minor_cn")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count("vaf").alias("n_vaf"),
            F.sum(F.floor("vaf").cast("bigint")).alias("sum_vaf"),
        )
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_suppkey % 9 <> 0
                THEN 'LTX' || l_orderkey || '_1:' || (l_suppkey % 9) || ':' || (l_partkey + 7) || ':A:-' END AS mutation_id_new
    FROM lineitem
""")
def mutation_id_rebuild(t):
    old_id = F.expr("'LTX' || l_orderkey || '_1:3:' || l_partkey || ':A:-'")
    chromosome = F.expr("if(l_suppkey % 9 = 0, null, string(l_suppkey % 9))")
    new_id = genome.rebuilt_mutation_id(
        old_id, chromosome, F.col("l_partkey") + 7, F.lit("A"), F.lit("-")
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", new_id.alias("mutation_id_new"))
