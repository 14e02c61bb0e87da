"""Whole table jobs: source files in the cohort's formats are written from the tables,
then built into the canonical table."""

from __future__ import annotations

from pyspark.sql import functions as F

from clonarium.operators import aggregates, trees
from clonarium.plans import tables
from clonarium.plans.build import Sources, build_store
from clonarium.session import scratch_path
from clonarium.sources.headed import key_from_directory
from testdata_queries.registry import query


def _csv(t, df, name, sep="\t", header=True, **options):
    path = scratch_path(t.spark, name)
    df.write.options(sep=sep, header=header, **options).csv(path)
    return path


def _mutation_file(t):
    rows = t.lineitem.selectExpr(
        "'LTX' || l_suppkey AS patient_id",
        "'LTX' || l_suppkey || '_tumour' || (l_orderkey % 2 + 1) AS patient_tumour",
        "l_orderkey % 2 + 1 AS tumour_id",
        "'S' || l_orderkey AS sample_name_hash",
        "'LTX' || l_suppkey || '_1:' || l_partkey AS mutation_id",
        "CASE l_linenumber WHEN 1 THEN 'chr7' WHEN 2 THEN 'M' WHEN 3 THEN 'X' ELSE string(l_linenumber) END AS chr",
        "l_partkey AS pos",
        "'G' AS ref",
        "if(l_linenumber = 5, '-', 'T') AS var",
        "int(l_quantity) AS var_count",
        "if(l_linenumber = 6, 'NA', string(l_discount)) AS vaf",
        "if(l_returnflag = 'A', 'True', 'False') AS is_present",
        "CASE l_linenumber WHEN 1 THEN 'NA' WHEN 2 THEN 'NaN' WHEN 3 THEN '3' ELSE l_linenumber || '.0' END AS mutation_cluster",
    )
    return _csv(t, rows, "mutations", compression="gzip")


@query("""
    SELECT CASE l_linenumber WHEN 1 THEN '7' WHEN 2 THEN 'MT' WHEN 3 THEN 'X' ELSE CAST(l_linenumber AS VARCHAR) END AS chr,
           CASE WHEN l_linenumber > 2 THEN 'clone' || l_linenumber END AS clone,
           CASE WHEN l_linenumber = 5 THEN '-' ELSE 'T' END AS alt,
           CAST(l_orderkey % 2 + 1 AS INTEGER) AS tumour_ordinal, l_returnflag = 'A' AS is_present,
           min('LTX' || l_suppkey || '-Tumour' || (l_orderkey % 2 + 1)) AS first_tumour,
           CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS reads,
           count(CASE WHEN l_linenumber <> 6 THEN 1 END) AS n_vaf, count(*) AS n_rows
    FROM lineitem GROUP BY 1, 2, 3, 4, 5
""")
def job_mutations(t):
    built = tables.mutations(t.spark, _mutation_file(t), partitions=16)
    return built.groupBy("chr", "clone", "alt", "tumour_ordinal", "is_present").agg(
        aggregates.least_text(F.col("tumour_id")).alias("first_tumour"),
        F.sum("var_count").alias("reads"),
        F.count("vaf").alias("n_vaf"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def _tree_file(t):
    rows = t.customer.selectExpr(
        "'LTX' || (c_custkey % 50) || '-Tumour1' AS tumour_id",
        "'clone' || (c_custkey div 50 + 1) AS clone",
        "if(c_custkey < 50, 'diploid', 'clone' || ((c_custkey div 50 + 1) div 2)) AS parent",
        "if(c_custkey % 9 = 0, 'nan', string(c_custkey % 3)) AS number_of_gds_at_clone",
        "5 AS total_gds_per_tumour",
        "'High' AS quality",
        "if(c_custkey % 50 % 4 = 0, 'unresolved', 'resolved') AS status",
        "if(c_custkey % 50 % 4 = 0, null, 'clonal_wgd') AS class",
        "'NA' AS sub_class",
    )
    return _csv(t, rows, "tree")


_TREE_SQL = """
    RECURSIVE forest AS (SELECT c_custkey % 50 AS t, c_custkey // 50 + 1 AS n, (c_custkey // 50 + 1) // 2 AS p,
        CASE WHEN c_custkey % 9 <> 0 THEN c_custkey % 3 END AS gds FROM customer),
    walk AS (SELECT t, n, gds, coalesce(gds, 0) AS total FROM forest WHERE p = 0
             UNION ALL SELECT f.t, f.n, f.gds, coalesce(f.gds, 0) + w.total
             FROM forest f JOIN walk w ON f.t = w.t AND f.p = w.n)"""


@query(f"""
    WITH {_TREE_SQL}
    SELECT 'LTX' || t || '-Tumour1' AS tumour_id, 'clone' || n AS clone, coalesce(gds, -1) AS number_of_gds_at_clone,
           n = 1 AS is_root, gds > 0 AS is_wgd_event_clone, CAST(total AS BIGINT) AS cumulative_gds_to_clone,
           total > 0 AS has_wgd_ancestor, CASE WHEN t % 4 = 0 THEN NULL ELSE 'clonal_wgd' END AS class
    FROM walk
""")
def job_clone_tree(t):
    built = tables.clone_tree(t.spark, _tree_file(t))
    return built.select(
        "tumour_id", "clone", F.coalesce("number_of_gds_at_clone", F.lit(-1)).alias("number_of_gds_at_clone"),
        "is_root", "is_wgd_event_clone", "cumulative_gds_to_clone", "has_wgd_ancestor", "class",
    )


@query(f"""
    WITH {_TREE_SQL},
    mutations AS (SELECT l_suppkey AS t, CASE WHEN l_linenumber > 2 THEN l_linenumber END AS n FROM lineitem WHERE l_orderkey % 2 = 0)
    SELECT 'LTX' || m.t || '-Tumour1' AS tumour_id,
           CASE WHEN w.total > 0 THEN 'post_wgd' ELSE 'pre_wgd' END AS wgd_timing, count(*) AS n_mutations
    FROM mutations m JOIN walk w ON m.t = w.t AND m.n = w.n WHERE m.t % 4 <> 0 GROUP BY 1, 2
""")
def job_mutation_timing(t):
    """Two built tables joined: mutations before and after doubling, per tumour."""
    mutations = tables.mutations(t.spark, _mutation_file(t)).select("tumour_id", "clone")
    timed = trees.timed_mutations(mutations, tables.clone_tree(t.spark, _tree_file(t)))
    return timed.groupBy("tumour_id", "wgd_timing").agg(F.count(F.lit(1)).alias("n_mutations"))


@query("""
    SELECT 'LTX' || (l_suppkey % 40) || '-Tumour1' AS tumour_id, CAST(l_linenumber AS VARCHAR) AS chr, l_partkey AS pos,
           CASE WHEN l_linestatus = 'F' THEN 'A' END AS alt, max(l_discount) AS am_pathogenicity,
           min(CASE l_orderkey % 3 WHEN 0 THEN 'benign' WHEN 1 THEN 'pathogenic' END) AS am_class
    FROM lineitem GROUP BY 1, 2, 3, 4
""")
def job_variant_scores(t):
    tumour = F.regexp_extract("path", "/tumour=([^/]+)/", 1)
    return tables.variant_scores(t.spark, _score_files(t), tumour)


def _score_files(t):
    root = scratch_path(t.spark, "scores")
    rows = t.lineitem.selectExpr(
        "'LTX' || (l_suppkey % 40) || '_tumour01' AS tumour",
        "l_orderkey",
        "if(l_linenumber % 2 = 0, 'chr', '') || l_linenumber AS chr",
        "l_partkey AS pos",
        "if(l_linestatus = 'F', 'A', '-') AS var",
        "string(l_discount) AS alpha_missense",
        "element_at(array('Likely benign', 'Likely pathogenic', 'not_classified'), int(l_orderkey % 3) + 1) AS am_class",
    )
    rows.write.partitionBy("tumour").options(sep="\t", header=True).csv(root)
    return f"{root}/*"


@query("""
    SELECT 'LTX' || c_custkey AS "Patient_ID", i AS tumour_ordinal, 'LTX' || c_custkey || '-Tumour' || i AS tumour_id,
           CASE WHEN i = 1 THEN c_mktsegment ELSE 'LUSC' END AS histology,
           CASE WHEN i = 1 AND c_custkey % 7 > 0 THEN c_acctbal ELSE -1 END AS size_path_mm
    FROM customer, (SELECT unnest([1, 2]) AS i) WHERE i = 1 OR c_custkey % 8 = 0
""")
def job_clinical(t):
    patients = tables.clinical(t.spark, _clinical_file(t))
    tumours = tables.clinical_per_tumour(patients)
    return tumours.select(
        "Patient_ID", "tumour_ordinal", "tumour_id", "histology",
        F.coalesce("size_path_mm", F.lit(-1.0)).alias("size_path_mm"),
    )


def _clinical_file(t):
    rows = t.customer.select(
        F.expr("'LTX' || c_custkey").alias("Patient_ID"),
        F.expr("c_custkey % 90").alias("age"),
        F.col("c_mktsegment").alias("histology1_central.reviewed"),
        F.expr("if(c_custkey % 8 = 0, 'LUSC', 'NA')").alias("histology2_central.reviewed"),
        F.expr("if(c_custkey % 7 = 0, 'NA', string(c_acctbal))").alias("SizePath_lesion1_central.reviewed"),
    )
    return _csv(t, rows, "clinical")


@query("""
    SELECT 'G' || p_partkey AS "Hugo_Symbol", CAST(p_size % 23 AS VARCHAR) AS chr_hg38,
           CASE WHEN p_size % 2 = 0 THEN 'MT' ELSE '1' END AS chr_hg19, p_partkey * 10 AS start_hg38,
           CASE p_partkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS mut_driver, p_partkey % 2 = 0 AS "CN_driver"
    FROM part
""")
def job_drivers(t):
    return tables.drivers(t.spark, _driver_file(t))


def _driver_file(t):
    rows = t.part.selectExpr(
        "'G' || p_partkey AS Hugo_Symbol",
        "'chr' || (p_size % 23) AS chr_hg38",
        "if(p_size % 2 = 0, 'chrM', '1') AS chr_hg19",
        "p_partkey * 10 AS start_hg38",
        "element_at(array('TRUE', 'false', 'NA'), int(p_partkey % 3) + 1) AS mut_driver",
        "if(p_partkey % 2 = 0, 'True', 'FALSE') AS CN_driver",
    )
    return _csv(t, rows, "drivers")


@query("""
    WITH cn AS (SELECT 'LTX' || (p_partkey % 3) || '-Tumour1' AS tumour_id, p_partkey,
                       CAST(p_size % 4 AS BIGINT) AS a, p_partkey % 3 AS b FROM part)
    SELECT tumour_id, 'X_' || p_partkey || '_' || (p_partkey + 99) AS segment, 'X' AS segment_chr,
           p_partkey AS segment_start, p_partkey + 99 AS segment_end, a + b AS total_cn,
           least(a, b) AS minor_cn, greatest(a, b) AS major_cn, a = 0 AND b = 0 AS is_homdel,
           least(a, b) = 0 AND a + b > 0 AS is_loh
    FROM cn
""")
def job_copy_number(t):
    return tables.copy_number(t.spark, _copy_number_file(t)).drop("clone", "pred_CN_A", "pred_CN_B")


def _copy_number_file(t):
    rows = t.part.selectExpr(
        "'LTX' || (p_partkey % 3) || '-Tumour1' AS tumour_id",
        "'X_' || p_partkey || '_' || (p_partkey + 99) AS segment",
        "'clone1' AS clone",
        "p_size % 4 AS pred_CN_A",
        "p_partkey % 3 AS pred_CN_B",
    )
    return _csv(t, rows, "copy-number", sep=",")


@query("""
    WITH long AS (SELECT p_partkey, i, i % 10 = 0 AS is_normal, (p_partkey * i) % 97 AS tpm FROM part, range(1, 61) r(i))
    SELECT 'LTX' || (i % 5) AS patient_id, is_normal, count(*) AS n_rows, CAST(sum(tpm) AS BIGINT) AS tpm,
           CAST(sum(tpm * 2) AS BIGINT) AS counts, CAST(coalesce(sum(CASE WHEN NOT is_normal THEN i END), -1) AS BIGINT) AS regions
    FROM long GROUP BY 1, 2
""")
def job_expression(t):
    """Sixty samples, one in ten a normal."""
    built = tables.expression(t.spark, *_matrix_files(t))
    return built.groupBy("patient_id", "is_normal").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("tpm").cast("bigint").alias("tpm"),
        F.sum("counts").cast("bigint").alias("counts"),
        F.coalesce(F.sum("region_ordinal"), F.lit(-1)).alias("regions"),
    )


def _matrix_files(t):
    names = [f"LTX{i % 5}_SU_N{i:02d}--0{i}" if i % 10 == 0 else f"LTX{i % 5}_SU_T1-R{i}--0{i}" for i in range(1, 61)]

    def matrix(factor):
        cells = [f"double((p_partkey * {i}) % 97 * {factor}) AS `{n}`" for i, n in enumerate(names, 1)]
        path = scratch_path(t.spark, "matrix")
        t.part.selectExpr("'G' || p_partkey AS gene_id", *cells).write.parquet(path)
        return path

    return matrix(2), matrix(1)


def _crosswalk_file(t):
    rows = t.customer.selectExpr("' LTX' || c_custkey || ' ' AS PatientID", "'CRUK' || (c_custkey * 2 + 1) AS CRUK_ID")
    return _csv(t, rows, "crosswalk", sep=",", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


@query("SELECT 'LTX' || c_custkey AS ltx_patient_id, 'CRUK' || (c_custkey * 2 + 1) AS cruk_patient_id FROM customer")
def job_id_crosswalk(t):
    return tables.id_crosswalk(t.spark, _crosswalk_file(t))


def _flag_file(t):
    text = "element_at(array('TRUE', 'FALSE', 'T', '0', 'NA', 'odd'), int({} % 6) + 1) AS {}"
    rows = t.orders.selectExpr(
        "if(o_orderkey % 2 = 0, 'LTX' || o_custkey, 'CRUK' || (o_custkey * 2 + 1)) || '_' || (o_custkey % 2 + 1) AS tumour_id",
        "o_orderkey AS mutation_cluster",
        text.format("o_orderkey", "treeClones"),
        text.format("o_custkey", "seedingClones"),
        "'TRUE' AS clonalClones",
        "'FALSE' AS sharedClones",
        text.format("(o_orderkey + 1)", "primaryClones"),
        text.format("(o_orderkey + 2)", "metClones"),
    )
    return _csv(t, rows, "flags")


@query("""
    SELECT 'CRUK' || (o_custkey * 2 + 1) || '_' || (o_custkey % 2 + 1) AS tumour_id, 'clone' || o_orderkey AS clone,
           CASE WHEN o_orderkey % 6 IN (0, 2) THEN true WHEN o_orderkey % 6 IN (1, 3) THEN false END AS is_tree_clone,
           CASE WHEN o_custkey % 6 IN (0, 2) THEN true WHEN o_custkey % 6 IN (1, 3) THEN false END AS is_seeding_clone
    FROM orders
""")
def job_clone_flags(t):
    crosswalk = tables.id_crosswalk(t.spark, _crosswalk_file(t))
    flags = tables.clone_flags(t.spark, _flag_file(t), crosswalk, "cruk")
    return flags.select("tumour_id", "clone", "is_tree_clone", "is_seeding_clone")


@query("""
    SELECT DISTINCT 'LTX' || o_custkey || '-Tumour' || (o_custkey % 2 + 1) AS tumour_id
    FROM orders WHERE (o_orderkey + 2) % 6 IN (0, 2)
""")
def job_cohort_of_flags(t):
    crosswalk = tables.id_crosswalk(t.spark, _crosswalk_file(t))
    return aggregates.cohort_tumours(tables.clone_flags(t.spark, _flag_file(t), crosswalk), "mets")


@query("""
    SELECT 'LTX' || c_custkey || '-Tumour1' AS tumour_id, c_custkey % 3 + 1 AS n_regions,
           'mono' || repeat(';poly', c_custkey % 3) AS individual_seeding_clonality,
           CASE WHEN c_custkey % 5 > 0 THEN 'a' || repeat(';b', c_custkey % 3) END AS individual_seeding_phyletic
    FROM customer
""")
def job_seeding(t):
    crosswalk = tables.id_crosswalk(t.spark, _crosswalk_file(t))
    built = tables.seeding(t.spark, _seeding_file(t), crosswalk)
    return built.select("tumour_id", "n_regions", "individual_seeding_clonality", "individual_seeding_phyletic")


def _seeding_file(t):
    rows = t.customer.selectExpr(
        "'CRUK' || (c_custkey * 2 + 1) || '-Cluster1' AS tumour_id",
        "'monoclonal' AS seedingClonality",
        "'monophyletic' AS seedingPhyletic",
        "'mono' || repeat(';poly', int(c_custkey % 3)) AS individualSeedingClonality",
        "if(c_custkey % 5 = 0, 'NA', 'a' || repeat(';b', int(c_custkey % 3))) AS individualSeedingPhyletic",
        "c_custkey % 3 + 1 AS nRegions",
    )
    return _csv(t, rows, "seeding", sep=" ")


@query("""
    WITH genes AS (SELECT 'G' || l_partkey AS gene_name, (l_partkey // 500) % 26 + 1 AS c,
                          min(l_partkey * 100 + l_linenumber) AS start, max(l_partkey * 100 + l_linenumber + 20) AS "end"
                   FROM lineitem WHERE (l_partkey // 500) % 26 + 1 <= 22 GROUP BY 1, 2),
    bands AS (SELECT (s_suppkey // 25) % 26 + 1 AS c, s_suppkey * 2000 AS s, s_suppkey * 2000 + 1950 AS e, 'q' || s_suppkey AS b FROM supplier)
    SELECT gene_name, CAST(g.c AS VARCHAR) AS chromosome, start, "end", '+' AS strand,
           coalesce(string_agg(DISTINCT b, ';' ORDER BY b), '') AS cytoband_name
    FROM genes g LEFT JOIN bands ON g.c = bands.c AND s < "end" AND e > start GROUP BY 1, 2, 3, 4
""")
def job_gene_reference(t):
    return tables.gene_reference(t.spark, *_gene_files(t), partitions=16)


def _gene_files(t):
    transcripts = t.lineitem.selectExpr(
        "0 AS bin", "'NM' AS name", "'chr' || ((l_partkey div 500) % 26 + 1) AS chrom", "'+' AS strand",
        "l_partkey * 100 + l_linenumber AS s", "l_partkey * 100 + l_linenumber + 20 AS e", "0 AS cs", "0 AS ce", "1 AS n",
        "'1,' AS es", "'2,' AS ee", "0 AS score", "'G' || l_partkey AS name2", "'cmpl' AS a", "'cmpl' AS b", "'0,' AS f",
    )
    bands = t.supplier.selectExpr(
        "'chr' || ((s_suppkey div 25) % 26 + 1) AS chrom", "s_suppkey * 2000 AS s", "s_suppkey * 2000 + 1950 AS e",
        "'q' || s_suppkey AS b", "'gneg' AS g",
    )
    return (
        _csv(t, transcripts, "transcripts", header=False, compression="gzip"),
        _csv(t, bands, "bands", header=False, compression="gzip"),
    )


@query("""
    SELECT 'LTX' || o_custkey || '-Tumour' || o_orderkey AS tumour_id, 'clone' || c AS clone, 'R' || r AS region,
           CASE WHEN r = 1 THEN 'clonal' WHEN c = 1 THEN 'subclonal' ELSE 'absent' END AS clonality
    FROM orders, (SELECT unnest([1, 2]) AS c), (SELECT unnest([1, 2]) AS r) WHERE o_orderkey % 11 > 0
""")
def job_region_clonality(t):
    crosswalk = tables.id_crosswalk(t.spark, _crosswalk_file(t))
    return tables.region_tables(t.spark, _bundle_file(t), crosswalk)[1]


def _bundle_file(t):
    records = t.orders.selectExpr(
        "if(o_orderkey % 11 = 0, '', 'LTX' || o_custkey || '_' || o_orderkey) AS sample_id",
        "array('R1', 'R2') AS regions",
        "array('1', 'clone2') AS clones",
        "array(array(100, 40), array(30, 0)) AS ccf",
        "array(array('clonal', 'subclonal'), array('clonal', 'absent')) AS clonality",
    )
    path = scratch_path(t.spark, "bundles")
    records.write.json(path)
    return path


@query("""
    SELECT 'LTX' || o_custkey || '-Tumour' || o_orderkey AS tumour_id, 'clone' || c AS clone, 'R' || r AS region,
           CAST(CASE WHEN c = 1 AND r = 1 THEN 100 WHEN c = 1 THEN 40 WHEN r = 1 THEN 30 ELSE 0 END AS INTEGER) AS ccf
    FROM orders, (SELECT unnest([1, 2]) AS c), (SELECT unnest([1, 2]) AS r) WHERE o_orderkey % 11 > 0
""")
def job_region_ccf(t):
    crosswalk = tables.id_crosswalk(t.spark, _crosswalk_file(t))
    return tables.region_tables(t.spark, _bundle_file(t), crosswalk)[0]


def _proportion_files(t):
    """A directory per region, all customers in one of them; the last one, which takes the two last
    remainders, lacks the column that names the rows."""
    root = scratch_path(t.spark, "proportions")
    for region in range(4):
        rows = t.customer.where(f"least(c_nationkey % 5, 3) = {region}").selectExpr(
            f"'clone' || c_custkey AS {'clone' if region < 3 else 'other'}",
            f"if(c_custkey % 6 = 0, 'NA', string(c_custkey % 10 / 10)) AS s{region}",
            f"c_custkey % 2 AS shared{region}",
        )
        rows.write.options(header=True).csv(f"{root}/LTX{region}-Tumour1")
    return f"{root}/*"


@query("""
    WITH parts AS (SELECT c_nationkey % 5 AS r, c_custkey AS c FROM customer WHERE c_nationkey % 5 < 3)
    SELECT 'LTX' || r || '-Tumour1' AS tumour_id, 'clone' || c AS clone, 's' || r AS sample_id,
           CASE WHEN c % 6 > 0 THEN c % 10 / 10.0 END AS proportion, '' AS reason FROM parts
    UNION ALL SELECT 'LTX' || r || '-Tumour1', 'clone' || c, 'shared' || r, c % 2, '' FROM parts
    UNION ALL SELECT DISTINCT 'LTX3-Tumour1', '', '', -1, 'no column clone' FROM customer WHERE c_nationkey % 5 = 3
""")
def job_clone_proportions(t):
    rows, rejects = tables.clone_proportions(t.spark, _proportion_files(t))
    left_out = rejects.select(key_from_directory().alias("tumour_id"), "reason").distinct()
    empty = F.lit("")
    return rows.withColumn("reason", empty).unionByName(
        left_out.select("tumour_id", empty.alias("clone"), empty.alias("sample_id"), F.lit(-1.0).alias("proportion"), "reason")
    )


def _chain_file(t):
    """A chain of two blocks per part: 80 bases at ``p_partkey * 100``, a gap of 5, 10 more."""
    chains = t.part.selectExpr(
        "concat_ws('\n', concat_ws(' ', 'chain', p_partkey, 'chr7', 1000000000, '+', p_partkey * 100, p_partkey * 100 + 95, "
        "'chr8', 1000000000, if(p_partkey % 2 = 0, '+', '-'), p_partkey * 200, p_partkey * 200 + 97, p_partkey), "
        "'80 5 7', '10', '') AS value"
    )
    path = scratch_path(t.spark, "chain")
    chains.repartition(1).write.options(lineSep="\n").text(path)
    return path


@query("""
    WITH m AS (SELECT l_orderkey, l_linenumber, l_partkey AS p, CAST(l_suppkey % 100 AS BIGINT) AS o FROM lineitem),
    lifted AS (SELECT *, CASE WHEN o < 80 THEN p * 200 + o WHEN o >= 85 AND o < 95 THEN p * 200 + o + 2 END AS q FROM m)
    SELECT CASE WHEN q IS NULL THEN 'lost' WHEN p % 2 = 0 THEN 'forward' ELSE 'reverse' END AS way, count(*) AS n_rows,
           CAST(sum(CASE WHEN p % 2 = 0 THEN q + 1 ELSE 1000000000 - q END) AS BIGINT) AS sum_pos
    FROM lifted GROUP BY 1
""")
def job_lifted_mutations(t):
    """All lineitem rows as mutations, moved through a chain file written from part."""
    mutations = t.lineitem.selectExpr(
        "'LTX' || l_orderkey || '_1:7:' || l_linenumber AS mutation_id", "'S1' AS sample_name_hash",
        "'LTX1-Tumour1' AS tumour_id", "'7' AS chr", "l_partkey * 100 + l_suppkey % 100 + 1 AS pos", "'A' AS ref", "'T' AS alt",
        "l_partkey",
    )
    lifted = tables.mutations_on_new_build(t.spark, mutations, _chain_file(t))
    new = F.split("mutation_id_hg38", ":")
    way = F.when(F.col("mutation_id_hg38").isNull(), "lost").when(F.col("l_partkey") % 2 == 0, "forward").otherwise("reverse")
    return lifted.groupBy(way.alias("way")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.get(new, F.lit(2)).cast("bigint")).alias("sum_pos")
    )


@query("""
    WITH o AS (SELECT count(*) AS n FROM orders WHERE o_orderkey % 11 > 0)
    SELECT 'id_crosswalk' AS "table", count(*) AS n_rows FROM customer
    UNION ALL SELECT 'mutations', count(*) FROM lineitem
    UNION ALL SELECT 'mutations_hg38', count(*) FROM lineitem
    UNION ALL SELECT 'clone_tree', count(*) FROM customer
    UNION ALL SELECT 'clinical', count(*) FROM customer
    UNION ALL SELECT 'clinical_per_tumour', count(*) + count(CASE WHEN c_custkey % 8 = 0 THEN 1 END) FROM customer
    UNION ALL SELECT 'drivers', count(*) FROM part
    UNION ALL SELECT 'copy_number', count(*) FROM part
    UNION ALL SELECT 'expression', 60 * count(*) FROM part
    UNION ALL SELECT 'paired_normals', count(*) FROM part
    UNION ALL SELECT 'clone_proportions', 2 * count(*) FROM customer WHERE c_nationkey % 5 < 3
    UNION ALL SELECT 'clone_flags', count(*) FROM orders
    UNION ALL SELECT 'seeding', count(*) FROM customer
    UNION ALL SELECT 'gene_reference', count(DISTINCT l_partkey) FROM lineitem WHERE (l_partkey // 500) % 26 + 1 <= 22
    UNION ALL SELECT 'region_ccf', 4 * n FROM o
    UNION ALL SELECT 'region_clonality', 4 * n FROM o
""")
def job_store_build(t):
    """All tables but the one keyed by file names into one store, with its manifest."""
    genes, bands = _gene_files(t)
    counts, tpm = _matrix_files(t)
    sources = Sources(
        crosswalk=_crosswalk_file(t),
        mutations=f"{_mutation_file(t)}/*.csv.gz",
        clone_tree=_tree_file(t),
        clinical=_clinical_file(t),
        drivers=_driver_file(t),
        copy_number=_copy_number_file(t),
        expression_counts=counts,
        expression_tpm=tpm,
        clone_proportions=_proportion_files(t),
        clone_flags=_flag_file(t),
        seeding=_seeding_file(t),
        genes=genes,
        bands=bands,
        bundles=_bundle_file(t),
        chain=_chain_file(t),
    )
    manifest = build_store(t.spark, sources, scratch_path(t.spark, "store"))
    return manifest.select("table", "n_rows")
