"""Grouped summaries and the named filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from clonarium.operators import aggregates
from clonarium.plans.filters import filter_counts
from testdata_queries.registry import query


@query("""
    SELECT l_partkey, l_suppkey,
           max(CASE WHEN l_linenumber > 2 THEN l_discount ELSE -1 END) AS am_pathogenicity,
           min(CASE WHEN l_linenumber > 1 THEN l_returnflag END) AS am_class
    FROM lineitem GROUP BY 1, 2
""")
def variant_dedup(t):
    scores = t.lineitem.selectExpr(
        "l_partkey",
        "l_suppkey",
        "CASE l_linenumber WHEN 1 THEN null WHEN 2 THEN double('NaN') ELSE l_discount END AS am_pathogenicity",
        "if(l_linenumber > 1, l_returnflag, null) AS am_class",
    )
    best = aggregates.best_score_per_variant(scores, ["l_partkey", "l_suppkey"])
    return best.withColumn("am_pathogenicity", F.coalesce("am_pathogenicity", F.lit(-1.0)))


@query("""
    SELECT o_orderpriority AS gene_id, 'T' || (o_custkey % 10) AS patient_id,
           round(avg(CAST(floor(o_totalprice) AS DOUBLE)), 3) AS tpm_normal,
           min('s' || o_orderkey) AS normal_sample_name_hash
    FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2
""")
def paired_normals(t):
    return aggregates.paired_normals(_expression(t)).withColumn("tpm_normal", F.round("tpm_normal", 3))


def _expression(t):
    return t.orders.selectExpr(
        "'s' || o_orderkey AS sample_name_hash",
        "'T' || (o_custkey % 10) AS patient_id",
        "o_orderpriority AS gene_id",
        "o_orderstatus = 'F' AS is_normal",
        "double(floor(o_totalprice)) AS tpm",
    )


@query("""
    SELECT 'T' || l_orderkey AS tumour_id, 'clone' || (l_linenumber % 3) AS clone, max(l_tax) AS max_proportion
    FROM lineitem GROUP BY 1, 2 HAVING max(l_tax) >= 0.05
""")
def clone_presence(t):
    proportions = t.lineitem.selectExpr(
        "'T' || l_orderkey AS tumour_id", "'clone' || (l_linenumber % 3) AS clone", "l_tax AS proportion"
    )
    return aggregates.present_clones(proportions, 0.05)


@query("""
    SELECT l_partkey AS mutation_id, max(CAST(l_quantity AS INTEGER)) AS max_var_count,
           min(CAST(l_suppkey + 50 AS INTEGER)) AS min_depth, max(l_discount) AS max_vaf,
           bool_or(l_returnflag = 'A') AS varscan_any, bool_or(l_linestatus = 'F') AS mutect_any,
           bool_or(l_discount >= 0.1) AS vaf02_any, bool_or(l_tax = 0) AS is_expressed_any
    FROM lineitem GROUP BY 1
""")
def mutation_rollups(t):
    mutations = t.lineitem.selectExpr(
        "l_partkey AS mutation_id", "int(l_quantity) AS var_count", "int(l_suppkey + 50) AS cov",
        "l_discount AS vaf", "l_returnflag = 'A' AS varscan", "l_linestatus = 'F' AS mutect",
        "l_discount >= 0.1 AS vaf02", "l_tax = 0 AS is_expressed",
    )
    return aggregates.mutation_rollups(mutations)


@query("""
    SELECT 'T' || c_nationkey AS tumour_id, CAST(sum(c_custkey % 3) AS BIGINT) AS total_gds_per_tumour
    FROM customer GROUP BY 1
""")
def total_rollup(t):
    tree = t.customer.selectExpr(
        "'T' || c_nationkey AS tumour_id", "c_custkey % 3 AS number_of_gds_at_clone"
    )
    return aggregates.doublings_per_tumour(tree)


@query("""
    SELECT l_orderkey, round(sum(l_linenumber / 10.0), 4) AS total, sum(l_linenumber) = 10 AS is_complete
    FROM lineitem GROUP BY 1
""")
def composition_sum(t):
    proportions = t.lineitem.selectExpr("l_orderkey", "l_linenumber / 10.0D AS proportion")
    return aggregates.composition(proportions, ["l_orderkey"]).withColumn("total", F.round("total", 4))


_CLONE_FLAGS = [
    "'T' || o_custkey AS tumour_id",
    "'clone' || o_orderkey AS clone",
    "o_orderstatus <> 'P' AS is_tree_clone",
    "if(o_orderstatus = 'P', null, o_orderpriority = '1-URGENT') AS is_primary_clone",
    "o_orderpriority = '5-LOW' AS is_met_clone",
]


@query("""
    SELECT DISTINCT 'primary' AS cohort, 'T' || o_custkey AS tumour_id FROM orders
    WHERE o_orderstatus <> 'P' AND o_orderpriority = '1-URGENT'
    UNION ALL
    SELECT DISTINCT 'mets', 'T' || o_custkey FROM orders WHERE o_orderpriority = '5-LOW'
""")
def cohort_members(t):
    flags = t.orders.selectExpr(*_CLONE_FLAGS)
    members = [
        aggregates.cohort_tumours(flags, c).select(F.lit(c).alias("cohort"), "tumour_id")
        for c in aggregates.COHORT_FLAGS
    ]
    return reduce(lambda a, b: a.unionByName(b), members)


@query("""
    SELECT count(*) AS n_clones, count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS n_non_tree FROM orders
""")
def nontree_count(t):
    return aggregates.non_tree_clones(t.orders.selectExpr(*_CLONE_FLAGS))


@query("SELECT DISTINCT l_suppkey % 5 AS chr, l_partkey AS pos FROM lineitem")
def distinct_loci(t):
    return t.lineitem.selectExpr("l_suppkey % 5 AS chr", "l_partkey AS pos").distinct()


@query("""
    SELECT 'T' || c_nationkey AS tumour_id, string_agg(DISTINCT c_mktsegment, ';' ORDER BY c_mktsegment) AS segments
    FROM customer GROUP BY 1
""")
def joined_distinct_values(t):
    clones = t.customer.selectExpr("'T' || c_nationkey AS tumour_id", "c_mktsegment")
    return aggregates.joined_distinct(clones, ["tumour_id"], "c_mktsegment", "segments")


def _filter_tables(t):
    line, part, order, customer = t.lineitem, t.part, t.orders, t.customer
    return {
        "mutations": line.selectExpr(
            "l_linenumber < 4 AS is_present", "l_returnflag = 'R' AS CALLED",
            "if(l_linestatus = 'O', 'exonic', 'intronic') AS func_refgene", "l_partkey % 3 > 0 AS is_snv",
            "if(l_linenumber = 7, null, l_suppkey % 2 = 0) AS tree_cluster",
            "if(l_linenumber = 6, null, l_suppkey % 5 = 0) AS tree_cn_removed_cluster",
        ),
        "clone_tree": customer.selectExpr(
            "element_at(array('resolved', 'unresolved', 'needs_follow_up'), int(c_custkey % 3) + 1) AS status",
            "if(c_acctbal > 0, 'High', 'Low') AS quality",
            "element_at(array('clonal_wgd', 'mut_supported', 'ploidy_only', 'no_wgd', null), int(c_custkey % 5) + 1) AS class",
        ),
        "variant_scores": line.selectExpr(
            "if(l_linenumber = 1, null, l_discount) AS am_pathogenicity",
            "element_at(array('pathogenic', 'benign', 'ambiguous', null), int(l_partkey % 4) + 1) AS am_class",
        ),
        "copy_number": part.selectExpr("p_size % 4 AS pred_CN_A", "int(p_partkey % 4) AS pred_CN_B"),
        "drivers": part.selectExpr(
            "p_partkey % 2 = 0 AS lung_mut_driver", "p_partkey % 3 = 0 AS mut_driver",
            "p_partkey % 5 = 0 AS lung_CN_driver", "p_partkey % 7 = 0 AS CN_driver",
        ),
        "expression": order.selectExpr(
            "if(o_orderstatus = 'P', null, o_orderstatus = 'F') AS is_normal", "o_orderkey % 5 / 2.0D AS tpm"
        ),
        "gene_source": line.selectExpr("'chr' || (l_partkey % 30) AS chrom"),
    }


_COUNT = "SELECT '{t}' AS \"table\", '{f}' AS filter, count(*) AS n_rows FROM {src} WHERE {cond}"
_FILTER_SQL = [
    ("mutations", "present_in_sample", "lineitem", "l_linenumber < 4"),
    ("mutations", "called", "lineitem", "l_returnflag = 'R'"),
    ("mutations", "coding_only", "lineitem", "l_linestatus = 'O'"),
    ("mutations", "snv_only", "lineitem", "l_partkey % 3 > 0"),
    ("mutations", "on_tree", "lineitem",
     "l_linenumber <> 7 AND l_suppkey % 2 = 0 AND (l_linenumber = 6 OR l_suppkey % 5 <> 0)"),
    ("clone_tree", "analysis_usable", "customer", "c_custkey % 3 = 0"),
    ("clone_tree", "high_quality", "customer", "c_acctbal > 0"),
    ("clone_tree", "clonal_wgd_tumours", "customer", "c_custkey % 5 = 0"),
    ("clone_tree", "subclonal_wgd_mut_supported", "customer", "c_custkey % 5 = 1"),
    ("clone_tree", "subclonal_wgd_ploidy_only", "customer", "c_custkey % 5 = 2"),
    ("clone_tree", "no_wgd_tumours", "customer", "c_custkey % 5 = 3"),
    ("variant_scores", "scored", "lineitem", "l_linenumber <> 1"),
    ("variant_scores", "likely_pathogenic", "lineitem", "l_partkey % 4 = 0"),
    ("variant_scores", "likely_benign", "lineitem", "l_partkey % 4 = 1"),
    ("variant_scores", "ambiguous", "lineitem", "l_partkey % 4 = 2"),
    ("copy_number", "homdel", "part", "p_size % 4 = 0 AND p_partkey % 4 = 0"),
    ("copy_number", "loh", "part",
     "(p_size % 4 = 0 OR p_partkey % 4 = 0) AND p_size % 4 + p_partkey % 4 > 0"),
    ("copy_number", "amplified", "part", "p_size % 4 + p_partkey % 4 >= 5"),
    ("copy_number", "diploid_heterozygous", "part", "p_size % 4 = 1 AND p_partkey % 4 = 1"),
    ("drivers", "snv_drivers_lung", "part", "p_partkey % 2 = 0"),
    ("drivers", "snv_drivers_pan", "part", "p_partkey % 3 = 0"),
    ("drivers", "cn_drivers_lung", "part", "p_partkey % 5 = 0"),
    ("drivers", "cn_drivers_pan", "part", "p_partkey % 7 = 0"),
    ("expression", "tumour_only", "orders", "o_orderstatus = 'O'"),
    ("expression", "normal_only", "orders", "o_orderstatus = 'F'"),
    ("expression", "expressed", "orders", "o_orderkey % 5 >= 2"),
    ("gene_source", "primary_assembly", "lineitem", "l_partkey % 30 BETWEEN 1 AND 22"),
]


@query(" UNION ALL ".join(_COUNT.format(t=a, f=b, src=c, cond=d) for a, b, c, d in _FILTER_SQL))
def named_filters(t):
    counts = [
        filter_counts(df, name).withColumn("table", F.lit(name)) for name, df in _filter_tables(t).items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts).select("table", "filter", "n_rows")
