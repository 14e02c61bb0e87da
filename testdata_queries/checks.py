"""Checks, on data that has offenders for each."""

from __future__ import annotations

from pyspark.sql import functions as F

from clonarium.operators import quality
from clonarium.operators.joins import unpaired_keys
from clonarium.plans.contracts import CONTRACTS, contract_report, foreign_key_orphans
from testdata_queries.registry import query


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def pk_duplicates(t):
    return quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""
    SELECT p_partkey, p_name FROM part WHERE NOT regexp_matches(p_name, '^(small|red) [a-z]+$')
""")
def format_offenders(t):
    return quality.malformed(t.part.select("p_partkey", "p_name"), "p_name", "^(small|red) [a-z]+$")


@query("""
    SELECT p_partkey, CASE WHEN p_partkey % 10 > 0 THEN 'LTX' || p_partkey END AS patient_id
    FROM part WHERE p_partkey % 10 = 0
""")
def null_offenders(t):
    ids = t.part.selectExpr("p_partkey", "if(p_partkey % 10 > 0, 'LTX' || p_partkey, null) AS patient_id")
    return quality.malformed(ids, "patient_id", r"^LTX\d+$", null_is_bad=True)


@query("""
    SELECT c_custkey AS key, 'left_only' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey * 2 FROM orders)
    UNION ALL
    SELECT DISTINCT o_custkey * 2, 'right_only' FROM orders WHERE o_custkey * 2 NOT IN (SELECT c_custkey FROM customer)
""")
def keyset_diff(t):
    left = t.customer.select(F.col("c_custkey").alias("key"))
    right = t.orders.select((F.col("o_custkey") * 2).alias("key"))
    return quality.key_set_difference(left, right, ["key"])


@query("""
    SELECT o_orderkey, o_orderkey % 4 + 1 AS n_regions FROM orders
    WHERE o_orderkey % 9 > 0 AND o_orderkey % 4 + 1 <> o_custkey % 4 + 1
""")
def list_length_offenders(t):
    rows = t.orders.selectExpr(
        "o_orderkey",
        "o_orderkey % 4 + 1 AS n_regions",
        "if(o_orderkey % 9 = 0, null, array_join(transform(sequence(0, o_custkey % 4), i -> 'a'), ';')) AS list",
    )
    return quality.list_length_mismatch(rows, ["list"], "n_regions").drop("list")


@query("""
    SELECT o_orderpriority, count(*) AS n_rows FROM orders
    WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1
""")
def allowed_value_offenders(t):
    return quality.unexpected_values(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query("""
    SELECT DISTINCT l_partkey AS key FROM lineitem WHERE l_partkey % 3 > 0
      AND l_partkey NOT IN (SELECT o_custkey FROM orders)
""")
def fk_orphans(t):
    child = t.lineitem.selectExpr("if(l_partkey % 3 = 0, null, l_partkey) AS key")
    return quality.orphans(child, t.orders, [("key", "o_custkey")])


@query("""
    SELECT l_partkey, min(l_returnflag) <> max(l_returnflag) AS l_returnflag_varies,
           min(l_linestatus) <> max(l_linestatus) AS l_linestatus_varies
    FROM lineitem GROUP BY 1 HAVING min(l_returnflag) <> max(l_returnflag) OR min(l_linestatus) <> max(l_linestatus)
""")
def constancy_offenders(t):
    return quality.varying_within(t.lineitem, ["l_partkey"], ["l_returnflag", "l_linestatus"])


@query("SELECT l_orderkey, l_linenumber, l_tax FROM lineitem WHERE l_tax < 0.01 OR l_tax > 0.06")
def bounds_offenders(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_tax")
    return quality.outside_bounds(rows, "l_tax", 0.01, 0.06)


@query("""
    SELECT c_nationkey, CAST(sum(c_custkey % 3) AS BIGINT) AS found, 60 AS declared_min, 60 AS declared_max
    FROM customer GROUP BY 1 HAVING sum(c_custkey % 3) <> 60
""")
def formula_offenders(t):
    tree = t.customer.selectExpr("c_nationkey", "c_custkey % 3 AS gds", "60 AS total")
    return quality.sum_mismatch(tree, ["c_nationkey"], "gds", "total")


@query("""
    SELECT 'chr has prefix' AS "check", count(*) AS n_rows, count(CASE WHEN l_orderkey % 4 = 0 THEN 1 END) AS n_bad FROM lineitem
    UNION ALL SELECT 'tumour_id form', count(*), count(CASE WHEN l_partkey % 5 = 0 THEN 1 END) FROM lineitem
    UNION ALL SELECT 'clone form', count(*), count(CASE WHEN l_linenumber = 2 THEN 1 END) FROM lineitem
""")
def canonical_form_report(t):
    rows = t.lineitem.selectExpr(
        "if(l_orderkey % 4 = 0, 'chr', '') || l_linenumber AS chr",
        "'LTX' || l_partkey || if(l_partkey % 5 = 0, '_tumour', '-Tumour') || '1' AS tumour_id",
        "if(l_linenumber = 1, null, if(l_linenumber = 2, '2', 'clone' || l_linenumber)) AS clone",
    )
    return quality.violation_counts(
        rows,
        {
            "chr has prefix": F.col("chr").startswith("chr"),
            "tumour_id form": ~F.col("tumour_id").rlike("-Tumour"),
            "clone form": ~F.col("clone").startswith("clone"),
        },
    )


@query("""
    SELECT count(*) AS n_shared FROM (SELECT DISTINCT o_custkey * 2 AS k FROM orders) JOIN customer ON k = c_custkey
""")
def key_overlap(t):
    return quality.shared_key_count(
        t.customer.selectExpr("c_custkey AS key"), t.orders.selectExpr("o_custkey * 2 AS key"), ["key"]
    )


@query("""
    WITH m AS (SELECT 'LTX' || l_suppkey || '-Tumour1' AS tumour_id, l_partkey AS pos, l_linenumber AS n,
                      l_orderkey, l_discount * 12 AS score FROM lineitem),
    n AS (SELECT count(*) AS n_rows FROM m)
    SELECT 'tumour_id is null' AS "check", n_rows, (SELECT count(*) FROM m WHERE n = 7) AS n_bad FROM n
    UNION ALL SELECT 'chr is null', n_rows, 0 FROM n
    UNION ALL SELECT 'pos is null', n_rows, 0 FROM n
    UNION ALL SELECT 'alt is null', n_rows, 0 FROM n
    UNION ALL SELECT 'am_class allowed', n_rows, (SELECT count(*) FROM m WHERE l_orderkey % 4 = 3) FROM n
    UNION ALL SELECT 'tumour_id format', n_rows, 0 FROM n
    UNION ALL SELECT 'chr format', n_rows, (SELECT count(*) FROM m WHERE pos % 5 = 0) FROM n
    UNION ALL SELECT 'am_pathogenicity bounds', n_rows, (SELECT count(*) FROM m WHERE score > 1) FROM n
    UNION ALL SELECT 'has rows', n_rows, 0 FROM n
    UNION ALL SELECT 'column types', NULL, 0
    UNION ALL SELECT 'key unique', NULL, (SELECT count(*) FROM (
        SELECT 1 FROM m GROUP BY CASE WHEN n <> 7 THEN tumour_id END, pos, n HAVING count(*) > 1))
""")
def contract_report_scores(t):
    scores = t.lineitem.selectExpr(
        "if(l_linenumber = 7, null, 'LTX' || l_suppkey || '-Tumour1') AS tumour_id",
        "if(l_partkey % 5 = 0, 'chr', '') || l_linenumber AS chr",
        "l_partkey AS pos",
        "'A' AS alt",
        "l_discount * 12 AS am_pathogenicity",
        "element_at(array('benign', null, 'pathogenic', 'other'), int(l_orderkey % 4) + 1) AS am_class",
    )
    return contract_report(scores, CONTRACTS["variant_scores"])


@query("""
    SELECT 'tumour_id,clone in clone_tree' AS "check",
           (SELECT count(*) FROM (SELECT DISTINCT o_custkey % 7, o_custkey FROM orders
             WHERE (o_custkey % 7, o_custkey) NOT IN (SELECT c_custkey % 7, c_custkey FROM customer WHERE c_nationkey <> 3))) AS n_bad
""")
def contract_foreign_key(t):
    proportions = t.orders.selectExpr(
        "'LTX' || (o_custkey % 7) || '-Tumour1' AS tumour_id", "'clone' || o_custkey AS clone",
        "'s' || o_orderkey AS sample_id", "0.5D AS proportion",
    )
    tree = t.customer.where("c_nationkey <> 3").selectExpr(
        "'LTX' || (c_custkey % 7) || '-Tumour1' AS tumour_id", "'clone' || c_custkey AS clone"
    )
    report = contract_report(proportions, CONTRACTS["clone_proportions"], {"clone_tree": tree})
    return report.where("check LIKE '% in clone_tree'").select("check", "n_bad")


@query("""
    SELECT 'G' || (p_partkey % 700) AS gene_id, CAST(count(*) AS BIGINT) AS n_left,
           CAST(count(CASE WHEN p_size % 2 = 0 THEN 1 END) AS BIGINT) AS n_right
    FROM part GROUP BY 1 HAVING count(*) <> 1 OR count(CASE WHEN p_size % 2 = 0 THEN 1 END) <> 1
""")
def matrix_duplicate_genes(t):
    """Genes that are not exactly once in each of two matrices."""
    gene = "'G' || (p_partkey % 700) AS gene_id"
    return unpaired_keys(t.part.selectExpr(gene), t.part.where("p_size % 2 = 0").selectExpr(gene), "gene_id")


@query("SELECT 'customer' AS \"table\", 'source lacks columns [''c_missing'']' AS error, count(*) AS n_rows FROM customer")
def required_columns(t):
    """The error for a missing column, next to the rows of a table that has all it needs."""
    try:
        quality.require_columns(t.customer, ["c_custkey", "c_missing"], "source")
        error = ""
    except quality.CheckFailed as failed:
        error = str(failed).split(";")[0]
    quality.require_columns(t.customer, ["c_custkey", "c_name"])
    return t.customer.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("customer").alias("table"), F.lit(error).alias("error"), "n_rows")


@query("""
    SELECT least(5, (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1))) AS n_listed, count(*) AS n_rows
    FROM lineitem
""")
def first_offenders(t):
    """A failing check lists five offenders at most."""
    try:
        quality.require_none(quality.duplicate_keys(t.lineitem, ["l_orderkey"]), "duplicate")
        listed = 0
    except quality.CheckFailed as failed:
        listed = str(failed).count("'l_orderkey'")
    return t.lineitem.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(listed).cast("bigint").alias("n_listed"), "n_rows")


def _tree(t):
    return t.customer.selectExpr(
        "if(c_custkey % 11 = 0, null, 'LTX' || (c_custkey % 9) || '-Tumour1') AS tumour_id",
        "'clone' || c_custkey AS clone",
        "CASE WHEN c_custkey < 9 THEN 'diploid' WHEN c_custkey % 13 = 0 THEN 'clone-1' WHEN c_custkey % 17 > 0 THEN 'clone' || (c_custkey - 9) END AS parent",
        "int(c_custkey % 3) AS number_of_gds_at_clone",
        "c_custkey < 9 AS is_root",
        "if(c_custkey % 10 = 0, null, c_custkey) AS cumulative_gds_to_clone",
        "true AS has_wgd_ancestor",
    )


@query("""
    SELECT 'cumulative_gds_to_clone is null' AS "check", count(CASE WHEN c_custkey % 10 = 0 THEN 1 END) AS n_bad FROM customer
    UNION ALL SELECT 'tumour_id is null', count(CASE WHEN c_custkey % 11 = 0 THEN 1 END) FROM customer
""")
def contract_null_rules(t):
    report = contract_report(_tree(t), CONTRACTS["clone_tree"])
    return report.where(F.col("check").endswith("is null") & (F.col("n_bad") > 0)).select("check", "n_bad")


@query("""
    SELECT 'column types' AS "check", CAST(7 AS BIGINT) AS n_bad FROM customer HAVING count(*) > 0
""")
def contract_types(t):
    """Six columns of a tree are missing, one has another type."""
    return contract_report(_tree(t), CONTRACTS["clone_tree"]).where("check = 'column types'").select("check", "n_bad")


@query("""
    WITH tree AS (SELECT CASE WHEN c_custkey % 11 > 0 THEN c_custkey % 9 END AS t, c_custkey AS n,
                         CASE WHEN c_custkey < 9 THEN NULL WHEN c_custkey % 13 = 0 THEN -1 WHEN c_custkey % 17 > 0 THEN c_custkey - 9 END AS p
                  FROM customer)
    SELECT DISTINCT 'LTX' || c.t || '-Tumour1' AS tumour_id, 'clone' || c.p AS parent
    FROM tree c WHERE c.t IS NOT NULL AND c.p IS NOT NULL AND NOT EXISTS (SELECT 1 FROM tree o WHERE o.t = c.t AND o.n = c.p)
""")
def tree_parent_key(t):
    """Parents that are no clones of their tumour; the virtual root and null are none."""
    tree = _tree(t)
    return foreign_key_orphans(tree, tree, CONTRACTS["clone_tree"].foreign_keys[0])
