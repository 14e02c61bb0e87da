"""Clone trees. Customers are clones; three or twenty-five tumours share them."""

from __future__ import annotations

from pyspark.sql import functions as F

from clonarium.operators import trees as tree_ops
from testdata_queries.registry import query

# A third of all clones per tumour; a binary tree by arithmetic on the clone number.
_FOREST = """
    forest AS (SELECT 'T' || (c_custkey % 3) AS tumour_id, c_custkey // 3 + 1 AS n,
                      (c_custkey // 3 + 1) // 2 AS p, c_custkey % 3 + c_custkey % 2 AS gds FROM customer)"""
_WALK = """
    walk AS (SELECT tumour_id, n, CAST(gds AS BIGINT) AS total FROM forest WHERE p = 0
             UNION ALL
             SELECT f.tumour_id, f.n, CAST(f.gds + w.total AS BIGINT)
             FROM forest f JOIN walk w ON f.tumour_id = w.tumour_id AND f.p = w.n)"""


def _forest(t):
    return t.customer.selectExpr(
        "'T' || (c_custkey % 3) AS tumour_id",
        "'clone' || (c_custkey div 3 + 1) AS clone",
        "if(c_custkey < 3, 'diploid', 'clone' || ((c_custkey div 3 + 1) div 2)) AS parent",
        "c_custkey % 3 + c_custkey % 2 AS number_of_gds_at_clone",
    )


@query(f"""
    WITH RECURSIVE {_FOREST}, {_WALK}
    SELECT w.tumour_id, 'clone' || w.n AS clone, f.p = 0 AS is_root, f.gds > 0 AS is_wgd_event_clone,
           w.total AS cumulative_gds_to_clone, w.total > 0 AS has_wgd_ancestor
    FROM walk w JOIN forest f ON w.tumour_id = f.tumour_id AND w.n = f.n
""")
def tree_cumulative(t):
    return tree_ops.clone_tree_table(_forest(t)).select(
        "tumour_id", "clone", "is_root", "is_wgd_event_clone", "cumulative_gds_to_clone", "has_wgd_ancestor"
    )


@query("""
    SELECT 'T' || (c_custkey % 25) AS tumour_id, c_custkey // 25 AS clone,
           CAST(sum(c_custkey % 3) OVER (PARTITION BY c_custkey % 25 ORDER BY c_custkey) AS BIGINT) AS total
    FROM customer
""")
def tree_cumulative_chain(t):
    chain = t.customer.selectExpr(
        "'T' || (c_custkey % 25) AS tumour_id",
        "c_custkey div 25 AS clone",
        "if(c_custkey < 25, null, c_custkey div 25 - 1) AS parent",
        "c_custkey % 3 AS weight",
    )
    return tree_ops.ancestor_sum(chain, weight="weight", total="total", root=None)


@query("""
    SELECT 'star' AS tumour_id, c_custkey AS clone,
           CAST(1 + CASE WHEN c_custkey > 0 THEN c_custkey % 5 ELSE 0 END AS BIGINT) AS total
    FROM customer
""")
def tree_cumulative_star(t):
    """One root is the parent of every other clone."""
    star = t.customer.selectExpr(
        "'star' AS tumour_id",
        "c_custkey AS clone",
        "if(c_custkey = 0, null, 0L) AS parent",
        "if(c_custkey = 0, 1, c_custkey % 5) AS weight",
    )
    return tree_ops.ancestor_sum(star, weight="weight", total="total", root=None)


def _labelled_tree(t):
    forest = t.customer.selectExpr(
        "'T' || (c_custkey % 25) AS tumour_id",
        "'clone' || (c_custkey div 25 + 1) AS clone",
        "if(c_custkey < 25, 'diploid', 'clone' || ((c_custkey div 25 + 1) div 2)) AS parent",
        "if(c_custkey % 25 % 5 = 0, 0, int((c_custkey div 25) % 4 = 2)) AS number_of_gds_at_clone",
        "if(c_custkey % 25 % 5 = 4, 'unresolved', 'resolved') AS status",
        "if(c_custkey % 25 % 5 = 0, 'no_wgd', 'mut_supported') AS class",
    )
    return tree_ops.clone_tree_table(forest)


def mutations_by_timing(t):
    """Orders as mutations of the customer's clone, counted per tumour and timing."""
    mutations = t.orders.selectExpr(
        "o_orderkey AS mutation_id",
        "'T' || (o_custkey % 25) AS tumour_id",
        "if(o_orderkey % 9 = 0, null, 'clone' || (o_custkey div 25 + 1)) AS clone",
    )
    timed = tree_ops.timed_mutations(mutations, _labelled_tree(t))
    return timed.groupBy("tumour_id", "wgd_timing").agg(F.count(F.lit(1)).alias("n_mutations"))


@query("""
    WITH RECURSIVE forest AS (
      SELECT c_custkey % 25 AS t, c_custkey // 25 + 1 AS n, (c_custkey // 25 + 1) // 2 AS p,
             CASE WHEN c_custkey % 25 % 5 = 0 THEN 0 WHEN (c_custkey // 25) % 4 = 2 THEN 1 ELSE 0 END AS gds
      FROM customer),
    walk AS (SELECT t, n, gds AS total FROM forest WHERE p = 0
             UNION ALL SELECT f.t, f.n, f.gds + w.total FROM forest f JOIN walk w ON f.t = w.t AND f.p = w.n)
    SELECT 'T' || w.t AS tumour_id,
           CASE WHEN w.t % 5 = 0 THEN 'no_wgd' WHEN w.total > 0 THEN 'post_wgd' ELSE 'pre_wgd' END AS wgd_timing,
           count(*) AS n_mutations
    FROM orders o JOIN walk w ON o.o_custkey % 25 = w.t AND o.o_custkey // 25 + 1 = w.n
    WHERE o.o_orderkey % 9 <> 0 AND w.t % 5 <> 4
    GROUP BY 1, 2
""")
def tree_label_mutations(t):
    return mutations_by_timing(t)


@query("""
    WITH RECURSIVE forest AS (
      SELECT c_custkey % 3 AS t, c_custkey // 3 + 1 AS n, (c_custkey // 3 + 1) // 2 AS p,
             c_custkey % 5 - 1 AS gds FROM customer),
    walk AS (SELECT t, n, p, CAST(gds AS BIGINT) AS total, CAST(NULL AS BIGINT) AS parent_total FROM forest WHERE p = 0
             UNION ALL SELECT f.t, f.n, f.p, CAST(f.gds + w.total AS BIGINT), w.total
             FROM forest f JOIN walk w ON f.t = w.t AND f.p = w.n)
    SELECT 'T' || t AS tumour_id, 'clone' || n AS clone, 'clone' || p AS parent,
           total AS cumulative_gds_to_clone, parent_total
    FROM walk WHERE total < parent_total
""")
def tree_monotone_violations(t):
    negative = _forest(t).drop("number_of_gds_at_clone").withColumn(
        "number_of_gds_at_clone",
        # the customer key again, from tumour and clone number
        F.expr("((bigint(substr(clone, 6)) - 1) * 3 + bigint(substr(tumour_id, 2))) % 5 - 1"),
    )
    return tree_ops.monotone_violations(tree_ops.clone_tree_table(negative))
