"""The named joins between cohort tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from clonarium.operators import aggregates, joins
from testdata_queries.registry import query
from testdata_queries.summaries import _expression


@query("""
    WITH c AS (SELECT 'LTX' || o_orderkey || '_SU_T1-R' || (o_custkey % 4 + 1) || '--0a' AS sample_name_hash,
                      o_orderpriority AS gene_id, CAST(o_custkey AS DOUBLE) AS counts FROM orders WHERE o_orderstatus <> 'P'),
    p AS (SELECT 'LTX' || o_orderkey || '_SU_T1-R' || (o_custkey % 4 + 1) || '--0a' AS sample_name_hash,
                 o_orderpriority AS gene_id, floor(o_totalprice) AS tpm FROM orders WHERE o_orderkey % 3 > 0)
    SELECT coalesce(c.sample_name_hash, p.sample_name_hash) AS sample_name_hash,
           coalesce(c.gene_id, p.gene_id) AS gene_id, coalesce(counts, -1) AS counts, coalesce(tpm, -1) AS tpm
    FROM c FULL JOIN p ON c.sample_name_hash = p.sample_name_hash AND c.gene_id = p.gene_id
""")
def full_join_pair(t):
    key = ["'LTX' || o_orderkey || '_SU_T1-R' || (o_custkey % 4 + 1) || '--0a' AS sample_name_hash",
           "o_orderpriority AS gene_id"]
    counts = t.orders.where("o_orderstatus <> 'P'").selectExpr(*key, "double(o_custkey) AS counts")
    tpm = t.orders.where("o_orderkey % 3 > 0").selectExpr(*key, "double(floor(o_totalprice)) AS tpm")
    both = joins.expression_table(counts, tpm, check_keys=False)
    return both.select(
        "sample_name_hash", "gene_id",
        F.coalesce("counts", F.lit(-1.0)).alias("counts"), F.coalesce("tpm", F.lit(-1.0)).alias("tpm"),
    )


@query("""
    SELECT 's' || o_orderkey AS sample_name_hash, o_orderstatus AS gene_id, CAST(o_orderkey % 4 + 1 AS INTEGER) AS region_ordinal,
           CAST(o_custkey AS DOUBLE) AS counts, floor(o_totalprice) AS tpm
    FROM orders
""")
def expression_pair(t):
    """Both sides carry the same samples and genes, which the join checks first."""
    name = "'LTX' || o_orderkey || '_SU_T1-R' || (o_orderkey % 4 + 1) || '--0a' AS sample_name_hash"
    counts = t.orders.selectExpr(name, "o_orderstatus AS gene_id", "double(o_custkey) AS counts")
    tpm = t.orders.selectExpr(name, "o_orderstatus AS gene_id", "double(floor(o_totalprice)) AS tpm")
    both = joins.expression_table(counts, tpm)
    return both.select(
        F.concat(F.lit("s"), F.expr("substr(patient_id, 4)")).alias("sample_name_hash"),
        "gene_id", "region_ordinal", "counts", "tpm",
    )


@query("""
    WITH scores AS (SELECT l_partkey % 3 AS tumour_id, l_suppkey % 5 AS chr, l_partkey AS pos, max(l_tax) AS score
                    FROM lineitem WHERE l_linenumber < 3 GROUP BY 1, 2, 3)
    SELECT m.l_returnflag, count(*) AS n_rows, count(s.score) AS n_scored,
           CAST(sum(CAST(round(s.score * 100) AS BIGINT)) AS BIGINT) AS sum_score
    FROM lineitem m LEFT JOIN scores s
      ON m.l_partkey % 3 = s.tumour_id AND m.l_suppkey % 5 = s.chr AND m.l_partkey = s.pos
    GROUP BY 1
""")
def mutation_score_join(t):
    locus = ["string(l_partkey % 3) AS tumour_id", "string(l_suppkey % 5) AS chr", "l_partkey AS pos", "'A' AS alt"]
    raw = t.lineitem.where("l_linenumber < 3").selectExpr(
        *locus, "l_tax AS am_pathogenicity", "l_returnflag AS am_class"
    )
    scores = aggregates.best_score_per_variant(raw).drop("am_class")
    joined = joins.mutations_with_scores(t.lineitem.selectExpr(*locus, "l_returnflag"), scores)
    return joined.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("am_pathogenicity").alias("n_scored"),
        F.sum(F.round(F.col("am_pathogenicity") * 100).cast("bigint")).alias("sum_score"),
    )


@query("""
    SELECT c.c_mktsegment AS status, count(*) AS n_mutations
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_orderkey % 10 > 0 GROUP BY 1
""")
def mutation_tree_join(t):
    mutations = t.orders.selectExpr(
        "'T' || (o_custkey % 3) AS tumour_id", "if(o_orderkey % 10 = 0, null, 'clone' || o_custkey) AS clone"
    )
    tree = t.customer.selectExpr(
        "'T' || (c_custkey % 3) AS tumour_id", "'clone' || c_custkey AS clone", "c_mktsegment AS status"
    )
    joined = joins.mutations_on_tree(mutations, tree)
    return joined.groupBy("status").agg(F.count(F.lit(1)).alias("n_mutations"))


@query("""
    SELECT 'G' || p_partkey AS gene_name, p_brand, coalesce(s.s_nationkey % 2 = 0, false) AS mut_driver,
           coalesce(s.s_nationkey % 3 = 0, false) AS "CN_driver"
    FROM part LEFT JOIN supplier s ON p_partkey = s.s_suppkey * 3
""")
def driver_flag_join(t):
    genes = t.part.selectExpr("'G' || p_partkey AS gene_name", "p_brand")
    drivers = t.supplier.selectExpr(
        "'G' || (s_suppkey * 3) AS Hugo_Symbol", "s_nationkey % 2 = 0 AS mut_driver", "s_nationkey % 3 = 0 AS CN_driver"
    )
    return joins.genes_with_driver_flags(genes, drivers, ["mut_driver", "CN_driver"])


@query("""
    SELECT p.p_type AS driver_role, count(*) AS n_mutations, CAST(sum(l_quantity) AS BIGINT) AS reads
    FROM lineitem JOIN part p ON l_partkey = p.p_partkey WHERE p.p_size <= 10 GROUP BY 1
""")
def gene_join(t):
    mutations = t.lineitem.selectExpr("'G' || l_partkey AS gene", "l_quantity")
    drivers = t.part.where("p_size <= 10").selectExpr("'G' || p_partkey AS Hugo_Symbol", "p_type AS driver_role")
    joined = joins.mutations_in_drivers(mutations, drivers)
    return joined.groupBy("driver_role").agg(
        F.count(F.lit(1)).alias("n_mutations"), F.sum("l_quantity").cast("bigint").alias("reads")
    )


_ORDER_TUMOURS = ["'LTX' || o_custkey || '-Tumour' || (o_orderkey % 2 + 1) AS tumour_id", "o_totalprice"]


@query("""
    SELECT c_mktsegment AS histology, count(*) AS n_rows,
           CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1
""")
def patient_join(t):
    clinical = t.customer.selectExpr("'LTX' || c_custkey AS Patient_ID", "c_mktsegment AS histology")
    joined = joins.with_patient_record(t.orders.selectExpr(*_ORDER_TUMOURS), clinical)
    return joined.groupBy("histology").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"),
    )


@query("""
    SELECT c_mktsegment AS histology, o_orderkey % 2 + 1 AS tumour_ordinal, count(*) AS n_rows
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderkey % 2 = 0 OR c_nationkey < 5 GROUP BY 1, 2
""")
def tumour_record_join(t):
    per_tumour = t.customer.selectExpr(
        "explode(if(c_nationkey < 5, array(1L, 2L), array(1L))) AS tumour_ordinal", "c_custkey", "c_mktsegment AS histology"
    ).selectExpr("'LTX' || c_custkey || '-Tumour' || tumour_ordinal AS tumour_id", "tumour_ordinal", "histology")
    joined = joins.with_tumour_record(t.orders.selectExpr(*_ORDER_TUMOURS), per_tumour)
    return joined.groupBy("histology", "tumour_ordinal").agg(F.count(F.lit(1)).alias("n_rows"))


@query("""
    WITH expr AS (SELECT l_orderkey AS s, l_partkey AS g, max(l_quantity) AS tpm FROM lineitem
                  WHERE l_returnflag <> 'R' GROUP BY 1, 2)
    SELECT m.l_linestatus, count(*) AS n_rows, CAST(sum(e.tpm) AS BIGINT) AS sum_tpm
    FROM lineitem m JOIN expr e ON m.l_orderkey = e.s AND m.l_partkey = e.g GROUP BY 1
""")
def sample_join(t):
    key = ["'s' || l_orderkey AS sample_name_hash", "'G' || l_partkey AS gene"]
    expression = (
        t.lineitem.where("l_returnflag <> 'R'")
        .selectExpr("'s' || l_orderkey AS sample_name_hash", "'G' || l_partkey AS gene_id", "l_quantity")
        .groupBy("sample_name_hash", "gene_id")
        .agg(F.max("l_quantity").alias("tpm"))
    )
    joined = joins.expression_of_mutations(t.lineitem.selectExpr(*key, "l_linestatus"), expression)
    return joined.groupBy("l_linestatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("tpm").cast("bigint").alias("sum_tpm")
    )


@query("""
    SELECT c_mktsegment AS histology, o_orderstatus = 'F' AS is_normal, count(*) AS n_rows,
           CAST(sum(floor(o_totalprice)) AS BIGINT) AS sum_tpm
    FROM orders JOIN customer ON o_custkey % 10 = c_custkey GROUP BY 1, 2
""")
def expression_patient_join(t):
    clinical = t.customer.selectExpr("'T' || c_custkey AS Patient_ID", "c_mktsegment AS histology")
    joined = joins.expression_with_patient(_expression(t), clinical)
    return joined.groupBy("histology", "is_normal").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("tpm").cast("bigint").alias("sum_tpm")
    )


@query("""
    WITH n AS (SELECT o_custkey % 10 AS p, o_orderpriority AS g, avg(CAST(floor(o_totalprice) AS DOUBLE)) AS tpm_normal
               FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)
    SELECT 'T' || p AS patient_id, g AS gene_id, count(*) AS n_rows,
           count(CASE WHEN floor(o_totalprice) > tpm_normal THEN 1 END) AS n_above
    FROM orders JOIN n ON o_custkey % 10 = p AND o_orderpriority = g WHERE o_orderstatus <> 'F' GROUP BY 1, 2
""")
def tumour_normal_pair(t):
    expression = _expression(t)
    paired = joins.tumour_against_normal(expression, aggregates.paired_normals(expression))
    return paired.groupBy("patient_id", "gene_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("tpm") > F.col("tpm_normal")).alias("n_above")
    )


@query("""
    WITH cn AS (SELECT c_custkey, sum(o_orderkey % 6) AS total_cn FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1)
    SELECT c.c_custkey % 3 AS tumour, c_mktsegment AS clonality, CAST(sum(total_cn) AS BIGINT) AS sum_cn, count(*) AS n_clones
    FROM customer c JOIN cn ON c.c_custkey = cn.c_custkey JOIN supplier ON c.c_custkey % 3 = s_suppkey
    WHERE s_suppkey <> 1 GROUP BY 1, 2
""")
def clone_joins(t):
    """Copy number by clone, joined to clone flags and then to a per-tumour table."""
    copy_number = (
        t.orders.selectExpr("'T' || (o_custkey % 3) AS tumour_id", "'clone' || o_custkey AS clone", "o_orderkey % 6 AS cn")
        .groupBy("tumour_id", "clone")
        .agg(F.sum("cn").alias("total_cn"))
    )
    flags = t.customer.selectExpr(
        "'T' || (c_custkey % 3) AS tumour_id", "'clone' || c_custkey AS clone", "c_mktsegment AS clonality"
    )
    seeding = t.supplier.where("s_suppkey <> 1").selectExpr(
        "'T' || s_suppkey AS tumour_id", "s_suppkey AS tumour"
    )
    joined = joins.on_tumour(joins.on_clone(copy_number, flags), seeding)
    return joined.groupBy("tumour", "clonality").agg(
        F.sum("total_cn").alias("sum_cn"), F.count(F.lit(1)).alias("n_clones")
    )
