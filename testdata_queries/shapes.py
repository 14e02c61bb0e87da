"""Wide to long, column groups to rows, paired lists, nested matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from clonarium.operators import reshape
from clonarium.session import scratch_path
from clonarium.sources import bundles
from testdata_queries.registry import query


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, variable, value FROM (
      SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_tax FROM lineitem)
    UNPIVOT INCLUDE NULLS (value FOR variable IN (l_quantity, l_discount, l_tax))
""")
def melt_matrix(t):
    wide = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax")
    return reshape.melt(wide, ["l_orderkey", "l_linenumber", "l_partkey"])


@query("""
    SELECT 's.' || i AS sample, count(*) AS n_rows,
           CAST(sum(CASE WHEN (p_partkey + i) % 10 > 0 THEN (p_partkey * i) % 97 END) AS BIGINT) AS total
    FROM part, range(300) r(i) GROUP BY 1
""")
def melt_wide_matrix(t):
    """300 sample columns with dotted names, some cells empty."""
    wide = t.part.selectExpr(
        "p_partkey",
        *[f"if((p_partkey + {i}) % 10 > 0, double((p_partkey * {i}) % 97), null) AS `s.{i}`" for i in range(300)],
    )
    long = reshape.melt(wide, ["p_partkey"], variable="sample")
    return long.groupBy("sample").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("value").cast("bigint").alias("total")
    )


@query("""
    WITH rows AS (
      SELECT 'LTX' || o_orderkey AS patient, 1 AS tumour_ordinal,
             CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus END AS histology,
             CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END AS size FROM orders
      UNION ALL
      SELECT 'LTX' || o_orderkey, 2, CASE WHEN o_orderkey % 5 = 0 THEN o_orderpriority END, NULL FROM orders)
    SELECT patient, tumour_ordinal, histology, coalesce(size, -1) AS size, CAST(NULL AS VARCHAR) AS margin
    FROM rows WHERE histology IS NOT NULL OR size IS NOT NULL
""")
def numbered_groups(t):
    wide = t.orders.selectExpr(
        "'LTX' || o_orderkey AS patient",
        "if(o_orderkey % 4 > 0, o_orderstatus, null) AS `histology1.reviewed`",
        "if(o_orderkey % 5 = 0, o_orderpriority, null) AS `histology2.reviewed`",
        "if(o_orderkey % 3 > 0, o_custkey, null) AS `size1.reviewed`",
    )
    columns = {
        "histology{n}.reviewed": "histology", "size{n}.reviewed": "size", "margin{n}.reviewed": "margin"
    }
    rows = reshape.numbered_groups_to_rows(wide, ["patient"], columns, (1, 2), "tumour_ordinal")
    return rows.withColumn("size", F.coalesce("size", F.lit(-1)))


@query("""
    SELECT 'LTX' || c_custkey AS "Patient_ID", i AS tumour_ordinal, 'LTX' || c_custkey || '-Tumour' || i AS tumour_id,
           c_mktsegment AS histology, CASE WHEN i = 1 THEN 'site' || c_nationkey END AS lesion_site
    FROM customer, (SELECT unnest([1, 2]) AS i) WHERE i = 1 OR c_custkey % 8 = 0
""")
def lesion_unpivot(t):
    clinical = t.customer.select(
        F.expr("'LTX' || c_custkey").alias("Patient_ID"),
        F.col("c_mktsegment").alias("histology1_central.reviewed"),
        F.expr("if(c_custkey % 8 = 0, c_mktsegment, null)").alias("histology2_central.reviewed"),
        F.expr("'site' || c_nationkey").alias("Lesion1_site_central.reviewed"),
    )
    rows = reshape.lesions_to_tumours(clinical)
    return rows.select("Patient_ID", "tumour_ordinal", "tumour_id", "histology", "lesion_site")


@query("""
    WITH lists AS (SELECT c_custkey, c_custkey % 4 + 1 AS n, CASE WHEN c_custkey % 10 = 0 THEN greatest(c_custkey % 4, 1) ELSE c_custkey % 4 + 1 END AS m FROM customer)
    SELECT c_custkey, CAST(i AS INTEGER) AS position, 'c' || (c_custkey + i) AS clonality,
           CASE WHEN i < m THEN 'p' || (c_custkey * 2 + i) END AS phyletic
    FROM lists, range(4) r(i) WHERE i < n AND c_custkey % 6 > 0
""")
def paired_list_explode(t):
    lists = t.customer.selectExpr(
        "c_custkey",
        "if(c_custkey % 6 = 0, null, array_join(transform(sequence(0, c_custkey % 4), i -> 'c' || (c_custkey + i)), ';')) AS clonalities",
        """array_join(transform(slice(sequence(0, 9), 1,
               int(if(c_custkey % 10 = 0, greatest(c_custkey % 4, 1), c_custkey % 4 + 1))), i -> 'p' || (c_custkey * 2 + i)), ';') AS phyletics""",
    )
    return reshape.paired_lists_to_rows(
        lists.where("clonalities IS NOT NULL"), {"clonalities": "clonality", "phyletics": "phyletic"}
    )


@query("""
    WITH cells AS (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
    SELECT 'T' || label AS tumour_id, 'r' || i AS region, count(*) AS n_rows,
           CAST(sum(CAST(floor(CAST(v AS DOUBLE) * 1000) AS BIGINT)) AS BIGINT) AS sum_ccf
    FROM cells GROUP BY 1, 2
""")
def matrix_bundle_explode(t):
    bundle = t.embeddings.selectExpr(
        "'T' || label AS sample_id",
        "array('clone' || vec_id) AS clones",
        "transform(embedding, (v, i) -> 'r' || i) AS regions",
        "array(transform(embedding, v -> int(floor(double(v) * 1000)))) AS ccf",
    )
    rows = bundles.bundle_rows(bundle, "ccf", "ccf")
    return rows.groupBy("tumour_id", "region").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("ccf").alias("sum_ccf")
    )


def _bundle_file(t):
    """Two clones by three regions per order, as JSON lines; some lack a matrix or the id."""
    records = t.orders.selectExpr(
        "if(o_orderkey % 11 = 0, null, 'LTX' || o_orderkey || '_1') AS sample_id",
        "array('R1', 'R2', 'R3') AS regions",
        "array('1', '2') AS clones",
        """if(o_orderkey % 13 = 0, null, array(array(int(o_custkey % 101), 50, 0),
               array(int(o_custkey % 7), int(o_custkey % 5), 1))) AS ccf""",
        "array(array('clonal', 'clonal', 'absent'), array('subclonal', 'absent', 'subclonal')) AS clonality",
    )
    path = scratch_path(t.spark, "bundles")
    records.write.json(path)
    return bundles.split_bundles(bundles.read_bundles(t.spark, path))


@query("""
    WITH good AS (SELECT * FROM orders WHERE o_orderkey % 11 > 0 AND o_orderkey % 13 > 0)
    SELECT 'LTX' || o_orderkey || '_1' AS tumour_id, CAST(c AS VARCHAR) AS clone, 'R' || r AS region,
           CAST(CASE WHEN c = 1 THEN CASE r WHEN 1 THEN o_custkey % 101 WHEN 2 THEN 50 ELSE 0 END
                ELSE CASE r WHEN 1 THEN o_custkey % 7 WHEN 2 THEN o_custkey % 5 ELSE 1 END END AS INTEGER) AS ccf
    FROM good, (SELECT unnest([1, 2]) AS c), (SELECT unnest([1, 2, 3]) AS r)
""")
def scan_bundles(t):
    usable, _ = _bundle_file(t)
    return bundles.bundle_rows(usable, "ccf", "ccf")


@query("""
    SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'no sample id' ELSE 'matrix missing' END AS reason, count(*) AS n_bundles
    FROM orders WHERE o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 GROUP BY 1
""")
def scan_bundles_rejects(t):
    _, rejects = _bundle_file(t)
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n_bundles"))
