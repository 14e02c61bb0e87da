"""Scans and sinks: table slices are written to scratch files and read back."""

from __future__ import annotations

import re
import struct
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import functions as F

from clonarium.session import scratch_path
from clonarium.sources import delimited, headed, store
from testdata_queries.registry import query

_MARKED = [
    "l_orderkey",
    "l_linenumber",
    "if(l_linenumber = 1, 'NA', if(l_linenumber = 2, 'nan', string(l_discount))) AS score",
    "if(l_linenumber = 3, '-', l_returnflag) AS flag",
]
_TYPES = {"l_orderkey": "bigint", "l_linenumber": "int", "score": "double", "flag": "string"}
_SUMMARY_SQL = """
    SELECT l_linenumber, flag, count(*) AS n_rows, count(score) AS n_scored,
           CAST(sum(l_orderkey) AS BIGINT) AS sum_key, coalesce(max(score), -1) AS max_score
    FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber > 2 THEN l_discount END AS score,
                 CASE WHEN l_linenumber <> 3 THEN l_returnflag END AS flag FROM lineitem)
    GROUP BY 1, 2"""


def _summary(df):
    return df.groupBy("l_linenumber", "flag").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("score").alias("n_scored"),
        F.sum("l_orderkey").alias("sum_key"),
        F.coalesce(F.max("score"), F.lit(-1.0)).alias("max_score"),
    )


def _written(t, df, **options):
    path = scratch_path(t.spark, "delimited")
    df.write.options(**options).csv(path)
    return path


@query(_SUMMARY_SQL)
def scan_delimited(t):
    path = _written(t, t.lineitem.selectExpr(*_MARKED), sep="\t", header=True)
    return _summary(delimited.read_delimited(t.spark, path, _TYPES, markers=delimited.MARKERS_SCORES))


@query(_SUMMARY_SQL)
def scan_headerless(t):
    path = _written(t, t.lineitem.selectExpr(*_MARKED), sep=" ", header=False)
    return _summary(
        delimited.read_delimited(
            t.spark, path, _TYPES, sep=" ", markers=delimited.MARKERS_SCORES, names=list(_TYPES)
        )
    )


@query(_SUMMARY_SQL)
def scan_gzip(t):
    path = _written(t, t.lineitem.selectExpr(*_MARKED), sep="\t", header=True, compression="gzip")
    return _summary(
        delimited.read_delimited(t.spark, path, _TYPES, markers=delimited.MARKERS_SCORES, partitions=16)
    )


def _block_gzip_writer(root):
    """Writes each task's lines as one block gzip file of members of some 16 KB, with a header of its own."""
    header = "\t".join(_TYPES)

    def member(text):
        packed = zlib.compressobj(wbits=-15)
        body = packed.compress(text) + packed.flush()
        # Fixed values of the format: deflate with the extra field BC, which holds the size less one.
        head = b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff\x06\x00BC\x02\x00" + struct.pack("<H", len(body) + 25)
        return head + body + struct.pack("<II", zlib.crc32(text), len(text))

    def write(batches):
        files, folder = fs.FileSystem.from_uri(re.sub("^file:/+", "/", root))
        files.create_dir(folder, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}.tsv.gz"
        with files.open_output_stream(f"{folder}/{name}", compression=None) as out:
            rest = (header + "\n").encode()
            for batch in batches:
                rest += "".join(f"{line}\n" for line in batch.column(0).to_pylist()).encode()
                cut = len(rest) - len(rest) % 16000
                for at in range(0, cut, 16000):
                    out.write(member(rest[at : at + 16000]))
                rest = rest[cut:]
            out.write(member(rest) + member(b""))
        yield pa.RecordBatch.from_pydict({"name": [name]})

    return write


@query(_SUMMARY_SQL)
def scan_block_gzip(t):
    """Files of many gzip members that lines and tasks cut across."""
    root = scratch_path(t.spark, "block-gzip")
    lines = t.lineitem.selectExpr(*_MARKED).select(F.concat_ws("\t", *_TYPES))
    lines.mapInArrow(_block_gzip_writer(root), "name string").write.format("noop").mode("overwrite").save()
    return _summary(
        delimited.read_delimited(t.spark, f"{root}/*.gz", _TYPES, markers=delimited.MARKERS_SCORES, partitions=16)
    )


@query("SELECT p_brand, count(*) AS n_rows FROM part GROUP BY 1")
def scan_parquet(t):
    df = delimited.read_parquet_columns(t.spark, f"{t.sf_dir}/part.parquet", ["p_partkey", "p_brand"])
    return df.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n_rows"))


@query("""
    SELECT 'customer' AS "table", count(*) AS n_rows, true AS is_recent, 'sandbox' AS mode FROM customer
    UNION ALL SELECT 'orders', count(*), true, 'sandbox' FROM orders
""")
def manifest_json(t):
    """The manifest as it is read back from JSON, its time included."""
    root = scratch_path(t.spark, "store")
    for name, key in (("customer", "c_custkey"), ("orders", "o_orderkey")):
        store.write_table(getattr(t, name).select(key), root, name, [key])
    manifest = store.write_manifest(t.spark, root, ["customer", "orders"], t.sf_dir, "sandbox")
    recent = F.col("built_at_utc").between(F.current_timestamp() - F.expr("INTERVAL 1 HOUR"), F.current_timestamp())
    return manifest.select("table", "n_rows", recent.alias("is_recent"), "mode")


# The entities of the per-entity files are the three values of l_returnflag.
_ENTITIES = ("A", "N", "R")


def _per_entity_files(t, columns, sep, name):
    """One directory of files per entity; every file has its own header."""
    root = scratch_path(t.spark, name)
    for entity in _ENTITIES:
        rows = t.lineitem.where(F.col("l_returnflag") == entity).selectExpr(*columns(entity))
        rows.write.options(sep=sep, header=True).csv(f"{root}/{entity}")
    return f"{root}/*"


@query("""
    SELECT l_returnflag AS entity, l_linenumber % 4 AS chr, count(*) AS n_rows,
           count(CASE WHEN l_linenumber > 2 THEN 1 END) AS n_scored, CAST(sum(l_partkey) AS BIGINT) AS sum_pos
    FROM lineitem GROUP BY 1, 2
""")
def scan_per_entity_union(t):
    """The same columns in another order in each entity's files, next to unused ones."""
    columns = ["l_partkey AS pos", "l_linenumber % 4 AS chr", "if(l_linenumber > 2, string(l_discount), 'NA') AS score", "l_tax"]
    order = {"A": [0, 1, 2, 3], "N": [3, 2, 1, 0], "R": [1, 3, 0, 2]}
    path = _per_entity_files(t, lambda e: [columns[i] for i in order[e]], "\t", "entities")
    scores = headed.read_entity_columns(
        t.spark, path, headed.key_from_directory(), {"pos": "bigint", "chr": "int", "score": "double"},
        markers=delimited.MARKERS_SCORES,
    )
    return scores.groupBy("entity", "chr").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("score").alias("n_scored"), F.sum("pos").alias("sum_pos")
    )


def _ragged(t):
    """Sample columns that differ per entity; the files of entity R hold text in a cell."""

    def columns(entity):
        samples = [f"l_quantity AS `{entity}-q`", f"if(l_linenumber = 1, 'NA', string(l_tax)) AS `{entity}-t`"]
        if entity == "R":
            return ["'clone' || l_linenumber AS clone", "if(l_linenumber = 7, 'seven', '0') AS `R-x`"]
        if entity == "N":
            return ["l_discount AS `N-d`", *samples, "'clone' || l_linenumber AS clone"]
        return [*samples, "'clone' || l_linenumber AS clone"]

    path = _per_entity_files(t, columns, ",", "ragged")
    return headed.read_ragged_matrices(
        t.spark, path, "clone", key="tumour_id", column="sample_id", value="proportion",
        markers=delimited.MARKERS_PLAIN,
    )


@query("""
    WITH long AS (
      SELECT l_returnflag AS tumour_id, 'clone' || l_linenumber AS clone, l_returnflag || '-q' AS sample_id, l_quantity AS v
      FROM lineitem WHERE l_returnflag <> 'R'
      UNION ALL SELECT l_returnflag, 'clone' || l_linenumber, l_returnflag || '-t', CASE WHEN l_linenumber > 1 THEN l_tax END
      FROM lineitem WHERE l_returnflag <> 'R'
      UNION ALL SELECT 'N', 'clone' || l_linenumber, 'N-d', l_discount FROM lineitem WHERE l_returnflag = 'N')
    SELECT tumour_id, clone, sample_id, count(*) AS n_rows, count(v) AS n_values, coalesce(max(v), -1) AS max_value
    FROM long GROUP BY 1, 2, 3
""")
def ragged_melt(t):
    long, _ = _ragged(t)
    return long.groupBy("tumour_id", "clone", "sample_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("proportion").alias("n_values"),
        F.coalesce(F.max("proportion"), F.lit(-1.0)).alias("max_value"),
    )


@query("SELECT 'R' AS tumour_id, 'cell is not a number' AS reason")
def ragged_rejects(t):
    _, rejects = _ragged(t)
    return rejects.select(headed.key_from_directory().alias("tumour_id"), "reason").distinct()


_ALL_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


@query(" UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS n_rows FROM {n}" for n in _ALL_TABLES))
def manifest_counts(t):
    return store.row_counts({n: getattr(t, n) for n in _ALL_TABLES})


@query(" UNION ALL ".join(f"SELECT '{n}' AS \"table\", 64 AS digest_chars, true AS has_size" for n in _ALL_TABLES))
def source_provenance(t):
    found = store.source_provenance(t.spark, f"{t.sf_dir}/*.parquet")
    name = F.regexp_extract("path", r"/([a-z]+)\.parquet", 1).alias("table")
    return found.select(name, F.length("digest").alias("digest_chars"), (F.col("n_bytes") > 0).alias("has_size")).distinct()


@query()
def source_files(t):
    """One row per file of the tables with its real digest and size; tested against hashlib."""
    found = store.source_provenance(t.spark, f"{t.sf_dir}/*.parquet")
    name = F.regexp_extract("path", r"/([^/]+\.parquet(?:/.*)?)$", 1).alias("file")
    return found.select(name, "n_bytes", "digest")


_HEADERS = {"A": ["l_orderkey"], "N": ["l_orderkey", "l_linenumber"], "R": ["l_orderkey", "l_linenumber", "l_quantity", "l_tax"]}


@query(" UNION ALL ".join(
    f"SELECT DISTINCT '{flag}' AS folder, {len(names)} AS n_columns FROM lineitem WHERE l_returnflag = '{flag}'"
    for flag, names in _HEADERS.items()
))
def header_widths(t):
    """The columns that the headers of three text files written from lineitem name."""
    root = scratch_path(t.spark, "headers")
    for flag, names in _HEADERS.items():
        rows = t.lineitem.where(F.col("l_returnflag") == flag).select(names)
        rows.repartition(1).write.options(header=True, sep="\t").csv(f"{root}/{flag}")
    return store.header_sizes(t.spark, f"{root}/*").select(headed.key_from_directory().alias("folder"), "n_columns")


@query("""
    SELECT l_returnflag AS tumour_id, CASE l_returnflag WHEN 'A' THEN 'line longer than the header'
             WHEN 'N' THEN 'line shorter than the header' ELSE '' END AS reason,
           CASE WHEN l_returnflag = 'R' THEN count(*) ELSE 0 END AS n_values
    FROM lineitem GROUP BY l_returnflag
""")
def scan_bad_lines(t):
    """Every 100th line of two entities has a cell too many or too few; their files are rejected."""
    root = scratch_path(t.spark, "bad-lines")
    for entity, bad in (("A", "'1,2,3'"), ("N", "'1'"), ("R", "'1,2'")):
        rows = t.lineitem.where(F.col("l_returnflag") == entity)
        line = f"if(pmod(xxhash64(l_orderkey, l_linenumber), 100) = 0 OR l_linenumber = 1, {bad}, l_linenumber || ',' || l_quantity)"
        # The header of a one-column file is its column's name.
        rows.selectExpr(f"{line} AS `clone,{entity}`").repartition(1).write.options(header=True, sep="\t").csv(f"{root}/{entity}")
    good, rejects = headed.read_ragged_matrices(
        t.spark, f"{root}/*", "clone", key="tumour_id", value="proportion", markers=delimited.MARKERS_PLAIN
    )
    found = good.groupBy("tumour_id").agg(F.lit("").alias("reason"), F.count("proportion").alias("n_values"))
    left_out = rejects.select(headed.key_from_directory().alias("tumour_id"), "reason").distinct()
    return found.unionByName(left_out.withColumn("n_values", F.lit(0).cast("bigint")))


@query("""
    SELECT count(*) AS n_rows, CAST(sum(l_orderkey) AS BIGINT) AS sum_key,
           count(CASE WHEN l_linenumber = 2 THEN 1 END) AS n_like_header FROM lineitem
""")
def scan_header_lines(t):
    """Lines equal to the header are rows; only each file's first line is its header."""
    key = "if(l_linenumber = 2, 'k', string(l_orderkey)) AS k"
    path = _written(t, t.lineitem.selectExpr(key, "if(l_linenumber = 2, 'v', string(l_orderkey)) AS v"), sep="\t", header=True, compression="gzip")
    rows = delimited.read_delimited(t.spark, path, {"k": "string", "v": "string"}, partitions=16)
    like_header = rows.where("k = 'k' AND v = 'v'").agg(F.count(F.lit(1)).alias("n_like_header"))
    replaced = t.lineitem.where("l_linenumber = 2").agg(F.sum("l_orderkey").alias("hidden"))
    whole = rows.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("k").try_cast("bigint")).alias("shown"))
    both = whole.crossJoin(like_header).crossJoin(replaced)  # one row each
    return both.select("n_rows", (F.col("shown") + F.col("hidden")).alias("sum_key"), "n_like_header")


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders
""")
def store_roundtrip(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    root = scratch_path(t.spark, "store")
    store.write_table(orders, root, "orders", ["o_custkey", "o_orderkey"])
    return store.read_table(t.spark, root, "orders")


@query("""
    SELECT l_returnflag AS flag, l_linenumber, count(*) AS n_rows, CAST(sum(l_orderkey) AS BIGINT) AS sum_key,
           CAST(sum(length('order ' || l_orderkey || chr(10) || chr(10) || '"line", ' || l_linenumber)) AS BIGINT) AS n_chars,
           max('"line", ' || l_linenumber) AS last_line
    FROM lineitem GROUP BY 1, 2
""")
def scan_quoted_breaks(t):
    """Cells of three lines each, with quotes and separators in them."""
    note = "concat('order ', l_orderkey, '\\n\\n\"line\", ', l_linenumber) AS note"
    path = _written(t, t.lineitem.selectExpr("l_orderkey", note, "l_returnflag AS flag"), header=True, escape='"', quoteAll=True)
    rows = delimited.read_delimited(t.spark, path, {"l_orderkey": "bigint", "note": "string", "flag": "string"}, sep=",", markers=[])
    last = F.element_at(F.split("note", "\n"), -1)
    number = F.regexp_extract(last, r"(\d+)$", 1).cast("int").alias("l_linenumber")
    return rows.groupBy("flag", number).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("l_orderkey").alias("sum_key"), F.sum(F.length("note")).alias("n_chars"), F.max(last).alias("last_line")
    )


def _renamed_files(t, folder, suffix):
    """Give the data files of a scratch folder another suffix."""
    hadoop = t.spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(folder)
    fs = place.getFileSystem(t.spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(place):
        if status.getPath().getName().startswith("part-"):
            fs.rename(status.getPath(), status.getPath().suffix(suffix))


@query("""
    SELECT l_returnflag AS tumour_id, CASE WHEN l_returnflag = 'R' THEN 'gzip' ELSE '' END AS reason,
           CASE WHEN l_returnflag = 'R' THEN 0 ELSE count(*) END AS n_values
    FROM lineitem GROUP BY l_returnflag
""")
def scan_broken_files(t):
    """The files of one of three entities are called packed but are not: these are left out, with a reason."""
    root = scratch_path(t.spark, "broken")
    for entity in _ENTITIES:
        rows = t.lineitem.where(F.col("l_returnflag") == entity).selectExpr("l_linenumber AS clone", f"l_quantity AS {entity}")
        rows.write.options(header=True, compression="none" if entity == "R" else "gzip").csv(f"{root}/{entity}")
    _renamed_files(t, f"{root}/R", ".gz")
    good, rejects = headed.read_ragged_matrices(
        t.spark, f"{root}/*", "clone", key="tumour_id", value="proportion", markers=delimited.MARKERS_PLAIN
    )
    found = good.groupBy("tumour_id").agg(F.lit("").alias("reason"), F.count("proportion").alias("n_values"))
    left_out = rejects.select(headed.key_from_directory().alias("tumour_id"), F.split("reason", ":")[0].alias("reason")).distinct()
    return found.unionByName(left_out.withColumn("n_values", F.lit(0).cast("bigint")))
