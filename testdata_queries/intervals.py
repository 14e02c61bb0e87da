"""Interval joins on positions minted from keys; a third of the rows share a tumour."""

from __future__ import annotations

from pyspark.sql import functions as F

from clonarium.functions.genome import on_primary_assembly
from clonarium.operators import intervals, joins, liftover
from clonarium.operators.aggregates import gene_extents
from clonarium.session import materialize
from testdata_queries.registry import query

_GENES = """
    tx AS (SELECT 'G' || l_partkey AS gene_name, 'chr' || ((l_partkey // 500) % 26 + 1) AS chromosome,
                  l_partkey * 100 + l_linenumber * 10 AS tx_start,
                  l_partkey * 100 + l_linenumber * 10 + CAST(l_quantity AS BIGINT) AS tx_end,
                  CASE WHEN l_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand
           FROM lineitem WHERE (l_partkey // 500) % 26 + 1 <= 22),
    genes AS (SELECT gene_name, chromosome, min(tx_start) AS start, max(tx_end) AS "end", min(strand) AS strand
              FROM tx GROUP BY 1, 2),
    bands AS (SELECT 'chr' || ((s_suppkey // 25) % 26 + 1) AS chromosome, s_suppkey * 2000 AS band_start,
                     s_suppkey * 2000 + 1900 + s_suppkey % 7 * 100 AS band_end, 'p' || s_suppkey AS band_name
              FROM supplier WHERE s_suppkey % 10 <> 3)"""


def _genes(t):
    transcripts = t.lineitem.selectExpr(
        "'G' || l_partkey AS gene_name",
        "'chr' || ((l_partkey div 500) % 26 + 1) AS chromosome",
        "l_partkey * 100 + l_linenumber * 10 AS tx_start",
        "l_partkey * 100 + l_linenumber * 10 + bigint(l_quantity) AS tx_end",
        "if(l_partkey % 2 = 0, '+', '-') AS strand",
        "l_orderkey AS line_no",
    )
    return materialize(gene_extents(transcripts.where(on_primary_assembly(F.col("chromosome")))), "genes")


def _bands(t):
    return t.supplier.where("s_suppkey % 10 <> 3").selectExpr(
        "'chr' || ((s_suppkey div 25) % 26 + 1) AS chromosome",
        "s_suppkey * 2000 AS band_start",
        "s_suppkey * 2000 + 1900 + s_suppkey % 7 * 100 AS band_end",
        "'p' || s_suppkey AS band_name",
    )


@query(f"WITH {_GENES} SELECT * FROM genes")
def gene_extent_from_transcripts(t):
    return _genes(t)


@query(f"""
    WITH {_GENES}
    SELECT g.gene_name, b.band_name, g.start, g."end" FROM genes g JOIN bands b
      ON g.chromosome = b.chromosome AND b.band_start < g."end" AND b.band_end > g.start
""")
def interval_overlap_bands(t):
    hits = intervals.interval_join(
        _genes(t), _bands(t), ["chromosome"], ("start", "end"), ("band_start", "band_end"),
        left_end_open=True, right_end_open=True,
    )
    return hits.select("gene_name", "band_name", "start", "end")


@query(f"""
    WITH {_GENES}
    SELECT g.gene_name, g.chromosome, g.start, g."end", g.strand,
           coalesce(string_agg(DISTINCT b.band_name, ';' ORDER BY b.band_name), '') AS cytoband_name
    FROM genes g LEFT JOIN bands b
      ON g.chromosome = b.chromosome AND b.band_start < g."end" AND b.band_end > g.start
    GROUP BY ALL
""")
def band_list_per_gene(t):
    return joins.bands_per_gene(_genes(t), _bands(t))


_SEGMENTS = """
    segments AS (SELECT 'T' || (p_partkey % 3) AS tumour_id, CAST(p_partkey % 5 AS VARCHAR) AS chr,
                        p_partkey AS segment_no, p_partkey * 50 AS segment_start,
                        p_partkey * 50 + p_size * 20 AS segment_end, p_size % 6 AS total_cn FROM part)"""


def _segments(t):
    return t.part.selectExpr(
        "'T' || (p_partkey % 3) AS tumour_id",
        "string(p_partkey % 5) AS chr",
        "p_partkey AS segment_no",
        "p_partkey * 50 AS segment_start",
        "p_partkey * 50 + p_size * 20 AS segment_end",
        "p_size % 6 AS total_cn",
    )


@query(f"""
    WITH {_SEGMENTS},
    mutations AS (SELECT 'T' || (l_orderkey % 3) AS tumour_id, CAST(l_suppkey % 5 AS VARCHAR) AS chr,
                         l_partkey * 50 + CAST(l_quantity AS BIGINT) AS pos FROM lineitem)
    SELECT m.tumour_id, m.chr, s.total_cn, count(*) AS n_pairs, CAST(sum(m.pos - s.segment_start) AS BIGINT) AS sum_offset
    FROM mutations m JOIN segments s ON m.tumour_id = s.tumour_id AND m.chr = s.chr
      AND m.pos BETWEEN s.segment_start AND s.segment_end
    GROUP BY 1, 2, 3
""")
def point_in_segment(t):
    mutations = t.lineitem.selectExpr(
        "'T' || (l_orderkey % 3) AS tumour_id",
        "string(l_suppkey % 5) AS chr",
        "l_partkey * 50 + bigint(l_quantity) AS pos",
    )
    pairs = intervals.mutations_in_segments(mutations, _segments(t), ["tumour_id", "chr"])
    return pairs.groupBy("tumour_id", "chr", "total_cn").agg(
        F.count(F.lit(1)).alias("n_pairs"), F.sum(F.col("pos") - F.col("segment_start")).alias("sum_offset")
    )


@query(f"""
    WITH {_SEGMENTS},
    genes AS (SELECT CAST(o_custkey % 5 AS VARCHAR) AS chr, o_orderkey, o_orderkey * 6 AS start,
                     o_orderkey * 6 + o_custkey % 400 AS "end" FROM orders)
    SELECT g.chr, s.tumour_id, count(*) AS n_pairs, CAST(sum(g.start) AS BIGINT) AS sum_gene_start,
           CAST(sum(s.segment_no) AS BIGINT) AS sum_segment
    FROM genes g JOIN segments s
      ON g.chr = s.chr AND g.start <= s.segment_end AND g."end" > s.segment_start
    GROUP BY 1, 2
""")
def segment_gene_overlap(t):
    genes = t.orders.selectExpr(
        "string(o_custkey % 5) AS chr", "o_orderkey", "o_orderkey * 6 AS start",
        "o_orderkey * 6 + o_custkey % 400 AS end",
    )
    pairs = intervals.genes_on_segments(genes, _segments(t))
    return pairs.groupBy("chr", "tumour_id").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.sum("start").alias("sum_gene_start"),
        F.sum("segment_no").alias("sum_segment"),
    )


_LIFT = """
    mutations AS (SELECT 'LTX' || l_orderkey || '_1:x:0:A:T' AS mutation_id, CAST(l_suppkey % 5 AS VARCHAR) AS chr,
                         l_partkey * 50 + l_linenumber * 13 AS pos FROM lineitem),
    blocks AS (SELECT CAST(p_partkey % 5 AS VARCHAR) AS chr, p_partkey * 50 AS block_start,
                      p_partkey * 50 + 300 AS block_end, 'chr' || (p_partkey % 3 + 1) AS new_chr,
                      p_partkey * 1000 + 500 AS new_start, p_partkey % 4 = 0 AS minus, p_size AS score
               FROM part WHERE p_partkey % 9 <> 2),
    loci AS (SELECT DISTINCT chr, pos FROM mutations),
    hits AS (SELECT l.chr, l.pos, substr(b.new_chr, 4) AS new_chr, b.score,
                    CASE WHEN minus THEN new_start - (l.pos - 1 - block_start)
                         ELSE new_start + (l.pos - 1 - block_start) END + 1 AS new_pos
             FROM loci l JOIN blocks b ON l.chr = b.chr AND l.pos - 1 >= b.block_start AND l.pos - 1 < b.block_end),
    best AS (SELECT chr, pos, new_chr, new_pos FROM hits
             QUALIFY row_number() OVER (PARTITION BY chr, pos ORDER BY score DESC, new_chr, new_pos) = 1),
    lookup AS (SELECT l.chr, l.pos, b.new_chr, b.new_pos FROM loci l LEFT JOIN best b ON l.chr = b.chr AND l.pos = b.pos)"""


def _lift_input(t):
    mutations = t.lineitem.selectExpr(
        "'LTX' || l_orderkey || '_1:x:0:A:T' AS mutation_id",
        "string(l_suppkey % 5) AS chr",
        "l_partkey * 50 + l_linenumber * 13 AS pos",
        "'A' AS ref",
        "'T' AS alt",
    )
    blocks = t.part.where("p_partkey % 9 <> 2").selectExpr(
        "'chr' || (p_partkey % 5) AS chr",
        "p_partkey * 50 AS block_start",
        "p_partkey * 50 + 300 AS block_end",
        "'chr' || (p_partkey % 3 + 1) AS new_chr",
        "p_partkey * 1000 + 500 AS new_start",
        "if(p_partkey % 4 = 0, '-', '+') AS strand",
        "p_size AS score",
    )
    return mutations, blocks


@query(f"""
    WITH {_LIFT} SELECT chr, pos, new_chr, coalesce(new_pos, -1) AS new_pos FROM lookup
""")
def liftover_positions(t):
    lookup = liftover.lift_loci(*_lift_input(t))
    return lookup.withColumn("new_pos", F.coalesce("new_pos", F.lit(-1)))


@query(f"""
    WITH {_LIFT},
    lifted AS (SELECT m.mutation_id, split_part(m.mutation_id, ':', 1) || ':' || k.new_chr || ':' || k.new_pos || ':A:T' AS new_id
               FROM mutations m LEFT JOIN lookup k ON m.chr = k.chr AND m.pos = k.pos)
    SELECT new_id AS mutation_id_hg38, count(*) AS n_rows FROM lifted GROUP BY 1
""")
def liftover_mutation_ids(t):
    mutations, blocks = _lift_input(t)
    lifted = liftover.lifted_mutations(mutations, liftover.lift_loci(mutations, blocks))
    return lifted.groupBy("mutation_id_hg38").agg(F.count(F.lit(1)).alias("n_rows"))


@query(f"""
    WITH {_LIFT},
    loci_n AS (SELECT count(*) AS n_loci, count(new_pos) AS n_loci_mapped FROM lookup),
    rows_n AS (SELECT count(*) AS n_rows, count(k.new_pos) AS n_rows_mapped
               FROM mutations m LEFT JOIN lookup k ON m.chr = k.chr AND m.pos = k.pos)
    SELECT n_loci, n_loci_mapped, n_rows, n_rows_mapped, round(100.0 * n_loci_mapped / n_loci, 3) AS pct_loci,
           round(100.0 * n_rows_mapped / n_rows, 3) AS pct_rows FROM loci_n, rows_n
""")
def liftover_coverage(t):
    mutations, blocks = _lift_input(t)
    lookup = materialize(liftover.lift_loci(mutations, blocks), "lookup")  # read twice
    coverage = liftover.mapping_coverage(lookup, liftover.lifted_mutations(mutations, lookup))
    return coverage.withColumns({c: F.round(c, 3) for c in ("pct_loci", "pct_rows")})
