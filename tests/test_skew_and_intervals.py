"""The skew-safe join and the interval joins against brute force."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from clonarium.operators import intervals
from clonarium.operators.liftover import lift_loci, lift_mapped_loci, lifted_mutations, mapping_coverage
from clonarium.operators.skew import lookup_join
from clonarium.operators.sweep import sweep_join
from clonarium.session import job_settings
from clonarium.sources.chain import read_chain
from testdata_queries import intervals as queries
from testdata_queries.registry import Tables


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows on one key, exact copies among them, some keys null or unmatched."""
    data = [("hot" if i % 3 == 0 else None if i % 17 == 0 else f"k{i % 40}", i % 5) for i in range(900)]
    return spark.createDataFrame(data, "k string, v int")


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(30)], "k string, w int")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_in_a_shuffle_splits_a_heavy_key(spark, facts, lookup, rows, how):
    """Without broadcast, with partitions small enough that the heavy key's has to be split."""
    plain = rows(facts.join(lookup, ["k"], how))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = lookup_join(facts.repartition(20), lookup, ["k"], how)
        assert joined.columns == ["k", "v", "w"] and rows(joined) == plain
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_lookup_join_with_repeated_lookup_keys(facts, lookup, rows):
    doubled = lookup.union(lookup)
    assert rows(lookup_join(facts, doubled, ["k"], "inner")) == rows(facts.join(doubled, ["k"]))


def test_lookup_key_of_another_type(spark, rows):
    small = spark.createDataFrame([(7 if i % 2 else i, i) for i in range(100)], "k int, v int")
    wide = spark.createDataFrame([(7, "a"), (8, "b"), (1 << 40, "c")], "k long, w string")
    for how in ("inner", "left"):
        assert rows(lookup_join(small, wide, ["k"], how)) == rows(small.join(wide, ["k"], how))


def test_lookup_join_refuses_other_kinds(facts, lookup):
    with pytest.raises(ValueError):
        lookup_join(facts, lookup, ["k"], "full")


def test_shuffles_grow_with_the_input(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    for size, n in ((1, int(spark.conf.get("spark.sql.shuffle.partitions"))), (10 << 30, 80), (100 << 40, 819_200)):
        with job_settings(spark, size) as wanted:
            assert wanted == n == int(spark.conf.get(key))
        assert spark.conf.get(key, None) is None


def _random_intervals(spark, rng, n, prefix, widest):
    data = []
    for i in range(n):
        start = rng.randint(-500, 20_000)
        length = rng.choice([0, 1, int(2 ** rng.uniform(0, widest))])
        # an empty or reversed interval now and then
        end = start - rng.randint(0, 3) if rng.random() < 0.05 else start + length
        data.append((rng.choice(["a", "a", "b"]), i, start, end))
    data.append(("a", n, None, 5))
    return spark.createDataFrame(data, f"chr string, {prefix}id int, {prefix}s long, {prefix}e long")


@pytest.mark.parametrize("left_open", [False, True])
@pytest.mark.parametrize("right_open", [False, True])
def test_overlap_against_nested_loop(spark, rows, left_open, right_open):
    rng = random.Random(7)
    left, right = _random_intervals(spark, rng, 250, "l", 9), _random_intervals(spark, rng, 200, "r", 13)
    starts = F.col("ls") < F.col("re") if right_open else F.col("ls") <= F.col("re")
    ends = F.col("rs") < F.col("le") if left_open else F.col("rs") <= F.col("le")
    brute = left.join(right.withColumnRenamed("chr", "c2"), (F.col("chr") == F.col("c2")) & starts & ends)
    got = intervals.interval_join(
        left, right, ["chr"], ("ls", "le"), ("rs", "re"),
        left_end_open=left_open, right_end_open=right_open,
    )
    assert rows(got, "lid", "rid") == rows(brute, "lid", "rid")
    assert set(got.columns) == {"chr", "lid", "ls", "le", "rid", "rs", "re"}


@pytest.mark.parametrize("end_open", [False, True])
def test_points_against_nested_loop(spark, rows, end_open):
    rng = random.Random(8)
    points = spark.createDataFrame(
        [(rng.choice("ab"), i, 4711 if i % 3 == 0 else rng.randint(-500, 20_000)) for i in range(300)]
        + [("a", 300, None)],
        "chr string, pid int, pos long",
    )
    right = _random_intervals(spark, rng, 200, "r", 13)
    inside = (F.col("pos") >= F.col("rs")) & (
        F.col("pos") < F.col("re") if end_open else F.col("pos") <= F.col("re")
    )
    brute = points.join(right.withColumnRenamed("chr", "c2"), (F.col("chr") == F.col("c2")) & inside)
    got = intervals.point_join(points, right, ["chr"], "pos", ("rs", "re"), end_open=end_open)
    assert rows(got, "pid", "rid") == rows(brute, "pid", "rid")


@pytest.mark.parametrize("n_ranges", [1, 7, 60])
def test_nested_long_and_crowded_intervals(spark, rows, n_ranges):
    """Intervals in intervals, one over everything, and a third of all rows at one place."""
    rng = random.Random(10)

    def some(n, seed_key):
        data = [(rng.choice("abc"), i, s := rng.randrange(1000), s + rng.choice([0, 3, 40, 900])) for i, _ in enumerate(range(n))]
        data += [("a", n + i, 500, 500 + i % 4) for i in range(n // 2)] + [("a", 2 * n, -5, 10**9), ("b", 2 * n + 1, 0, 10**12)]
        data += [("a", 3 * n + i, 200 + i, 800 - i) for i in range(40)] + [(None, 4 * n, 1, 2), ("c", 4 * n + 1, None, 2)]
        return spark.createDataFrame(data, f"chr string, {seed_key}id int, {seed_key}s long, {seed_key}e long")

    left, right = some(150, "l"), some(60, "r")
    brute = left.join(right.withColumnRenamed("chr", "c2"), F.expr("chr = c2 AND ls <= re AND rs <= le"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(n_ranges))
        got = intervals.interval_join(left, right, ["chr"], ("ls", "le"), ("rs", "re"))
        found = rows(got, "lid", "rid")
        points = intervals.point_join(left.withColumn("p", F.col("ls")), right, ["chr"], "p", ("rs", "re"))
        inside = rows(points, "lid", "rid")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == rows(brute, "lid", "rid")
    assert inside == rows(brute.where("ls BETWEEN rs AND re"), "lid", "rid")


def test_crowded_starts_are_shared_out(spark):
    """Rows that all start at one place are found by several tasks."""
    left = spark.range(4000).selectExpr("id AS lid", "5L AS ls", "9L AS le")
    right = spark.createDataFrame([(1, 9), (5, 5), (9, 30), (10, 11)], "rs long, re long")
    pairs = sweep_join(left, right, [], ("ls", "le"), ("rs", "re"))
    counts = pairs.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in counts) == 12_000
    assert max(r["count"] for r in counts) < 9000


def test_far_positions_fail(spark):
    points = spark.createDataFrame([(1 << 41,)], "pos long")
    some = spark.createDataFrame([(1, 9)], "s long, e long")
    with pytest.raises(Exception, match="beyond"):
        intervals.point_join(points, some, [], "pos", ("s", "e")).collect()


@pytest.mark.parametrize("n_points", [20, 3000])
def test_points_in_few_long_intervals(spark, rows, n_points):
    rng = random.Random(9)
    points = spark.createDataFrame([("a", i, rng.randint(0, 100_000)) for i in range(n_points)], "chr string, pid int, pos long")
    data = [("a", i, s, s + rng.randint(0, 30)) for i, s in enumerate(rng.sample(range(100_000), 300))]
    data += [("a", 1000 + i, s, s + 40_000) for i, s in enumerate((5, 30_000, 59_999))]
    right = spark.createDataFrame(data, "chr string, rid int, rs long, re long")
    brute = points.join(right.withColumnRenamed("chr", "c2"), F.col("pos").between(F.col("rs"), F.col("re")))
    got = intervals.point_join(points, right, ["chr"], "pos", ("rs", "re"))
    assert rows(got, "pid", "rid") == rows(brute, "pid", "rid")


def test_touching_ends(spark, rows):
    segments = spark.createDataFrame([("1", 10, 20)], "chr string, segment_start long, segment_end long")
    genes = spark.createDataFrame(
        [("1", "before", 1, 10), ("1", "first", 1, 11), ("1", "last", 20, 25), ("1", "after", 21, 25)],
        "chr string, gene string, start long, end long",
    )
    assert rows(intervals.genes_on_segments(genes, segments), "gene") == [("first",), ("last",)]
    mutations = spark.createDataFrame([("1", p) for p in (9, 10, 20, 21)], "chr string, pos long")
    assert rows(intervals.mutations_in_segments(mutations, segments, ["chr"]), "pos") == [(10,), (20,)]


def test_without_key_columns(spark, rows):
    points = spark.createDataFrame([(5,), (50,)], "pos long")
    some = spark.createDataFrame([(1, 9), (5, 5), (60, 70)], "s long, e long")
    assert rows(intervals.point_join(points, some, [], "pos", ("s", "e"))) == [(5, 1, 9), (5, 5, 5)]


def test_no_intervals_at_all(spark):
    points = spark.createDataFrame([("1", 5)], "chr string, pos long")
    none = spark.createDataFrame([], "chr string, s long, e long")
    assert intervals.point_join(points, none, ["chr"], "pos", ("s", "e")).count() == 0


def test_liftover(spark, rows):
    mutations = spark.createDataFrame(
        [("LTX1_1:1:101:A:T", "1", 101, "A", "T"), ("LTX1_1:1:101:A:T", "1", 101, "A", "T"),
         ("LTX1_1:1:150:A:-", "1", 150, "A", "-"), ("LTX1_1:X:5:C:G", "X", 5, "C", "G"),
         ("LTX1_1:1:200:A:T", "1", 201, "A", "T"), ("LTX1_1:?:1:A:T", None, 1, "A", "T")],
        "mutation_id string, chr string, pos long, ref string, alt string",
    )
    blocks = spark.createDataFrame(
        [("chr1", 100, 200, "chr1", 1100, "+", 5.0),
         ("chr1", 140, 160, "chr2", 9000, "-", 9.0),
         ("X", 0, 10, "chrY", 50, "-", 1.0)],
        "chr string, block_start long, block_end long, new_chr string, new_start long, strand string, score double",
    )
    lookup = lift_loci(mutations, blocks)
    assert rows(lookup, "chr", "pos", "new_chr", "new_pos") == sorted(
        [(None, 1, None, None), ("1", 101, "1", 1101), ("1", 150, "2", 8992), ("1", 201, None, None),
         ("X", 5, "Y", 47)],
        key=lambda t: [(v is not None, str(v)) for v in t],
    )
    lifted = lifted_mutations(mutations, lookup)
    ids = sorted(str(r.mutation_id_hg38) for r in lifted.collect())
    assert ids == ["LTX1_1:1:1101:A:T", "LTX1_1:1:1101:A:T", "LTX1_1:2:8992:A:-", "LTX1_1:Y:47:C:G", "None", "None"]
    coverage = mapping_coverage(lookup, lifted).first()
    assert (coverage.n_loci, coverage.n_loci_mapped, coverage.n_rows, coverage.n_rows_mapped) == (5, 3, 6, 4)
    assert round(coverage.pct_loci, 1) == 60.0


def test_liftover_through_a_chain_file(spark, rows, tmp_path):
    (tmp_path / "a.chain.gz").write_bytes(
        gzip.compress(
            b"# comment\nchain 500 chr1 1000 + 100 160 chr2 900 + 40 105 1\n20 10 5\n30\n\n"
            b"chain 90 chrX 300 + 0 10 chrX 200 - 50 60 2\n10\n"
        )
    )
    blocks = read_chain(spark, str(tmp_path / "a.chain.gz"))
    assert rows(blocks) == [
        ("chr1", 100, 120, "chr2", 40, "+", 500.0),
        ("chr1", 130, 160, "chr2", 65, "+", 500.0),
        ("chrX", 0, 10, "chrX", 149, "-", 90.0),
    ]
    loci = spark.createDataFrame([("1", 101), ("1", 120), ("1", 125), ("1", 131), ("X", 3)], "chr string, pos long")
    assert rows(lift_loci(loci, blocks), "chr", "pos", "new_chr", "new_pos") == [
        ("1", 101, "2", 41), ("1", 120, "2", 60), ("1", 125, None, None), ("1", 131, "2", 66), ("X", 3, "X", 148),
    ]


def test_the_lookup_of_a_coverage_is_computed_once(spark, tmp_path):
    spark.sql("SELECT 1L AS l_orderkey, explode(array(2L, 35L)) AS l_partkey, 3L AS l_suppkey, 1 AS l_linenumber").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.sql("SELECT 3L AS p_partkey, 7 AS p_size UNION ALL SELECT 33L, 7").write.parquet(str(tmp_path / "part.parquet"))
    found = queries.liftover_coverage(Tables(spark, str(tmp_path)))
    # Of loci 3:113 and 3:1763, only the latter lies in a block, that of part 33.
    assert [tuple(r) for r in found.collect()] == [(2, 1, 2, 1, 50.0, 50.0)]
    # The sweep's work is in the scratch table that both counts read.
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()


def test_loci_are_lifted_once_and_joined_by_position_first(spark, rows):
    """Loci without a block take no part in the join; positions, not names, are what rows are sorted by."""
    loci = [("7", 101), ("chr7", 101), ("7", 150), ("7", 500), ("X", 101), (None, 101), ("7", None)]
    mutations = spark.createDataFrame(
        [(f"LTX1_{i}:x", c, p, "A", "T") for i, (c, p) in enumerate(loci * 2)], "mutation_id string, chr string, pos long, ref string, alt string"
    )
    blocks = spark.createDataFrame(
        [("chr7", 100, 160, "chr8", 900, "+", 1.0), ("chr7", 140, 170, "chr9", 300, "-", 2.0), ("chr7", 140, 170, "chr5", 10, "+", 2.0)],
        "chr string, block_start long, block_end long, new_chr string, new_start long, strand string, score double",
    )
    mapped = lift_mapped_loci(mutations, blocks)
    assert rows(mapped, "chr", "pos", "new_chr", "new_pos") == [("7", 101, "8", 901), ("7", 150, "5", 20), ("chr7", 101, "8", 901)]
    whole = lift_loci(mutations, blocks)
    assert whole.count() == len(loci) and rows(whole.where("new_pos is not null")) == rows(mapped.select(whole.columns))
    lifted = lifted_mutations(mutations, mapped)
    assert rows(lifted) == rows(lifted_mutations(mutations, whole)) and lifted.count() == 2 * len(loci)
    above_the_sweep = lifted._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow")[0]
    assert "Union" not in above_the_sweep and "Aggregate [pos" in above_the_sweep
