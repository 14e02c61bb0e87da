"""A Merkle manifest of a table, stored by content, and proofs found by descent (operator 11).

Every row is a leaf: the digest of its fields. The leaves of a group, in order of id, are the lowest
level of the group's tree; while a level has several nodes, every two consecutive ones become the
digest of their digests, a last one alone too. The groups' roots, in order of group, are the leaves
of one more such tree, whose root is the manifest's.

* **Records.** A record maps a digest to its children: here those ``LEVELS`` binary levels below
  it, at most 2 ** LEVELS, from which the levels between follow. Records are found by digest alone,
  so equal subtrees share one.
* **Descent.** Requested leaves are grouped by the record above them, those records by the one above
  them, and so on up. From the root down, each record is then looked up by its digest once for all
  requests below it; the digits of a rank, base 2 ** LEVELS, pick the child, and the unselected
  children on the way are collected. At the leaf the path, top first, is reversed.

Ranks come from one range-partitioned sort and the counts of its tasks, so a group of any size is
spread over all tasks; a task sees one record at a time. Repeated rows are leaves of their own next
to each other. A null field has its own mark, a null group is a group and comes first, a null id
sorts first. An empty table has no root and no proofs. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clonarium.llm.common import materialize

LEVELS = 10
RECORD_SCHEMA = "tree string, n long, rank long, digest string, height int, children array<string>"
_STEP = pa.list_(pa.string())
_FOUND = pa.list_(pa.struct([("digest", pa.string()), ("path", _STEP)]))
_FOUND_SQL = "array<struct<digest: string, path: array<string>>>"


def digest_of(*fields: Column) -> Column:
    """The leaf digest: every field as its length in bytes, a colon and its text, or ``-`` if null."""
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in (f.cast("string") for f in fields)]
    return F.sha2(F.concat(*parts), 256)


def levels_above(nodes: list[str], height: int) -> list[list[str]]:
    """The given level and ``height`` levels above it."""
    levels = [nodes]
    for _ in range(height):
        below = levels[-1]
        pairs = ("".join(below[i : i + 2]) for i in range(0, len(below), 2))
        levels.append([hashlib.sha256(pair.encode()).hexdigest() for pair in pairs])
    return levels


def path_to(levels: list[list[str]], place: int) -> list[str]:
    """The unselected children on the way down to a node of the lowest level, top first.

    A step is the other child with ``<`` or ``>`` before it for the side it stands on, or empty where
    there is no other.
    """
    steps = []
    for height in range(len(levels) - 2, -1, -1):
        at = place >> height
        level = levels[height]
        steps.append("<" + level[at - 1] if at & 1 else ">" + level[at + 1] if at + 1 < len(level) else "")
    return steps


@dataclass
class Manifest:
    """``leaves`` (tree, n, rank, digest, row) and the records of every tier, the lowest first."""

    root: str | None
    levels: int
    leaves: DataFrame
    groups: DataFrame  # the same columns; ``row.tree`` names the group's tree
    tiers: list[DataFrame] = field(default_factory=list)
    group_tiers: list[DataFrame] = field(default_factory=list)


def ranked(nodes: DataFrame, *order: str) -> DataFrame:
    """``nodes`` with their ``rank`` within ``tree`` by ``order`` and the tree's size ``n``.

    The counts of the sort's tasks are one row for each task and tree in it.
    """
    placed = materialize(nodes.sort("tree", *order).withColumn("_at", F.monotonically_increasing_id()), "sorted")
    placed = placed.withColumn("_task", F.shiftright("_at", 33))
    shares = placed.groupBy("tree", "_task").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_share"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select(
        "tree", "_task", "_first", F.coalesce(F.sum("_share").over(before), F.lit(0)).alias("_before"), F.sum("_share").over(tree).alias("n")
    )
    rank = (F.col("_before") + F.col("_at") - F.col("_first")).alias("rank")
    return placed.join(materialize(shares, "shares"), ["tree", "_task"]).select("n", rank, *nodes.columns)


def _fold(levels: int):
    """Records over groups of neighbouring nodes."""

    def emit(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in ("tree", "n", "block"))
            for tree, n, block, nodes in zip(*columns, batch.column("nodes"), strict=True):
                children = [x["digest"] for x in nodes.as_py()]
                height = min((n - 1).bit_length(), levels)
                row = {"tree": tree, "n": -(-n >> levels), "rank": block, "digest": levels_above(children, height)[-1][0]}
                yield pa.RecordBatch.from_pylist([row | {"height": height, "children": children}], _RECORDS)

    return emit


_RECORDS = pa.schema(
    [("tree", pa.string()), ("n", pa.int64()), ("rank", pa.int64()), ("digest", pa.string()), ("height", pa.int32()), ("children", _STEP)]
)


def _climb(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The records of all trees by tier, the lowest first: each tier's nodes are the next one's children.

    A tree of one leaf has a record without levels; from then on, trees of one node are done.
    """
    tiers = []
    nodes = nodes.select("tree", "n", "rank", "digest")
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > (1 if tiers else 0):
        block = F.shiftright("rank", levels).alias("block")
        grouped = nodes.groupBy("tree", "n", block).agg(F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("nodes"))
        tiers.append(materialize(grouped.mapInArrow(_fold(levels), RECORD_SCHEMA), f"records-{len(tiers)}"))
        nodes = tiers[-1].where("n > 1").select("tree", "n", "rank", "digest")
        most = -(-most >> levels)
    return tiers


def _roots(tiers: list[DataFrame]) -> DataFrame:
    """(tree, digest, tier): every tree's root and the tier of the record that has it."""
    parts = [t.where("n = 1").select("tree", "digest", F.lit(i).alias("tier")) for i, t in enumerate(tiers)]
    roots = parts[0]
    for part in parts[1:]:
        roots = roots.unionByName(part)
    return roots


def build_manifest(
    rows: DataFrame, leaf: Column, group: Column, order: Column, *others: Column, levels: int = LEVELS
) -> Manifest:
    """The manifest of ``rows``; the ``others``, such as an id, stay with the leaves as their ``row``.

    Leaves of one ``order`` are put in order of digest. ``levels`` is the height of a record.
    """
    tree = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))  # null before all others
    given = rows.select(
        tree.alias("tree"), leaf.alias("digest"), order.alias("order"), F.struct(*others, F.lit(0).alias("_")).alias("row"),
        F.monotonically_increasing_id().alias("tie"),
    )
    # Written before it is sorted: a sort reads its input twice, and the tie must stay.
    leaves = materialize(ranked(materialize(given, "leaves"), "order", "digest", "tie").drop("order", "tie"), "ranked-leaves")
    tiers = _climb(leaves, levels)
    if not tiers:
        return Manifest(None, levels, leaves, leaves)
    tops = materialize(_roots(tiers), "group-roots").select(
        F.lit("").alias("tree"), "digest", F.col("tree").alias("order"), F.struct("tree", "tier").alias("row")
    )
    groups = materialize(ranked(tops, "order").drop("order"), "ranked-groups")
    group_tiers = _climb(groups, levels)
    root = group_tiers[-1].where("n = 1").select("digest").first()[0]
    return Manifest(root, levels, leaves, groups, tiers, group_tiers)


def _pick(batches) -> Iterator[pa.RecordBatch]:
    """For each row the child of its record, and the way to it, that each of its digits picks."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            path, children, height = (row.column(n)[0].as_py() for n in ("path", "children", "height"))
            levels = levels_above(children, height)
            found = [
                {"digest": children[d], "path": path + path_to(levels, d)} for d in row.column("digits")[0].as_py()
            ]
            kept = [n for n in row.schema.names if n not in ("children", "height", "path", "digits")]
            yield pa.RecordBatch.from_arrays([*(row.column(n) for n in kept), pa.array([found], _FOUND)], names=[*kept, "found"])


def _descend(requests: DataFrame, tiers: list[DataFrame], starts: DataFrame, levels: int) -> DataFrame:
    """(tree, digest, path, subroot, row) of the leaves that ``requests`` (tree, rank, row) ask for.

    ``starts`` (tree, tier, digest, path, subroot) are the trees' roots; ``subroot`` is handed down.
    """

    def digit(rank: str) -> Column:
        return F.pmod(rank, F.lit(1 << levels)).cast("int").alias("digit")

    # From the leaves up: which children of which records are needed.
    wanted = F.collect_list(F.struct(digit("rank"), "row")).alias("asked")
    up = [requests.groupBy("tree", F.shiftright("rank", levels).alias("block")).agg(wanted)]
    for _ in tiers[1:]:
        wanted = F.collect_list(F.struct(digit("block"), F.lit(0).alias("row"))).alias("asked")
        above = up[-1].groupBy("tree", F.shiftright("block", levels).alias("up")).agg(wanted)
        up.append(materialize(above.withColumnRenamed("up", "block"), "asked"))
    # From the roots down.
    came = None
    for tier in range(len(tiers) - 1, -1, -1):
        here = starts.where(F.col("tier") == tier).select("tree", F.lit(0).cast("long").alias("block"), "digest", "path", "subroot")
        here = here.unionByName(came) if came is not None else here
        # Equal subtrees have equal records.
        records = tiers[tier].groupBy("digest", "height").agg(F.first("children").alias("children"))
        met = here.join(up[tier], ["tree", "block"]).join(records, "digest").drop("digest")
        met = met.withColumn("digits", F.col("asked.digit"))
        kept = [f"{f.name} {f.dataType.simpleString()}" for f in met.schema if f.name not in ("children", "height", "path", "digits")]
        found = met.mapInArrow(_pick, ", ".join([*kept, f"found {_FOUND_SQL}"]))
        each = found.select("tree", "block", "subroot", F.explode(F.arrays_zip("asked", "found")).alias("x"))
        below = F.shiftleft("block", levels) + F.col("x.asked.digit")
        rows = each.select("tree", below.alias("block"), "x.found.digest", "x.found.path", "subroot", "x.asked.row")
        came = materialize(rows.drop("row"), "descended") if tier else rows
    return came.drop("block")


def find_proofs(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """``row``, ``digest``, ``subroot`` and ``path`` of requested leaves, which are rows of ``manifest.leaves``.

    ``path`` holds the siblings from the leaf up, each with its side before it (see ``path_to``).
    """
    if manifest.root is None:
        return requests.select("row", "digest", F.lit("").alias("subroot"), F.array().cast("array<string>").alias("path"))
    named = requests.select("tree").distinct()
    asked = manifest.groups.join(named, F.col("row.tree") == named["tree"], "left_semi").select("tree", "rank", "row")
    top = len(manifest.group_tiers) - 1
    spark = requests.sparkSession
    start = spark.range(1).select(
        F.lit("").alias("tree"), F.lit(top).alias("tier"), F.lit(manifest.root).alias("digest"),
        F.array().cast("array<string>").alias("path"), F.lit("").alias("subroot"),
    )
    # Written: a join on values known to the planner would turn into a cross join.
    groups = _descend(asked, manifest.group_tiers, materialize(start, "start"), manifest.levels)
    starts = materialize(groups.select("row.tree", "row.tier", "digest", "path", F.col("digest").alias("subroot")), "starts")
    found = _descend(requests.select("tree", "rank", "row"), manifest.tiers, starts, manifest.levels)
    return found.select("row", "digest", "subroot", F.reverse("path").alias("path"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings from the leaf up lead to."""

    def parent(node: Column, step: Column) -> Column:
        other = F.substring(step, 2, 64)
        return F.sha2(F.when(step.startswith("<"), F.concat(other, node)).otherwise(F.concat(node, other)), 256)

    return F.aggregate(path, leaf, parent)


def proof_digest(path: Column) -> Column:
    """The digest of a path's siblings, one after another."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.substring(step, 2, 64)), ""), 256)
