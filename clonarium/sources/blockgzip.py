"""Block gzip: gzip files of many small members, each with its packed size in its header.

Tools of genomics write ``.gz`` files this way, so that parts of a file can be unpacked without the
rest. Spark unpacks any gzip file in one task. Here one task per file only follows the sizes from member
to member, of which it holds a run at a time, and cuts the packed bytes into runs of members; those are spread
over tasks that unpack them.
Lines that reach from one run into the next are put together from their two ends and what lies
between: a few rows per run go through that shuffle, the others stay where they are unpacked.

A file counts as block gzip if the sizes lead from its first byte to exactly its end. All other
files, cut off ones among them, are left to Spark's own reader and its rules. A damaged member fails the job.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import chain, groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clonarium.sources.packed import reader_as_it_lies, whole_bytes

# Members of one run; a member holds at most 64 KB of text, so a run at most 16 MB.
RUN_MEMBERS = 256
# Fixed values of the format: two magic bytes, deflate, extra fields; the most bytes of a header with those.
_MAGIC = b"\x1f\x8b\x08\x04"
_HEADER = 12 + (1 << 16)


def _member_size(content: memoryview | bytearray, at: int) -> int:
    """Packed size of the member at this place, as its header gives it; -1 where there is none."""
    size = -1
    if content[at : at + 4] == _MAGIC and at + 12 <= len(content):
        field = at + 12
        end = field + struct.unpack_from("<H", content, at + 10)[0]
        # The field BC of two bytes is size - 1.
        while field + 6 <= min(end, len(content)):
            length = struct.unpack_from("<H", content, field + 2)[0]
            if content[field : field + 2] == b"BC" and length == 2:
                size = struct.unpack_from("<H", content, field + 4)[0] + 1
                break
            field += 4 + length
    # A header alone takes more than 18 bytes with the field, so that every step goes forward.
    return size if size >= 18 else -1


def member_sizes(content: memoryview) -> Iterator[int]:
    """Packed sizes of the members, as their headers give them; -1 where there is none."""
    at = 0
    while at < len(content):
        size = _member_size(content, at)
        yield size
        if size < 0:
            return
        at += size


def _runs(parts: Iterator[bytes], members: int) -> Iterator[bytes | None]:
    """The runs of so many members of a file that comes in parts; None, and no more, where it turns out not to be block gzip."""
    held, at, n = bytearray(), 0, 0
    for part in chain(parts, [None]):
        held += part or b""
        # A header is looked at when it is there whole. The members before it are, too.
        while at < len(held) if part is None else at + _HEADER <= len(held):
            if n == members:
                yield bytes(held[:at])
                del held[:at]
                at = n = 0
            size = _member_size(held, at)
            if size < 0:
                yield None
                return
            at, n = at + size, n + 1
    yield bytes(held) if at == len(held) and at else None


def _cutter(members: int, with_content: bool):
    """Batches of (path, size, line) to one row a run, or without content to one a file."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("path", "size", "line")), strict=True)

    def row(path: str, i: int, packed: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([i], pa.int64()), pa.array([packed], pa.binary())], names=["path", "block", "packed"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (path, size), lines in groupby(rows(batches), itemgetter(0, 1)):
            run = None
            for i, run in enumerate(_runs(whole_bytes(map(itemgetter(2), lines), size, path), members)):
                if with_content and run is None:
                    raise RuntimeError(f"{path} is not block gzip any more")
                if with_content:
                    yield row(path, i, run)
            if run is not None and not with_content:
                yield row(path, 0, b"")

    return cut


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs to lines as bytes, numbered; ``edge`` marks the first and last, ``ended`` those with a line feed."""
    for batch in batches:
        for path, block, packed in zip(batch.column("path"), batch.column("block"), batch.column("packed"), strict=True):
            members, at, texts = memoryview(packed.as_buffer()).cast("B"), 0, []
            for size in member_sizes(members):
                texts.append(zlib.decompress(members[at : at + size], 31))
                at += size
            lines = b"".join(texts).split(b"\n")
            n = len(lines)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([path.as_py()] * n),
                    pa.array([block.as_py()] * n, pa.int64()),
                    pa.array(range(n), pa.int64()),
                    pa.array(lines, pa.binary()),
                    pa.array([i in (0, n - 1) for i in range(n)]),
                    pa.array([i < n - 1 for i in range(n)]),
                ],
                names=["path", "block", "n", "line", "edge", "ended"],
            )


def _packed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, size, line): the packed bytes of gzip files, cut at line feeds; those of a file come in order, in one task."""
    name = F.col("_metadata.file_path")
    lines = reader_as_it_lies(spark, ".gz").text(path).where(F.lower(name).endswith(".gz"))
    return lines.select(name.alias("path"), F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("line"))


_RUN = "path string, block long, packed binary"


def block_gzip_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Names of the files that are block gzip: a part of the list of files, which any scan keeps on the driver."""
    # The first line of such a file begins as a member does. Few lines of others do: only files that have one are followed.
    begun = _packed(spark, path).where(F.substring("line", 1, len(_MAGIC)) == F.lit(_MAGIC)).select("path").distinct()
    names = [r.path for r in begun.collect()]
    if not names:
        return []
    found = _packed(spark, path).where(F.col("path").isin(names)).mapInArrow(_cutter(RUN_MEMBERS, with_content=False), _RUN)
    return [r.path for r in found.select("path").collect()]


def unpacked_lines(spark: SparkSession, path: str | list[str], files: list[str], partitions: int, members: int = RUN_MEMBERS) -> DataFrame:
    """(path, block, n, line) of those of ``files`` under ``path``, block gzip all, unpacked in ``partitions`` tasks.

    ``block`` is the run in which a line begins and ``n`` its number there: the same in every scan.
    """
    runs = _packed(spark, path).where(F.col("path").isin(files)).mapInArrow(_cutter(members, with_content=True), _RUN)
    parts = runs.repartition(partitions, "path", "block").mapInArrow(
        _unpack, "path string, block long, n long, line binary, edge boolean, ended boolean"
    )
    # Casts from bytes change none, so a character cut in two is whole again once its ends are together.
    parts = parts.withColumn("line", F.col("line").cast("string"))
    before = Window.partitionBy("path").orderBy("block", "n").rowsBetween(Window.unboundedPreceding, -1)
    edges = parts.where("edge").withColumn("_line", F.coalesce(F.sum(F.col("ended").cast("long")).over(before), F.lit(0)))
    pieces = F.sort_array(F.collect_list(F.struct("block", "n", "line")))
    joined = edges.groupBy("path", "_line").agg(
        F.min(F.struct("block", "n")).alias("_first"), F.array_join(F.transform(pieces, lambda p: p["line"]), "").alias("line"), F.max("ended").alias("ended")
    )
    # As Spark's reader does: a byte order mark is no text, nor is the nothing behind the last line feed a line.
    marked = (F.col("_line") == 0) & F.col("line").startswith("\ufeff")
    joined = joined.withColumn("line", F.when(marked, F.substr("line", F.lit(2))).otherwise(F.col("line")))
    joined = joined.where(F.col("ended") | (F.col("line") != ""))
    return parts.where(~F.col("edge")).select("path", "block", "n", "line").unionByName(
        joined.select("path", "_first.block", "_first.n", "line")
    )
