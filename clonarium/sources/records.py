"""Records of delimited text files, large or many, with quoted cells that may hold line breaks.

Files are read by line, so a large file is split over tasks like any other text. A first pass, the
survey, keeps one row for each file block: its header line, the bytes read, and whether a line
ends inside a quoted cell. Where none does, every line is a record, and the second pass is a plain
scan. A file where one does is put together again:

* A line maps the state it begins in, outside or inside a quoted cell, to the state it ends in. Such
  maps are a constant, a swap or nothing, so the state at any place follows from the last constant
  before it and the swaps since. The task that scans a block, line by line in order, so finds the map
  of the block; nothing is shuffled or sorted.
* The same over the blocks of a file, of which there is one row each, gives the state in which
  each block begins.
* A line that begins outside starts a record; a second scan joins the lines of each record. Only records
  over the edge of a block, two a block at most, are put together from their pieces by a shuffle.

A quote opens a cell at the cell's beginning only, elsewhere it is a character like any other; two
quotes in a quoted cell are one; what follows the closing quote belongs to the cell. Lines end with a
line feed; a carriage return before it is dropped at the end of a record. A record of nothing but spaces
is blank and is left out; a file's first record that is not blank is its header.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clonarium.operators.skew import lookup_join
from clonarium.session import materialize

# Stands for a separator outside quotes while a record is taken apart.
_CUT = "\x1f\x00\x1f"
# Files that cannot be read are left out one by one up to this number; more than that is no accident.
MAX_BROKEN = 1000

# Where a reader of quoted cells may be: at a cell's beginning, further on in a plain cell, in a
# quoted one, behind a quote in a quoted one.
_BEGIN, _PLAIN, _QUOTED, _BEHIND = range(4)


def _literal(sep: str) -> str:
    return "\\" + sep if sep in "|.^$*+?()[]{}\\" else sep


def _after_quote(state: Column) -> Column:
    return F.when(state == _BEGIN, _QUOTED).when(state == _QUOTED, _BEHIND).when(state == _BEHIND, _QUOTED).otherwise(state)


def _after_text(state: Column, text: Column, sep: str) -> Column:
    """The state after text without quotes."""
    plain = F.when(text.endswith(F.lit(sep)), _BEGIN).otherwise(_PLAIN)
    return F.when((state == _QUOTED) | (text == ""), state).otherwise(plain)


def _rest(pieces: Column) -> Column:
    return F.slice(pieces, F.lit(2), F.size(pieces))


def ends_inside(line: Column, sep: str, begins_inside: bool = False) -> Column:
    """Whether a line ends inside a quoted cell."""
    pieces = F.split(line, '"')
    first = _after_text(F.lit(_QUOTED if begins_inside else _BEGIN), F.get(pieces, F.lit(0)), sep)
    last = F.aggregate(_rest(pieces), first, lambda state, text: _after_text(_after_quote(state), text, sep))
    return F.when(line.contains('"'), last == _QUOTED).otherwise(F.lit(begins_inside))


def cells(record: Column, sep: str) -> Column:
    """The cells of a record, as an array of text."""
    pieces = F.split(record, '"')
    last = F.size(pieces) - 1

    def in_place(text: Column, i: Column) -> Column:
        """Whether quotes stand on both sides of a separator, or two of them together."""
        sides = ((i == 0) | text.startswith(F.lit(sep))) & ((i == last) | text.endswith(F.lit(sep)))
        return (i % 2 == 1) | (text == "") | sides

    orderly = (last % 2 == 0) & F.forall(F.transform(pieces, in_place), lambda x: x)
    # Every second piece is inside quotes.
    marked = F.transform(pieces, lambda p, i: F.when(i % 2 == 0, F.replace(p, F.lit(sep), F.lit(_CUT))).otherwise(p))
    unquoted = F.transform(
        F.split(F.array_join(marked, '"'), _CUT),
        lambda c: F.when(c.startswith('"'), F.replace(F.substr(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c),
    )

    def step(so_far: Column, text: Column) -> Column:
        state = _after_quote(so_far["state"])
        kept = F.when(so_far["state"].isin(_PLAIN, _BEHIND), '"').otherwise("")
        cut = F.when(state == _QUOTED, text).otherwise(F.replace(text, F.lit(sep), F.lit(_CUT)))
        return F.struct(_after_text(state, text, sep).alias("state"), F.concat(so_far["text"], kept, cut).alias("text"))

    head = F.get(pieces, F.lit(0))
    first = F.struct(
        _after_text(F.lit(_BEGIN), head, sep).alias("state"), F.replace(head, F.lit(sep), F.lit(_CUT)).alias("text")
    )
    odd = F.split(F.aggregate(_rest(pieces), first, step)["text"], _CUT)
    plain = F.split(record, _literal(sep))
    return F.when(~record.contains('"'), plain).when(orderly, unquoted).otherwise(odd)


def _blank(text: Column) -> Column:
    return F.trim(text) == ""


def _without_return(text: Column) -> Column:
    return F.when(text.endswith("\r"), F.substr(text, F.lit(1), F.length(text) - 1)).otherwise(text)


def _lines(spark: SparkSession, path: str | list[str], without: list[str], lenient: bool = False) -> DataFrame:
    """(path, block, n, line): ``n`` orders the lines of a block within one scan only."""
    text = spark.read.option("lineSep", "\n").option("ignoreCorruptFiles", lenient).text(path)
    if without:
        text = text.where(~F.col("_metadata.file_path").isin(without))  # prunes the list of files
    return text.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"),
        F.col("value").alias("line"),
    )


def survey(spark: SparkSession, path: str | list[str], sep: str, without: list[str] = (), lenient: bool = False) -> DataFrame:
    """One row for each file block: bytes, first line with text, lines that end inside quotes.

    ``lenient`` goes on where a file breaks off; ``broken_files`` then tells which did.
    """
    return materialize(_summary(_lines(spark, path, list(without), lenient), sep), "survey")


def _summary(lines: DataFrame, sep: str) -> DataFrame:
    # What the scan without header takes for blank: see ``_plain_body``.
    faint = ~F.col("line").rlike(r"[^\x00-\x20]")
    # The set, of one value at most, makes this an aggregate over objects. That keeps the few blocks of a
    # task in a map; with a text in the buffer and no such aggregate, Spark would sort all lines instead.
    faint_lines = F.collect_set(F.when(faint & ~_blank(_without_return(F.col("line"))), True))
    summary = lines.groupBy("path", "block").agg(
        F.sum(F.octet_length("line").cast("long") + 1).alias("n_bytes"),
        F.min(F.when(~faint, F.struct("n", "line"))).alias("_first"),
        F.count_if(ends_inside(F.col("line"), sep)).alias("n_open"),
        (F.size(faint_lines) > 0).alias("has_faint"),
    )
    return summary.select("*", F.col("_first.line").alias("first"), F.col("_first.n").alias("first_n")).drop("_first")


@dataclass
class TextFiles:
    """``headers`` (path, header) and, without them, ``body`` (path, record) of some files."""

    headers: DataFrame
    body: DataFrame


def open_files(
    spark: SparkSession, path: str | list[str], sep: str, without: list[str] = (), has_header: bool = True, blocks: DataFrame | None = None
) -> TextFiles:
    """The records of all files but those ``without``; ``blocks`` is their survey if there is one."""
    blocks = survey(spark, path, sep, without) if blocks is None else blocks
    totals = blocks.agg(F.sum("n_open").alias("n_open"), F.max("has_faint").alias("has_faint")).first()
    top = blocks.where("first is not null").groupBy("path").agg(F.min_by("first", "block").alias("header"))
    headers = top.withColumn("header", _without_return(F.col("header")))
    body = _plain_body(spark, path, list(without), has_header, bool(totals["has_faint"]))
    files = TextFiles(headers, body)
    return _with_stitched(files, blocks, _lines(spark, path, list(without)), sep, has_header) if totals["n_open"] else files


def open_lines(lines: DataFrame, sep: str, has_header: bool = True) -> TextFiles:
    """The records of ``lines`` (path, block, n, line), of which ``n`` is the same in every scan."""
    blocks = materialize(_summary(lines, sep), "survey")
    n_open = blocks.agg(F.sum("n_open")).first()[0]
    top = blocks.where("first is not null").groupBy("path").agg(F.min(F.struct("block", "first_n", "first")).alias("_top"))
    headers = top.select("path", _without_return(F.col("_top.first")).alias("header"))
    rows = lines.withColumn("record", _without_return(F.col("line"))).where(~_blank(F.col("record")))
    if has_header:
        place = top.select("path", F.struct("_top.block", F.col("_top.first_n").alias("n")).alias("_top"))
        rows = lookup_join(rows, materialize(place, "headers"), ["path"], "left")
        rows = rows.where(~F.struct("block", "n").eqNullSafe(F.col("_top")))
    files = TextFiles(headers, rows.select("path", "record"))
    return _with_stitched(files, blocks, lines, sep, has_header, ordered=False) if n_open else files


def _with_stitched(files: TextFiles, blocks: DataFrame, lines: DataFrame, sep: str, has_header: bool, ordered: bool = True) -> TextFiles:
    """``files`` with those put together from ``lines`` that have lines ending inside quotes.

    ``ordered``: the lines of a block come one after another, in order, in one task.
    """
    # A written table: its size is known, so few paths are broadcast.
    stitch = materialize(blocks.where("n_open > 0").select("path").distinct(), "quoted-files")
    headers, body = (df.join(stitch, "path", "left_anti") for df in (files.headers, files.body))
    whole = stitched(lines.join(F.broadcast(stitch), "path", "left_semi"), sep, ordered)
    if has_header:
        place = whole.where("top").groupBy("path").agg(F.min_by("record", "start").alias("header"), F.min("start").alias("_first"))
        place = materialize(place, "stitched-headers")
        headers = headers.unionByName(place.select("path", "header"))
        whole = lookup_join(whole, place.select("path", "_first"), ["path"], "inner").where(~F.col("top") | (F.col("start") != F.col("_first")))
    return TextFiles(headers, body.unionByName(whole.select("path", "record")))


def _plain_body(spark: SparkSession, path: str | list[str], without: list[str], has_header: bool, faint: bool) -> DataFrame:
    """(path, record) of files whose lines are records, the headers left out by their place.

    The reader of delimited files does that; set to a separator and a quote that no line can hold,
    it gives every line as one cell. It leaves out lines of control characters only, such as those
    of a table's empty cells, which a second scan brings in where there are any.
    """
    reader = spark.read.schema("line string").option("header", has_header).option("lineSep", "\n")
    text = reader.option("sep", "\n\n").option("quote", "\n").option("escape", "\n").option("maxCharsPerColumn", -1).csv(path)
    if without:
        text = text.where(~F.col("_metadata.file_path").isin(without))
    rows = text.select(F.col("_metadata.file_path").alias("path"), _without_return(F.col("line")).alias("record"))
    if faint:
        lines = _lines(spark, path, without).where(~F.col("line").rlike(r"[^\x00-\x20]"))
        rows = rows.unionByName(lines.select("path", _without_return(F.col("line")).alias("record")).where(~_blank(F.col("record"))))
    return rows


def _states(rows: DataFrame, over: Window, start: Column) -> DataFrame:
    """``rows`` with the state ``after`` each: each row's map is a constant ``fixed`` or, without one, a ``swap`` or nothing."""
    until = over.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = rows.withColumn("_swaps", F.sum(F.col("swap").cast("long")).over(until))
    known = F.when(F.col("fixed").isNotNull(), F.struct("fixed", "_swaps"))
    counted = counted.withColumn("_known", F.last(known, ignorenulls=True).over(until))
    since = F.col("_swaps") - F.coalesce("_known._swaps", F.lit(0))
    return counted.withColumn("after", F.coalesce("_known.fixed", start) != (since % 2 == 1))


def stitched(lines: DataFrame, sep: str, ordered: bool = True) -> DataFrame:
    """(path, start, top, record) of all records that are not blank, in a scratch table.

    ``start`` is the block in which a record starts, ``top`` tells the first one that does. For ``ordered``
    see ``_with_stitched``.
    """
    line = F.col("line")
    maps = lines.withColumns({"out": ends_inside(line, sep), "inn": ends_inside(line, sep, begins_inside=True)})

    def streamed(df: DataFrame, *columns: Column | str) -> DataFrame:
        df = df if ordered else df.repartition("path", "block").sortWithinPartitions("path", "block", "n")
        return df.select("path", "block", "out", "inn", *columns)

    # A block as a map: where its last line leads to from outside, and from inside.
    ends = streamed(maps).mapInArrow(_block_maps, "path string, block long, out boolean, inn boolean")
    blocks = materialize(ends, "block-maps").select(
        "path", "block", F.when(F.col("out") == F.col("inn"), F.col("out")).alias("fixed"), (F.col("out") & ~F.col("inn")).alias("swap")
    )
    in_file = Window.partitionBy("path").orderBy("block")
    begins = F.lag("after", 1, False).over(in_file).alias("begins")
    begins = materialize(_states(blocks, in_file, F.lit(False)).select("path", "block", begins), "block-states")
    # Broadcast, so that the lines stay where and as they are: one row a block.
    placed = maps.join(F.broadcast(begins), ["path", "block"])
    placed = streamed(placed, line.cast("binary").alias("line"), _blank(_without_return(line)).alias("blank"), "begins")
    pieces = placed.mapInArrow(_pieces, "path string, block long, begun boolean, whole boolean, top boolean, record binary")
    # Casts from bytes change none.
    pieces = materialize(pieces.withColumn("record", F.col("record").cast("string")), "records")
    # A record that a block leaves open goes on in the blocks after it that begin inside.
    before = Window.partitionBy("path").orderBy("block", "begun").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.last(F.when(F.col("begun"), F.col("block")), ignorenulls=True).over(before)
    ordered_texts = F.transform(F.sort_array(F.collect_list(F.struct("block", "record"))), lambda x: x["record"])
    over_edges = pieces.where("NOT whole").withColumn("start", start).groupBy("path", "start").agg(
        F.max("top").alias("top"), F.array_join(ordered_texts, "\n").alias("record")
    )
    whole = pieces.where("whole").select("path", F.col("block").alias("start"), "top", "record").unionByName(over_edges)
    return whole.withColumn("record", _without_return(F.col("record")))


def _runs_of_blocks(batches) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The batches, cut where another block begins."""
    for batch in batches:
        path, block = batch.column("path"), batch.column("block").to_numpy()
        other = pc.not_equal(path.slice(1), path.slice(0, max(len(path) - 1, 0))).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(other | (block[1:] != block[:-1])) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            if low < high:
                yield (path[low].as_py(), int(block[low])), batch.slice(low, high - low)


def _flags(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(bool)


def _after_lines(batch: pa.RecordBatch, state: bool) -> np.ndarray:
    """The state after each line, given the one before the first."""
    out, inn = _flags(batch, "out"), _flags(batch, "inn")
    swaps = np.cumsum(out & ~inn)
    last = np.maximum.accumulate(np.where(out == inn, np.arange(len(out)), -1))
    since = swaps - np.where(last >= 0, swaps[last], 0)
    return np.where(last >= 0, out[last], state) ^ (since % 2 == 1)


def _block_maps(batches) -> Iterator[pa.RecordBatch]:
    """One row a block: the state after its last line, from outside and from inside."""

    def row(key: tuple[str, int], ends: list[bool]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"path": [key[0]], "block": [key[1]], "out": [ends[0]], "inn": [ends[1]]})

    now, ends = None, [False, True]
    for key, batch in _runs_of_blocks(batches):
        if key != now:
            if now:
                yield row(now, ends)
            now, ends = key, [False, True]
        ends = [bool(_after_lines(batch, state)[-1]) for state in ends]
    if now:
        yield row(now, ends)


def _pieces(batches) -> Iterator[pa.RecordBatch]:
    """The records of each block that are not blank, and the pieces of those that cross its edges."""

    def rows(key, begun, whole, top, records) -> pa.RecordBatch:
        n = len(records)
        columns = [pa.array([key[0]] * n), pa.array([key[1]] * n, pa.int64()), pa.array([begun] * n), pa.array([whole] * n), pa.array(top, pa.bool_()), records]
        return pa.RecordBatch.from_arrays(columns, names=["path", "block", "begun", "whole", "top", "record"])

    def one(key, begun, whole, top, texts) -> pa.RecordBatch:
        return rows(key, begun, whole, [top], pa.array([b"\n".join(texts)], pa.binary()))

    # Of the record that is open: its lines so far, whether it began in this block, and as its first one.
    now, state, texts, begun, top, found = None, False, [], False, False, False
    for key, batch in _runs_of_blocks(batches):
        if key != now:
            if texts:
                yield one(now, begun, False, top, texts)
            now, state, texts, begun, top, found = key, batch.column("begins")[0].as_py(), [], False, False, False
        after = _after_lines(batch, state)
        starts = np.flatnonzero(~np.append(state, after[:-1]))
        bounds = np.append(starts, len(after)) if len(starts) and not starts[0] else np.append(np.append(0, starts), len(after))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), batch.column("line")), b"\n")
        low, high = 0, len(joined) - int(after[-1])
        if state:  # the first one goes on from the lines before
            texts.append(joined[0].as_py())
            low = 1
            if high:
                yield one(now, begun, begun, top, texts)
                texts = []
        if low < high:
            # Records of several lines have a quote.
            kept = (np.diff(bounds) > 1) | ~_flags(batch, "blank")[bounds[:-1]]
            records = joined.slice(low, high - low).filter(pa.array(kept[low:high]))
            if len(records):
                yield rows(now, True, True, [not found, *[False] * (len(records) - 1)], records)
                found = True
        if after[-1] and high >= low:
            texts, begun, top, found = [joined[high].as_py()], True, not found, True
        state = bool(after[-1])
    if texts:
        yield one(now, begun, False, top, texts)


def _unpacked(batches) -> Iterator[pa.RecordBatch]:
    """Bytes that each gzip file unpacks to, member by member, or why it does not."""
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            size, reason, rest = 0, None, memoryview(content.as_buffer())
            try:
                while len(rest):
                    member, at = zlib.decompressobj(31), 0
                    while at < len(rest) and not member.eof:
                        size += len(member.decompress(rest[at : at + (1 << 20)]))
                        at += 1 << 20
                    if not member.eof:
                        raise zlib.error("the file ends too early")
                    rest = rest[min(at, len(rest)) - len(member.unused_data) :]
            except zlib.error as error:
                reason = f"gzip: {error}"
            yield pa.RecordBatch.from_arrays([pa.array([path.as_py()]), pa.array([size], pa.int64()), pa.array([reason], pa.string())], names=["path", "unpacked", "reason"])


def broken_files(spark: SparkSession, path: str | list[str], blocks: DataFrame) -> DataFrame:
    """(path, reason) of the files that a lenient survey did not read to their end.

    A plain file was read whole if its lines and their ends are all its bytes. A gzip file was if every
    member unpacks with the right checksum and the lines are what that gives; for this its
    packed bytes must fit a row (two gigabytes). Files packed otherwise are not looked at.
    """
    binary = spark.read.format("binaryFile").option("ignoreCorruptFiles", True).load(path)
    name, size = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
    listed = binary.select(name, size)
    read = blocks.groupBy("path").agg(F.sum("n_bytes").alias("n_read"))
    # The last line may lack its end, which is counted all the same.
    missing = F.coalesce("n_read", F.lit(0)) - F.col("size")
    packed = F.lower("path").rlike(r"\.(gz|bz2|zst|zstd|snappy|lz4|deflate)$")
    short = F.concat(F.lit("only "), F.coalesce("n_read", F.lit(0)), F.lit(" bytes of "), F.col("size"), F.lit(" could be read"))
    plain = listed.join(read, "path", "left").where(~packed & ~missing.isin(0, 1)).select("path", short.alias("reason"))
    zipped = binary.where(F.lower(F.col("_metadata.file_path")).endswith(".gz"))
    unpacked = zipped.select(name, "content").mapInArrow(_unpacked, "path string, unpacked long, reason string")
    tried = listed.where(F.lower("path").endswith(".gz")).join(unpacked, "path", "left").join(read, "path", "left")
    rest = F.coalesce("n_read", F.lit(0)) - F.col("unpacked")
    why = F.coalesce("reason", F.when(F.col("unpacked").isNull(), "could not be opened"), F.when(~rest.isin(0, 1), "gzip: not read to its end"))
    return materialize(plain.unionByName(tried.select("path", why.alias("reason")).where("reason is not null")), "broken-files")


def open_readable(spark: SparkSession, path: str | list[str], sep: str) -> tuple[TextFiles, DataFrame]:
    """The records of the files that can be read to their end, and (path, reason) of the others.

    Every file is read once where a failure only ends that file. The others are then read as usual,
    where a failure, now unexpected, ends the job: nothing is left out unseen.
    """
    blocks = survey(spark, path, sep, lenient=True)
    broken = broken_files(spark, path, blocks)
    names = [r.path for r in broken.select("path").limit(MAX_BROKEN + 1).collect()]
    if len(names) > MAX_BROKEN:
        raise ValueError(f"more than {MAX_BROKEN} files cannot be read, such as {names[0]}")
    whole = blocks.where(~F.col("path").isin(names)) if names else blocks
    return open_files(spark, path, sep, names, blocks=whole), broken
