"""Block gzip against the same text unpacked by Spark's own reader and by Python's csv."""

import gzip
import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from clonarium.sources import blockgzip, delimited
from tests.test_records import collected, plain_read, quoted_text


def member(text, extra=b""):
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(text) + deflate.flush()
    extra += b"BC" + struct.pack("<H", 2)
    size = 12 + len(extra) + 2 + len(body) + 8
    head = b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff" + struct.pack("<H", len(extra) + 2) + extra + struct.pack("<H", size - 1)
    return head + body + struct.pack("<II", zlib.crc32(text), len(text))


def block_gzip(text, size=60, extra=b""):
    parts = [text[i : i + size] for i in range(0, len(text), size)]
    return b"".join(member(p, extra) for p in [*parts, b""])


def lines_of(spark, path, members):
    found = blockgzip.unpacked_lines(spark, path, blockgzip.block_gzip_files(spark, path), 5, members)
    return [r.line for r in sorted(found.collect(), key=lambda r: (r.path, r.block, r.n))]


@pytest.mark.parametrize("members", [1, 3, 256])
def test_lines_over_members_and_runs(spark, tmp_path, members):
    drawn = random.Random(4)
    lines = ["".join(drawn.choice(["é", "日本", "a", " ", "\t", "\r"]) for _ in range(drawn.choice([0, 1, 5, 40, 700]))) for _ in range(300)]
    for i, end in enumerate(["", "\n", "\n\n"]):
        text = "﻿head\n" + "\n".join(lines) + end
        path = tmp_path / f"{i}.gz"
        path.write_bytes(block_gzip(text.encode(), 61, extra=b"XY\x03\x00abc"))
        assert gzip.decompress(path.read_bytes()).decode() == text
        wanted = [r.value for r in spark.read.option("lineSep", "\n").text(str(path)).collect()]
        assert lines_of(spark, str(path), members) == wanted and len(wanted) > 300


def test_what_is_no_block_gzip_is_left_to_the_plain_reader(spark, tmp_path):
    text = b"x\ty\n" + b"".join(b"%d\t%d\n" % (i, i * i) for i in range(400))
    whole = block_gzip(text)
    (tmp_path / "plain.tsv.gz").write_bytes(gzip.compress(text))
    (tmp_path / "several.tsv.gz").write_bytes(gzip.compress(text[:600]) + gzip.compress(text[600:]))
    (tmp_path / "begun.tsv.gz").write_bytes(whole + gzip.compress(b"7\t7\n"))
    (tmp_path / "text.tsv").write_bytes(text)
    (tmp_path / "empty.tsv.gz").write_bytes(b"")
    path = str(tmp_path / "*")
    assert blockgzip.block_gzip_files(spark, path) == []
    (tmp_path / "a b%20[1].tsv.gz").write_bytes(whole)
    assert [p.rsplit("/")[-1][:2] for p in blockgzip.block_gzip_files(spark, path)] == ["a%"]
    read = delimited.read_delimited(spark, path, {"x": "int", "y": "int"}, partitions=4)
    squares = [(i, i * i) for i in range(400)]
    assert sorted(map(tuple, read.collect())) == sorted([*squares * 5, (7, 7)])


def test_quoted_breaks_and_headers(spark, tmp_path):
    """Records over members, of files with and without quoted breaks, next to plain gzip."""
    drawn = random.Random(5)
    texts = [quoted_text(drawn, 120, 4, ",", breaks=b) for b in (True, False, True, False)] + ["c0,c1,c2,c3\n", "\n \nc0,c1,c2,c3\r\n1,2,3,4\r\n"]
    wanted = []
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.csv.gz").write_bytes(gzip.compress(text.encode()) if i == 3 else block_gzip(text.encode()))
        wanted += plain_read(text.replace("\r", ""), ",")[1]
    path = str(tmp_path / "*.csv.gz")
    assert len(blockgzip.block_gzip_files(spark, path)) == 5
    assert collected(delimited.read_text_columns(spark, path, ",", partitions=3)) == sorted(map(tuple, wanted))
    assert collected(delimited.read_text_columns(spark, path, ",")) == sorted(map(tuple, wanted))
    bare = delimited.read_text_columns(spark, str(tmp_path / "1.csv.gz"), ",", names=list("abcd"), partitions=3)
    assert bare.count() == delimited.read_text_columns(spark, str(tmp_path / "1.csv.gz"), ",").count() + 1


def test_one_file_is_unpacked_by_several_tasks(spark, tmp_path):
    (tmp_path / "a.gz").write_bytes(block_gzip(b"some words\n" * 20000, 1000))
    path = str(tmp_path / "a.gz")
    parts = blockgzip.unpacked_lines(spark, path, blockgzip.block_gzip_files(spark, path), 6, members=4)
    held = parts.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(held) > 4 and sum(r["count"] for r in held) == 20000


def test_damage_fails(spark, tmp_path):
    content = bytearray(block_gzip(b"x\n" + b"some words\n" * 500, 1000))
    content[-40] ^= 1  # in the last member with text
    (tmp_path / "a.tsv.gz").write_bytes(content)
    with pytest.raises(Exception, match="(?i)zlib|decompress"):
        delimited.read_delimited(spark, str(tmp_path / "a.tsv.gz"), {"x": "string"}, partitions=2).collect()
    (tmp_path / "a.tsv.gz").write_bytes(content[:-60])
    assert blockgzip.block_gzip_files(spark, str(tmp_path / "a.tsv.gz")) == []


def test_no_row_holds_a_file(spark, tmp_path):
    """Files that no task may read whole are looked through, cut and read all the same."""
    drawn = random.Random(6)
    text = b"x\n" + b"".join(b"%x\n" % drawn.getrandbits(200) for _ in range(3000))
    whole = block_gzip(text, 1000)
    files = {"a.tsv.gz": whole, "B.GZ": whole, "plain.tsv.gz": gzip.compress(text), "begun.tsv.gz": whole + gzip.compress(text[2:])}
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    # What would be one byte too many for a reader of lines, and sizes that lead past the end.
    (tmp_path / "feed.tsv.gz").write_bytes(whole + b"\n")
    (tmp_path / "short.tsv.gz").write_bytes(whole[:-1])
    before = spark.conf.get("spark.sql.sources.binaryFile.maxLength")
    try:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
        found = blockgzip.block_gzip_files(spark, str(tmp_path))
        assert sorted(p.rsplit("/")[-1] for p in found) == ["B.GZ", "a.tsv.gz"]
        paths = [str(tmp_path / name) for name in files]
        read = delimited.read_delimited(spark, paths, {"x": "string"}, partitions=4).collect()
    finally:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", str(before))
    assert sorted(r.x for r in read) == sorted(text.decode().split()[1:] * 5)


def test_runs_of_a_file_that_comes_in_parts():
    drawn = random.Random(7)
    members = [member(drawn.randbytes(drawn.choice([0, 9, 300])), extra=drawn.choice([b"", b"XY\x03\x00abc"])) for _ in range(40)]
    whole = b"".join(members)

    def in_parts(content, largest):
        at = 0
        while at < len(content):
            n = drawn.randint(0, largest)
            yield content[at : at + n]
            at += n

    for largest in (1, 50, 100_000):
        for n in (1, 3, 39, 40, 256):
            wanted = [b"".join(members[i : i + n]) for i in range(0, 40, n)]
            assert list(blockgzip._runs(in_parts(whole, largest), n)) == wanted
        for wrong in (whole[:-1], whole + b"\n", whole + b"\x1f\x8b\x08\x04", b"\n" + whole, b""):
            assert list(blockgzip._runs(in_parts(wrong, largest), 256))[-1] is None
    # A run is handed on once it is there, and a header that fills its bytes.
    wide = [member(b"text", extra=b"XY" + struct.pack("<H", 60_000) + bytes(60_000))] * 9
    assert list(blockgzip._runs(in_parts(b"".join(wide), 999), 2)) == [b"".join(wide[i : i + 2]) for i in range(0, 9, 2)]
