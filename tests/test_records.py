"""Delimited text against Python's csv reader, in one piece and in many blocks."""

import contextlib
import csv
import gzip
import io
import random

import pytest
from pyspark.sql import functions as F

from clonarium.sources import delimited, headed, records
from clonarium.sources.store import header_sizes


@contextlib.contextmanager
def small_blocks(spark, size=512):
    """Files read in blocks of ``size`` bytes, each a task of its own."""
    names = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": str(size)}
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def plain_read(text, sep):
    """Rows without the header; lines of spaces only are blank, as they are outside quotes."""
    rows = [r for r in csv.reader(io.StringIO(text, newline="\n"), delimiter=sep) if not (len(r) == 1 and not r[0].strip(" ")) and r]
    return rows[0], rows[1:]


def quoted_text(drawn, n, width, sep, breaks=True, long=False):
    """A table with quotes, doubled quotes, separators and line breaks in cells."""

    def cell():
        kind = drawn.randrange(9)
        if kind == 0:
            return f'"a{sep}b ""{drawn.randrange(99)}"""'
        if kind == 1 and breaks:
            return '"' + "\n".join(drawn.choice(["one", "", '""two""', sep, "x" * drawn.randrange(1, 900 if long else 9)]) for _ in range(drawn.randrange(2, 5))) + '"'
        if kind == 2:
            return drawn.choice(['5" wide', 'a"b"c', '3\'"', '""', '"whole"', '"x"y', '"x"y"z'])
        return drawn.choice(["", "NA", "plain", f"{drawn.random()}", "é日本", " spaced ", "\\", "it's"])

    head = sep.join(f"c{i}" for i in range(width))
    lines = [sep.join([str(i), *(cell() for _ in range(width - 1))]) for i in range(n)]
    return "\n".join([head, *lines]) + drawn.choice(["", "\n", "\n\n"])


def collected(df):
    return sorted(tuple(v or "" for v in r) for r in df.collect())


@pytest.mark.parametrize("sep", [",", "\t", "|"])
def test_cells_are_those_of_the_csv_reader(spark, sep):
    drawn = random.Random(3)
    lines = quoted_text(drawn, 400, 5, sep, breaks=False).splitlines()
    lines += [f'"{sep}"', f'""{sep}""', f'"""a"""{sep}"', f'a{sep}"b""', f'"a"{sep}{sep}"b"', '"', '""', '"""', f'"{sep}""{sep}"{sep}x"']
    frame = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    found = frame.select(
        "i", records.cells(F.col("line"), sep).alias("cells"), records.ends_inside(F.col("line"), sep).alias("open")
    ).collect()
    for row in found:
        line = lines[row.i]
        reader = csv.reader([line, '"ZZ'], delimiter=sep)
        wanted = next(reader)
        assert row.open == (reader.line_num == 2), line
        if not row.open:
            assert row.cells == wanted, line


@pytest.mark.parametrize("long", [False, True])
def test_quoted_breaks_in_many_blocks(spark, tmp_path, long):
    drawn = random.Random(9)
    texts = [quoted_text(drawn, 120, 4, ",", long=long) for _ in range(3)] + ["c0,c1,c2,c3\n1,2,3,4\n" + "5,6,7,8\n" * 300]
    wanted = []
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.csv").write_text(text, newline="")
        wanted += plain_read(text, ",")[1]
    wanted = sorted(map(tuple, wanted))
    path = str(tmp_path / "*.csv")
    assert collected(delimited.read_text_columns(spark, path, ",")) == wanted
    with small_blocks(spark):
        assert spark.read.text(path).rdd.getNumPartitions() > 20
        assert collected(delimited.read_text_columns(spark, path, ",")) == wanted
        assert collected(delimited.read_text_columns(spark, path, ",", partitions=3)) == wanted
    some = headed.read_entity_columns(
        spark, path, headed.key_from_file_name("{key}.csv"), {"c2": "string", "c0": "string"}, sep=",", markers=[]
    )
    assert sorted((r.c2 or "", r.c0) for r in some.collect()) == sorted((r[2], r[0]) for r in wanted)


def test_a_header_with_a_line_break(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('\n"first\nname",b\n1,2\n')
    df = delimited.read_text_columns(spark, str(tmp_path / "a.csv"), ",")
    assert df.columns == ["first\nname", "b"] and rows(df) == [("1", "2")]


def test_spreading_lines_keeps_every_character(spark, tmp_path, rows):
    """Control characters, quotes and what looks like a separator of another kind, plain and packed."""
    drawn = random.Random(12)
    marks = [chr(c) for c in range(1, 32) if c not in (9, 10, 13)] + ["\x00", "\x7f", '"', "\\", "#", " ", "é", "\x85", " "]
    pairs = [tuple("".join(drawn.choice(marks + ["a", "b"]) for _ in range(drawn.randrange(5))) for _ in range(2)) for _ in range(800)]
    pairs += [("y", "\x01z"), ("\x01", "\x01"), ("", ""), ("", "\x02"), ("\x1f", "\x1f\x01")]
    text = "x\ty\n" + "".join(f"{a}\t{b}\n" for a, b in pairs if not a.startswith('"') and not b.startswith('"'))
    (tmp_path / "a.tsv").write_text(text, newline="")
    (tmp_path / "a.tsv.gz").write_bytes(gzip.compress(text.encode()))
    wanted = sorted(tuple(line.split("\t")) for line in text.split("\n")[1:-1])
    for name in ("a.tsv", "a.tsv.gz"):
        for partitions in (None, 2):
            assert collected(delimited.read_text_columns(spark, str(tmp_path / name), partitions=partitions)) == wanted


def test_files_must_share_a_header(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("x\ty\n1\t2\n")
    (tmp_path / "b.tsv").write_text('"x"\ty\n3\t4\n')
    (tmp_path / "empty.tsv").write_text("")
    path = str(tmp_path / "*.tsv")
    assert collected(delimited.read_text_columns(spark, path)) == [("1", "2"), ("3", "4")]
    (tmp_path / "b.tsv").write_text("y\tx\n3\t4\n")
    with pytest.raises(ValueError, match="different headers"):
        delimited.read_text_columns(spark, path)
    (tmp_path / "c.tsv").write_text("y\ty\n3\t4\n")
    with pytest.raises(ValueError, match="repeats a column"):
        delimited.read_text_columns(spark, str(tmp_path / "c.tsv"))


def test_header_sizes_know_separators_and_quotes(spark, tmp_path):
    wanted = {}
    for name, text, sep, n in (("a", "a|b|c\n1|2|3", "|", 3), ("b", '"a,x",b\n', ",", 2), ("c", '"a""",b,"c"', ",", 3), ("d", "a.b", ".", 2)):
        (tmp_path / name).write_text(text)
        assert header_sizes(spark, str(tmp_path / name), sep).collect()[0].n_columns == n, name


def test_files_that_cannot_be_read_are_left_out(spark, tmp_path):
    """Cut off, damaged and empty packed files; good ones of one and of several members."""

    def put(tumour, content, name="cp_table.csv.gz"):
        (tmp_path / tumour).mkdir()
        (tmp_path / tumour / name).write_bytes(content)

    drawn = random.Random(2)
    table = "clone,s1\n" + "".join(f"clone{i},{drawn.random()}\n" for i in range(5000))
    packed = gzip.compress(table.encode())
    put("T1", packed)
    put("T2", packed[: len(packed) // 2])
    put("T3", gzip.compress(b"clone,s1\nclone1,1\n") + gzip.compress(b"clone2,2\n"))
    put("T4", packed[:3000] + b"\x00\x11\x22" * 20 + packed[3060:])
    put("T5", b"clone,s1\nclone1,9\n", "cp_table.csv")
    put("T6", gzip.compress(b"clone,s1\nclone1,1\n") + gzip.compress(b"clone2,2\n")[:-9])
    put("T7", packed[:-8] + b"\x00" * 8)
    put("T8", b"not packed at all")
    long, rejects = headed.read_ragged_matrices(spark, str(tmp_path / "*/cp_table.csv*"), "clone", key="tumour", markers=[])
    found = {r.tumour: (r["n"], r["total"]) for r in long.groupBy("tumour").agg(F.count("value").alias("n"), F.sum("value").alias("total")).collect()}
    assert {t: n for t, (n, _) in found.items()} == {"T1": 5000, "T3": 2, "T5": 1}
    assert found["T3"][1] == 3
    reasons = {r.path.split("/")[-2]: r.reason for r in rejects.collect()}
    assert sorted(reasons) == ["T2", "T4", "T6", "T7", "T8"] and all(r.startswith("gzip:") for r in reasons.values()), reasons


def test_one_broken_file_of_three(spark, tmp_path, rows):
    for i, cut in enumerate((None, 40, None)):
        (tmp_path / f"E{i}").mkdir()
        content = gzip.compress(("clone,s\n" + "".join(f"c{j},{j}\n" for j in range(i + 20))).encode())
        (tmp_path / f"E{i}" / "t.csv.gz").write_bytes(content[:cut])
    long, rejects = headed.read_ragged_matrices(spark, str(tmp_path / "*/t.csv.gz"), "clone", markers=[])
    assert rows(long.groupBy("entity").count()) == [("E0", 20), ("E2", 22)]
    assert [(r.path.split("/")[-2], r.reason.split(":")[0]) for r in rejects.collect()] == [("E1", "gzip")]


def test_too_many_broken_files_fail(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "MAX_BROKEN", 1)
    for i in range(2):
        (tmp_path / f"{i}.csv.gz").write_bytes(b"broken")
    with pytest.raises(ValueError, match="more than 1 files cannot be read"):
        headed.read_ragged_matrices(spark, str(tmp_path / "*.gz"), "clone", markers=[])


def plans_of(monkeypatch):
    """The plans of the scratch tables that the records module writes from now on, by name."""
    plans, write = {}, records.materialize

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(records, "materialize", noted)
    return plans


def test_lines_of_quoted_files_are_not_shuffled(spark, tmp_path, monkeypatch):
    """Records are put together where their lines are read; the one that covers several blocks comes out whole."""
    cell = "\n".join(["one", "", '""two""'] * 200)
    text = "a,b\n" + "".join(f'{i},"x\n{i}"\n' for i in range(100)) + f'200,"{cell}"\n \n201,"y\r\n"\r\n'
    (tmp_path / "a.csv").write_text(text, newline="")
    plans = plans_of(monkeypatch)
    with small_blocks(spark):
        found = collected(delimited.read_text_columns(spark, str(tmp_path / "a.csv"), ","))
    assert found == sorted([*((str(i), f"x\n{i}") for i in range(100)), ("200", cell.replace('""', '"')), ("201", "y\r\n")])
    for name in ("block-maps", "records"):
        assert "hashpartitioning" not in plans[name] and "Sort" not in plans[name], name


def test_the_survey_sorts_no_lines(spark, tmp_path, monkeypatch):
    (tmp_path / "a.tsv").write_text("\n \nx\ty\n1\t2\n\x01\n")
    plans = plans_of(monkeypatch)
    found = records.survey(spark, str(tmp_path / "a.tsv"), "\t").first()
    assert "Sort" not in plans["survey"]
    assert (found.n_bytes, found.first, found.n_open, found.has_faint) == (13, "x\ty", 0, True)


def test_the_lines_of_matrices_are_not_sorted(spark, tmp_path, monkeypatch):
    """Of several reasons, the first in alphabetical order, found without a sort of the lines."""
    texts = {"a": "clone,s\n1,2,3\n1,x\n1\n", "b": "clone,s\n1\n1,2,3\n", "c": "clone,s\n1\n", "d": "clone,s\n1,2\n"}
    for name, text in texts.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "t.csv").write_text(text)
    plans, write = {}, headed.materialize

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(headed, "materialize", noted)
    _, rejects = headed.read_ragged_matrices(spark, str(tmp_path / "*/t.csv"), "clone", markers=[])
    found = {r.path.split("/")[-2]: r.reason for r in rejects.collect()}
    assert found == {"a": "cell is not a number", "b": "line longer than the header", "c": "line shorter than the header"}
    assert "SortAggregate" not in plans["rejects"]
