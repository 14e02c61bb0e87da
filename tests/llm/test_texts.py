"""Operators 1, 4, 5 and 6 against brute force."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clonarium.llm import chat_format, decontaminate, line_crf, pii, queries

# ---- personal data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    numbers = [int(c) for c in reversed(digits)]
    return (sum(numbers[::2]) + sum(sum(divmod(2 * n, 10)) for n in numbers[1::2])) % 10 == 0


def plain_spans(text):
    found = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), rank, m.end(), kind))
    return [(k, a, b) for a, _, b, k in sorted(found)]


CASES = [
    "", None, "a@b.c", "a@b", "foo@bar@baz.com", "a@b.c+d@e.f", "x@y.z_w@q.r", "..@-.-", "é@a.b ü", "a@b..c d@e.f.",
    "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "0255.01.1.1", "12a1.2.3.4", "1.2.3", "999999999999999999999.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "x4111111111111111y", "0" * 12, "0" * 20, "1 2 3 4 5 6 7 8 9 0 1 2 3",
    "+1 (068) 555-2748", "+1+2 345 678 901", "+123", "+1 2345678901234567", "++49 30 123456-7.", "日本 +81 3-1234-5678 a@b.jp",
    "my card 4111 1111 1111 1111 and mail me a@b.c at 10.0.0.1 or +49 30 1234567", "9" * 12000, "a" * 9000 + "@", "1 " * 6000,
]


@pytest.fixture
def pii_texts():
    drawn = random.Random(1)
    letters = ["@", ".", "+", "-", " ", "(", ")", *"0123456789", "a", "Z", "_", "%", "é", "4111111111111111", "1.2.3.4"]
    return CASES + ["".join(drawn.choice(letters) for _ in range(drawn.randrange(60))) for _ in range(600)]


def test_pii_base_spans(spark, pii_texts):
    rows = [(i, t, "x") for i, t in enumerate(pii_texts)]
    found = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string, _text string")).collect()
    assert len(found) == len(rows)
    for row in found:
        assert [(s.kind, s.start, s.end) for s in row.pii if s.kind in PLAIN] == plain_spans(row.text), repr(row.text)


def test_account_numbers_and_context(spark):
    texts = ["IBAN: GB82 WEST 1234 5698 7654 32.", "GB82 WEST 1234 5698 7654 33", "DE89370400440532013000",
             "mail to a@b.c", "see a@b.c", "é" * 5 + "DE89370400440532013000"]
    found = pii.find_pii(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    spans = [[(s.kind, s.start, s.end, s.score) for s in r.pii if s.kind != "card"] for r in found]
    assert spans == [[("iban", 6, 33, 0.9)], [], [("iban", 0, 22, 0.8)], [("email", 8, 13, 1.0)], [("email", 4, 9, 0.9)],
                     [("iban", 5, 27, 0.8)]]


def plain_accounts(text):
    """Every place tried with its country's length, by hand; the leftmost that do not overlap."""
    lengths = {c: n for n, names in pii.IBAN_COUNTRIES.items() for c in names.split()}
    found, end = [], 0
    for at in range(len(text)):
        length, taken, stop = lengths.get(text[at : at + 2], 0), "", at
        while len(taken) < length and stop < len(text):
            if text[stop] == " " and taken and len(taken) % 4 == 0 and text[stop - 1] != " ":
                stop += 1
                continue
            if not re.match("[A-Z0-9]", text[stop]):
                break
            taken, stop = taken + text[stop], stop + 1
        whole = length and len(taken) == length and re.match("[0-9]{2}", taken[2:4]) and not re.match("[A-Z0-9]", text[stop : stop + 1])
        if whole and int("".join(str(int(c, 36)) for c in taken[4:] + taken[:4])) % 97 == 1 and at >= end:
            end = stop
            found.append((at, end))
    return found


def test_account_numbers_next_to_other_blocks(spark, tmp_path):
    cases = {
        "AT61 1904 3002 3457 3201 BIC BKAUATWW": [(0, 24)],
        "BE68 5390 0754 7034 EUR": [(0, 19)],
        "REF20 GB82 WEST 1234 5698 7654 32": [(6, 33)],
        "BE20 GB82 WEST 1234 5698 7654 32 1": [(5, 32)],
        "ES9121000418450200051332 SE45 5000 0000 0583 9825 7466 PL61 1090 1014 0000 0712 1981 2874": [(0, 24), (25, 54), (55, 89)],
        "CZ65 0800 0000 1920 0014 5399 A1, NO93 8601 1117 947 X": [(0, 29), (34, 52)],
        "IBANGB82WEST12345698765432": [(4, 26)],
        "GB82 WEST 1234 5698 7654 321": [],
        "é AT61  1904 3002 3457 3201": [],
    }
    numbers = ["AT611904300234573201", "BE68 5390 0754 7034", "GB82WEST12345698765432", "NO93 8601 1117 947", "MT84MALT011000012345MTLCAST001S"]
    drawn = random.Random(3)
    parts = [*numbers, *numbers, "BIC", "EUR", "REF20", "DE89", "BE20", "A", "1", "é", "-", "BKAUATWW", "iban"]
    drawn_texts = ["".join(drawn.choice(parts) + drawn.choice([" ", " ", " ", "", "  "]) for _ in range(drawn.randrange(9))) for _ in range(400)]
    texts = [*cases, *drawn_texts]
    assert [plain_accounts(t) for t in cases] == list(cases.values())
    found = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {r.text: [(s.start, s.end) for s in r.pii if s.kind == "iban"] for r in found}
    assert got == {t: plain_accounts(t) for t in texts}
    assert sum(map(len, got.values())) > 300
    # The SQL knows the same rule, context scores included.
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    query = queries.QUERIES["op1_pii"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    wanted = con.execute(f"SELECT {', '.join(query.columns)} FROM ({queries.ORACLES['op1_pii']})").fetchall()
    assert sorted(map(tuple, query.collect())) == sorted(wanted)


def test_running_sums_over_several_blocks(spark):
    row = spark.range(1).select(pii.running_sums(F.transform(F.sequence(F.lit(1), F.lit(1000)), lambda x: x.cast("long"))).alias("s"))
    assert row.first().s == np.cumsum(np.arange(1, 1001)).tolist()


def test_redaction(spark):
    texts = ["hi a@b.c, 10.0.0.1!", None, "", "none", "+1.2.3.4555555", "é a@b.c"]
    found = pii.find_pii(spark.createDataFrame([(t, 1) for t in texts], "text string, x int"))
    got = [r.text for r in pii.redact(found).collect()]
    assert got == ["hi <email>, <ip>!", None, "", "none", "<phone>", "é <email>"]


def test_pii_uses_no_python(spark, docs):
    plan = pii.redact(pii.find_pii(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_no_pii_rows(no_docs):
    assert pii.find_pii(no_docs).collect() == []


# ---- chats


def test_escaping_is_reversible():
    drawn = random.Random(2)
    parts = ["<", "[", "\\", "/", "s>", "INST]", "SYS>>", "ROLE ", "]", "a", " ", "<s>", "[/INST]", "[ROLE x]", "\n", "]\\"]
    for _ in range(20000):
        text = "".join(drawn.choice(parts) for _ in range(drawn.randrange(9)))
        assert chat_format.unescape(chat_format.escape(text)) == text
        role = drawn.choice(["user", "assistant", "system", "tool", "", "a]b\\", text])
        formatted, begin, end = chat_format.render(role, text)
        assert list(chat_format.parse(formatted * 2)) == [(role, text)] * 2
        assert chat_format.unescape(formatted[begin:end]) == (text if role == "assistant" else "")


def test_events_are_folded():
    fold = chat_format.fold
    assert fold([("message", "user", "a"), ("delta", "user", "b"), ("delta", "user", "c")]) == ("user", "abc")
    assert fold([("message", "assistant", "a"), ("regenerate", "assistant", ""), ("delta", "assistant", "b")]) == ("assistant", "b")
    assert fold([("message", "user", "a"), ("edit", "user", "z"), ("delta", "user", "!")]) == ("user", "z!")
    assert fold([("message", "user", "a"), ("delete", "user", "")]) is None
    assert fold([("message", "user", "a"), ("delete", "user", ""), ("edit", "user", "b")]) == ("user", "b")
    with pytest.raises(ValueError):
        fold([("unknown", "user", "a")])


def test_event_log_of_a_conversation(spark):
    log = [(1, 2, 1, 0, "message", "assistant", "x"), (1, 2, 1, 2, "regenerate", "assistant", ""), (1, 2, 1, 1, "delta", "assistant", "y"),
           (1, 2, 1, 3, "delta", "assistant", "</s>"), (1, 1, 1, 0, "message", "user", "hi"), (1, 3, 1, 0, "message", "user", "bye"),
           (1, 3, 1, 1, "delete", "user", "")]
    schema = "conv_id long, turn long, place long, seq int, kind string, role string, text string"
    turns = chat_format.format_turns(spark.createDataFrame(log, schema))
    assert sorted((r.turn, r.formatted) for r in turns.collect()) == [(1, "[INST]hi[/INST]"), (2, r"<s><\/s></s>")]
    row = chat_format.read_back(turns).first()
    assert (row.n_turns, row.loss_chars) == (2, 4)


def test_conversations_read_back(spark):
    drawn = random.Random(7)
    parts = ["</s>", "[INST]", " ok ", "\\", "<<SYS>>", "é", "\n", "x" * 700]
    rows = [
        (c, t, drawn.choice(["user", "assistant", "system", "tool", None]), drawn.choice([None, "".join(drawn.choices(parts, k=4))]), 0)
        for c in [None, 1, 2, 3, 4, 5]
        for t in range(drawn.randrange(1, 9))
    ]
    rows += [rows[1], rows[1], (9, None, "user", "no turn number", 1), (9, 1, "assistant", "", 1)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place int").repartition(3)
    found = chat_format.read_back(chat_format.format_turns(chat_format.message_events(frame))).collect()
    assert sorted(found, key=str) == sorted(found, key=str)
    assert {r.conv_id for r in found} == {None, 1, 2, 3, 4, 5, 9}
    for row in found:
        mine = [(t, r or "", x or "") for c, t, r, x, _ in rows if c == row.conv_id]
        mine.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1], m[2]))
        loss = "".join(x for _, r, x in mine if r == "assistant")
        assert row.n_turns == len(mine)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in mine).encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_logs_hold_all_kinds_and_end_in_the_given_turns(spark):
    rows = [(c, t, "user" if t % 2 else "assistant", f"text {t} " * (1 + t % 200)) for c, n in ((1, 300), (2, 3), (3, 40)) for t in range(n)]
    log = chat_format.message_events(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    kinds = {r.kind: r["count"] for r in log.groupBy("kind").count().collect()}
    assert set(kinds) == {"message", "delta", "edit", "regenerate", "delete"} and min(kinds.values()) > 40
    # Turns deleted for good, besides those given.
    assert log.where("place < 0").select("conv_id", "turn").distinct().count() > 10
    found = chat_format.format_turns(log, dealt=True).collect()
    assert sorted((r.conv_id, r.turn, *chat_format.parse(r.formatted)) for r in found) == sorted((c, t, (r, x)) for c, t, r, x in rows)
    shuffled = log.repartition(7)
    again = chat_format.format_turns(shuffled.select("conv_id", "turn", "place", "seq", "kind", "role", "text")).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))
    # One shuffle up to the folded turns.
    plan = chat_format.format_turns(log, dealt=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.read_back(chat_format.format_turns(chat_format.message_events(empty))).collect() == []


# ---- quality


def quality_corpus(n=240, mixed=False):
    """Good and bad documents; if ``mixed``, some lines of the bad ones are like those of the good."""
    drawn = random.Random(11)
    words = ["the", "shore", "and", "winter", "came", "over", "a", "quiet", "harbour"]

    def good():
        return " ".join(drawn.choice(words) for _ in range(drawn.randrange(5, 14))).capitalize() + "."

    def bad():
        return " | ".join(drawn.choice(words) + drawn.choice("#$%") for _ in range(8))

    out = []
    for i in range(n):
        label = i % 2
        lines = [(good if label else bad)() for _ in range(drawn.randrange(1, 8))]
        if mixed and not label:
            lines[1:1] = [good() for _ in range(drawn.randrange(4))]
        out.append((i, "\n".join(lines), label))
    return out


def test_quality_is_learnt_and_held_out_documents_are_told_apart(spark):
    rows = quality_corpus()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows if i < 160], "doc_id long, quality int")
    model = line_crf.train(docs, labels, F.lit(True))
    again = line_crf.train(docs.repartition(5), labels.repartition(2), F.lit(True))
    assert np.allclose(model.weights, again.weights)
    found = {r.doc_id: r for r in line_crf.score(docs, model).collect()}
    assert all((found[i].score >= 0.5) == bool(q) for i, _, q in rows if i >= 160)
    assert all(found[i].n_bad_lines == (0 if q else found[i].n_lines) for i, _, q in rows[160:])


def test_lines_of_one_document_may_differ(spark):
    rows = quality_corpus(mixed=True)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows if i < 160], "doc_id long, quality int")
    model = line_crf.train(docs, labels, F.lit(True))
    found = {r.doc_id: r for r in line_crf.score(docs, model).collect()}
    assert all((found[i].score >= 0.5) == bool(q) for i, _, q in rows if i >= 160)
    hidden = [(found[i].n_bad_lines, sum("|" in line for line in t.split("\n")), t.count("\n") + 1) for i, t, q in rows if i >= 160 and not q]
    assert sum(bad < n for _, bad, n in hidden) > 15
    assert np.mean([n_bad == bad for n_bad, bad, _ in hidden]) >= 0.9
    # The chain changes state within documents, and prefers not to.
    assert model.links[0, 0] + model.links[1, 1] > model.links[0, 1] + model.links[1, 0]


def test_marginals_are_those_of_all_paths():
    drawn = np.random.default_rng(4)
    for n in (1, 2, 5):
        unary, links = drawn.standard_normal(n), drawn.standard_normal((2, 2))
        weights = {}
        for path in np.ndindex(*(2,) * n):
            total = sum(u for u, s in zip(unary, path, strict=True) if s) + sum(links[a, b] for a, b in zip(path, path[1:]))
            weights[path] = np.exp(total)
        wanted = [sum(w for p, w in weights.items() if p[i]) / sum(weights.values()) for i in range(n)]
        ahead, behind = line_crf.forward_backward(unary, links, line_crf.Chains(np.array([n])))
        assert np.allclose(line_crf._sigmoid(ahead + behind), wanted)


def test_scores_of_odd_rows(spark, docs, twice, no_docs):
    rows = quality_corpus(60)
    known = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([*((i, q) for i, _, q in rows), (None, 1), (3, None)], "doc_id long, quality int")
    model = line_crf.train(known, labels, F.col("doc_id").isNotNull())
    for frame, n in ((docs, docs.count()), (twice, 6), (no_docs, 0)):
        scores = [r.score for r in line_crf.score(frame, model, "source").collect()]
        assert len(scores) == n
        assert all(0 <= s <= 1 for s in scores)
    assert line_crf.train(known, labels.where("false"), F.lit(True)) == 0.5
    assert line_crf.train(known, labels.where("quality = 1"), F.lit(True)) == 1.0
    assert {r.score for r in line_crf.score(twice, 0.5).collect()} == {0.5}


# ---- benchmark

_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_words(text):
    return _WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_hits(texts, items, width):
    windows = {}
    for name, text in items:
        listed = plain_words(text)
        for i in range(max(1, len(listed) - width + 1) if listed else 0):
            windows.setdefault(tuple(listed[i : i + width]), set()).add(name)
    out = []
    for text in texts:
        listed, names = plain_words(text), set()
        hit = [False] * len(listed)
        for size in {len(w) for w in windows}:
            for i in range(len(listed) - size + 1):
                if found := windows.get(tuple(listed[i : i + size])):
                    names |= found
                    hit[i : i + size] = [True] * size
        out.append((len(listed), sum(hit), sorted(names)))
    return out


@pytest.fixture
def benchmark_items(texts):
    items = [(i, " ".join(t.split()[3:20])) for i, t in enumerate(texts[:8])]
    return [*items, (20, texts[9]), (21, "Tion"), (22, "étre 日本"), (23, ""), (24, None), (25, "no such words here"), (20, texts[10]), (None, texts[0])]


@pytest.mark.parametrize("segment", [1 << 23, 300])
def test_benchmark_windows(spark, docs, texts, benchmark_items, segment):
    bench = spark.createDataFrame(benchmark_items, "item_id long, text string")
    found = sorted(decontaminate.find_benchmark(docs, bench, "source", width=4, slop=1, segment_bytes=segment).collect())
    items = [(i, t) for i, t in benchmark_items if i is not None]
    wanted = plain_hits([*texts, None], items, 4)
    assert [(r.n_words, sum(x.end - x.begin for x in r.runs), r.items) for r in found] == wanted
    assert all(set(r.items) <= set(r.near) for r in found)


def test_proximity_matches(spark):
    docs = spark.createDataFrame([(1, "one two x three four"), (2, "one two three four"), (3, "one x x x x two x x three four")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "one two three four")], "item_id long, text string")
    for slop, near in ((0, [2]), (1, [1, 2]), (9, [1, 2, 3])):
        found = decontaminate.find_benchmark(docs, bench, width=4, slop=slop).collect()
        assert sorted(r.doc_id for r in found if r.near) == near
        assert [r.doc_id for r in found if r.items] == [2]


def test_proximity_matches_against_brute_force(spark):
    drawn = random.Random(12)
    texts = [" ".join(drawn.choice("abcde") for _ in range(drawn.randrange(30))) for _ in range(80)]
    items = [(i, " ".join(drawn.choice("abcde") for _ in range(5))) for i in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = decontaminate.find_benchmark(docs, spark.createDataFrame(items, "item_id long, text string"), width=4, slop=1)
    windows = {(i, tuple(t.split()[k : k + 4])) for i, t in items for k in range(2)}
    for row in found.collect():
        listed = texts[row.doc_id].split()
        near = {
            i
            for i, w in windows
            for s in range(len(listed) - 3)
            if all(w[j] in listed[max(s + j - 1, 0) : s + j + 2] for j in range(4))
        }
        assert row.near == sorted(near)


def test_benchmark_without_rows(spark, twice, no_docs, docs):
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert decontaminate.find_benchmark(no_docs, bench).collect() == []
    assert sum(bool(r.items) for r in decontaminate.find_benchmark(twice, bench).collect()) == 3
    assert not any(r.items or r.runs for r in decontaminate.find_benchmark(docs, bench.where("false")).collect())


def test_benchmark_words_that_repeat(spark):
    """Windows of one frequent word, whose lists are as long as the texts, and a text of many segments' size."""
    texts = ["a " * 5000, "b a a a a b " * 700, "a a a", "b " * 40]
    items = [(1, "a a a a a a"), (2, "a b b a"), (3, "b b a a a")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = sorted(decontaminate.find_benchmark(docs, bench, width=4, slop=2, segment_bytes=1000).collect())
    assert [(r.n_words, sum(x.end - x.begin for x in r.runs), r.items) for r in found] == plain_hits(texts, items, 4)
    kept = decontaminate.drop_contaminated(docs, bench, width=4)
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, hit in enumerate(plain_hits(texts, items, 4)) if not hit[1]]


def test_candidates_in_parts_give_the_same_matches(monkeypatch):
    rows = list(decontaminate._postings([7, 9], [b"a b a a b a", b"b b a a a b"]))
    names = [*rows[0].schema.names, "window", "words"]

    def matches():
        state = decontaminate.Segment()
        for part in rows:
            state.parts.append(pa.RecordBatch.from_arrays([*part.columns, pa.nulls(len(part)), pa.nulls(len(part))], names=names))
        state.seal()
        asked = pa.RecordBatch.from_pydict({"window": [0, 1, 2], "words": [[b"a", b"b"], [b"b", b"a", b"a"], [b"a", b"c"]]})
        made = [r for b in state.search(asked, 1) for r in b.to_pylist()]
        return sorted((r["key"], r["window"], r["exact"]) for r in made), [r for b in state.runs() for r in b.to_pylist()]

    whole = matches()
    monkeypatch.setattr(decontaminate, "CANDIDATES", 1)
    assert matches() == whole
    assert {k for k, _, _ in whole[0]} == {7, 9}
