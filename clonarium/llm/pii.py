"""Personal data in texts, by DataFrame functions alone (operator 1).

Regular expressions propose spans; numbers must pass their checksum (Luhn for cards, mod-97
for bank accounts) or range; words shortly before a span raise its score. Spans are counted in
code points with the end excluded. Per kind they are the leftmost matches that do not overlap;
spans of different kinds may. An account number is as long as its country says, whatever stands
after it, and is tried at every place where one may begin.

The patterns are written so that matching stays linear in the text: what a shorter start
could not match is not tried again, and repeated groups give nothing back. Positions come from
the lengths of the matches and of the pieces between them.

Null text counts as empty; a text without personal data has an empty array. Repeated rows are
answered one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BLOCK = 128  # running sums are made in two levels, so that long arrays stay cheap
CONTEXT_CHARS = 40


@dataclass(frozen=True)
class Kind:
    """One kind of personal data: what proposes it, what hints at it, and how sure it is."""

    name: str
    pattern: str
    hint: str  # only texts that match this are searched
    context: tuple[str, ...]
    score: float
    head: int = 0  # if any, the pattern takes so many characters, and the match is its group 1 from there on


# Characters of an account number by country: the registry of ISO 13616, and countries that use the form without an entry.
IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV",
    22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_pattern() -> str:
    """Takes the first four characters, no two of which can overlap, so that no number hides another."""

    def blocks(length: int) -> str:
        whole, rest = divmod(length - 4, 4)
        return rf"(?:\x20?[A-Z0-9]{{4}}){{{whole}}}" + (rf"\x20?[A-Z0-9]{{{rest}}}" if rest else "")

    numbers = "|".join(rf"(?:{names.replace(' ', '|')})[0-9]{{2}}{blocks(n)}" for n, names in IBAN_COUNTRIES.items())
    return rf"(?=[A-Z]{{2}}[0-9]{{2}})(?=({numbers})(?![A-Z0-9]))[A-Z0-9]{{4}}"


# In the order that breaks ties between spans of one start.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@",
         ("mail", "contact", "write to"), 0.9),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", ("ip", "host", "server", "address"), 0.6),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "", ("card", "visa", "credit", "payment"), 0.7),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", ("phone", "call", "tel", "mobile", "fax"), 0.6),
    Kind("iban", _iban_pattern(), "", ("iban", "account", "bank"), 0.8, head=4),
)
CONTEXT_BONUS = 0.1


def running_sums(values: Column) -> Column:
    """The sum up to and including each element of an array."""

    def extend(sums: Column, value: Column) -> Column:
        last = F.when(F.size(sums) > 0, F.element_at(sums, -1)).otherwise(F.lit(0).cast("long"))
        return F.concat(sums, F.array(last + value))

    empty = F.expr("cast(array() as array<long>)")
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _BLOCK).cast("int")),
        lambda b: F.aggregate(F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)), empty, extend),
    )
    before = F.aggregate(
        blocks,
        F.array(F.lit(0).cast("long")),
        lambda sums, block: F.concat(sums, F.array(F.element_at(sums, -1) + F.element_at(block, -1))),
    )
    return F.flatten(F.transform(blocks, lambda block, b: F.transform(block, lambda x: x + F.get(before, b))))


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def add(total: Column, i: Column) -> Column:
        digit = F.ascii(F.substr(digits, F.length(digits) - i, F.lit(1))) - 48
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(i % 2 == 1, twice).otherwise(digit)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _mod97(found: Column) -> Column:
    """Whether an account number has remainder one, its first four characters put last."""
    compact = F.translate(found, " ", "")
    turned = F.concat(F.substr(compact, F.lit(5)), F.substr(compact, F.lit(1), F.lit(4)))

    def add(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substr(turned, i, F.lit(1)))
        return F.when(code < 65, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def _confirmed(kind: str, found: Column) -> Column:
    if kind == "ip":
        return found.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])(?:\.|$)){4}$")
    if kind == "card":
        digits = _digits(found)
        return F.length(digits).between(12, 19) & F.when(F.length(digits).between(12, 19), _luhn(digits))
    if kind == "phone":
        return F.length(_digits(found)).between(9, 15)
    if kind == "iban":
        return _mod97(found)
    return F.lit(True)


_SPAN = "struct<start: long, rank: int, end: long, kind: string, score: double>"


def _matches(kind: Kind) -> Column:
    """All matches of a kind's pattern; texts without its hint are not searched."""
    found = F.regexp_extract_all("_text", F.lit(kind.pattern), F.lit(1 if kind.head else 0))
    hint = F.instr("_text", kind.hint) > 0 if kind.hint else F.lit(True)
    return F.when(hint, found).otherwise(F.expr("cast(array() as array<string>)"))


def _spans(kind: Kind, rank: int) -> Column:
    """The confirmed matches in column ``_<kind>`` with positions and scores; those of a kind with a
    head may overlap."""
    found = F.col(f"_{kind.name}")
    pieces, ends = F.col(f"_{kind.name}_pieces"), F.col(f"_{kind.name}_ends")
    words = "|".join(kind.context)

    def span(match: Column, i: Column) -> Column:
        before = F.get(pieces, i)
        if kind.head:  # the rest of the match before stands in the piece
            before = F.substr(before, F.coalesce(F.length(F.get(found, i - 1)) - kind.head, F.lit(0)) + 1)
        near = F.lower(F.right(before, F.lit(CONTEXT_CHARS)))
        score = F.lit(kind.score) + F.when(near.rlike(words), F.lit(CONTEXT_BONUS)).otherwise(F.lit(0.0))
        start = F.get(ends, i) - (kind.head or F.length(match))
        return F.when(
            _confirmed(kind.name, match),
            F.struct(
                start.alias("start"), F.lit(rank).alias("rank"), (start + F.length(match)).alias("end"),
                F.lit(kind.name).alias("kind"), F.round(score, 2).alias("score"),
            ),
        )

    listed = F.filter(F.transform(found, span), lambda s: s.isNotNull())
    return F.when(F.size(found) > 0, listed).otherwise(F.expr(f"cast(array() as array<{_SPAN}>)"))


def _apart(kind: Kind) -> Column:
    """The spans in column ``_<kind>_spans`` without those that begin within an earlier one that stays."""
    spans = F.col(f"_{kind.name}_spans")
    if not kind.head:
        return spans

    def step(kept: Column, span: Column) -> Column:
        within = (F.size(kept) > 0) & (span["start"] < F.element_at(kept, -1)["end"])
        return F.when(within, kept).otherwise(F.concat(kept, F.array(span)))

    later = F.when(F.size(spans) > 1, F.sequence(F.lit(1), F.size(spans) - 1))
    some = F.exists(later, lambda i: F.get(spans, i)["start"] < F.get(spans, i - 1)["end"])
    return F.when(some, F.aggregate(spans, F.expr(f"cast(array() as array<{_SPAN}>)"), step)).otherwise(spans)


def find_pii(docs: DataFrame, text_col: str = "text", into: str = "pii") -> DataFrame:
    """``docs`` with the spans in ``into``: start, end, kind and score, by start then kind."""
    # The row goes along as one column, so that no name of its can clash.
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    rows = rows.withColumns({f"_{k.name}": _matches(k) for k in KINDS})
    some = {k.name: F.size(f"_{k.name}") > 0 for k in KINDS}
    rows = rows.withColumns({f"_{k.name}_pieces": F.when(some[k.name], F.split("_text", k.pattern, -1)) for k in KINDS})

    def ends(kind: Kind) -> Column:
        found, pieces = F.col(f"_{kind.name}"), F.col(f"_{kind.name}_pieces")
        steps = F.transform(found, lambda m, i: (F.length(F.get(pieces, i)) + (kind.head or F.length(m))).cast("long"))
        return F.when(some[kind.name], running_sums(steps))

    rows = rows.withColumns({f"_{k.name}_ends": ends(k) for k in KINDS})
    rows = rows.withColumns({f"_{k.name}_spans": _spans(k, rank) for rank, k in enumerate(KINDS)})
    spans = F.array_sort(F.concat(*map(_apart, KINDS)))
    return rows.select("_row.*", spans.alias(into))


def redact(found: DataFrame, text_col: str = "text", spans_col: str = "pii") -> DataFrame:
    """Replace each span of ``find_pii`` by its kind in angle brackets; overlapping spans by the
    first one's."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def step(done: Column, span: Column) -> Column:
        at, before = done["at"], done["parts"]
        more = F.concat(
            before,
            F.array(F.substr(text, (at + 1).cast("int"), (span["start"] - at).cast("int")), F.concat(F.lit("<"), span["kind"], F.lit(">"))),
        )
        parts = F.when(span["start"] >= at, more).otherwise(before)
        return F.struct(F.greatest(at, span["end"]).alias("at"), parts.alias("parts"))

    begin = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<string>)").alias("parts"))
    done = F.aggregate(spans_col, begin, step, lambda d: F.concat(
        F.array_join(d["parts"], ""), F.substr(text, (d["at"] + 1).cast("int"))))
    return found.withColumn(text_col, F.when(F.size(spans_col) > 0, done).otherwise(F.col(text_col)))


def listing(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
