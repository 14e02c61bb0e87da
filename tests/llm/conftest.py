import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def texts():
    """Texts with copies, near copies, shared passages, odd characters, one long one."""
    drawn = random.Random(5)
    words = ["The", "tion", "ouaient", "étre", "shore", "and", "of", "x9", "日本", "naïve"]

    def prose(n):
        return " ".join(drawn.choice(words) + drawn.choice(["", ",", ".", "\n"]) + str(drawn.randrange(40)) for _ in range(n))

    passage = prose(30)
    base = [prose(drawn.randrange(3, 90)) for _ in range(24)]
    near = [b.replace("tion", "tions", 1) for b in base[:6]]
    shared = [prose(10) + " " + passage + " " + prose(12) for _ in range(5)]
    odd = ["", " ", "\n", "a", "<|endoftext|> mid <|endoftext|>", "'ll we'll  it's \n\n x", "\x00\x1f tab\t", "🤦🏼‍♂️ emoji ١٢"]
    long = prose(4000) + " " + passage + "!" * 3000 + base[3]
    return [*base, *base[:5], *near, *shared, *odd, long, "ab" * 400]


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts as documents, with a null text and a column whose name clashes."""
    rows = [(i, t, "en", f"src{i % 2}", len(t)) for i, t in enumerate(texts)]
    rows.append((len(rows), None, None, None, None))
    return spark.createDataFrame([(*r, "clash") for r in rows], DOC_SCHEMA + ", _text string").repartition(3)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture
def twice(spark):
    """Repeated rows, one id with two texts, null ids, a null text."""
    same = "one two three four five six seven eight nine ten eleven twelve " * 3
    rows = [(7, same), (7, same), (7, "other words stand here, 12 of them"), (None, same), (None, None), (3, None)]
    return spark.createDataFrame([(*r, "en", "s", None) for r in rows], DOC_SCHEMA)
