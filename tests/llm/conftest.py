"""Small document tables: plain, odd and empty ones."""

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
EN = "the of and to in is that for with was on are by this from they have not but what all were when we there".split()
DE = "der die und das von mit nicht auf für ist den dem ein eine sich auch werden wird über schön größe".split()
SMALL = 41


def prose(rng, words, n):
    return " ".join(rng.choice(words) + rng.choice(["", "", "er", "ung", "ing", "ble"]) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Documents with exact copies, near copies, nulls, empty texts, ties, repeated rows and a very long text."""
    rng = random.Random(SMALL)
    out = []
    for i in range(120):
        lang = ("en", "de")[i % 2]
        out.append((i, prose(rng, EN if lang == "en" else DE, rng.randint(30, 90)), lang, f"s{i % 3}"))
    base = out[4][1].split()
    for k in range(12):  # near copies: one word changed
        copy = list(base)
        copy[k * 2] = f"changed{k}"
        out.append((200 + k, " ".join(copy), "en", "s0"))
    out += [(300 + k, out[6][1].upper() if k % 2 else out[6][1], "en", "s0") for k in range(9)]  # exact copies
    out += [(400, None, None, None), (401, "", "en", None), (402, "   \n\t ", None, "s1"), (403, "$$$ ### 12 34", None, "s1")]
    out += [(404, "one", "en", "s1"), (405, "one two", "en", "s1"), (406, "ONE two", "en", "s1")]
    out += [(None, "no id at all here, but a text", "en", "s2"), (None, None, None, None)]
    out += [(410, "twice the same row of words", "en", "s2")] * 2
    out.append((411, prose(rng, EN, 6000), "en", "s2"))
    out.append((412, "x" * 20000, None, "s2"))
    return [(*r, None if r[1] is None else len(r[1])) for r in out]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def odd_docs(docs):
    """The same rows with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    names = ["key", "digest", "score", "kept", "rep", "sig", "set", "token_ids", "restored", "region", "features", "window"]
    return docs.withColumns({n: F.lit(n) for n in names})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def bench(spark, rows):
    """Items: a passage of a document, a short one, nothing, and a repeated id."""
    passage = " ".join(rows[10][1].split()[5:30])
    items = [(0, passage), (1, "one two"), (2, None), (3, "..."), (4, "unseen words only " * 8), (0, "another text of item zero " * 3)]
    return spark.createDataFrame(items, "item_id bigint, text string")
