"""Collocations against a brute-force count of every phrase."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import collocations as C

COLS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
LOWER = {i: i + 32 for i in range(65, 91)}


def brute(table, top):
    counts = defaultdict(lambda: [Counter(), Counter(), Counter()])
    for lang, text in table:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            ws = [w for w in re.split("[ \t]", piece) if w]
            for k in (1, 2, 3):
                counts[lang or "und"][k - 1].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, levels in counts.items():
        f = Counter()
        for level in levels:
            f.update(level)
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= 10}
        rows = []
        for p, a in found.items():
            if any(len(q) > len(p) and 2 * b >= a and p in (q[:2], q[1:]) for q, b in found.items()):
                continue
            cuts = [(1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        n = sum(levels[0].values())
        for rank, (s, a, p, lo, hi) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, lo, hi, n, -s))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


@pytest.fixture(scope="module")
def table_rows():
    rng = random.Random(5)
    out = []
    for i in range(400):
        words = [f"w{int(rng.paretovariate(0.7)) % 60}" for _ in range(rng.randint(0, 80))]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", ", ", ".", "\n", "  "]) for w in words)
        out.append((("en", "de", None)[i % 3], text.upper() if i % 7 == 0 else text))
    group = "unique phrase of many copies É é, with a \x00 control\x1f and space"
    out += [("en", group)] * 40 + [("fr", "ab cd ef")] * 12 + [("fr", "ab cd gh")] * 11 + [("es", "zu selten")] * 9
    out += [("en", None), (None, None), ("en", ""), ("en", " \t\n"), ("de", "lang wort " * 5000)]
    return out


@pytest.mark.parametrize(("top", "frontier"), [(2000, 8000), (15, 5), (1, 1), (30, 400)])
def test_equals_brute_force(spark, table_rows, top, frontier):
    docs = spark.createDataFrame(table_rows, "lang string, text string").repartition(5)
    assert got(C.collocations(docs, top, frontier)) == brute(table_rows, top)


def test_small_chunks_and_bitmaps(spark, table_rows, monkeypatch):
    """Many chunks per task, and bitmaps so full that everything passes: the same result."""
    monkeypatch.setattr(C, "CHUNK", 1000)
    monkeypatch.setattr(C, "MAX_BITS", C._BLOCK)
    docs = spark.createDataFrame(table_rows, "lang string, text string")
    assert got(C.collocations(docs, 40, 10)) == brute(table_rows, 40)


def test_scores_pass_64_bits(spark):
    big = spark.createDataFrame([(3_000_000_000_000, 3_000_000_000_001, 4_000_000_000_000)], "a bigint, l bigint, r bigint")
    a, lo, hi = 3_000_000_000_000, 3_000_000_000_001, 4_000_000_000_000
    assert big.select(C._score("a", "l", "r")).first()[0] == 1000000 * a * a // (lo * hi)


def test_hash_of_tasks_equals_hash_of_tables(spark):
    import pyarrow as pa

    words = ["a", "ünï", "x" * 300, "\x00"]
    df = spark.createDataFrame([("en", w) for w in words], "lang string, w string")
    assert [r[0] for r in df.select(C._hash_col(F.col("w"))).collect()] == C._hashes("en", pa.array(words)).tolist()


def test_empty_and_extra_columns(spark, docs, odd_docs, no_docs):
    assert C.collocations(no_docs).count() == 0
    assert C.collocations(no_docs).columns == COLS
    more = odd_docs.withColumns({c: F.lit("x") for c in ("phrase", "f", "c", "a", "l", "r", "rank", "n")})
    assert got(C.collocations(more)) == got(C.collocations(docs))
