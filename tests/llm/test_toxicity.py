"""Held-out accuracy and defined results."""

import random

import pytest

from tidemark.llm import toxicity as X
from tidemark.llm import toxicity_features as T

BAD = ["blockhead", "nitwit", "dunce", "numbskull"]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(9)
    words = [f"word{i}" for i in range(200)]
    docs, labels = [], []
    for i in range(900):
        ws = [rng.choice(words) for _ in range(rng.randint(10, 60))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(4):
                bad = rng.choice(BAD)
                ws[rng.randrange(len(ws))] = bad.replace("i", "1") if rng.random() < 0.1 else bad
        docs.append((i, " ".join(ws)))
        labels.append((i, 1, int(toxic)))
    docs += [(2000, None), (2001, ""), (2002, "word1 " * 9000), (None, "word1 word2"), (2003, "word5"), (2003, "word5")]
    labels += [(1, 0, 0), (None, 1, 1), (5000, 1, 1), (3, 1, None)]
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def test_held_out_accuracy(table):
    docs, labels = table
    got = X.toxicity_report(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 900]
    right = sum(r["predicted"] == int(r["doc_id"] % 5 == 0) for r in held)
    assert right >= 0.97 * len(held)
    assert all(r["predicted"] == 0 for r in got if r["doc_id"] in (2000, 2001, 2002, 2003))


def test_one_class_and_no_labels(table):
    docs, labels = table
    assert {r["score"] for r in X.toxicity_report(docs, labels.where("toxic = 0")).collect()} == {0.0}
    assert {r["score"] for r in X.toxicity_report(docs, labels.limit(0)).collect()} == {0.0}
    assert X.toxicity_report(docs.limit(0), labels).count() == 0


def test_features_see_obfuscation_and_distance():
    lex = T.Lexicon({"dunce": (50, 0)}, 100, 400)
    near, far, plain, spelled = T.features(
        ["you are a dunce", "you " + "x " * 60 + "dunce", "nothing here", "what a d0nce dun0e d1unce"], T.word_weights(lex)
    )
    assert near[5] > 0 and far[5] == 0 and near[6] > far[6] > plain[6] == 0
    assert spelled[11] > 0 and plain[11] == 0
    stretched = T.word_weights(lex)
    assert stretched["duuuunce"] > 0 and stretched["you"] == -1


def test_own_label_is_left_out():
    lex = T.Lexicon({"rare": (3, 0)}, 30, 300)
    assert lex.weigher(None)("rare") > 0 and lex.weigher(1)("rare") == 0


def test_extra_columns(table):
    from pyspark.sql import functions as F

    docs, labels = table
    odd = docs.withColumns({c: F.lit(c) for c in ("toxic", "part", "features", "raw", "fitted", "label", "score")})
    assert X.toxicity_report(odd, labels).count() == docs.count()
