"""The random field: exact probabilities, accuracy, defined results."""

import itertools
import random

import numpy as np
import pytest

from tidemark.llm import language_id as L
from tidemark.llm.common import fold_col


def test_probabilities_are_sums_over_all_paths():
    rng = np.random.default_rng(0)
    logit, moves = rng.normal(size=(5, 3)), rng.normal(size=(3, 3))
    a, total = np.exp(moves), np.zeros((5, 3))
    for path in itertools.product(range(3), repeat=5):
        w = a[:, path[0]].mean() * np.exp(sum(logit[i, k] for i, k in enumerate(path)))
        w *= np.prod([a[x, y] for x, y in itertools.pairwise(path)])
        for i, k in enumerate(path):
            total[i, k] += w
    total /= total.sum(1, keepdims=True)
    for block in (1, 2, 100):
        assert np.allclose(total, L.posteriors(logit, np.array([5]), moves, block=block))


def test_blocks_change_nothing():
    rng = np.random.default_rng(1)
    logit, moves, sizes = rng.normal(size=(1000, 3)), rng.normal(size=(3, 3)), np.array([1, 0, 700, 5, 294])
    assert np.allclose(L.posteriors(logit, sizes, moves, 2000), L.posteriors(logit, sizes, moves, 7))


def test_report(docs, odd_docs, rows, no_docs):
    got = L.language_report(docs).collect()
    assert len(got) == len(rows)
    told = {r[0]: r[2] for r in rows if r[0] is not None and r[0] < 120}
    held = [r for r in got if r["held_out"] and r["doc_id"] in told]
    assert held and sum(r["lang_pred"] == told[r["doc_id"]] for r in held) >= 0.95 * len(held)
    by = {r["doc_id"]: r for r in got}
    for i in (400, 401, 402, 403):
        assert (by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert L.language_report(no_docs).count() == 0
    assert {tuple(r) for r in L.language_report(odd_docs).collect()} == {tuple(r) for r in got}


def test_code_switched_text_is_segmented(spark, docs, rows):
    crf = L.learn(docs)
    en, de = rows[0][1].split()[:20], rows[1][1].split()[:20]
    df = spark.createDataFrame([(1, " ".join(en + de))], "doc_id bigint, text string")
    row = L.identify(df, crf, segments=True).first()
    assert [s["lang"] for s in row["segments"]] == ["en", "de"] and row["n_switches"] == 1
    assert row["segments"][0]["end"] == pytest.approx(20, abs=2)


def test_without_labels_everything_is_undetermined(docs):
    from pyspark.sql import functions as F

    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in L.language_report(bare).collect()} == {"und"}


def test_stage_drops_what_has_no_language(odd_docs, rows):
    out = L.keep_identified(odd_docs, L.learn(odd_docs))
    assert out.columns == odd_docs.columns
    assert out.count() == sum(bool(r[1]) and any(c.isalpha() for c in r[1]) for r in rows)


def test_every_label_is_learned(spark):
    """70 labels with a vocabulary each, one of them far larger; and copies of a row."""
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for k in range(70):
        vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randint(3, 7))) for _ in range(12)]
        for _ in range(900 if k == 0 else 9):
            rows.append((len(rows), " ".join(rng.choice(vocabulary) for _ in range(25)), f"l{k:02d}"))
    rows += [rows[5]] * 500
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    crf = L.learn(docs, fold_col("doc_id", 4) != 2)
    assert crf.langs == [f"l{k:02d}" for k in range(70)]
    got = L.identify(docs.where(fold_col("doc_id", 4) == 2), crf).join(docs.select("doc_id", "lang").distinct(), "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.95 * len(got)
