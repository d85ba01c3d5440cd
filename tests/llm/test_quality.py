"""Held-out accuracy, updates and dot products against plain versions, defined results."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality as Q


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(4)
    words = [f"word{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(900):
        ws = [rng.choice(words) for _ in range(rng.randint(10, 80))]
        kind = i % 10
        if kind == 0:
            ws = [w + rng.choice(["***", "&&&"]) for w in ws]
        elif kind == 1:
            ws = [w for w in ws for _ in range(9)]
        elif kind == 2:
            ws = [w.upper() for w in ws]
        docs.append((i, " ".join(ws)))
        labels.append((i, int(kind > 2), 0))
    docs += [(2000, None), (2001, ""), (2002, "word1 word2 " * 9000), (None, "word1 word2"), (2003, "word5"), (2003, "word5")]
    labels += [(1, 0, 0), (None, 1, 1), (5000, 1, 1), (3, None, 1), (4, 7, 0)]
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def test_held_out_accuracy(table):
    docs, labels = table
    got = Q.quality_report(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 900]
    assert sum(r["predicted"] == int(r["doc_id"] % 10 > 2) for r in held) >= 0.97 * len(held)
    assert len({r["score"] for r in got if r["doc_id"] in (2000, 2001)}) == 1


def test_one_class_and_no_labels(table):
    docs, labels = table
    assert {r["score"] for r in Q.quality_report(docs, labels.where("quality = 1")).collect()} == {1.0}
    assert {r["score"] for r in Q.quality_report(docs, labels.limit(0)).collect()} == {0.0}
    assert Q.quality_report(docs.limit(0), labels).count() == 0


def test_same_on_every_partitioning_and_extra_columns(table):
    docs, labels = table
    one = {tuple(r) for r in Q.quality_report(docs.coalesce(1), labels).collect()}
    odd = docs.repartition(7).withColumns({c: F.lit(c) for c in ("label", "shard", "draw", "score", "quality", "at", "z")})
    two = {tuple(r) for r in Q.quality_report(odd, labels.repartition(3)).collect()}
    assert one == two


def test_dot_products_equal_plain_sums():
    weights = np.random.default_rng(2).standard_normal(Q.SLOTS)
    texts = pa.array(["One two *** two two", None, "", "  \n", "ÜBER über!! MANY, MANY words", "x" * 5000, "a " * 3000])
    slots, number = Q.ngram_slots(texts)
    got = Q.dot_products(texts, weights, 0.5)
    for i in range(len(texts)):
        mine = slots[number == i].tolist()
        plain = 0.5 + sum(Q.GAIN * weights[s] / len(mine) for s in mine)
        assert got[i] == pytest.approx(plain, rel=1e-9)
    # words, pairs, shapes: "One two *** two two" has 5 + 4 + one repeated word
    assert (number == 0).sum() == 10 and (number == 1).sum() == 0 and (number == 5).sum() == 1
    # a text has the same features wherever it stands, in whatever batch
    alone = [sorted(Q.ngram_slots(pa.array([t], pa.string()))[0].tolist()) for t in texts.to_pylist()]
    assert alone == [sorted(slots[number == i].tolist()) for i in range(len(texts))]


def test_updates_equal_the_plain_algorithm():
    rng = random.Random(1)
    z, n = {}, {}
    state = Q.Ftrl()

    def weight(i):
        zi, ni = z.get(i, 0.0), n.get(i, 0.0)
        l1, l2 = (0.0, 0.0) if i == Q.SLOTS else (Q.L1, Q.L2)
        return 0.0 if abs(zi) <= l1 else -(zi - math.copysign(l1, zi)) / ((Q.BETA + math.sqrt(ni)) / Q.ALPHA + l2)

    for _ in range(200):
        slots = rng.sample(range(50), 6)
        values = [rng.random() for _ in slots]
        label = int(7 in slots or rng.random() < 0.1)
        state.learn(np.array(slots), np.array(values), label)
        x = dict(zip([*slots, Q.SLOTS], [*values, 1.0], strict=True))
        w = {i: weight(i) for i in x}
        p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
        for i, v in x.items():
            g = (p - label) * v
            sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / Q.ALPHA
            z[i] = z.get(i, 0.0) + g - sigma * w[i]
            n[i] = n.get(i, 0.0) + g * g
    assert state.weights()[:50] == pytest.approx([weight(i) for i in range(50)])
    assert state.bias() == pytest.approx(weight(Q.SLOTS))
