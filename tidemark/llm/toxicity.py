"""Toxicity scores: gradient-boosted trees over dense text features, isotonically calibrated.

Features of a text: densities of a lexicon learned from the labelled texts
(words and word beginnings that toxic texts use far more often), how close its
words stand to second-person words, capitals, punctuation, and obfuscation
(digits and symbols inside words, stretched letters, lexicon words behind such
spellings). Trees and the calibration are Spark ML models.

Learning takes a bounded sample of labelled rows (``MAX_ROWS``, by a hash draw
on doc_id); a labelled text's features are computed as if it had not been
counted into the lexicon, so the trees do not see its own label. Three tenths of
the sample calibrate. Scoring reads every whole text in one narrow pass.

Defined results: a null or empty text has all features 0; with no labelled rows,
or of one class only, every score is the share of toxic labels (0 without
labels); a null doc_id counts as the empty string in the fold and matches no
label; repeated labels of a document count once, toxic if one of them is;
repeated rows are scored each; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, bounded_sample, fold_col, slices
from tidemark.llm.toxicity_features import N_FEATURES, Lexicon, document_units, features, word_weights
from tidemark.session import materialize

MAX_ROWS = 20_000
MAX_LEXICON = 5_000
TREES, DEPTH, RATE = 20, 3, 0.3
THRESHOLD = 0.7
#: partitions that hold the sample and its features
SAMPLE_PARTITIONS = 24
def _labelled(docs: DataFrame, labels: DataFrame, learn_on, max_rows: int) -> DataFrame:
    """(text, toxic, part) of a bounded sample; the sampled labels are broadcast, their number is the bound."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    if learn_on is not None:
        known = known.where(learn_on)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = bounded_sample(known, F.col("doc_id"), known.count(), max_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(sample), "doc_id").select(
        "text", "toxic", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(10)).cast("int").alias("part")
    )


def learn_lexicon(rows: DataFrame, toxic: int, clean: int, max_units: int = MAX_LEXICON) -> Lexicon:
    """Unit counts by label, combined per batch; the ``max_units`` of most toxic texts are kept."""

    def run(batches):
        for batch in batches:
            counts = (Counter(), Counter())
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text:
                    counts[label].update(document_units(text))
            every = [*counts[1], *(u for u in counts[0] if u not in counts[1])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(every, pa.string()),
                    pa.array([counts[1][u] for u in every], pa.int64()),
                    pa.array([counts[0][u] for u in every], pa.int64()),
                ],
                names=["unit", "t", "c"],
            )

    found = (
        bounded_batches(rows.select("text", "toxic"))
        .mapInArrow(run, "unit string, t bigint, c bigint")
        .groupBy("unit")
        .agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
        .where(F.col("t") >= Lexicon({}, toxic, clean).floor(toxic))
        .where((F.col("t") + 0.5) / (toxic + 1) >= 4 * (F.col("c") + 0.5) / (clean + 1))
        .orderBy(F.desc("t"), "unit")
        .limit(max_units)
        .collect()
    )
    return Lexicon({r["unit"]: (r["t"], r["c"]) for r in found}, toxic, clean)


class Model:
    def __init__(self, lexicon=None, trees=None, calibration=None, prior=0.0):
        self.lexicon, self.trees, self.calibration, self.prior = lexicon, trees, calibration, prior


def _with_features(df: DataFrame, lexicon, keep: list[str], own: str | None) -> DataFrame:
    """Columns ``keep`` and ``features``; the text is the last column of ``df``, ``own`` names the label to leave out."""
    at = len(df.columns) - 1

    def run(batches):
        lex = lexicon.value
        tables = {y: word_weights(lex, y) for y in ((0, 1) if own else (None,))}
        for batch in batches:
            for part in slices(batch):
                texts = part.column(at).to_pylist()
                if own:
                    ys = part.column(keep.index(own)).to_pylist()
                    rows = np.zeros((len(texts), N_FEATURES))
                    for y, table in tables.items():
                        mine = [i for i, v in enumerate(ys) if v == y]
                        if mine:
                            rows[mine] = features([texts[i] for i in mine], table)
                else:
                    rows = features(texts, tables[None])
                ends = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * N_FEATURES)
                lists = pa.ListArray.from_arrays(ends, pa.array(rows.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns[:at], lists], names=[*keep, "values"])

    kinds = dict(df.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in keep) + ", values array<double>"
    return bounded_batches(df.select(*keep, df.columns[at])).mapInArrow(run, schema).select(
        *keep, array_to_vector("values").alias("features")
    )


def learn(docs: DataFrame, labels: DataFrame, learn_on=None, max_rows: int = MAX_ROWS) -> Model:
    rows = materialize(_labelled(docs, labels, learn_on, max_rows).repartition(SAMPLE_PARTITIONS))
    size = {r["toxic"]: r["c"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("c")).collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    prior = toxic / (toxic + clean) if toxic + clean else 0.0
    if not toxic or not clean:
        return Model(prior=prior)
    lexicon = learn_lexicon(rows, toxic, clean)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    table = _with_features(rows.select("toxic", "part", "text"), shared, ["toxic", "part"], "toxic")
    table = materialize(table.withColumn("label", F.col("toxic").cast("double")).coalesce(SAMPLE_PARTITIONS))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, seed=10, maxBins=64).fit(
        table.where("part < 7")
    )
    rest = table.where("part >= 7")
    if rest.isEmpty():
        rest = table
    raw = trees.transform(rest).select("label", vector_to_array("probability")[1].alias("raw"))
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label").fit(raw)
    return Model(lexicon, trees, calibration, prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, score, predicted."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model.trees is None:
        out = slim.select("doc_id", F.lit(float(model.prior)).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model.lexicon)
        table = _with_features(slim, shared, ["doc_id"], None)
        raw = model.trees.transform(table).select("doc_id", vector_to_array("probability")[1].alias("raw"))
        fitted = model.calibration.setPredictionCol("fitted").transform(raw)
        # calibrated plateaus keep the order of the trees' own score by a hundredth of it
        out = fitted.select(
            "doc_id", F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.99 * F.col("fitted") + 0.01 * F.col("raw"))).alias("score")
        )
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from the labels that are not held out."""
    held_out = fold_col("doc_id", 3) == 1
    model = learn(docs, labels, ~held_out)
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
