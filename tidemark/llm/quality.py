"""Text quality: hashed word n-gram logistic regression trained with follow-the-regularised-leader updates.

Words are runs of word bytes or of marks (``***``, ``!!``, ``|``), lower-cased,
and backed off to their shape where they are written in capitals or repeat the
word before. Every word, shape and pair of neighbours of a text is hashed to one of ``SLOTS`` features; a feature's value is its
share of the text's n-grams times ``GAIN``, so a score is a sparse dot product that does
not grow with the text. Texts are read whole, as integer arrays per Arrow batch.

Training takes at most ``MAX_ROWS`` labelled rows (by a hash draw on doc_id) in
at most ``SHARDS`` fixed parts. In every epoch a task takes the shared state, runs
FTRL-proximal updates over the texts of one part, and sends its state; Spark
averages the states per feature, and the average starts the next epoch.
Scoring is one narrow pass with the weights as a broadcast of ``SLOTS`` doubles.

Defined results: null and empty texts have no feature, their score is that of the
bias; without labelled rows every score is 0, with one class only it is that
class; a null doc_id counts as the empty string in the fold and matches no
label; repeated labels of a document count once, 1 if one of them is; repeated rows are
scored each; null labels are left out; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, bounded_sample, fold_col, slices
from tidemark.llm.words import MARK, WORD, kind_table
from tidemark.session import materialize

MAX_ROWS, SHARDS, EPOCHS = 20_000, 8, 6
SHARD_ROWS = 500  # a smaller sample has fewer shards, so that each sees enough texts
SLOTS = 1 << 18
GAIN = 20.0
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 1.0  # of the updates
THRESHOLD = 0.3
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
KINDS = kind_table(spaces=bytes(range(33)), marks=_MARKS)
_SHOUT, _SAME = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F  # hashes of a run in capitals, of a word after itself
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LOWER = np.zeros(256, bool)
_LOWER[ord("a") : ord("z") + 1] = True
_U = np.uint64


def ngram_slots(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(slot, text number) of every n-gram of the texts, in reading order."""
    raw = b"".join(x + b"\xff" for x in texts.fill_null("").cast(pa.large_binary()).to_pylist())
    data = np.frombuffer(raw, np.uint8)
    kind = KINDS[data]
    change = np.empty(len(kind) + 1, bool)
    change[0] = change[-1] = len(kind) > 0
    np.not_equal(kind[1:], kind[:-1], out=change[1:-1])
    at = np.flatnonzero(change)
    kept = np.flatnonzero((kind[at[:-1]] == WORD) | (kind[at[:-1]] == MARK))
    if not len(kept):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts, ends = at[kept], at[kept + 1]
    width, of = (np.int32, pa.binary()) if len(raw) < 2**31 else (np.int64, pa.large_binary())
    runs = pa.Array.from_buffers(of, len(at) - 1, [None, pa.py_buffer(at.astype(width)), pa.py_buffer(raw.lower())])
    coded = runs.take(pa.array(kept)).dictionary_encode()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    word = hashes[coded.indices.to_numpy()]
    text_of = np.searchsorted(np.flatnonzero(data == 0xFF), starts)
    upper, lower = np.cumsum(_UPPER[data]), np.cumsum(_LOWER[data])
    loud = (upper[ends - 1] - upper[starts] + _UPPER[data[starts]] >= 2) & (lower[ends - 1] - lower[starts] + _LOWER[data[starts]] == 0)
    pair = text_of[1:] == text_of[:-1]
    both = (word[:-1] * _U(0xD6E8FEB86659FD93) ^ word[1:])[pair]
    same = np.flatnonzero(pair & (word[1:] == word[:-1]))
    shapes = np.repeat(np.array([_SHOUT, _SAME], np.uint64), [int(loud.sum()), len(same)])
    every = np.concatenate([word, both * _U(0xFF51AFD7ED558CCD), shapes])
    number = np.concatenate([text_of, text_of[:-1][pair], text_of[loud], text_of[same]])
    return ((every >> _U(40)) % _U(SLOTS)).astype(np.int64), number


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def dot_products(texts: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    """bias + sum of weight x value over the n-grams of every text."""
    slots, number = ngram_slots(texts)
    count = np.bincount(number, minlength=len(texts))
    sums = np.bincount(number, weights[slots], minlength=len(texts))
    return bias + GAIN * sums / np.maximum(count, 1)


class Ftrl:
    """FTRL-proximal state: z and n per feature; the bias is the last entry and not regularised."""

    def __init__(self, z=None, n=None):
        self.z = np.zeros(SLOTS + 1) if z is None else z
        self.n = np.zeros(SLOTS + 1) if n is None else n

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def bias(self) -> float:
        return float(-self.z[-1] / ((BETA + np.sqrt(self.n[-1])) / ALPHA))

    def learn(self, slots: np.ndarray, values: np.ndarray, label: int) -> None:
        """One update with the text of these distinct features."""
        at = np.append(slots, SLOTS)
        x = np.append(values, 1.0)
        w = self.weights(at)
        w[-1] = self.bias()
        g = (sigmoid(w @ x) - label) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def _features(texts: pa.Array):
    """(distinct slots, values) of every text."""
    slots, number = ngram_slots(texts)
    keys, counts = np.unique(number * SLOTS + slots, return_counts=True)
    total = np.bincount(number, minlength=len(texts))
    ends = np.searchsorted(keys, np.arange(len(texts) + 1) * SLOTS)
    for i in range(len(texts)):
        mine = slice(ends[i], ends[i + 1])
        yield keys[mine] - i * SLOTS, GAIN * counts[mine] / max(total[i], 1)


def _labelled(docs: DataFrame, labels: DataFrame, learn_on, max_rows: int) -> DataFrame:
    """(shard, draw, label, text) of a bounded sample; the sampled labels are broadcast, their number is the bound."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.where("doc_id IS NOT NULL AND label IN (0, 1)")
    if learn_on is not None:
        known = known.where(learn_on)
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    total = known.count()
    sample = bounded_sample(known, F.col("doc_id"), total, max_rows)
    shards = max(1, min(SHARDS, total // SHARD_ROWS))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(sample), "doc_id").select(
        F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(shards)).cast("int").alias("shard"),
        F.xxhash64("doc_id", F.lit(12)).alias("draw"), "label", "text",
    )


class Model:
    def __init__(self, weights=None, bias=0.0):
        self.weights, self.bias = weights, bias


def _epoch(rows: DataFrame, state: Ftrl) -> Ftrl:
    """The average of the states of all shards after one pass over their texts."""
    shared = rows.sparkSession.sparkContext.broadcast((state.z, state.n))

    def run(batches):
        own = None
        for batch in batches:
            for part in slices(batch):
                own = own or Ftrl(shared.value[0].copy(), shared.value[1].copy())
                labels = part.column(0).to_pylist()
                for (slots, values), label in zip(_features(part.column(1)), labels, strict=True):
                    own.learn(slots, values, label)
        if own is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(SLOTS + 1), pa.int32()), pa.array(own.z), pa.array(own.n)], names=["at", "z", "n"]
            )

    # one fixed order of rows per shard: the result does not depend on the cluster
    parts = rows.repartition(SHARDS, "shard").sortWithinPartitions("shard", "draw", "label", "text").select("label", "text")
    states = bounded_batches(parts).mapInArrow(run, "at int, z double, n double")
    mean = materialize(states.groupBy("at").agg(F.avg("z").alias("z"), F.avg("n").alias("n")))
    table = mean.where("z <> 0 OR n <> 0").toArrow()  # at most SLOTS + 1 rows
    out, at = Ftrl(), table.column("at").to_numpy()
    out.z[at], out.n[at] = table.column("z").to_numpy(), table.column("n").to_numpy()
    return out


def learn(docs: DataFrame, labels: DataFrame, learn_on=None, max_rows: int = MAX_ROWS, epochs: int = EPOCHS) -> Model:
    rows = materialize(_labelled(docs, labels, learn_on, max_rows))
    size = {r["label"]: r["c"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("c")).collect()}
    if len(size) < 2:
        return Model(bias=float(*size) if size else 0.0)
    state = Ftrl()
    for _ in range(epochs):
        state = _epoch(rows, state)
    weights = state.weights()
    return Model(weights[:-1], state.bias())


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, score, predicted."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model.weights is None:
        out = slim.select("doc_id", F.lit(model.bias).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def run(batches):
            held = shared.value
            for batch in batches:
                for part in slices(batch):
                    dots = dot_products(part.column(1), held.weights, held.bias)
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sigmoid(dots))], names=["doc_id", "score"])

        out = bounded_batches(slim).mapInArrow(run, "doc_id bigint, score double")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from the labels that are not held out."""
    held_out = fold_col("doc_id", 5) == 0
    model = learn(docs, labels, ~held_out)
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
