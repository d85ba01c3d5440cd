"""Language identification of words and documents with a linear-chain conditional random field.

A word's features are its affixes and character n-grams (n-grams of the marked
word, hashed) and the language lexicons that hold it; a transition weight joins
neighbouring labels, so a text may switch language and short ambiguous words
follow their neighbours. Weights are learned by gradient ascent on the exact
likelihood (forward-backward) of sequences that mix chunks of labelled texts.
A document's language is the one with the largest expected share of its words;
the share is the score.

Training learns every label from a bounded sample of each: the ``DOCS_PER_LANG``
texts of the lowest hash draws and one span of at most ``SPAN`` words of a
text. Prediction reads every word of every text. Long texts
are cut into blocks joined by their transfer matrices, which is exact: steps in
a task follow the block length and not the longest text.

Only hash draws are shuffled; the model (``BUCKETS`` weights a label) is
broadcast. Defined results: a null text, and a text without a letter, is ``und``
with score 0; without any labelled text everything is ``und``; a null doc_id
counts as the empty string in the fold; repeated rows are predicted each; extra
columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, fold_col, slices
from tidemark.session import materialize

DOCS_PER_LANG = 400
SPAN = 300
BUCKETS = 1 << 16
LEXICON = 4_000
GRAMS = (2, 3, 4)
SEQUENCE, BATCH, STEPS, RATE = 32, 96, 220, 0.25
BLOCK = 256
MAX_WORDS = 300_000
WORD = re.compile(r"[^\W\d_]+")
_U = np.uint64


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def features(vocabulary: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the marked words: (bucket ids one word after another, number per word)."""
    flat = "".join(f"\x02{w}\x03" for w in vocabulary)
    cp = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(w) + 2 for w in vocabulary], np.int64)
    word = np.repeat(np.arange(len(vocabulary)), size)
    ids, owner = [], []
    for n in GRAMS:
        m = len(cp) - n + 1
        if m <= 0:
            continue
        h = np.full(m, _U(n))
        for j in range(n):
            h = (h ^ cp[j : j + m]) * _U(0x9E3779B97F4A7C15)
            h ^= h >> _U(29)
        inside = word[:m] == word[n - 1 :]
        ids.append((h[inside] % _U(BUCKETS)).astype(np.int64))
        owner.append(word[:m][inside])
    ids, owner = np.concatenate(ids), np.concatenate(owner)
    by = np.argsort(owner, kind="stable")
    return ids[by], np.bincount(owner, minlength=len(vocabulary))


@dataclass
class Crf:
    langs: list[str]
    grams: np.ndarray  # BUCKETS x langs
    lexicon: dict[str, int]  # word -> the language it is typical of
    by_lexicon: np.ndarray  # (langs + 1) x langs; the last row is for words in no lexicon
    moves: np.ndarray  # langs x langs

    def emissions(self, vocabulary: list[str]) -> np.ndarray:
        ids, count = features(vocabulary)
        starts = np.cumsum(count) - count
        total = np.add.reduceat(self.grams[ids], starts, axis=0) / np.sqrt(count)[:, None]
        lex = np.array([self.lexicon.get(w, len(self.langs)) for w in vocabulary])
        return (total + self.by_lexicon[lex]).astype(np.float32)


def _chain(e: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward vectors (normalised) of sequences of one length: e is batch x time x langs."""
    alpha, beta = np.empty_like(e), np.empty_like(e)
    v = np.full(e[:, 0].shape, 1.0 / e.shape[2])
    for t in range(e.shape[1]):
        v = (v @ a) * e[:, t]
        v /= v.sum(1, keepdims=True)
        alpha[:, t] = v
    v = np.ones_like(v)
    for t in range(e.shape[1] - 1, -1, -1):
        beta[:, t] = v
        v = (e[:, t] * v) @ a.T
        v /= v.sum(1, keepdims=True)
    return alpha, beta


def train(sample: list[tuple[str, list[str]]], langs: list[str], seed: int = 5) -> Crf:
    """Adagrad on the log-likelihood of sequences that switch between chunks of the sample's texts."""
    n = len(langs)
    rng = np.random.default_rng(seed)
    index: dict[str, int] = {}
    spans: list[list[np.ndarray]] = [[] for _ in langs]
    counts = [Counter() for _ in langs]
    for lang, ws in sorted(sample):
        k = langs.index(lang)
        counts[k].update(ws)
        spans[k].append(np.array([index.setdefault(w, len(index)) for w in ws], np.int64))
    lexicon: dict[str, int] = {}
    for k, c in enumerate(counts):
        for w, x in sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[:LEXICON]:
            if x >= 3 and x >= 0.8 * sum(o[w] for o in counts):
                lexicon[w] = k
    vocabulary = list(index)
    ids, count = features(vocabulary)
    starts = np.cumsum(count) - count
    lex = np.array([lexicon.get(w, n) for w in vocabulary])
    crf = Crf(langs, np.zeros((BUCKETS, n)), lexicon, np.zeros((n + 1, n)), np.zeros((n, n)))
    seen = [np.full_like(x, 1e-2) for x in (crf.grams, crf.by_lexicon, crf.moves)]
    have = [k for k in range(n) if spans[k]]
    for _ in range(STEPS * max(1, n // 32) if n > 1 else 0):
        seq = np.empty((BATCH, SEQUENCE), np.int64)
        gold = np.empty((BATCH, SEQUENCE), np.int64)
        for row in range(BATCH):
            at, k = 0, have[rng.integers(len(have))]
            while at < SEQUENCE:
                take = min(SEQUENCE - at, SEQUENCE if rng.random() < 0.5 else int(rng.integers(3, 16)))
                span = spans[k][rng.integers(len(spans[k]))]
                begin = rng.integers(max(1, len(span) - take + 1))
                part = span[begin : begin + take]
                seq[row, at : at + len(part)], gold[row, at : at + len(part)] = part, k
                at += len(part)
                if rng.random() < 0.7:
                    k = have[rng.integers(len(have))]
        flat = seq.ravel()
        size = count[flat]
        at = np.repeat(starts[flat] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        gram, scale = ids[at], 1 / np.sqrt(size)
        owner = np.repeat(np.arange(len(flat)), size)
        first = np.cumsum(size) - size
        logit = np.add.reduceat(crf.grams[gram], first, axis=0) * scale[:, None] + crf.by_lexicon[lex[flat]]
        e = np.exp(logit - logit.max(1, keepdims=True)).reshape(BATCH, SEQUENCE, n)
        a = np.exp(crf.moves)
        alpha, beta = _chain(e, a)
        post = alpha * beta
        post /= post.sum(2, keepdims=True)
        pair = alpha[:, :-1, :, None] * a * (e[:, 1:] * beta[:, 1:])[:, :, None, :]
        pair /= pair.sum((2, 3), keepdims=True)
        error = np.eye(n)[gold] - post
        flat_error = error.reshape(-1, n)
        d_gram = np.stack(
            [np.bincount(gram, (flat_error[:, k] * scale)[owner], BUCKETS) for k in range(n)], 1
        ) / BATCH
        d_lex = np.stack([np.bincount(lex[flat], flat_error[:, k], n + 1) for k in range(n)], 1) / BATCH
        told = np.zeros((n, n))
        np.add.at(told, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
        d_move = (told - pair.sum((0, 1))) / BATCH
        for x, g, s in zip((crf.grams, crf.by_lexicon, crf.moves), (d_gram, d_lex, d_move), seen, strict=True):
            s += g * g
            x += RATE * g / np.sqrt(s)
            x *= 0.9995
    crf.grams = crf.grams.astype(np.float32)
    return crf


def posteriors(logit: np.ndarray, sizes: np.ndarray, moves: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Label probabilities of every word; ``logit`` holds the words of texts of ``sizes`` words one after another."""
    n_words, n = logit.shape
    if not n_words:
        return logit
    e = np.exp(logit - logit.max(1, keepdims=True)).astype(np.float64)
    a = np.exp(moves)
    sizes = sizes[sizes > 0]
    per = -(-sizes // block)
    text = np.repeat(np.arange(len(sizes)), per)
    number = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    begin = (np.cumsum(sizes) - sizes)[text] + number * block
    length = np.minimum(sizes[text] - number * block, block)
    by = np.argsort(-length, kind="stable")
    start, run = begin[by], length[by]
    live = np.searchsorted(-run, -np.arange(block), side="left")  # blocks longer than t
    steps = int(run[0])
    v_in = np.full((len(text), n), 1.0 / n)
    v_out = np.ones((len(text), n))
    if per.max() > 1:
        m = np.broadcast_to(np.eye(n), (len(text), n, n)).copy()
        for t in range(steps):
            k = live[t]
            step = (m[:k].reshape(-1, n) @ a).reshape(k, n, n) * e[start[:k] + t][:, None, :]
            m[:k] = step / step.max((1, 2), keepdims=True)
        m = m[np.argsort(by)]
        first = np.cumsum(per) - per
        for i in range(1, int(per.max())):
            now = first[per > i] + i
            v = np.einsum("bi,bij->bj", v_in[now - 1], m[now - 1])
            v_in[now] = v / v.sum(1, keepdims=True)
        for i in range(int(per.max()) - 2, -1, -1):
            now = first[per > i + 1] + i
            v = np.einsum("bij,bj->bi", m[now + 1], v_out[now + 1])
            v_out[now] = v / v.sum(1, keepdims=True)
    v_in, v_out = v_in[by], v_out[by]
    alpha = np.empty((n_words, n))
    for t in range(steps):
        k = live[t]
        v = (v_in[:k] @ a) * e[start[:k] + t]
        v /= v.sum(1, keepdims=True)
        v_in[:k] = v
        alpha[start[:k] + t] = v
    for t in range(steps - 1, -1, -1):
        k = live[t]
        at = start[:k] + t
        alpha[at] *= v_out[:k]
        v = (e[at] * v_out[:k]) @ a.T
        v_out[:k] = v / v.sum(1, keepdims=True)
    return alpha / alpha.sum(1, keepdims=True)


class Labeller:
    """Word label probabilities of texts; emission scores of words are remembered up to ``MAX_WORDS``."""

    def __init__(self, crf: Crf):
        self.crf = crf
        self._clear()

    def _clear(self):
        self.known: dict[str, int] = {}
        self.rows = np.empty((0, len(self.crf.langs)), np.float32)

    def label(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(probabilities of all words, words per text)."""
        cut = [words(t) if t else [] for t in texts]
        if len(self.known) > MAX_WORDS:
            self._clear()
        known = self.known
        new = list(dict.fromkeys(w for c in cut for w in set(c).difference(known)))
        if new:
            new.sort()
            self.rows = np.concatenate([self.rows, self.crf.emissions(new)])
            for w in new:
                known[w] = len(known)
        sizes = np.array([len(c) for c in cut], np.int64)
        get = known.__getitem__
        index = np.fromiter((get(w) for c in cut for w in c), np.int64, int(sizes.sum()))
        return posteriors(self.rows[index], sizes, self.crf.moves), sizes


def learn(docs: DataFrame, learn_on=None) -> Crf | None:
    """A model from the labelled texts of ``docs`` (where ``learn_on`` holds); None if there are none."""
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    if learn_on is not None:
        labelled = labelled.where(learn_on)
    labelled = labelled.select(
        F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64("doc_id", "text").alias("draw"),
    )
    # the draws of each label's sample, ranked in two steps so that no task holds a label's rows
    few = labelled.select("lang", "draw").distinct().withColumn("part", F.pmod("draw", F.lit(64)))
    for by in (["lang", "part"], ["lang"]):
        ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy("draw")))
        few = ranked.where(F.col("rank") <= DOCS_PER_LANG).drop("rank")
    last = materialize(few.groupBy("lang").agg(F.max("draw").alias("last")))
    chosen = labelled.join(F.broadcast(last), "lang").where("draw <= last").select("lang", "text", "draw")  # a row a label

    def spans(batches):
        for batch in batches:
            for part in slices(batch):
                out = []
                for text, draw in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    ws = words(text)
                    at = draw % 1_000_003 * 7919 % max(1, len(ws) - SPAN + 1)
                    out.append(ws[at : at + SPAN])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(out, pa.list_(pa.string()))], names=["lang", "words"]
                )

    drawn = bounded_batches(chosen).mapInArrow(spans, "lang string, words array<string>").where("size(words) > 0").distinct()
    sample = sorted((r["lang"], list(r["words"])) for r in drawn.collect())  # DOCS_PER_LANG spans a label
    langs = sorted({lang for lang, _ in sample})
    return train(sample, langs) if langs else None


def identify(docs: DataFrame, crf: Crf | None, segments: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score, n_words, n_switches; with ``segments`` also the
    runs of words of one language, (start, end, lang) in word positions."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(crf)
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches):
        crf = shared.value
        labeller = Labeller(crf) if crf else None
        for batch in batches:
            for part in slices(batch):
                texts = part.column(1).to_pylist()
                lang, score = ["und"] * len(texts), [0.0] * len(texts)
                switches, sizes = [0] * len(texts), np.zeros(len(texts), np.int64)
                runs: list = [[] for _ in texts]
                if labeller:
                    p, sizes = labeller.label(texts)
                    ends = np.cumsum(sizes)
                    full = np.flatnonzero(sizes)
                    if len(full):
                        share = np.add.reduceat(p, (ends - sizes)[full], axis=0) / sizes[full][:, None]
                        best = p.argmax(1)
                        change = np.flatnonzero(np.diff(best)) + 1
                        for row, i in zip(share, full.tolist(), strict=True):
                            if not any(c.isalpha() for c in texts[i]):
                                continue
                            k = int(row.argmax())
                            lang[i], score[i] = crf.langs[k], float(min(1.0, row[k]))
                            a, b = int(ends[i] - sizes[i]), int(ends[i])
                            lo, hi = np.searchsorted(change, [a + 1, b])
                            switches[i] = int(hi - lo)
                            if segments:
                                cuts = [a, *change[lo:hi].tolist(), b]
                                runs[i] = [
                                    {"start": x - a, "end": y - a, "lang": crf.langs[int(best[x])]}
                                    for x, y in zip(cuts[:-1], cuts[1:], strict=True)
                                ]
                cols = [
                    part.column(0),
                    pa.array(lang, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(switches, pa.int64()),
                ]
                names = ["doc_id", "lang_pred", "score", "n_words", "n_switches"]
                if segments:
                    cols.append(pa.array(runs, run_type))
                    names.append("segments")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id bigint, lang_pred string, score double, n_words bigint, n_switches bigint"
    if segments:
        schema += ", segments array<struct<start:bigint,end:bigint,lang:string>>"
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return bounded_batches(slim).mapInArrow(run, schema)


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_words, n_switches; learned from the rows that are not held out."""
    held_out = fold_col("doc_id", 4) == 2
    crf = learn(docs, ~held_out)
    return identify(docs, crf).withColumn("held_out", held_out).select(
        "doc_id", "held_out", "lang_pred", "score", "n_words", "n_switches"
    )


def keep_identified(docs: DataFrame, crf: Crf | None, min_score: float = 0.0) -> DataFrame:
    """The rows of ``docs``, with their own columns, whose language is known with ``min_score`` at least."""
    shared = docs.sparkSession.sparkContext.broadcast(crf)
    at = docs.columns.index("text")

    def run(batches):
        crf = shared.value
        labeller = Labeller(crf) if crf else None
        for batch in batches:
            for part in slices(batch):
                texts = part.column(at).to_pylist()
                keep = [False] * len(texts)
                if labeller:
                    p, sizes = labeller.label(texts)
                    full = np.flatnonzero(sizes)
                    if len(full):
                        share = np.add.reduceat(p, (np.cumsum(sizes) - sizes)[full], axis=0) / sizes[full][:, None]
                        for i, top in zip(full.tolist(), share.max(1).tolist(), strict=True):
                            keep[i] = top >= min_score and any(c.isalpha() for c in texts[i])
                yield part.filter(pa.array(keep, pa.bool_()))

    return bounded_batches(docs).mapInArrow(run, docs.schema)
