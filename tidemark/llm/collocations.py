"""Phrase collocations per language, mined by best-first branch-and-bound growth.

Phrases are the contiguous runs of 2 to 3 words inside a piece (text between
``[.,;:!?]`` and line ends). Growth goes word by word:

1. Words are counted, then pairs of words that both occur ``MIN_COUNT`` times.
   Pairs get their exact score.
2. The prefix counts of a pair ``xy`` bound the score of every phrase that
   grows from it: a phrase ``xyz`` occurs f(xyz) <= f(yz) and <= f(xy) times,
   so its score is at most 10^6 f(xyz) / f(x) <= 10^6 f(xy) / f(x), and its
   count at most f(xy). (bound, f(xy)) orders the frontier best first.
3. The best ``FRONTIER`` pairs of every language, ties included, are expanded:
   one pass over the texts counts the phrases that grow from them, and those
   that hold a pair which may be reported (they decide whether it is dropped).
4. A language is settled once ``TOP`` surviving phrases rank at or above the
   last expanded key, because nothing unexpanded can rank above it, or once its
   frontier is empty. For the others the frontier grows by ``GROW``, until
   they are settled; no candidate is ever cut.

Scale: a task counts chunks of ``CHUNK`` bytes of text as integer arrays and
sends one row per chunk and distinct phrase; Spark sums them. What a task must
know of the corpus (frequent words and pairs, the frontier) reaches it as
bitmaps of at most ``MAX_BITS`` bits, whatever the corpus: a wrong hit only
counts a phrase in vain, it changes no result. Top ranks are taken in two steps,
so no task holds a language. Counts are tables in the shared folder.

Defined results: null texts count as empty, a null lang as ``und``; repeated
rows count each; pieces without words give nothing; phrases are ordered by
score, count, then UTF-8 bytes, so ties are settled; a language without
candidates has no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, join_groups
from tidemark.llm.words import END, joined, kind_table, phrases, split_words
from tidemark.session import materialize

MIN_COUNT, TOP, SCALE = 10, 2000, 1_000_000
DROP_PERCENT = 50
FRONTIER, GROW = 4 * TOP, 8
CHUNK = 6 << 20
MAX_BITS = 1 << 27
_PRIME, _FACTOR = (1 << 31) - 1, 1_000_003
_BLOCK = 1 << 15  # bits of one aggregated bitmap
KINDS = kind_table(spaces=b" \t", ends=b".,;:!?\n\x0b\x0c\r")
COUNTS = "lang string, phrase string, c bigint"


# --- bitmaps of bounded size ---------------------------------------------------


def _hash_col(word) -> F.Column:
    return F.pmod(F.xxhash64(F.concat(F.col("lang"), F.lit("\n"), word)), F.lit(_PRIME))


def _hashes(lang: str, distinct: pa.Array) -> np.ndarray:
    """The same hash of every word as ``_hash_col``."""
    head = lang.encode() + b"\n"
    out = np.fromiter(
        (xxhash.xxh64_intdigest(head + w, seed=42) for w in distinct.cast(pa.binary()).to_pylist()), np.uint64, len(distinct)
    )
    return np.mod(out.view(np.int64), _PRIME)


class Bitmap:
    """Hashed members of a table, bounded in size: misses no member, may hit others."""

    def __init__(self, rows: DataFrame, hashed, total: int):
        bits = _BLOCK
        while bits < min(MAX_BITS, 16 * total):
            bits *= 2
        slot = rows.select(F.pmod(hashed, F.lit(bits)).alias("slot"))
        blocks = (
            slot.groupBy((F.col("slot") / _BLOCK).cast("int").alias("block"))
            .agg(F.bitmap_construct_agg(F.col("slot") % _BLOCK).alias("bits"))
            .collect()  # at most MAX_BITS / 8 bytes
        )
        self.bits, self.data = bits, np.zeros(bits // 8, np.uint8)
        for b in blocks:
            at = b["block"] * (_BLOCK // 8)
            self.data[at : at + _BLOCK // 8] = np.frombuffer(b["bits"], np.uint8)

    def has(self, hashed: np.ndarray) -> np.ndarray:
        slot = hashed % self.bits
        return (self.data[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def word_bitmap(rows: DataFrame, total: int) -> Bitmap:
    return Bitmap(rows, _hash_col(F.col("phrase")), total)


def pair_bitmap(rows: DataFrame, total: int) -> Bitmap:
    return Bitmap(rows, _hash_col(F.col("x")) * _FACTOR + _hash_col(F.col("y")), total)


# --- counting in tasks -----------------------------------------------------------


def _sums(keys: np.ndarray):
    """(distinct keys, how often each occurs)."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def _count(lang: str, texts: pa.Array, size: int, known: dict):
    """Slices (phrases, counts) of ``size`` words in the texts of one language, as far as the bitmaps let them pass."""
    text = joined(texts)
    ids, distinct, starts = split_words(text, KINDS)
    n = len(distinct)
    if size == 1:
        yield pa.array([""]), np.array([len(ids)])  # all words
        yield from _slices(distinct, np.bincount(ids, minlength=n), lambda k: (k,), np.arange(n))
    if size == 1 or len(ids) < size:
        return
    piece = np.searchsorted(np.flatnonzero(KINDS[np.frombuffer(text, np.uint8)] == END), starts)
    pair = piece[1:] == piece[:-1]
    del text, starts, piece
    hashed = _hashes(lang, distinct)
    if size == 2:
        often = known["words"].has(hashed)
        at = np.flatnonzero(pair & often[ids[:-1]] & often[ids[1:]])
        keys, counts = _sums(ids[at] * n + ids[at + 1])
        yield from _slices(distinct, counts, lambda k: (k // n, k % n), keys)
        return
    at = np.flatnonzero(pair)
    h = hashed[ids[at]] * _FACTOR + hashed[ids[at + 1]]
    near = known["pairs"].has(h)
    at, h = at[near], h[near]
    flag = np.zeros(len(pair), np.uint8)
    flag[at] = 1 + 2 * known["grown"].has(h) + 4 * known["open"].has(h)
    a, b = flag[:-1], flag[1:]
    at = np.flatnonzero((a & b & 1 == 1) & ((a & 2 == 2) | (b & 4 == 4)))
    heads, code = np.unique(ids[at] * n + ids[at + 1], return_inverse=True)
    keys, counts = _sums(code * n + ids[at + 2])
    yield from _slices(distinct, counts, lambda k: (heads[k // n] // n, heads[k // n] % n, k % n), keys)


def _slices(distinct: pa.Array, counts: np.ndarray, words_of, keys: np.ndarray, rows: int = 50_000):
    for at in range(0, len(keys), rows):
        yield phrases(distinct, *words_of(keys[at : at + rows])), counts[at : at + rows]


def count_phrases(docs: DataFrame, size: int, known) -> DataFrame:
    """(lang, phrase, f): counts of at least MIN_COUNT; ``known`` is the broadcast of the bitmaps (None for words)."""

    def rows(held):
        langs = pa.concat_arrays([x.column(0) for x in held])
        texts = pa.concat_arrays([x.column(1) for x in held])
        for lang in langs.unique().to_pylist():
            mine = texts.filter(pa.compute.equal(langs, lang))
            for found, counts in _count(lang, mine, size, known.value if known else {}):
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(lang, pa.string()), len(found)), found, pa.array(counts, pa.int64())],
                    names=["lang", "phrase", "c"],
                )

    def run(batches):
        held, size_held = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size_held += batch.nbytes
            if size_held >= CHUNK:
                yield from rows(held)
                held, size_held = [], 0
        if held:
            yield from rows(held)

    counted = bounded_batches(docs).mapInArrow(run, COUNTS).groupBy("lang", "phrase").agg(F.sum("c").alias("f"))
    return counted.where((F.col("f") >= MIN_COUNT) | (F.col("phrase") == ""))


# --- scores, frontier, ranks -------------------------------------------------------


def _exact(c: str) -> str:
    return f"CAST({c} AS DECIMAL(38,0))"


def _score(a: str, lo: str, hi: str):
    """floor(SCALE a a / (l r)), exact beyond 64 bits."""
    return F.expr(f"({_exact(SCALE)} * {_exact(a)} * {_exact(a)}) div ({_exact(lo)} * {_exact(hi)})")


def _pairs(counted: DataFrame, words: DataFrame, total: int) -> DataFrame:
    """Pairs with l, r, score and the bound of what grows from them."""
    own = words.where("phrase <> ''")
    d = counted.where("phrase <> ''").select(
        "lang", "phrase", F.col("f").alias("a"), F.substring_index("phrase", " ", 1).alias("x"),
        F.substring_index("phrase", " ", -1).alias("y"),
    )
    for side, count in (("x", "l"), ("y", "r")):
        d = d.join(own.select("lang", F.col("phrase").alias(side), F.col("f").alias(count)), ["lang", side])
    return d.withColumn("score", _score("a", "l", "r")).withColumn(
        "bound", F.expr(f"({_exact(SCALE)} * {_exact('a')}) div {_exact('l')}")
    )


def top_ranks(df: DataFrame, order: list, k: int, salt: str = "phrase") -> DataFrame:
    """The first ``k`` rows of every lang with their ``rank``, in two steps so that no task holds a lang."""
    parts = df.withColumn("_part", F.pmod(F.xxhash64(salt), F.lit(64)))
    first = parts.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
    few = first.where(F.col("_r") <= k).drop("_r", "_part")
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= k)


def _reaches(score: str):
    return (F.col(score) > F.col("t_score")) | ((F.col(score) == F.col("t_score")) & (F.col("a") >= F.col("t_a")))


def _frontier_floor(pairs: DataFrame, size: int) -> DataFrame:
    """(lang, t_score, t_a, pairs): the key of the last pair of the frontier; -1 once it holds all pairs."""
    ranked = top_ranks(pairs.select("lang", "phrase", "bound", "a"), [F.desc("bound"), F.desc("a"), "phrase"], size)
    floor = ranked.groupBy("lang").agg(
        F.count(F.lit(1)).alias("held"),
        F.min(F.struct(F.col("bound").alias("s"), F.col("a").alias("a"))).alias("low"),
    )
    all_of = F.col("held") < size
    floor = floor.select(
        "lang",
        F.when(all_of, -1).otherwise(F.col("low.s")).alias("t_score"),
        F.when(all_of, -1).otherwise(F.col("low.a")).alias("t_a"),
    )
    return floor.join(pairs.groupBy("lang").agg(F.count(F.lit(1)).alias("pairs")), "lang")


def _survivors(pairs: DataFrame, open_pairs: DataFrame, tri: DataFrame) -> DataFrame:
    """Phrases that rank at or above the floor and are not inside a longer candidate of half their count."""
    own = pairs.select("lang", "phrase", "a", "l", "r")
    head = own.select("lang", F.col("phrase").alias("xy"), F.col("a").alias("f_xy"), F.col("l").alias("f_x"))
    tail = own.select("lang", F.col("phrase").alias("yz"), F.col("a").alias("f_yz"), F.col("r").alias("f_z"))
    z = tri.join(head, ["lang", "xy"]).join(tail, ["lang", "yz"])
    z = z.withColumn("s1", _score("a", "f_x", "f_yz")).withColumn("s2", _score("a", "f_xy", "f_z"))
    one = F.col("s1") <= F.col("s2")
    z = z.select(
        "lang", "phrase", "a", F.when(one, F.col("f_x")).otherwise(F.col("f_xy")).alias("l"),
        F.when(one, F.col("f_yz")).otherwise(F.col("f_z")).alias("r"), F.least("s1", "s2").alias("score"),
    )
    longest = tri.select("lang", "a", F.explode(F.array("xy", "yz")).alias("phrase")).groupBy("lang", "phrase").agg(
        F.max("a").alias("longest")
    )
    stay = open_pairs.join(longest, ["lang", "phrase"], "left").where(
        F.col("longest").isNull() | (100 * F.col("longest") < DROP_PERCENT * F.col("a"))
    )
    return stay.select("lang", "phrase", "a", "l", "r", "score").unionByName(z)


def collocations(docs: DataFrame, top: int = TOP, frontier: int = FRONTIER) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` surviving phrases of every language."""
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    share = spark.sparkContext.broadcast
    words = materialize(count_phrases(texts, 1, None))
    n_words = words.count()
    known = {"words": word_bitmap(words.where("phrase <> ''"), n_words)}
    counted = materialize(count_phrases(texts, 2, share(known)))
    n_pairs = counted.count()
    pairs = materialize(_pairs(counted, words, n_pairs))
    frequent = pair_bitmap(pairs, n_pairs)
    todo, settled = pairs, []
    while True:
        floor = materialize(_frontier_floor(todo, frontier))
        if floor.isEmpty():
            break
        keyed = join_groups(todo, floor, "lang", "pairs", n_pairs)
        grown = materialize(keyed.where(_reaches("bound")))
        reported = grown.where(_reaches("score"))
        size = grown.count()
        bitmaps = share({"pairs": frequent, "grown": pair_bitmap(grown, size), "open": pair_bitmap(reported, size)})
        tri = count_phrases(texts, 3, bitmaps).where("phrase <> ''").select(
            "lang", "phrase", F.col("f").alias("a"),
            F.substring_index("phrase", " ", 2).alias("xy"), F.substring_index("phrase", " ", -2).alias("yz"),
        )
        found = _survivors(pairs, reported, materialize(tri))
        found = materialize(join_groups(found, floor, "lang", "pairs", n_pairs).where(_reaches("score")))
        enough = found.groupBy("lang").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= top).select("lang")
        done = materialize(enough.unionByName(floor.where("t_score = -1").select("lang")).distinct())
        order = [F.desc("score"), F.desc("a"), "phrase"]
        best = top_ranks(found.join(done, "lang"), order, top)
        settled.append(materialize(best.select("lang", "rank", "phrase", "a", "l", "r", "score")))
        todo = materialize(todo.join(done, "lang", "left_anti"))
        frontier *= GROW
    if not settled:
        return spark.createDataFrame([], "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    n = words.where("phrase = ''").select("lang", F.col("f").alias("n"))
    return out.join(n, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )


ORACLE_SQL = """
WITH pieces AS (
  SELECT doc, lang, unnest(generate_series(1, len(parts))) AS piece, unnest(parts) AS part
  FROM (
    SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
           string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[.,;:!?\\x0A-\\x0D]') AS parts
    FROM documents)
), lists AS (
  SELECT doc, lang, piece, list_filter(string_split_regex(part, '[\\x20\\x09]+'), lambda w: w <> '') AS ws FROM pieces
), tokens AS (
  SELECT doc, lang, piece, unnest(generate_series(1, len(ws))) AS pos, unnest(ws) AS w1 FROM lists WHERE len(ws) > 0
), grams AS (
  SELECT lang, w1, lead(w1) OVER p AS w2, lead(w1, 2) OVER p AS w3
  FROM tokens WINDOW p AS (PARTITION BY doc, piece ORDER BY pos)
), one AS (SELECT lang, w1, count(*) AS f FROM grams GROUP BY ALL),
two AS (SELECT lang, w1, w2, count(*) AS f FROM grams WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
three AS (SELECT lang, w1, w2, w3, count(*) AS f FROM grams WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
pairs AS (
  SELECT two.lang, two.w1 || ' ' || two.w2 AS phrase, two.f AS a, x.f AS l, y.f AS r,
         (1000000::HUGEINT * two.f * two.f) // (x.f::HUGEINT * y.f) AS score
  FROM two JOIN one x ON x.lang = two.lang AND x.w1 = two.w1 JOIN one y ON y.lang = two.lang AND y.w1 = two.w2
), cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3 AS phrase, t.w1 || ' ' || t.w2 AS head, t.w2 || ' ' || t.w3 AS tail, t.f AS a,
         x.f AS l1, yz.f AS r1, xy.f AS l2, z.f AS r2,
         (1000000::HUGEINT * t.f * t.f) // (x.f::HUGEINT * yz.f) AS s1,
         (1000000::HUGEINT * t.f * t.f) // (xy.f::HUGEINT * z.f) AS s2
  FROM three t
  JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN one z ON z.lang = t.lang AND z.w1 = t.w3
  JOIN two xy ON xy.lang = t.lang AND xy.w1 = t.w1 AND xy.w2 = t.w2
  JOIN two yz ON yz.lang = t.lang AND yz.w1 = t.w2 AND yz.w2 = t.w3
), longer AS (
  SELECT lang, phrase, max(a) AS most
  FROM (SELECT lang, head AS phrase, a FROM cuts UNION ALL SELECT lang, tail, a FROM cuts) GROUP BY ALL
), candidates AS (
  SELECT pairs.* FROM pairs LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * a
  UNION ALL
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM cuts
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM candidates
)
SELECT lang, rank, phrase, a, l, r, (SELECT sum(f)::BIGINT FROM one WHERE one.lang = ranked.lang) AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""
