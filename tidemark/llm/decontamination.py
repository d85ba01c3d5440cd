"""Benchmark decontamination with a generalised suffix automaton.

The normalised benchmark items form one automaton over words. Documents
stream through it: each word extends the longest match or falls back along
suffix links, so a text is read once whatever the number of items. Where the
match reaches a whole window the words under it are hit; spans beyond the
length or coverage limits are reported, cut out, or drop the document.

Scale: documents are never shuffled; one narrow pass per automaton. The
automaton is broadcast, so it is bounded: items are taken in shards of at most
``SHARD_WORDS`` words (long items in pieces that overlap by a window less one
word, so no window is lost) and a larger benchmark takes further passes whose
hit words are united per document.

Defined results: a null text (document or item) has no words; a document
without words is clean; repeated items or ids count once by item_id; a null
item_id is written as an empty string; an empty benchmark leaves every document
clean; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, slices

WINDOW = 13
SHARD_WORDS = 100_000
COVERAGE = 0.05
#: bytes outside 0-9, a-z, A-Z and non-ASCII end a word; A-Z fold to a-z
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_NEVER = 1 << 60


def words(text: str | None) -> list[bytes]:
    """``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lowered, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split(b" ") if text else []


@dataclass
class Automaton:
    """Suffix automaton of several word sequences. ``step[state * width + word]`` is the next state."""

    window: int = WINDOW
    vocab: dict = field(default_factory=dict)
    step: dict = field(default_factory=dict)
    link: list = field(default_factory=lambda: [-1])
    length: list = field(default_factory=lambda: [0])
    need: list = field(default_factory=list)  # shortest match that ends a window at this state
    full: dict = field(default_factory=dict)  # state -> the state of its last ``window`` words
    holders: dict = field(default_factory=dict)  # such a state -> items with that window
    short: dict = field(default_factory=dict)  # state -> [(words, items)] of short items ending here

    def build(self, items: list[tuple[str, list[bytes]]]) -> Automaton:
        for _, ws in items:
            for w in ws:
                self.vocab.setdefault(w, len(self.vocab))
        self.width = len(self.vocab) + 1
        moves: list[dict] = [{}]
        for _, ws in items:
            last = 0
            for w in ws:
                last = self._extend(moves, last, self.vocab[w])
        self.step = {s * self.width + c: t for s, m in enumerate(moves) for c, t in m.items()}
        self._mark(items)
        return self

    def _extend(self, moves, last, c) -> int:
        link, length = self.link, self.length

        def new(n, out, suffix):
            moves.append(out)
            length.append(n)
            link.append(suffix)
            return len(link) - 1

        def split(p, q):
            """``q`` stands for longer words too: part of it that ends at ``p`` + c becomes a state of its own."""
            part = new(length[p] + 1, dict(moves[q]), link[q])
            link[q] = part
            while p >= 0 and moves[p].get(c) == q:
                moves[p][c] = part
                p = link[p]
            return part

        if c in moves[last]:  # another item already has this path
            q = moves[last][c]
            return q if length[q] == length[last] + 1 else split(last, q)
        state, p = new(length[last] + 1, {}, 0), last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = state
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            link[state] = q if length[q] == length[p] + 1 else split(p, q)
        return state

    def _mark(self, items):
        n, w, link, length = len(self.link), self.window, self.link, self.length
        by_length = sorted(range(1, n), key=length.__getitem__)
        for s in by_length:
            if length[s] >= w:
                self.full[s] = s if length[link[s]] < w else self.full[link[s]]
        ends: dict[int, dict] = {}
        found: dict[int, set] = {}
        for item, ws in items:
            s = 0
            for i, word in enumerate(ws):
                s = self.step[s * self.width + self.vocab[word]]
                if i + 1 >= w:
                    found.setdefault(self.full[s], set()).add(item)
            if 0 < len(ws) < w:
                ends.setdefault(s, {}).setdefault(len(ws), set()).add(item)
        self.holders = {s: tuple(sorted(x)) for s, x in found.items()}
        self.need = [_NEVER] * n
        for s in by_length:
            up = self.short.get(link[s], []) if link[s] > 0 else []
            own = [(k, tuple(sorted(x))) for k, x in ends.get(s, {}).items()]
            if own or up:
                self.short[s] = own + up
            self.need[s] = min([w if length[s] >= w else _NEVER, *(k for k, _ in self.short.get(s, []))])

    def scan(self, doc: list[bytes]) -> tuple[int, list[tuple[int, int]], set, int]:
        """Words, hit spans [start, end) in word positions, items found and the longest match of one document."""
        vocab, step, link, length, need, width = self.vocab, self.step, self.link, self.length, self.need, self.width
        spans: list[tuple[int, int]] = []
        items: set = set()
        state = matched = i = longest = 0
        for word in doc:
            if not word:  # between two separators
                continue
            i += 1
            c = vocab.get(word)
            if c is None:
                state = matched = 0
                continue
            to = step.get(state * width + c)
            if to is None:
                while to is None and state:
                    state = link[state]
                    to = step.get(state * width + c)
                matched = length[state]
            state = to
            matched += 1
            if matched >= need[state]:
                longest = max(longest, matched)
                reach = 0
                if matched >= self.window:
                    items.update(self.holders[self.full[state]])
                    reach = self.window
                for k, held in self.short.get(state, ()):
                    if k <= matched:
                        items.update(held)
                        reach = max(reach, k)
                start = i - reach
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i))
        return i, spans, items, longest


def item_shards(bench: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS):
    """Items as bounded lists of (item_id text, words), streamed from the benchmark one partition at a time."""
    shard, held = [], 0
    for row in bench.select(F.col("item_id").cast("string").alias("i"), F.col("text").cast("string")).toLocalIterator():
        ws = [w for w in words(row[1]) if w]
        for at in range(0, max(1, len(ws) - window + 1), shard_words):
            piece = ws[at : at + shard_words + window - 1]
            if shard and held + len(piece) > shard_words:
                yield shard
                shard, held = [], 0
            if piece:
                shard.append((row[0] or "", piece))
                held += len(piece)
    yield shard


_SCHEMA = "doc_id bigint, n_words bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>, longest bigint"


def _pass(docs: DataFrame, automaton) -> DataFrame:
    def run(batches):
        a = automaton.value
        for batch in batches:
            for part in slices(batch):
                ids, out = part.column(0), []
                for text in part.column(1).to_pylist():
                    n, spans, items, longest = a.scan(words(text))
                    out.append((n, [{"start": s, "end": e} for s, e in spans], sorted(items), longest))
                cols = list(zip(*out, strict=True))
                span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                kinds = (pa.int64(), span, pa.list_(pa.string()), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                    names=["doc_id", "n_words", "spans", "items", "longest"],
                )

    return bounded_batches(docs).mapInArrow(run, _SCHEMA)


def contamination_spans(
    docs: DataFrame, bench: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """Per document: n_words, hit word spans (merged, in order), found items, longest match."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spark = docs.sparkSession
    passes = []
    for shard in item_shards(bench, window, shard_words):
        passes.append(spark.sparkContext.broadcast(Automaton(window).build(shard)))
    if len(passes) == 1:
        return _pass(slim, passes[0])
    # further passes: every row carries its own key, so that its spans meet again
    from tidemark.session import materialize

    keyed = materialize(slim.withColumn("__row", F.monotonically_increasing_id()))
    found = None
    for one in passes:
        part = _pass(keyed.select(F.col("__row").alias("doc_id"), "text"), one).withColumnRenamed("doc_id", "__row")
        found = part if found is None else found.unionByName(part)
    merged = found.groupBy("__row").agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.max("longest").alias("longest"),
    )
    united = F.aggregate(
        F.array_sort("spans"),
        F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= s["start"]),
            F.concat(
                F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(
                    F.struct(
                        F.element_at(acc, -1)["start"].alias("start"),
                        F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(acc, F.array(s))),
    )
    return (
        keyed.select("__row", "doc_id")
        .join(merged, "__row")
        .select("doc_id", "n_words", united.alias("spans"), "items", "longest")
    )


def contamination_report(
    docs: DataFrame, bench: DataFrame, window: int = WINDOW, coverage: float = COVERAGE, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest_match, spans."""
    spans = contamination_spans(docs, bench, window, shard_words)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    per = round(1 / coverage)
    return spans.withColumn("n_hit", hit).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * per >= F.col("n_words"))).alias("contaminated"),
        F.col("longest").alias("longest_match"),
        "spans",
    )


def _cut(text: str, automaton: Automaton, max_span: int, per: int) -> tuple[str | None, bool]:
    """The text without spans longer than ``max_span`` words; None if coverage drops it whole."""
    doc = words(text)
    n, spans, _, _ = automaton.scan(doc)
    hit = sum(e - s for s, e in spans)
    if hit and hit * per >= n:
        return None, True
    return _without(text, [(s, e) for s, e in spans if e - s > max_span]), False


def _without(text: str, long: list[tuple[int, int]]) -> str:
    """The text without the given word spans."""
    import re

    if not long:
        return text
    raw = text.encode("utf-8", "surrogatepass")
    at = [(m.start(), m.end()) for m in re.finditer(rb"[^ ]+", raw.translate(_TABLE))]
    out, last = [], 0
    for s, e in long:
        out.append(raw[last : at[s][0]])
        last = at[e - 1][1]
    return b"".join([*out, raw[last:]]).decode("utf-8", "surrogatepass")


def decontaminate(
    docs: DataFrame,
    bench: DataFrame,
    window: int = WINDOW,
    coverage: float = COVERAGE,
    max_span: int | None = None,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """The documents that stay, with their own columns and, up to one shard of the benchmark, no shuffle of texts.

    A document whose hit words reach ``coverage`` goes; with ``max_span`` set,
    hit spans of more words than that are cut out of the rest. With several
    shards their spans are united first, then judged and cut once.
    """
    schema, spark = docs.schema, docs.sparkSession
    names = docs.columns
    at = names.index("text")
    per = round(1 / coverage)
    limit = _NEVER if max_span is None else max_span
    shards = [spark.sparkContext.broadcast(Automaton(window).build(s)) for s in item_shards(bench, window, shard_words)]
    if len(shards) > 1:
        return _by_report(docs, bench, window, coverage, max_span, shard_words)

    def run_with(automaton):
        def run(batches):
            a = automaton.value
            for batch in batches:
                for part in slices(batch):
                    cut = [_cut(t, a, limit, per) if t else (t, False) for t in part.column(at).to_pylist()]
                    keep = pa.array([not gone for _, gone in cut], pa.bool_())
                    cols = [
                        pa.array([t for t, _ in cut], part.schema.field(i).type) if i == at else part.column(i)
                        for i in range(part.num_columns)
                    ]
                    yield pa.RecordBatch.from_arrays(cols, schema=part.schema).filter(keep)

        return run

    for one in shards:
        docs = bounded_batches(docs).mapInArrow(run_with(one), schema)
    return docs


def _by_report(docs, bench, window, coverage, max_span, shard_words):
    """Several shards: verdict and spans need the union of their hits, so rows get a key and both are joined back."""
    from tidemark.session import materialize

    key, cuts = "__decon_row", "__decon_spans"
    keyed = materialize(docs.withColumn(key, F.monotonically_increasing_id()))
    report = contamination_report(
        keyed.select(F.col(key).alias("doc_id"), "text"), bench, window, coverage, shard_words
    ).withColumnRenamed("doc_id", key)
    if max_span is None:
        return keyed.join(report.where("contaminated").select(key), key, "left_anti").select(*docs.columns)
    report = materialize(report.select(key, "contaminated", F.filter("spans", lambda s: s["end"] - s["start"] > max_span).alias(cuts)))
    kept = keyed.join(report.where("contaminated").select(key), key, "left_anti")
    long = report.where(~F.col("contaminated") & (F.size(cuts) > 0)).select(key, cuts)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                spans = part.column(part.num_columns - 1).to_pylist()
                texts = [
                    _without(t, [(s["start"], s["end"]) for s in cut]) if cut else t
                    for t, cut in zip(part.column(at).to_pylist(), spans, strict=True)
                ]
                cols = [pa.array(texts, x.type) if i == at else x for i, x in enumerate(part.columns[:-1])]
                yield pa.RecordBatch.from_arrays(cols, names=docs_names)

    docs_names = docs.columns
    return bounded_batches(kept.join(long, key, "left").select(*docs.columns, cuts)).mapInArrow(run, docs.schema)


def brute_force(doc: str | None, items: list[tuple[object, str | None]], window: int = WINDOW) -> tuple:
    """The contract's columns for one document, straight from its definition (for tests)."""
    ws = [w for w in words(doc) if w]
    hit, found = set(), set()
    for item, text in items:
        iw = [w for w in words(text) if w]
        k = min(window, len(iw))
        wins = {tuple(iw[j : j + k]) for j in range(len(iw) - k + 1)} if k else set()
        for j in range(len(ws) - k + 1) if k else ():
            if tuple(ws[j : j + k]) in wins:
                hit.update(range(j, j + k))
                found.add("" if item is None else str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(ws), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(ws)


_CUT = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
#: the report by window strings: every position's next words, compared with the distinct windows of the items
ORACLE_SQL = f"""WITH d AS (SELECT ROW_NUMBER() OVER () AS rid, doc_id, {_CUT} AS w FROM documents),
b AS (SELECT item_id, {_CUT} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, LEAST({WINDOW}, LEN(w)) AS size, ARRAY_TO_STRING(w[i : i + {WINDOW} - 1], ' ') AS piece
  FROM (SELECT *, UNNEST(RANGE(1, GREATEST(LEN(w) - {WINDOW} + 2, 2))) AS i FROM b WHERE LEN(w) > 0) x),
word AS (SELECT rid, UNNEST(w) AS word, GENERATE_SUBSCRIPTS(w, 1) AS i FROM d WHERE LEN(w) > 0),
ahead AS (SELECT rid, i, LIST(word) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW} - 1 FOLLOWING) AS next FROM word),
hit AS (SELECT DISTINCT rid, i, win.size, item_id FROM (SELECT rid, i, size, ARRAY_TO_STRING(next[1 : size], ' ') AS piece
  FROM ahead, (SELECT DISTINCT size FROM win) s WHERE LEN(next) >= size) p JOIN win USING (size, piece)),
cover AS (SELECT rid, COUNT(DISTINCT place) AS n_hit FROM (SELECT DISTINCT rid, UNNEST(RANGE(i, i + size)) AS place FROM hit) c GROUP BY rid),
found AS (SELECT rid, COUNT(*) AS n_items, STRING_AGG(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hit) f GROUP BY rid)
SELECT doc_id, CAST(IFNULL(LEN(w), 0) AS BIGINT) AS n_words, CAST(IFNULL(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(IFNULL(n_items, 0) AS BIGINT) AS n_items, SHA256(IFNULL(items, '')) AS items_sha256,
  IFNULL(n_hit > 0 AND 20 * n_hit >= LEN(w), FALSE) AS contaminated
FROM d LEFT JOIN cover USING (rid) LEFT JOIN found USING (rid)"""
