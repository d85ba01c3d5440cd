"""Personal data: base patterns and information-theoretic sanitisation of the terms that give it away.

Base spans (email, ip, card, phone) are found in every whole text by linear
scans. The corpus then tells which other terms reveal an entity of such a kind
where the entity itself is masked: for a term t and a kind k

    PMI(t, k) = log2(P(t near k) / (P(t) P(k)))   against   IC(k) = -log2 P(k),

P over all word positions of all documents, near: within ``REACH`` words of a
span. A term with PMI >= ``DISCLOSE`` x IC(k) that stood near at least
``ENTITIES`` different values of k (so that copies of one text prove nothing)
discloses k. So does a term that gives one entity away (a name beside one
person's phone): the same ratio with the entity v in place of k, and near v in
at least ``TEXTS`` texts that differ in more than case, spaces and entities.
In documents that hold an entity of k its occurrences become spans of kind
``term``. ``sanitise`` masks base spans, generalises disclosing terms to
their kind and removes those at ``REMOVE`` x IC(k) and above.

Scale: narrow passes over the texts; only words near spans, and the counts of
candidate terms, are shuffled. Term tables go out in shards of at most
``SHARD_TERMS`` terms, one pass each, so no broadcast grows with the corpus.

Defined results: null text is empty and has no spans; an empty table gives an
empty result; repeated rows each get their spans and count as often as they
occur; overlapping spans of different kinds are all reported; extra columns are
not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, slices
from tidemark.session import materialize

KINDS = ("email", "ip", "card", "phone")
REACH, ENTITIES, TEXTS, DISCLOSE, REMOVE = 5, 5, 3, 0.9, 0.97
SHARD_TERMS = 200_000
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
#: a match can only start where a run of digits starts, which keeps long runs linear
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_WORD = re.compile(r"[^\W\d_]{2,}")
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            last = m.end()
            out.append((start, last))
        at = text.find("@", max(at + 1, last))
    return out


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then start."""
    if not text:
        return []
    out = [("email", a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and _luhn(digits):
                    out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= len(_DIGIT.findall(m[0])) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return out


def join_spans(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _masked(text: str, spans) -> str:
    """The text with its base spans blanked."""
    out, last = [], 0
    for _, a, b in sorted(spans, key=lambda s: s[1:]):
        if b <= last:
            continue
        out += [text[last : max(a, last)], " " * (b - max(a, last))]
        last = b
    out.append(text[last:])
    return "".join(out)


def _near(words: list[tuple[int, int, str]], a: int, b: int) -> list[str]:
    """The ``REACH`` words on either side of a span, however far; ``words`` are (start, end, word) in page order."""
    left = bisect_right(words, a, key=lambda w: w[1])
    right = bisect_left(words, b, key=lambda w: w[0])
    return [w for _, _, w in words[max(0, left - REACH) : left] + words[right : right + REACH]]


def _digest(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def _near_words(docs: DataFrame) -> DataFrame:
    """(term, kind, value, text) for every word near a span, counted within a batch; values and texts as digests."""

    def run(batches):
        for batch in batches:
            found: Counter = Counter()
            for text in batch.column(1).to_pylist():
                spans = base_spans(text)
                if not spans:
                    continue
                masked = _masked(text, spans)
                words = [(m.start(), m.end(), m[0].lower()) for m in _WORD.finditer(masked)]
                plain = _digest(" ".join(masked.lower().split()))
                for kind, a, b in spans:
                    value = _digest(text[a:b].lower())
                    for w in _near(words, a, b):
                        found[w, kind, value, plain] += 1
            if found:
                cols = list(zip(*((*k, n) for k, n in found.items()), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.string()) for c in cols[:4]), pa.array(cols[4], pa.int64())],
                    names=["term", "kind", "value", "text", "n"],
                )

    return docs.mapInArrow(run, "term string, kind string, value string, text string, n bigint")


def _occurrences(docs: DataFrame, terms) -> DataFrame:
    """(term, n) of the broadcast terms in all texts; a null term carries the number of all words."""

    def run(batches):
        wanted = terms.value
        for batch in batches:
            counts: Counter = Counter()
            total = 0
            for part in slices(batch):
                for text in part.column(1).to_pylist():
                    if text:
                        ws = _WORD.findall(text.lower())
                        total += len(ws)
                        counts.update(filter(wanted.__contains__, ws))
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *counts], pa.string()), pa.array([total, *counts.values()], pa.int64())],
                names=["term", "n"],
            )

    return docs.mapInArrow(run, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def _shards(rows: DataFrame, size: int):
    """Rows as tuples in lists of at most ``size``, one partition at a time."""
    held = []
    for row in rows.toLocalIterator():
        held.append(tuple(row))
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def disclosing_terms(
    docs: DataFrame, entities: int = ENTITIES, disclose: float = DISCLOSE, shard_terms: int = SHARD_TERMS, texts: int = TEXTS
) -> DataFrame:
    """term, kind, near (times near the kind, or the one entity), n (times in the corpus), pmi, ic, ratio (pmi / ic);
    a term that discloses a kind in several ways has the row of the highest ratio."""
    spark = docs.sparkSession
    slim = bounded_batches(docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")))
    # a value's own words first, then its terms: every step combines before the shuffle
    pairs = materialize(
        _near_words(slim)
        .groupBy("term", "kind", "value", "text")
        .agg(F.sum("n").alias("n"))
        .groupBy("term", "kind", "value")
        .agg(F.sum("n").alias("near"), F.count(F.lit(1)).alias("texts"))
    )
    near = materialize(
        pairs.groupBy("term", "kind").agg(
            F.sum("near").alias("near"), F.count(F.lit(1)).alias("entities"), F.max("texts").alias("texts")
        )
    )
    share = near.groupBy("kind").agg(F.sum("near").alias("_words"))  # a row per kind
    of_value = pairs.groupBy("kind", "value").agg(F.sum("near").alias("_words"))
    candidates = near.where((F.col("entities") >= entities) | (F.col("texts") >= texts))
    counted = None
    for shard in _shards(candidates.select("term").distinct(), shard_terms):
        part = _occurrences(slim, spark.sparkContext.broadcast(frozenset(t for (t,) in shard)))
        counted = part if counted is None else counted.unionByName(part)
    if counted is None:
        return spark.createDataFrame(
            [], "term string, kind string, near long, n long, pmi double, ic double, ratio double"
        )
    counted = materialize(counted)
    total = counted.where("term IS NULL").agg(F.max("n").alias("words"))
    by_kind = near.where(F.col("entities") >= entities).join(F.broadcast(share), "kind")  # four rows
    by_value = pairs.where(F.col("texts") >= texts).join(of_value, ["kind", "value"])
    columns = ["term", "kind", "near", "_words"]
    p_near = F.col("_words") / F.col("words")
    scored = (
        by_kind.select(columns)
        .unionByName(by_value.select(columns))
        .join(counted.where("term IS NOT NULL"), "term")
        .crossJoin(F.broadcast(total))  # one row
        .withColumn("ic", -F.log2(p_near))
        .withColumn("pmi", F.log2(F.col("near") / F.col("n") / p_near))
        .withColumn("ratio", F.col("pmi") / F.col("ic"))
        .where((F.col("ic") > 0) & (F.col("ratio") >= disclose))
    )
    row = F.max(F.struct("ratio", "near", "n", "pmi", "ic")).alias("r")
    return scored.groupBy("term", "kind").agg(row).select("term", "kind", "r.near", "r.n", "r.pmi", "r.ic", "r.ratio")


def _term_spans(text: str, spans, terms: dict) -> list[tuple[str, int, int]]:
    """Occurrences outside base spans of terms that disclose a kind the text holds."""
    kinds = {k for k, _, _ in spans}
    masked = _masked(text, spans)
    return [
        ("term", m.start(), m.end())
        for m in _WORD.finditer(masked)
        if not kinds.isdisjoint(terms.get(m[0].lower(), ()))
    ]


def _term_table(terms: DataFrame, shard_terms: int):
    """Broadcast tables term -> {kind: ratio}, each of at most ``shard_terms`` rows (at least one, maybe empty)."""
    spark = terms.sparkSession
    tables = []
    for shard in _shards(terms.select("term", "kind", "ratio"), shard_terms):
        table: dict = {}
        for term, kind, ratio in shard:
            table.setdefault(term, {})[kind] = ratio
        tables.append(spark.sparkContext.broadcast(table))
    return tables or [spark.sparkContext.broadcast({})]


def find_spans(docs: DataFrame, terms: DataFrame | None = None, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term.

    ``terms`` as ``disclosing_terms`` gives them; learned from ``docs`` if not given.
    """
    tables = _term_table(disclosing_terms(docs) if terms is None else terms, shard_terms)

    def run(batches):
        known = [t.value for t in tables]
        for batch in batches:
            for part in slices(batch):
                rows = []
                for text in part.column(1).to_pylist():
                    base = base_spans(text)
                    more = sorted({s for t in known if t and base for s in _term_spans(text, base, t)}, key=lambda s: s[1])
                    count = Counter(k for k, _, _ in base)
                    sha = hashlib.sha256(join_spans(base).encode()).hexdigest()
                    rows.append((*(count[k] for k in KINDS), sha, join_spans(base + more), len(more)))
                cols = list(zip(*rows, strict=True))
                kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                    names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_term"],
                )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return bounded_batches(slim).mapInArrow(
        run, f"doc_id bigint, {counts}, base_sha256 string, spans string, n_term bigint"
    )


def sanitise(docs: DataFrame, terms: DataFrame | None = None, remove: float = REMOVE) -> DataFrame:
    """``docs`` with base spans masked as ``[KIND]`` and disclosing terms generalised to ``[KIND term]`` or removed."""
    tables = _term_table(disclosing_terms(docs) if terms is None else terms, SHARD_TERMS)
    at = docs.columns.index("text")

    def clean(text, known):
        base = base_spans(text)
        if not base:
            return text
        marks = [(a, b, f"[{k.upper()}]") for k, a, b in base]
        kinds = {k for k, _, _ in base}
        for table in known:
            for _, a, b in _term_spans(text, base, table) if table else ():
                ratio, kind = max((r, k) for k, r in table[text[a:b].lower()].items() if k in kinds)
                marks.append((a, b, "" if ratio >= remove else f"[{kind.upper()} term]"))
        out, last = [], 0
        for a, b, put in sorted(marks):
            if b <= last:
                continue
            out += [text[last : max(a, last)], put]
            last = b
        return "".join([*out, text[last:]])

    def run(batches):
        known = [t.value for t in tables]
        for batch in batches:
            for part in slices(batch):
                texts = [clean(t, known) if t else t for t in part.column(at).to_pylist()]
                cols = [pa.array(texts, f.type) if i == at else part.column(i) for i, f in enumerate(part.schema)]
                yield pa.RecordBatch.from_arrays(cols, schema=part.schema)

    return bounded_batches(docs).mapInArrow(run, docs.schema)


def expected_ratio(near: int, n: int, kind_words: int, words: int) -> float:
    """PMI / IC from counts (for tests)."""
    p = kind_words / words
    return math.log2(near / n / p) / -math.log2(p)
