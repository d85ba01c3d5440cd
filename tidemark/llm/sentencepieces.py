"""SentencePiece encoding and decoding over a suffix array.

The pre-tokens of a batch that were not seen before are joined into one string
with separators. Its suffixes are sorted (by as many code points as the longest
piece has), every piece of the vocabulary is found in them by binary search as
one range of suffixes, the ranges unfold to lattice edges, the edges are sorted
by position and relaxed position by position for all pre-tokens at once. Texts
are then gathered from their pre-tokens' ids. Decoding gathers the bytes of the
ids; it restores every text exactly.

Nothing is shuffled and memory is bounded by a slice of a batch and by
``MAX_WORDS`` remembered pre-tokens; the vocabulary (one file) is broadcast.

Defined results: null text encodes to null and decodes to null, the empty text
to no ids and back; control characters, literal word marks and code points
without a piece go through bytes; ids outside the vocabulary decode to nothing;
repeated rows are encoded each; all other columns of the input are kept by
``encode``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bounded_batches, slices
from tidemark.llm.pieces import MODEL_PATH, WEIGHT, PieceModel, load_pieces, pretokens

MAX_WORDS = 400_000
#: code points that one suffix array indexes
MAX_INDEX = 1 << 18
#: score of an unreached node; a text has less than 2^31 bytes, so its score (without WEIGHT) stays far above
_LOW = np.int64(-(1 << 62))


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one after another."""
    total = int(sizes.sum())
    if not total:
        return np.empty(0, np.int64)
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return np.arange(total, dtype=np.int64) + shift


class SuffixEncoder:
    """Ids of distinct pre-tokens by suffix-array matching; keeps what it has encoded up to ``max_words``."""

    def __init__(self, model: PieceModel, max_words: int = MAX_WORDS):
        self.model, self.max_words = model, max_words
        pieces = list(model.value)
        self.length = np.array([len(p) for p in pieces], np.int64)
        self.score = np.array([(model.value[p][0] + 1) // WEIGHT for p in pieces], np.int64)
        self.id = np.array([model.value[p][1] for p in pieces], np.int64)
        flat = "".join(pieces)
        self.letters = np.frombuffer(flat.encode("utf-32-le"), np.uint32)
        self.starts = np.cumsum(self.length) - self.length
        self.alphabet = np.unique(self.letters)
        surface = model.surface
        size = max(surface) + 1
        self.surface_len = np.array([len(surface.get(i, b"")) for i in range(size)], np.int64)
        self.surface_at = np.cumsum(self.surface_len) - self.surface_len
        self.surface = np.frombuffer(b"".join(surface.get(i, b"") for i in range(size)), np.uint8)
        self._clear()

    def _clear(self):
        self.known: dict[str, int] = {}
        self.sizes = np.empty(0, np.int64)
        self.at = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int32)

    # -- one batch of new pre-tokens -------------------------------------------------

    def _match(self, text: np.ndarray):
        """Edges (start, piece index) of all pieces in ``text`` (code points; 0 separates), by suffix array."""
        present = self.alphabet[np.isin(self.alphabet, text)]
        bits = max(1, int(len(present) + 1).bit_length())
        per_key = 62 // bits
        n_keys = -(-self.model.longest // per_key)
        n = len(text)

        def rank(letters):
            at = np.searchsorted(present, letters)
            at[at == len(present)] = 0
            return np.where(present[at] == letters, at + 1, 0).astype(np.int64) if len(present) else np.zeros(len(letters), np.int64)

        r = np.concatenate([rank(text), np.zeros(per_key * n_keys, np.int64)])
        keys = []
        for k in range(n_keys):
            key = np.zeros(n, np.int64)
            for j in range(k * per_key, (k + 1) * per_key):
                key = (key << bits) | r[j : j + n]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        keys = [k[order] for k in keys]

        pr = rank(self.letters)
        seen = np.minimum.reduceat(pr, self.starts) > 0 if len(pr) else np.zeros(0, bool)
        piece = np.flatnonzero(seen)  # all their letters occur
        m = self.length[piece]
        low, high = [], []
        for k in range(n_keys):
            lo = np.zeros(len(piece), np.int64)
            hi = np.zeros(len(piece), np.int64)
            for j in range(k * per_key, (k + 1) * per_key):
                inside = j < m
                c = np.where(inside, pr[np.minimum(self.starts[piece] + j, len(pr) - 1)], 0)
                lo = (lo << bits) | c
                hi = (hi << bits) | np.where(inside, c, (1 << bits) - 1)
            low.append(lo)
            high.append(hi)

        def bisect(target, after):
            a, b = np.zeros(len(piece), np.int64), np.full(len(piece), n, np.int64)
            while True:
                open_ = a < b
                if not open_.any():
                    return a
                mid = (a + b) >> 1
                probe = np.minimum(mid, n - 1)
                less, same = np.zeros(len(piece), bool), np.ones(len(piece), bool)
                for k in range(n_keys):
                    v = keys[k][probe]
                    less |= same & (v < target[k])
                    same &= v == target[k]
                go = open_ & (less | same if after else less)
                a = np.where(go, mid + 1, a)
                b = np.where(open_ & ~go, mid, b)

        first, last = bisect(low, False), bisect(high, True)
        count = last - first
        return order[ranges(first, count)], np.repeat(piece, count)

    def _encode(self, words: list[str]) -> None:
        size = np.array([len(w) for w in words], np.int64)
        text = np.frombuffer("\0".join([*words, ""]).encode("utf-32-le"), np.uint32)
        begin = np.cumsum(size + 1) - size - 1
        n = len(text)
        start, piece = self._match(text)
        plain = np.ones(n, bool)  # code points without a piece of their own
        plain[start[self.length[piece] == 1]] = False
        plain[begin + size] = False
        bare = np.flatnonzero(plain)
        cp = text[bare]
        n_bytes = 1 + (cp >= 0x80).astype(np.int64) + (cp >= 0x800) + (cp >= 0x10000)
        e_start = np.concatenate([start, bare])
        e_end = np.concatenate([start + self.length[piece], bare + 1])
        e_gain = np.concatenate([self.score[piece], np.full(len(bare), self.model.fallback // WEIGHT, np.int64)])
        e_tokens = np.concatenate([np.ones(len(piece), np.int64), n_bytes])
        e_piece = np.concatenate([piece, np.full(len(bare), -1, np.int64)])

        offset = np.arange(n, dtype=np.int64) - np.repeat(begin, size + 1)
        e_off = offset[e_start]
        by = np.argsort(e_off, kind="stable")
        e_start, e_end, e_gain, e_tokens, e_piece = e_start[by], e_end[by], e_gain[by], e_tokens[by], e_piece[by]
        cuts = np.searchsorted(e_off[by], np.arange(int(size.max(initial=0)) + 1))
        best = np.full(n, _LOW, np.int64)
        best[begin] = 0
        tokens = np.zeros(n, np.int64)
        back = np.full(n, -1, np.int64)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            # edges from one distance to their word's start: their ends differ, and their starts are settled
            total = best[e_start[a:b]] + e_gain[a:b]
            count = tokens[e_start[a:b]] + e_tokens[a:b]
            end = e_end[a:b]
            better = (total > best[end]) | (total == best[end]) & (count < tokens[end])
            best[end[better]] = total[better]
            tokens[end[better]] = count[better]
            back[end[better]] = np.flatnonzero(better) + a

        node, word = begin + size, np.arange(len(words))
        steps = []
        while len(node):
            on = node > begin[word]
            node, word = node[on], word[on]
            edge = back[node]
            steps.append((word, edge))
            node = e_start[edge]
        word = np.concatenate([w for w, _ in steps] or [np.empty(0, np.int64)])[::-1]
        edge = np.concatenate([e for _, e in steps] or [np.empty(0, np.int64)])[::-1]
        by = np.argsort(word, kind="stable")
        word, edge = word[by], edge[by]
        which = e_piece[edge]
        ids = np.where(which >= 0, self.id[which], -1)
        width = np.ones(len(ids), np.int64)
        raw = np.flatnonzero(which < 0)
        if len(raw):
            spelled = [chr(c).encode("utf-8", "surrogatepass") for c in text[e_start[edge[raw]]].tolist()]
            width[raw] = [len(s) for s in spelled]
            wide = np.repeat(ids, width)
            wide[wide < 0] = np.frombuffer(b"".join(spelled), np.uint8).astype(np.int64) + self.model.bytes_at
            ids = wide
        sizes = np.bincount(word, weights=width, minlength=len(words)).astype(np.int64)
        base = len(self.ids)
        self.at = np.concatenate([self.at, base + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        for w in words:
            self.known[w] = len(self.known)

    # -- texts -----------------------------------------------------------------------

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text)."""
        cut = [pretokens(t) for t in texts]
        if len(self.known) > self.max_words:
            self._clear()
        new = list(dict.fromkeys(w for c in cut for w in set(c).difference(self.known)))
        held, room = [], 0
        for w in sorted(new):
            held.append(w)
            room += len(w) + 1
            if room >= MAX_INDEX:
                self._encode(held)
                held, room = [], 0
        if held:
            self._encode(held)
        get = self.known.__getitem__
        index = np.fromiter((get(w) for c in cut for w in c), np.int64, sum(map(len, cut)))
        size = self.sizes[index]
        ids = self.ids[ranges(self.at[index], size)]
        ends = np.concatenate([[0], np.cumsum(size)])
        stops = ends[np.cumsum([len(c) for c in cut], dtype=np.int64)] if cut else np.empty(0, np.int64)
        return ids, np.diff(stops, prepend=0)

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        ids = np.asarray(ids, np.int64)
        inside = (ids >= 0) & (ids < len(self.surface_len))
        ids = np.where(inside, ids, 0)
        width = np.where(inside, self.surface_len[ids], 0)
        raw = self.surface[ranges(self.surface_at[ids], width)].tobytes()
        ends = np.concatenate([[0], np.cumsum(width)])[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        return [
            (part[1:] if part[:1] == b" " else part).decode("utf-8", "replace")
            for part in (raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True))
        ]


def _list_array(ids: np.ndarray, sizes: np.ndarray, texts: list[str | None]):
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    none = pa.array([t is None for t in texts], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids, pa.int32()), mask=none)


def encode(
    docs: DataFrame, model_path: str = MODEL_PATH, out_col: str = "token_ids", check_col: str | None = None
) -> DataFrame:
    """``docs`` with an array<int> column of ids and, if named, a column that tells whether decoding them gives the
    text back; columns of those names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(load_pieces(model_path))
    docs = docs.drop(out_col, *([check_col] if check_col else []))
    at = docs.columns.index("text")
    added = [T.StructField(out_col, T.ArrayType(T.IntegerType()))]
    if check_col:
        added.append(T.StructField(check_col, T.BooleanType()))
    names = [*docs.columns, *(f.name for f in added)]

    def run(batches):
        encoder = SuffixEncoder(shared.value)
        for batch in batches:
            for part in slices(batch):
                texts = part.column(at).to_pylist()
                ids, sizes = encoder.encode(texts)
                cols = [*part.columns, _list_array(ids, sizes, texts)]
                if check_col:
                    back = encoder.decode(ids, sizes)
                    cols.append(pa.array([(t or "") == b for t, b in zip(texts, back, strict=True)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return bounded_batches(docs).mapInArrow(run, T.StructType([*docs.schema.fields, *added]))


def decode(encoded: DataFrame, model_path: str = MODEL_PATH, ids_col: str = "token_ids", out_col: str = "text") -> DataFrame:
    """``encoded`` with the text that its ids stand for in ``out_col`` (replaced if it is there)."""
    shared = encoded.sparkSession.sparkContext.broadcast(load_pieces(model_path))
    encoded = encoded.drop(out_col)
    at = encoded.columns.index(ids_col)
    schema = T.StructType([*encoded.schema.fields, T.StructField(out_col, T.StringType())])

    def run(batches):
        decoder = SuffixEncoder(shared.value)
        for batch in batches:
            for part in slices(batch):
                lists = part.column(at)
                sizes = np.array([len(x) if x is not None else 0 for x in lists.to_pylist()], np.int64)
                ids = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.int64)
                valid = lists.is_valid().to_pylist()
                texts = [t if ok else None for t, ok in zip(decoder.decode(ids, sizes), valid, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, out_col]
                )

    return bounded_batches(encoded).mapInArrow(run, schema)


def encoding_report(docs: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids as decimal text, comma-joined), restored (decoding gives the text back)."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(load_pieces(model_path))

    def run(batches):
        encoder = SuffixEncoder(shared.value)
        for batch in batches:
            for part in slices(batch):
                texts = part.column(1).to_pylist()
                ids, sizes = encoder.encode(texts)
                back = encoder.decode(ids, sizes)
                ends = np.cumsum(sizes).tolist()
                sha = [
                    hashlib.sha256(",".join(map(str, ids[e - s : e].tolist())).encode()).hexdigest()
                    for s, e in zip(sizes.tolist(), ends, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(sizes, pa.int64()),
                        pa.array(sha, pa.string()),
                        pa.array([(t or "") == b for t, b in zip(texts, back, strict=True)], pa.bool_()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "restored"],
                )

    return bounded_batches(slim).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, restored boolean")
