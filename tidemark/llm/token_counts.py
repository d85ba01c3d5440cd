"""Token counts by a dynamic programme shared over a trie.

The distinct pre-tokens of a task's rows go into one trie. A node's forward
score (the best unigram score of the prefix it stands for) is computed when the
node is made, so pre-tokens that share a prefix share its work; the node where
a pre-token ends holds its token count. A document's count is the sum over its
pre-tokens. Nothing is shuffled: tries are local to a task and emptied at
``MAX_NODES`` (counts at ``MAX_WORDS``), so memory does not depend on the input.

Defined results: a null or empty text has 0 tokens; repeated rows are counted
each; a pre-token longer than ``LONG`` code points is scored without the trie
by the same programme over a sliding window; extra columns are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, slices
from tidemark.llm.pieces import MODEL_PATH, WEIGHT, PieceModel, load_pieces, pretokens

MAX_NODES = 400_000
MAX_WORDS = 400_000
LONG = 200


class ForwardTrie:
    """Trie of pre-tokens with forward scores; ``count`` inserts a pre-token and gives its number of tokens,
    ``counts`` is where the caller keeps them."""

    def __init__(self, model: PieceModel, max_nodes: int = MAX_NODES):
        self.model, self.max_nodes = model, max_nodes
        self.value = {p: v for p, (v, _) in model.value.items()}
        sizes: dict[str, set] = {}
        for p in self.value:
            sizes.setdefault(p[-2:], set()).add(len(p))
        self.sizes = {k: tuple(sorted(v)) for k, v in sizes.items()}
        self.clear()

    def clear(self):
        self.child: dict[int, int] = {}  # node << 21 | code point -> node
        self.best = [0]
        self.counts: dict[str, int] = {}

    def _forward(self, prefix: str, end: int, path: list[int]) -> int:
        """Best score of ``prefix[:end]``; ``path[i]`` is the node of its first i code points."""
        best, value, last = self.best, self.value, prefix[end - 1]
        single = value.get(last)
        top = best[path[end - 1]] + (self.model.fallback - len(last.encode()) if single is None else single)
        if end > 1:
            for size in self.sizes.get(prefix[end - 2 : end], ()):
                if size > end:
                    break
                got = value.get(prefix[end - size : end])
                if got is not None and best[path[end - size]] + got > top:
                    top = best[path[end - size]] + got
        return top

    def count(self, pretoken: str) -> int:
        if len(pretoken) > LONG:
            return self._sliding(pretoken)
        if len(self.best) > self.max_nodes:  # what is counted stays counted
            self.child, self.best = {}, [0]
        child, best, node, path = self.child, self.best, 0, [0]
        for end, letter in enumerate(pretoken, 1):
            key = node << 21 | ord(letter)
            node = child.get(key)
            if node is None:
                best.append(self._forward(pretoken, end, path))
                node = child[key] = len(best) - 1
            path.append(node)
        return -best[node] % WEIGHT

    def _sliding(self, pretoken: str) -> int:
        reach = self.model.longest
        best = [0]  # of the last ``reach`` prefixes
        value, fallback = self.value, self.model.fallback
        for end in range(1, len(pretoken) + 1):
            last = pretoken[end - 1]
            single = value.get(last)
            top = best[-1] + (fallback - len(last.encode()) if single is None else single)
            for size in self.sizes.get(pretoken[end - 2 : end], ()) if end > 1 else ():
                if size > end:
                    break
                got = value.get(pretoken[end - size : end])
                if got is not None and best[-size] + got > top:
                    top = best[-size] + got
            best.append(top)
            if len(best) > reach:
                del best[0]
        return -best[-1] % WEIGHT


def token_counts(docs: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, n_pretokens."""
    shared = docs.sparkSession.sparkContext.broadcast(load_pieces(model_path))

    def run(batches):
        trie = ForwardTrie(shared.value)
        for batch in batches:
            for part in slices(batch):
                cuts = [pretokens(text) for text in part.column(1).to_pylist()]
                if len(trie.counts) > MAX_WORDS:
                    trie.clear()
                known = trie.counts
                for cut in cuts:
                    for pretoken in set(cut).difference(known):
                        known[pretoken] = trie.count(pretoken)
                get = known.__getitem__
                tokens = [sum(map(get, cut)) for cut in cuts]
                pieces = [len(cut) for cut in cuts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(tokens, pa.int64()), pa.array(pieces, pa.int64())],
                    names=["doc_id", "n_tokens", "n_pretokens"],
                )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return bounded_batches(slim).mapInArrow(run, "doc_id bigint, n_tokens bigint, n_pretokens bigint")
