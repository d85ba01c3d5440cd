"""Near-duplicate detection with an LSH forest over MinHash signatures.

1. Every text becomes its set of word shingles, a digest of the set and a
   signature of ``TREES x STEP`` MinHash values. Equal sets are one class.
2. Tree ``t`` orders the classes by their signature read from value ``STEP x t``
   on (cyclically). Classes that agree on its first ``STEP`` values form a
   region; single regions end here, before any label is moved.
3. First candidates are neighbours in a region's order (their common prefix is
   the longest) and the region's hub, the member that carries the region's
   commonest label in most trees. A crowded region is cut at deeper prefixes
   until a cut is small enough to be ordered by one task.
   Each class keeps its best neighbour and its best hub by signature (pairs
   whose signatures lie ``SLACK`` standard deviations below the similarity go).
4. Candidates are confirmed on full sets; confirmed links give components.
5. What is left is compared without a limit: in every group of regions of one
   hub that still holds several components, the members outside the largest one
   are compared, in blocks, with all members, exactly: both sets are given by
   their differences from the hub's set, which are small and whose exclusive or
   is the difference of the two sets. Only links that connect components leave
   a task; with them the components are final.

So a link between two classes can be missed only if no tree puts them in one
region: (1 - s**STEP)**TREES, 2e-8 at s = 0.85 and 4e-6 at 0.8.

Scale: texts are shuffled once, and only against the ids of classes in shared
regions; step 3 moves two pairs per class at most, step 5 one row per class, hub
and block. Hot keys (a set of copies, a hub, a region) meet
combinable aggregates, joins that adaptive execution splits, or a broadcast of
proven size (``common.join_groups``). Intermediate results are tables in the
shared folder, so a lost executor costs a re-read.

Defined results: null texts and texts without words have an empty set, link
with nothing and keep their own doc_id; rows that repeat a doc_id with an equal
set are one document (the stage keeps one); null doc_ids take part but never
name a component that has another id; extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, join_groups, slices
from tidemark.session import materialize

WORDS, SIMILARITY = 5, 0.8
TREES, STEP, DEPTH = 24, 4, 16
HASHES = TREES * STEP
SLACK = 4.5
CROWD = 10_000  # members of a region that one task orders
BLOCK, PART = 256, 512  # left-over members and members of a group that one task compares with one another
_U = np.uint64


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 63, n, dtype=np.uint64) * _U(2) + _U(1)


_MUL, _ADD = _odd(11, HASHES), _odd(12, HASHES)
_WORD_MUL = _odd(13, 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


class _WordHash(dict):
    """64-bit hash per word, remembered up to a bound."""

    def __missing__(self, word):
        if len(self) > 500_000:
            self.clear()
        out = self[word] = xxhash.xxh64_intdigest(word)
        return out


def shingle_sets(texts: list[str | None], words: int, known: _WordHash) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text: A-Z lowered, words ``[^\\x20\\x09-\\x0D]+``;
    a text of fewer words is one shingle, without words it is empty."""
    cut = [t.encode("utf-8", "surrogatepass").lower().split() if t else [] for t in texts]
    sizes = np.array([len(c) for c in cut], np.int64)
    flat = np.fromiter((known[w] for c in cut for w in c), np.uint64, int(sizes.sum()))
    n = len(flat)
    rolled = np.zeros(max(0, n - words + 1), np.uint64)
    for j in range(words):
        if len(rolled):
            rolled += _mix(flat[j : j + len(rolled)] + _U(j)) * _WORD_MUL[j]
    rolled = _mix(rolled)
    out, at = [], 0
    for size in sizes.tolist():
        if size >= words:
            out.append(np.unique(rolled[at : at + size - words + 1]))
        elif size:
            whole = _U(size)
            few = flat[at : at + size]
            with np.errstate(over="ignore"):
                for j in range(size):
                    whole = whole * _U(0x9E3779B97F4A7C15) + few[j]
            out.append(_mix(np.array([whole], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
        at += size
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values, one row of ``HASHES`` uint32 per non-empty set."""
    sizes = np.array([len(s) for s in sets], np.int64)
    starts = np.cumsum(sizes) - sizes
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    out = np.empty((len(sets), HASHES), np.uint32)
    for k in range(HASHES):
        out[:, k] = np.minimum.reduceat(flat * _MUL[k] + _ADD[k], starts) >> _U(32)
    return out


def _signed(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, key, sig) per row; key and sig are null without words."""

    def run(batches):
        known = _WordHash()
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part.column(1).to_pylist(), words, known)
                full = [i for i, s in enumerate(sets) if len(s)]
                keys, sigs = [None] * len(sets), [None] * len(sets)
                if full:
                    rows = signatures([sets[i] for i in full])
                    for i, row in zip(full, rows, strict=True):
                        keys[i] = xxhash.xxh3_128_digest(sets[i].tobytes())
                        sigs[i] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(sigs, pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "key", "sig"],
                )

    return bounded_batches(docs).mapInArrow(run, "doc_id bigint, n_shingles bigint, key binary, sig binary")


def _sig_matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def _region_ids(sig: np.ndarray) -> np.ndarray:
    """Region of every class in every tree (rows x TREES), the tree included in the id."""
    steps = sig.reshape(-1, TREES, STEP).astype(np.uint64)
    out = np.repeat(np.arange(1, TREES + 1, dtype=np.uint64)[None, :], len(sig), 0)
    for j in range(STEP):
        out = _mix(out * _U(0x9E3779B97F4A7C15) + steps[:, :, j])
    return out.astype(np.int64)


def _regions(classes: DataFrame) -> DataFrame:
    """(region, key), a row per class and tree."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1 << 20):
                ids = _region_ids(_sig_matrix(part.column(1)))
                at = pa.array(np.repeat(np.arange(part.num_rows), TREES))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids.ravel()), part.column(0).take(at)], names=["region", "key"]
                )

    return bounded_batches(classes.select("key", "sig")).mapInArrow(run, "region bigint, key binary")


def _labels(classes: DataFrame, shared: DataFrame) -> DataFrame:
    """(region, members, key, n, label, mini) for the classes of shared regions."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1 << 20):
                sig = _sig_matrix(part.column(2))
                wanted = part.column(3).to_pylist()
                ids = _region_ids(sig)
                mini = (sig & 0xFF).astype(np.uint8)
                row, region, members, label = [], [], [], []
                cyclic = np.concatenate([sig, sig[:, : DEPTH - STEP]], 1)
                for i, held in enumerate(wanted):
                    tree_of = {int(r): t for t, r in enumerate(ids[i])}
                    for w in held:
                        t = tree_of.get(w["region"])
                        if t is None:
                            continue
                        row.append(i)
                        region.append(w["region"])
                        members.append(w["members"])
                        label.append(cyclic[i, t * STEP : t * STEP + DEPTH].astype(">u4").tobytes())
                at = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(region, pa.int64()),
                        pa.array(members, pa.int64()),
                        part.column(0).take(at),
                        part.column(1).take(at),
                        pa.array(label, pa.binary()),
                        pa.array([m.tobytes() for m in mini], pa.binary()).take(at),
                    ],
                    names=["region", "members", "key", "n", "label", "mini"],
                )

    held = shared.groupBy("key").agg(F.collect_list(F.struct("region", "members")).alias("held"))  # TREES at most
    rows = classes.join(held, "key").select("key", "n", "sig", "held")
    return bounded_batches(rows).mapInArrow(run, "region bigint, members bigint, key binary, n bigint, label binary, mini binary")


def _agreement(pairs: DataFrame, floor: float) -> DataFrame:
    """(a, b, est) of the pairs (a, mini_a, b, mini_b) whose signatures agree in ``floor`` of their values."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, HASHES)
            y = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(-1, HASHES)
            est = (x == y).mean(1)
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(est, pa.float64())], names=["a", "b", "est"]
            )
            yield out.filter(pa.array(est >= floor))

    return bounded_batches(pairs).mapInArrow(run, "a binary, b binary, est double")


def _may_link(n_a, n_b, similarity: float):
    """Sets can only be this similar if their sizes are."""
    return F.least(n_a, n_b) >= F.lit(similarity - 1e-9) * F.greatest(n_a, n_b)


def _hubs(labels: DataFrame) -> DataFrame:
    """(region, hub): the member that carries its regions' commonest label in most trees stands in the middle."""
    common = (
        labels.groupBy("region", "label")
        .agg(F.count(F.lit(1)).alias("c"))
        .groupBy("region")
        .agg(F.max(F.struct("c", "label")).getField("label").alias("label"))
    )
    central = labels.join(common, ["region", "label"], "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("trees"))
    return labels.join(central, "key").groupBy("region").agg(F.max(F.struct("trees", "key", "mini", "n")).alias("hub"))


def _first_pairs(labels: DataFrame, hubs: DataFrame, similarity: float, floor: float) -> DataFrame:
    """Two candidates per class at most: the best neighbour in any order and the best hub."""
    from pyspark.sql import Window

    crowded = F.col("members") > CROWD
    cut = F.when(crowded, F.xxhash64(F.substring("label", 1, 4 * 2 * STEP))).otherwise(F.lit(0).cast("long"))
    ordered = labels.withColumn("cut", cut)
    deep = (
        ordered.where(crowded)
        .groupBy("region", "cut")
        .agg(F.count(F.lit(1)).alias("deep"))
        .where(F.col("deep") > CROWD)
    )
    # beyond that depth the whole label cuts, and equal labels are dealt by key: their hub joins them
    whole = F.xxhash64("label", F.pmod(F.xxhash64("key"), F.ceil(F.col("deep") / CROWD)))
    ordered = ordered.join(deep, ["region", "cut"], "left").withColumn(
        "cut", F.when(F.col("deep").isNull(), F.col("cut")).otherwise(whole)
    )
    w = Window.partitionBy("region", "cut").orderBy("label", "key")
    neighbours = ordered.select(
        F.col("key").alias("a"),
        F.col("mini").alias("mini_a"),
        F.col("n").alias("n_a"),
        F.lag("key").over(w).alias("b"),
        F.lag("mini").over(w).alias("mini_b"),
        F.lag("n").over(w).alias("n_b"),
    ).where("b IS NOT NULL")
    centre = hubs.select("region", *[F.col(f"hub.{c}").alias(d) for c, d in (("key", "b"), ("mini", "mini_b"), ("n", "n_b"))])
    star = labels.select("region", F.col("key").alias("a"), F.col("mini").alias("mini_a"), F.col("n").alias("n_a")).join(
        centre, "region"
    ).where("a <> b")
    near, star = (
        _agreement(
            d.where(_may_link(F.col("n_a"), F.col("n_b"), similarity)).select("a", "mini_a", "b", "mini_b"), floor
        )
        for d in (neighbours, star)
    )
    both = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "est"))
    best = [d.groupBy("a").agg(F.max(F.struct("est", "b")).getField("b").alias("b")) for d in (both, star)]
    return _unordered(best[0].unionByName(best[1]))


def _unordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _differences(rows: DataFrame, groups: DataFrame, sets: DataFrame) -> DataFrame:
    """``rows`` (hub, key, parts, ...) with ``n``, the size of the class's set, and ``delta``, its symmetric difference
    with the hub's set. The hubs of ``groups`` (hub, parts) go out once per part, so a hot hub's rows are spread."""
    keep = [c for c in rows.columns if c not in ("hub", "key")]
    centres = groups.select("hub", "parts").join(sets.select(F.col("key").alias("hub"), F.col("set").alias("centre")), "hub")
    centres = centres.select("hub", "centre", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"))
    own = rows.join(sets.withColumnRenamed("set", "own"), "key")
    own = own.withColumn("salt", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    both = own.join(centres, ["hub", "salt"])

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                n, delta = [], []
                for x, h in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    x, h = np.frombuffer(x, np.uint64), np.frombuffer(h, np.uint64)
                    n.append(len(x))
                    delta.append(np.setxor1d(x, h, assume_unique=True).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(delta, pa.binary()), *part.columns[4:]],
                    names=["hub", "key", "n", "delta", *keep],
                )

    kinds = dict(rows.dtypes)
    schema = "hub binary, key binary, n bigint, delta binary" + "".join(f", {c} {kinds[c]}" for c in keep)
    return bounded_batches(both.select("hub", "key", "own", "centre", *keep)).mapInArrow(run, schema)


class _Queries:
    """A block of left-over members, to be compared with rows of their hub's group."""

    def __init__(self):
        self.keys: list[bytes] = []
        self.comp: list[int] = []
        self.n: list[int] = []
        self.deltas: list[np.ndarray] = []
        self.root: dict[int, int] = {}
        self.index = None

    def add(self, keys, comp, n, deltas):
        self.keys += keys
        self.comp += comp
        self.n += n
        self.deltas += deltas

    def _find(self, c: int) -> int:
        while self.root.get(c, c) != c:
            c = self.root[c]
        return c

    def links(self, keys, comp, n, deltas, percent: int) -> list[tuple[bytes, bytes]]:
        """Links with the rows that connect components not yet connected here: with D the difference from the hub,
        two sets differ in D(x) xor D(y), so their intersection is exact without the sets themselves."""
        if self.index is None:
            sizes = np.array([len(d) for d in self.deltas], np.int64)
            flat = np.concatenate(self.deltas)
            by = np.argsort(flat, kind="stable")
            self.index = (sizes, flat[by], np.repeat(np.arange(len(sizes)), sizes)[by], np.array(self.n), np.array(self.comp))
        sizes, elements, owner, q_n, q_comp = self.index
        x_sizes = np.array([len(d) for d in deltas], np.int64)
        flat = np.concatenate(deltas)
        x_of = np.repeat(np.arange(len(deltas)), x_sizes)
        lo, hi = np.searchsorted(elements, flat, "left"), np.searchsorted(elements, flat, "right")
        hits = hi - lo
        at = np.repeat(lo - (np.cumsum(hits) - hits), hits) + np.arange(int(hits.sum()))
        cell = owner[at] * len(deltas) + np.repeat(x_of, hits)
        common = np.bincount(cell, minlength=len(sizes) * len(deltas)).reshape(len(sizes), len(deltas))
        x_n, x_comp = np.array(n), np.array(comp)
        differ = sizes[:, None] + x_sizes[None, :] - 2 * common
        total = q_n[:, None] + x_n[None, :]
        ok = 100 * (total - differ) >= percent * (total + differ)
        ok &= q_comp[:, None] != x_comp[None, :]
        out = []
        for i, j in zip(*(v.tolist() for v in np.nonzero(ok)), strict=True):
            a, b = self._find(self.comp[i]), self._find(comp[j])
            if a != b:
                self.root[a] = b
                out.append((self.keys[i], keys[j]))
        return out


def _rest_links(labels: DataFrame, hubs: DataFrame, comps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components that share a region: left-over members against all, group by group.

    The regions of one hub are one group, so a pair is compared once whatever number of trees holds it. Only links
    that connect components leave a task, never the compared pairs.
    """
    members = (
        labels.select("region", "key")
        .join(hubs.select("region", F.col("hub.key").alias("hub")), "region")
        .select("hub", "key")
        .distinct()
        .join(comps, "key")
        .withColumn("comp", F.xxhash64("comp"))
    )
    members = materialize(members)
    open_groups = (
        members.groupBy("hub", "comp")
        .agg(F.count(F.lit(1)).alias("c"))
        .groupBy("hub")
        .agg(F.count(F.lit(1)).alias("k"), F.sum("c").alias("m"), F.max(F.struct("c", "comp")).alias("top"))
        .where("k > 1")
        .select(
            "hub",
            F.col("top.comp").alias("major"),
            F.ceil((F.col("m") - F.col("top.c")) / BLOCK).cast("int").alias("blocks"),
            F.ceil(F.col("m") / PART).cast("int").alias("parts"),
        )
    )
    open_groups = materialize(open_groups)
    rows = materialize(_differences(members.join(open_groups, "hub"), open_groups, sets))
    cols = ["hub", "block", "part", "key", "n", "delta", "comp"]
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    queries = rows.where("comp <> major").withColumn("block", dealt("blocks")).withColumn("part", numbers("parts"))
    against = rows.withColumn("part", dealt("parts")).withColumn("block", numbers("blocks"))
    cells = (
        queries.select(*cols, F.lit(0).alias("side"))
        .unionByName(against.select(*cols, F.lit(1).alias("side")))
        .repartition("hub", "block", "part")
        .sortWithinPartitions("hub", "block", "part", "side")
    )

    def run(batches):
        group, held = None, _Queries()
        for batch in batches:
            for part in slices(batch, 1 << 20):
                names = list(zip(*(part.column(c).to_pylist() for c in (0, 1, 2, 7)), strict=True))
                cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    if names[a][:3] != group:
                        group, held = names[a][:3], _Queries()
                    piece = part.slice(a, b - a)
                    keys, n, deltas, comp = (piece.column(c).to_pylist() for c in (3, 4, 5, 6))
                    x = (keys, comp, n, [np.frombuffer(d, np.uint64) for d in deltas])
                    if names[a][3] == 0:
                        held.add(*x)
                    elif held.keys and (found := held.links(*x, percent)):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.binary())],
                            names=["a", "b"],
                        )

    return _unordered(bounded_batches(cells).mapInArrow(run, "a binary, b binary"))


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(key, set) of the wanted classes, from the text of one document each."""

    def run(batches):
        known = _WordHash()
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part.column(1).to_pylist(), words, known)
                keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                out = pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(keys, pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["key", "own", "set"],
                )
                match = [w == k for w, k in zip(part.column(0).to_pylist(), keys, strict=True)]
                yield out.filter(pa.array(match, pa.bool_())).select(["key", "set"])

    named = wanted.select("rep", "key")
    texts = docs.join(named, F.col("doc_id").eqNullSafe(F.col("rep")))
    found = bounded_batches(texts.select("key", "text")).mapInArrow(run, "key binary, set binary")
    return found.groupBy("key").agg(F.first("set").alias("set"))


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs with 100 x intersection >= percent x union."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                ok = []
                for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(100 * both >= percent * (len(x) + len(y) - both))
                yield part.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    with_a = pairs.join(sets.select(F.col("key").alias("a"), F.col("set").alias("set_a")), "a")
    both = with_a.join(sets.select(F.col("key").alias("b"), F.col("set").alias("set_b")), "b")
    return bounded_batches(both.select("a", "b", "set_a", "set_b")).mapInArrow(run, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """(key, comp) for every key of ``links`` (a, b): comp is the least key connected with it.

    Labels take the least label of their neighbours and then their label's label, so the number of
    rounds is about the logarithm of a component's diameter. Every round is a table in the shared folder.
    """
    edges = materialize(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = materialize(edges.groupBy(F.col("a").alias("key")).agg(F.least(F.min("a"), F.min("b")).alias("comp")))
    while True:
        low = (
            edges.join(labels.select(F.col("key").alias("b"), "comp"), "b")
            .groupBy(F.col("a").alias("key"))
            .agg(F.min("comp").alias("low"))
        )
        near = materialize(labels.join(low, "key").select("key", "comp", F.least("comp", "low").alias("root")))
        # what a label names may itself have come by a lower one, from its own neighbours or another member's
        hooks = near.groupBy(F.col("comp").alias("root")).agg(F.min("root").alias("hook"))
        up = materialize(
            near.select(F.col("key").alias("root"), F.col("root").alias("own"))
            .join(hooks, "root", "left")
            .select("root", F.least("own", F.coalesce("hook", "own")).alias("up"))
            .where("up < root")
        )
        step = materialize(
            near.join(up, "root", "left").select("key", F.coalesce("up", "root").alias("comp"), F.col("comp").alias("was"))
        )
        labels = step.select("key", "comp")
        if step.where("comp <> was").isEmpty():
            return labels


def _judged(docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """A row per row: doc_id, n_shingles, key (of its class), comp (of its component), component_id, class_size."""
    percent = round(100 * similarity)
    floor = max(0.0, similarity - SLACK * math.sqrt(similarity * (1 - similarity) / HASHES))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = materialize(_signed(slim, words))
    classes = materialize(
        rows.where("key IS NOT NULL")
        .groupBy("key")
        .agg(
            F.min("doc_id").alias("rep"),
            F.count(F.lit(1)).alias("size"),
            F.first("n_shingles").alias("n"),
            F.first("sig").alias("sig"),
        )
    )
    regions = _regions(classes)
    counts = regions.groupBy("region").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = materialize(regions.join(counts, "region"))
    wanted = classes.join(shared.select("key").distinct(), "key").select("rep", "key")
    labels = materialize(_labels(classes.select("key", "n", "sig"), shared))
    sets = materialize(_sets(slim, wanted, words))

    hubs = materialize(_hubs(labels))
    links = materialize(_confirm(materialize(_first_pairs(labels, hubs, similarity, floor)), sets, percent))
    comps = components(links)
    every = materialize(
        sets.select("key").join(comps, "key", "left").select("key", F.coalesce("comp", "key").alias("comp"))
    )
    rest = materialize(_rest_links(labels, hubs, every, sets, percent))
    if not rest.isEmpty():
        comps = components(links.unionByName(rest))

    final = (
        classes.select("key", "rep", "size").join(comps, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    )
    lowest = final.groupBy("comp").agg(F.min("rep").alias("component_id"))
    verdict = materialize(
        final.join(lowest, "comp").select("key", "comp", F.col("size").alias("class_size"), "component_id")
    )
    ids = rows.select("doc_id", "n_shingles", "key")
    full = join_groups(ids.where("key IS NOT NULL"), verdict, "key", "class_size", rows.count())
    empty = ids.where("key IS NULL").select(
        "*",
        F.lit(None).cast("binary").alias("comp"),
        F.lit(1).cast("long").alias("class_size"),
        F.col("doc_id").alias("component_id"),
    )
    return full.unionByName(empty)


def near_duplicates(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, class_size (rows with an equal set).

    ``similarity`` is taken in whole percent. ``component_id`` is the smallest doc_id reachable.
    """
    return _judged(docs, words, similarity).select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        "class_size",
    )


def _keyed(docs: DataFrame, words: int, name: str) -> DataFrame:
    """``docs`` with the key of its set in column ``name``."""
    from pyspark.sql import types as T

    at = docs.columns.index("text")

    def run(batches):
        known = _WordHash()
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part.column(at).to_pylist(), words, known)
                keys = pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, keys], names=[*part.schema.names, name])

    return bounded_batches(docs).mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.BinaryType())]))


def drop_near_copies(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns: one document of each group."""
    mark, key, comp = "__near_id", "__near_key", "__near_comp"
    found = materialize(_judged(docs, words, similarity).select("doc_id", "key", "comp", "component_id"))
    stays = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    per_id = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c"))
    repeated = materialize(per_id.where("c > 1").select(F.col("doc_id").alias(mark)))
    once = stays.join(repeated, F.col("doc_id").eqNullSafe(F.col(mark)), "left_anti").select(F.col("doc_id").alias(mark))
    out = docs.join(once, docs["doc_id"].eqNullSafe(once[mark]), "left_semi")
    if not repeated.isEmpty():
        # an id of several rows does not name one text: those rows are matched by their set too
        rows = docs.join(repeated, docs["doc_id"].eqNullSafe(repeated[mark]), "left_semi")
        named = stays.select(F.col("doc_id").alias(mark), F.col("key").alias("__near_k"), F.col("comp").alias(comp)).distinct()
        keyed = _keyed(rows, words, key)
        again = keyed.join(
            named, keyed["doc_id"].eqNullSafe(named[mark]) & keyed[key].eqNullSafe(named["__near_k"])
        ).dropDuplicates([mark, comp])
        out = out.unionByName(again.select(*docs.columns))
    return out.select(*docs.columns)


def brute_force(texts: dict[int, str | None], words: int, similarity: float) -> dict[int, tuple[int, int]]:
    """doc_id -> (n_shingles, component_id), by comparing all pairs of word tuples (for tests)."""
    sets = {}
    for i, t in texts.items():
        ws = t.encode().lower().split() if t else []
        sets[i] = (
            {tuple(ws[j : j + words]) for j in range(len(ws) - words + 1)} if len(ws) >= words else {tuple(ws)} if ws else set()
        )
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * 100 >= round(100 * similarity) * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= round(100 * similarity) * (len(a) + len(b) - both):
                    lo, hi = sorted((find(i), find(j)))
                    root[hi] = lo
    return {i: (len(sets[i]), find(i)) for i in ids}
