"""The suffix automaton against a window scan."""

import random

import pytest

from tidemark.llm import decontamination as D


def via(a, text):
    import hashlib

    n, spans, items, _ = a.scan(D.words(text))
    hit = sum(e - s for s, e in spans)
    return n, hit, len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), hit > 0 and 20 * hit >= n


@pytest.mark.parametrize("seed", range(60))
def test_automaton_on_small_alphabets(seed):
    rng = random.Random(seed)
    items = [(i, " ".join(rng.choice("ab" if seed % 2 else "abc") for _ in range(rng.randint(0, 9)))) for i in range(6)]
    a = D.Automaton(4).build([(str(i), [w for w in D.words(t) if w]) for i, t in items if t])
    for _ in range(5):
        text = " ".join(rng.choice("abd") for _ in range(40))
        assert via(a, text) == D.brute_force(text, items, 4)


def test_report_is_the_definition(docs, bench, rows):
    items = [tuple(r) for r in bench.collect()]
    cols = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    key = lambda r: tuple(str(x) for x in r)
    want = sorted(((r[0], *D.brute_force(r[1], items)) for r in rows), key=key)
    for shard in (D.SHARD_WORDS, 20):  # one pass, and several whose hits are united
        got = D.contamination_report(docs, bench, shard_words=shard).select(*cols).collect()
        assert sorted(map(tuple, got), key=key) == want
    assert any(r[-1] for r in want) and not all(r[-1] for r in want)


def test_stage_drops_contaminated_only(odd_docs, bench, rows):
    items = [tuple(r) for r in bench.collect()]
    bad = sum(D.brute_force(r[1], items)[-1] for r in rows)
    for shard in (D.SHARD_WORDS, 20):
        out = D.decontaminate(odd_docs, bench, shard_words=shard)
        assert out.columns == odd_docs.columns
        assert out.count() == len(rows) - bad


def test_long_spans_are_cut(spark, bench, rows):
    passage = bench.where("item_id = 0").first()["text"]
    clean = " ".join(f"word{i}" for i in range(900))
    docs = spark.createDataFrame([(1, f"Before, {passage}. After. {clean}")], "doc_id bigint, text string")
    got = D.decontaminate(docs, bench, max_span=15).collect()[0]["text"]
    assert got.startswith("Before, . After. word0") and got.endswith("word899")


def test_shards_do_not_change_what_is_cut(spark, odd_docs, bench):
    """Coverage and spans come from the union of all shards: 13 hit words of each of two items are 6.5 % of 400."""
    one, two = (" ".join(f"{c}{i}" for i in range(13)) for c in "ab")
    items = spark.createDataFrame([(1, one), (2, two)], "item_id bigint, text string")
    fill = " ".join(f"w{i}" for i in range(374))
    rows = [(1, f"{one} {fill} {two}"), (2, f"{one} and {fill} {fill}"), (3, fill), (4, None), (None, f"{one} {fill} {fill}")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    key = lambda df: sorted(map(str, df.collect()))
    want = key(D.decontaminate(docs, items, max_span=5))
    assert key(D.decontaminate(docs, items, max_span=5, shard_words=13)) == want and len(want) == 4
    assert any("and w0" in r and "a1 a2" not in r for r in want)
    whole = key(D.decontaminate(odd_docs, bench, max_span=15))
    assert key(D.decontaminate(odd_docs, bench, max_span=15, shard_words=20)) == whole


def test_empty_tables(spark, docs, no_docs, bench):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert D.contamination_report(no_docs, bench).count() == 0
    assert D.contamination_report(docs, none).where("n_hit > 0 OR contaminated").count() == 0
    assert D.decontaminate(docs, none).count() == docs.count()
