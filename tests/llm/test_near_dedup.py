"""The LSH forest against a comparison of all pairs."""

import random

import pytest

from tidemark.llm import near_dedup as N


@pytest.mark.parametrize(("words", "similarity"), [(3, 0.85), (5, 0.8)])
def test_components_are_those_of_all_pairs(docs, rows, words, similarity):
    once = {}
    for r in rows:
        once.setdefault(r[0], r[1])
    del once[None]
    want = N.brute_force(once, words, similarity)
    got = {r["doc_id"]: r for r in N.near_duplicates(docs.where("doc_id IS NOT NULL"), words, similarity).collect()}
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.values())


def test_star_of_copies_that_are_only_near_their_base(spark):
    """Copies that link with the base and not with one another, more than one block of a region."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(300)]
    texts = {0: " ".join(base)}
    for k in range(1, 400):
        copy = list(base)
        for at in rng.sample(range(300), 7):
            copy[at] = f"x{rng.random()}"
        texts[k] = " ".join(copy)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in N.near_duplicates(df, 3, 0.85).collect()}
    want = {i: c for i, (_, c) in N.brute_force(texts, 3, 0.85).items()}
    assert got == want and len(set(want.values())) < 400


def test_chain_of_copies(spark):
    """Each text is near the next one only; components follow the chain."""
    base = [f"w{i}" for i in range(200)]
    texts = {}
    for k in range(40):
        texts[k] = " ".join(base)
        base[(k * 5) % 200] = f"n{k}"
        base[(k * 5 + 1) % 200] = f"m{k}"
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in N.near_duplicates(df, 3, 0.85).collect()}
    assert got == {i: c for i, (_, c) in N.brute_force(texts, 3, 0.85).items()}


def test_null_ids_and_repeats(docs, rows):
    got = N.near_duplicates(docs, 3, 0.85).collect()
    assert len(got) == len(rows)
    assert sum(r["doc_id"] == 410 and r["kept"] for r in got) == 2
    assert {r["component_id"] for r in got if r["doc_id"] in (400, 401, 402)} == {400, 401, 402}


def test_stage_keeps_one_of_each_group(odd_docs, rows):
    comp = {i: c for i, (_, c) in N.brute_force({r[0]: r[1] for r in rows if r[0] is not None}, 3, 0.8).items()}
    out = N.drop_near_copies(odd_docs.where("doc_id IS NOT NULL"), words=3)
    assert out.columns == odd_docs.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert sorted(ids) == sorted(i for i, c in comp.items() if i == c)
    assert not set(ids) & set(range(201, 212)) and 6 in ids and 300 not in ids
    assert N.drop_near_copies(odd_docs.where("doc_id IS NULL")).count() == 2


def test_empty_table(no_docs):
    assert N.near_duplicates(no_docs).count() == 0
    assert N.drop_near_copies(no_docs).count() == 0


def test_components_of_links(spark):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(1, 60)] + [(100 + rng.randrange(40), 100 + rng.randrange(40)) for _ in range(50)]
    links = spark.createDataFrame([(f"{a:04d}".encode(), f"{b:04d}".encode()) for a, b in pairs if a != b], "a binary, b binary")
    got = {bytes(r["key"]): bytes(r["comp"]) for r in N.components(links).collect()}
    root = {k: k for k in got}

    def find(k):
        return k if root[k] == k else find(root[k])

    for r in links.collect():
        lo, hi = sorted((find(bytes(r["a"])), find(bytes(r["b"]))))
        root[hi] = lo
    assert got == {k: find(k) for k in root}
