"""The corpus pipeline against a plain version of its stages."""

import pytest

import corpus_pipeline as P
from tidemark.llm import decontamination, near_dedup


@pytest.fixture(scope="module")
def sf_dir(docs, bench, tmp_path_factory):
    d = tmp_path_factory.mktemp("tables")
    docs.write.parquet(f"{d}/documents.parquet")
    bench.write.parquet(f"{d}/benchmark.parquet")
    return str(d)


def plain(rows, items):
    """doc_ids that stay, in the pipeline's order of decisions."""
    rows = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    groups = {}
    for r in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1])
        best = groups.get(low)
        if best is None or (r[0] is not None and (best[0] is None or r[0] > best[0])):
            groups[low] = r
    rows = list(groups.values())
    texts = {i if r[0] is None else r[0]: r[1] for i, r in ((-1, r) for r in rows)}
    comp = near_dedup.brute_force(texts, 5, 0.8)
    rows = [r for r in rows if comp[-1 if r[0] is None else r[0]][1] == (-1 if r[0] is None else r[0])]
    return [r for r in rows if not decontamination.brute_force(r[1], items)[-1]]


def test_run_is_the_plain_version(spark, sf_dir, rows, bench):
    got = P.run(spark, sf_dir).collect()
    want = plain(rows, [tuple(r) for r in bench.collect()])
    assert sorted((str(r["doc_id"]), r["text"]) for r in got) == sorted((str(r[0]), r[1]) for r in want)
    assert all(r["restored"] and len(r["token_ids"]) > 0 for r in got)


def test_stages_keep_the_columns_of_documents(spark, sf_dir, docs, odd_docs):
    for name, stage in P.STAGES[:-1]:
        assert stage(spark, odd_docs, sf_dir).columns == odd_docs.columns, name
    assert [n for n, _ in P.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontamination", "sentencepiece"]


def test_stages_on_an_empty_table(spark, sf_dir, no_docs):
    for _, stage in P.STAGES:
        assert stage(spark, no_docs, sf_dir).count() == 0
