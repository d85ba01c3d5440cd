"""Token counts and SentencePiece encoding against a plain dynamic programme."""

import os

import numpy as np
import pytest

from tidemark.llm import pieces, sentencepieces, token_counts

pytestmark = pytest.mark.skipif(not os.path.exists(pieces.MODEL_PATH), reason="no public vocabulary here")
ODD = ["", None, " ", "  a  b\n\n c\t▁x 中𝒳é\x00z", "x" * 3000, "ab" * 300, "\n", "Zażółć gęślą jaźń", "a b c"]


@pytest.fixture(scope="module")
def model():
    return pieces.load_pieces()


def plain(model, text):
    return [i for w in pieces.pretokens(text) for i in pieces.best_path(model, w)]


def test_unigram_library_finds_no_better_path(model):
    from tokenizers import Tokenizer, models

    vocab = [("<unk>", (model.fallback / pieces.WEIGHT))] + [(p, (v + 1) / pieces.WEIGHT) for p, (v, _) in model.value.items()]
    unigram = Tokenizer(models.Unigram(vocab, unk_id=0))
    score = dict(vocab)
    for word in (" the", " unbelievable", " Geschwindigkeit", "ing", " token", " antidisestablishment"):
        theirs = sum(score[t] for t in unigram.encode(word).tokens)
        names = {i: p for p, (_, i) in model.value.items()}
        assert sum(score[names[i]] for i in pieces.best_path(model, word)) == pytest.approx(theirs)


def test_counts_and_ids_are_the_programme(model, rows):
    texts = [r[1] for r in rows[:40]] + ODD
    encoder, trie = sentencepieces.SuffixEncoder(model), token_counts.ForwardTrie(model)
    ids, sizes = encoder.encode(texts)
    ends = np.cumsum(sizes)
    for text, size, end in zip(texts, sizes, ends, strict=True):
        want = plain(model, text)
        assert ids[end - size : end].tolist() == want
        assert sum(map(trie.count, pieces.pretokens(text))) == len(want)
    assert [t or "" for t in texts] == encoder.decode(ids, sizes)


def test_bounded_tables_change_nothing(model, rows):
    texts = [r[1] for r in rows[:30]]
    small = sentencepieces.SuffixEncoder(model, max_words=5)
    full = sentencepieces.SuffixEncoder(model)
    for k in range(0, 30, 10):
        assert np.array_equal(small.encode(texts[k : k + 10])[0], full.encode(texts[k : k + 10])[0])
    trie, free = token_counts.ForwardTrie(model, max_nodes=3), token_counts.ForwardTrie(model)
    for w in pieces.pretokens(texts[0]):
        assert trie.count(w) == free.count(w)


def test_reports(docs, odd_docs, no_docs, rows):
    counts = token_counts.token_counts(docs).collect()
    report = sentencepieces.encoding_report(odd_docs).collect()
    assert len(counts) == len(report) == len(rows)
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"])
    assert [r["n_tokens"] for r in sorted(counts, key=key)] == [r["n_tokens"] for r in sorted(report, key=key)]
    assert all(r["restored"] for r in report)
    assert token_counts.token_counts(no_docs).count() == sentencepieces.encoding_report(no_docs).count() == 0


def test_encode_then_decode_is_exact(odd_docs, no_docs, rows):
    encoded = sentencepieces.encode(odd_docs)
    assert [c for c in encoded.columns if c != "token_ids"] == [c for c in odd_docs.columns if c != "token_ids"]
    back = sentencepieces.decode(encoded, out_col="again").collect()
    assert len(back) == len(rows)
    assert all(r["again"] == r["text"] for r in back)
    assert all(r["token_ids"] is None for r in back if r["text"] is None)
    assert sentencepieces.decode(sentencepieces.encode(no_docs)).count() == 0


def test_unknown_ids_decode_to_nothing(spark):
    ids = spark.createDataFrame([([-5, 10**6],), (None,)], "token_ids array<int>")
    assert [r["text"] for r in sentencepieces.decode(ids).collect()] == ["", None]


def test_long_run_without_pieces_is_encoded_whole(model):
    letter = "ꦄ"  # Javanese, no piece of its own
    assert letter not in model.value
    long = letter * 10_000 + "ab"
    encoder = sentencepieces.SuffixEncoder(model)
    ids, sizes = encoder.encode([long, "the end"])
    assert ids[: sizes[0]].tolist() == plain(model, long)
    assert sizes[0] > 30_000
    assert encoder.decode(ids, sizes) == [long, "the end"]


def test_count_of_a_huge_pretoken_does_not_wrap(model):
    letter = "ꦄ"  # three bytes, no piece of its own
    n = (1 << 20) // 3 + 10
    assert token_counts.ForwardTrie(model).count(letter * n) == 3 * n
    assert token_counts.ForwardTrie(model).count(" " + letter * n) == 3 * n + 1
