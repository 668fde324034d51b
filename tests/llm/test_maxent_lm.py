import math
import zlib
from collections import Counter

import numpy as np
import pytest

from keyflow.llm import maxent_lm as lm
from keyflow.llm.queries import op12_maxent_lm

SF = "/root/testdata/sf0.01"


def tokens(text):
    return (text or "").encode().lower().split() + [lm.END]


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7


def counted(rows):
    """Per row (doc_id, held, tokens, known, N, base), counted again in Python."""
    c = Counter(t for i, text in rows if fold(i) != 2 for t in tokens(text))
    n, v = sum(c.values()), len(c)
    return sorted((str(i), fold(i) == 2, len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n,
                   round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t)), 5))
                  for i, t in rows)


def returned(df):
    return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                   round(r.base_score, 5)) for r in df)


@pytest.fixture(scope="module")
def scored(llm):
    return op12_maxent_lm(llm, SF).collect()


def near(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x[:-1] == y[:-1] and abs(x[-1] - y[-1]) <= 1e-4


def test_counts_and_base_match(llm, scored):
    rows = [(r.doc_id, r.text) for r in llm.read.parquet(f"{SF}/documents.parquet").collect()]
    near(returned(scored), counted(rows))


def test_held_out_texts_are_likelier_than_by_counts_alone(scored):
    held = [r for r in scored if r.held_out]
    n = sum(r.n_tokens for r in held)
    assert sum(r.score for r in held) / n > sum(r.base_score for r in held) / n + 0.1
    assert sum(r.score > r.base_score for r in held) >= 0.9 * len(held)


def test_any_vocabulary_is_counted_exactly(llm, scored):
    """With few known words, or none, the others meet their counts in the join."""
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    for most in (300, 0):
        got = lm.score_documents(docs, most=most).collect()
        near(returned(got), returned(scored))


def test_probabilities_sum_to_one(llm):
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    counts = lm.count_words(docs)
    model, _ = lm.fit_model(docs)
    words = {bytes(r.word): r.c for r in counts.collect()}
    assert model.w.of_class.any() and model.w.in_class.any()
    for context in ([], [b"the"], [b"never-seen", b"of"]):
        total = 0.0
        v = model.v
        unseen = {lm.tail_class(w): w for w in (bytes([97, i]) * 3 for i in range(97, 123))
                  if w not in words}
        for batch in ([*words], [*unseen.values()]):
            ids = [lm.token_ids(b" ".join(context).decode(), v)[:-1]] * len(batch)
            last = [v.words.get(w, lm.KNOWN + lm.tail_class(w) - lm.HEAD_CLASSES) for w in batch]
            flat = np.concatenate([np.r_[c, x] for c, x in zip(ids, last)]).astype(np.int32)
            size = len(context) + 1
            p = model.log_probabilities(flat, np.arange(0, len(flat), size))[size - 1::size]
            for w, x in zip(batch, p):
                if w not in v.words:
                    x += math.log((words.get(w, 0) + 1) / v.mass[lm.tail_class(w)])
                total += math.exp(x)
        # classes none of whose unseen words stand in the list still hold their place
        classes = set(range(lm.HEAD_CLASSES, lm.CLASSES)) - set(unseen)
        for k in classes:
            flat = np.r_[lm.token_ids(b" ".join(context).decode(), v)[:-1],
                         lm.KNOWN + k - lm.HEAD_CLASSES].astype(np.int32)
            x = model.log_probabilities(flat, np.array([0]))[-1]
            total += math.exp(x) / v.mass[k]
        assert abs(total - 1) < 1e-3


def test_odd_rows(llm, odd_docs, no_docs):
    got = lm.score_documents(odd_docs).collect()
    near(returned(got), counted([(r.doc_id, r.text) for r in odd_docs.collect()]))
    assert all(r.score <= 0 for r in got)
    twins = {r.score for r in got if r.doc_id == 2}
    assert len(twins) == 1
    assert lm.score_documents(no_docs).count() == 0


def test_without_training_rows(llm):
    held = [i for i in range(100) if fold(i) == 2]
    docs = llm.createDataFrame([(i, "a b a") for i in held] + [(held[0], None)],
                               "doc_id long, text string")
    got = lm.score_documents(docs).collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in got} == {(0, 0, 0.0)}
    assert all(r.score < 0 for r in got)


def test_pieces_of_a_very_long_text(monkeypatch):
    text = " ".join(f"Wörd{i % 50}" for i in range(5000)) + "\tend\n"
    whole = text.encode().lower().split()
    monkeypatch.setattr(lm, "PIECE", 37)
    assert [w for p in lm.word_pieces(text) for w in p] == whole
    assert [w for p in lm.word_pieces("x" * 500) for w in p] == [b"x" * 500]


def test_first_sums_equal_the_softmax_at_zero_weights(llm):
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    v, _ = lm.fit_vocabulary(lm.count_words(docs))
    model = lm.Model(v, lm.Weights.zero())
    parts = [lm.token_ids(r.text, v) for r in docs.limit(40).collect()]
    flat, starts = np.concatenate(parts), np.cumsum([0, *map(len, parts[:-1])])
    short, full = lm.Sums(), lm.Sums()
    model.log_probabilities(flat, starts, short, True)
    short.expect_bias(model)
    model.log_probabilities(flat, starts, full)
    for table in (0, 1):
        assert (short.observed[table] == full.observed[table]).all()
        assert np.abs(short.expected[table] - full.expected[table]).max() < 1e-2
