import random
import zlib

import numpy as np
import pytest

from keyflow.llm import quality, toxicity
from keyflow.llm.decontaminate import Index, best_end, drop_contaminated, find_items, words_of

from .conftest import WORDS, prose


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_bit_vectors_give_the_edit_distance():
    rng = random.Random(2)
    for _ in range(150):
        p = [rng.randrange(1, 5) for _ in range(rng.randrange(1, 12))]
        t = [rng.randrange(0, 5) for _ in range(rng.randrange(0, 18))]
        want = min((edit_distance(p, t[i:j]) for i in range(len(t) + 1)
                    for j in range(i, len(t) + 1)), default=len(p))
        assert best_end(Index._masks(np.array(p)), len(p), t)[0] == min(want, len(p))


def test_items_are_found_through_edits():
    rng = random.Random(4)
    items = [(k, prose(rng.randrange(14, 60), 900 + k)) for k in range(60)]
    index = Index(items)
    found = clean = 0
    for k, text in items:
        w = text.split()
        for _ in range(int(0.2 * len(w))):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        host = prose(200, 5000 + k).split()
        at = rng.randrange(len(host))
        hits = list(index.search([" ".join(host[:at] + w + host[at:]), " ".join(host)]))
        found += any(h[0] == 0 and h[1] == k for h in hits)
        clean += not any(h[0] == 1 for h in hits)
    assert found >= 0.95 * len(items) and clean == len(items)


def test_decontaminate_reports_the_best_place(llm, odd_docs, no_docs):
    item = prose(25, 7777)
    bench = llm.createDataFrame([(1, item), (2, None), (3, ""), (4, "?!"), (1, item)],
                                "item_id long, text string")
    host = prose(50, 78)
    docs = llm.createDataFrame(
        [(1, f"{host} {item.upper()}, {host}"), (2, host), (3, None), (None, item), (1, item)],
        "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["item_id"], r["first_word"], r["end_word"],
                  r["edit_distance"]) for r in find_items(docs, bench).collect())
    # the repeated item is reported each time
    assert got == sorted([("1", 1, 50, 75, 0)] * 2 + [("None", 1, 0, 25, 0)] * 2
                         + [("1", 1, 0, 25, 0)] * 2)
    assert [r["doc_id"] for r in drop_contaminated(docs, bench).orderBy("doc_id").collect()] == [2, 3]
    out = drop_contaminated(odd_docs, bench)
    assert out.schema == odd_docs.schema and out.count() == odd_docs.count()
    assert find_items(no_docs, bench).count() == 0
    assert find_items(docs, bench.limit(0)).count() == 0
    assert drop_contaminated(docs, bench.limit(0)).count() == 5


def test_chain_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    counts = np.array([3, 1, 4])
    unary, pair = rng.normal(size=8), rng.normal(size=(2, 2))
    p, pairs = quality.Chains(counts).marginals(unary, pair)
    start, total = 0, np.zeros((2, 2))
    for n in counts:
        weights, good = [], []
        for y in np.ndindex(*([2] * n)):
            s = sum(unary[start + t] * y[t] for t in range(n)) + sum(
                pair[y[t], y[t + 1]] for t in range(n - 1))
            weights.append(np.exp(s))
            good.append(y)
        weights = np.array(weights) / sum(weights)
        for t in range(n):
            assert abs(p[start + t] - sum(w for w, y in zip(weights, good) if y[t])) < 1e-9
            if t + 1 < n:
                for w, y in zip(weights, good):
                    total[y[t], y[t + 1]] += w
        start += n
    assert np.allclose(pairs, total)


@pytest.fixture(scope="module")
def sf(llm):
    read = lambda t: llm.read.parquet(f"/root/testdata/sf0.1/{t}.parquet")
    return read("documents"), read("labels")


def held(rows, labels, name, folds, fold):
    y = {r["doc_id"]: r[name] for r in labels.collect()}
    out = [(r["score"], y[r["doc_id"]], r) for r in rows
           if r["doc_id"] in y and zlib.crc32(str(r["doc_id"]).encode()) % folds == fold]
    assert all(r["held_out"] for _, _, r in out)
    return out


def test_quality_on_held_out_labels(sf):
    docs, labels = sf
    rows = quality.score_quality(docs, quality.fit_quality(docs, labels)).collect()
    assert len(rows) == docs.count()
    out = held(rows, labels, "quality", 5, 0)
    assert np.mean([(s >= 0.3) == (y == 1) for s, y, _ in out]) > 0.97
    assert np.mean([s >= 0.3 for s, y, _ in out if y == 1]) > 0.98


def test_toxicity_on_held_out_labels(sf):
    docs, labels = sf
    rows = toxicity.score_toxicity(docs, labels).collect()
    assert len(rows) == docs.count()
    out = held(rows, labels, "toxic", 4, 2)
    assert np.mean([s < 0.3 for s, y, _ in out if y == 0]) > 0.98
    english = [s for s, y, r in out if y == 1 and r["score"] is not None]
    assert np.mean([s >= 0.3 for s in english]) > 0.6
    assert all(len(r["neighbours"]) == len(r["similarities"]) <= toxicity.K for r in rows)


def test_block_max_is_exact():
    rng = np.random.default_rng(3)
    examples = []
    for k in range(500):
        ids = np.sort(rng.choice(40, size=int(rng.integers(1, 8)), replace=False))
        examples.append((k, ids, toxicity.weights(ids, rng.integers(1, 4, len(ids)).astype(float),
                                                  np.ones(40)), k % 2))
    index = toxicity.BlockMaxIndex(examples, 40, block=16)
    dense = np.zeros((500, 40))
    for k, ids, w, _ in examples:
        dense[k, ids] = w
    for _ in range(60):
        ids = np.sort(rng.choice(40, size=4, replace=False))
        q = toxicity.weights(ids, np.ones(4), np.ones(40))
        cos = dense[:, ids] @ q
        want = sorted(((-round(c, 12), k) for k, c in enumerate(cos) if c > 0))[:10]
        rows, scores = index.nearest(ids, q, 10)
        assert [(-round(s, 12), int(index.ids[r])) for r, s in zip(rows, scores)] == want


@pytest.mark.parametrize("score", [
    lambda d, x: quality.score_quality(d, quality.fit_quality(d, x)), toxicity.score_toxicity])
def test_classifier_edges(odd_docs, no_docs, labels, score):
    rows = score(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    by_text = {}
    for r, d in zip(sorted(rows, key=lambda r: str(r["doc_id"])),
                    sorted(odd_docs.collect(), key=lambda r: str(r["doc_id"]))):
        by_text.setdefault(r["doc_id"], set()).add(r["score"])
    assert by_text[3] == by_text[4] and len(by_text[2]) == 1
    assert score(no_docs, labels).count() == 0
    assert len(score(odd_docs, labels.limit(0)).collect()) == odd_docs.count()


def test_rejected_documents_go(odd_docs, no_docs, labels):
    out = quality.drop_rejected(odd_docs, labels)
    assert out.schema == odd_docs.schema
    scores = quality.score_quality(odd_docs, quality.fit_quality(odd_docs, labels))
    assert out.count() == scores.filter("predicted = 1").count()
    assert quality.drop_rejected(no_docs, labels).count() == 0


def test_words():
    assert words_of(None) == [] and words_of("A, b\nC!") == ["a", "b", "c"]
