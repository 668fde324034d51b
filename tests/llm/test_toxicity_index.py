"""The toxicity query against dense cosines, and the index's own parts."""
import numpy as np
from pyspark.sql import functions as F

from keyflow.llm import toxicity
from keyflow.llm.common import labelled_sample
from keyflow.llm.queries import op6_toxicity_knn
from keyflow.llm.shingles import shingle_set

SF = "/root/testdata/sf0.01"


def dense(llm):
    """{doc_id: (score, neighbours, cosines)} of every document by one dense product."""
    docs, labels = (llm.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    examples = sorted(set(labelled_sample(docs, labels, "toxic", 4, 2, toxicity.SAMPLE)))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    terms = lambda t: [x for w in toxicity.LETTERS.findall(t.lower())
                       for x in toxicity.terms_of(w)]
    place = {t: k for k, t in enumerate(sorted({x for e in examples for x in terms(e[1])}))}

    def counts(text):
        out = np.zeros(len(place))
        for t in terms(text):
            if t in place:
                out[place[t]] += 1
        return out

    q = np.stack([counts(t) for _, t in rows])
    e = np.stack([counts(t) for _, t, _ in examples])
    y = np.array([x[2] for x in examples], float)
    # texts that share one of their three smallest shingles with an earlier one do not count
    once, seen = np.zeros(len(y), dtype=bool), set()
    for k, (_, text, _) in enumerate(examples):
        own = shingle_set(text)[:3].tolist()
        once[k] = bool(own) and not seen & set(own)
        seen |= set(own)
    n, pos = once.sum(), y[once].sum()
    df, toxic = (e[once] > 0).sum(axis=0), (e[once & (y > 0)] > 0).sum(axis=0)
    over = toxic - df * pos / n
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = np.where((over > 0) & (df < n), over ** 2 * n ** 3. / (df * (n - df) * pos * (n - pos)), 0)
    idf = np.log((1 + len(rows)) / (1 + (q > 0).sum(axis=0))) + 1
    idf *= 1 + toxicity.SIGNAL * np.sqrt(chi)

    def unit(c):
        w = np.where(c > 0, 1 + np.log(np.maximum(c, 1)), 0) * idf
        return w / np.maximum(np.sqrt((w * w).sum(axis=1, keepdims=True)), 1e-300)

    cos = unit(q) @ unit(e).T
    out = {}
    for (doc_id, _), c in zip(rows, cos):
        best = np.lexsort((np.arange(len(y)), -np.round(c, 9)))[:toxicity.K]
        best = best[c[best] > 0]
        base = y.mean()
        out[doc_id] = ((c[best] @ y[best] + toxicity.PRIOR * base) / (c[best].sum() + toxicity.PRIOR),
                       [examples[k][0] for k in best], c[best])
    return out


def test_query_equals_dense_cosines(llm):
    want = dense(llm)
    got = op6_toxicity_knn(llm, SF).collect()
    assert len(got) == len(want)
    for r in got:
        score, near, cos = want[r.doc_id]
        if near:
            assert np.allclose(r.similarities, cos, atol=2e-6)
            assert abs(r.score - score) < 1e-6
            # the same neighbours, but for ties at the last place
            apart = set(r.neighbours) ^ set(near)
            assert all(abs(dict(zip(r.neighbours + near, [*r.similarities, *cos]))[i] - cos[-1]) < 2e-6
                       for i in apart)
    assert sum(bool(w[1]) for w in want.values()) > 900


def test_most_pairs_of_query_and_block_are_pruned():
    """Reported share of (query, block) pairs that are scored, on texts of a few topics."""
    rng = np.random.default_rng(4)
    idf = np.ones(400)

    def text(topic):
        own = rng.choice(100, size=20, replace=False) + 100 * topic
        return np.sort(own), np.ones(20)

    examples = [(k, *(lambda t: (t[0], toxicity.weights(*t, idf), k % 2))(text(k % 4))) for k in range(800)]
    index = toxicity.BlockMaxIndex(examples, 400, block=16, common=400)
    queries = [(i, toxicity.weights(i, c, idf)) for i, c in (text(k % 4) for k in range(64))]
    index.nearest_of(queries, 5)
    assert index.scored <= 0.3 * index.asked


def test_ids_of_any_type(llm, labels):
    words = "river stone maple winter copper lantern".split()
    rows = [(f"id-{k}", " ".join(words[k % 3:k % 3 + 3])) for k in range(60)]
    docs = llm.createDataFrame(rows, "doc_id string, text string")
    marks = docs.select("doc_id", F.col("text").contains("river").cast("int").alias("toxic"))
    got = toxicity.score_toxicity(docs, marks).collect()
    assert len(got) == 60 and all(set(r.neighbours) <= {i for i, _ in rows} for r in got)
    assert {r.predicted for r in got if "river" in dict(rows)[r.doc_id]} == {1}


def test_packed_numbers():
    for numbers in ([], [0], [255], [256, 1], [65_535], [65_536, 0, 7], [1 << 31]):
        x = np.array(numbers, dtype=np.int64)
        assert (toxicity.unpacked(toxicity.packed(x)) == x).all()


def test_words_are_cut_alike_in_bytes_and_by_pattern():
    for text in ("Ab cd_ef 12x", "“Curly” quotes—and dashes…", "Größe ÜBER été", "a b c", "漢字 かな",
                 "x́y", "ⅷ²½", ""):
        want = [w.encode() for w in toxicity.LETTERS.findall(text.lower())]
        assert toxicity.words_of(text) == want, text
