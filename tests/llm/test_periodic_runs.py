import hashlib
import random
import re
import zlib

from pyspark.sql import functions as F

from keyflow.llm import periodic_runs
from keyflow.llm.queries import op13_periodic_runs

SF = "/root/testdata/sf0.001"


def brute(words):
    """Every maximal stretch of every period; the smallest period of a stretch counts."""
    best = {}
    for p in range(1, len(words) // 4 + 1):
        i = 0
        while i + p < len(words):
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < len(words) and words[i] == words[i + p]:
                i += 1
            if i - start + p >= max(6, 4 * p):
                best.setdefault((start, i - start + p), p)
    return sorted((s, n, p) for (s, n), p in best.items())


def test_runs_match_every_period():
    rng = random.Random(3)
    seen = 0
    for _ in range(1500):
        texts = []
        for _ in range(rng.randint(1, 4)):
            words = []
            while len(words) < rng.randint(0, 90):
                if rng.random() < 0.5:
                    unit = [rng.choice("abc") for _ in range(rng.randint(1, 6))]
                    words += (unit * 9)[:rng.randint(1, 9 * len(unit))]
                else:
                    words += [rng.choice("abcd") for _ in range(rng.randint(1, 5))]
            texts.append(words)
        want = [brute(w) for w in texts]
        assert periodic_runs.runs_of(texts) == want
        seen += sum(map(len, want))
    assert seen > 1000


def test_very_long_texts_and_frequent_words():
    assert periodic_runs.runs_of([["a"] * 200_000]) == [[(0, 200_000, 1)]]
    line = "all rights reserved by the owner of this page".split()
    far = [w for i in range(20_000) for w in [*line, str(i)]]
    assert periodic_runs.runs_of([far, ["x", "y"] * 10, []]) == [[], [(0, 20, 2)], []]


def rewritten(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = rewritten(doc_id, text)
    runs = brute(words)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    s, n, p = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (doc_id, len(runs), s, n, p, n and 1000 * n // p,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


COLS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
        "collapsed_sha256"]


def test_query_matches_brute_force(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(expected(r.doc_id, r.text) for r in docs if len(r.text or "") < 40_000)
    short = {w[0] for w in want}
    got = sorted(tuple(r) for r in op13_periodic_runs(llm, SF).select(*COLS).collect()
                 if r.doc_id in short)
    assert got == want
    assert sum(w[1] for w in want) >= 10


def test_odd_rows(llm, odd_docs, no_docs, tmp):
    odd_docs.write.parquet(f"{tmp}/documents.parquet")
    got = op13_periodic_runs(llm, tmp).select(*COLS).collect()
    texts = odd_docs.select("doc_id", "text").collect()
    order = lambda rows: sorted(rows, key=str)
    assert order(tuple(r) for r in got) == order(expected(r.doc_id, r.text) for r in texts)
    assert periodic_runs.periodic_runs(no_docs).count() == 0


def test_general_interface_returns_spans_and_text(llm):
    docs = llm.createDataFrame([("k", "go " * 8 + "stop here")], "name string, body string")
    row = periodic_runs.periodic_runs(docs, doc_id="name", text=F.col("body")).first()
    assert [tuple(r) for r in row.runs] == [(0, 8, 1)]
    assert row.collapsed == "go stop here" and row.n_words == 10
