import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyflow.llm.components import components
from keyflow.llm.exact_dedup import drop_copies, exact_dedup
from keyflow.llm.near_dedup import (drop_near_copies, likely, merged, near_duplicates, registers_of,
                                    remaining_links)
from keyflow.llm.near_dedup import full_sets, signature, sketches
from keyflow.llm.shingles import shingle_set

from .conftest import prose


def test_exact_groups_and_survivors(odd_docs):
    rows = exact_dedup(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    kept = [r for r in rows if r["kept"]]
    assert len({r["text_sha256"] for r in rows}) == len(kept)
    # equal after removing white space: 1, 2, 2, null, 9; the longest original stays
    same = [r for r in rows if r["keep_id"] == 9]
    assert len(same) == 5 and {r["group_size"] for r in same} == {5}
    # null, empty and blank texts are one group; the blank one has most code points
    assert {r["doc_id"] for r in rows if r["keep_id"] == 5} == {3, 4, 5, None}


def test_exact_repeated_rows_leave_one(llm):
    docs = llm.createDataFrame([(1, "a b")] * 4 + [(None, "q")] * 2, "doc_id long, text string")
    rows = exact_dedup(docs).collect()
    assert sum(r["kept"] for r in rows) == 2
    assert drop_copies(docs).count() == 2


def test_drop_copies_keeps_columns(odd_docs, no_docs):
    out = drop_copies(odd_docs)
    assert out.schema == odd_docs.schema
    assert out.count() == exact_dedup(odd_docs).filter("kept").count()
    assert exact_dedup(no_docs).count() == 0 and drop_copies(no_docs).count() == 0


def test_exact_uses_no_python(odd_docs):
    plan = exact_dedup(odd_docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]


def brute_force(rows):
    """(n_shingles, component_id) by position, from every pair."""
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= 85 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)].append(doc_id)
    return [(len(s), min(least[find(i)], default=None) if s else rows[i][0])
            for i, s in enumerate(sets)]


def near_texts(seed=0):
    """Families of edited copies around the threshold, chains, and unrelated texts."""
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    for family in range(12):
        base = prose(int(rng.integers(20, 200)), 100 + family).split()
        for _ in range(12):
            w = list(base)
            for _ in range(int(rng.integers(0, 4))):
                w[int(rng.integers(len(w)))] = f"new{k}"
            if rng.random() < 0.3:
                base = w
            rows.append((k, " ".join(w)))
            k += 1
    return rows + [(1000 + i, prose(50, 500 + i)) for i in range(20)]


def test_near_duplicates_match_brute_force(llm):
    rows = near_texts()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(
        llm.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {i: w for (i, _), w in zip(rows, brute_force(rows), strict=True)}
    assert got == want
    assert len({c for _, c in want.values()}) < len(rows) - 30


def test_near_edges(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = near_duplicates(odd_docs).collect()
    key = lambda x: (str(x[0]), x[1], str(x[2]))
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=key) == \
        sorted(((i, *w) for (i, _), w in zip(rows, brute_force(rows), strict=True)), key=key)
    out = drop_near_copies(odd_docs)
    assert out.schema == odd_docs.schema
    # of {1, 2, 2, null, 9} and {6, 7} one row each; rows with one id and text are one
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(
        map(str, [1, 3, 4, 5, None, None, 6, 8, 10, 11]))
    assert near_duplicates(no_docs).count() == 0 and drop_near_copies(no_docs).count() == 0


def test_blocks_find_links_across_components(llm):
    """All nodes in one bucket and all apart: blocks must find every link."""
    rows = near_texts(3)[:60]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    nodes = sketches(docs).filter("n > 0").dropDuplicates(["sig"])
    sets = full_sets(docs, nodes)
    members = nodes.select(F.lit(0).alias("band"), F.lit(7).cast("long").alias("key"),
                           F.lit(b"none").alias("hub"), "sig", "n", "bands",
                           F.col("sig").alias("group"))
    got = {frozenset((bytes(r["a"]), bytes(r["b"])))
           for r in remaining_links(members, sets, 85, block=7).collect()}
    own = {signature(s): set(s.tolist()) for s in (shingle_set(t) for _, t in rows)}
    want = {frozenset((a, b)) for a in own for b in own if a != b
            and 100 * len(own[a] & own[b]) >= 85 * len(own[a] | own[b])}
    assert got == want and want


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    b = np.r_[a[:2700], rng.integers(0, 1 << 63, 300, dtype=np.uint64)]
    ra, rb, both = registers_of([a, b, np.union1d(a, b)])
    assert (merged(ra, rb) == both).all()
    assert abs((ra == rb).mean() - 2700 / 3300) < 0.2
    more, less = np.array([(ra > rb).sum()]), np.array([(ra < rb).sum()])
    n = np.array([3000.0])
    assert likely(more, less, n, n, 0.8)[0]
    far = registers_of([rng.integers(0, 1 << 63, 3000, dtype=np.uint64)])[0]
    assert not likely(np.array([(ra > far).sum()]), np.array([(ra < far).sum()]), n, n, 0.8)[0]


@pytest.mark.parametrize("links,want", [
    ([], {}),
    ([(1, 2), (2, 1), (3, 3)], {1: 1, 2: 1}),
    ([(i, i + 1) for i in range(30)] + [(50, 60), (60, 70)],
     {**{i: 0 for i in range(31)}, 50: 50, 60: 50, 70: 50}),
])
def test_components(llm, links, want):
    got = components(llm.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == want
