import zlib
from collections import defaultdict

import pytest

from keyflow.llm import toxicity

from .conftest import prose


@pytest.fixture(scope="module")
def scored(llm):
    read = lambda t: llm.read.parquet(f"/root/testdata/sf0.1/{t}.parquet")
    docs = read("documents")
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    y = {r["doc_id"]: r["toxic"] for r in read("labels").collect()}
    return [(r, y[r["doc_id"]], lang[r["doc_id"]])
            for r in toxicity.score_toxicity(docs, read("labels")).collect()
            if r["doc_id"] in y and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]


def test_toxic_rows_are_found_in_every_language(scored):
    found = defaultdict(list)
    for r, y, lang in scored:
        if y == 1:
            found[lang].append(r["predicted"])
    assert len(found) >= 4
    for lang, hits in found.items():
        assert sum(hits) >= 0.85 * len(hits), (lang, sum(hits), len(hits))


def test_every_text_with_a_known_word_has_neighbours(llm):
    rows = [(k, prose(30, k % 7)) for k in range(40)]  # no word leans far
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    labels = llm.createDataFrame([(k, int(k % 7 == 0)) for k in range(40)],
                                 "doc_id long, toxic int")
    assert all(r["neighbours"] and r["similarities"][0] > 0.99
               for r in toxicity.score_toxicity(docs, labels).collect())
