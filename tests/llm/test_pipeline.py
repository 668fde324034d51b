import importlib.util

import duckdb
import pytest

import corpus_pipeline
from keyflow.llm import decontaminate, quality
from keyflow.llm.oracles import ORACLE_SQL
from keyflow.llm.queries import QUERIES, tokenizer_path
from keyflow.llm.packing import WordTokens

from .test_dedup import brute_force

SF = "/root/testdata/sf0.01"


def test_pipeline_matches_brute_force(llm):
    """Every stage redone row by row on the documents that the one before kept."""
    docs = {r["doc_id"]: r["text"] for r in llm.read.parquet(f"{SF}/documents.parquet").collect()}
    frame = llm.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit_quality(frame, llm.read.parquet(f"{SF}/labels.parquet"))
    ids = sorted(docs)
    scores = dict(zip(ids, model.score([docs[i] for i in ids]), strict=True))
    docs = {i: docs[i] for i in ids if scores[i] >= quality.THRESHOLD}
    best = {}
    for i in sorted(docs):
        key = "".join(c for c in docs[i] if c not in " \t\n\x0b\x0c\r")
        if key not in best or len(docs[i]) > len(docs[best[key]]):
            best[key] = i
    docs = {i: docs[i] for i in sorted(best.values())}
    near = brute_force(list(docs.items()))
    docs = {i: t for (i, t), (_, c) in zip(docs.items(), near, strict=True) if i == c}
    bench = [(r["item_id"], r["text"]) for r in
             llm.read.parquet(f"{SF}/benchmark.parquet").collect()]
    index = decontaminate.Index(bench)
    hit = {h[0] for h in index.search(list(docs.values()))}
    for k, t in enumerate(docs.values()):  # whole items in a text are never missed
        w = " ".join(decontaminate.words_of(t))
        assert k in hit or not any(" ".join(decontaminate.words_of(b)) in w for _, b in bench)
    docs = {i: t for k, (i, t) in enumerate(docs.items()) if k not in hit}
    tokens = WordTokens(tokenizer_path())
    want = {i: len(tokens.encode(t)) // 4 + 1 for i, t in docs.items()}
    got = corpus_pipeline.run(llm, SF).collect()
    assert {r["doc_id"]: r["doc_tokens"] for r in got} == want
    assert sum(r["length"] for r in got) == sum(want.values())


def test_a_run_leaves_no_scratch_but_its_last_input(llm):
    from keyflow.session import checkpoint_root, child_folders

    place = f"{checkpoint_root(llm)}/keyflow"
    before = set(child_folders(llm, place))
    out = corpus_pipeline.run(llm, "/root/testdata/sf0.001")
    assert out.count() > 0
    left = {n.rsplit("-", 1)[0] for n in set(child_folders(llm, place)) - before}
    assert "pipeline-decontaminate" in left
    assert not left & {"pipeline-quality", "pipeline-exact_dedup", "pipeline-near_dedup", "benchmark"}


def test_stages_keep_the_columns(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(llm, docs, SF).columns == docs.columns, name


def test_stages_on_odd_rows(llm, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(llm, odd_docs, SF).count() <= 3 * odd_docs.count() + 60, name
        assert stage(llm, no_docs, SF).count() == 0, name


def test_every_stage_is_registered():
    spec = importlib.util.find_spec("__spark_entry__")
    assert spec
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_match_sql(llm, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(ORACLE_SQL[name]).df()
    got = QUERIES[name](llm, SF).toPandas()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    a, b = (x[cols].astype(str).sort_values(cols).to_numpy().tolist() for x in (want, got))
    assert a == b
