import pytest

from keyflow.llm.queries import importable

WORDS = ("river stone maple winter copper lantern meadow falcon harbor signal velvet orchard "
         "granite thunder canyon ember willow saddle marble beacon").split()


def prose(n: int, seed: int = 0) -> str:
    import random

    rng = random.Random(seed)
    return " ".join(f"{rng.choice(WORDS)}{rng.choice(WORDS)}" for _ in range(n))


@pytest.fixture(scope="session")
def llm(spark):
    importable(spark)
    return spark


@pytest.fixture(scope="session")
def odd_docs(llm):
    """Nulls, empty and very long texts, ties, repeated rows, clashing column names."""
    long = "\n".join(prose(40, k) for k in range(400))
    rows = [(1, prose(60, 1), "x"), (2, prose(60, 1), "y"), (2, prose(60, 1), "y"),
            (3, None, None), (4, "", "z"), (5, " \t\n", "z"), (None, prose(60, 1), "n"),
            (None, prose(30, 2), "n"), (None, None, "n"), (6, long, "l"), (7, long + " end", "l"),
            (8, "short", "s"), (9, prose(60, 1) + "  ", "w"), (10, "Ünïcode ß 漢字 \U0001f600", "u"),
            (11, "a\r\nb\x0bc\x85d", "c")]
    cols = ("doc_id long, text string, lang string, source string, n_chars long, score string, "
            "shard string, row string, sig string, n string, k string, bucket string")
    return llm.createDataFrame([(i, t, s, s, None, s, s, s, s, s, s, s) for i, t, s in rows], cols)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def labels(llm):
    return llm.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(1, 12)]
                               + [(None, 1, 1), (3, None, None)],
                               "doc_id long, quality int, toxic int")
