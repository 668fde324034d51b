import random

import numpy as np
import pytest

from keyflow.llm.decontaminate import Index, best_end, best_end_in_chunks

from .conftest import WORDS, prose


def edited(words, n, rng):
    """``words`` after n substitutions, deletions and insertions."""
    words = list(words)
    for _ in range(n):
        kind, at = rng.randrange(3), rng.randrange(len(words))
        words[at:at + (kind < 2)] = [rng.choice(WORDS)] * (kind != 1)
    return words


def least_distance(item, text):
    """Least edit distance of ``item`` to a stretch of ``text``, row by row."""
    names = {w: k for k, w in enumerate(dict.fromkeys(item + text))}
    a, b = (np.array([names[w] for w in x]) for x in (item, text))
    at = np.arange(len(b) + 1)
    row = np.zeros(len(b) + 1, dtype=int)
    for i, x in enumerate(a, 1):
        new = np.r_[i, np.minimum(row[1:] + 1, row[:-1] + (b != x))]
        row = np.minimum.accumulate(new - at) + at
    return int(row.min())


@pytest.mark.parametrize("n", [15, 60, 150, 300, 600, 1000])
def test_recall_does_not_fall_with_length(n):
    rng = random.Random(n)
    items = [(k, prose(n, 5000 + k)) for k in range(30)]
    texts = [[*prose(40, 90 + k).split(), *edited(t.split(), n // 5, rng),
              *prose(40, 95 + k).split()] for k, t in items]
    found = {(d, i): distance for d, i, _, _, distance
             in Index(items).search([" ".join(t) for t in texts])}
    assert sum((k, k) in found for k in range(30)) >= 28
    for k in range(0, 30, 10):
        if (k, k) in found:
            assert found[k, k] == least_distance(items[k][1].split(), texts[k])


def test_chunks_give_the_same_place():
    rng = random.Random(6)
    for _ in range(200):
        p = np.array([rng.randrange(1, 5) for _ in range(rng.randrange(1, 30))])
        t = [rng.randrange(0, 5) for _ in range(rng.randrange(0, 60))]
        for anchored in (False, True):
            assert (best_end_in_chunks(p, t, anchored, rng.randrange(1, 9))
                    == best_end(Index._masks(p), len(p), t, anchored))


def test_an_item_of_100000_words():
    rng = random.Random(8)
    words = [f"w{rng.randrange(5000)}" for _ in range(100_000)]
    short = prose(20, 3)
    index = Index([(1, " ".join(words)), (2, short)])
    copy = " ".join(["x"] * 50 + edited(words, 500, rng))
    got = {(d, i): (first, distance) for d, i, first, _, distance
           in index.search([copy, " ".join(words[:50_000]), short])}
    assert set(got) == {(0, 0), (2, 1)} and got[2, 1] == (0, 0)
    assert abs(got[0, 0][0] - 50) <= 2 and 0 < got[0, 0][1] <= 500
