"""Very long texts: memory and time of one worker, in a process of its own."""
import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def alone(code):
    """What ``code`` prints (JSON) in a fresh interpreter, as a worker would run it."""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600,
                         env={**os.environ, "PYTHONPATH": ROOT, "OMP_NUM_THREADS": "1"})
    assert out.returncode == 0, out.stderr[-2000:]
    return json.loads(out.stdout.splitlines()[-1])


GROWTH = """
import json, resource, time
peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024
"""


@pytest.mark.parametrize("unit", ["The quick brown fox jumps over lazy dogs. ", "a b\\nc "])
def test_decontaminate_a_text_of_50_mb(unit):
    got = alone(GROWTH + f"""
from keyflow.llm.decontaminate import Index
item = " ".join("item%d" % i for i in range(40))
index = Index([(1, item), (2, "some other words that a benchmark asks about in a long line")])
n = (50 << 20) // len("{unit}")
text = "{unit}" * (n // 2) + item + " " + "{unit}" * (n // 2)
before, t = peak(), time.time()
hits = list(index.search([text]))
print(json.dumps([peak() - before, time.time() - t, [h[1] for h in hits], len(text) >> 20]))
""")
    assert got[2] == [0] and got[3] >= 49
    assert got[0] < 500, got


def test_quality_of_a_text_of_50_mb():
    got = alone(GROWTH + """
import numpy as np
from keyflow.llm import quality
good, bad = "A good line of plain words, as ever.", "BUY!!! $$$ 99 %%% NOW NOW NOW !!!"
crf = quality.LineCrf.fit(["\\n".join([good] * 5), "\\n".join([bad] * 5)] * 20, [1, 0] * 20, 60)
n = (50 << 20) // 37
text = "\\n".join(f"{good[:30]} {i % 90001}" for i in range(n))
before, t = peak(), time.time()
score = float(crf.score([text])[0])
print(json.dumps([peak() - before, time.time() - t, score, len(text) >> 20]))
""")
    assert got[0] < 500 and got[1] < 120 and 0 <= got[2] <= 1 and got[3] >= 47, got


def test_blocks_of_lines_change_no_marginal():
    import numpy as np

    from keyflow.llm import quality

    rng = np.random.default_rng(2)
    counts = np.array([1, 2, 17, 40, 3, 39, 1, 8])
    unary, pair = rng.normal(size=counts.sum()) * 3, rng.normal(size=(2, 2))
    whole = quality.Chains(counts).marginals(unary, pair)
    for block in (1, 2, 3, 8, 13):
        got = quality.Chains(counts, block).marginals(unary, pair)
        assert max(np.abs(a - b).max() for a, b in zip(whole, got)) < 1e-11


def test_pieces_of_lines_change_no_score(monkeypatch):
    import numpy as np

    from keyflow.llm import quality

    texts = ["\n".join(f"line {i % 7} of {k}" for i in range(50 * k)) for k in range(1, 6)] + ["", None]
    crf = quality.LineCrf.fit(texts[:4], [0, 1, 0, 1], 30)
    want = crf.score(texts)
    monkeypatch.setattr(quality, "PIECE", 64)
    assert np.abs(crf.score(texts) - want).max() <= 1e-9
    again = np.concatenate([a for _, a in quality.line_pieces(texts)])
    lines = [x for piece, _ in quality.line_pieces(texts) for x in piece]
    assert lines == [x for t in texts for x in (t or "").split("\n")]
    seen, want = set(), []
    for k, t in enumerate(texts):
        for x in (t or "").split("\n"):
            want.append((k, x) in seen)
            seen.add((k, x))
    assert again.tolist() == want
