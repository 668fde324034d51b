"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are shares and counts of characters and
words, its neighbours' features, and whether it repeats an earlier line; two
weights per pair of neighbouring labels make the chain. Training lines carry the
label of their document. Forward-backward gives each line's probability of being
good; the document's score is their mean, weighted by line length.

The model is fitted on a bounded sample of labelled rows (``SAMPLE`` rows and
``SAMPLE_LINES`` lines, drawn by a hash of the id outside the held-out fold);
scoring is one pass over whole texts in Arrow batches, cut by bytes. The chains of a
call run side by side, and long ones in blocks of ``BLOCK_LINES`` lines: what a
block does to either label before it is worked out for all blocks at once, so a
text of a million lines takes some thousand steps. Features are made for
``PIECE`` characters of lines at a time and only their three products with the
weights are kept, so a worker holds some bytes for each line of a long text.

Defined results: null and empty texts are one empty line and get that line's
score; without any usable label every score is 0.5; repeated rows get equal
scores; an empty table gives an empty result. Only doc_id and text are read for
a score.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, in_fold, labelled_sample, text_or_empty

#: labelled rows that the model is fitted on, at most
SAMPLE = 3000
#: lines of these rows, at most
SAMPLE_LINES = 400_000
BLOCK_LINES = 512
#: bytes of texts that are scored together, characters whose features are made at once
CALL_BYTES, PIECE = 1 << 20, 1 << 20
FOLDS, HELD = 5, 0
THRESHOLD = 0.3
STEPS = 300
RATE = 0.05
L2 = 1e-4

LOWER, UPPER, DIGIT, SPACE, POINT, MARK, SYMBOL, OTHER = range(8)


def _kind(i: int) -> int:
    c = chr(i)
    cat = unicodedata.category(c)
    if cat == "Lu":
        return UPPER
    if cat[0] in "LM":
        return LOWER
    if cat[0] == "N":
        return DIGIT
    if c.isspace():
        return SPACE
    if c in ".,;:'\"-()?":
        return POINT
    return MARK if c == "!" else SYMBOL if cat[0] in "PS" else OTHER


_KINDS: list[np.ndarray] = []


def kinds() -> np.ndarray:
    """Character class of every code point below U+3000; the rest count as letters."""
    if not _KINDS:
        _KINDS.append(np.array([_kind(i) for i in range(0x3000)] + [LOWER], dtype=np.int8))
    return _KINDS[0]


def line_pieces(texts: list[str | None]) -> Iterator[tuple[list[str], np.ndarray]]:
    """The lines of all texts in order, some ``PIECE`` characters at a time, and
    whether each stands earlier in its text already."""
    held: list[str] = []
    again: list[bool] = []
    size = 0
    for text in texts:
        seen: set[str] = set()
        known = np.zeros(0, dtype=np.uint64)  # hashes of the pieces before
        for part in _pieces_of_lines(text or ""):
            lines = part.split("\n")
            if len(part) < PIECE // 2 and not len(known):
                for line in lines:
                    again.append(line in seen)
                    seen.add(line)
            else:
                h = np.fromiter((xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass"))
                                 for x in lines), np.uint64, len(lines))
                _, first = np.unique(h, return_index=True)
                twice = np.ones(len(h), dtype=bool)
                twice[first] = False
                again += (twice | np.isin(h, known)).tolist()
                known = np.union1d(known, h)
            held += lines
            size += len(part)
            if size >= PIECE:
                yield held, np.array(again)
                held, again, size = [], [], 0
    if held:
        yield held, np.array(again)


def _pieces_of_lines(text: str) -> Iterator[str]:
    """A text cut behind newlines into pieces of about ``PIECE`` characters."""
    at = 0
    while True:
        cut = text.find("\n", at + PIECE) if len(text) - at > PIECE else -1
        if cut < 0:
            yield text[at:] if at else text
            return
        yield text[at:cut]
        at = cut + 1


def base_features(lines: list[str], again: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(own features, lengths) of lines."""
    extra: list[tuple[int, int, int]] = []
    for line in lines:
        words = line.split()
        extra.append((len(words), len(set(words)), sum(map(eq, words, words[1:]))))
    size = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    order = "utf-32-le" if sys.byteorder == "little" else "utf-32-be"
    codes = np.frombuffer("".join(lines).encode(order, "surrogatepass"), dtype=np.uint32)
    kind = kinds()[np.minimum(codes, 0x3000)]
    at = np.repeat(np.arange(len(lines)) * 8, size) + kind
    by_kind = np.bincount(at, minlength=8 * len(lines)).reshape(-1, 8).astype(float)
    words, distinct, twice = np.array(extra, dtype=float).reshape(-1, 3).T
    chars = np.maximum(size, 1)
    letters = by_kind[:, LOWER] + by_kind[:, UPPER]
    share = by_kind / chars[:, None]
    many = np.maximum(words, 1)
    return np.stack([
        by_kind[:, UPPER] / np.maximum(letters, 1), share[:, DIGIT], share[:, SPACE],
        share[:, POINT], share[:, MARK], share[:, SYMBOL], share[:, OTHER],
        (share[:, SYMBOL] > 0.02).astype(float), (share[:, MARK] > 0.02).astype(float),
        np.minimum(letters / many, 30) / 10, distinct / many, twice / many,
        np.sqrt(twice / many), again.astype(float), np.log1p(words) / 5, np.log1p(size) / 8,
        (size == 0).astype(float), (words <= 2).astype(float)], axis=1), size


def line_counts(texts: list[str | None]) -> np.ndarray:
    return np.array([(t or "").count("\n") + 1 for t in texts], dtype=np.int64)


def beside(own: np.ndarray, counts: np.ndarray, step: int) -> np.ndarray:
    """Each line's neighbour's row, ``step`` lines on in the same text; else zeros."""
    out = np.roll(own, -step, axis=0)
    ends = np.cumsum(counts)
    out[(ends - 1 if step > 0 else ends - counts)[counts > 0]] = 0
    return out


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, line lengths, lines per text) of all lines of ``texts``."""
    parts = [base_features(*piece) for piece in line_pieces(texts)]
    base, size = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    counts = line_counts(texts)
    return (np.concatenate([np.ones((len(base), 1)), base, beside(base, counts, -1),
                            beside(base, counts, 1)], axis=1), size, counts)


class Chains:
    """Texts of different numbers of lines, run side by side in blocks of lines."""

    def __init__(self, counts: np.ndarray, block: int = BLOCK_LINES):
        self.counts, self.block = counts, block
        ends = np.cumsum(counts)
        n = -(-counts // block)
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        first = np.repeat(ends - counts, n) + place * block
        size = np.minimum(block, np.repeat(ends, n) - first)
        # longest blocks first, so that those with a step t are the first ones
        order = np.argsort(-size, kind="stable")
        self.first, self.size = first[order], size[order]
        self.place, self.last = place[order], (np.repeat(n, n) - 1)[order]
        self.longest = int(size.max()) if len(size) else 0
        self.active = [int(np.searchsorted(-self.size, -t, "left")) for t in range(self.longest)]
        # blocks of texts that have several, by place: aligned from text to text
        text = np.repeat(np.arange(len(counts)), n)[order]
        self.chained = []
        for k in range(int(n.max()) if len(n) else 0):
            own = np.flatnonzero((self.place == k) & (self.last > 0))
            self.chained.append(own[np.argsort(text[own], kind="stable")])
        self.text = text

    def scan(self, scores: np.ndarray, pair: np.ndarray, back: bool) -> np.ndarray:
        """Log-weight of each line's labels with all lines before it (``back``: after)."""
        pair = pair.T if back else pair
        start = self.first + self.size - 1 if back else self.first
        step = -1 if back else 1
        nth = self.last - self.place if back else self.place
        out = np.zeros_like(scores)

        def passed(x: np.ndarray) -> np.ndarray:
            return np.logaddexp(x[..., 0, None] + pair[0], x[..., 1, None] + pair[1])

        enter = np.zeros((len(start), 2))  # weights of the labels of the line before a block
        if len(self.chained) > 1:
            # what a block makes of either label before it; a text's end is not passed on
            own = np.flatnonzero((self.last > 0) & (nth < self.last))
            x = np.where((nth[own] > 0)[:, None, None], pair, 0.0) + scores[start[own]][:, None, :]
            size = self.size[own]
            for t in range(1, int(size.max())):
                on = size > t
                x[on] = passed(x[on]) + scores[start[own[on]] + step * t][:, None, :]
            made = np.zeros((len(start), 2, 2))
            made[own] = x
            chain = self.chained[::-1] if back else self.chained
            by_nth = [np.flatnonzero((nth == k) & (self.last > 0)) for k in range(len(chain))]
            by_nth = [o[np.argsort(self.text[o], kind="stable")] for o in by_nth]
            for before, after in zip(by_nth, by_nth[1:]):
                source = before[np.isin(self.text[before], self.text[after])]
                y = enter[source][:, :, None] + made[source]
                enter[after] = np.where((nth[source] > 0)[:, None],
                                        np.logaddexp(y[:, 0], y[:, 1]), made[source][:, 0])
        for t in range(self.longest):
            at = start[:self.active[t]] + step * t
            if t == 0:
                out[at] = scores[at] + np.where((nth > 0)[:, None], passed(enter), 0.0)
            else:
                out[at] = passed(out[at - step]) + scores[at]
        return out

    def marginals(self, unary: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(good) of every line, and the expected number of each label pair."""
        scores = np.stack([np.zeros(len(unary)), unary], axis=1)
        a, c = self.scan(scores, pair, False), self.scan(scores, pair, True)
        z = a + c - scores
        inner = np.ones(len(unary), dtype=bool)  # lines with a next one
        inner[(np.cumsum(self.counts) - 1)[self.counts > 0]] = False
        at = np.flatnonzero(inner)
        joint = a[at][:, :, None] + pair + c[at + 1][:, None, :]
        joint -= joint.max(axis=(1, 2), keepdims=True)
        joint = np.exp(joint)
        pairs = (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        return 1 / (1 + np.exp(np.clip(z[:, 0] - z[:, 1], -500, 500))), pairs


class LineCrf:
    """Weights of the field: one per feature (of good over bad) and per label pair."""

    def __init__(self, weights: np.ndarray, pair: np.ndarray, scale: tuple[np.ndarray, np.ndarray]):
        self.weights, self.pair, self.scale = weights, pair, scale

    @classmethod
    def fit(cls, texts: list[str], labels: list[int], steps: int = STEPS) -> LineCrf | None:
        if not texts:
            return None
        x, _, counts = line_features(texts)
        mean, spread = x.mean(axis=0), x.std(axis=0)
        mean[0], spread[spread < 1e-9] = 0, 1
        x = (x - mean) / spread
        y = np.repeat(np.asarray(labels, dtype=float), counts)
        chains, n = Chains(counts), len(x)
        same = np.asarray([[((counts - 1) * (1 - np.asarray(labels))).sum(), 0],
                           [0, ((counts - 1) * np.asarray(labels)).sum()]], dtype=float)
        theta = np.zeros(x.shape[1] + 4)
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for k in range(1, steps + 1):
            p, pairs = chains.marginals(x @ theta[:-4], theta[-4:].reshape(2, 2))
            g = np.r_[x.T @ (p - y), (pairs - same).ravel()] / n + L2 * theta
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            theta -= RATE * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.999 ** k)) + 1e-8)
        return cls(theta[:-4], theta[-4:].reshape(2, 2), (mean, spread))

    def lines(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """P(good) and length of every line, and the lines per text."""
        mean, spread = self.scale
        w = self.weights / spread
        # of a line's own features only the products with the three parts of the weights
        parts = w[1:].reshape(3, -1).T
        made = [(base @ parts, size) for base, size in
                (base_features(*piece) for piece in line_pieces(texts))]
        own, size = (np.concatenate([m[k] for m in made]) for k in (0, 1))
        counts = line_counts(texts)
        unary = (w[0] - mean @ w + own[:, 0] + beside(own[:, 1], counts, -1)
                 + beside(own[:, 2], counts, 1))
        scores = np.stack([np.zeros(len(unary)), unary], axis=1)
        chains = Chains(counts)
        z = (chains.scan(scores, self.pair, False) + chains.scan(scores, self.pair, True) - scores)
        return 1 / (1 + np.exp(np.clip(z[:, 0] - z[:, 1], -500, 500))), size, counts

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Length-weighted mean of the line probabilities of each text."""
        p, size, counts = self.lines(texts)
        weight = size + 1.0
        starts = np.r_[0, np.cumsum(counts)[:-1]].astype(np.int64)
        mean = np.add.reduceat(p * weight, starts) / np.add.reduceat(weight, starts)
        return np.round(mean, 9)  # the last digits depend on what else is in the batch


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> LineCrf | None:
    """The field fitted on at most ``sample`` labelled rows outside the held-out fold."""
    rows, lines = [], 0
    for row in labelled_sample(docs, labels, "quality", FOLDS, HELD, sample):
        lines += row[1].count("\n") + 1
        if lines > SAMPLE_LINES:
            break
        rows.append(row)
    rows.sort()
    return LineCrf.fit([r[1] for r in rows], [r[2] for r in rows])


def score_quality(docs: DataFrame, model: LineCrf | None) -> DataFrame:
    """doc_id, held_out, score, predicted and n_lines of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = shared.value
        for batch in it:
            for part in by_bytes(batch, 1, 4096, CALL_BYTES):
                texts = part.column(1).to_pylist()
                s = crf.score(texts) if crf else np.full(len(texts), 0.5)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.clip(s, 0, 1)),
                     pa.array([t.count("\n") + 1 for t in texts], pa.int64())],
                    names=["doc_id", "score", "n_lines"])

    kind = dict(docs.dtypes)["doc_id"]
    return (docs.select("doc_id", text_or_empty().alias("text"))
            .mapInArrow(score, f"doc_id {kind}, score double, n_lines long")
            .select("doc_id", in_fold("doc_id", FOLDS, HELD).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_lines"))


def drop_rejected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows whose score is under the threshold, columns unchanged."""
    model = fit_quality(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd

        crf, out, part, held = shared.value, [], [], 0
        for k, text in enumerate(texts):
            part.append(text)
            held += len(text)
            if held >= CALL_BYTES or k == len(texts) - 1:
                out.append(crf.score(part) if crf else np.full(len(part), 0.5))
                part, held = [], 0
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return docs.filter(score(text_or_empty()) >= THRESHOLD)
