"""Language-model scores from a hashed maximum-entropy model.

Tokens are the words of a text after lower-casing A-Z, then one end mark. Every
token belongs to a class: the ``HEAD_CLASSES * SLOTS`` most frequent words to
classes by rank, all others to one of ``TAIL_CLASSES`` by their last two bytes.
The model factors as

    P(token | context) = P(class | context) * P(token | class, context).

Both factors are softmaxes over a bias (log frequency) plus one weight row for
each feature of the context: the word before, the two words before (n-grams) and,
for the class, the word two back (a skip). Features are hashed into ``BUCKETS`` rows, inside a
class together with the class. Within a tail class the token's probability is
its smoothed share of the class, with one place for words never seen, so the
probabilities of all words sum to 1.

Training reads every training row: its tokens are counted by Spark, and each of
``ROUNDS`` gradient updates takes the next part of the rows (by a hash, so that
each row is used once). Tasks sum up, per weight, how often it was observed and
how often the model expected it; the sums are shuffled by blocks of weights, and
their difference moves the weights as in iterative scaling. Expectations are
rounded to 1/16 in each task, so the order in which tasks are added is no matter.

Plan and bounds: broadcast are the weights (fixed size) and at most ``KNOWN``
words of at most ``KNOWN_BYTES`` bytes with their counts, chosen by a count
threshold that a histogram of counts gives. All other words of a text leave
the scoring pass with their multiplicity and meet their counts in a join, so any
vocabulary is counted exactly. Texts are read in pieces, so that a worker holds
some 4 bytes a word of a very long text beside one piece.

Defined results: null and empty texts are the end mark alone; without training
rows every base probability is 1 and the model is uniform over classes; a null
id belongs to the training rows; repeated rows get equal scores (and count as
often as they stand there); an empty table gives an empty result; only the id
and the text are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_fold, materialize, text_or_empty

FOLDS, HELD = 7, 2
HEAD_CLASSES, TAIL_CLASSES, SLOTS = 32, 16, 64
CLASSES = HEAD_CLASSES + TAIL_CLASSES
HEAD = HEAD_CLASSES * SLOTS
BUCKETS = 1 << 13
#: features of a context for the class, and inside a class (the n-grams)
FEATURES = (3, 2)
ROUNDS = 3
#: step of each round, as a multiple of the step of iterative scaling
STEPS = (1.5, 1.2, 1.0)
PRIOR = 4.0
KNOWN = 1 << 18
KNOWN_BYTES = 64
#: a mark that no word can be
END = b" "
#: bytes of one piece of a text, tokens of one call, distinct words a task holds
PIECE, CALL, DISTINCT = 1 << 20, 1 << 17, 200_000
#: tokens whose softmaxes are held at once: they should stay in a core's cache
CHUNK = 1 << 13
#: weights of one shuffled row
BLOCK = 256
#: tokens of a bucket that are added up side by side with other buckets'
TOGETHER = 12

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                             0xD6E8FEB86659FD93)]
_PAD = KNOWN + TAIL_CLASSES


def word_pieces(text: str) -> Iterator[list[bytes]]:
    """The lower-cased words of a text, some ``PIECE`` bytes at a time."""
    data = text.encode("utf-8", "surrogatepass")
    at = 0
    while at < len(data):
        end = at + PIECE
        if end < len(data):
            cut = _SPACE.search(data, end)
            end = cut.start() if cut else len(data)
        yield data[at:end].lower().split()
        at = end


def tail_class(word: bytes) -> int:
    return HEAD_CLASSES + zlib.crc32(word[-2:]) % TAIL_CLASSES


def tail_class_column(word: str) -> Column:
    return (F.lit(HEAD_CLASSES) + F.crc32(F.substring(word, -2, 2)) % TAIL_CLASSES).cast("int")


@dataclass(frozen=True)
class Vocabulary:
    """Counts of the known words (by falling count), and sums over all words."""

    words: dict[bytes, int]
    counts: np.ndarray
    classes: np.ndarray
    tokens: int
    distinct: int
    mass: np.ndarray  # of each class: head counts, or tail counts + words + 1

    @property
    def class_bias(self) -> np.ndarray:
        with np.errstate(divide="ignore"):
            b = np.log(self.mass / self.mass.sum())
        return np.maximum(b, -60).astype(np.float32)

    @property
    def word_bias(self) -> np.ndarray:
        own = np.zeros(HEAD)
        own[:min(HEAD, len(self.counts))] = self.counts[:HEAD]
        own = own.reshape(HEAD_CLASSES, SLOTS)
        with np.errstate(divide="ignore", invalid="ignore"):
            b = np.log(own / own.sum(axis=1, keepdims=True))
        return np.where(own > 0, b, -60).astype(np.float32)


@dataclass(frozen=True)
class Weights:
    """A row per feature bucket: of class weights, and of weights inside a class."""

    of_class: np.ndarray
    in_class: np.ndarray

    @classmethod
    def zero(cls) -> Weights:
        return cls(np.zeros((BUCKETS, CLASSES), np.float32), np.zeros((BUCKETS, SLOTS), np.float32))


def count_words(rows: DataFrame) -> DataFrame:
    """(word, c) over the texts of ``rows``, the end mark included."""

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def send() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()),
                                              pa.array(list(held.values()), pa.int64())],
                                             names=["word", "c"])
            held.clear()
            return out

        for batch in it:
            for text in batch.column(0):
                for words in word_pieces(text.as_py()):
                    held.update(words)
                    if len(held) > DISTINCT:
                        yield send()
                held[END] += 1
        yield send()

    return (rows.select("text").mapInArrow(count, "word binary, c long")
            .groupBy("word").agg(F.sum("c").alias("c")))


def _bucket() -> Column:
    return F.floor(F.log2("c") * 8).cast("int")


def fit_vocabulary(counts: DataFrame, most: int = KNOWN) -> tuple[Vocabulary, DataFrame]:
    """At most ``most`` known words and the sums of a (word, c) table; and the other
    words."""
    short = F.length("word") <= KNOWN_BYTES
    sums = counts.groupBy(tail_class_column("word").alias("k"), _bucket().alias("b")).agg(
        F.sum("c").alias("c"), F.count(F.lit(1)).alias("v"),
        F.count_if(short).alias("short")).collect()
    by_bucket: Counter[int] = Counter()
    for r in sums:
        by_bucket[r["b"]] += r["short"]
    low, held = None, 0
    for b in sorted(by_bucket, reverse=True):
        if held + by_bucket[b] > min(most, KNOWN):
            break
        low, held = b, held + by_bucket[b]
    known = short & (_bucket() >= (low if low is not None else 1 << 20))
    table = counts.filter(known).select("word", "c").toArrow()
    rows = sorted(zip(table.column("word").to_pylist(), table.column("c").to_pylist()),
                  key=lambda r: (-r[1], r[0]))
    mass = np.zeros(CLASSES)
    for r in sums:
        mass[r["k"]] += r["c"] + r["v"]
    classes = np.array([i // SLOTS if i < HEAD else tail_class(w) for i, (w, _) in enumerate(rows)],
                       dtype=np.int32)
    for i, (w, c) in enumerate(rows[:HEAD]):
        mass[tail_class(w)] -= c + 1
        mass[i // SLOTS] += c
    mass[HEAD_CLASSES:] += 1
    vocabulary = Vocabulary({w: i for i, (w, _) in enumerate(rows)},
                            np.array([c for _, c in rows], dtype=np.int64), classes,
                            sum(r["c"] for r in sums), sum(r["v"] for r in sums), mass)
    return vocabulary, counts.filter(~known)


def token_ids(text: str, v: Vocabulary, others: Counter[bytes] | None = None) -> np.ndarray:
    """Numbers of a text's tokens: rank of a known word, or ``KNOWN`` + tail class;
    what is not known is counted in ``others``."""
    parts = []
    for words in _with_end(word_pieces(text)):
        ids = np.fromiter(map(v.words.get, words, repeat(-1)), np.int32, len(words))
        unknown = np.flatnonzero(ids < 0)
        if len(unknown):
            rest = [words[i] for i in unknown.tolist()]
            ids[unknown] = [_TAIL[w[-2:]] for w in rest]
            if others is not None:
                others.update(rest)
        parts.append(ids)
    return np.concatenate(parts)


class _Tail(dict):
    """Token number of an unknown word by its last two bytes."""

    def __missing__(self, ending: bytes) -> int:
        out = self[ending] = KNOWN + tail_class(ending) - HEAD_CLASSES
        return out


_TAIL = _Tail()


def _with_end(pieces: Iterator[list[bytes]]) -> Iterator[list[bytes]]:
    yield from pieces
    yield [END]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x = x * _M[3]
    return x ^ (x >> np.uint64(32))


def features(ids: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Hashes of each token's context: the word before, both words before, the
    word two back. ``starts``: first tokens of the texts."""
    before = np.r_[_PAD, ids[:-1]].astype(np.uint64)
    before[starts] = _PAD
    second = np.r_[_PAD, before[:-1]].astype(np.uint64)
    second[starts] = _PAD
    return [_mixed(before * _M[0]), _mixed((before * _M[1]) ^ (second * _M[2])),
            _mixed(second * _M[3] + np.uint64(77))]


class Model:
    """The vocabulary and weights, ready to score or to sum up gradients."""

    def __init__(self, vocabulary: Vocabulary, weights: Weights):
        self.v, self.w = vocabulary, weights
        self.class_bias, self.word_bias = vocabulary.class_bias, vocabulary.word_bias

    def classes_of(self, ids: np.ndarray) -> np.ndarray:
        known = ids < KNOWN
        out = ids - KNOWN + HEAD_CLASSES
        out[known] = self.v.classes[ids[known]]
        return out

    def log_probabilities(self, ids: np.ndarray, starts: np.ndarray,
                          sums: Sums | None = None, only_sums: bool = False) -> np.ndarray:
        """Natural log of P(class) of every token, times that of the word inside a
        head class or of a known word inside a tail class (other words: class only).
        With ``sums``, adds up the uses of the weights; ``only_sums``: nothing else,
        by the short way that weights of zero allow."""
        out = np.empty(len(ids))
        kinds, hashes = self.classes_of(ids), features(ids, starts)
        mask = np.uint64(BUCKETS - 1)
        of_class = [(h & mask).astype(np.uint16) for h in hashes]
        head = np.flatnonzero(kinds < HEAD_CLASSES)
        own, slot = kinds[head], ids[head] % SLOTS
        salt = own.astype(np.uint64) * _M[1]
        in_class = [(_mixed(h[head] + salt) & mask).astype(np.uint16) for h in hashes[:FEATURES[1]]]
        if only_sums:
            sums.add_unweighted(of_class, kinds, in_class, own, slot)
            return out
        for at in range(0, len(ids), CHUNK):
            part = slice(at, at + CHUNK)
            out[part] = _softmax(self.class_bias, self.w.of_class, [r[part] for r in of_class],
                                 kinds[part], sums, 0)
        for at in range(0, len(head), CHUNK):
            part = slice(at, at + CHUNK)
            out[head[part]] += _softmax(self.word_bias[own[part]], self.w.in_class,
                                        [r[part] for r in in_class], slot[part], sums, 1)
        tail = np.flatnonzero((ids < KNOWN) & (kinds >= HEAD_CLASSES))
        out[tail] += np.log((self.v.counts[ids[tail]] + 1) / self.v.mass[kinds[tail]])
        return out


def _softmax(bias: np.ndarray, weights: np.ndarray, rows: list[np.ndarray], target: np.ndarray,
             sums: Sums | None, table: int) -> np.ndarray:
    """Log-probability of each target; with ``sums``, adds up the uses of the weights."""
    z = weights.take(rows[0], axis=0)
    for r in rows[1:]:
        z += weights.take(r, axis=0)
    z += bias
    chosen = z[np.arange(len(z)), target]
    np.exp(z, out=z)  # weights are kept small enough for float32
    total = z.sum(axis=1)
    if sums:
        z /= total[:, None]
        sums.add(table, rows, target, z)
    return chosen - np.log(total)


class Sums:
    """Observed and expected uses of every weight, over a task's tokens."""

    def __init__(self) -> None:
        self.observed = [np.zeros((BUCKETS, n)) for n in (CLASSES, SLOTS)]
        self.expected = [np.zeros((BUCKETS, n)) for n in (CLASSES, SLOTS)]
        self.inside = np.zeros((BUCKETS, HEAD_CLASSES))  # tokens by bucket and class

    def add_unweighted(self, of_class: list[np.ndarray], kinds: np.ndarray,
                       in_class: list[np.ndarray], own: np.ndarray, slot: np.ndarray) -> None:
        """Counts alone: while all weights are zero, a bucket's expectation is its
        number of tokens (of a class) times the bias distribution (of that class)."""
        for table, rows, target in ((0, of_class, kinds), (1, in_class, slot)):
            observed = self.observed[table].reshape(-1)
            for r in rows:
                np.add.at(observed, r.astype(np.int64) * self.observed[table].shape[1] + target, 1.0)
        for r in in_class:
            np.add.at(self.inside.reshape(-1), r.astype(np.int64) * HEAD_CLASSES + own, 1.0)

    def expect_bias(self, model: Model) -> None:
        """The expectations of what ``add_unweighted`` has counted."""
        for table, tokens, bias in ((0, self.observed[0].sum(axis=1, keepdims=True),
                                     model.class_bias[None, :]), (1, self.inside, model.word_bias)):
            p = np.exp(bias.astype(float))
            self.expected[table] += tokens @ (p / p.sum(axis=1, keepdims=True))

    def add(self, table: int, rows: list[np.ndarray], target: np.ndarray, p: np.ndarray) -> None:
        n = p.shape[1]
        observed, expected = self.observed[table].reshape(-1), self.expected[table]
        ones = np.ones(len(p), np.float32)
        for r in rows:
            np.add.at(observed, r.astype(np.int64) * n + target, 1.0)
            # tokens by bucket; buckets of equally many tokens are added up together
            order = np.argsort(r, kind="stable")
            by = r[order]
            first = np.flatnonzero(np.r_[True, by[1:] != by[:-1]])
            sizes = np.diff(np.r_[first, len(by)])
            bucket = by[first].astype(np.int64)
            for size in range(1, TOGETHER + 1):
                k = np.flatnonzero(sizes == size)
                if len(k):
                    own = p.take(order[first[k]], axis=0)
                    for j in range(1, size):
                        own += p.take(order[first[k] + j], axis=0)
                    expected[bucket[k]] += own
            k = np.flatnonzero(sizes > TOGETHER)
            for b, a, size in zip(bucket[k].tolist(), first[k].tolist(), sizes[k].tolist()):
                expected[b] += ones[:size] @ p.take(order[a:a + size], axis=0)

    def blocks(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(block number, observed, expected) of the blocks that were used."""
        for table in (0, 1):
            for at in range(0, BUCKETS, BLOCK):
                seen = self.observed[table][at:at + BLOCK]
                if seen.any():
                    expected = np.round(self.expected[table][at:at + BLOCK] * 16) / 16
                    yield (table * (BUCKETS // BLOCK) + at // BLOCK,
                           seen.astype("<f8").tobytes(), expected.astype("<f8").tobytes())


BLOCK_SCHEMA = "block int, observed binary, expected binary"


def _block_batch(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()),
         pa.array([r[2] for r in rows], pa.binary())], names=["block", "observed", "expected"])


def gradient_sums(rows: DataFrame, words: Broadcast, weights: Weights
                  ) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Observed and expected sums over all tokens of ``rows``, by block."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def local(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sums = Model(words.value, shared.value), Sums()
        zero = not (own.w.of_class.any() or own.w.in_class.any())
        some = False
        for batch in it:
            for ids, starts, _, _ in _calls(batch.column(0), own.v, None):
                own.log_probabilities(ids, starts, sums, zero)
                some = True
        if some:
            if zero:
                sums.expect_bias(own)
            for block in sums.blocks():
                yield _block_batch([block])

    def total(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}  # at most the weights
        for batch in it:
            for b, seen, expected in zip(*(c.to_pylist() for c in batch.columns)):
                pair = [np.frombuffer(x, "<f8") for x in (seen, expected)]
                held[b] = [x + y for x, y in zip(held[b], pair)] if b in held else pair
        for b, (seen, expected) in held.items():
            yield _block_batch([(b, seen.tobytes(), expected.tobytes())])

    blocks = 2 * BUCKETS // BLOCK
    out = (rows.select("text").mapInArrow(local, BLOCK_SCHEMA).repartition(blocks, "block")
           .mapInArrow(total, BLOCK_SCHEMA).collect())
    shared.destroy()
    return [(r["block"], np.frombuffer(r["observed"], "<f8"), np.frombuffer(r["expected"], "<f8"))
            for r in out]


def _calls(texts: pa.Array, v: Vocabulary, others: list[Counter[bytes]] | None
           ) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Tokens of about ``CALL`` tokens' worth of texts at a time: (ids, first
    tokens, first text, texts)."""
    parts: list[np.ndarray] = []
    held, first = 0, 0
    for k, text in enumerate(texts):
        own = Counter() if others is not None else None
        parts.append(token_ids(text.as_py(), v, own))
        if others is not None:
            others.append(own)
        held += len(parts[-1])
        if held >= CALL or k == len(texts) - 1:
            starts = np.cumsum([0, *map(len, parts[:-1])])
            yield np.concatenate(parts), starts, first, len(parts)
            parts, held, first = [], 0, k + 1


def updated(weights: Weights, sums: list[tuple[int, np.ndarray, np.ndarray]],
            step: float) -> Weights:
    """Weights moved along the gradient (observed minus expected), each scaled as
    in iterative scaling: a step of log(observed / expected) / features."""
    tables = [weights.of_class.copy(), weights.in_class.copy()]
    per = BUCKETS // BLOCK
    for block, seen, expected in sums:
        t, n = tables[block // per], FEATURES[block // per]
        rows = slice(block % per * BLOCK, (block % per + 1) * BLOCK)
        move = np.log((seen + PRIOR) / (expected + PRIOR)).reshape(BLOCK, -1)
        t[rows] = np.clip(t[rows] + step / n * move, -8, 8)
    return Weights(*tables)


def fit_model(rows: DataFrame, rounds: int = ROUNDS,
              most: int = KNOWN) -> tuple[Model, DataFrame]:
    """The model of all texts of ``rows`` (doc_id, text), and the counts of the
    words that are not among its known ones."""
    vocabulary, others = fit_vocabulary(materialize(count_words(rows), "lm-counts"), most)
    words, weights = rows.sparkSession.sparkContext.broadcast(vocabulary), Weights.zero()
    for r in range(rounds):
        part = rows.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds)) == r)
        step = STEPS[min(r, len(STEPS) - 1)]
        weights = updated(weights, gradient_sums(part, words, weights), step)
    words.destroy()
    return Model(vocabulary, weights), others


PARTIAL = ("row long, doc_id {kind}, n_tokens long, n_known long, base_score double, score double, "
           "others array<struct<word:binary,n:long>>")
_LOG10 = float(np.log(10))


def _lists(counters: list[Counter[bytes]]) -> pa.Array:
    """Words and their numbers, a list for each counter."""
    words = pa.array([w for c in counters for w in c], pa.binary())
    numbers = pa.array([k for c in counters for k in c.values()], pa.int64())
    ends = np.cumsum([0, *map(len, counters)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(
        [words, numbers], names=["word", "n"]))


def score_texts(rows: DataFrame, model: Model, others: DataFrame) -> DataFrame:
    """n_tokens, n_known, base_score and score of every (doc_id, text) row."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast((model.v, model.w))
    total = model.v.tokens + model.v.distinct + 1

    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        base = np.log((own.v.counts + 1) / total) if len(own.v.counts) else np.zeros(0)
        for batch in it:
            left: list[Counter[bytes]] = []
            for ids, starts, first, n in _calls(batch.column(2), own.v, left):
                p = own.log_probabilities(ids, starts)
                known = ids < KNOWN
                b = np.zeros(len(ids))
                b[known] = base[ids[known]]
                sizes = np.diff(np.r_[starts, len(ids)])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, n), batch.column(1).slice(first, n),
                    pa.array(sizes), pa.array(np.add.reduceat(known.astype(np.int64), starts)),
                    pa.array(np.add.reduceat(b, starts) / _LOG10),
                    pa.array(np.add.reduceat(p, starts) / _LOG10),
                    _lists(left[first:first + n])],
                    names=["row", "doc_id", "n_tokens", "n_known", "base_score", "score", "others"])

    # the row numbers are written with the rows, so later reads agree on them
    partial = materialize(
        rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
        .mapInArrow(score, PARTIAL.format(kind=kind)), "lm-scores")
    mass = F.array(*(F.lit(float(m)) for m in model.v.mass))
    seen = F.coalesce(F.col("c"), F.lit(0))
    rest = (partial.select("row", F.inline("others")).join(others, "word", "left")
            .groupBy("row").agg(
                F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("k"),
                F.sum(F.col("n") * F.log10((seen + 1) / F.lit(float(total)))).alias("b"),
                F.sum(F.col("n") * F.log10((seen + 1) / mass[tail_class_column("word")]))
                .alias("s")))
    return (partial.drop("others").join(rest, "row", "left")
            .select("doc_id", "n_tokens", (F.col("n_known") + F.coalesce("k", F.lit(0))).alias("n_known"),
                    F.lit(model.v.tokens).cast("long").alias("train_tokens"),
                    (F.col("base_score") + F.coalesce("b", F.lit(0.0))).alias("base_score"),
                    (F.col("score") + F.coalesce("s", F.lit(0.0))).alias("score")))


def score_documents(docs: DataFrame, folds: int = FOLDS, held: int = HELD,
                    most: int = KNOWN) -> DataFrame:
    """Scores of all rows under the model of the rows outside the held-out fold."""
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    model, others = fit_model(rows.filter(~in_fold("doc_id", folds, held)), most=most)
    return (score_texts(rows, model, others)
            .select("doc_id", in_fold("doc_id", folds, held).alias("held_out"), "n_tokens", "n_known",
                    "train_tokens", "base_score", "score"))
