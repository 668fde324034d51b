"""Toxicity by the nearest labelled examples: exact TF-IDF cosine, block-max index.

Terms are lower-cased words and their four- and five-letter beginnings (for
inflected forms). The vocabulary is every term of the labelled examples; a term
of none of them adds to no cosine's numerator and would scale all cosines of a
document alike, so it is left out of its norm. Document frequencies are counted
over all documents. A term that leans toxic weighs more, by ``SIGNAL`` times the
root of its chi-square with the label; no term is dropped.

The index holds the labelled examples in blocks of ``BLOCK`` similar ones. The
postings of the ``COMMON`` most frequent terms, which most texts share, are
kept block by block as small dense tables with the largest weight of each term in
the block; the postings of all other terms are lists. A batch of queries first
adds up the lists (they are short), which gives every example's exact rest; the
block maxima (and the block's largest norm, by Cauchy-Schwarz) bound what the
common terms can add. The ``FIRST`` blocks that are likeliest by their means are scored,
then all blocks that can still reach the k-th best cosine. That filter is in single
precision with a margin; what passes is scored again in double precision, so the k
nearest are exact (ties: smallest example id) and do not depend on the batch.
Votes are weighted by cosine and smoothed with the base rate; a document without
any term of the vocabulary has no neighbour and gets the rate of the examples
that have none either.

Texts are read once: a row's terms of the vocabulary and their counts are written
in packed form (less than the text), the document frequencies come from them, and
so do the scores; equal rows of a call are looked up once.

Defined results: null and empty texts have no terms; without any usable label
every score is 0; repeated rows get equal scores; an empty table gives an empty
result; ids may be of any type. Very long texts are scored whole, in calls of
bounded bytes; as examples serve labelled texts of bounded size
(``labelled_sample``). Only doc_id and text are read for a score.
"""

from __future__ import annotations

import pickle
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LETTERS, by_bytes, in_fold, labelled_sample, materialize, text_or_empty
from .shingles import shingle_set

#: labelled rows that make the index, at most
SAMPLE = 8000
#: weight of the root of a term's chi-square with the label
SIGNAL = 2.0
FOLDS, HELD = 4, 2
THRESHOLD = 0.3
K = 15
BLOCK = 64
#: terms whose postings are kept as tables
COMMON = 2048
#: blocks that a query scores before it compares bounds
FIRST = 8
#: more than single precision can err in a cosine
MARGIN = 1e-5
#: queries that are looked up together
QUERIES = 256
#: weight of the base rate in a vote
PRIOR = 0.5
WORDS_KEPT = 250_000


def terms_of(word: str) -> tuple[str, ...]:
    """The word and its beginnings."""
    return (word, *(word[:n] + "*" for n in (4, 5) if len(word) >= n))


def toxic_lean(texts: list[str], rows: list[np.ndarray], labels: list[int], terms: int
               ) -> np.ndarray:
    """Chi-square between presence and label of the terms that lean toxic, else 0;
    ``rows``: the distinct term ids of each text.

    Copies and near copies count once (texts that share one of their three
    smallest shingles with an earlier one), else a copied text's every word
    would stand out.
    """
    seen_shingles: set[int] = set()
    n = pos = 0
    seen, toxic = np.zeros(terms), np.zeros(terms)
    for text, ids, y in zip(texts, rows, labels, strict=True):
        own = shingle_set(text)[:3].tolist()
        if own and seen_shingles.isdisjoint(own):
            n, pos = n + 1, pos + y
            seen[ids] += 1
            toxic[ids] += y
        seen_shingles.update(own)
    out = np.zeros(terms)
    diff = toxic - seen * (pos / max(n, 1))  # over what chance would give
    lean = (diff > 0) & (seen < n)
    if 0 < pos < n:
        df = seen[lean]
        out[lean] = diff[lean] ** 2 * float(n) ** 3 / (df * (n - df) * pos * (n - pos))
    return out


def weights(ids: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF weights of one sparse row."""
    w = (1 + np.log(counts)) * idf[ids]
    return w / np.sqrt((w * w).sum())


def similar_order(rows: np.ndarray, block: int) -> np.ndarray:
    """An order in which rows that point the same way stand side by side: halves
    along the leading directions of all rows, and of each half again."""
    rng = np.random.default_rng(6)
    lead = rng.standard_normal((rows.shape[1], 8)).astype(rows.dtype)
    for _ in range(4):
        lead = np.linalg.qr(rows.T @ (rows @ lead))[0]
    key = rows @ lead
    out, open_ = [], [np.arange(len(rows))]
    while open_:
        own = open_.pop()
        if len(own) <= block:
            out.append(own)
            continue
        own = own[np.argsort(key[own, np.argmax(key[own].var(axis=0))], kind="stable")]
        half = -(-len(own) // (2 * block)) * block  # all blocks but the last are full
        open_ += [own[half:], own[:half]]
    return np.concatenate(out)


class BlockMaxIndex:
    """Inverted index over labelled examples with block maxima."""

    def __init__(self, examples: list[tuple[object, np.ndarray, np.ndarray, int]], terms: int,
                 block: int = BLOCK, common: int = COMMON):
        # (id, term ids, weights, label); ids in order, so that rows break ties by id
        examples = sorted(examples, key=lambda e: e[0])
        self.block, self.n, self.terms = block, len(examples), terms
        self.ids = [e[0] for e in examples]
        self.labels = np.array([e[3] for e in examples], dtype=float)
        self.ends = np.cumsum([0, *(len(e[1]) for e in examples)])
        self.term = np.concatenate([e[1] for e in examples]).astype(np.int32)
        self.weight = np.concatenate([e[2] for e in examples])
        row = np.repeat(np.arange(self.n), np.diff(self.ends))
        often = np.argsort(-np.bincount(self.term, minlength=terms), kind="stable")[:common]
        self.common = len(often)
        self.column = np.full(terms, -1)
        self.column[often] = np.arange(len(often))
        column = self.column[self.term]
        inside = column >= 0
        table = np.zeros((self.n, len(often)), np.float32)
        table[row[inside], column[inside]] = self.weight[inside]
        # slots: rows in blocks of similar ones, the last block filled up with nothing
        self.blocks = -(-self.n // block)
        self.slots = self.blocks * block
        order = similar_order(table, block)
        self.row = np.full(self.slots, -1)
        self.row[:self.n] = order
        slot = np.empty(self.n, dtype=np.int64)
        slot[order] = np.arange(self.n)
        full = np.zeros((self.slots, self.common), np.float32)
        np.take(table, order, axis=0, out=full[:self.n])
        self.tables = full.reshape(self.blocks, block, self.common)
        self.top, self.mean = self.tables.max(axis=1), self.tables.mean(axis=1)
        self.norm = np.sqrt((self.tables ** 2).sum(axis=2)).max(axis=1)
        # lists of the other terms
        order = np.flatnonzero(~inside)
        order = order[np.argsort(self.term[order], kind="stable")]
        self.lists = np.searchsorted(self.term[order], np.arange(terms + 1))
        # slot and weight side by side, so that a list is one stretch of memory
        self.postings = np.stack([slot[row[order]], self.weight[order]], axis=1).astype(np.float32)
        self.query = np.zeros(terms)  # the query at hand, term by term
        self.asked = self.scored = 0  # (query, block) pairs

    def nearest(self, ids: np.ndarray, w: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the k best examples with a positive cosine."""
        return self.nearest_of([(ids, w)], k)[0]

    def nearest_of(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int
                   ) -> list[tuple[np.ndarray, np.ndarray]]:
        """Rows and cosines of the k best examples of each query."""
        n = len(queries)
        self.asked += n * self.blocks
        q = np.zeros((n, self.common), np.float32)
        for i, (ids, w) in enumerate(queries):
            column = self.column[ids]
            inside = column >= 0
            q[i, column[inside]] = w[inside]
        bound = np.minimum(q @ self.top.T, np.sqrt((q * q).sum(axis=1))[:, None] * self.norm)
        # queries that lean to the same blocks side by side: they want the same tables
        order = np.argsort(bound.argmax(axis=1), kind="stable")
        queries, q, bound = [queries[i] for i in order.tolist()], q[order], bound[order]
        rest = np.zeros((n, self.slots), np.float32)
        for i, (ids, w) in enumerate(queries):
            inside = self.column[ids] >= 0
            others = ids[~inside]
            begin, end = self.lists[others], self.lists[others + 1]
            if len(others):
                found = np.concatenate([self.postings[a:b] for a, b in
                                        zip(begin.tolist(), end.tolist())])
                parts = found[:, 1] * np.repeat(w[~inside].astype(np.float32), end - begin)
                rest[i] = np.bincount(found[:, 0].astype(np.intp), weights=parts,
                                      minlength=self.slots)
        # a block's best rest, with the most and with the mean that its common terms add
        most = rest.reshape(n, self.blocks, self.block).max(axis=2)
        likely = most + q @ self.mean.T
        bound += most
        scores = np.full((n, self.slots), -1, np.float32)
        some = min(FIRST, self.blocks)
        first = np.zeros((n, self.blocks), dtype=bool)
        best = np.argpartition(-likely, some - 1, axis=1)[:, :some]
        np.put_along_axis(first, best, True, axis=1)
        self._score(scores, rest, q, first)
        by_block = scores.reshape(n, self.blocks, self.block)
        seen = np.take_along_axis(by_block, best[:, :, None], axis=1).reshape(n, -1)
        # at least k examples are as near as this, so farther ones are out
        least = kth_best(seen, k)[:, None] - MARGIN
        self._score(scores, rest, q, ~first & (bound >= least) & (bound > 0))
        query, slot = np.nonzero(scores >= np.maximum(least, -MARGIN))
        ends = np.searchsorted(query, np.arange(n + 1))
        out = []
        for i, (ids, w) in enumerate(queries):
            own = slot[ends[i]:ends[i + 1]]
            if len(own) > k:
                near = scores[i, own]
                own = own[near >= np.partition(near, -k)[-k] - MARGIN]
            own = self.row[own]
            out.append(self._exact(ids, w, own[own >= 0], k))
        return [out[i] for i in np.argsort(order).tolist()]

    def _score(self, scores: np.ndarray, rest: np.ndarray, q: np.ndarray, wanted: np.ndarray
               ) -> None:
        """Fill in the scores of the wanted (query, block) pairs, block by block."""
        self.scored += int(wanted.sum())
        block, query = np.nonzero(wanted.T)
        ends = np.searchsorted(block, np.arange(self.blocks + 1))
        for b in np.flatnonzero(np.diff(ends)).tolist():
            own = query[ends[b]:ends[b + 1]]
            part = slice(b * self.block, (b + 1) * self.block)
            if 2 * len(own) > own[-1] - own[0]:  # mostly wanted: a stretch needs no copy
                own = slice(own[0], own[-1] + 1)
            scores[own, part] = rest[own, part] + q[own] @ self.tables[b].T

    def _exact(self, ids: np.ndarray, w: np.ndarray, rows: np.ndarray, k: int
               ) -> tuple[np.ndarray, np.ndarray]:
        """The k best of ``rows`` by their cosine in double precision."""
        if not len(rows):
            return rows, np.zeros(0)
        rows = np.sort(rows)
        stretches = list(zip(self.ends[rows].tolist(), self.ends[rows + 1].tolist()))
        self.query[ids] = w
        parts = self.query[np.concatenate([self.term[a:b] for a, b in stretches])]
        self.query[ids] = 0
        parts *= np.concatenate([self.weight[a:b] for a, b in stretches])
        cos = np.add.reduceat(parts, np.cumsum([0, *(b - a for a, b in stretches[:-1])]))
        rows, cos = rows[cos > 0], cos[cos > 0]
        order = np.lexsort((rows, -np.round(cos, 12)))[:k]
        return rows[order], cos[order]


def kth_best(scores: np.ndarray, k: int) -> np.ndarray:
    """Of each row the k-th largest number, or 0 with fewer positive ones."""
    if scores.shape[1] < k:
        return np.zeros(len(scores), scores.dtype)
    return np.maximum(np.partition(scores, -k, axis=1)[:, -k], 0)


class Neighbours:
    """The index with its vocabulary, rates and vote."""

    def __init__(self, index: BlockMaxIndex | None, idf: np.ndarray, base: float, none: float):
        self.index, self.idf, self.base, self.none = index, idf, base, none

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]], k: int = K
               ) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """Vote, examples (their rows in the index) and cosines of each row of term
        ids and counts."""
        nobody = (self.none, np.zeros(0, np.int64), np.zeros(0))
        if self.index is None:
            return [nobody] * len(rows)
        place: dict[tuple[bytes, bytes], int] = {}
        which = [place.setdefault((ids.tobytes(), n.tobytes()), len(place)) for ids, n in rows]
        own = {w: i for i, w in reversed(list(enumerate(which)))}
        once = [rows[own[w]] for w in range(len(place))]
        out = [nobody] * len(once)
        some = [i for i, (ids, _) in enumerate(once) if len(ids)]
        queries = [(once[i][0], weights(*once[i], self.idf)) for i in some]
        for i, (near, cos) in zip(some, self.index.nearest_of(queries, k) if queries else []):
            if len(near):
                vote = (cos @ self.index.labels[near] + PRIOR * self.base) / (cos.sum() + PRIOR)
                out[i] = (float(vote), near, np.round(cos, 6))
        return [out[w] for w in which]


#: a character beyond ASCII that is no letter
ODD = re.compile(r"[^\x00-\x7f](?<![^\W\d_])")
#: ASCII characters but letters as spaces
SPACED = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """The lower-cased words (``LETTERS``) of a text."""
    low = text.lower()
    if ODD.search(low):
        return [w.encode("utf-8", "surrogatepass") for w in LETTERS.findall(low)]
    return low.encode("utf-8", "surrogatepass").translate(SPACED).split()


class _Hits(dict):
    """Of each word that was seen, its terms in the vocabulary, packed."""

    def __init__(self, place: dict[bytes, int]):
        super().__init__()
        self.place = place

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > WORDS_KEPT:
            self.clear()
        find = self.place.get
        if word.isascii():
            size, four, five = len(word), word[:4], word[:5]
        else:
            text = word.decode("utf-8", "surrogatepass")
            size = len(text)
            four, five = (text[:n].encode("utf-8", "surrogatepass") for n in (4, 5))
        # a vocabulary has a word's beginnings with the word: without the shorter
        # one there is no longer one, nor the word
        hits = [find(four + b"*")] if size >= 4 else []
        if size >= 5 and hits[0] is not None:
            hits.append(find(five + b"*"))
        if not hits or hits[-1] is not None:
            hits.append(find(word))
        out = self[word] = b"".join(_pack(h) for h in hits if h is not None)
        return out


_pack = struct.Struct("=i").pack


def term_counter(hits: _Hits) -> Callable[[str], tuple[np.ndarray, np.ndarray]]:
    """Gives the ids and counts of a text's terms in the vocabulary."""

    def count(text: str) -> tuple[np.ndarray, np.ndarray]:
        ids = np.frombuffer(b"".join(map(hits.__getitem__, words_of(text))), np.int32).copy()
        ids.sort()
        first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else ids
        return ids[first].astype(np.int64), np.diff(np.r_[first, len(ids)])

    return count


_HITS: dict[str, _Hits] = {}
_MODEL: dict[str, Neighbours] = {}


def hits_of(name: str, shared) -> _Hits:
    """The words seen so far, kept by the worker for its next task."""
    if name not in _HITS:
        _HITS.clear()
        _MODEL.clear()
        terms = zlib.decompress(shared.value).split(b"\n")
        _HITS[name] = _Hits({t: k for k, t in enumerate(terms)})
    return _HITS[name]


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs."""
    kind = next(k for k in ("<u1", "<u2", "<u4") if numbers.max(initial=0) < 1 << (8 * int(k[2])))
    return kind[2].encode() + numbers.astype(kind).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[:1].decode()}", offset=1).astype(np.int64)


def counted_terms(docs: DataFrame, name: str, places) -> DataFrame:
    """doc_id, and the terms (as steps from one to the next) and counts, packed."""

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms_in = term_counter(hits_of(name, places))
        for batch in it:
            for part in by_bytes(batch, 1, 4096):
                rows = [terms_in(text.as_py()) for text in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0),
                     pa.array([packed(np.diff(ids, prepend=0)) for ids, _ in rows], pa.binary()),
                     pa.array([packed(n) for _, n in rows], pa.binary())],
                    names=["doc_id", "terms", "counts"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        count, f"doc_id {kind}, terms binary, counts binary")


def document_frequencies(counted: DataFrame, terms: int) -> tuple[int, np.ndarray]:
    """Number of documents, and of those with each term of the vocabulary."""

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the last place counts all documents
        df = np.zeros(terms + 1, dtype=np.int64)
        for batch in it:
            df[-1] += batch.num_rows
            for data in batch.column(0):
                df[np.cumsum(unpacked(data.as_py()))] += 1
        own = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(df[own])], names=["t", "n"])

    found = (counted.select("terms").mapInArrow(count, "t long, n long")
             .groupBy("t").agg(F.sum("n").alias("n")).toArrow())  # a row per term at most
    df = np.zeros(terms + 1, dtype=np.int64)
    df[found["t"].to_numpy()] = found["n"].to_numpy()
    return int(df[-1]), df[:-1]


def packed_examples(rows: list[tuple], idf: np.ndarray) -> bytes:
    """Labelled (id, label, term ids, counts) rows, and the weights: a worker
    builds the index from them, which is several times their size."""
    return zlib.compress(pickle.dumps(
        ([(r[0], r[1], len(r[2])) for r in rows],
         *(np.concatenate([np.zeros(0, np.int32), *(r[k] for r in rows)]) for k in (2, 3)),
         idf)), 1)


def build_index(packed: bytes) -> Neighbours:
    """The index over labelled rows."""
    rows, all_ids, all_counts, idf = pickle.loads(zlib.decompress(packed))
    inside, without, at = [], [], 0
    for doc_id, y, n in rows:
        if n:
            ids = all_ids[at:at + n].astype(np.int64)
            inside.append((doc_id, ids, weights(ids, all_counts[at:at + n], idf), y))
        else:
            without.append(y)
        at += n
    base = sum(r[1] for r in rows) / len(rows) if rows else 0.0
    none = (sum(without) + PRIOR * base) / (len(without) + PRIOR) if rows else 0.0
    return Neighbours(BlockMaxIndex(inside, len(idf)) if inside else None, idf, base, none)


def model_of(name: str, shared) -> Neighbours:
    """The index of the broadcast rows, kept by the worker for its next task."""
    if name not in _MODEL:
        _MODEL.clear()
        _HITS.clear()  # the words are counted
        _MODEL[name] = build_index(shared.value)
    return _MODEL[name]


def score_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted, neighbours and similarities of every row."""
    examples = sorted(set(labelled_sample(docs, labels, "toxic", FOLDS, HELD, sample)))
    words: set[bytes] = set()
    for _, text, _ in examples:
        words.update(words_of(text))
    vocabulary = sorted({t for w in words for t in terms_of(w.decode("utf-8", "surrogatepass"))})
    del words
    place = {t.encode("utf-8", "surrogatepass"): k for k, t in enumerate(vocabulary)}
    terms_in = term_counter(_Hits(place))
    rows = [(doc_id, y, *(x.astype(np.int32) for x in terms_in(text)))
            for doc_id, text, y in examples]
    spark = docs.sparkSession.sparkContext
    # packed, as a worker keeps what was broadcast for as long as the driver does
    places = spark.broadcast(zlib.compress(b"\n".join(place), 1))
    name = uuid.uuid4().hex
    counted = materialize(counted_terms(docs, name, places), "toxicity-terms")
    total, df = document_frequencies(counted, len(place))
    idf = np.log((1 + total) / (1 + df)) + 1
    idf *= 1 + SIGNAL * np.sqrt(toxic_lean([e[1] for e in examples], [r[2] for r in rows],
                                           [e[2] for e in examples], len(place)))
    shared = spark.broadcast(packed_examples(rows, idf))

    def score(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, ids = model_of(name, shared), None
        for batch in it:
            if model.index is not None and ids is None:
                ids = pa.array(model.index.ids).cast(batch.column(0).type)
            for part in by_bytes(batch, 1, QUERIES):
                out = model.scores([(np.cumsum(unpacked(t.as_py())), unpacked(n.as_py()))
                                    for t, n in zip(part.column(1), part.column(2))])
                ends = pa.array(np.cumsum([0, *(len(o[1]) for o in out)]), pa.int32())
                rows = pa.array(np.concatenate([o[1] for o in out]))
                near = ids.take(rows) if ids is not None else pa.nulls(0, batch.column(0).type)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([o[0] for o in out], pa.float64()),
                     pa.ListArray.from_arrays(ends, near),
                     pa.ListArray.from_arrays(ends, pa.array(np.concatenate([o[2] for o in out])))],
                    names=["doc_id", "score", "neighbours", "similarities"])

    kind = dict(docs.dtypes)["doc_id"]
    scored = counted.mapInArrow(
        score, f"doc_id {kind}, score double, neighbours array<{kind}>, similarities array<double>")
    return scored.select("doc_id", in_fold("doc_id", FOLDS, HELD).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
                         "neighbours", "similarities")
