"""Runs of repeating words by maximal-pair enumeration.

A run is a stretch of consecutive words whose smallest period ``q`` (words ``q``
apart are identical) fits at least ``EXPONENT`` times and that no neighbouring
word extends keeping period ``q``; short stretches (under ``MIN_WORDS`` words)
do not count.

Method: the suffixes of a text's words are sorted, and the tree of LCP intervals
is built bottom-up from their longest common prefixes. Every interval carries
its positions in lists by left word (and one list over all, to find the list
that holds a partner). Where two intervals meet, positions with different left
words form maximal pairs: they agree on exactly ``l`` words and neither side can
be extended. A pair at distance ``p`` spans ``p + l`` words of period ``p``, so
those with ``l >= (EXPONENT - 1) * p`` are exactly the runs (once per multiple of
the smallest period; the smallest distance of a span is its period), and nothing
has to be extended.

Only pairs within ``l / (EXPONENT - 1) <= l / 3`` words are looked at, which
keeps the work near n log n: occurrences of one string that close to each other
are spaced by its period, so all but the first follow the same word. Hence the
partners to the right of a position share one left word, and to its left only
the first occurrence in reach can differ. Lists are merged small into large.

Plan: one pass over the texts in Arrow batches, no shuffle; texts are cut into
calls of about ``CALL_WORDS`` words, and a longer text is a call of its own, so a
worker holds a bounded multiple of its longest text (about 0.5 KB a word). A text
in which no five words recur close enough to be part of a run (a lossless test
over exact 64-bit hashes, equal words have equal hashes) skips the sort.

Defined results: null, empty and blank texts have no words, no runs and an empty
collapsed text; the first of equal-length runs is the one that starts first;
repeated rows get equal results; an empty table gives an empty result; only
doc_id and text are read, whatever the other columns are called.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 6
EXPONENT = 4
#: words that recur at least in any run: the shortest common prefix of its pairs
SEED = 5
#: words of the texts that are looked at together
CALL_WORDS = 1 << 18

Run = tuple[int, int, int]


def suffix_order(ids: np.ndarray) -> np.ndarray:
    """Positions of ``ids`` in the order of their suffixes, by prefix doubling;
    positions that are already alone in their group are not sorted again."""
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    rank = _dense(rank[order], order, n)
    open_ = _together(rank, order)
    k = 1
    while len(open_):
        # slots of the order that hold an undecided position, group by group
        at = order[open_]
        later = np.where(at + k < n, rank[np.minimum(at + k, n - 1)] + 1, 0)
        by = np.lexsort((later, rank[at]))
        at, later = at[by], later[by]
        order[open_] = at
        group = rank[at]
        first = np.r_[True, group[1:] != group[:-1]]
        fresh = first | np.r_[True, later[1:] != later[:-1]]
        # a group's rank is the slot of its first member
        rank[at] = open_[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
        alone = fresh & np.r_[fresh[1:], True]
        open_ = open_[~alone]
        k *= 2
    return order


def _dense(sorted_rank: np.ndarray, order: np.ndarray, n: int) -> np.ndarray:
    first = np.r_[True, sorted_rank[1:] != sorted_rank[:-1]]
    out = np.empty(n, dtype=np.int64)
    out[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    return out


def _together(rank: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Slots whose group has more than one position."""
    r = rank[order]
    same = r[1:] == r[:-1]
    return np.flatnonzero(np.r_[same, False] | np.r_[False, same])


def common_prefixes(ids: list[int], order: list[int]) -> list[int]:
    """For each slot, the words that its suffix shares with the slot before."""
    n = len(ids)
    before = [-1] * n
    for x, y in zip(order, order[1:]):
        before[y] = x
    out = [0] * n  # by position; the next position shares at most one word less
    h = 0
    for i in range(n):
        j = before[i]
        if j < 0:
            h = 0
            continue
        top = n - max(i, j)
        while h < top and ids[i + h] == ids[j + h]:
            h += 1
        out[i] = h
        if h:
            h -= 1
    return [out[i] for i in order]


class Interval:
    """An LCP interval's positions: all in order, and in lists by left word."""

    __slots__ = ("all", "lists")

    def __init__(self, position: int, left: int):
        self.all = [position]
        self.lists = {left: [position]}

    def absorb(self, other: Interval) -> None:
        self.all = _merged(self.all, other.all)
        for left, more in other.lists.items():
            own = self.lists.get(left)
            self.lists[left] = _merged(own, more) if own else more


def _merged(large: list[int], small: list[int]) -> list[int]:
    if len(small) * 16 > len(large):
        large += small
        large.sort()
    else:
        for x in small:
            insort(large, x)
    return large


def maximal_pairs(x: Interval, y: Interval, l: int, reach: int, left: list[int],
                  found: dict[tuple[int, int], int]) -> Interval:
    """Merge two children of the interval with common prefix ``l``; for pairs of
    positions at most ``reach`` apart with different left words, note the
    smallest distance of the span (first word, word after the last)."""
    small, large = (x, y) if len(x.all) <= len(y.all) else (y, x)
    if reach:
        ordered, lists = large.all, large.lists
        for own, positions in small.lists.items():
            for i in positions:
                at = bisect_right(ordered, i)
                if at < len(ordered) and ordered[at] <= i + reach:
                    other = left[ordered[at]]
                    if other != own:  # all partners in reach follow that word
                        far = lists[other]
                        for k in range(bisect_right(far, i), len(far)):
                            j = far[k]
                            if j > i + reach:
                                break
                            _note(found, i, j, l)
                if at and ordered[at - 1] >= i - reach:
                    j = ordered[bisect_left(ordered, i - reach)]
                    if left[j] != own:  # only the first occurrence can differ
                        _note(found, j, i, l)
    large.absorb(small)
    return large


def _note(found: dict[tuple[int, int], int], i: int, j: int, l: int) -> None:
    span = (i, j + l)
    p = j - i
    if found.get(span, p) >= p:
        found[span] = p


def word_runs(ids: list[int], starts: set[int], min_words: int = MIN_WORDS,
              exponent: int = EXPONENT) -> list[Run]:
    """(start, length, period) of all runs in ``ids``; ``starts``: first positions
    of texts, whose left word is unlike any other (texts share no ids)."""
    order = suffix_order(np.asarray(ids, dtype=np.int64)).tolist()
    shared = common_prefixes(ids, order)
    left = [-1 - i if i in starts else ids[i - 1] for i in range(len(ids))]
    seed = max(1, min(min_words - p if p * exponent <= min_words else p * (exponent - 1)
                      for p in range(1, min_words + 1)))
    found: dict[tuple[int, int], int] = {}
    stack: list[tuple[int, Interval]] = []  # open intervals: (common prefix with the one below, it)
    top = Interval(order[0], left[order[0]]) if order else None
    for slot in range(1, len(order) + 1):
        l = shared[slot] if slot < len(order) else 0
        # close what shares more than l words with the suffixes below it
        while stack and stack[-1][0] > l:
            depth, below = stack.pop()
            top = maximal_pairs(below, top, depth, depth // (exponent - 1), left, found)
        if slot == len(order):
            break
        if l >= seed:
            if stack and stack[-1][0] == l:
                top = maximal_pairs(stack.pop()[1], top, l, l // (exponent - 1), left, found)
            stack.append((l, top))
        top = Interval(order[slot], left[order[slot]])
    return sorted((i, end - i, p) for (i, end), p in found.items() if end - i >= min_words)


_RNG = np.random.default_rng(13)
_FACTORS = _RNG.integers(1, 1 << 63, size=SEED, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def may_hold_runs(ids: np.ndarray, texts: np.ndarray, count: int) -> np.ndarray:
    """Texts (by number below ``count``) that can hold a run of exponent 4 and 6 words.

    Inside a run of period q and n words, n - q - 4 consecutive positions each
    see their five words again at most q words on, and q <= (that number + 4) / 3."""
    out = np.zeros(count, dtype=bool)
    n = len(ids) - SEED + 1
    if n < 2:
        return out
    h = (texts[:n].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    u = ids.astype(np.uint64)
    for j in range(SEED):
        h += (u[j:n + j] + np.uint64(1)) * _FACTORS[j]
    h ^= h >> np.uint64(31)
    order = np.argsort(h, kind="stable")
    same = np.flatnonzero(h[order[1:]] == h[order[:-1]])
    here, again = order[same], order[same + 1]
    # five words must lie inside one text
    inside = (texts[here + SEED - 1] == texts[here]) & (texts[again + SEED - 1] == texts[here])
    here, again = here[inside], again[inside]
    if not len(here):
        return out
    by = np.argsort(here)
    here, gap = here[by], (again - here)[by]
    new = np.flatnonzero(np.r_[True, (here[1:] != here[:-1] + 1) | (texts[here[1:]] != texts[here[:-1]])])
    length = np.diff(np.r_[new, len(here)])
    near = np.minimum.reduceat(gap, new) * 3 <= length + 4
    out[texts[here[new[near]]]] = True
    return out


def collapsed(words: list[str], runs: list[Run]) -> str:
    """The words that no run contains after its first period, joined by one space."""
    if not runs:
        return " ".join(words)
    keep = bytearray(b"\x01") * len(words)
    for start, length, period in runs:
        keep[start + period:start + length] = bytes(length - period)
    return " ".join(w for w, k in zip(words, keep) if k)


def runs_of(texts: list[list[str]]) -> list[list[Run]]:
    """The runs of each text (a list of words)."""
    known: dict[str, int] = {}
    flat = [known.setdefault(w, len(known)) for words in texts for w in words]
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    ids = np.asarray(flat, dtype=np.int64)
    number = np.repeat(np.arange(len(texts)), sizes)
    ends = np.cumsum(sizes)
    out: list[list[Run]] = [[] for _ in texts]
    chosen = np.flatnonzero(may_hold_runs(ids, number, len(texts)))
    if not len(chosen):
        return out
    # one suffix order for all of them: texts share no ids, a mark ends each
    parts, at, first = [], 0, []
    for t in chosen:
        own = ids[ends[t] - sizes[t]:ends[t]]
        parts += [own + t * len(known), [-1 - t]]
        first.append(at)
        at += len(own) + 1
    marks = np.asarray(first)
    for start, length, period in word_runs(np.concatenate(parts).tolist(), set(first)):
        k = int(np.searchsorted(marks, start, "right")) - 1
        out[chosen[k]].append((start - first[k], length, period))
    return out


def words_of(text: str) -> list[str]:
    """``[^\\x20\\x09-\\x0D]+``; other scripts' spaces belong to words."""
    return [w.decode("utf-8", "surrogatepass")
            for w in text.encode("utf-8", "surrogatepass").split()]


RUNS = "array<struct<start:long,length:long,period:long>>"
_ARROW_RUNS = pa.list_(pa.struct([(f, pa.int64()) for f in ("start", "length", "period")]))


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str | Column = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row: runs by start, then period;
    collapsed is the text's words without the repeats inside its runs."""
    rows = docs.select(F.col(doc_id).alias("doc_id"),
                       F.coalesce((F.col(text) if isinstance(text, str) else text).cast("string"),
                                  F.lit("")).alias("text"))

    def find(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            texts = batch.column(1)
            at = 0
            while at < batch.num_rows:
                words, held, begin = [], 0, at
                while at < batch.num_rows and (held < CALL_WORDS):
                    words.append(words_of(texts[at].as_py()))
                    held += len(words[-1])
                    at += 1
                runs = runs_of(words)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(begin, at - begin),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array([[{"start": s, "length": n, "period": p} for s, n, p in r]
                              for r in runs], _ARROW_RUNS),
                    pa.array([collapsed(w, r) for w, r in zip(words, runs)], pa.string()),
                ], names=["doc_id", "n_words", "runs", "collapsed"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(find, f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string")
