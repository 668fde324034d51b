"""Benchmark decontamination: edit-distance search with CGK embeddings and LSH.

Texts and benchmark items are sequences of lower-cased words. The CGK random
walk writes the symbol under a cursor and moves the cursor on by a random bit
of (step, symbol); two sequences at a small edit distance fall back into step
after each edit, so their walks differ in few places: edit distance becomes
Hamming distance. A signature samples ``BITS`` steps of a walk; ``REPEATS``
independent walks and samples are drawn, and a window is a candidate for an
item if one signature agrees. Candidates are verified with the exact edit
distance (Myers' bit vectors) between the item and its best place in the text.

A walk drifts out of step with every edit, so items of more than
``SEGMENT_WORDS`` words are embedded in even segments of at most that many, and
a candidate for any segment is one for its item, which is verified as a whole.
If an item is within the share, so is one of its segments at least. A walk's
bits are hashes of (repeat, symbol), not a table, and items of over
``CHUNK_WORDS`` words are verified in chunks, so an index takes memory in
proportion to the words of its items.

Segments are put into classes of similar length; a window starts at every word
of a document and has the length of the class. Windows in which too many words
occur in no segment of the class cannot be within the distance and are not
walked (a lossless count over the window). Words that occur in no item at all
are one symbol, which no item contains. Texts are looked at in calls of about
``CALL_BYTES``, short ones together, a longer one alone; its words are numbered
piece by piece and its windows filtered ``STRETCH`` places at a time, so a worker
holds some bytes for each of its words.

The benchmark side is small by nature but not assumed to be: items are dealt
over blocks of about ``BLOCK_ITEMS`` and ``BLOCK_BYTES`` (a larger item is a
block's only excess); one pass over the documents per block, each with its own
broadcast index.

Defined results: an item is found if some stretch of the text is within
``share`` of its number of words; items without words match nothing; null and
empty texts hold nothing; repeated items and repeated documents are reported
each. Empty tables give an empty result. Only doc_id, text, item_id are read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, materialize, pieces, text_or_empty

#: an item is found at an edit distance of at most this share of its words
SHARE = 0.2
REPEATS = 24
BITS = 3
#: longest piece of an item that is walked at once, and steps of a walk at most
SEGMENT_WORDS = 60
STEPS = 64
#: words of an item that are verified at once, and size of the masks that are kept
CHUNK_WORDS = 8192
MASK_BYTES = 32 << 20
#: ratio between the longest and shortest segment of a class
CLASS_RATIO = 1.2
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 16 << 20
#: bytes of texts that are looked at together, and places that are filtered at once
CALL_BYTES = 1 << 20
STRETCH = 1 << 20
#: symbols whose moves are kept in tables
TABLED_SYMBOLS = 1 << 16
WORDS = re.compile(r"\w+")
NO_WORD = re.compile(r"\W")
#: a character beyond ASCII that belongs to no word; and ASCII ones of no word as spaces
ODD = re.compile(r"[^\x00-\x7f](?<!\w)")
SPACED = bytes(b if b >= 128 or chr(b).isalnum() or chr(b) == "_" else 32 for b in range(256))


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def encoded_words(text: str) -> list[bytes]:
    """``words_of`` in UTF-8."""
    low = text.lower()
    if ODD.search(low):
        return [w.encode("utf-8", "surrogatepass") for w in WORDS.findall(low)]
    return low.encode("utf-8", "surrogatepass").translate(SPACED).split()


def walk_bits(symbols: np.ndarray, r: int) -> np.ndarray:
    """The moves of walk ``r`` at each symbol: bit j says whether step j moves on."""
    x = symbols.astype(np.uint64) + np.uint64(((r + 1) * 0x9E3779B97F4A7C15) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


def segments_of(words: int) -> list[tuple[int, int]]:
    """Even pieces (first, end) of at most ``SEGMENT_WORDS`` words."""
    n = -(-words // SEGMENT_WORDS)
    return [(k * words // n, (k + 1) * words // n) for k in range(n)]


class _Class:
    """Signature index of the segments (item, first, end) of one length class."""

    def __init__(self, segments: list[tuple[int, int, int]], tokens: list[np.ndarray],
                 symbols: int, share: float, seed: int):
        rng = np.random.default_rng([17, seed])
        self.items = np.array([i for i, _, _ in segments])
        self.offsets = np.array([first for _, first, _ in segments])
        lengths = [end - first for _, first, end in segments]
        self.low = min(lengths)
        self.slack = int(share * max(lengths))
        self.need = self.low - self.slack
        self.inside = np.zeros(symbols, dtype=bool)
        for i, first, end in segments:
            self.inside[tokens[i][first:end]] = True
        # steps that the walk of the shortest segment can take inside it, on average
        self.steps = max(1, min(STEPS, int(1.6 * self.low)))
        self.samples = np.sort(rng.integers(0, self.steps, size=(REPEATS, BITS)), axis=1)
        self.factors = rng.integers(1, 1 << 62, size=BITS, dtype=np.int64) * 2 + 1
        pad = 2 * self.steps
        flat = np.concatenate([part for i, first, end in segments
                               for part in (tokens[i][first:end], np.zeros(pad, dtype=np.int64))])
        starts = np.cumsum([0, *(n + pad for n in lengths)])[:-1]
        self.tables = []
        for r in range(REPEATS):
            sig, _ = self.signatures(flat, Moves(symbols, r), starts, r)
            order = np.argsort(sig, kind="stable")
            self.tables.append((sig[order], order))

    def windows(self, flat: np.ndarray, lo: int) -> np.ndarray:
        """Places from ``lo`` on, within a stretch, whose window can be close enough."""
        run = np.cumsum(np.r_[0, self.inside[flat[lo:lo + STRETCH + self.low - 1]]], dtype=np.int32)
        if len(run) <= self.low:
            return np.zeros(0, dtype=np.int64)
        return np.flatnonzero(run[self.low:] - run[:-self.low] >= self.need) + lo

    def signatures(self, flat: np.ndarray, moves: Moves, at: np.ndarray, r: int
                   ) -> tuple[np.ndarray, np.ndarray]:
        """Signature of the walk from each place, and whether it saw only known words."""
        place, sig = at.copy(), np.zeros(len(at), dtype=np.int64)
        known = np.ones(len(at), dtype=bool)
        samples = self.samples[r].tolist()
        for j in range(samples[-1] + 1):
            symbol = flat[place]
            if j in samples:
                known &= symbol > 0
                for b, s in enumerate(samples):
                    if s == j:
                        sig += (symbol + np.int64(1)) * self.factors[b]
            place += (moves.of(symbol) >> j) & 1
        return sig, known


class Moves:
    """The moves of one walk at each symbol, looked up where the symbols are few."""

    def __init__(self, symbols: int, r: int):
        self.r = r
        self.table = walk_bits(np.arange(symbols), r) if symbols <= TABLED_SYMBOLS else None

    def of(self, symbols: np.ndarray) -> np.ndarray:
        return walk_bits(symbols, self.r) if self.table is None else self.table[symbols]


class Index:
    """The index of one block of items: vocabulary, classes, word sequences."""

    def __init__(self, rows: list[tuple], share: float = SHARE):
        self.share = share
        self.ids = [r[0] for r in rows]
        words = [words_of(r[1]) for r in rows]
        # symbol 0 stands for every word of no item and for the end
        self.symbol = {w: k + 1 for k, w in enumerate(dict.fromkeys(w for x in words for w in x))}
        self.encoded = {w.encode("utf-8", "surrogatepass"): k for w, k in self.symbol.items()}
        self.moves = [Moves(len(self.symbol) + 1, r) for r in range(REPEATS)]
        self.tokens = [np.array([self.symbol[w] for w in x], dtype=np.int64) for x in words]
        self.limit = [int(share * len(x)) for x in words]
        self.masks: dict[int, dict[int, int]] = {}
        self.masked = 0
        segments = sorted(((i, first, end) for i, x in enumerate(words) if x
                           for first, end in segments_of(len(x))), key=lambda s: s[2] - s[1])
        groups: list[list[tuple[int, int, int]]] = []
        shortest = 0
        for s in segments:
            if groups and s[2] - s[1] <= CLASS_RATIO * shortest:
                groups[-1].append(s)
            else:
                groups.append([s])
                shortest = s[2] - s[1]
        self.classes = [_Class(g, self.tokens, len(self.symbol) + 1, share, k)
                        for k, g in enumerate(groups)]

    def symbols_of(self, text: str | None) -> np.ndarray:
        """The symbols of a text's words; a piece's words are there at a time."""
        out = []
        for piece in pieces(text or "", CALL_BYTES, NO_WORD):
            words = encoded_words(piece)
            out.append(np.fromiter(map(self.encoded.get, words, repeat(0)), np.int32, len(words)))
        return np.concatenate(out) if out else np.zeros(0, np.int32)

    @staticmethod
    def _masks(tokens: np.ndarray) -> dict[int, int]:
        out: dict[int, int] = {}
        for k, t in enumerate(tokens.tolist()):
            out[t] = out.get(t, 0) | (1 << k)
        return out

    def distance(self, item: int, text: list[int]) -> tuple[int, int]:
        """Least edit distance of the item to a stretch of ``text``, and its end.

        Bit k of the vertical vectors belongs to the item's word k."""
        tokens = self.tokens[item]
        if len(tokens) > CHUNK_WORDS:
            return best_end_in_chunks(tokens, text)
        if item not in self.masks:
            if self.masked > MASK_BYTES:
                self.masks.clear()
                self.masked = 0
            self.masks[item] = self._masks(tokens)
            self.masked += len(tokens) * (100 + len(tokens) // 8)
        return best_end(self.masks[item], len(tokens), text)

    def start(self, item: int, stretch: list[int]) -> int:
        """Words from the item's best start to the end of ``stretch``, where it ends."""
        back, text = self.tokens[item][::-1], stretch[::-1]
        if len(back) > CHUNK_WORDS:
            return best_end_in_chunks(back, text, True)[1]
        return best_end(self._masks(back), len(back), text, True)[1]

    def candidates(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start of the item, item, place) of windows that agree in a signature.
        ``flat`` ends in zeros."""
        places, items, firsts = [], [], []
        for c in self.classes:
            at = np.concatenate([c.windows(flat, lo) for lo in range(0, len(flat), STRETCH)])
            at = at[at + 2 * c.steps < len(flat)]
            if not len(at):
                continue
            for r, (keys, own) in enumerate(c.tables):
                sig, known = c.signatures(flat, self.moves[r], at, r)
                lo, hi = np.searchsorted(keys, sig, "left"), np.searchsorted(keys, sig, "right")
                n = np.where(known, hi - lo, 0)
                if n.any():
                    hit = np.repeat(np.arange(len(at)), n)
                    within = np.arange(len(hit)) - np.repeat(np.cumsum(n) - n, n)
                    segment = own[lo[hit] + within]
                    places.append(at[hit])
                    items.append(c.items[segment])
                    firsts.append(at[hit] - c.offsets[segment])
        if not places:
            return (np.zeros(0, dtype=np.int64),) * 3
        found = np.unique(np.stack([np.concatenate(x) for x in (items, firsts, places)]), axis=1)
        return found[1], found[0], found[2]

    def search(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, first word, end word, distance) of every item in every text."""
        pad = 2 * max((c.steps for c in self.classes), default=0) + 1
        parts, starts, n = [], [], 0
        for text in texts:
            part = self.symbols_of(text)
            parts += [part, np.zeros(pad, dtype=np.int32)]
            starts.append(n)
            n += len(part) + pad
        if not self.classes or not parts:
            return
        flat = np.concatenate(parts)
        first, item, place = self.candidates(flat)
        source = np.searchsorted(starts, place, "right") - 1
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        done: dict[tuple[int, int], int] = {}
        for d, i, p in zip(source.tolist(), item.tolist(), first.tolist(), strict=True):
            k, m = self.limit[i], len(self.tokens[i])
            if (d, i) in done and p < done[(d, i)]:
                continue  # inside the stretch looked at last
            lo = max(starts[d], p - k - m // 2)
            hi = min(starts[d] + len(parts[2 * d]), p + m + 2 * k + m // 2)
            done[(d, i)] = p + max(1, m // 2 - k)
            # too few words, or too few of the item's, for its distance
            if hi - lo < m - k or (m > CHUNK_WORDS and np.isin(
                    flat[lo:hi], self.tokens[i]).sum() < m - k):
                continue
            distance, end = self.distance(i, flat[lo:hi].tolist())
            if distance <= k and ((d, i) not in best or distance < best[(d, i)][2]):
                stretch = flat[max(lo, lo + end - m - k):lo + end].tolist()
                back = self.start(i, stretch)
                best[(d, i)] = (lo + end - back - starts[d], lo + end - starts[d], distance)
        for (d, i), (first, end, distance) in sorted(best.items()):
            yield d, i, first, end, distance


def best_end(masks: dict[int, int], m: int, text: list[int], anchored: bool = False
             ) -> tuple[int, int]:
    """Least edit distance of a pattern of ``m`` symbols to a stretch of ``text``
    and where that stretch ends; ``anchored``: the stretch begins with the text."""
    ones, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = ones, 0, m
    best, end = m, 0
    for j, symbol in enumerate(text):
        eq = masks.get(symbol, 0)
        x = eq | down
        d0 = (((x & up) + up) ^ up) | x
        plus, minus = down | ~(d0 | up), up & d0
        if plus & top:
            score += 1
        if minus & top:
            score -= 1
        plus = (plus << 1) | anchored
        minus <<= 1
        up = (minus | ~(d0 | plus)) & ones
        down = plus & d0 & ones
        if score < best:
            best, end = score, j + 1
    return best, end


def best_end_in_chunks(pattern: np.ndarray, text: list[int], anchored: bool = False,
                       chunk: int = CHUNK_WORDS) -> tuple[int, int]:
    """``best_end`` for a long pattern: one chunk of it after the other over the
    text, with the steps along a chunk's last row handed on to the next."""
    m = len(pattern)
    steps = [int(anchored)] * len(text)
    for at in range(0, m, chunk):
        part = pattern[at:at + chunk]
        masks = Index._masks(part)
        ones, top = (1 << len(part)) - 1, 1 << (len(part) - 1)
        up, down = ones, 0
        for j, symbol in enumerate(text):
            step = steps[j]
            eq = masks.get(symbol, 0)
            x = eq | down
            if step < 0:
                x |= 1
            d0 = (((x & up) + up) ^ up) | x
            plus, minus = down | ~(d0 | up), up & d0
            steps[j] = 1 if plus & top else -1 if minus & top else 0
            plus, minus = (plus << 1) | (step > 0), (minus << 1) | (step < 0)
            up = (minus | ~(d0 | plus)) & ones
            down = plus & d0 & ones
    score = best = m
    end = 0
    for j, step in enumerate(steps):
        score += step
        if score < best:
            best, end = score, j + 1
    return best, end


def benchmark_blocks(benchmark: DataFrame) -> Iterator[list[tuple]]:
    """The benchmark as lists of (item_id, text) of bounded number and size.

    Items are numbered per partition, blocks are cut by running totals on the
    cluster; only one block at a time is on the driver.
    """
    items = materialize(benchmark.select("item_id", text_or_empty().alias("text"))
                        .withColumn("row", F.monotonically_increasing_id()), "benchmark")
    size = items.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    blocks = max(1, -(-size[0] // BLOCK_ITEMS), -(-(size[1] or 0) // (BLOCK_BYTES // 2)))
    for b in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b) if blocks > 1 else items
        rows = [(r["item_id"], r["text"]) for r in own.orderBy("row").toLocalIterator()]
        if rows:
            yield rows


def find_items(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, first_word,
    end_word, edit_distance, item_words (the best place, by distance)."""
    spark = docs.sparkSession
    id_kind, item_kind = dict(docs.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    schema = (f"doc_id {id_kind}, item_id {item_kind}, first_word long, end_word long, "
              "edit_distance long, item_words long")
    item_type = pa.string() if item_kind == "string" else pa.int64()
    out: DataFrame | None = None
    for rows in benchmark_blocks(benchmark):
        # at most BLOCK_ITEMS items and BLOCK_BYTES of text; each task builds the index
        shared = spark.sparkContext.broadcast(rows)

        def search(it: Iterator[pa.RecordBatch], shared=shared,
                   name: str = uuid.uuid4().hex) -> Iterator[pa.RecordBatch]:
            index = index_of(name, shared, share)
            for batch in it:
                for part in by_bytes(batch, 1, 4096, CALL_BYTES):
                    hits = list(index.search(part.column(1).to_pylist()))
                    if hits:
                        d, i, first, end, distance = zip(*hits, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0).take(pa.array(d, pa.int64())),
                             pa.array([index.ids[k] for k in i]).cast(item_type),
                             pa.array(first, pa.int64()), pa.array(end, pa.int64()),
                             pa.array(distance, pa.int64()),
                             pa.array([len(index.tokens[k]) for k in i], pa.int64())],
                            names=["doc_id", "item_id", "first_word", "end_word",
                                   "edit_distance", "item_words"])

        hits = (docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(search, schema))
        out = hits if out is None else out.unionByName(hits)
    return out if out is not None else spark.createDataFrame([], schema)


_INDEX: dict[str, Index] = {}


def index_of(name: str, shared, share: float) -> Index:
    """The index of a broadcast block, kept by the worker for its next task."""
    if name not in _INDEX:
        _INDEX.clear()
        _INDEX[name] = Index(shared.value, share)
    return _INDEX[name]


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item, columns unchanged."""
    # rows are told apart by their text, so null or repeated ids do no harm
    texts = docs.select(F.sha2(text_or_empty(), 256).alias("doc_id"), text_or_empty().alias("text"))
    bad = (find_items(texts, benchmark, share)
           .select(F.col("doc_id").alias("__kf_key")).distinct())
    return (docs.withColumn("__kf_key", F.sha2(text_or_empty(), 256))
            .join(bad, "__kf_key", "left_anti")
            .select(*[f"`{c}`" for c in docs.columns]))
