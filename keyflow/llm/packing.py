"""Harmonic packing of token sequences.

A document's ids (and its end id) are cut at harmonic sizes ``capacity // k``:
the largest that still fits is cut off while more than ``TAIL`` ids remain, so
nearly every piece fills its share of a sequence exactly. The class of a piece
is the number ``k = capacity // length`` of such pieces that a sequence holds;
every sequence of class k takes exactly k of them. Workers (hash buckets of
bounded size) fill their sequences independently; what is left in their open
sequences is merged bucket by bucket, 64 at a time, and the last open sequences
of all classes (fewer than ``capacity`` pieces each, however large the input)
are packed first-fit decreasing.

Tokenisation: the vocabulary works word by word, so a word's ids are looked up
once per worker and kept as bytes; texts with characters outside the range
where this is exact go to the tokenizer whole.

Defined results: null and empty texts are the end id alone; rows repeated with
one id are packed each; very long texts are cut like any other; an empty table
gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_bytes, materialize, text_or_empty

CAPACITY = 2048
END_ID = 1
#: a remainder of at most so many ids is not cut further
TAIL = 128
#: pieces that one worker packs
PIECES_PER_BUCKET = 8192
MERGE = 64
#: words whose ids a worker keeps, at most twice as many
WORDS_KEPT = 250_000


def cut_points(n: int, capacity: int = CAPACITY, tail: int = TAIL) -> list[int]:
    """Lengths of the pieces of ``n`` ids."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest > tail:
        # smallest k whose share fits: k = ceil-like search from capacity // rest
        k = capacity // rest
        while capacity // k > rest:
            k += 1
        out.append(capacity // k)
        rest -= capacity // k
    return [*out, rest] if rest else out


class _Ids(dict):
    """ids of words as little-endian 32-bit bytes; old words make room for new ones."""

    def __init__(self, tokenize, kept: int = WORDS_KEPT):
        super().__init__()
        self.tokenize, self.kept, self.older = tokenize, kept, {}
        # the byte-level alphabet: printable bytes stand for themselves, the others
        # for the characters from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        self.alphabet = {b: chr(256 + k) for k, b in enumerate(rest)}

    def __missing__(self, word: str) -> bytes:
        out = self.older.get(word)
        if out is None:
            spelt = word.encode("utf-8").decode("latin-1").translate(self.alphabet)
            out = array("I", [t.id for t in self.tokenize(spelt)]).tobytes()
        if len(self) >= self.kept:
            self.older = dict(self)
            self.clear()
        self[word] = out
        return out


class WordTokens:
    """ids of a text as little-endian 32-bit bytes, by words where that is exact.

    The vocabulary lower-cases, then splits by a pattern whose matches are
    encoded one by one. Below U+0180 (without U+0130) the classes of the
    pattern are known here; other texts are encoded whole.
    """

    def __init__(self, path: str, data: str | None = None):
        """From the tokenizer's file, or from what it holds."""
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path) if data is None else Tokenizer.from_str(data)
        chars = [chr(i) for i in range(0x180)]
        letters = "".join(c for c in chars if unicodedata.category(c)[0] == "L")
        numbers = "".join(c for c in chars if unicodedata.category(c)[0] == "N")
        space = "\t\n\x0b\x0c\r \x85\xa0"
        inside = "".join(map(re.escape, letters))
        self.words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{inside}]+|[{re.escape(numbers)}]"
                                f"|[^{re.escape(space + numbers)}{inside}]+").findall
        self.strange = re.compile("[^\x00-\u012f\u0131-\u017f]").search
        self.kept = _Ids(self.tokenizer.model.tokenize)

    def encode(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, dtype="<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if "<|" in text or not text.isascii() and self.strange(text):
            return self.encode(text)
        kept = self.kept
        return b"".join([kept[w] for w in self.words(text.lower())])


_TOKENS: dict[str, WordTokens] = {}


def tokens_of(path: str, shared) -> WordTokens:
    """The tokenizer of a worker, from the broadcast file: its path is the driver's."""
    if path not in _TOKENS:
        _TOKENS[path] = WordTokens(path, shared.value)
    return _TOKENS[path]


def token_pieces(docs: DataFrame, tokenizer: str, with_ids: bool = False,
                 capacity: int = CAPACITY) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens and, if asked, ids of every piece."""
    fields = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
              ("doc_tokens", pa.int64())] + [("ids", pa.list_(pa.int32()))] * with_ids
    end = np.asarray([END_ID], dtype="<u4").tobytes()
    # a vocabulary file: a few MB, whatever the documents
    shared = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text("utf-8"))

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens_of(tokenizer, shared)
        for batch in it:
            for part in by_bytes(batch, 1, 256):
                cols: dict[str, list] = {name: [] for name, _ in fields}
                source = []
                for i, text in enumerate(part.column(1).to_pylist()):
                    ids, start = encode(text) + end, 0
                    for n in cut_points(len(ids) // 4, capacity):
                        own = ids[4 * start:4 * (start + n)]
                        source.append(i)
                        cols["start"].append(start)
                        cols["length"].append(n)
                        cols["ids_crc32"].append(zlib.crc32(own))
                        cols["doc_tokens"].append(len(ids) // 4)
                        if with_ids:
                            cols["ids"].append(np.frombuffer(own, dtype="<i4"))
                        start += n
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(source, pa.int64())),
                     *(pa.array(cols[n], kind) for n, kind in fields)],
                    names=["doc_id", *(n for n, _ in fields)])

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + \
        ", ids array<int>" * with_ids
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(cut, schema)


def _first_fit(capacity: int):
    """Packs the last open pieces, longest first; their number has a fixed bound."""

    def pack(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(it)
        if not parts:
            return
        df = pd.concat(parts).sort_values(["length", "piece"], ascending=[False, True],
                                          kind="stable")
        room = np.zeros(len(df), dtype=np.int64) + capacity
        seq, offset = [], []
        for n in df["length"].to_numpy():
            b = int(np.argmax(room >= n))
            seq.append(b)
            offset.append(capacity - room[b])
            room[b] -= n
        yield df[["piece"]].assign(seq=np.asarray(seq, dtype="int64"),
                                   offset=np.asarray(offset, dtype="int64"))

    return pack


def harmonic_bins(pieces: DataFrame, capacity: int = CAPACITY,
                  per_bucket: int = PIECES_PER_BUCKET) -> DataFrame:
    """(piece, sequence_id, offset) for a written table with columns piece and length."""
    total = pieces.count()
    buckets = max(1, -(-total // per_bucket))
    k = F.floor(F.lit(capacity) / F.col("length")).cast("long")
    open_ = pieces.select("piece", "length", k.alias("k"),
                          F.pmod(F.xxhash64("piece"), F.lit(buckets)).alias("bucket"))
    done: DataFrame | None = None
    level = 0
    while True:
        group = Window.partitionBy("k", "bucket")
        bin_ = Window.partitionBy("k", "bucket", "bin")
        before = bin_.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
        seq = (F.lit(level << 58) + F.shiftleft("k", 46) + F.shiftleft("bucket", 20)
               + F.col("bin"))
        placed = materialize(
            open_.withColumn("bin", F.floor((F.row_number().over(group.orderBy("piece")) - 1)
                                            / F.col("k")).cast("long"))
            .withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
            .withColumn("full", F.count(F.lit(1)).over(bin_) == F.col("k"))
            .withColumn("sequence_id", seq), f"pack-{level}")
        full = placed.filter("full").select("piece", "sequence_id", "offset")
        done = full if done is None else done.unionByName(full)
        open_ = placed.filter("not full").select(
            "piece", "length", "k", F.floor(F.col("bucket") / MERGE).cast("long").alias("bucket"))
        level += 1
        if buckets == 1:
            break
        buckets = -(-buckets // MERGE)
    last = (open_.select("piece", "length").coalesce(1)
            .mapInPandas(_first_fit(capacity), "piece long, seq long, offset long")
            .select("piece", (F.lit(level << 58) + F.col("seq")).alias("sequence_id"), "offset"))
    return done.unionByName(last)


def pack_documents(docs: DataFrame, tokenizer: str, with_ids: bool = False,
                   capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset; with ``with_ids`` also its ids."""
    pieces = materialize(
        token_pieces(docs, tokenizer, with_ids, capacity)
        .withColumn("piece", F.monotonically_increasing_id()), "pack-pieces")
    return pieces.join(harmonic_bins(pieces, capacity), "piece").drop("piece")
