"""Line removal by log templates: a fixed-depth tree over tokens.

The tree has a level for the number of tokens of a line and one for each of its
``LEAD`` first tokens (tokens with a digit are fields from the start; characters
of scripts without spaces are tokens of their own). Inside a leaf a token is
constant if ``MIN_DOCS`` lines and at least one in ``CONSTANT_ONE_IN`` of the
leaf's lines have it at its position, else it is a field: a share, so that fields
stay fields however many lines there are. A line's template is its constants with
fields as ``<*>``. Dropped are lines whose template recurs in ``MIN_DOCS`` documents
with enough constants, also behind the leading tokens (those a leaf has in common
anyway), and lines of any positive length that recur themselves in so many.

All of it are aggregates over narrow hashes: the lines of a leaf never meet in
one task. Lines are tokenised once; their texts are read again only for leaves
that recur, and texts are shuffled once more to meet their dropped line numbers.
Equal lines of a document count once there; counts are partially aggregated, so
a line that is in every document arrives as one row per task.

Defined results: lines are what newlines separate; a null text is empty and has
one empty line; lines without a token stay; a document may end up empty; every
row counts as a document, also rows repeated with one id; a very long text loses
its lines in time proportional to their number. An empty table gives an empty
result. Only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_or_empty

LEAD = 3
MIN_DOCS = 10
#: a token of one in so many lines of its leaf, at its position, is constant
CONSTANT_ONE_IN = 10
#: share of constants that a recurring template has at least
CONSTANT_SHARE = 0.5
FIELD = "<*>"
#: scripts that are written without spaces between words
UNSPACED = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")


#: where their characters stand, with others: one look tells most texts have none
BEYOND = r"[\u0E00-\uFFFF\x{10000}-\x{10FFFF}]"


def tokens_of(line: Column, may_be_unspaced: Column) -> Column:
    unspaced = "".join(rf"\p{{Is{s}}}" for s in UNSPACED)
    apart = F.regexp_replace(line, f"([{unspaced}])", " $1 ")
    spaced = F.when(may_be_unspaced, apart).otherwise(line)
    return F.array_remove(F.split(F.translate(spaced, "\t\x0b\x0c\r", "    "), " "), "")


def masked(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.when(t.rlike("[0-9]"), F.lit(FIELD)).otherwise(t))


def numbered_lines(docs: DataFrame, lead: int) -> DataFrame:
    """row, k1, k2 (96 bits of the text), at, leaf and hash of the lines with a token."""
    text = text_or_empty()
    # numbered before the lines part: a generator's row would number the lines
    return (docs.select(F.monotonically_increasing_id().alias("row"), F.xxhash64(text).alias("k1"),
                        F.crc32(text).alias("k2"), text.rlike(BEYOND).alias("beyond"),
                        F.split(text, "\n").alias("lines"))
            .select("row", "k1", "k2", "beyond", F.posexplode("lines").alias("at", "line"))
            .withColumn("tokens", tokens_of(F.col("line"), F.col("beyond")))
            .filter(F.size("tokens") > 0)
            .select("row", "k1", "k2", "at",
                    F.xxhash64(F.size("tokens"), F.array_join(
                        masked(F.slice("tokens", 1, lead)), " ")).alias("leaf"),
                    F.xxhash64("line").alias("hash")))


def templates(docs: DataFrame, lines: DataFrame, min_docs: int = MIN_DOCS,
              share: float = CONSTANT_SHARE, one_in: int = CONSTANT_ONE_IN,
              lead: int = LEAD) -> DataFrame:
    """leaf, hash, docs, template and recurs of every line of a recurring leaf.

    Small aggregates are written before they are joined: the join then shuffles
    both sides itself, and adaptive execution splits a hot leaf or line.
    """
    counts = materialize(lines.select("leaf", "hash", "row").distinct()
                         .groupBy("leaf", "hash").agg(F.count(F.lit(1)).alias("docs")),
                         "line-counts")
    leaves = materialize(counts.groupBy("leaf").agg(F.sum("docs").alias("all"))
                         .filter(F.col("all") >= min_docs), "line-leaves")
    wanted = materialize(counts.join(leaves, "leaf"), "line-wanted")
    # one text per line of these leaves
    texts = (docs.select(F.explode(F.split(text_or_empty(), "\n")).alias("line"))
             .select("line", F.xxhash64("line").alias("hash"))
             .join(wanted.select("hash"), "hash", "left_semi")
             .groupBy("hash").agg(F.min("line").alias("line")))
    words = (wanted.join(texts, "hash")
             .select("leaf", "hash", "docs", "all",
                     F.posexplode(masked(tokens_of(F.col("line"), F.col("line").rlike(BEYOND)))).alias("pos", "token")))
    words = materialize(words, "line-words")
    constants = materialize(
        words.groupBy("leaf", "pos", "token").agg(F.sum("docs").alias("seen"),
                                                  F.max("all").alias("all"))
        .filter((F.col("seen") >= min_docs) & (F.col("seen") * one_in >= F.col("all"))
                & (F.col("token") != FIELD))
        .select("leaf", "pos", "token", F.lit(True).alias("constant")), "line-constants")
    parts = F.array_sort(F.collect_list(F.struct(
        "pos", F.when(F.col("constant"), F.col("token")).otherwise(FIELD).alias("part"))))
    by_line = (words.join(constants, ["leaf", "pos", "token"], "left")
               .groupBy("leaf", "hash").agg(
                   F.min("docs").alias("docs"), F.count("constant").alias("constants"),
                   F.count_if(F.col("constant") & (F.col("pos") >= lead)).alias("behind"),
                   F.count(F.lit(1)).alias("size"), parts.alias("parts"))
               .withColumn("template", F.array_join(F.col("parts.part"), " ")))
    by_line = materialize(by_line.drop("parts"), "line-templates")
    totals = materialize(by_line.groupBy("leaf", "template").agg(F.sum("docs").alias("all")),
                         "line-totals")
    return by_line.join(totals, ["leaf", "template"]).select(
        "leaf", "hash", "docs", "template",
        ((F.col("docs") >= min_docs)
         | ((F.col("all") >= min_docs) & (F.col("constants") >= share * F.col("size"))
            & (F.col("behind") >= share * (F.col("size") - lead))))
        .alias("recurs"))


def drop_template_lines(docs: DataFrame, lead: int = LEAD, min_docs: int = MIN_DOCS,
                        share: float = CONSTANT_SHARE, one_in: int = CONSTANT_ONE_IN) -> DataFrame:
    """doc_id, text without the lines of recurring templates, n_lines and n_dropped."""
    lines = materialize(numbered_lines(docs, lead), "line-numbers")
    recurring = (templates(docs, lines, min_docs, share, one_in, lead).filter("recurs")
                 .select("leaf", "hash"))
    text = text_or_empty()
    keys = ["k1", "k2"]  # equal texts lose the same lines
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("k1"),
                       F.crc32(text).alias("k2"))
    dropped = materialize(lines.join(recurring, ["leaf", "hash"], "left_semi")
                          .groupBy(*keys).agg(F.collect_set("at").alias("gone")), "line-dropped")
    gone, lines_of = F.col("gone"), F.split("text", "\n")

    def without(lines: Column) -> Column:
        # positions but the dropped ones, by hash: no line is looked up in a list
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")

    # bound once by the lambda, or every position would split the text again
    kept = F.transform(F.array(lines_of), without)[0]
    return rows.join(dropped, keys, "left").select(
        "doc_id", F.when(gone.isNull(), F.col("text")).otherwise(
            F.when(F.size(gone) < F.size(lines_of), kept).otherwise("")).alias("text"),
        F.size(lines_of).cast("long").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_dropped"))
