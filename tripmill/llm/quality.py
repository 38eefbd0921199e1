"""Quality rules: features of a text, and the frequency of its lines over documents of the same host.

Lines are normalised and hashed; a line is boilerplate on a host if more than ``MIN_DOCS`` documents of the
host contain it and it has ``LONG_LINE`` letters or more. Shorter lines may be everyday phrases, and
rows of figures are alike once digits are 0; they need more than ``SHORT_DOCS`` documents. Neither limit
depends on the size of the host. Such lines are removed, and a document
is rejected if what is left has fewer than ``MIN_WORDS`` words or less than ``MIN_LEFT`` of its words.
The base rules reject a document of fewer than ``MIN_WORDS`` words or with more than half of its words
in repeated windows of three.

Everything is made of Spark's own functions. A text is read once: its features and the hashes of its
lines are staged under a row number, counts and removed words are found from those.

Cases: a null text has no words; a null host is a host of its own. Every row counts as a document of its
own, whatever its doc_id, and a line counts once per row. Lines without words are no lines. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm import common

MIN_WORDS = 50
MIN_DOCS, SHORT_DOCS = 20, 200
# Characters, without digits, blanks and ASCII punctuation, of a normalised line that is no everyday phrase.
LONG_LINE = 32
MIN_LEFT = 0.3
# White space as the rules know it, and the symbols counted.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
# Looks at the start of a line only, which costs much less than to count its letters.
_LONG = f"^(?:[0 \\p{{Punct}}]*+[^0 \\p{{Punct}}]){{{LONG_LINE}}}"
_WORD, _GAPS = "[^\\x20\\x09-\\x0D]+", "[\\x20\\x09-\\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Salts that spread the lines of one host and hash when they are joined.
_SALTS = 16


def normalised(line: Column) -> Column:
    """ASCII letters in lower case, digits as 0, runs of white space as one blank."""
    letters = F.translate(line, _UPPER + "123456789", _LOWER + "0" * 9)
    return F.trim(F.regexp_replace(letters, _GAPS, " "))


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def features(docs: DataFrame) -> DataFrame:
    """doc_id, host, the base counts, and (hash, words, long, first) of each line; ``first`` marks one of equal ones."""
    text = common.text_or_empty()
    split = docs.select(
        "doc_id",
        F.col("source").alias("host"),
        text.alias("text"),
        F.regexp_extract_all(text, F.lit(_WORD), 0).alias("words"),
        F.filter(F.split(text, "\n"), lambda line: F.length(_without(line, SPACE)) > 0).alias("lines"),
    )

    def window(i: Column) -> Column:
        words = F.col("words")
        return F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("hash"), i.alias("at"))

    n = F.size("words")
    windows = F.when(n >= 3, F.array_sort(F.transform(F.sequence(F.lit(0), n - 3), window)))
    sorted_windows = split.select(
        "doc_id",
        "host",
        n.cast("long").alias("n_words"),
        F.length(_without(F.col("text"), SPACE)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(windows, F.array().cast("array<struct<hash:bigint,at:int>>")).alias("windows"),
        F.array_sort(F.transform("lines", normalised)).alias("lines"),
    )

    def neighbour(i: Column) -> Column:
        return F.get(F.col("windows"), i)["hash"]

    repeated = F.filter(
        "windows", lambda w, i: w["hash"].eqNullSafe(neighbour(i - 1)) | w["hash"].eqNullSafe(neighbour(i + 1))
    )
    starts = sorted_windows.withColumn("starts", F.array_sort(F.transform(repeated, lambda w: w["at"]))).drop("windows")
    # A repeated window adds its three words, less those that the next one starts within.
    covered = F.aggregate(
        F.transform("starts", lambda at, i: F.least(F.lit(3), F.coalesce(F.get(F.col("starts"), i + 1) - at, F.lit(3)))),
        F.lit(0),
        lambda a, b: a + b,
    )

    def line(x: Column, i: Column) -> Column:
        first = ~x.eqNullSafe(F.get(F.col("lines"), i - 1))
        long = x.rlike(_LONG)
        words = F.regexp_count(x, F.lit(_WORD))
        return F.struct(F.xxhash64(x).alias("hash"), words.alias("words"), long.alias("long"), first.alias("first"))

    return starts.select(
        "doc_id",
        "host",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        covered.cast("long").alias("n_repeat_words"),
        F.transform("lines", line).alias("lines"),
    )



def boilerplate(lines: DataFrame, min_docs: int, short_docs: int) -> DataFrame:
    """(host, hash) of the lines of (row_id, host, hash, long, first) that too many documents of the host contain."""
    counts = F.count_if("first").alias("n_docs"), F.bool_or("long").alias("long")
    limit = F.when(F.col("long"), min_docs).otherwise(max(min_docs, short_docs))
    return lines.groupBy("host", "hash").agg(*counts).filter(F.col("n_docs") > limit).select("host", "hash")


def judge(
    docs: DataFrame, min_docs: int = MIN_DOCS, short_docs: int = SHORT_DOCS, min_left: float = MIN_LEFT
) -> DataFrame:
    """doc_id, the base counts, removed_words, base_failed and kept for every row of (doc_id, source, text)."""
    rows = common.stage(features(docs).withColumn("row_id", F.monotonically_increasing_id()), "quality-rows")
    lines = rows.select("row_id", "host", F.explode("lines").alias("line")).select("row_id", "host", "line.*")
    common_lines = common.stage(boilerplate(lines, min_docs, short_docs), "boilerplate")
    salted = common_lines.select(F.col("host").alias("_host"), F.col("hash").alias("_hash"), common.salts(_SALTS).alias("_salt"))
    hit = (
        F.col("host").eqNullSafe(F.col("_host"))
        & (F.col("hash") == F.col("_hash"))
        & (common.salt_of("row_id", salts=_SALTS) == F.col("_salt"))
    )
    removed = lines.join(salted, hit).groupBy("row_id").agg(F.sum("words").alias("removed_words"))
    judged = rows.drop("lines", "host").join(removed, "row_id", "left")
    n, left = F.col("n_words"), F.col("n_words") - F.col("removed_words")
    failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * n)
    return (
        judged.withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("long"))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (left >= MIN_WORDS) & (left >= min_left * n))
        .drop("row_id")
    )
