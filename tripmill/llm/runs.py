"""Periodic runs: stretches of words that repeat with a period, found by tiles of every scale.

A run is a stretch of consecutive words with smallest period q, at least ``MIN_WORDS`` and 2 q long, that no
neighbouring word extends. Words q apart that are equal make a match position; a run has max(q, MIN_WORDS - q) of
them in a row. Periods are taken by octaves, from 2^k to 2^(k+1) - 1, and every octave has boundaries so close to
each other that each of its runs has a match position on one. Then, at a boundary, the Z-function of the
words that follow says how far a period goes on, and the Z-function of the words before it, read backwards,
how far it reaches back.

1. Screening: a document is of interest if at some boundary some period matches for a few words around. Most
   are not, and are done with: their texts go no further.
2. The others are exploded into overlapping tiles, per octave, of ``TILE`` words or four periods' length. A
   tile reaches past its boundaries by twice the octave's start, so that what it cannot see the tiles beside it do. Tiles
   without a boundary of interest are left out; the others are dealt over all tasks by document, octave and tile.
3. A tile is solved by itself: for each boundary the periods whose stretch is long enough, and whose words are not
   themselves repetitions of something shorter, give an interval of match positions.
4. Intervals are shuffled by document and period, and those that touch are stitched into runs.

``collapse`` then drops the words of a run after its first period. A tile of W words takes time and memory in proportion
to W; a document, in proportion to its words times the number of octaves, spread over tasks.

Cases: a null text has no words, and no runs. Words are what stands between white space (ASCII only), and are
compared as they are. Rows are documents of their own, whatever their doc_id. Long texts are cut into pieces while
words are read. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm import common

MIN_WORDS = 12
# Words in the core of a tile, more for periods beyond a quarter of it.
TILE = 4096
_PIECE = 4 << 20
_SPACE = b" \t\n\x0b\x0c\r"
_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in UTF-8, piece by piece."""
    at = 0
    while at < len(text):
        end = min(at + _PIECE, len(text))
        while end < len(text) and text[end] not in _SPACE:
            end += 1
        yield text[at:end].split()
        at = end


def word_codes(text: bytes):
    """The words as numbers, equal where the words are."""
    import numpy as np

    codes: dict[bytes, int] = {}
    parts = [np.array([codes.setdefault(w, len(codes)) for w in words], "int32") for words in words_of(text)]
    return np.concatenate(parts) if parts else np.zeros(0, "int32")


def octaves(n: int) -> Iterator[tuple[int, int, int]]:
    """(first period, last period, distance of boundaries) of the octaves that n words have room for."""
    first = 1
    while n >= MIN_WORDS and 2 * first <= n:
        last = min(2 * first - 1, n // 2)
        yield first, last, min(max(q, MIN_WORDS - q) for q in range(first, min(last, MIN_WORDS) + 1)) if first < MIN_WORDS else first
        first *= 2


def live_boundaries(codes, first: int, last: int, step: int):
    """Boundaries where some period of the octave matches often enough in the words around."""
    import numpy as np

    n = len(codes)
    boundaries = np.arange(0, n - first, step)
    if step == first:
        # The words a period after a boundary follow the next boundary: no index is needed.
        rows = n // step - 1
        grid = codes[step : step * (rows + 1)].reshape(rows, step) == codes[: step * rows : step, None]
        at, off = np.nonzero(grid)
        tail = np.nonzero(codes[step * (rows + 1) :] == codes[step * rows])[0] if step * rows < n - first else at[:0]
        left = np.concatenate([at, np.full(len(tail), rows, at.dtype)]) * step
        right = left + first + np.concatenate([off, tail])
    else:
        other = boundaries[:, None] + np.arange(first, last + 1)
        at, off = np.nonzero((codes[np.minimum(other, n - 1)] == codes[boundaries][:, None]) & (other < n))
        left, right = boundaries[at], other[at, off]
    # A run has six match positions in a row at least, one of them here.
    wanted = MIN_WORDS // 2
    ahead = np.ones(len(left), "int64")
    going = np.arange(len(left))
    for k in range(1, wanted):
        going = going[right[going] + k < n]
        going = going[codes[left[going] + k] == codes[right[going] + k]]
        ahead[going] += 1
        if not len(going):
            break
    going = np.nonzero(ahead < wanted)[0]
    for k in range(1, wanted):
        going = going[left[going] >= k]
        going = going[codes[left[going] - k] == codes[right[going] - k]]
        ahead[going] += 1
        if not len(going):
            break
    return np.unique(left[(ahead >= wanted) & (right - left <= last)])


def is_live(codes) -> bool:
    return any(len(live_boundaries(codes, *octave)) for octave in octaves(len(codes)))


def tiles_of(codes) -> Iterator[tuple[int, int, int, list[int], bytes]]:
    """(first period, last period, start, boundaries within, words) of each tile with a boundary of interest."""
    n = len(codes)
    for first, last, step in octaves(n):
        live = live_boundaries(codes, first, last, step)
        core, reach = max(TILE, 4 * first), max(2 * first, MIN_WORDS)
        for tile in sorted(set((live // core).tolist())):
            own = live[(live >= tile * core) & (live < (tile + 1) * core)]
            start, end = max(0, tile * core - reach), min(n, (tile + 1) * core + reach + last)
            yield first, last, start, (own - start).tolist(), codes[start:end].astype("<i4").tobytes()


def z_function(s: list[int]) -> list[int]:
    """For each place, how many words from there on are the same as those from the start on."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[i + k] == s[k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    if n:
        z[0] = n
    return z


def prime_factors(q: int) -> list[int]:
    found, p = [], 2
    while p * p <= q:
        if q % p == 0:
            found.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return [*found, q] if q > 1 else found


def solve_tile(words: list[int], boundaries: list[int], first: int, last: int) -> dict[int, list[tuple[int, int]]]:
    """Per period of the octave, intervals of match positions around the boundaries, as far as the tile shows."""
    import numpy as np

    reach = max(2 * first, MIN_WORDS)
    periods = np.arange(first, last + 1)
    enough = np.maximum(periods, MIN_WORDS - periods)
    found: dict[int, list[tuple[int, int]]] = {}
    for b in boundaries:
        after = z_function(words[b : b + reach + last])
        high = min(last, len(after) - 1)
        if high < first:
            continue
        forward = np.minimum(after[first : high + 1], reach)
        low = max(0, b - reach)
        before, until = words[low:b][::-1], words[low : b + high][::-1]
        back = z_function([*before, -1, *until])
        # What ends q words after the boundary begins at high - q in the reversed words.
        base = len(before) + 1 + high
        backward = np.array(back[base - high : base - first + 1][::-1]) if high > 0 else forward * 0
        q = periods[: high - first + 1]
        for k in np.nonzero((forward > 0) & (forward + backward >= enough[: len(q)]))[0].tolist():
            period = first + k
            if any(after[period // p] >= period - period // p for p in prime_factors(period) if p > 1):
                continue
            interval = b - int(backward[k]), b + int(forward[k])
            own = found.setdefault(period, [])
            if own and interval[0] <= own[-1][1]:
                own[-1] = min(own[-1][0], interval[0]), max(own[-1][1], interval[1])
            else:
                own.append(interval)
    return found


def screen(docs: DataFrame, hashed: bool) -> DataFrame:
    """Stage (row_id, doc_id, n_words, text, collapsed): the text only where a run is possible, else the result."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, known, text in zip(batch["doc"], batch["known"], batch["text"]):
                codes = word_codes(text)
                live = is_live(codes)
                rows.append((doc, known, len(codes), text if live else None, None if live else _joined(text, hashed)))
            yield pd.DataFrame(rows, columns=["doc", "known", "n_words", "text", "collapsed"])

    plain = docs.select(
        F.coalesce("doc_id", F.lit(0)).alias("doc"),
        F.col("doc_id").isNotNull().alias("known"),
        common.text_or_empty().cast("binary").alias("text"),
    )
    seen = plain.mapInPandas(look, "doc long, known boolean, n_words long, text binary, collapsed string")
    return common.stage(
        seen.select(
            F.monotonically_increasing_id().alias("row_id"),
            F.when(F.col("known"), F.col("doc")).alias("doc_id"), "n_words", "text", "collapsed",
        ),
        "screened",
    )


def _joined(text: bytes, hashed: bool, keep=None) -> str:
    """Words with one blank between, as a text or its SHA-256; ``keep`` says which ones stay."""
    import hashlib
    from itertools import compress

    digest, parts, at = hashlib.sha256(), [], 0
    for words in words_of(text):
        kept = words if keep is None else list(compress(words, keep[at : at + len(words)]))
        at += len(words)
        if kept:
            piece = b" ".join(kept)
            if hashed:
                digest.update(piece if not parts else b" " + piece)
                parts = [b""]
            else:
                parts.append(piece)
    return digest.hexdigest() if hashed else b" ".join(parts).decode("utf-8", "surrogatepass")


def intervals(live: DataFrame) -> DataFrame:
    """(row_id, period, low, high): what the tiles of (row_id, text) show of match positions."""

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["row_id", "first", "last", "start", "boundaries", "words"]
        rows, held = [], 0
        for batch in batches:
            for row_id, text in zip(batch["row_id"], batch["text"]):
                for tile in tiles_of(word_codes(text)):
                    rows.append((row_id, *tile))
                    held += len(tile[-1])
                    if held >= _PIECE:
                        yield pd.DataFrame(rows, columns=columns)
                        rows, held = [], 0
        yield pd.DataFrame(rows, columns=columns)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for batch in batches:
            rows = []
            for row_id, first, last, start, boundaries, words in batch.itertuples(index=False):
                solved = solve_tile(np.frombuffer(words, "<i4").tolist(), list(boundaries), first, last)
                rows += [(row_id, q, start + a, start + b) for q, own in solved.items() for a, b in own]
            yield pd.DataFrame(rows, columns=["row_id", "period", "low", "high"])

    tiles = live.select("row_id", "text").mapInPandas(
        explode, "row_id long, first int, last int, start long, boundaries array<int>, words binary"
    )
    dealt = tiles.repartition(F.col("row_id"), F.col("first"), F.col("start"))
    return dealt.mapInPandas(solve, "row_id long, period int, low long, high long")


def stitch(pieces: DataFrame) -> DataFrame:
    """(row_id, start, length, period) of the runs that intervals of (row_id, period, low, high) add up to."""
    order = Window.partitionBy("row_id", "period").orderBy("low", "high")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    apart = F.coalesce(F.col("low") > F.max("high").over(before), F.lit(False)).cast("int")
    numbered = pieces.withColumn("apart", apart).withColumn("run", F.sum("apart").over(order))
    whole = numbered.groupBy("row_id", "period", "run").agg(F.min("low").alias("start"), F.max("high").alias("end"))
    length = F.col("end") + F.col("period") - F.col("start")
    long = whole.select("row_id", "start", length.alias("length"), F.col("period").cast("long").alias("period"))
    return long.filter((F.col("length") >= MIN_WORDS) & (F.col("length") >= 2 * F.col("period")))


def collapse(docs: DataFrame, hashed: bool = False) -> DataFrame:
    """doc_id, n_words, runs and collapsed for every row of (doc_id, text).

    ``runs`` is sorted by start, then period; ``collapsed`` is the text without repetitions, words joined by
    one blank, or the SHA-256 of it if ``hashed``.
    """
    common.small_batches(docs.sparkSession)
    screened = screen(docs, hashed)
    live = screened.filter(F.col("text").isNotNull())
    found = stitch(intervals(live)).groupBy("row_id").agg(
        F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs")
    )
    found = found.withColumn("runs", F.transform("runs", lambda r: F.struct(r["start"], r["length"], r["period"])))

    @F.pandas_udf("string")
    def shortened(text: pd.Series, start: pd.Series, length: pd.Series, period: pd.Series, n_words: pd.Series) -> pd.Series:
        import numpy as np

        out = []
        for t, starts, lengths, periods, n in zip(text, start, length, period, n_words):
            keep = np.ones(n, bool)
            for a, m, q in zip(starts, lengths, periods):
                keep[a + q : a + m] = False
            out.append(_joined(t, hashed, keep.tolist()))
        return pd.Series(out, dtype="object")

    with_runs = live.drop("collapsed").join(found, "row_id", "left").withColumn("runs", F.coalesce("runs", F.array().cast(_RUNS)))
    parts = [F.col(f"runs.{name}") for name in ("start", "length", "period")]
    shorter = with_runs.select("doc_id", "n_words", "runs", shortened("text", *parts, "n_words").alias("collapsed"))
    plain = screened.filter(F.col("text").isNull()).select("doc_id", "n_words", F.array().cast(_RUNS).alias("runs"), "collapsed")
    return plain.unionByName(shorter)
