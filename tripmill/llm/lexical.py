"""Ranked lexical search, reversed: many items are looked for in one pass over the documents.

The items' terms make an inverted index, which is broadcast; documents are streamed through it. A first
pass counts the terms of every document and keeps the counts of those that some item has; from these come
the document frequencies, and with them the weights. A second pass streams the kept counts through the
index: a document adds each term's score to the items on the term's list. Every task holds the best
``k`` documents of each item in a heap, and the heaps of all tasks are merged in two steps.

An index holds at most ``BLOCK_POSTINGS`` pairs of item and term, unless a single item has more. More items are
dealt into blocks, each with an index and both passes of its own; nothing else depends on their number.

A term's weight is floor(1000 * ln((2 N + 2) / (2 df + 1))); all else is whole numbers.

Cases: a null text has no terms, and a document without terms counts nowhere. An item without terms, or
whose terms no document has, has no rows. Every row of items is an item and every row of documents a document
of its own, so repeated rows are ranked each. Equal scores go by ascending doc_id, nulls last. Long texts
are cut into pieces between terms. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm import common

BLOCK_POSTINGS = 250_000
# Scores held at once, documents by items.
_CELLS = 2_000_000
_PIECE = 4 << 20
_SALTS = 64
_LAST = (1 << 63) - 1
# Letters in lower case, digits and all bytes of non-ASCII characters as they are, everything else blank.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def term_counts(text: bytes) -> Counter:
    """Terms of a text in UTF-8 and how often they occur."""
    counts: Counter = Counter()
    at = 0
    while at < len(text):
        piece = text[at : at + _PIECE].translate(_TERM_BYTES)
        end = len(piece)
        if at + end < len(text):
            # A term that may go on stays for the next piece, unless it fills this one.
            end = piece.rfind(b" ") + 1
            if not end:
                piece = text[at:].translate(_TERM_BYTES)
                end = piece.find(b" ") + 1 or len(piece)
        counts.update(piece[:end].split())
        at += end
    return counts


class Index:
    """Terms of some items, each with the items that have it."""

    def __init__(self, numbers: list[int], item_terms: list[list[bytes]]) -> None:
        import numpy as np

        self.numbers = numbers
        self.terms: dict[bytes, int] = {}
        owners: list[list[int]] = []
        for item, terms in enumerate(item_terms):
            for term in terms:
                number = self.terms.setdefault(term, len(owners))
                if number == len(owners):
                    owners.append([])
                owners[number].append(item)
        self.starts = np.cumsum([0, *map(len, owners)])
        self.items = np.array([item for own in owners for item in own], "int64")


class Heaps:
    """The best k documents of each item, by score and then by ascending id."""

    def __init__(self, n_items: int, k: int) -> None:
        import numpy as np

        self.k = k
        self.heaps: list[list[tuple[int, int, bool]]] = [[] for _ in range(n_items)]
        # What a document must exceed: the worst kept score, and with that score a smaller id.
        self.score = np.zeros(n_items, "int64")
        self.doc = np.full(n_items, -_LAST - 1, "int64")

    def add(self, scores, docs, known) -> None:
        """Scores of documents (rows) for all items (columns)."""
        import numpy as np

        better = (scores > self.score) | ((scores == self.score) & (docs[:, None] < self.doc))
        for row, item in zip(*(x.tolist() for x in np.nonzero(better))):
            heap, entry = self.heaps[item], (int(scores[row, item]), -int(docs[row]), bool(known[row]))
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.k:
                self.score[item], self.doc[item] = heap[0][0], -heap[0][1]


def _blocks(items: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """Items with a block, dealt by hash into so many that none has too many postings, single items aside."""
    total = items.agg(F.sum(F.size("terms"))).first()[0] or 0
    count = max(1, math.ceil(total / limit))
    while True:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("item_no"), F.lit(count)).cast("int"))
        sizes = dealt.groupBy("block").agg(F.sum(F.size("terms")).alias("size"), F.count("*").alias("n"))
        if not sizes.filter((F.col("size") > limit) & (F.col("n") > 1)).limit(1).count():
            return dealt, count
        count *= 2


def count_terms(docs: DataFrame, index: Index) -> DataFrame:
    """Stage (doc, known, n_terms, terms, counts): the index's terms in each document that has any term at all."""
    shared = docs.sparkSession.sparkContext.broadcast(index.terms)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = shared.value
        for batch in batches:
            rows = []
            for doc, known, text in zip(batch["doc"], batch["known"], batch["text"]):
                counts = term_counts(text)
                if counts:
                    found = [(wanted[t], c) for t, c in counts.items() if t in wanted]
                    rows.append((doc, known, counts.total(), [t for t, _ in found], [c for _, c in found]))
            yield pd.DataFrame(rows, columns=["doc", "known", "n_terms", "terms", "counts"])

    plain = docs.select(
        F.coalesce("doc_id", F.lit(_LAST)).alias("doc"),
        F.col("doc_id").isNotNull().alias("known"),
        common.text_or_empty().cast("binary").alias("text"),
    )
    counted = plain.mapInPandas(count, "doc long, known boolean, n_terms long, terms array<int>, counts array<long>")
    return common.stage(counted, "term-counts")


def _document_scores(counts: DataFrame, index: Index, weights: list[int], n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item_no, doc, known, score): the best documents of each item, of each task."""
    shared = counts.sparkSession.sparkContext.broadcast((index.numbers, index.starts, index.items, weights))

    def rank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        numbers, starts, items, weight = shared.value
        n_items = len(numbers)
        weight = np.array(weight, "int64")
        heaps = Heaps(n_items, k)
        for batch in batches:
            lengths = batch["terms"].map(len).to_numpy()
            if not lengths.sum():
                continue
            row = np.repeat(np.arange(len(batch)), lengths)
            term = np.concatenate(batch["terms"].to_numpy()).astype("int64")
            tf = np.concatenate(batch["counts"].to_numpy()).astype("int64")
            # 90 * n * N may go beyond 64 bits.
            m = np.array([10 + 90 * n * n_docs // n_terms for n in batch["n_terms"].tolist()], "int64")
            value = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
            width = starts[term + 1] - starts[term]
            docs, known = batch["doc"].to_numpy(), batch["known"].to_numpy()
            filled = np.concatenate([[0], np.cumsum(np.bincount(row, weights=width, minlength=len(batch)).astype("int64"))])
            first = np.concatenate([[0], np.cumsum(lengths)])
            low = 0
            while low < len(batch):
                high = min(low + max(1, _CELLS // n_items), int(np.searchsorted(filled, filled[low] + _CELLS, "right")) - 1)
                high = min(max(high, low + 1), len(batch))
                own = slice(first[low], first[high])
                wide = width[own]
                # Places in the lists of the terms, one after another.
                place = np.repeat(starts[term[own]] - np.cumsum(wide) + wide, wide) + np.arange(wide.sum())
                scores = np.zeros((high - low) * n_items, "int64")
                np.add.at(scores, np.repeat((row[own] - low) * n_items, wide) + items[place], np.repeat(value[own], wide))
                heaps.add(scores.reshape(-1, n_items), docs[low:high], known[low:high])
                low = high
        rows = [(item, -doc, known, score) for item, heap in zip(numbers, heaps.heaps) for score, doc, known in heap]
        yield pd.DataFrame(rows, columns=["item_no", "doc", "known", "score"])

    return counts.select("doc", "known", "n_terms", "terms", "counts").mapInPandas(
        rank, "item_no long, doc long, known boolean, score long"
    )


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best of (doc_id, text) for each row of items (item_id, text)."""
    spark = docs.sparkSession
    lower = F.translate(common.text_or_empty(), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = F.array_distinct(F.regexp_extract_all(lower, F.lit("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), 0))
    asked = common.stage(items.select("item_id", terms.alias("terms"), F.monotonically_increasing_id().alias("item_no")), "items")
    dealt, count = _blocks(asked.filter(F.size("terms") > 0), block_postings)
    ranked = [found for block in range(count) if (found := _search_block(docs, dealt.filter(F.col("block") == block), k)) is not None]
    if not ranked:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = reduce(DataFrame.unionByName, ranked)
    order = [F.desc("score"), F.asc("doc"), F.desc("known")]
    for keys in (["item_no", "salt"], ["item_no"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)
    return best.join(asked.select("item_no", "item_id"), "item_no").select(
        "item_id", F.col("rank").cast("int").alias("rank"), F.when(F.col("known"), F.col("doc")).alias("doc_id"), "score"
    )


def _search_block(docs: DataFrame, items: DataFrame, k: int) -> DataFrame | None:
    """(item_no, doc, known, score, salt) for one block of items, whose bounded postings come to the driver."""
    rows = items.select("item_no", F.transform("terms", lambda t: t.cast("binary")).alias("terms")).collect()
    if not rows:
        return None
    index = Index([row["item_no"] for row in rows], [[bytes(t) for t in row["terms"]] for row in rows])
    counts = count_terms(docs, index)
    n_docs, n_terms = counts.agg(F.count("*"), F.sum("n_terms")).first()
    held = counts.select(F.explode("terms").alias("term")).groupBy("term").count()
    frequency = dict(held.collect())  # at most one row per term of the index
    weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency.get(t, 0) + 1))) for t in range(len(index.terms))]
    scored = _document_scores(counts, index, weights, n_docs, n_terms or 1, k)
    return scored.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(_SALTS)))
