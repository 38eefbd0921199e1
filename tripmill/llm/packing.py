"""Best-fit packing under conflicts: documents into bins of fixed capacity.

A bin holds at most one document of each source and at most one of each duplicate cluster; clusters are
given with the items, and are equal texts in ``pack_documents``. Texts longer
than the capacity are cut into full pieces, each of which fills a bin, and a rest that is packed like a
short text. Items are dealt at random into blocks of bounded size, and every block is packed by itself:
items by falling length, bins in the order of what is left in them; the search begins at the first bin
that has room and goes on to the next ones until one is compatible, which is the tightest such bin. A
bin carries its sources and clusters as bitmaps over those of the block.

Cases: a null text has length 0 and takes no room; a null source or cluster conflicts with nothing.
Ties in length go by row number, ties in room to the older bin. Equal rows are items of their own.
An empty table gives no bins. Input columns beyond those named are kept only by ``pack_documents``.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm import common

# Mean number of items in a block.
BLOCK_ITEMS = 4096
_BIN_BITS = 32
_PLACED = "row_id long, piece int, start long, length long, bin long, bin_start long, bin_used long"


def number_rows(docs: DataFrame, name: str) -> DataFrame:
    """Stage rows with a row_id, which is fixed from then on."""
    return common.stage(docs.withColumn("row_id", F.monotonically_increasing_id()), name)


def best_fit(lengths: list[int], sources: list, clusters: list, capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and place in the bin of each item, and what each bin holds; items come by falling length."""
    source_bit = {s: 1 << k for k, s in enumerate(dict.fromkeys(s for s in sources if s is not None))}
    cluster_bit = {c: 1 << k for k, c in enumerate(dict.fromkeys(c for c in clusters if c is not None))}
    rooms: list[tuple[int, int]] = []  # (room left, bin), sorted
    used, source_map, cluster_map = [], [], []
    bins, places = [], []
    for length, source, cluster in zip(lengths, sources, clusters):
        s, c = source_bit.get(source, 0), cluster_bit.get(cluster, 0)
        at = bisect_left(rooms, (length, -1))
        while at < len(rooms) and (source_map[rooms[at][1]] & s or cluster_map[rooms[at][1]] & c):
            at += 1
        if at < len(rooms):
            room, bin_ = rooms.pop(at)
        else:
            room, bin_ = capacity, len(used)
            used.append(0)
            source_map.append(0)
            cluster_map.append(0)
        bins.append(bin_)
        places.append(used[bin_])
        used[bin_] += length
        source_map[bin_] |= s
        cluster_map[bin_] |= c
        insort(rooms, (room - length, bin_))
    return bins, places, used


def pack(items: DataFrame, capacity: int, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Bins for the rows of ``items`` (row_id, source, cluster, length), as staged with ``number_rows``.

    A row per piece: row_id, piece (from 0), start and length in the document, bin, bin_start (its place
    in the bin) and bin_used (what the bin holds in all).
    """
    import pandas as pd

    blocks = max(1, math.ceil(items.count() / block_items))
    length = F.coalesce("length", F.lit(0)).cast("long")
    slim = items.select(
        "row_id", "source", "cluster", length.alias("length"), F.pmod(F.xxhash64("row_id"), F.lit(blocks)).alias("block")
    )

    def pack_block(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("row_id")
        # A text that is a multiple of the capacity has a last piece as full as the others.
        whole = ((frame["length"] - 1) // capacity).clip(lower=0)
        rest = frame.assign(start=whole * capacity, piece=whole, length=frame["length"] - whole * capacity)
        rest = rest.sort_values(["length", "row_id"], ascending=[False, True])
        keys = [x.astype(object).where(x.notna(), None).tolist() for x in (rest["source"], rest["cluster"])]
        bins, places, used = best_fit(rest["length"].tolist(), *keys, capacity)
        rest = rest.assign(bin=bins, bin_start=places, bin_used=[used[b] for b in bins])
        cut = frame.loc[frame.index.repeat(whole)]
        piece = cut.groupby("row_id").cumcount()
        numbers = range(len(used), len(used) + len(cut))
        cut = cut.assign(piece=piece, start=piece * capacity, length=capacity, bin=numbers, bin_start=0, bin_used=capacity)
        placed = pd.concat([rest, cut])
        placed["bin"] += placed["block"] * (1 << _BIN_BITS)
        return placed[[x.split()[0] for x in _PLACED.split(", ")]]

    return slim.groupBy("block").applyInPandas(pack_block, _PLACED)


def text_cluster() -> Column:
    """Equal texts are a cluster."""
    return F.md5("text")


def pack_documents(docs: DataFrame, capacity: int) -> DataFrame:
    """Pack documents by the characters of their text: their columns, with the piece's text and its bin."""
    added = [x.split()[0] for x in _PLACED.split(", ")]
    rows = number_rows(docs.drop(*added), "unpacked")
    items = rows.select("row_id", "source", text_cluster().alias("cluster"), F.length("text").alias("length"))
    placed = common.stage(pack(items, capacity), "placed")
    piece = F.substring("text", (F.col("start") + 1).cast("int"), F.col("length").cast("int"))
    return rows.join(placed, "row_id").withColumn("text", piece).drop("row_id")
