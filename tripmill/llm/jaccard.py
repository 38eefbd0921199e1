"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of word shingles; two texts are linked if the Jaccard similarity of their sets reaches a
threshold. Equal texts are one representative, named by its digest. Representatives
get ``HASHES`` MinHash values; those that agree in a band of ``ROWS`` values meet in a bucket. With 24
bands of 3 a pair at similarity 0.8 is missed with a probability of 3e-8. Within a bucket
pairs are compared on their MinHash values a few at a time, and dropped as soon as the posterior
probability (uniform prior, binomial matches) that their similarity reaches the threshold falls below
``TOLERANCE``. Representatives that remain paired form a candidate group; within it all pairs are verified
exactly on the shingle sets.

No pair is ever a row: buckets and groups are cut into blocks, a task compares two blocks at a time as
arrays, and what leaves it is per representative: the number of its links and one edge that connects it.
A pair of one bucket is only looked at in the first band in which it agrees. Buckets and groups of any
size are cut alike; none is capped. Connected components of the edges are found by rounds of taking the
smallest neighbour's label, staged in between.

Cases: a null text is an empty one. Texts shorter than a shingle have one shingle, all their words; those
without words have none, and are linked to equal texts only. A class is a connected component of equal and
linked texts; its id is the smallest doc_id in it (null only if all are). Rows may repeat; every row gets its own result. An
empty table gives no rows. Other columns are kept by ``join``; those named like added ones are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm import common

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 3
HASHES = BANDS * ROWS
# Probability of a lost link that pruning a pair may cost.
TOLERANCE = 1e-6
# MinHash values compared at a time.
_STEP = 12
# Representatives in a block.
BLOCK = 1024
_SKETCH = "rep binary, bands array<long>, sketch binary"
# Pairs looked at at a time, and columns of the incidence matrices of a verification.
_PAIRS, _COLUMNS = 100_000, 4096
_SALTS = 16


def words_of(text: str) -> list[str]:
    return text.lower().split()


def shingle_hashes(text: str, size: int = SHINGLE):
    """Distinct 64-bit hashes of a text's word shingles, sorted."""
    import numpy as np
    import xxhash

    words = words_of(text)
    if not words:
        return np.empty(0, "uint64")
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), "uint64", len(words))
    n = max(1, len(words) - size + 1)
    mixed = np.zeros(n, "uint64")
    for k in range(min(size, len(words))):
        mixed = (mixed ^ own[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def _multipliers():
    import numpy as np

    dice = np.random.default_rng(20)
    return dice.integers(0, 1 << 63, HASHES, dtype="uint64") | np.uint64(1), dice.integers(0, 1 << 63, HASHES, dtype="uint64")


def min_hashes(shingles, multipliers):
    """``HASHES`` 32-bit MinHash values of a set of hashes."""
    import numpy as np

    a, b = multipliers
    out = np.full(HASHES, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingles), 512):
        out = np.minimum(out, (shingles[at : at + 512, None] * a + b).min(axis=0))
    return (out >> np.uint64(32)).astype("uint32")


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(values compared, matches needed to go on): fewer make the posterior fall below the tolerance.

    With a uniform prior and m matches of n the similarity is distributed as Beta(m + 1, n - m + 1), whose tail
    beyond the threshold is the probability of at most m successes in n + 1 trials at the threshold.
    """
    out = []
    for n in range(_STEP, HASHES + 1, _STEP):
        tail, m = 0.0, 0
        while True:
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                break
            m += 1
        out.append((n, m))
    return out


def digest():
    """Names a text; 16 bytes, so that unequal texts of any corpus differ."""
    return F.unhex(F.md5(common.text_or_empty()))


def sketches(docs: DataFrame) -> DataFrame:
    """(rep, bands, sketch) of every distinct text that has shingles: its band keys and MinHash values, cut to 16 bits."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        multipliers = _multipliers()
        for batch in batches:
            out = []
            for rep, text in batch.drop_duplicates("rep").itertuples(index=False):
                shingles = shingle_hashes(text)
                if not len(shingles):
                    continue
                values = min_hashes(shingles, multipliers)
                keys = np.arange(BANDS, dtype="uint64")
                for r in range(ROWS):
                    keys = (keys ^ values[r::ROWS].astype("uint64")) * np.uint64(0xC2B2AE3D27D4EB4F)
                    keys ^= keys >> np.uint64(31)
                out.append((rep, keys.view("int64"), values.astype("<u2").tobytes()))
            yield pd.DataFrame(out, columns=["rep", "bands", "sketch"])

    made = docs.select(digest().alias("rep"), common.text_or_empty().alias("text")).mapInPandas(sketch, _SKETCH)
    return made.groupBy("rep").agg(F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))


def _cells(members: DataFrame, group: str) -> DataFrame:
    """Each member of (group, rep, size, ...) once per cell, that is pair of blocks of its group, that it takes part in."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = members.withColumn("own", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
    with_other = own.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    cell = F.struct(group, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    return with_other.withColumn("cell", F.xxhash64(cell)).drop("other", "size")


def _sorted_groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Frames of whole groups from rows sorted by ``key``; the last group of a batch waits for the next one."""
    held = []
    for batch in batches:
        if not len(batch):
            continue
        last = batch[key].iloc[-1]
        if held and held[-1][key].iloc[-1] == last and batch[key].iloc[0] == last:
            held.append(batch)
            continue
        cut = int((batch[key] != last).to_numpy().nonzero()[0][-1]) + 1 if batch[key].iloc[0] != last else 0
        ready = [*held, batch.iloc[:cut]] if cut else held
        if ready:
            yield pd.concat(ready, ignore_index=True)
        held = [batch.iloc[cut:]]
    if held:
        yield pd.concat(held, ignore_index=True)


def _cell_pairs(starts, ends, own) -> Iterator[tuple]:
    """Index arrays of the pairs of each cell, of bounded length: across its two blocks, or within its only one."""
    import numpy as np

    sizes = ends - starts
    for size in np.unique(sizes[(sizes > 1) & (sizes <= 16)]).tolist():
        a, b = np.triu_indices(size, 1)
        heads = starts[sizes == size]
        for at in range(0, len(heads), max(1, _PAIRS // len(a))):
            part = heads[at : at + max(1, _PAIRS // len(a)), None]
            i, j = (part + a).ravel(), (part + b).ravel()
            lone = np.repeat((own[part + np.arange(size)] == own[part]).all(axis=1), len(a))
            keep = lone | (own[i] != own[j])
            yield i[keep], j[keep]
    for start, end in zip(starts[sizes > 16].tolist(), ends[sizes > 16].tolist()):
        low = own[start:end] == own[start]
        left, right = start + np.flatnonzero(low), start + np.flatnonzero(~low)
        within = not len(right)
        right = left if within else right
        step = max(1, _PAIRS // len(right))
        for at in range(0, len(left), step):
            i, j = np.meshgrid(left[at : at + step], right, indexing="ij")
            i, j = i.ravel(), j.ravel()
            keep = i < j if within else slice(None)
            yield i[keep], j[keep]


def roots_of(n: int, pairs: list[tuple]) -> list[int]:
    """Smallest index connected with each of n items by index-array pairs."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for left, right in pairs:
        for x, y in zip(left.tolist(), right.tolist()):
            a, b = root(x), root(y)
            if a != b:
                parent[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


def candidate_edges(sketched: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(a, b): edges that connect what Bayesian pruning leaves of the pairs in buckets."""
    needs = least_matches(threshold, tolerance)

    def prune(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for frame in _sorted_groups(batches, "cell"):
            cell, own, band = (frame[c].to_numpy() for c in ("cell", "own", "band"))
            bands = np.stack(frame["bands"].to_list())
            values = np.frombuffer(b"".join(frame["sketch"]), "<u2").reshape(len(frame), HASHES)
            starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            left = []
            for i, j in _cell_pairs(starts, np.r_[starts[1:], len(cell)], own):
                for b in range(BANDS - 1):
                    same = (bands[i, b] == bands[j, b]) & (b < band[i])
                    i, j = i[~same], j[~same]
                matches, done = np.zeros(len(i), "int64"), 0
                for n, need in needs:
                    matches = matches + (values[i, done:n] == values[j, done:n]).sum(axis=1)
                    keep = matches >= need
                    i, j, matches, done = i[keep], j[keep], matches[keep], n
                if len(i):
                    left.append((i, j))
            if left:
                root = roots_of(len(frame), left)
                found = [k for k, r in enumerate(root) if r != k]
                reps = frame["rep"].to_numpy()
                yield pd.DataFrame({"a": reps[found], "b": reps[[root[k] for k in found]]})

    banded = sketched.select("rep", F.posexplode("bands").alias("band", "key"))
    full = banded.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    members = banded.join(full, "key").join(sketched, "rep")
    cells = _cells(members, "key").select("cell", "own", "band", "rep", "bands", "sketch")
    dealt = cells.repartition("cell").sortWithinPartitions("cell", "rep")
    return dealt.mapInPandas(prune, "a binary, b binary").distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(rep, root): the smallest name in the connected component of each end of an edge (a, b), without loops.

    Each round replaces an edge's ends by their smallest neighbours, which at least halves long paths in
    two rounds, until the edges do not change any label.
    """
    both = common.stage(edges.select("a", "b").union(edges.select("b", "a")), f"{name}-edges")
    labels = common.stage(
        both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("rep"), F.least("a", "least").alias("root")),
        f"{name}-labels",
    )
    while True:
        heard = both.join(labels, both["b"] == labels["rep"]).groupBy("a").agg(F.min("root").alias("heard"))
        closer = labels.join(heard, labels["rep"] == heard["a"]).select("rep", F.least("root", "heard").alias("root"), F.col("root").alias("old"))
        jump = labels.select(F.col("rep").alias("via"), F.col("root").alias("beyond"))
        changed = common.stage(
            closer.join(jump, closer["root"] == jump["via"], "left").select(
                "rep", F.least("root", F.coalesce("beyond", "root")).alias("root"), "old"
            ),
            f"{name}-labels",
        )
        labels = changed.select("rep", "root")
        if changed.filter("root != old").isEmpty():
            return labels


def verified(docs: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """(rep, root, n_links) per cell of the candidate groups (rep, root): exact links on the shingle sets."""

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for frame in _sorted_groups(batches, "cell"):
            for _, cell in frame.groupby("cell", sort=False):
                sets = [np.frombuffer(x, "uint64") for x in cell["shingles"]]
                own, reps = cell["own"].to_numpy(), cell["rep"].to_numpy()
                left = np.flatnonzero(own == own[0])
                right = np.flatnonzero(own != own[0])
                within = not len(right)
                right = left if within else right
                linked = links_between([sets[k] for k in left], [sets[k] for k in right], threshold)
                if within:
                    np.fill_diagonal(linked, False)
                n_links = np.zeros(len(cell), "int64")
                n_links[left] += linked.sum(axis=1)
                if not within:
                    n_links[right] += linked.sum(axis=0)
                a, b = np.nonzero(linked)
                root = roots_of(len(cell), [(left[a], right[b])])
                keep = np.flatnonzero(n_links)
                yield pd.DataFrame({"rep": reps[keep], "root": reps[np.array(root)[keep]], "n_links": n_links[keep]})

    def shingle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_hashes(text).tobytes() for text in batch["text"]]
            yield batch[["rep", "group", "size"]].assign(shingles=sets)

    sizes = groups.groupBy("root").agg(F.count("*").alias("size"))
    members = common.stage(groups.join(sizes, "root").select("rep", F.col("root").alias("group"), "size"), "candidates")
    texts = docs.select(digest().alias("rep"), common.text_or_empty().alias("text"))
    # The same plan at every size: candidates grow with the corpus, so they are never broadcast.
    texts = texts.join(members.hint("merge"), "rep").groupBy("rep").agg(*(F.first(c).alias(c) for c in ("group", "size", "text")))
    sets = texts.mapInPandas(shingle, "rep binary, group binary, size long, shingles binary")
    cells = _cells(sets, "group").select("cell", "own", "rep", "shingles")
    dealt = cells.repartition("cell").sortWithinPartitions("cell", "rep")
    return dealt.mapInPandas(verify, "rep binary, root binary, n_links long")


def links_between(left: list, right: list, threshold: float):
    """Boolean matrix of the pairs whose Jaccard similarity reaches the threshold, from sorted sets.

    Intersections are products of incidence matrices over the shingles that more than one set has.
    """
    import numpy as np

    sizes = np.array([len(x) for x in (*left, *right)])
    every, where, times = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[where]
    rows, columns = rows[keep], number[where[keep]]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    common_ = np.zeros((len(left), len(right)), "float32")
    for at in range(0, int(shared.sum()), _COLUMNS):
        a, b = np.searchsorted(columns, [at, at + _COLUMNS])
        block = np.zeros((len(sizes), min(_COLUMNS, int(columns[b - 1]) - at + 1)), "float32")
        block[rows[a:b], columns[a:b] - at] = 1
        common_ += block[: len(left)] @ block[len(left) :].T
    union = sizes[: len(left), None] + sizes[None, len(left) :] - common_
    # The allowance keeps rounding from costing a link exactly at the threshold.
    return common_ >= threshold * union - 1e-6


def _related(docs: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Staged (rep, class_key, class_id, first_rep, copies, n_links) of all texts that have copies or links."""
    sketched = common.stage(sketches(docs), "sketches")
    groups = components(candidate_edges(sketched, threshold, tolerance), "candidate")
    found = common.stage(verified(docs, groups, threshold), "verified")
    links = found.groupBy("rep").agg(F.sum("n_links").alias("n_links"))
    edges = found.filter(F.col("rep") != F.col("root")).select(F.col("rep").alias("a"), F.col("root").alias("b"))
    classes = components(edges.distinct(), "class")
    texts = docs.groupBy(digest().alias("rep")).agg(F.min("doc_id").alias("least_id"), F.count("*").alias("copies"))
    named = texts.join(classes, "rep", "left").join(links, "rep", "left").filter("copies > 1 OR root IS NOT NULL")
    named = common.stage(named.withColumn("class_key", F.coalesce("root", "rep")).drop("root"), "named")
    first = F.min(F.struct(F.col("least_id").isNull(), F.col("least_id").alias("id"), F.col("rep").alias("rep")))
    firsts = named.groupBy("class_key").agg(first.alias("first"))
    firsts = firsts.select("class_key", F.col("first.id").alias("class_id"), F.col("first.rep").alias("first_rep"))
    return common.stage(named.join(firsts, "class_key").drop("least_id"), "related")


def _with_classes(docs: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Documents with rep, _salt and what ``_related`` knows of their text, joined by text and salt."""
    added = ["rep", "_salt", "class_id", "class_key", "first_rep", "copies", "n_links"]
    docs = docs.drop(*added)
    table = _related(docs, threshold, tolerance).withColumn("_salt", common.salts(_SALTS))
    keyed = docs.withColumn("rep", digest()).withColumn("_salt", common.salt_of("doc_id", salts=_SALTS))
    return keyed.join(table, ["rep", "_salt"], "left")


def join(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """The documents with class_id, class_key, copies (rows of equal text) and n_links (other texts that are similar)."""
    alone = F.col("class_key").isNull()
    return (
        _with_classes(docs, threshold, tolerance)
        .withColumn("class_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")))
        .withColumn("copies", F.coalesce("copies", F.lit(1)))
        .withColumn("n_links", F.coalesce("n_links", F.lit(0)))
        .drop("rep", "_salt", "first_rep")
    )


def keep_first(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One document of each class, the one of the smallest doc_id; documents without relatives all stay.

    Rows equal in doc_id and text share the text and salt that the join has dealt them by, so keeping one
    of them takes no further shuffle.
    """
    joined = _with_classes(docs, threshold, tolerance)
    first = (F.col("rep") == F.col("first_rep")) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    kept = joined.filter(F.col("class_key").isNull() | first).dropDuplicates(["rep", "_salt"])
    return kept.select([c for c in docs.columns if c in kept.columns])
