"""Mixing sources to target weights by Poisson replication.

Every source has a target repetition rate: the size it is to have in the mixture over the size it has.
A document is repeated as often as a Poisson distribution with that mean says, whose inverse is taken
at a uniform number made from a hash of the document and a seed; the copies are then shuffled globally,
by a hash of document, copy and seed. Nothing depends on the order or the partitioning of the input.

Rates above ``PIECE`` are drawn as sums of Poisson numbers of equal smaller rates, which have the same
distribution and whose first probability does not vanish.

Cases: a null source is a source of its own. A source without a given weight, or with weight 0, is
left out of the mixture. A null text has size 0; a source of size 0 has rate 0. Rows equal in
doc_id get equal counts; without a doc_id the text stands in for it. An empty table gives an empty mixture. All columns of the input
are kept as they are; the added ones take their place if they clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm import common

# Largest rate that is drawn in one piece.
PIECE = 16.0
# Sources up to this many are broadcast (some 400 bytes each), more are joined with salts.
_BROADCAST_SOURCES = 20_000
_SALTS = 64
_DIGITS = 13  # hex digits of a uniform number: 52 bits


def target_rates(sizes: DataFrame, weights: dict[str | None, float] | None, temperature: float) -> DataFrame:
    """(source, rate) from (source, size): the mixture is as large as the input in all.

    Without ``weights`` a source's weight is its size to the power ``temperature``: 1 leaves the sources
    as they are, 0 makes them equal.
    """
    if weights is None:
        weighted = sizes.withColumn("weight", F.pow("size", F.lit(temperature)))
    else:
        given = sizes.sparkSession.createDataFrame(list(weights.items()), "named string, weight double")
        weighted = sizes.join(given, F.col("source").eqNullSafe(F.col("named")), "left").drop("named")
    weighted = weighted.withColumn("weight", F.when(F.col("size") > 0, F.coalesce("weight", F.lit(0.0))).otherwise(0.0))
    all_size, all_weight = weighted.agg(F.sum("size"), F.sum("weight")).first()
    if not all_weight:
        return weighted.select("source", F.lit(0.0).alias("rate"))
    rate = F.col("weight") / F.lit(all_weight) * F.lit(all_size) / F.col("size")
    return weighted.select("source", F.when(F.col("weight") > 0, rate).otherwise(0.0).alias("rate"))


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the MD5 of the parts, joined by colons."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))
    return F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double") / F.lit(float(16**_DIGITS))


def _cumulative(rate: Column) -> Column:
    """Cumulative probabilities of a Poisson distribution, as far as they differ from 1."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("all"))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * rate / k
        total = state["sum"] + p
        return F.struct(p.alias("p"), total.alias("sum"), F.concat(state["all"], F.array(total)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda state: state["all"])


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    temperature: float = 0.5,
    seed: str = "mix",
    size: Column | None = None,
) -> DataFrame:
    """The mixture: the documents' columns with ``copy`` (from 1) and ``shuffle_key``, in shuffled order.

    Partitions are ranges of the key, sorted, so the files of a written mixture are a global shuffle.
    """
    size = F.coalesce(F.length("text") if size is None else size, F.lit(0)).cast("double")
    docs = docs.drop("copy", "shuffle_key")
    sizes = common.stage(docs.select("source", size.alias("size")).groupBy("source").agg(F.sum("size").alias("size")), "sizes")
    rates = target_rates(sizes, weights, temperature).filter(F.col("rate") > 0)
    pieces = F.greatest(F.lit(1), F.ceil(F.col("rate") / PIECE).cast("int"))
    tables = common.stage(
        rates.select(F.col("source").alias("_source"), pieces.alias("_pieces"), F.col("rate"))
        .withColumn("_cumulative", _cumulative(F.col("rate") / F.col("_pieces")))
        .drop("rate"),
        "rates",
    )
    same = F.col("source").eqNullSafe(F.col("_source"))
    if tables.count() <= _BROADCAST_SOURCES:
        joined = docs.join(F.broadcast(tables), same)
    else:
        spread = tables.withColumn("_salt", common.salts(_SALTS))
        joined = docs.withColumn("_of", common.salt_of("doc_id", "text", salts=_SALTS)).join(
            spread, same & (F.col("_of") == F.col("_salt"))
        )

    document = F.coalesce(docs["doc_id"].cast("string"), F.md5(common.text_or_empty()))

    def drawn(piece: Column) -> Column:
        u = uniform(F.lit(seed), piece, document)
        return F.size(F.filter("_cumulative", lambda c: c <= u))

    count = F.aggregate(F.sequence(F.lit(1), F.col("_pieces")), F.lit(0), lambda n, piece: n + drawn(piece))
    copies = (
        joined.withColumn("_count", count)
        .filter("_count > 0")
        .select(*[docs[c] for c in docs.columns], F.explode(F.sequence(F.lit(1), "_count")).alias("copy"))
        .withColumn("shuffle_key", uniform(F.lit(seed), F.lit("order"), document, F.col("copy")))
    )
    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # The key is uniform, so equal stretches of it are equal partitions; nothing need be sampled.
    dealt = copies.repartitionById(n, F.floor(F.col("shuffle_key") * n).cast("int"))
    return dealt.sortWithinPartitions("shuffle_key", "doc_id", "copy")
