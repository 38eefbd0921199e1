"""A training-data pipeline over ``documents``: stages that each call one operator of ``tripmill.llm``.

Every stage takes the documents that its predecessor kept and returns the columns of ``documents``; the last
one returns them with the bin that each piece of text is packed into.

Cases, for every stage: a null text is as clean as an empty one, stays null, and takes no room in a bin; a null doc_id,
lang or n_chars is carried along; a null source is a source of its own when sources are mixed and conflicts with nothing
in a bin. Repeated rows are near copies, of which one stays; among equal texts it is that of the smallest doc_id. Texts of any
length are read whole. Empty tables give no rows, and without labels of both kinds nothing is rejected.
Columns beyond those of ``documents``, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import common, jaccard, mixing, packing, secrets, toxicity
from tripmill.llm.queries import BIN_CHARS, MIX_SEED, MIX_TEMPERATURE

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity (5): documents with a toxic passage that reach the rejection score go.

    The model learns from the labels of the corpus. Where many of these are toxic and words say little about them, the score
    of any document is high; without a passage that is no reason to reject it.
    """
    common.small_batches(spark)
    model = toxicity.train(docs, common.read_table(spark, sf_dir, "labels"))
    rejected = (F.col("toxic_score") >= toxicity.REJECT_AT) & (F.size("passages") > 0)
    return toxicity.score(docs, model).filter(~rejected).select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (2): one document of each group of equal or similar ones stays."""
    common.small_batches(spark)
    return jaccard.keep_first(docs).select(COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans (3): every span found is replaced by a mark; no document goes."""
    common.small_batches(spark)
    redacted = secrets.redact(docs, secrets.train(docs))
    return redacted.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing (7): documents are left out or repeated, so that sources reach their target weights, and shuffled."""
    return mixing.mix(docs, temperature=MIX_TEMPERATURE, seed=MIX_SEED).select(COLUMNS)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing (6): pieces of text with their bin; no bin holds a source or a text twice."""
    return packing.pack_documents(docs, BIN_CHARS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_bins),
]
# SQL can express neither the trained models nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written and reread as the next stage's input."""
    docs = common.read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
