"""From documents to packed sequences: five stages, each written as Parquet and read by the next.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
documents. The SQL of the whole is left out: the chain that is fitted for the first stage and
the packing can't be stated in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import linededup, minhash, mixing, packing, toxicity
from seriesloom.llm.common import cut, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of toxic spans rejects go; it learns from the labels of documents that aren't held out."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of lines that at least ten documents hold only the first stays. Documents stay, also those that become empty."""
    kept = linededup.without_repeats(docs, first_stays=True)
    length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long"))
    return kept.withColumn("n_chars", length)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies by shingles of five words stays."""
    return minhash.keep_one(docs, width=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their places in sequences."""
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near dedup", keep_one_of_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
