"""Two-pass external shuffle into shards of equal row counts.

Pass 1 scatters whole records into memory-sized buckets by a seeded hash of id and text; the number of
buckets follows from the bytes of the input. Pass 2 holds one bucket at a time, brings it into a defined
order, shuffles it in memory (Spark's `shuffle` is a seeded Fisher-Yates) and deals the records
out. Bucket b is partition b of the exchange, so the seed of a bucket is the same
in every run and after the loss of an executor.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, whole

SHARDS = 16
SEED = 11
BUCKET_BYTES = 16 << 20


def shuffle(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """One row per input row: `record` (all columns), `size` (UTF-8 bytes + 1), `shard`, `slot`.

    Law: counts of shards are at most one apart; slots are gapless from 0. Null or empty texts have size
    1. Rows with equal id and text land in the same bucket but are separate records. Column types must be
    orderable. No rows: no rows.
    """
    spark = df.sparkSession
    text = whole(text_col)
    size = (F.octet_length(text) + 1).cast("long")
    total = df.agg(F.sum(size)).first()[0] or 0
    buckets = max(shards, math.ceil(total / bucket_bytes))
    place = F.xxhash64(F.lit(seed), F.col(id_col), text)
    keyed = df.select(F.pmod(place, F.lit(buckets)).cast("int").alias("bucket"), place.alias("order"), size.alias("size"), F.struct("*").alias("record"))
    # Rows before each bucket: one number per bucket, whose count is known from the bytes.
    counts = dict(keyed.groupBy("bucket").count().collect())
    offsets, ahead = [], 0
    for b in range(buckets):
        offsets.append((b, ahead))
        ahead += counts.get(b, 0)
    starts = spark.createDataFrame(offsets, "bucket int, ahead long")
    held = (
        keyed.repartitionById(buckets, F.col("bucket"))
        .groupBy("bucket")
        .agg(F.sort_array(F.collect_list(F.struct("order", "size", "record"))).alias("rows"))
        .select("bucket", F.shuffle("rows", F.lit(seed)).alias("rows"))
        .join(starts, "bucket")
        .select("ahead", F.posexplode("rows").alias("pos", "row"))
    )
    index = F.col("ahead") + F.col("pos")
    return held.select(
        "row.record",
        "row.size",
        F.pmod(index, F.lit(shards)).cast("int").alias("shard"),
        F.floor(index / shards).cast("long").alias("slot"),
    )


def write(shuffled: DataFrame, path: str, shards: int = SHARDS, files_per_shard: int = 1) -> None:
    """Writes path/shard=N/ with the records of each shard in the order of their slots."""
    keyed = shuffled.select("record.*", "shard", "slot")
    spread = keyed.repartitionByRange(shards * files_per_shard, "shard", "slot")
    spread.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op8_sharding(spark, sf_dir) -> DataFrame:
    rows = shuffle(table(spark, sf_dir, "documents"))
    return rows.select(
        F.col("record.doc_id").alias("doc_id"),
        "size",
        F.crc32(whole(F.col("record.text")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
