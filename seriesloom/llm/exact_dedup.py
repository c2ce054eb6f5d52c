"""Exact dedup by a tree-merge of sorted digest runs.

Rows belong to runs by a hash of their id. Every run is sorted and holds one entry for a digest:
the identifier that stays and the number of rows. In round r the runs whose numbers differ only in
digit r exchange slices: each keeps the digests whose digit r is its own and sends the others away, so
`fan_in` runs are merged at once and, after log(runs) rounds, every digest lies in one run. Equal
entries become one at every level, on both sides of each exchange, so a text that a third of all
rows share is at most one row per run.

Equal means: identical after lower-casing A-Z. Entries are verified by SHA-256 and byte length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ascii_lower, cut, partitions, table, whole


def _rounds(runs: int, fan_in: int) -> int:
    n = 1
    while fan_in**n < runs:
        n += 1
    return n


def _digit(number: Column, place: int, fan_in: int) -> Column:
    return F.floor(number / fan_in**place).cast("long") % fan_in


def merge_runs(runs: DataFrame, keep: Column, rounds: int, fan_in: int) -> DataFrame:
    """Merges runs (`run`, `digest`, `n_bytes`, `id`, `n`) into one entry per digest."""
    total = fan_in**rounds
    # The slot a digest ends in: 15 hex digits give a uniform number.
    end = F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long") % total
    level = runs
    for r in range(rounds):
        moved = F.col("run") + (_digit(end, r, fan_in) - _digit(F.col("run"), r, fan_in)) * fan_in**r
        level = (
            level.withColumn("run", moved.cast("int"))
            .repartitionById(total, F.col("run"))
            .sortWithinPartitions("run", "digest", "n_bytes")
            .groupBy("run", "digest", "n_bytes")
            .agg(keep.alias("id"), F.sum("n").alias("n"))
        )
    return level.drop("run")


def mark(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    runs: int | None = None,
    fan_in: int = 8,
) -> DataFrame:
    """One row per input row: `id`, `keep_id`, `group_size`, `kept`, `digest`.

    A null text counts as empty; empty texts are equal to each other. Of equal texts the row with
    the smallest (or largest) id stays; null ids lose to others and stay only among themselves.
    Rows that repeat id and text share one result. Other columns are ignored. No rows: no rows.
    """
    best = {"smallest": F.min, "largest": F.max}[keep]
    rounds = _rounds(runs or partitions(df.sparkSession), fan_in)
    text = ascii_lower(whole(text_col))
    rows = cut(
        df.select(
            F.col(id_col).alias("id"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
            F.octet_length(text).alias("n_bytes"),
        ),
        "digests",
    )
    run = F.pmod(F.xxhash64("id"), F.lit(fan_in**rounds)).cast("int")
    level = rows.groupBy(run.alias("run"), "digest", "n_bytes").agg(best("id").alias("id"), F.count(F.lit(1)).alias("n"))
    merged = merge_runs(level, best("id"), rounds, fan_in)
    # Texts that occur once need no answer from the merge.
    groups = merged.filter("n > 1").select("digest", "n_bytes", F.col("id").alias("keep_id"), F.col("n").alias("group_size"))
    joined = rows.join(groups, ["digest", "n_bytes"], "left")
    keep_id = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return joined.select(
        "id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep_id).alias("kept"),
        "digest",
    )


def op7_exact_dedup(spark, sf_dir) -> DataFrame:
    marks = mark(table(spark, sf_dir, "documents"), keep="largest")
    return marks.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


OP7_SQL = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM d
"""
