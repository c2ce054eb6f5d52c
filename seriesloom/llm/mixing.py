"""Mixing sources to target weights by capped water-filling.

Source totals are a table with one row per source. The words of the mix are given out by weight; a source
above its cap (most epochs times its size) is clamped and the excess goes to the others in proportion
to their weights, until none is above: each round is an aggregate over the sources that returns three numbers. A document then appears `whole` times, and once more while
its place in the source's seeded order lies within the words that are still missing.

The place needs a running sum within each source. It is summed first by (source, slice of the hash),
so a window never holds more than one slice of a source, whatever share of the rows the source has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, cut, table, whole

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
SEED = 17
#: Hex digits of the hash that name a slice: 4096 slices of each source.
SLICE_DIGITS = 3


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def ranked(sources: DataFrame, column: str) -> DataFrame:
    """sources with their `rank` from 0 by code point of a column, null last, without one task that holds them all."""
    ordered = sources.orderBy(F.col(column).isNull(), column)
    dealt = cut(ordered.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")), "ranked")
    counts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per task of the sort.
    offsets = counts.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    own = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return dealt.join(offsets, "_part").withColumn("rank", F.col("_before") + own).drop("_part", "_at", "_before")


def water_fill(sources: DataFrame, share: float, epochs: float) -> DataFrame:
    """sources (`n`, `weight`) with their `target`: together share of all words (or all caps, if less), none above epochs * n."""
    cap = F.col("n") * F.lit(epochs)
    one = sources.agg(F.sum("n").alias("n"), F.sum("weight").alias("w")).first()
    total, left, weight, clamped = share * (one["n"] or 0), share * (one["n"] or 0), one["w"] or 0, 0
    while True:
        above = F.lit(float(left)) * F.col("weight") / F.lit(float(weight or 1)) > cap
        now = sources.agg(
            F.count(F.when(above, 1)).alias("clamped"), F.sum(F.when(above, cap)).alias("capped"), F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("w")
        ).first()
        if now["clamped"] == clamped:
            break
        # Clamping raises the level of the others, so what is above stays above.
        left, weight, clamped = total - now["capped"], now["w"], now["clamped"]
        if not weight:
            above = F.lit(True)
            break
    return sources.withColumn("target", F.when(above, cap).otherwise(F.lit(float(left)) * F.col("weight") / F.lit(float(weight or 1))).cast("double"))


def plan(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    epochs: float = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """One row per input row: `id`, `text_hash`, `source`, `size`, `source_size`, `target`, `copies`.

    Sources are ordered by code point, a null source last; weights repeat along that order. A null text has
    size 0 and is taken like any other, at no cost in words. Rows with equal id and text are placed by
    their size and are interchangeable. Without words all targets are 0. No rows: no rows.
    """
    text = whole(text_col)
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    rows = cut(
        df.select(
            F.col(id_col).alias("id"),
            F.col(source_col).cast("string").alias("source"),
            F.xxhash64(text).alias("text_hash"),
            n_words(text).alias("size"),
            key.alias("key"),
        ),
        "sizes",
    )
    order = ranked(rows.groupBy("source").agg(F.sum("size").alias("n")), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    filled = water_fill(cut(order.withColumn("weight", weight), "sources"), share, epochs)
    whole_copies = F.when(F.col("n") > 0, F.floor(F.col("target") / F.col("n"))).otherwise(1)
    sources = filled.select(
        F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("named"), F.col("n").alias("source_size"), "target", whole_copies.alias("whole_copies")
    )

    keyed = rows.withColumns(
        {
            "no_source": F.col("source").isNull(),
            "named": F.coalesce("source", F.lit("")),
            "slice": F.substring("key", 1, SLICE_DIGITS),
        }
    )
    part = W.partitionBy("no_source", "named").orderBy("slice")
    before = (
        keyed.groupBy("no_source", "named", "slice")
        .agg(F.sum("size").alias("n"))
        .select("no_source", "named", "slice", (F.sum("n").over(part) - F.col("n")).alias("before"))
    )
    # One row per source and slice: bounded by the number of sources, and summed before it is joined.
    slices = before.join(sources, ["no_source", "named"])
    place = W.partitionBy("no_source", "named", "slice").orderBy("key", "id", "size", "text_hash")
    placed = keyed.join(slices, ["no_source", "named", "slice"]).withColumn(
        "ahead", F.col("before") + F.sum("size").over(place.rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    )
    missing = F.col("target") - F.col("whole_copies") * F.col("source_size")
    # A document at the edge is taken if that brings the sum nearer to the target.
    more = (F.col("ahead") + F.col("size") / 2 <= missing).cast("long")
    return placed.select("id", "text_hash", "source", "size", "source_size", "target", (F.col("whole_copies") + more).alias("copies"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of df, each as often as the mix takes it (also never). Repeated rows share their number of copies."""
    copies = (
        plan(df, id_col, text_col, **settings)
        .groupBy(F.col("id").alias("_mix_id"), F.col("text_hash").alias("_mix_hash"))
        .agg(F.max("copies").alias("_mix_copies"))
    )
    keyed = df.select(F.struct("*").alias("_mix_row"), F.col(id_col).alias("_mix_own"), F.xxhash64(whole(text_col)).alias("_mix_own_hash"))
    same = F.col("_mix_own").eqNullSafe(F.col("_mix_id")) & (F.col("_mix_own_hash") == F.col("_mix_hash"))
    return (
        keyed.join(copies.filter("_mix_copies > 0"), same)
        .select("_mix_row", F.explode(F.sequence(F.lit(1), F.col("_mix_copies").cast("int"))))
        .select("_mix_row.*")
    )


def op4_mixing(spark, sf_dir) -> DataFrame:
    rows = plan(table(spark, sf_dir, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


OP4_SQL = f"""
WITH d AS (
  SELECT doc_id, source, length(regexp_replace(regexp_replace(coalesce(text, ''), '{WORD}', 'w', 'g'), '[^w]', '', 'g'))::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n FROM d GROUP BY source),
w AS (SELECT source, n, ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS w FROM s),
-- The sources that are clamped are those with the least size for their weight.
o AS (
  SELECT source, n, w,
         {SHARE} * sum(n) OVER () AS total,
         sum(w) OVER (ORDER BY n / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w,
         coalesce(sum({EPOCHS} * n) OVER (ORDER BY n / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped
  FROM w),
c AS (SELECT *, (total - capped) * w / open_w > {EPOCHS} * n AS clamped FROM o),
l AS (SELECT sum(CASE WHEN clamped THEN {EPOCHS} * n ELSE 0 END) AS capped, sum(CASE WHEN clamped THEN 0 ELSE w END) AS open_w FROM c),
t AS (
  SELECT c.source, c.n, CASE WHEN clamped THEN ({EPOCHS} * n)::DOUBLE ELSE (total - l.capped)::DOUBLE * w / l.open_w END AS target
  FROM c, l),
p AS (
  SELECT doc_id, size, n AS source_size, target, CASE WHEN n = 0 THEN 1 ELSE floor(target / n) END AS whole,
         sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS ahead
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN ahead + size / 2 <= target - whole * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""
