"""Document fingerprints: bottom-k sketches of shingle hashes.

The sketch of a text is the sorted list of the k smallest distinct hashes of its shingles of five
words. Sketches of parts merge into the sketch of the whole (`merge`), and give estimates of
resemblance, containment and the number of distinct shingles. Sets of at most k
shingles are held whole, so their estimates are exact. Everything runs on column functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ascii_lower, let, partitions, table, whole, words

K = 128
WORDS = 5


def shingle_hashes(text: Column, width: int = WORDS) -> Column:
    """Distinct 64-bit hashes of all runs of `width` words; fewer words make one shingle, none make none."""

    def shingles(h: Column) -> Column:
        wide = F.transform(F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(width))))
        short = F.array(F.aggregate(h, F.xxhash64(F.lit(0)), lambda a, x: F.xxhash64(a, x)))
        return F.when(F.size(h) >= width, wide).when(F.size(h) > 0, short).otherwise(F.array().cast("array<bigint>"))

    return F.array_distinct(let(F.transform(words(ascii_lower(text)), lambda w: F.xxhash64(w)), shingles))


def sketch(text: Column, k: int = K, width: int = WORDS) -> Column:
    """The k smallest hashes, ascending. Null and empty texts have the empty sketch."""
    return F.slice(F.sort_array(shingle_hashes(whole(text), width)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Share of the k smallest hashes of both that are in both; 1 for two empty sketches."""

    def share(u: Column) -> Column:
        both = F.size(F.array_intersect(u, F.array_intersect(a, b)))
        return F.when(F.size(u) == 0, F.lit(1.0)).otherwise(both / F.size(u))

    return let(F.slice(F.sort_array(F.array_union(a, b)), 1, k), share)


def distinct(s: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    # Hashes are uniform on the signed 64-bit range.
    share = (F.get(s, F.lit(k - 1)).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that are in b; 1 for an empty a."""
    union = distinct(F.slice(F.sort_array(F.array_union(a, b)), 1, k), k)
    common = resemblance(a, b, k) * union
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), common / distinct(a, k)))


def merge(df: DataFrame, keys: Sequence[str], sketch_col: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per key from the sketches of its parts; a key may hold any share of the rows.

    Equal hashes are merged before the shuffle, and the rank limit keeps k hashes of
    a key in each task, so no task gathers a group. Keys without hashes get the empty sketch.
    """
    names = list(keys)
    hashes = df.select(*names, F.explode_outer(sketch_col).alias("_hash")).groupBy(*names, "_hash").agg(F.lit(1).alias("_one"))
    rank = F.row_number().over(W.partitionBy(*names).orderBy(F.col("_hash").asc_nulls_last()))
    best = hashes.withColumn("_rank", rank).filter(F.col("_rank") <= k)
    return best.groupBy(*names).agg(F.sort_array(F.collect_list("_hash")).alias(sketch_col))


def text_form(s: Column) -> Column:
    """A sketch as text: its hashes in order, eight bytes each, in Base64."""
    return F.base64(F.unhex(F.array_join(F.transform(s, lambda h: F.lpad(F.hex(h), 16, "0")), "")))


def _bucket_of(key: Column, bounds: Sequence[int], low: int = 0) -> Column:
    """Number of bounds at or below key, as a balanced tree of comparisons."""
    if not bounds:
        return F.lit(low)
    mid = len(bounds) // 2
    return F.when(key < bounds[mid], _bucket_of(key, bounds[:mid], low)).otherwise(_bucket_of(key, bounds[mid + 1 :], low + mid + 1))


def with_next(df: DataFrame, id_col: str, text_col: str, add, buckets: int) -> DataFrame:
    """Rows (`id`, `text`, columns of `add(text)`) with `next`, a struct of the following row's, by ascending id.

    The last row is followed by the first; a single row by itself. Null ids come first; rows
    with equal ids are ordered by a hash of their text. Ids are dealt into ranges by approximate
    quantiles, and the first row of each range is sent to the range before it too: one row per range.
    """
    spark = df.sparkSession
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)))
    rows = df.select(F.col(id_col).alias("id"), key.alias("key"), whole(text_col).alias("text"))
    steps = [i / buckets for i in range(1, buckets)]
    bounds = rows.agg(F.percentile_approx("key", steps, 100 * buckets)).first()[0] if steps else []
    bucket = _bucket_of(F.col("key"), sorted(set(bounds or [])))
    firsts = sorted(rows.groupBy(bucket.alias("bucket")).agg(F.min("key")).collect())
    if not firsts:
        return rows.select("id", "text", *add(F.col("text")), F.struct("text", *add(F.col("text"))).alias("next"))
    # Bucket i ends with the first row of the next bucket that has rows.
    after = [(b, firsts[(i + 1) % len(firsts)][1]) for i, (b, _) in enumerate(firsts)]
    # The null id has the least key there is; any other filter reaches the scan as a list of ids.
    at_head = F.col("id").isin([k for _, k in after if k != -(2**63)])
    heads = rows.filter(at_head | (F.col("id").isNull() if firsts[0][1] == -(2**63) else F.lit(False)))
    heads = heads.groupBy("key").agg(F.min(F.struct(F.xxhash64("text").alias("order"), "id", "text")).alias("h"))
    tails = heads.join(spark.createDataFrame(after, "bucket int, key bigint"), "key").select(
        "bucket", F.lit(True).alias("tail"), "key", F.col("h.id").alias("id"), F.col("h.text").alias("text")
    )
    dealt = rows.select(bucket.alias("bucket"), F.lit(False).alias("tail"), "key", "id", "text").unionByName(tails)
    spread = dealt.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket", "tail", "key", F.xxhash64("text"))
    extra = add(F.col("text"))
    own = spread.select("*", F.xxhash64("text").alias("order"), *extra)
    names = [c for c in own.columns if c not in ("bucket", "tail", "key", "id", "order")]
    ahead = W.partitionBy("bucket").orderBy("tail", "key", "order")
    return (
        own.select("tail", "id", *names, F.lead(F.struct(*names)).over(ahead).alias("next")).filter(~F.col("tail")).drop("tail")
    )


def edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, buckets: int | None = None) -> DataFrame:
    """One row per input row: `id`, `n_chars`, `sketch`, `edited`, `edited_sketch`, `near_edited`, `near_next`.

    The edited text has its last quarter (rounded down, in code points) replaced by as many first
    code points of the next row's text, or all of a shorter one. Null texts count as empty; extra
    columns are ignored; no rows give no rows.
    """
    n = buckets or partitions(df.sparkSession)
    rows = with_next(df, id_col, text_col, lambda text: [sketch(text, k).alias("sketch")], n)
    length = F.char_length("text")
    quarter = F.floor(length / 4).cast("int")
    changed = F.concat(F.col("text").substr(F.lit(1), length - quarter), F.col("next.text").substr(F.lit(1), quarter))
    return (
        rows.select("id", length.cast("long").alias("n_chars"), "sketch", F.col("next.sketch").alias("next_sketch"), changed.alias("edited"))
        .withColumn("edited_sketch", sketch(F.col("edited"), k))
        .select(
            "id",
            "n_chars",
            "sketch",
            "edited",
            "edited_sketch",
            resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
            resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        )
    )


def op1_fingerprints(spark, sf_dir) -> DataFrame:
    rows = edited(table(spark, sf_dir, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        text_form(F.col("sketch")).alias("fingerprint"),
        text_form(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
