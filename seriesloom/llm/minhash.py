"""Near-duplicates by MinHash: one permutation, optimal densification, banded buckets, star-shaped candidates.

A document is the set of hashes of its word shingles. Documents with equal sets are one node. One sorted pass over a set
gives the minimum of each of BANDS * ROWS bins; an empty bin takes the value of the bin that a fixed
random sequence meets first (optimal densification). The minima of a band make a bucket key.

Within a bucket every member is compared with one centre only, so candidates grow with the members, not
with their square. The centre is the member that meets most others over all its buckets: edited copies
share more buckets with their original than with each other. Links are confirmed on the full sets. Buckets
whose members are still in different components go into another round with the next centre. What is open after
CENTRES rounds is compared by an exact join of differences: members of a bucket are reduced to what tells them from its first
centre, where the text they share cancels out. Every pair that shares a bucket is either tested, provably
too different, or in one component, whatever else is in the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, table, whole
from .components import components


BANDS, ROWS = 40, 6
#: Per cent of the union that two documents must share.
SIMILAR = 80
#: Rounds of centres before the members of open buckets are compared exactly.
CENTRES = 2
REMEMBERED = 500_000
_TRIES = 400
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input changes half of the output."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_NONE = np.zeros(0, dtype=np.uint64)


class Shingler:
    """Sorted distinct 64-bit hashes of the shingles of a text; A-Z is lower-cased, words end at ASCII white space."""

    def __init__(self, width: int):
        self.width = width
        self.words: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        found = text.encode("utf-8", "surrogatepass").lower().split()
        if not found:
            return _NONE
        known = self.words
        for w in set(found).difference(known):
            known[w] = xxhash.xxh64_intdigest(w, seed=1)
        h = np.fromiter(map(known.__getitem__, found), dtype=np.uint64, count=len(found))
        if len(known) > REMEMBERED:
            known.clear()
        width = min(self.width, len(h))
        out = h[: len(h) - width + 1]
        for i in range(1, width):
            out = _mix(out + np.uint64(0x9E3779B97F4A7C15)) ^ h[i : len(h) - width + 1 + i]
        return np.unique(_mix(out + np.uint64(width)))


class Bands:
    def __init__(self, bands: int = BANDS, rows: int = ROWS):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        self.sequence = np.random.default_rng(7).integers(0, self.bins, size=(_TRIES, self.bins))
        self.names = _mix(np.arange(1, bands + 1, dtype=np.uint64))

    def minima(self, hashes: np.ndarray) -> np.ndarray:
        """The minimum of each bin. Bins are ranges of the hash, so the first of a sorted run is its minimum."""
        at = ((hashes >> np.uint64(32)) * np.uint64(self.bins) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        values, full = np.zeros(self.bins, dtype=np.uint64), np.zeros(self.bins, dtype=bool)
        values[at[first]], full[at[first]] = hashes[first], True
        empty = np.flatnonzero(~full)
        own = values.copy()
        for tries in self.sequence:
            if not len(empty):
                break
            found = tries[empty]
            ok = full[found]
            own[empty[ok]] = values[found[ok]]
            empty = empty[~ok]
        if len(empty):
            own[empty] = values[at[first[0]]]
        return own

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        grid = self.minima(hashes).reshape(self.bands, self.rows)
        key = self.names.copy()
        for i in range(self.rows):
            key = _mix(key + np.uint64(0x9E3779B97F4A7C15)) ^ grid[:, i]
        return _mix(key).astype(np.int64)


def row_key(id_col: str, text: Column) -> Column:
    """128 bits that name a row; rows with equal id and text share them."""
    own = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("n"))
    return F.unhex(F.md5(F.concat(own, F.lit("\0"), text).cast("binary")))


def signed(df: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(`id`, `row`, `node`, `n`, `keys`): node is a 128-bit digest of the set, keys its buckets; n = 0 has none."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, bands = Shingler(width), Bands()
        for batch in batches:
            sets = [shingles(t) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "row": batch["row"],
                    "node": [xxhash.xxh128_digest(s.tobytes()) for s in sets],
                    "n": [len(s) for s in sets],
                    "keys": [bands.keys(s) if len(s) else [] for s in sets],
                }
            )

    text = whole(text_col)
    rows = df.select(F.col(id_col).alias("id"), row_key(id_col, text).alias("row"), text.alias("text"))
    return rows.mapInPandas(run, f"id {kind}, row binary, node binary, n long, keys array<long>")


def sets_of(df: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(`node`, `hashes`) for the rows of wanted (`node`, `row`), made again from their texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingler(width)
        for batch in batches:
            yield pd.DataFrame({"node": batch["node"], "hashes": [shingles(t).astype(np.int64) for t in batch["text"]]})

    text = whole(text_col)
    rows = df.select(row_key(id_col, text).alias("row"), text.alias("text"))
    # Rows that repeat have the same key; one of them is enough.
    return rows.join(wanted, "row").select("node", "text").mapInPandas(run, "node binary, hashes array<long>").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, sets: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """The pairs (`a`, `b`) whose full sets share at least `similar` per cent of their union."""
    left = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb"))
    right = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha"))
    both = pairs.join(left, "b").join(right, "a").select(
        "a", "b", F.size("ha").alias("na"), F.size("hb").alias("nb"), F.size(F.array_intersect("ha", "hb")).alias("common")
    )
    return both.filter(100 * F.col("common") >= similar * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def joined(merged: DataFrame | None, fresh: DataFrame) -> DataFrame | None:
    """The components (`node`, `root`) so far with the links (`a`, `b`) added; None while there is no link."""
    if fresh.isEmpty():
        return merged
    if merged is None:
        return cut(components(fresh), "roots")
    # Links between components so far; unlinked nodes are components of their own.
    known = merged.select(F.col("node").alias("_n"), "root")
    ends = fresh.join(known, F.col("a") == F.col("_n"), "left").select(F.coalesce("root", "a").alias("a"), "b")
    ends = ends.join(known, F.col("b") == F.col("_n"), "left").select("a", F.coalesce("root", "b").alias("b"))
    above = cut(components(ends), "above").select(F.col("node").alias("_r"), F.col("root").alias("top"))
    moved = merged.join(above, F.col("root") == F.col("_r"), "left").select("node", F.coalesce("top", "root").alias("root"))
    new = above.join(merged, F.col("_r") == F.col("node"), "left_anti").select(F.col("_r").alias("node"), F.col("top").alias("root"))
    return cut(moved.union(new), "roots")


def candidates(rest: DataFrame, sets: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """All pairs (`a`, `b`) of rest (`ref`, `node`, `n`, `root`) that may be similar, share a ref and are in different components.

    Each set x is reduced to its symmetric difference Sx with the set of its ref. |x △ m| = |Sx| + |Sm| - 2 |Sx ∩ Sm|, so two sets
    are similar only if Sx and Sm share at least t = (|Sx| + |Sm| - largest difference of similar sets) / 2 hashes, and then
    also one of the rarest |S| - t + 1 of each. Members that are similar to the ref were linked with it before, so one of a
    pair is not, and t is at least half of what the other one differs by: what most members have in common is never joined.
    """
    apart = lambda size: F.floor(size * (100 - similar) / (100 + similar))
    own = sets.select(F.col("node").alias("_o"), F.col("hashes").alias("ho"))
    other = sets.select(F.col("node").alias("_r"), F.col("hashes").alias("hr"))
    both = rest.join(own, F.col("node") == F.col("_o")).join(other, F.col("ref") == F.col("_r"))
    diff = F.concat(F.array_except("ho", "hr"), F.array_except("hr", "ho"))
    each = both.select("ref", "node", "n", "root", F.size("hr").cast("long").alias("nr"), diff.alias("diff")).withColumn("k", F.size("diff").cast("long"))
    each = cut(each.select("ref", "node", "n", "root", "nr", "k", F.explode("diff").alias("hash")), "differences")
    often = each.groupBy("ref", "hash").agg(F.count(F.lit(1)).alias("often"))
    order = Window.partitionBy("ref", "node").orderBy("often", "hash")
    placed = each.join(often, ["ref", "hash"]).withColumn("at", F.row_number().over(order)).filter("often > 1")
    n, k, nr = (F.col(c) for c in ("n", "k", "nr"))
    # Partners of a member that is similar to no ref, and partners of any member that are similar to none.
    least_far = F.greatest(k - apart(n + F.floor(n * 100 / similar)), F.lit(1))
    least_any = F.greatest(F.ceil((1 + k + apart(nr - n)) / 2), F.lit(1))
    heads = cut(placed.filter(F.col("at") <= k - F.least(least_far, least_any) + 1), "heads")
    far = heads.filter((k > apart(n + nr)) & (F.col("at") <= k - least_far + 1)).select("ref", "hash", *[F.col(c).alias(f"_{c}") for c in ("node", "n", "root", "k", "at")])
    any_ = heads.filter(F.col("at") <= k - least_any + 1)
    shared = F.ceil((k + F.col("_k") - apart(n + F.col("_n"))) / 2)
    left = 1 + F.least(k - F.col("at"), F.col("_k") - F.col("_at"))
    near = (100 * F.least("n", "_n") >= similar * F.greatest("n", "_n")) & (F.col("root") != F.col("_root")) & (left >= shared)
    met = far.join(any_, ["ref", "hash"]).filter(near)
    return met.select(F.least("node", "_node").alias("a"), F.greatest("node", "_node").alias("b")).distinct()


def links(df: DataFrame, base: DataFrame, id_col: str, text_col: str, width: int, similar: int = SIMILAR) -> DataFrame:
    """(`node`, `root`) for every node that a confirmed link touches."""
    nodes = base.filter("n > 0")
    one = nodes.groupBy("node").agg(F.min("row").alias("row"))
    # Repeated rows have equal keys: the distinct rows of (bucket, node) count.
    reps = nodes.join(one, ["node", "row"]).select("node", "n", F.explode("keys").alias("key"))
    members = reps.groupBy("key", "node").agg(F.max("n").alias("n"))
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("met")).filter("met > 1")
    members = cut(members.join(shared, "key"), "members")
    met = members.groupBy("node").agg(F.sum("met").alias("met"))
    ranked = cut(members.drop("met").join(met, "node").select("key", F.struct("met", "node", "n").alias("m")), "ranked")
    wanted = ranked.select("m.node").distinct().join(one, "node")
    sets = cut(sets_of(df, wanted, id_col, text_col, width), "sets")

    # Members carry the root of their component so far; pairs within one component need no test.
    open_, merged = ranked.withColumns({"root": F.col("m.node"), "ref": F.lit(None).cast("binary")}), None
    for _ in range(CENTRES):
        centre = open_.groupBy("key").agg(F.max(F.struct("m", "root")).alias("c"))
        # A centre meets all others of its bucket now, so the bucket goes on without it.
        led = open_.join(centre, "key").filter(F.col("c.m.node") != F.col("m.node"))
        # n of two sets that share enough can't differ by more than the similarity itself.
        near = 100 * F.least("c.m.n", "m.n") >= similar * F.greatest("c.m.n", "m.n")
        tests = led.filter(near & (F.col("root") != F.col("c.root")))
        pairs = tests.select(F.least("c.m.node", "m.node").alias("a"), F.greatest("c.m.node", "m.node").alias("b")).distinct()
        merged = joined(merged, cut(confirmed(pairs, sets, similar), "links"))
        # Buckets whose other members are in different components, whether or not this round has linked anything.
        rooted = led.select("key", "m", F.col("m.node").alias("root"), F.coalesce("ref", "c.m.node").alias("ref"))
        if merged is not None:
            known = merged.select(F.col("node").alias("_n"), F.col("root").alias("_root"))
            rooted = rooted.drop("root").join(known, F.col("m.node") == F.col("_n"), "left")
            rooted = rooted.select("key", "m", F.coalesce("_root", F.col("m.node")).alias("root"), "ref")
        mixed = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high").select("key")
        open_ = cut(rooted.join(mixed, "key"), "open")
        if open_.isEmpty():
            break
    else:
        rest = cut(open_.select("ref", F.col("m.node").alias("node"), F.col("m.n").alias("n"), "root").distinct(), "rest")
        pairs = cut(candidates(rest, sets, similar), "candidates")
        merged = joined(merged, cut(confirmed(pairs, sets, similar), "links"))
    if merged is None:
        return base.select("node", F.col("node").alias("root")).limit(0)
    return merged


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similar: int = SIMILAR) -> DataFrame:
    """One row per input row: `id`, `row`, `n_shingles`, `component_id`, `kept`.

    A text with fewer words than `width` has one shingle, its whole sequence; null texts and texts without words have none and are
    linked with nothing. component_id is the smallest id of the component, nulls left out; kept says that the row has
    it. Rows that repeat id and text share one result; other columns are ignored; no rows give no rows.
    """
    base = cut(signed(df, id_col, text_col, width), "signed")
    roots = links(df, base, id_col, text_col, width, similar)
    rows = base.select("id", "row", "node", "n").join(roots, "node", "left")
    # Without words a row is alone: its own row key tells it from the others.
    alone = F.struct(F.lit(b"").alias("node"), F.col("row").alias("row"))
    linked = F.struct(F.coalesce("root", "node").alias("node"), F.lit(b"").alias("row"))
    placed = rows.select("id", "row", "n", F.when(F.col("n") == 0, alone).otherwise(linked).alias("group"))
    least = placed.groupBy("group").agg(F.min("id").alias("component_id"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    sized = placed.join(least, "group", "left")
    component = F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return sized.select("id", "row", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One row of df for each group of near-duplicates, the one with the smallest id; of repeated rows one."""
    kept = groups(df, id_col, text_col, **settings).filter("kept").select(F.col("row").alias("_kept_row")).distinct()
    rows = df.select(F.struct("*").alias("_record"), row_key(id_col, whole(text_col)).alias("_own_row"))
    joined = rows.join(kept, F.col("_own_row") == F.col("_kept_row")).dropDuplicates(["_own_row"])
    return joined.select("_record.*")


def op5_minhash(spark, sf_dir) -> DataFrame:
    rows = groups(table(spark, sf_dir, "documents"), width=2)
    return rows.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")
