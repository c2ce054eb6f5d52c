"""Line dedup by range-partitioned line hashes, answered with keep bitmaps instead of text.

Every line becomes (hash, document, position). The rows are range-partitioned by (hash, document), so a line
that a third of all documents share is spread over many tasks, and sorted by position within.
Each task streams its rows once and gives one row for each run of equal hashes: the documents in it and its first
occurrence. Runs cut by a partition border meet again in a sum of those few rows. Lines to drop
go back to their documents as positions, and each document gets one compressed bitmap of the lines it keeps.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ascii_lower, cut, partitions, table, whole

MIN_DOCS = 10
MIN_CHARS = 1
KEYS = "h1 long, h2 long, docs long, doc long, pos int"


def line_key(line: Column) -> Column:
    """What two equal lines share: white space stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")))


def row_key(id_col: str, text_col: str) -> Column:
    """Rows with equal id and text are one document."""
    return F.xxhash64(F.col(id_col), whole(text_col))


def line_rows(df: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(`h1`, `h2`, `doc`, `pos`) of all lines whose key is long enough; 128 bits name a key."""
    lines = df.select(row_key(id_col, text_col).alias("doc"), F.posexplode(F.split(whole(text_col), "\n", -1)).alias("pos", "line"))
    keyed = lines.select("doc", "pos", line_key(F.col("line")).alias("key")).filter(F.char_length("key") >= min_chars)
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc", "pos")


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Streams sorted rows; holds one batch and the open run."""
    open_run = None  # [h1, h2, documents, first doc, first pos, last doc]

    def rows(parts):
        return pd.DataFrame([p[:5] for p in parts], columns=["h1", "h2", "docs", "doc", "pos"])

    for batch in batches:
        h1, h2, doc, pos = (batch[c].to_numpy() for c in ("h1", "h2", "doc", "pos"))
        if not len(h1):
            continue
        new = np.ones(len(h1), dtype=bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new_doc = np.ones(len(h1), dtype=bool)
        new_doc[1:] = new[1:] | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        docs = np.add.reduceat(new_doc.astype(np.int64), at)
        ends = np.append(at[1:], len(h1)) - 1
        parts = [list(p) for p in zip(h1[at].tolist(), h2[at].tolist(), docs.tolist(), doc[at].tolist(), pos[at].tolist(), doc[ends].tolist(), strict=True)]
        if open_run:
            if open_run[:2] == parts[0][:2]:
                parts[0][2] += open_run[2] - (open_run[5] == parts[0][3])
                parts[0][3:5] = open_run[3:5]
            else:
                parts.insert(0, open_run)
        open_run = parts.pop()
        if parts:
            yield rows(parts)
    if open_run:
        yield rows([open_run])


def key_counts(lines: DataFrame, parts: int) -> DataFrame:
    """(`h1`, `h2`, `docs`, `first`): documents that hold a key and its first occurrence by (document, position)."""
    dealt = lines.repartitionByRange(parts, "h1", "h2", "doc").sortWithinPartitions("h1", "h2", "doc", "pos")
    runs = dealt.mapInPandas(_runs, KEYS)
    return runs.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.min(F.struct("doc", "pos")).alias("first"))


@F.pandas_udf(T.BinaryType())
def _bitmap(n_lines: pd.Series, dropped: pd.Series) -> pd.Series:
    out = []
    for n, drop in zip(n_lines, dropped, strict=True):
        keep = np.ones(n, dtype=np.uint8)
        keep[drop] = 0
        out.append(zlib.compress(np.packbits(keep).tobytes()))
    return pd.Series(out)


@F.pandas_udf(T.ArrayType(T.BooleanType()))
def _flags(bitmap: pd.Series, n_lines: pd.Series) -> pd.Series:
    unpack = lambda b, n: np.unpackbits(np.frombuffer(zlib.decompress(b), dtype=np.uint8), count=int(n)).astype(bool).tolist()
    return pd.Series([None if b is None else unpack(b, n) for b, n in zip(bitmap, n_lines, strict=True)])


def bitmaps(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    first_stays: bool = False,
) -> DataFrame:
    """(`doc`, `n_lines`, `n_dropped`, `keep`) for the documents that lose lines; all others keep every line.

    A line goes if at least min_docs documents hold its key; with first_stays its first occurrence stays.
    `doc` is `row_key`, `keep` a deflated bitmap with one bit per line. A null text is one empty line. Rows that repeat id
    and text count as one document. No rows: no rows.
    """
    n_lines = df.select(row_key(id_col, text_col).alias("doc"), (F.regexp_count(whole(text_col), F.lit("\n")) + 1).alias("n_lines"))
    lines = cut(line_rows(df.dropDuplicates([id_col, text_col]) if first_stays else df, id_col, text_col, min_chars), "lines")
    common = key_counts(lines, partitions(df.sparkSession)).filter(F.col("docs") >= min_docs)
    gone = lines.join(common, ["h1", "h2"])
    if first_stays:
        gone = gone.filter((F.col("doc") != F.col("first.doc")) | (F.col("pos") != F.col("first.pos")))
    # Bounded by the lines of one document.
    dropped = gone.groupBy("doc").agg(F.collect_set("pos").alias("dropped"))
    own = n_lines.groupBy("doc").agg(F.max("n_lines").alias("n_lines")).join(dropped, "doc")
    return own.select("doc", "n_lines", F.size("dropped").cast("long").alias("n_dropped"), _bitmap("n_lines", "dropped").alias("keep"))


def apply(df: DataFrame, maps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`record` (the row), `n_lines`, `n_dropped` and `kept`, the text without the lines that its bitmap drops."""
    kept_maps = maps.select(F.col("doc").alias("_doc"), F.col("n_lines").alias("_n"), "n_dropped", "keep")
    rows = df.select(F.struct("*").alias("record"), whole(text_col).alias("text"), row_key(id_col, text_col).alias("_own"))
    joined = rows.join(kept_maps, F.col("_own") == F.col("_doc"), "left")
    flagged = joined.select("record", "text", "n_dropped", _flags("keep", "_n").alias("flags"))
    lines = F.filter(F.split("text", "\n", -1), lambda line, i: F.get(F.col("flags"), i))
    return flagged.select(
        "record",
        (F.regexp_count("text", F.lit("\n")) + 1).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("flags").isNull(), F.col("text")).otherwise(F.array_join(lines, "\n")).alias("kept"),
    )


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of df with their texts cut down to the lines that stay; a null text without dropped lines stays null."""
    done = apply(df, bitmaps(df, id_col, text_col, **settings), id_col, text_col)
    text = F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("record")[text_col])
    return done.select(*(text.alias(c) if c == text_col else F.col("record")[c].alias(c) for c in df.columns))


def op9_line_dedup(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = apply(docs, bitmaps(docs))
    return rows.select(
        F.col("record.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


OP9_SQL = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (
  SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
c AS (SELECT key FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS})
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (c.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN c USING (key)
GROUP BY doc_id
"""
