"""Source divergence audit by chunk factorization.

The words of a corpus are few against its text. Each task counts the white-space chunks of its documents and adds them
up as (language, source, chunk) with occurrences, documents, and the first and last document. These rows are dealt by
chunk; there each globally distinct chunk is tokenized once and its terms are joined back to its rows without another shuffle. Dealt by
(language, term), occurrences and distinct documents are summed. No row of a document is shuffled, and a hot chunk is one row a task.
A row holds what it says of all its languages and sources as packed records, which name these by 64-bit hashes.

Whether three documents hold a term follows exactly: a chunk in fewer than three has only its first and last one, so a
term whose chunks are all such has three if any of these differs from the first and the last of them all.

Sources are compared in slices of terms: a task holds all sources against the terms of a slice as a bounded block of
exact integers, and gives one sum per pair of sources. Terms are never joined with themselves.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, partitions, table, whole

MIN_DOCS = 3
TOP = 200
SCALE = 1_000_000_000
# A term is a run of ASCII letters and characters beyond ASCII.
#: The same on UTF-8 bytes: A-Z lower-cased, all that ends a term is a space, but a line feed, which is in no chunk, stays.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or c == 10 else 32 for c in range(256))
#: Bytes of text that are counted at a time, rows that a task adds up before it passes them on, cells of a block.
#: Rows that are added up stand in memory some four times over, each in some 70 bytes.
SLAB = 1 << 21
HELD_ROWS = 1 << 18
BLOCK = 1 << 21
#: Bytes of text for which the shuffles get one more partition: a task holds the distinct rows of one.
PART_BYTES = 256 << 20
#: Sums of a chunk as they are added up, and the records they are moved as.
COLUMNS = ("chunk", "lang", "source", "n", "docs", "low", "high")
OF_CHUNK = np.dtype([("lang", "<i8"), ("source", "<i8"), ("n", "<i8"), ("docs", "<i4"), ("low", "<i8"), ("span", "<i8")])
OF_TERM = np.dtype([("source", "<i8"), ("n", "<i8"), ("many", "<i1"), ("low", "<i8"), ("span", "<i8")])


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in slabs that end at white space, so that no chunk is cut."""
    low = 0
    while len(text) - low > SLAB:
        found = re.compile(rb"[\x20\x09-\x0D]").search(text, low + SLAB)
        if found is None:
            break
        yield text[low : found.start()]
        low = found.start()
    yield text[low:]


def chunk_counts(text: bytes) -> Counter:
    """Chunks of UTF-8 bytes; bytes.split() ends them at the six ASCII white-space characters and at nothing else."""
    found: Counter = Counter()
    for piece in _pieces(text):
        found.update(piece.split())
    return found


def _table(columns: list) -> pa.Table:
    return pa.table(dict(zip(COLUMNS, columns, strict=True)))


def _pack(records: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Runs of records as one binary value each."""
    offsets = (np.append(starts, len(records)) * records.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(records.tobytes())])


def _unpack(packed: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The records of all values and the number of the value that each comes from."""
    sizes = pc.binary_length(packed).to_numpy(zero_copy_only=False) // kind.itemsize
    return np.frombuffer(b"".join(packed.to_pylist()), dtype=kind), np.repeat(np.arange(len(packed)), sizes)


def _batches(names: tuple[str, ...], columns: list, size: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    yield from pa.table(dict(zip(names, columns, strict=True))).to_batches(max_chunksize=size)


def _freeing(run):
    """run, after which the worker, which stays for other tasks, gives back the memory that Arrow holds in reserve."""

    def freed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return freed


def _segments(key: np.ndarray) -> np.ndarray:
    """Where the runs of a sorted key begin."""
    return np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])


def _slab(texts: list[bytes], groups: list[tuple[int, int]], first: int) -> pa.Table:
    """Sums of some documents, numbered from `first` on."""
    split = [t.split() for t in texts]
    lengths = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    if not lengths.any():
        return _long(b"", (0, 0), 0)
    words = pa.array([w for d in split for w in d], pa.binary()).dictionary_encode()
    names, of = np.unique(np.array(groups, dtype=np.int64), axis=0, return_inverse=True)
    own = np.repeat(of.ravel(), lengths)
    width = len(words.dictionary)
    key = own * width + words.indices.to_numpy()
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), lengths)
    order = np.argsort(key, kind="stable")  # documents stay in order
    key, doc = key[order], doc[order]
    starts = _segments(key)
    ends = np.append(starts[1:], len(key)) - 1
    new = np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]))[: len(key)]
    docs = np.add.reduceat(new, starts, dtype=np.int64)
    group, code = key[starts] // width, key[starts] % width
    many = docs > 2  # documents are named only where there are one or two: of more, none needs to be known
    named = [pa.array(doc[i] + first, mask=many) for i in (starts, ends)]
    return _table([words.dictionary.take(pa.array(code)), pa.array(names[group, 0]), pa.array(names[group, 1]), pa.array(ends - starts + 1), pa.array(docs), *named])


def _long(text: bytes, group: tuple[int, int], doc: int) -> pa.Table:
    """The same of one document that is longer than a slab."""
    found = chunk_counts(text)
    same = lambda v: pa.array(np.full(len(found), v, dtype=np.int64))
    return _table([pa.array(list(found), pa.binary()), same(group[0]), same(group[1]), pa.array(list(found.values()), pa.int64()), same(1), same(doc), same(doc)])


def _summed(parts: list[pa.Table]) -> pa.Table:
    """Rows of equal (chunk, lang, source) added up."""
    whole_ = pa.concat_tables(parts)
    if len(parts) == 1:
        return whole_
    sums = whole_.group_by(["chunk", "lang", "source"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum"), ("low", "min"), ("high", "max")])
    return _table([sums[c] for c in ("chunk", "lang", "source", "n_sum", "docs_sum", "low_min", "high_max")])


def _moved(table_: pa.Table) -> Iterator[pa.RecordBatch]:
    """One row per chunk with its groups as records."""
    coded = table_["chunk"].combine_chunks().dictionary_encode()
    code = coded.indices.to_numpy()
    order = np.argsort(code, kind="stable")
    lang, source, n, docs = (table_[c].to_numpy()[order] for c in ("lang", "source", "n", "docs"))
    low, high = (pc.fill_null(table_[c], 0).to_numpy()[order] for c in ("low", "high"))
    records = np.empty(len(code), dtype=OF_CHUNK)
    for name, values in zip(OF_CHUNK.names, (lang, source, n, docs, np.where(docs > 2, 0, low), np.where(docs > 2, 0, high - low)), strict=True):
        records[name] = values
    starts = _segments(code[order])
    yield from _batches(("chunk", "groups"), [coded.dictionary.take(pa.array(code[order][starts])), _pack(records, starts)])


def _slabs(batches: Iterator[pa.RecordBatch], task: int) -> Iterator[pa.Table]:
    row, texts, groups, size = task << 40, [], [], 0
    for batch in batches:
        for lang, source, scalar in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text"), strict=True):
            text = scalar.as_py()
            if len(text) > SLAB:
                yield _long(text, (lang, source), row + len(texts))
                # The rows before it keep their numbers.
                texts.append(b"")
            else:
                texts.append(text)
            groups.append((lang, source))
            size += len(texts[-1])
            if size >= SLAB or len(texts) >= SLAB // 64:
                yield _slab(texts, groups, row)
                row, texts, groups, size = row + len(texts), [], [], 0
    if texts:
        yield _slab(texts, groups, row)


def counted(batches: Iterator[pa.RecordBatch], task: int) -> Iterator[pa.RecordBatch]:
    """The sums of a task's documents (`lang`, `source`, `text`) by (chunk, lang, source), passed on when there are many."""
    parts, rows = [], 0
    for table_ in _slabs(batches, task):
        parts.append(table_)
        rows += table_.num_rows
        if rows > HELD_ROWS:
            parts = [_summed(parts)]
            rows = parts[0].num_rows
            if rows > HELD_ROWS // 2:
                yield from _moved(parts[0])
                parts, rows = [], 0
    if parts:
        yield from _moved(_summed(parts))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from counted(batches, TaskContext.get().partitionId())


def _held(batches: Iterator[pa.RecordBatch]) -> list[pa.Table]:
    """The batches of a partition as tables; rows that are added up are kept once."""
    parts, rows, least = [], 0, HELD_ROWS
    for batch in batches:
        records, row = _unpack(batch.column("groups"), OF_CHUNK)
        many = records["docs"] > 2
        named = [pa.array(v, mask=many) for v in (records["low"], records["low"] + records["span"])]
        numbers = [pa.array(np.ascontiguousarray(records[c]).astype(np.int64)) for c in ("lang", "source", "n", "docs")]
        parts.append(_table([batch.column("chunk").take(pa.array(row)), *numbers, *named]))
        rows += len(records)
        if rows > least:
            parts = [_summed(parts)]
            rows = parts[0].num_rows
            least = max(HELD_ROWS, 2 * rows)
    return parts


def terms_of(chunks: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The terms of all chunks in order, and how many each chunk has."""
    folded = b"\n".join(chunks).translate(_FOLD)
    return folded.split(), np.fromiter((len(c.split()) for c in folded.split(b"\n")), dtype=np.int64)[: len(chunks)]


def _tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of a chunk are in one partition: it is tokenized once, and its rows get each of its terms."""
    parts = _held(batches)
    if not parts:
        return
    rows = _summed(parts).combine_chunks()
    coded = rows["chunk"].combine_chunks().dictionary_encode()
    terms, lengths = terms_of(coded.dictionary.to_pylist())
    starts = np.append(0, np.cumsum(lengths))
    words = pa.array(terms, pa.binary())
    del terms
    code = coded.indices.to_numpy()
    each = lengths[code]
    row = np.repeat(np.arange(len(code)), each)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    docs = rows["docs"].to_numpy()[row]
    low, high = (pc.fill_null(rows[c], 0).to_numpy()[row] for c in ("low", "high"))
    lang, n, source = (rows[c].to_numpy()[row] for c in ("lang", "n", "source"))
    term = words.take(pa.array(starts[code[row]] + offset)).dictionary_encode()
    names, of = np.unique(lang, return_inverse=True)
    key = of * max(1, len(term.dictionary)) + term.indices.to_numpy()
    order = np.argsort(key, kind="stable")
    records = np.empty(len(order), dtype=OF_TERM)
    many = docs > 2
    for name, values in zip(OF_TERM.names, (source, n, many, np.where(many, 0, low), np.where(many, 0, high - low)), strict=True):
        records[name] = values[order]
    key = key[order]
    at = _segments(key)
    width_ = max(1, len(term.dictionary))
    yield from _batches(("term", "lang", "groups"), [term.dictionary.take(pa.array(key[at] % width_)), pa.array(names[key[at] // width_]), _pack(records, at)])


def _kept(min_docs: int):
    """Sums by (language, source, term) of a partition that holds all rows of a term; terms in too few documents go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        rows = pa.Table.from_batches(parts).combine_chunks()
        records, row = _unpack(rows["groups"].combine_chunks(), OF_TERM)
        coded = rows["term"].combine_chunks().dictionary_encode()
        langs, lang = np.unique(rows["lang"].to_numpy(), return_inverse=True)
        sources, source = np.unique(records["source"], return_inverse=True)
        wide, terms = len(sources), len(coded.dictionary)
        key = (lang[row] * terms + coded.indices.to_numpy()[row]) * wide + source
        order = np.argsort(key, kind="stable")
        key = key[order]
        own = key // wide
        starts = _segments(own)
        size = np.diff(np.append(starts, len(own)))
        many = records["many"][order] > 0
        known, low = ~many, records["low"][order]
        high = low + records["span"][order]
        first = np.repeat(np.minimum.reduceat(np.where(known, low, np.iinfo(np.int64).max), starts), size)
        last = np.repeat(np.maximum.reduceat(np.where(known, high, -1), starts), size)
        between = known & ((low > first) & (low < last) | (high > first) & (high < last))
        enough = {1: np.ones(len(own), dtype=bool), 2: many | (first < last), 3: many | between}[min_docs]
        stays = np.repeat(np.logical_or.reduceat(enough, starts), size)
        key, n = key[stays], records["n"][order][stays]
        if not len(key):
            return
        starts = _segments(key)
        sums, at = np.add.reduceat(n, starts), key[starts]
        columns = [pa.array(langs[at // wide // terms]), pa.array(sources[at % wide]), coded.dictionary.take(pa.array(at // wide % terms)), pa.array(sums)]
        yield from _batches(("lang", "source", "term", "n"), columns, 1 << 16)

    return run


def counts(df: DataFrame, min_docs: int = MIN_DOCS, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(`lang`, `source`, `term`, `n`) of the terms that at least min_docs documents of the language hold.

    Every row is a document. min_docs is 1 to 3: a chunk remembers two documents.
    """
    if not 1 <= min_docs <= 3:
        raise ValueError("min_docs is 1 to 3")
    plain = df.select(*(whole(F.col(c).cast("string")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    size = plain.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(partitions(df.sparkSession), -(-size // PART_BYTES))
    hashed = plain.select(F.xxhash64("lang").alias("lang"), F.xxhash64("source").alias("source"), F.col("text").cast("binary").alias("text"))
    dealt = hashed.mapInArrow(_freeing(_count), "chunk binary, groups binary").repartition(parts, "chunk")
    each = dealt.mapInArrow(_freeing(_tokenize), "term binary, lang long, groups binary").repartition(parts, "lang", "term")
    kept = each.mapInArrow(_freeing(_kept(min_docs)), "lang long, source long, term binary, n long")
    names = plain.select("lang", "source").distinct().select("lang", "source", F.xxhash64("lang").alias("_lang"), F.xxhash64("source").alias("_source"))
    numbered = kept.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), F.col("term").cast("string").alias("term"), "n")
    return cut(numbered.join(names, ["_lang", "_source"]).select("lang", "source", "term", "n"), "terms")


def scaled(n: Column, total: Column, size: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + size)), exactly."""
    wide = lambda c: c.cast("decimal(20,0)")
    above, below = wide(n + 1) * F.lit(SCALE).cast("decimal(10,0)"), wide(total + size)
    return ((above - above % below) / below).cast("long") + 1


def _exact(n: np.ndarray, total: np.ndarray, size: int) -> np.ndarray:
    """The same as `scaled`. 64 bits hold it up to 9e9 occurrences; beyond that Python integers do."""
    n, total = np.asarray(n, dtype=np.int64), np.asarray(total, dtype=np.int64)
    if len(n) and int(n.max()) < 9_000_000_000:
        return 1 + SCALE * (n + 1) // (total + size)
    return np.array([1 + SCALE * (int(a) + 1) // (int(b) + size) for a, b in zip(n, np.broadcast_to(total, n.shape), strict=True)], dtype=np.int64)


def _compare(key, cells: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """Sums over the terms of a slice for all ordered pairs of sources of a language."""
    groups = groups.sort_values("source", ignore_index=True)
    names, totals = groups["source"].to_numpy(), groups["total"].to_numpy(dtype=np.int64)
    size = int(groups["size"].iloc[0]) if len(groups) else 0
    sums = np.zeros((len(names), len(names)), dtype=np.int64)
    if len(cells) and len(names):
        at = {s: i for i, s in enumerate(names)}
        who = cells["source"].map(at).to_numpy()
        which, terms = pd.factorize(cells["term"])
        p = np.repeat(_exact(np.zeros(len(names), dtype=np.int64), totals, size)[:, None], len(terms), axis=1)
        p[who, which] = _exact(cells["n"].to_numpy(), totals[who], size)
        for i in range(len(names)):
            sums[i] = ((p[i] - p) ** 2 // p).sum(axis=1)
    pairs = [(i, j) for i in range(len(names)) for j in range(len(names)) if i != j]
    one, two = ([x[k] for x in pairs] for k in (0, 1))
    return pd.DataFrame({"lang": key[0], "source": names[one] if pairs else [], "item": names[two] if pairs else [], "value": sums[one, two] if pairs else []})


def pairs(found: DataFrame, groups: DataFrame) -> DataFrame:
    """(`lang`, `source`, `item`, `value`) for all ordered pairs of sources of a language.

    Terms are sliced by their hash so that sources times terms of a slice stay near BLOCK cells.
    """
    slices = F.greatest(F.ceil(F.col("size") * F.col("sources") / BLOCK), F.lit(1)).cast("int")
    cut_up = groups.withColumn("slices", slices)
    own = cut_up.select("lang", "source", "slices")
    cells = found.join(own, ["lang", "source"]).withColumn("slice", F.pmod(F.xxhash64("term"), F.col("slices")).cast("int"))
    # Slice 0 is there even for a language without terms.
    sides = cut_up.select("lang", "source", "total", "size", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    left = cells.select("lang", "slice", "source", "term", "n").groupBy("lang", "slice")
    sums = left.cogroup(sides.groupBy("lang", "slice")).applyInPandas(_compare, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value"))


def audit(df: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """How the sources of a language differ in their terms: `lang`, `source`, `part`, `item`, `value`, `rank`.

    Part `pair` has every other source of the language with the divergence summed over all kept terms; part `term` the terms that a
    source uses more than its language does, the first `top` of them. Null text, lang and source are ''. Every
    group that occurs is compared, also one without terms; a language with one source has no pairs. No rows: no rows.
    Rows that repeat are documents of their own; other columns are ignored.
    """
    found = counts(df, min_docs, lang, source, text)
    occurring = df.select(*(whole(F.col(c).cast("string")).alias(n) for c, n in ((lang, "lang"), (source, "source")))).distinct()
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    per_term = found.groupBy("lang", "term").agg(F.sum("n").alias("all"))
    per_lang = per_term.groupBy("lang").agg(F.count(F.lit(1)).alias("size"), F.sum("all").alias("lang_total"))
    sizes = occurring.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")).join(per_lang, "lang", "left")
    filled = occurring.join(totals, ["lang", "source"], "left").join(sizes, "lang").fillna(0, ["total", "size", "lang_total"])
    groups = cut(filled, "groups")

    paired = pairs(found, groups).withColumn("part", F.lit("pair"))
    used = found.join(per_term, ["lang", "term"]).join(groups, ["lang", "source"])
    p, q = scaled(F.col("n"), F.col("total"), F.col("size")), scaled(F.col("all"), F.col("lang_total"), F.col("size"))
    above = used.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).filter("p > q")
    valued = above.select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(by_value))
    first = ranked(valued).filter(F.col("rank") <= top).withColumn("part", F.lit("term"))
    return ranked(paired).unionByName(first).select("lang", "source", "part", "item", "value", "rank")


def op13_source_divergence(spark, sf_dir) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


OP13_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT row, lang, source,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= {MIN_DOCS}),
v AS (SELECT lang, count(*)::HUGEINT AS size, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
t AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(t.total, 0) + v.size) AS p,
         1 + ({SCALE}::HUGEINT * (k.n + 1)) // (v.total + v.size) AS q
  FROM g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM o)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= {TOP}
"""
