"""Packing token sequences by non-negative least squares over a length histogram.

Documents are tokenized and cut into pieces of at most the window; full pieces fill a window alone. Lengths are
counted in bins of `STEP` tokens. Shallow combinations (up to three bins that fill the window together)
are the columns of a non-negative least squares problem against the histogram; its rounded-down repeat
counts say how often each combination is used. The pieces of a bin are numbered across all tasks and so find
their combination, copy and place. Pieces left over are packed greedily, one after the other, and cut at the
end of each window, so they leave no padding.

Only the histogram (one number per bin) is solved on the driver. Pieces are numbered from counts per task and bin,
never by sorting a bin in one task.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import store, table, whole

WINDOW = 1024
STEP = 8
END_ID = 0
VOCABULARY = "byte_bpe_50k.json"
# Fixed value: how byte-level vocabularies cut a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words whose ids a worker remembers, and texts tokenized before pieces are passed on.
REMEMBERED, AT_ONCE = 800_000, 500

_SPLIT = re.compile(r"(?<=\S)(?= \S)")
_SPACE, _SPACES = re.compile(r"\s"), re.compile(r"\s\s")
_ENCODERS: dict[str, Encoder] = {}


def _ranked(path: str):
    """The same vocabulary for a faster library, where its ids are in the order of its merges; else None."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
        return None
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    if any(model["vocab"].get(t) != 256 + i for i, t in enumerate(merged)):
        return None
    # Bytes that print stand for themselves, the others for the characters from 256 on.
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printed)]
    byte_of = {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Ids of texts, as bytes.

    The vocabulary never joins a space that stands between two other characters to what is before it. So a text is cut
    there, each word is encoded once with the space before it, and its ids are remembered. The unknown words of
    some texts are encoded as one line; every word in it begins with the only token that starts with a space.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.width = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(size)])
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranked = _ranked(path)
        self.words: dict[str, bytes] = {}

    def ids(self, text: str) -> np.ndarray:
        if self.ranked is not None and not any(s in text for s in self.special):
            return np.array(self.ranked.encode_ordinary(text), dtype=self.width)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.width)

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self._pieces(t) for t in texts]
        wanted: set[str] = set()
        for _, words, _ in cut:
            wanted.update(words)
        fresh = self._learn(wanted.difference(self.words))
        find = self.words.__getitem__
        out = [b"".join([head, *map(find, words)]) if odd is None else self._mixed(odd) for head, words, odd in cut]
        if len(self.words) > REMEMBERED:
            for w in fresh:
                del self.words[w]
        return out

    def _pieces(self, text: str):
        """(ids of the first piece, words after it, None), or all pieces where some are more than a word."""
        if not _SPACES.search(text) and not any(s in text for s in self.special):
            first, *words = text.split(" ")
            if "" not in words:
                return self.ids(first).tobytes(), words, None
        pieces = _SPLIT.split(text)
        plain = [p[1:] if p[:1] == " " and not _SPACE.search(p, 1) and not any(s in p for s in self.special) else None for p in pieces]
        return b"", [w for w in plain if w], [(w or None, p) for w, p in zip(plain, pieces, strict=True)]

    def _mixed(self, pieces) -> bytes:
        return b"".join(self.words[w] if w else self.ids(p).tobytes() for w, p in pieces)

    def _learn(self, missing: set[str]) -> list[str]:
        words = list(missing)
        if not words:
            return words
        ids = self.ids(" " + " ".join(words))
        at = np.flatnonzero(self.opens[ids])
        raw, ends = ids.tobytes(), [*at[1:].tolist(), len(ids)]
        size = self.width.itemsize
        for w, a, b in zip(words, at.tolist(), ends, strict=True):
            self.words[w] = raw[a * size : b * size]
        return words


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def combinations(bins: int, depth: int = 3) -> list[tuple[int, ...]]:
    """All ascending tuples of up to `depth` bins that sum to `bins`."""

    def grow(left: int, least: int, depth: int):
        if depth == 1:
            if left >= least:
                yield (left,)
            return
        for first in range(least, left // depth + 1):
            for rest in grow(left - first, first, depth - 1):
                yield (first, *rest)

    return [c for d in range(1, depth + 1) for c in grow(bins, 1, d)]


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by the active-set method; ends when a round no longer lowers the misfit."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    gram, onto = a.T @ a, a.T @ b
    close, before = 1e-9 * float(b @ b), np.inf
    while True:
        rest = b - a @ x
        gain = np.where(active, -np.inf, a.T @ rest)
        if active.all() or gain.max() <= 0 or before - rest @ rest <= close:
            break
        before = rest @ rest
        active[int(gain.argmax())] = True
        while True:
            trial = np.zeros_like(x)
            # The least squares of the active columns; the small ridge keeps dependent columns solvable.
            on = np.flatnonzero(active)
            trial[on] = np.linalg.solve(gram[np.ix_(on, on)] + 1e-10 * np.eye(len(on)), onto[on])
            bad = active & (trial <= 0)
            if not bad.any():
                x = trial
                break
            step = (x[bad] / np.maximum(x[bad] - trial[bad], 1e-300)).min()
            x = x + step * (trial - x)
            active &= x > 1e-12
            x[~active] = 0.0
    return x


def repeats(histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Combinations with their number of copies; together they need no more pieces of a bin than there are."""
    bins = len(histogram) - 1
    shapes = combinations(bins)
    a = np.zeros((bins + 1, len(shapes)))
    for j, shape in enumerate(shapes):
        for i in shape:
            a[i, j] += 1
    scale = max(1.0, float(histogram.max()))
    counts = np.floor(nnls(a, histogram / scale) * scale + 1e-6).astype(np.int64)
    left, out = histogram.astype(np.int64).copy(), []
    for j in np.argsort(-counts, kind="stable"):
        need = a[:, j].astype(np.int64)
        copies = min(int(counts[j]), int((left[need > 0] // need[need > 0]).min()))
        if copies > 0:
            left -= copies * need
            out.append((shapes[j], copies))
    return out


def tokenized(df: DataFrame, id_col: str, text_col: str, vocabulary: str, window: int, step: int) -> DataFrame:
    """Pieces (`piece`, `id`, `start`, `length`, `doc_tokens`, `task`, `bin`, `nth`, `tokens`).

    `nth` numbers the pieces of a bin within the task that made them.
    """
    ids = df.schema[id_col].dataType

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, task, made = encoder(vocabulary), TaskContext.get().partitionId(), 0
        seen = np.zeros(window // step + 2, dtype=np.int64)
        width, end = enc.width.itemsize, np.array([END_ID], dtype=enc.width).tobytes()
        for batch in batches:
            for low in range(0, len(batch), AT_ONCE):
                rows = []
                some = batch.iloc[low : low + AT_ONCE]
                for own, coded in zip(some["id"], enc.encode(some["text"].tolist()), strict=True):
                    coded += end
                    total = len(coded) // width
                    for start in range(0, total, window):
                        piece = coded[start * width : (start + window) * width]
                        n = len(piece) // width
                        b = -(-n // step)
                        rows.append((task << 40 | made, own, start, n, total, task, b, seen[b], piece))
                        seen[b] += 1
                        made += 1
                yield pd.DataFrame(rows, columns=["piece", "id", "start", "length", "doc_tokens", "task", "bin", "nth", "tokens"])

    rows = df.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    kinds = f"piece long, id {ids.simpleString()}, start long, length int, doc_tokens long, task int, bin int, nth long, tokens binary"
    return rows.mapInPandas(run, kinds)


def layout(pieces: DataFrame, window: int = WINDOW, step: int = STEP) -> DataFrame:
    """(`piece`, `skip`, `length`, `sequence_id`, `offset`): where each piece, or each part of it, lies."""
    spark = pieces.sparkSession
    small = pieces.select("piece", "length", "task", "bin", "nth")
    counts = small.groupBy("task", "bin").count()
    histogram = np.zeros(window // step + 1)
    for r in counts.groupBy("bin").agg(F.sum("count").alias("n")).collect():
        histogram[r.bin] = r.n
    used = np.zeros(len(histogram), dtype=np.int64)
    slots, first = [], 0
    for shape, copies in repeats(histogram):
        for place, b in enumerate(shape):
            slots.append((b, int(used[b]), int(used[b]) + copies, place, first))
            used[b] += copies
        first += copies
    # One row per place of a combination that is used: bounded by the number of bins.
    lookup = spark.createDataFrame(slots or [(-1, 0, 0, 0, 0)], "bin int, low long, high long, place int, first long")
    before = counts.select("task", "bin", (F.sum("count").over(W.partitionBy("bin").orderBy("task")) - F.col("count")).alias("before"))
    ranked = small.join(before, ["task", "bin"]).withColumn("rank", F.col("before") + F.col("nth"))
    hit = (ranked["bin"] == lookup["bin"]) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    placed = ranked.join(F.broadcast(lookup), hit, "left").select(ranked["*"], "low", "place", "first")

    together = W.partitionBy("sequence_id").orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    combined = placed.filter("place IS NOT NULL").withColumn("sequence_id", F.col("first") + F.col("rank") - F.col("low"))
    combined = combined.select(
        "piece", F.lit(0).cast("long").alias("skip"), F.col("length").cast("long").alias("length"), "sequence_id", (F.sum("length").over(together) - F.col("length")).alias("offset")
    )

    rest = placed.filter("place IS NULL").select("piece", "task", F.col("length").cast("long").alias("length"))
    sums = rest.groupBy("task").agg(F.sum("length").alias("n"))
    # One row per task.
    ahead = sums.select("task", (F.sum("n").over(W.orderBy("task")) - F.col("n")).alias("ahead"))
    running = W.partitionBy("task").orderBy("piece").rowsBetween(W.unboundedPreceding, 0)
    streamed = rest.join(ahead, "task").withColumn("at", F.col("ahead") + F.sum("length").over(running) - F.col("length"))
    end = F.col("at") + F.col("length")
    windows = F.sequence(F.floor(F.col("at") / window), F.floor((end - 1) / window))
    parts = streamed.select("piece", "at", end.alias("end"), F.explode(windows).alias("k"))
    low, high = F.greatest("at", F.col("k") * window), F.least("end", (F.col("k") + 1) * window)
    greedy = parts.select(
        "piece", (low - F.col("at")).alias("skip"), (high - low).alias("length"), (F.lit(first) + F.col("k")).alias("sequence_id"), (low - F.col("k") * window).alias("offset")
    )
    return combined.unionByName(greedy)


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, window: int = WINDOW, step: int = STEP) -> DataFrame:
    """One row per piece: `id`, `start`, `length`, `doc_tokens`, `sequence_id`, `offset`, `tokens`.

    `tokens` holds the ids of the piece, two bytes each (four for vocabularies over 65,536), little-endian. Null and empty texts are
    one end id. Repeated rows are packed each for itself; other columns are ignored; no rows give no rows.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path(VOCABULARY)
    pieces, _ = store(tokenized(df, id_col, text_col, vocabulary, window, step), "pieces")
    places = layout(pieces, window, step).withColumnRenamed("length", "n")
    width = 2 if encoder(vocabulary).width.itemsize == 2 else 4
    joined = pieces.select("piece", "id", "start", "doc_tokens", "tokens").join(places, "piece")
    own = F.expr(f"substring(tokens, cast(skip * {width} + 1 as int), cast(n * {width} as int))")
    return joined.select("id", (F.col("start") + F.col("skip")).alias("start"), F.col("n").alias("length"), "doc_tokens", "sequence_id", "offset", own.alias("tokens"))


@F.pandas_udf(T.LongType())
def _crc32(tokens: pd.Series) -> pd.Series:
    return tokens.map(lambda b: zlib.crc32(np.frombuffer(b, dtype="<u2").astype("<u4").tobytes()))


def digests(packed: DataFrame) -> DataFrame:
    return packed.select(
        F.col("id").alias("doc_id"), "start", "length", _crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op6_packing(spark, sf_dir) -> DataFrame:
    return digests(pack(table(spark, sf_dir, "documents")))
