"""Language identification with a bit-sliced Bloom filter of n-grams.

Every language has a Bloom filter over the character n-grams that are typical of it; all filters share their hash
positions and are stored as slices: a slot holds one bit per language. Looking an n-gram up is an AND of its slots
and gives all languages that contain it at once. Per language the n-grams of a text that it contains are counted;
counts are corrected for the false positives that its filter's fill lets expect, and the largest corrected share decides.

An n-gram is typical of a language if enough of its documents hold it and if its rate there is not far below its rate in
any other language, so passages in a foreign language and rare noise stay out of the filters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, table

# Fixed values of the contract.
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"

#: The filters are fitted on so many documents of each language (on all where it has fewer), give or take what a draw by a
#: hash of their ids leaves to chance.
SAMPLE_DOCS = 1000
LENGTHS = (1, 2, 3, 4)
#: Slots of the filter and slots an n-gram sets.
SLOTS, HASHES = 1 << 20, 3
#: Documents of a language that hold a typical n-gram, and its rate there against its highest rate in any language.
LEAST_DOCS, LEAST_RATE = 3, 0.25
#: N-grams of a language that enter its filter, the most frequent first: bounds the fill of the filter.
MOST_GRAMS = 1 << 17
#: Code points that are hashed, and texts that are counted, at a time.
SLAB = 1 << 18
MOST_TEXTS = 1000
#: The bits of every byte.
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float64)


def held_out(id_col: Column) -> Column:
    """Whether a row is kept from all learning; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


@cache
def _folded() -> np.ndarray:
    """Code point -> lower-case code point of a letter, a space for everything that is no letter."""
    out = np.full(0x110000, 32, dtype=np.uint32)
    for c in range(0x110000):
        if (s := chr(c)).isalpha():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts, lower-cased, runs of anything else as one space, each text between two spaces; and where texts start."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    points = np.frombuffer(" ".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    low = np.full(len(points) + 2, 32, dtype=np.uint32)
    low[1:-1] = _folded()[points]
    owner = np.repeat(np.arange(len(texts)), lengths + 1)  # a text and the space behind it
    owner = np.append(0, owner) if len(texts) else np.zeros(2, dtype=np.int64)
    keep = np.ones(len(low), dtype=bool)
    keep[1:] = (low[1:] != 32) | (low[:-1] != 32)
    return low[keep], owner[keep]


def grams(low: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(64-bit hashes, text numbers) of the n-grams of all lengths, slab by slab; a space only begins or ends an n-gram."""
    last, more = max(LENGTHS), np.uint64(0x9E3779B97F4A7C15)
    for at in range(0, len(low), SLAB):
        part = low[at : at + SLAB + last - 1].astype(np.uint64)
        own = owner[at : at + SLAB + last - 1]
        count = min(SLAB, len(low) - at)
        blank = part == 32
        inner = np.append(0, np.cumsum(blank))
        h = np.zeros(len(part), dtype=np.uint64)
        for n in range(1, last + 1):
            k = min(count, len(part) - n + 1)
            if k <= 0:
                break
            h = (h[:k] + part[n - 1 : n - 1 + k]) * more
            h ^= h >> np.uint64(29)
            if n not in LENGTHS:
                continue
            ok = ~blank[:k] if n == 1 else (inner[n - 1 : n - 1 + k] - inner[1 : 1 + k] == 0) if n > 2 else ~(blank[:k] & blank[1 : 1 + k])
            # The text of an n-gram is that of its first letter.
            first = np.arange(k) + blank[:k]
            yield h[:k][ok] ^ (np.uint64(n) << np.uint64(56)), own[np.minimum(first, len(own) - 1)][ok]


def positions(h: np.ndarray) -> list[np.ndarray]:
    """The slots of hashes, by double hashing."""
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + np.uint64(i) * step) & np.uint64(SLOTS - 1)).view(np.int64) for i in range(HASHES)]


@dataclass
class Filters:
    """Languages, most frequent first, and slices: a byte for each eight languages by slots."""

    langs: list[str]
    slices: np.ndarray

    def __post_init__(self):
        filled = [(np.bincount(plane, minlength=256) @ BITS) / SLOTS for plane in self.slices]
        self.chance = np.concatenate(filled)[: len(self.langs)] ** HASHES

    def containing(self, places: list[np.ndarray], plane: int) -> np.ndarray:
        """Per n-gram the bits of the languages of a plane that contain it."""
        found = self.slices[plane][places[0]]
        for p in places[1:]:
            found &= self.slices[plane][p]
        return found

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """N-grams of every text and, per language, how many of them it contains."""
        n, hits = np.zeros(len(texts)), np.zeros((len(texts), 8 * len(self.slices)))
        for h, own in grams(*folded(texts)):
            places = positions(h)
            for plane in range(len(self.slices)):
                met = np.bincount(own * 256 + self.containing(places, plane), minlength=256 * len(texts)).reshape(-1, 256)
                hits[:, 8 * plane : 8 * plane + 8] += met @ BITS
            n += met.sum(axis=1)
        return n, hits[:, : len(self.langs)]

    def decide(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score of every text; the score is the corrected share of its n-grams that the language contains."""
        n, hits = self.counts(texts)
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        share = (hits / np.maximum(n, 1)[:, None] - self.chance) / (1 - np.minimum(self.chance, 0.999))
        share = np.clip(share, 0, 1)
        best = share.argmax(axis=1)  # ties: the most frequent language
        names = [self.langs[b] if k else UNKNOWN for b, k in zip(best, n, strict=True)]
        return names, np.where(n > 0, share[np.arange(len(texts)), best], 0.0)


def _texts(texts: pd.Series) -> Iterator[list[str]]:
    """Runs of texts of some SLAB characters; a long text is one run."""
    run, size = [], 0
    for t in texts:
        run.append(t or "")
        size += len(run[-1]) + 1
        if size >= SLAB or len(run) >= MOST_TEXTS:
            yield run
            run, size = [], 0
    if run:
        yield run


def _gram_docs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(language, n-gram, documents, occurrences) of slabs of the texts of a task; slabs of a long text count as documents."""
    for batch in batches:
        for lang, rows in batch.groupby("lang"):
            for run in _texts(rows["text"]):
                for h, own in grams(*folded(run)):
                    # Texts ascend, so a stable order by n-gram is one by n-gram and text.
                    order = np.argsort(h, kind="stable")
                    h, own = h[order], own[order]
                    new = np.append(True, h[1:] != h[:-1])[: len(h)]
                    at = np.flatnonzero(new)
                    if len(at):
                        docs = np.add.reduceat(new | np.append(True, own[1:] != own[:-1]), at)
                        yield pd.DataFrame({"lang": lang, "h": h[at].view(np.int64), "docs": docs, "n": np.diff(np.append(at, len(h)))})


def teachable(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(`lang`, `text`, `place`) of documents that may teach; places are uniform in [0, 1)."""
    place = F.shiftrightunsigned(F.xxhash64(F.col(id_col).cast("string"), F.lit("sample")), 1) / 2.0**63
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), place.alias("place"), held_out(F.col(id_col)).alias("held"))
    return rows.filter("NOT held AND lang IS NOT NULL AND text IS NOT NULL").drop("held")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = SAMPLE_DOCS) -> Filters:
    """Filters of all languages that occur; rows that are held out and rows without text or language teach nothing."""
    rows = teachable(docs, id_col, text_col, lang_col)
    counted = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()  # one row per language
    langs = [r.lang for r in counted]
    slices = np.zeros((max(1, -(-len(langs) // 8)), SLOTS), dtype=np.uint8)
    if not langs:
        return Filters(langs, slices)
    # The share of a language that is taken; texts stay where they are.
    shares = F.create_map(*[F.lit(v) for r in counted for v in (r.lang, min(1.0, most / r["count"]))])
    teach = rows.filter(F.col("place") < F.element_at(shares, F.col("lang"))).select("lang", "text")
    each = teach.mapInPandas(_gram_docs, "lang string, h long, docs long, n long")
    found = cut(each.groupBy("lang", "h").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")), "grams")
    totals = found.groupBy("lang").agg(F.sum("n").alias("total"))
    rated = found.join(totals, "lang").withColumn("rate", F.col("n") / F.col("total"))
    top = rated.withColumn("most", F.max("rate").over(Window.partitionBy("h")))
    typical = top.filter((F.col("docs") >= LEAST_DOCS) & (F.col("rate") >= LEAST_RATE * F.col("most")))
    by_rate = Window.partitionBy("lang").orderBy(F.desc("rate"), "h")
    # The rows of one language are bounded by its sample.
    chosen = typical.withColumn("rank", F.row_number().over(by_rate)).filter(F.col("rank") <= MOST_GRAMS).select("lang", "h")
    at = {name: i for i, name in enumerate(langs)}
    for r in chosen.groupBy("lang").agg(F.collect_list("h").alias("hs")).toLocalIterator():  # at most MOST_GRAMS each
        i = at[r.lang]
        for p in positions(np.array(r.hs, dtype=np.int64).view(np.uint64)):
            slices[i // 8, p] |= np.uint8(1 << i % 8)
    return Filters(langs, slices)


def identify(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: `id`, `lang_pred`, `score` (0 to 1).

    A null text and a text without a letter is `und` with score 0. A text whose n-grams no language contains goes to the most
    frequent learned language with score 0; where no language was learned, all are `und`. Rows that repeat get the same
    result; other columns are ignored; no rows give no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(filters)  # 1 MB for each eight languages

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names, scores = [], []
            for texts in _texts(batch["text"]):
                name, score = sent.value.decide(texts)
                names += name
                scores += score.tolist()
            yield pd.DataFrame({"id": batch["id"], "lang_pred": names, "score": scores})

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, f"id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double")


def op11_language_id(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, train(docs))
    return found.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "lang_pred", "score")
