"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Training reads a bounded, seeded sample of the labelled rows: at most `SAMPLE_LABELS` of each label, weighted
by how many there are. Scores read whole texts of all documents.

1. Statistics (Spark): for every word and every word beginning of 4 or 5 letters the
   number of toxic and of clean documents it occurs in, and from these a smoothed log-odds ratio. The
   features most strongly tied to the label form a lexicon of bounded size.
2. Token labels: in toxic documents the tokens whose strongest feature passes a threshold are toxic, all other
   tokens of training documents are not.
3. The chain (states 0 and 1) is fitted by gradient ascent on a bounded, seeded sample of
   windows of labelled tokens: `SAMPLE_DOCS` documents, at most `WINDOW` tokens around evidence or the start.
4. Scores: forward-backward marginals of whole texts. The document score is a logistic function of the log of
   the expected number of toxic tokens, the log of their share and the highest marginal, fitted on the sums of
   training documents. Offsets are the runs of tokens with a marginal of at least one half.

Forward and backward products are 2x2 matrices; they are scanned over blocks of tokens, so a very long
text costs the same per token as many short ones.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, table, whole

TOKEN = re.compile(r"[^\W_]+")
#: Rows whose crc32(id as text) has this remainder are held out from all learning.
FOLDS, HELD_OUT = 4, 2
PREFIXES = (4, 5)
#: Documents a feature must occur in, documents of the prior, log-odds of toxic tokens, and features kept.
LEAST_DOCS, PRIOR, LEAST_ODDS, LEXICON = 4, 10, 2.0, 50_000
#: Labelled rows of each label that training reads: those with the least hash of their id.
SAMPLE_LABELS = 10_000
#: Bounds of the fitting sample: documents of each label, tokens of each window.
SAMPLE_DOCS, WINDOW = 1500, 400
#: Counts that a task holds before it passes them on.
MOST_COUNTS = 300_000
#: Words whose class a task remembers.
REMEMBERED = 400_000
SEED = 5
CUT_AT = 0.3
#: Upper ends of the log-odds classes that are the observations of a token.
CLASSES = (1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0, 6.0)
BLOCK = 128
#: Tokens, and characters of texts, that are worked on at once.
SLAB, AT_ONCE = 1 << 17, 2_000_000


def held_out(id_col: Column) -> Column:
    text = F.coalesce(id_col.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(FOLDS)) == HELD_OUT


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def features(token: str) -> list[str]:
    """A word and its beginnings; a beginning is marked so that it isn't taken for a word."""
    return [token, *(token[:n] + "*" for n in PREFIXES if len(token) > n)]


def feature_counts(labelled: DataFrame) -> DataFrame:
    """(`feature`, `toxic`, `clean`): documents with the feature, from rows (`text`, `toxic`)."""

    def rows(counts):
        for label, own in enumerate(counts):
            if own:
                n = pd.Series(list(own.values()), dtype="int64")
                yield pd.DataFrame({"feature": list(own), "clean": n * (1 - label), "toxic": n * label})
                own.clear()

    def per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: tuple[dict[str, int], dict[str, int]] = ({}, {})
            for text, label in zip(batch["text"], batch["toxic"], strict=True):
                own = counts[label]
                for f in {f for t in set(tokens(text)) for f in features(t)}:
                    own[f] = own.get(f, 0) + 1
                if len(own) > MOST_COUNTS:
                    yield from rows(counts)
            yield from rows(counts)

    counted = labelled.mapInPandas(per_batch, "feature string, clean long, toxic long")
    return counted.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


@dataclass
class Model:
    """What scoring needs: log-odds by feature, the chain's weights, and the logistic function."""

    lexicon: dict[str, float]
    state: list[list[float]]
    move: list[list[float]]
    start: list[float]
    logistic: list[float]
    center: list[float]
    scale: list[float]

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Model:
        return Model(**json.loads(text))

    def classes(self, toks: list[str], cache: dict[str, int]) -> np.ndarray:
        codes = list(map(cache.get, toks))
        for t in set(compress(toks, [c is None for c in codes])):
            odds = max(self.lexicon.get(f, -9.0) for f in features(t))
            cache[t] = 0 if odds == -9.0 else 1 + bisect_left(CLASSES, odds)
        if None in codes:
            codes = list(map(cache.__getitem__, toks))
        if len(cache) > REMEMBERED:
            cache.clear()
        return np.array(codes, dtype=np.int64)

    def scores(self, summaries: np.ndarray) -> np.ndarray:
        w = np.array(self.logistic)
        z = w[0] + ((summaries - np.array(self.center)) / np.array(self.scale)) @ w[1:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


N_CLASSES = len(CLASSES) + 2


def _scan(m: np.ndarray) -> np.ndarray:
    """Running products m[0] @ m[1] @ ... @ m[i] for 2x2 matrices, each scaled to largest entry 1."""
    n = len(m)
    if n <= BLOCK:
        out = np.empty_like(m)
        run = m[0]
        out[0] = run
        for i in range(1, n):
            run = run @ m[i]
            run = run / run.max()
            out[i] = run
        return out
    blocks = -(-n // BLOCK)
    padded = np.broadcast_to(np.eye(2), (blocks * BLOCK, 2, 2)).copy()
    padded[:n] = m
    grid = padded.reshape(blocks, BLOCK, 2, 2)
    inside = np.empty_like(grid)
    inside[:, 0] = grid[:, 0]
    for i in range(1, BLOCK):
        a, b = inside[:, i - 1], grid[:, i]
        step = np.empty_like(b)
        for r in (0, 1):
            for c in (0, 1):
                step[:, r, c] = a[:, r, 0] * b[:, 0, c] + a[:, r, 1] * b[:, 1, c]
        inside[:, i] = step / step.max(axis=(1, 2))[:, None, None]
    before = _scan(inside[:, -1])
    ahead = np.concatenate([np.eye(2)[None], before[:-1]])
    out = np.einsum("bij,bkjl->bkil", ahead, inside)
    return (out / out.max(axis=(2, 3))[..., None, None]).reshape(-1, 2, 2)[:n]


def marginals(obs: np.ndarray, lengths: np.ndarray, state: np.ndarray, move: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Probability of state 1 for every token of the concatenated sequences obs.

    Goes through the tokens in slabs, forwards and back, and carries one vector from slab to slab.
    """
    n = len(obs)
    emit_of, trans, begin = np.exp(state - state.max(axis=1, keepdims=True)), np.exp(move), np.exp(start)
    opens, closes = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    closes[np.cumsum(lengths) - 1] = True
    opens[np.cumsum(lengths) - lengths] = True
    alpha, out = np.empty((n, 2)), np.empty(n)
    carry = np.ones(2)
    for low in range(0, n, SLAB):
        emit = emit_of[obs[low : low + SLAB]]
        m = trans[None] * emit[:, None, :]
        # At the start of a sequence what comes before doesn't matter.
        first = opens[low : low + SLAB]
        m[first] = (begin[None] * emit[first])[:, None, :]
        m[0] = (carry @ m[0])[None, :]
        alpha[low : low + SLAB] = _scan(m)[:, 0, :]
        carry = alpha[min(low + SLAB, n) - 1]
    carry = np.ones(2)
    for low in reversed(range(0, n, SLAB)):
        high = min(low + SLAB, n)
        # beta[i] = back[i] @ beta[i + 1] with back[i] = trans * emit[i + 1], and all ones at the end of a sequence.
        back = np.ones((high - low, 2, 2))
        inner = np.flatnonzero(~closes[low:high])
        back[inner] = trans[None] * emit_of[obs[low + inner + 1]][:, None, :]
        beta = _scan(back[::-1].transpose(0, 2, 1))[::-1].transpose(0, 2, 1) @ carry
        carry = beta[0] / beta[0].max()
        p = alpha[low:high] * beta
        out[low:high] = p[:, 1] / p.sum(axis=1)
    return out


def fit_chain(obs: list[np.ndarray], labels: list[np.ndarray], rounds: int = 60, l2: float = 1e-2):
    """Weights that maximise the penalised likelihood of the labelled sequences: gradient ascent with momentum.

    Expected counts of single states come from the marginals; those of transitions from pairs of them, computed by
    padding the (bounded) windows into one matrix.
    """
    n, longest = len(obs), max(map(len, obs))
    x = np.zeros((n, longest), dtype=np.int64)
    y = np.zeros((n, longest), dtype=np.int64)
    on = np.zeros((n, longest), dtype=bool)
    for i, (o, t) in enumerate(zip(obs, labels, strict=True)):
        x[i, : len(o)], y[i, : len(o)], on[i, : len(o)] = o, t, True
    total = on.sum()
    seen_state = np.zeros((N_CLASSES, 2))
    np.add.at(seen_state, (x[on], y[on]), 1)
    pair = on[:, 1:]
    seen_move = np.zeros((2, 2))
    np.add.at(seen_move, (y[:, :-1][pair], y[:, 1:][pair]), 1)
    seen_start = np.bincount(y[:, 0], minlength=2).astype(float)
    w = [np.zeros((N_CLASSES, 2)), np.zeros((2, 2)), np.zeros(2)]
    first, second = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    for k in range(1, rounds + 1):
        state, move, start = w
        emit, trans = np.exp(state)[x], np.exp(move)
        alpha = np.empty((longest, n, 2))
        a = np.exp(start) * emit[:, 0]
        alpha[0] = a / a.sum(axis=1, keepdims=True)
        for i in range(1, longest):
            a = (alpha[i - 1] @ trans) * emit[:, i]
            a = a / a.sum(axis=1, keepdims=True)
            alpha[i] = np.where(on[:, i, None], a, alpha[i - 1])
        beta = np.ones((n, 2))
        want_state, want_move = np.zeros((N_CLASSES, 2)), np.zeros((2, 2))
        for i in range(longest - 1, -1, -1):
            p = alpha[i] * beta
            p = np.where(on[:, i, None], p / p.sum(axis=1, keepdims=True), 0.0)
            for s in (0, 1):
                want_state[:, s] += np.bincount(x[:, i], weights=p[:, s], minlength=N_CLASSES)
            if i == 0:
                want_start = p.sum(axis=0)
                break
            e = emit[:, i] * beta
            both = alpha[i - 1][:, :, None] * trans[None] * e[:, None, :]
            both = both / both.sum(axis=(1, 2))[:, None, None]
            want_move += both[on[:, i]].sum(axis=0)
            b = e @ trans.T
            beta = np.where(on[:, i, None], b / b.sum(axis=1, keepdims=True), beta)
        grads = [(s - e) / total - l2 * a / total for s, e, a in zip((seen_state, seen_move, seen_start), (want_state, want_move, want_start), w, strict=True)]
        for j, g in enumerate(grads):
            first[j] = 0.9 * first[j] + 0.1 * g
            second[j] = 0.99 * second[j] + 0.01 * g * g
            w[j] = w[j] + 0.3 * (first[j] / (1 - 0.9**k)) / (np.sqrt(second[j] / (1 - 0.99**k)) + 1e-9)
    return w


def summary(probs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per sequence: log of 0.01 + expected toxic tokens, log of 0.001 + their share, and the highest marginal."""
    out = np.zeros((len(lengths), 3))
    out[:, 0], out[:, 1] = np.log(0.01), np.log(0.001)
    full = np.flatnonzero(lengths)
    if len(full):
        first = np.concatenate([[0], np.cumsum(lengths[full])[:-1]])
        total = np.add.reduceat(probs, first)
        out[full] = np.stack([np.log(0.01 + total), np.log(0.001 + total / lengths[full]), np.maximum.reduceat(probs, first)], axis=1)
    return out


def _parts(batch):
    """The batch in slices of about AT_ONCE characters; a longer text is one slice."""
    low, held = 0, 0
    for i, n in enumerate(map(len, batch["text"])):
        held += n
        if held >= AT_ONCE:
            yield batch.iloc[low : i + 1]
            low, held = i + 1, 0
    if low < len(batch):
        yield batch.iloc[low:]


def _sequences(texts, model: Model, cache: dict[str, int]):
    obs = [model.classes(tokens(t), cache) for t in texts]
    lengths = np.array([len(o) for o in obs], dtype=np.int64)
    return (np.concatenate(obs) if len(obs) else np.zeros(0, dtype=np.int64)), lengths


def _marginals(obs: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    return marginals(obs, lengths[lengths > 0], np.array(model.state), np.array(model.move), np.array(model.start))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from the labelled rows that aren't held out.

    Labels other than 0 and 1 (also null) and rows without id are left out; a document with several labels counts with its
    largest. Without toxic or without clean rows the model gives every text the share of toxic labels.
    """
    spark = docs.sparkSession
    own = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("toxic")).filter("toxic IN (0, 1) AND id IS NOT NULL")
    own = cut(own.filter(~held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").cast("int").alias("toxic")), "labels")
    totals = {r.toxic: r["count"] for r in own.groupBy("toxic").count().collect()}
    place = F.xxhash64(F.lit(SEED), "id")
    sample = [own.filter(F.col("toxic") == label).orderBy(place, "id").limit(SAMPLE_LABELS) for label in (0, 1)]
    # At most 2 * SAMPLE_LABELS rows of two numbers: the texts stay where they are.
    chosen = F.broadcast(sample[0].union(sample[1]))
    rows = cut(docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text")).join(chosen, "id"), "labelled")
    held = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    clean, toxic = held.get(0, 0), held.get(1, 0)
    # What a sampled row of each label stands for.
    stands = {label: max(1.0, totals[label] / held[label]) if held.get(label) else 1.0 for label in (0, 1)}
    share = (toxic * stands[1] + 0.5) / (clean * stands[0] + toxic * stands[1] + 1)
    blank = Model({}, [[0.0, 0.0]] * N_CLASSES, [[0.0, 0.0]] * 2, [0.0, 0.0], [float(np.log(share / (1 - share))), 0.0, 0.0, 0.0], [0.0] * 3, [1.0] * 3)
    if not clean or not toxic:
        return blank
    # Log-odds against the share of toxic documents, drawn towards 0 as if PRIOR more documents had that share.
    weighed = (F.col("toxic") * stands[1] + PRIOR * share) / (F.col("clean") * stands[0] + PRIOR * (1 - share))
    odds = F.log(weighed) - float(np.log(share / (1 - share)))
    strong = feature_counts(rows.select("text", "toxic")).filter(F.col("toxic") >= LEAST_DOCS).withColumn("odds", odds)
    kept = strong.filter(F.col("odds") >= 1.0).orderBy(F.desc("odds"), F.desc("toxic"), "feature").limit(LEXICON).collect()
    model = blank
    model.lexicon = {r.feature: float(r.odds) for r in kept}

    # A bounded sample for the chain: the rows of each label with the least hash.
    place = F.xxhash64(F.lit(SEED), "id", "text")
    picked = []
    for label in (0, 1):
        picked += rows.filter(F.col("toxic") == label).orderBy(place, "id").limit(SAMPLE_DOCS).select(_window_udf(model)("text").alias("w"), "toxic").collect()
    obs, marks, evidence = [], [], int(np.searchsorted(CLASSES, LEAST_ODDS)) + 1
    for r in picked:
        o = np.array(r.w, dtype=np.int64)
        if len(o):
            obs.append(o)
            marks.append((o >= evidence).astype(np.int64) * r.toxic)
    if not obs:
        return blank
    state, move, start = fit_chain(obs, marks)
    model.state, model.move, model.start = state.tolist(), move.tolist(), start.tolist()

    sums = rows.select("text", "toxic").mapInPandas(_summaries(model), "a double, b double, c double, toxic int")
    # Equal summaries are one weighted row of rounded values: their number is bounded by the grid, not by the rows.
    grid = sums.groupBy(*(F.round(c, 2 if c == "c" else 1).alias(c) for c in "abc"), "toxic").count().collect()
    x = np.array([[r.a, r.b, r.c] for r in grid])
    y, n = np.array([r.toxic for r in grid], dtype=float), np.array([r["count"] * stands[r.toxic] for r in grid], dtype=float)
    w, center, scale = _weighted_logistic(x, y, n)
    model.logistic, model.center, model.scale = w.tolist(), center.tolist(), scale.tolist()
    return model


def _weighted_logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, rounds: int = 60, l2: float = 1.0):
    center = (x * n[:, None]).sum(axis=0) / n.sum()
    scale = np.maximum(np.sqrt((((x - center) ** 2) * n[:, None]).sum(axis=0) / n.sum()), 1e-6)
    z = np.column_stack([np.ones(len(x)), (x - center) / scale])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hess = z.T @ (z * (n * p * (1 - p))[:, None]) + l2 * np.eye(len(w))
        w = w + np.linalg.solve(hess, z.T @ (n * (y - p)) - l2 * w)
    return w, center, scale


def _window_udf(model: Model):
    """Token classes of a window of a text, around the first evidence or from the start; for the bounded fit only."""
    evidence = int(np.searchsorted(CLASSES, LEAST_ODDS)) + 1

    @F.pandas_udf("array<long>")
    def window(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            o = model.classes(tokens(t), {})
            hits = np.flatnonzero(o >= evidence)
            low = max(0, int(hits[0]) - WINDOW // 4) if len(hits) else 0
            out.append(o[low : low + WINDOW].tolist())
        return pd.Series(out)

    return window


def _summaries(model: Model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, int] = {}
        for batch in (part for whole_batch in batches for part in _parts(whole_batch)):
            obs, lengths = _sequences(batch["text"], model, cache)
            s = summary(_marginals(obs, lengths, model), lengths)
            yield pd.DataFrame({"a": s[:, 0], "b": s[:, 1], "c": s[:, 2], "toxic": batch["toxic"].to_numpy(dtype="int32")})

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: `id`, `score` (0 to 1) and `spans`, the offending offsets (code points) as start:end.

    Null and empty texts are scored as texts without tokens; rows that repeat get the same score; other columns are ignored;
    no rows give no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model.to_json())  # bounded by LEXICON

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, cache = Model.from_json(sent.value), {}
        for batch in (part for whole_batch in batches for part in _parts(whole_batch)):
            obs, lengths = _sequences(batch["text"], own, cache)
            probs = _marginals(obs, lengths, own)
            scores = own.scores(summary(probs, lengths))
            ends = np.cumsum(lengths)
            spans = [""] * len(batch)
            for i in np.unique(np.searchsorted(ends, np.flatnonzero(probs >= 0.5), side="right")):
                p = probs[ends[i] - lengths[i] : ends[i]]
                spans[i] = _offsets(batch["text"].iloc[i], p)
            yield pd.DataFrame({"id": batch["id"], "score": scores, "spans": spans})

    rows = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    return rows.mapInPandas(run, f"id {rows.schema['id'].dataType.simpleString()}, score double, spans string")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", cut_at: float = CUT_AT) -> DataFrame:
    """The rows of docs whose score is below cut_at, with all their columns as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model.to_json())  # bounded by LEXICON
    schema, at = docs.schema, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, cache = Model.from_json(sent.value), {}
        for batch in batches:
            texts = pd.DataFrame({"text": [t or "" for t in batch.column(at).to_pylist()]})
            scores = []
            for part in _parts(texts):
                obs, lengths = _sequences(part["text"], own, cache)
                scores.append(own.scores(summary(_marginals(obs, lengths, own), lengths)))
            if scores:
                yield batch.filter(pa.array(np.concatenate(scores) < cut_at))

    return docs.mapInArrow(run, schema)


def _offsets(text: str, probs: np.ndarray) -> str:
    """Runs of toxic tokens as start:end in code points of the text."""
    low = text.lower()
    found = list(TOKEN.finditer(low))
    back = range(len(text) + 1)
    if len(low) != len(text):  # some letters lower-case into two
        back = [i for i, c in enumerate(text) for _ in c.lower()] + [len(text)]
    runs: list[list[int]] = []
    for k in np.flatnonzero(probs >= 0.5):
        if runs and runs[-1][2] == k - 1:
            runs[-1][1:] = [back[found[k].end()], k]
        else:
            runs.append([back[found[k].start()], back[found[k].end()], int(k)])
    return ",".join(f"{a}:{b}" for a, b, _ in runs)


def op10_toxicity(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return rows.select(
        F.col("id").alias("doc_id"),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= CUT_AT).cast("int").alias("predicted"),
        "spans",
    )
