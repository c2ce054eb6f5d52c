"""The middle stages of the corpus pipeline against plain Python, each on what the one before kept."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from test_free import brute_groups, lower, water_fill

import corpus_pipeline
from seriesloom.llm import linededup, minhash, mixing

WHITE = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    """Rows before and after every stage but the last, by name."""
    at = tmp_path_factory.mktemp("stages")
    now, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = now.collect()
        stage(spark, now, sf).write.parquet(str(at / name))
        now = spark.read.parquet(str(at / name))
        out[name] = before, now.collect()
    return out


def test_stages_keep_the_columns(spark, sf, stages):
    want = spark.read.parquet(f"{sf}/documents.parquet").columns
    assert all(after[0].__fields__ == want for _, after in stages.values())


def test_line_dedup_keeps_first_occurrences(spark, sf, stages):
    before, after = stages["line dedup"]
    frame = spark.createDataFrame(before, spark.read.parquet(f"{sf}/documents.parquet").schema)
    place = {r.doc_id: r.k for r in frame.select("doc_id", linededup.row_key("doc_id", "text").alias("k")).collect()}
    lines = {r.doc_id: (r.text or "").split("\n") for r in before}
    key = lambda line: lower(line.strip(WHITE))
    holders, first = defaultdict(set), {}
    for i, own in lines.items():
        for pos, line in enumerate(own):
            holders[key(line)].add(i)
            first[key(line)] = min(first.get(key(line), (math.inf, 0)), (place[i], pos))
    for r in after:
        kept = [x for pos, x in enumerate(lines[r.doc_id]) if not key(x) or len(holders[key(x)]) < 10 or first[key(x)] == (place[r.doc_id], pos)]
        assert (r.text or "") == "\n".join(kept) and r.n_chars == len("\n".join(kept))
    assert len(after) == len(before)


def test_near_dedup_keeps_the_smallest_id_of_each_group(stages):
    before, after = stages["near dedup"]
    roots, _ = brute_groups([(r.doc_id, r.text, r.source) for r in before], 5)
    assert sorted(after) == sorted(r for r in before if roots[r.doc_id] == r.doc_id)


def test_mixing_repeats_documents_as_the_targets_say(stages):
    before, after = stages["mixing"]
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in before}
    groups = defaultdict(list)
    for r in before:
        groups[r.source].append(r)
    names = sorted(groups, key=lambda s: (s is None, s or ""))
    sizes = [sum(size[r.doc_id] for r in groups[s]) for s in names]
    targets = water_fill(sizes, [mixing.WEIGHTS[k % 3] for k in range(len(names))], mixing.SHARE * sum(sizes), mixing.EPOCHS)
    want = Counter()
    for name, n, target in zip(names, sizes, targets, strict=True):
        whole = math.floor(target / n) if n else 1
        ahead = 0
        for r in sorted(groups[name], key=lambda r: hashlib.md5(f"{mixing.SEED}:{r.doc_id}".encode()).hexdigest()):
            want[r.doc_id] = whole + (ahead + size[r.doc_id] / 2 <= target - whole * n)
            ahead += size[r.doc_id]
    assert Counter(r.doc_id for r in after) == +want
    assert set(after) <= set(before)


def test_repeated_rows_with_another_language_give_one_row(spark, sf, odd):
    """Rows with equal id and text are one document; near dedup keeps one of them, whatever else they hold."""
    rows = odd([(1, "one two three four five six", "a")] * 2 + [(2, "other words stand here alone today", "b")])
    rows = rows.withColumn("lang", F.when(F.col("doc_id") == 1, F.concat(F.lit("l"), F.monotonically_increasing_id().cast("string"))))
    kept = minhash.keep_one(rows, width=5).collect()
    assert sorted(r.doc_id for r in kept) == [1, 2]
