"""Operators on column functions against plain Python."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from seriesloom.llm import exact_dedup, fingerprint, pii, sharding
from seriesloom.llm.common import WHITE, ascii_lower


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def shingles(text, width=5):
    words = [w for w in re.split(WHITE, lower(text)) if w]
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or {tuple(words)}


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edit(rows):
    """(id, text, edited text, next text) by ascending id, nulls first."""
    rows = sorted(((i, t or "") for i, t, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    for (i, t), (_, n) in zip(rows, rows[1:] + rows[:1], strict=True):
        q = len(t) // 4
        yield i, t, t[: len(t) - q] + n[:q], n


def test_fingerprints_follow_true_likeness(spark, sf, docs):
    got = {r.doc_id: r for r in fingerprint.op1_fingerprints(spark, sf).collect()}
    assert len(got) == len(docs)
    errors = []
    for i, t, e, n in edit(docs):
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert len(base64.b64decode(r.fingerprint)) == 8 * min(fingerprint.K, len(shingles(t)))
        small = max(len(shingles(x)) for x in (t, e)) <= fingerprint.K // 2
        assert r.near_edited == pytest.approx(likeness(shingles(t), shingles(e)), abs=1e-9 if small else 0.2)
        errors += [abs(r.near_edited - likeness(shingles(t), shingles(e))), abs(r.near_next - likeness(shingles(t), shingles(n)))]
    assert sum(errors) / len(errors) < 0.02
    by_text = defaultdict(set)
    for i, t, *_ in docs:
        by_text[t].add(got[i].fingerprint)
    assert all(len(x) == 1 for x in by_text.values())


@pytest.mark.parametrize("buckets", [1, 3, 40])
def test_next_document_of_odd_rows(odd, odd_rows, buckets):
    got = sorted(
        ((r.id is not None, r.id or 0, r.n_chars, r.edited) for r in fingerprint.edited(odd(odd_rows), buckets=buckets).collect())
    )
    want = sorted((i is not None, i or 0, len(t), e) for i, t, e, _ in edit(odd_rows))
    assert got == want


def test_fingerprint_of_one_and_no_rows(odd):
    assert fingerprint.edited(odd([])).collect() == []
    (r,) = fingerprint.edited(odd([(9, "abcd", None)])).collect()
    assert (r.edited, r.near_next) == ("abca", 1.0)


def test_sketches_merge_and_estimate(spark):
    text = " ".join(f"w{i}" for i in range(6000))
    half = " ".join(f"w{i}" for i in range(3000))
    both = spark.createDataFrame([(1, text), (1, half), (2, half), (3, "")], "k int, text string")
    parts = both.select("k", fingerprint.sketch(F.col("text")).alias("sketch"))
    merged = {r.k: r.sketch for r in fingerprint.merge(parts, ["k"]).collect()}
    own = {len(r.text): r.sketch for r in both.select("text", fingerprint.sketch(F.col("text")).alias("sketch")).collect()}
    assert merged[1] == own[len(text)] and merged[2] == own[len(half)] and merged[3] == []
    pair = spark.createDataFrame([(merged[1], merged[2])], "a array<bigint>, b array<bigint>")
    a, b = F.col("a"), F.col("b")
    est = pair.select(
        fingerprint.distinct(a).alias("n"), fingerprint.containment(b, a).alias("c"), fingerprint.resemblance(a, b).alias("r")
    ).first()
    assert est.n == pytest.approx(5996, rel=0.3) and est.c > 0.8 and est.r == pytest.approx(0.5, abs=0.15)


def test_ascii_lower_leaves_other_letters(spark):
    rows = spark.createDataFrame([("AbZÉß",), ("ABC",), ("",)], "t string").select(ascii_lower(F.col("t")).alias("t")).collect()
    assert [r.t for r in rows] == ["abzÉß", "abc", ""]


def brute_dedup(rows, best):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[lower(t or "")].append(i)
    out = []
    for i, t, *_ in rows:
        ids = [x for x in groups[lower(t or "")] if x is not None]
        keep = best(ids) if ids else None
        out.append((i, keep, len(groups[lower(t or "")]), i == keep, hashlib.sha256(lower(t or "").encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize(("runs", "fan_in", "keep"), [(1, 2, "smallest"), (5, 2, "largest"), (60, 8, "smallest")])
def test_exact_dedup_against_brute_force(odd, odd_rows, docs, runs, fan_in, keep):
    rows = odd_rows + [(100 + i, "Hot Text" if i % 3 else docs[i][1], "s") for i in range(150)]
    marks = exact_dedup.mark(odd(rows), keep=keep, runs=runs, fan_in=fan_in).collect()
    got = Counter((r.id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex()) for r in marks)
    assert got == brute_dedup(rows, min if keep == "smallest" else max)


def test_exact_dedup_of_no_rows(odd):
    assert exact_dedup.mark(odd([])).collect() == []


def brute_spans(text):
    text = text or ""
    luhn = lambda n: sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(n))) % 10 == 0
    number = lambda s: re.sub("[^0-9]", "", s)
    tests = {
        "email": lambda s: True,
        "ip": lambda s: all(int(p) <= 255 for p in s.split(".")),
        "card": lambda s: 13 <= len(number(s)) <= 19 and luhn(number(s)),
        "phone": lambda s: 9 <= len(number(s)) <= 15,
    }
    patterns = {k.name: k.pattern for k in pii.KINDS}
    return [f"{k}:{m.start()}:{m.end()}" for k, ok in tests.items() for m in re.finditer(patterns[k], text) if ok(m.group())]


PERSONAL = [
    "mail a.b@c.de, a@b.c_d@e.f x@y @z.q é@b.cd ÄÖ x@y.z.",
    "1.2.3.4 256.1.1.1 0000255.0.0.1 1.2.3.4.5 99999999999.1.1.1 1..2.3",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112, 4111111111111111 49927398716 1  2 0000000000000",
    "call +1 (337) 555-9217 or +49 30 1234567. +1-2 +123456789012345678 +1234567890123456789012",
    "𝒳𝒳 a@b.cc 𝒳 +1 (337) 555-9217 é 8.8.8.8",
    "iban DE89 3704 0044 0532 0130 00 and DE88 3704 0044 0532 0130 00, ssn 123-45-6789",
    "987-65-4321",
    "",
    None,
    "9" * 5000 + "@" + "a." * 2000,
]


def check_spans(texts, rows):
    for i, t in texts:
        want = brute_spans(t)
        r = rows[i]
        assert [s for s in r.spans.split(",") if s and s.split(":")[0] in pii.BASE] == want
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in want) for k in pii.BASE]


def test_personal_data_against_brute_force(spark, tmp_path, odd):
    odd([(i, t, None) for i, t in enumerate(PERSONAL)]).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in pii.op3_pii(spark, str(tmp_path)).collect()}
    check_spans(enumerate(PERSONAL), rows)
    text = PERSONAL[5]
    begin = text.index("DE89")
    assert f"iban:{begin}:{begin + 27}" in rows[5].spans and "DE88" not in rows[5].spans
    assert rows[5].spans.count("iban:") == 1 and "ssn:" in rows[5].spans and "ssn:" not in rows[6].spans
    assert pii.find(odd([])).collect() == []


def test_personal_data_of_documents(spark, docs, sf):
    check_spans([(i, t) for i, t, _ in docs], {r.doc_id: r for r in pii.op3_pii(spark, sf).collect()})


@pytest.mark.parametrize("bucket_bytes", [1000, 1 << 20])
def test_shards_are_even_gapless_and_repeatable(spark, odd, odd_rows, docs, bucket_bytes):
    rows = odd_rows + [(100 + i, t, s) for i, t, s in docs]
    frame = odd(rows)
    got = sharding.shuffle(frame, bucket_bytes=bucket_bytes).collect()
    assert Counter((r.record.doc_id, r.record.text) for r in got) == Counter((i, t) for i, t, _ in rows)
    assert all(r.size == len((r.record.text or "").encode()) + 1 for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(16)]
    assert max(counts) - min(counts) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    place = lambda rs: {(r.record.doc_id, r.record.text, r.shard, r.slot) for r in rs}
    again = sharding.shuffle(frame.repartition(7, "text"), bucket_bytes=bucket_bytes).collect()
    assert place(again) == place(got)
    assert place(sharding.shuffle(frame, bucket_bytes=bucket_bytes, seed=5).collect()) != place(got)


def test_shards_of_no_rows_and_files(spark, odd, odd_rows, tmp_path):
    assert sharding.shuffle(odd([])).collect() == []
    sharding.write(sharding.shuffle(odd(odd_rows), shards=3), f"{tmp_path}/out", shards=3)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == len(odd_rows) and back.select("shard").distinct().count() == 3


def test_shard_query_columns(spark, sf, docs):
    rows = {r.doc_id: r for r in sharding.op8_sharding(spark, sf).collect()}
    assert all(rows[i].text_crc32 == zlib.crc32((t or "").encode()) and rows[i].law == "rows" for i, t, _ in docs)
