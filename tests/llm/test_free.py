"""Operators in free style against plain Python, and the pipeline."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.llm import components, linededup, minhash, mixing, packing, toxicity

WHITE = " \t\n\x0b\x0c\r"


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


# --- mixing ------------------------------------------------------------------------------


def water_fill(sizes, weights, total, epochs):
    """Targets by rounds over plain lists."""
    targets, open_, left, weight = [0.0] * len(sizes), set(range(len(sizes))), total, sum(weights)
    while open_ and weight > 0:
        above = [i for i in open_ if left * weights[i] / weight > epochs * sizes[i]]
        if not above:
            for i in open_:
                targets[i] = left * weights[i] / weight
            break
        for i in above:
            targets[i] = float(epochs * sizes[i])
        open_ -= set(above)
        left = total - sum(epochs * sizes[i] for i in range(len(sizes)) if i not in open_)
        weight = sum(weights[i] for i in open_)
    return targets


@pytest.mark.parametrize(
    ("sizes", "weights", "share"),
    [([10, 100, 1000], [5, 2, 1], 300 / 1110), ([10, 20], [5, 2], 100.0), ([0, 0], [5, 2], 1.5), ([7, 50, 3, 900, 41], [5, 2, 1, 5, 2], 1.5), ([], [], 1.5)],
)
def test_water_filling_clamps_and_reshares(spark, sizes, weights, share):
    rows = spark.createDataFrame(list(zip(range(len(sizes)), sizes, map(float, weights), strict=True)), "i int, n long, weight double")
    got = [r.target for r in sorted(mixing.water_fill(rows, share, 2).collect())]
    assert got == pytest.approx(water_fill(sizes, weights, share * sum(sizes), 2))
    assert sum(got) == pytest.approx(min(share * sum(sizes), 2 * sum(sizes))) and all(t <= 2 * s for t, s in zip(got, sizes, strict=True))


def test_ranks_of_many_sources_follow_code_points(spark):
    names = [None, "", "a", "B", "é", "z", "\U0001f600", "\uffff"] + [f"host{i}" for i in range(500)]
    got = {r.source: r.rank for r in mixing.ranked(spark.createDataFrame([(n,) for n in names], "source string").repartition(7), "source").collect()}
    assert got == {n: i for i, n in enumerate(sorted(names, key=lambda n: (n is None, n or "")))}


def test_mix_of_odd_rows_and_a_hot_source(odd, odd_rows, docs):
    rows = odd_rows + [(100 + i, t, "hot" if i % 3 else s) for i, t, s in docs]
    got = mixing.plan(odd(rows)).collect()
    assert Counter((r.id, r.source, r.size) for r in got) == Counter((i, s, len((t or "").split())) for i, t, s in rows)
    largest = max(r.size for r in got)
    by_source = defaultdict(list)
    for r in got:
        by_source[r.source].append(r)
    for group in by_source.values():
        assert {r.source_size for r in group} == {sum(r.size for r in group)}
        assert abs(sum(r.size * r.copies for r in group) - group[0].target) <= max(r.size for r in group) <= largest
    assert all(0 <= r.copies <= 2 for r in got)
    place = lambda rs: Counter((r.id, r.size, r.copies) for r in rs)
    assert place(mixing.plan(odd(rows).repartition(5)).collect()) == place(got)
    mixed = mixing.mix(odd(rows))
    want = Counter()
    for r in got:
        want[r.id] += r.copies
    assert mixed.columns == odd(rows).columns
    once = Counter(i for i, *_ in rows)
    assert all(n == want[i] for i, n in Counter(r.doc_id for r in mixed.collect()).items() if once[i] == 1)


def test_mix_of_no_rows_and_no_words(odd):
    assert mixing.mix(odd([])).collect() == []
    assert [(r.size, r.target) for r in mixing.plan(odd([(1, "", "a"), (2, None, None)])).collect()] == [(0, 0.0), (0, 0.0)]


# --- near-duplicates ---------------------------------------------------------------------


def sets_by_id(rows, width):
    out = {}
    for i, t, *_ in rows:
        words = lower(t or "").encode().split()
        out[i] = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} or ({tuple(words)} if words else set())
    return out


def brute_groups(rows, width):
    """Smallest id reachable over all pairs that share 80 % of their union."""
    sets = {k: frozenset(v) for k, v in sets_by_id(rows, width).items()}
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    index = defaultdict(set)
    for i in ids:
        for s in sets[i]:
            for j in index[s]:
                a, b = find(i), find(j)
                if a != b:
                    common = len(sets[i] & sets[j])
                    if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                        root[max(a, b)] = min(a, b)
        for s in sets[i]:
            index[s].add(i)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def edited_copies():
    """An original that isn't the smallest id, with 60 copies that share more with it than with each other; a chain; tiny texts."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for k in range(60):
        words = list(base)
        for at in rng.choice(200, size=10, replace=False):
            words[at] = f"x{k}_{at}"
        rows.append((k, " ".join(words), "s"))
    rows.append((60, " ".join(base), "s"))
    chain = [f"c{i}" for i in range(100)]
    for k in range(6):
        rows.append((100 + k, " ".join(chain[6 * k : 6 * k + 70]), "s"))
    rows += [(200, "a b", "s"), (201, "A  b", "s"), (202, "a", "s"), (203, "A", "s"), (204, "", "s"), (205, None, "s"), (206, " \n", "s")]
    return rows


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_against_all_pairs(odd, docs, width):
    rows = edited_copies() + [(1000 + i, t, s) for i, t, s in docs] + [(2000 + i, docs[0][1] + f" tail {i}", "s") for i in range(40)]
    got = minhash.groups(odd(rows), width=width).collect()
    want, n = brute_groups(rows, width)
    assert {r.id: r.component_id for r in got} == want
    assert all(r.n_shingles == n[r.id] and r.kept == (r.id == want[r.id]) for r in got) and len(got) == len(rows)
    kept = minhash.keep_one(odd(rows), width=width)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in want if want[i] == i)


def test_near_duplicates_of_odd_rows(odd, odd_rows):
    got = minhash.groups(odd(odd_rows), width=2).collect()
    assert len(got) == len(odd_rows)
    by_id = {r.id: r for r in got}
    assert by_id[1].n_shingles == by_id[2].n_shingles == by_id[7].n_shingles == 0 and by_id[2].component_id == 2
    assert by_id[5].component_id == 5 and by_id[None].component_id is None and by_id[None].kept
    assert minhash.keep_one(odd(odd_rows), width=2).filter("doc_id = 5").count() == 1
    assert minhash.groups(odd([])).collect() == []


def test_twins_behind_a_family_without_links(odd):
    """Two late edits at 0.8018 in a family of copies that are all at 0.786 of each other: no round of centres links anything."""
    core = [f"core2w{i}" for i in range(440)]
    rows = [(i, [*core, *(f"own2w{i}x{k}" for k in range(60))], "a") for i in range(60)]
    rows += [(i, [*core, *(f"late2w{k}" for k in range(5)), *(f"own2w{i}x{k}" for k in range(55))], "a") for i in (100, 101)]
    rows = [(i, " ".join(words), s) for i, words, s in rows]
    want, _ = brute_groups(rows, 1)
    assert want[101] == 100 and sum(i != c for i, c in want.items()) == 1
    assert {r.id: r.component_id for r in minhash.groups(odd(rows), width=1).collect()} == want


def test_densified_minima_follow_likeness():
    bands, rng = minhash.Bands(), np.random.default_rng(1)
    for size in (30, 300, 3000):
        a = np.unique(rng.integers(0, 2**63, size=size).astype(np.uint64))
        b = np.unique(np.concatenate([a[: int(0.9 * size)], rng.integers(0, 2**63, size=size - int(0.9 * size)).astype(np.uint64)]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((bands.minima(a) == bands.minima(b)).mean() - true) < 0.2
    assert len(np.unique(bands.minima(a[:1]))) == 1


def test_components_of_a_hub_and_a_path(spark):
    pairs = [(0, i) for i in range(5, 300)] + [(i, i + 1) for i in range(1000, 1050)] + [(7, 7), (2000, 1999)]
    edges = spark.createDataFrame([(a.to_bytes(4, "big"), b.to_bytes(4, "big")) for a, b in pairs], "a binary, b binary")
    got = {int.from_bytes(r.node, "big"): int.from_bytes(r.root, "big") for r in components.components(edges).collect()}
    want = {i: 0 for i in [0, *range(5, 300)]} | {i: 1000 for i in range(1000, 1051)} | {1999: 1999, 2000: 1999}
    assert got == want


# --- packing -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def test_remembered_words_give_the_same_ids(tokenizer, docs):
    import public_tokenizers

    rng = np.random.default_rng(0)
    parts = ["a", "bc", " ", "  ", "\n", "'s", "!", ".", "é", "\t", "<|endoftext|>", " ", "7", "𝒳", "日本", "\x00", "'LL"]
    texts = ["".join(rng.choice(parts, size=rng.integers(0, 30))) for _ in range(2000)] + [t for _, t, _ in docs]
    coded = packing.Encoder(public_tokenizers.path(packing.VOCABULARY)).encode(texts)
    assert coded == [np.array(c.ids, dtype="<u2").tobytes() for c in tokenizer.encode_batch(texts, add_special_tokens=False)]


def check_pack(rows, texts, tokenizer, fill=0.97):
    """rows: (id, start, length, crc or None, doc_tokens, sequence, offset)."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r[0]].append(r)
        by_sequence[r[5]].append(r)
    for i, t in texts:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r[1]):
            assert r[1] == at and r[4] == len(ids) and zlib.crc32(ids[at : at + r[2]].tobytes()) == r[3]
            at += r[2]
        assert at == len(ids)
    used = 0
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r[6]):
            assert r[6] == at
            at += r[2]
        assert at <= packing.WINDOW
        used += at
    assert used >= fill * packing.WINDOW * (len(by_sequence) - 1)


def test_packing_of_documents(spark, sf, docs, tokenizer):
    rows = [tuple(r) for r in packing.op6_packing(spark, sf).collect()]
    check_pack(rows, [(i, t) for i, t, _ in docs], tokenizer)


def test_packing_of_odd_rows(odd, odd_rows, tokenizer):
    unique = [r for r in odd_rows if r[0] not in (None, 5)]
    check_pack([tuple(r) for r in packing.digests(packing.pack(odd(unique))).collect()], [(i, t) for i, t, _ in unique], tokenizer, 0)
    assert packing.pack(odd([])).collect() == []
    total = packing.pack(odd(odd_rows)).agg(F.sum("length")).first()[0]
    assert total == sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, _ in odd_rows)


def test_repeat_counts_never_exceed_the_histogram():
    rng = np.random.default_rng(2)
    for n in (0, 1, 50, 5000):
        h = np.bincount(rng.integers(1, 129, size=n), minlength=129).astype(float)
        used = np.zeros(129)
        for shape, copies in packing.repeats(h):
            assert sum(shape) == 128
            for b in shape:
                used[b] += copies
        assert (used <= h).all() and (n < 5000 or used.sum() > 0.9 * n)
    a = np.array([[1.0, 0.0, 1.0], [0.0, 1.0, 1.0]])
    assert packing.nnls(a, np.array([1.0, -1.0])) == pytest.approx([1.0, 0.0, 0.0], abs=1e-6)


# --- lines -------------------------------------------------------------------------------


def brute_lines(rows, min_docs, first_stays=False):
    """(id, lines, dropped, text) by counting keys over distinct (id, text)."""
    docs = {(i, t or "") for i, t, *_ in rows}
    holders = defaultdict(set)
    for d in docs:
        for line in d[1].split("\n"):
            if key := lower(line.strip(WHITE)):
                holders[key].add(d)
    gone = {k for k, v in holders.items() if len(v) >= min_docs}
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if lower(x.strip(WHITE)) not in gone]
        yield i, len(lines), len(lines) - len(kept), "\n".join(kept)


def test_line_dedup_against_brute_force(odd, odd_rows, docs):
    shared = "\n  The same PASSAGE\t\nonce more"
    rows = odd_rows + [(100 + i, (t or "") + (shared if i % 3 else "") + ("\n" + shared if i % 7 == 0 else ""), s) for i, t, s in docs]
    for min_docs in (2, 10):
        got = linededup.apply(odd(rows), linededup.bitmaps(odd(rows), min_docs=min_docs)).collect()
        assert Counter((r.record.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got) == Counter(brute_lines(rows, min_docs))


def test_first_occurrences_stay(odd):
    rows = [(i, f"own {i}\nshared\nshared\n{'x' * i}", "s") for i in range(30)] + [(3, "own 3\nshared\nshared\nxxx", "s"), (99, None, "s")]
    got = linededup.without_repeats(odd(rows), min_docs=10, first_stays=True).collect()
    assert sum((r.text or "").split("\n").count("shared") for r in got if r.doc_id != 3) + max(
        (r.text or "").split("\n").count("shared") for r in got if r.doc_id == 3
    ) == 1
    assert len(got) == len(rows) and {r.text for r in got if r.doc_id == 99} == {None}
    assert all(f"own {r.doc_id}" in r.text for r in got if r.doc_id != 99)
    assert linededup.without_repeats(odd([])).collect() == []


# --- toxicity ----------------------------------------------------------------------------


def test_marginals_equal_plain_forward_backward(monkeypatch):
    rng = np.random.default_rng(0)
    state, move, start = rng.normal(size=(toxicity.N_CLASSES, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    lengths = np.array([1, 5, 700, 3, 2, 1000])
    obs = rng.integers(0, toxicity.N_CLASSES, size=lengths.sum())

    def plain(o):
        emit, trans = np.exp(state[o]), np.exp(move)
        a, b = [np.exp(start) * emit[0]], [np.ones(2)]
        for i in range(1, len(o)):
            x = (a[-1] @ trans) * emit[i]
            a.append(x / x.sum())
        for i in range(len(o) - 2, -1, -1):
            x = trans @ (emit[i + 1] * b[-1])
            b.append(x / x.sum())
        p = np.array(a) * np.array(b[::-1])
        return p[:, 1] / p.sum(axis=1)

    want = np.concatenate([plain(o) for o in np.split(obs, np.cumsum(lengths)[:-1])])
    for slab in (1 << 17, 100, 7):
        monkeypatch.setattr(toxicity, "SLAB", slab)
        assert toxicity.marginals(obs, lengths, state, move, start) == pytest.approx(want, abs=1e-9)
    assert len(toxicity.marginals(obs[:0], lengths[:0], state, move, start)) == 0


def test_chain_learns_its_labels():
    rng = np.random.default_rng(1)
    labels = [(rng.random(60) < 0.1).astype(int) for _ in range(50)]
    obs = [np.where(rng.random(60) < 0.95, y * 6, (1 - y) * 6) for y in labels]
    state, move, start = toxicity.fit_chain(obs, labels)
    p = toxicity.marginals(np.concatenate(obs), np.array([60] * 50), state, move, start)
    assert ((p > 0.5) == np.concatenate(labels)).mean() > 0.93


@pytest.fixture(scope="module")
def scored(spark):
    """Scores of the next larger test tables, where enough rows are labelled."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.train(docs, labels)
    rows = toxicity.score(docs, model).join(labels.withColumnRenamed("doc_id", "id"), "id", "left")
    return model, rows.join(docs.select(F.col("doc_id").alias("id"), "text"), "id").toPandas()


def test_held_out_documents_are_told_apart(scored):
    rows = scored[1]
    rows["held"] = [zlib.crc32(str(i).encode()) % toxicity.FOLDS == toxicity.HELD_OUT for i in rows.id]
    held = rows[rows.held & rows.toxic.notna()]
    flagged, toxic = held.score >= toxicity.CUT_AT, held.toxic == 1
    assert (flagged & toxic).sum() / toxic.sum() > 0.9 and (flagged & toxic).sum() / flagged.sum() > 0.9
    assert rows.score.between(0, 1).all() and (flagged == toxic).mean() > 0.97


def test_offending_offsets_are_words_of_the_lexicon(scored):
    model, rows = scored
    spans = [(t, s) for t, s in zip(rows.text, rows.spans, strict=True) if s]
    assert spans
    for text, found in spans[:200]:
        for span in found.split(","):
            a, b = map(int, span.split(":"))
            assert any(f in model.lexicon for w in toxicity.tokens(text[a:b]) for f in toxicity.features(w))


def test_toxicity_of_odd_rows(odd, odd_rows, scored):
    model = scored[0]
    got = toxicity.score(odd(odd_rows), model).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score < toxicity.CUT_AT for r in got)
    bad = odd([*odd_rows, (50, "you IDIOT, you pathetic moron, stupid clown. " * 5, "s"), (51, "İİ idiot idiot idiot", "s")])
    rows = {r.id: r for r in toxicity.score(bad, model).collect()}
    assert rows[50].score >= toxicity.CUT_AT and rows[50].spans.startswith("4:9")
    assert rows[51].spans == "3:20"
    kept = toxicity.keep_clean(bad, model)
    assert kept.columns == bad.columns and kept.filter("doc_id = 50").count() == 0 and kept.filter("doc_id IN (1, 2, 3, 6)").count() == 4
    assert toxicity.score(odd([]), model).collect() == [] and toxicity.keep_clean(odd([]), model).collect() == []


def test_training_without_labels_gives_the_prior(spark, odd, odd_rows):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(odd(odd_rows), none)
    assert {round(r.score, 6) for r in toxicity.score(odd(odd_rows), model).collect()} == {0.5}


# --- pipeline ----------------------------------------------------------------------------


def test_stages_on_odd_rows(spark, sf, odd_rows, tmp_path):
    import corpus_pipeline

    columns = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, "en", s, None) for i, t, s in odd_rows], columns)
    empty = docs.limit(0)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        assert stage(spark, empty, sf).count() == 0
        if name == "packing":
            assert set(out.columns) >= {"doc_id", "start", "length", "sequence_id", "offset"}
        else:
            assert out.dtypes == docs.dtypes
            out.write.parquet(f"{tmp_path}/{k}")
            docs = spark.read.parquet(f"{tmp_path}/{k}")
            assert docs.count() > 0


def test_texts_hash_alike_everywhere(spark):
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.lit("").cast("binary"), 256)).first()[0]
