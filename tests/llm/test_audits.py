"""Language identification, conversation repair and the divergence audit against plain Python and DuckDB."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from seriesloom.llm import divergence, langid, repair

# --- language identification -------------------------------------------------------------


def plain_grams(text):
    """n-grams of all lengths by plain slicing."""
    words = re.split(" +", "".join(langid_fold(c) for c in " " + text + " "))
    line = " ".join(words)
    out = Counter()
    for n in langid.LENGTHS:
        for i in range(len(line) - n + 1):
            g = line[i : i + n]
            if " " not in (g[1:-1] if n > 2 else "") and g.strip() and not (n == 1 and g == " "):
                out[g] += 1
    return out


def langid_fold(c):
    return (c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " "


@pytest.mark.parametrize("slab", [7, 1 << 18])
def test_ngrams_are_those_of_plain_slicing(monkeypatch, slab):
    monkeypatch.setattr(langid, "SLAB", slab)
    texts = ["One, two  three!", "", "Éa ÉA 12 x", "   ", "a", "İstanbul straße\n\nçok"]
    sizes, kinds = Counter(), [set() for _ in texts]
    for h, own in langid.grams(*langid.folded(texts)):
        sizes.update(own.tolist())
        for x, o in zip(h.tolist(), own.tolist(), strict=True):
            kinds[o].add(x)
    for i, t in enumerate(texts):
        want = plain_grams(t)
        assert sizes[i] == sum(want.values()) and len(kinds[i]) == len(want)


def test_filters_hold_all_their_ngrams_of_many_languages():
    langs = [f"l{i}" for i in range(11)]
    words = {name: f"{name}word" + "abcdefghijk"[i] * 5 for i, name in enumerate(langs)}
    slices = np.zeros((2, langid.SLOTS), dtype=np.uint8)
    for i, name in enumerate(langs):
        for h, _ in langid.grams(*langid.folded([words[name]])):
            for p in langid.positions(h):
                slices[i // 8, p] |= np.uint8(1 << i % 8)
    filters = langid.Filters(langs, slices)
    n, hits = filters.counts([words[name] for name in langs])
    assert (np.diag(hits) == n).all() and (hits <= n[:, None]).all()
    names, scores = filters.decide([words[name] for name in langs])
    assert names == langs and (scores <= 1).all()


@pytest.fixture(scope="session")
def filters(spark, sf):
    return langid.train(spark.read.parquet(f"{sf}/documents.parquet"))


def test_languages_of_held_out_documents(spark, sf, filters):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in langid.op11_language_id(spark, sf).collect()}
    want = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert got.keys() == want.keys()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 for i, r in got.items())
    held = [i for i, r in got.items() if r.held_out]
    assert sum(got[i].lang_pred == want[i] for i in held) >= 0.97 * len(held)
    # Labels of held-out rows and other columns play no part.
    changed = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 'xx' ELSE lang END AS lang", "'s' AS source")
    again = langid.train(changed)
    assert again.langs == filters.langs and (again.slices == filters.slices).all()


def test_languages_of_odd_rows(odd, odd_rows, filters):
    rows = odd_rows + [(20, "12 34 !?", "a"), (21, "漢字", None)]
    got = langid.identify(odd(rows), filters).collect()
    assert Counter(r.id for r in got) == Counter(i for i, *_ in rows)
    text = {i: t for i, t, _ in rows}
    for r in got:
        letters = any(c.isalpha() for c in text[r.id] or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
    assert langid.identify(odd([]), filters).collect() == []
    untaught = langid.train(odd([(1, None, "a")]))
    assert untaught.langs == [] and {r.lang_pred for r in langid.identify(odd(rows), untaught).collect()} == {"und"}


# --- conversation repair -----------------------------------------------------------------


def plain_cheapest(rows):
    """Least (cost, audit) by a search over whole audits, without bounds: rows are (initial, must go, truncated)."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    fill = {"": "u", "s": "u", "u": "a", "a": "u"}
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit
        heapq.heappush(heap, (cost + 3, audit + "I", i, fill[state]))
        if i < len(rows):
            initial, gone, truncated = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state))
            if not gone:
                heapq.heappush(heap, (cost + 3 + 3 * truncated, audit + "R", i + 1, fill[state]))
                if (state, initial) in step:
                    heapq.heappush(heap, (cost + 3 * truncated, audit + "K", i + 1, step[state, initial]))


def plain_repair(rows):
    """gaps .. repaired_sha256 of (turn, role, text) rows."""
    text = lambda c: " " if c is None else c
    rows = sorted(((t is not None, t or 0, text(r).encode(), text(x).encode()) for t, r, x in rows))
    turns = [t for known, t, *_ in rows if known]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults, kinds = set(), Counter(), []
    rows = [(r.decode(), x.decode()) for _, _, r, x in rows]
    for r, x in rows:
        body = x.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (r, x) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((r, x))
        faults[fault] += 1
        kinds.append((r[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(rows, rows[1:], strict=False))
    cost, audit = plain_cheapest(kinds)
    out, left = [], list(rows)
    for edit in audit:
        role, x = ("", "") if edit == "I" else left.pop(0)
        if edit != "D":
            expected = "assistant" if out and out[-1][0] == "u" else "user"
            out.append(f"{role if edit == 'K' else expected}:{x}")
    return gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def test_branch_and_bound_finds_the_cheapest_first_audit():
    draw = random.Random(7)
    for size in [*range(6), 9, 14, 40] * 60:
        rows = [(draw.choice(["s", "u", "a", "u", "a", "t", ""]), draw.random() < 0.15, draw.random() < 0.2) for _ in range(size)]
        assert repair.cheapest(bytes(repair.digit(*r) for r in rows)) == plain_cheapest(rows)


def test_search_grows_with_the_rows_only():
    rows = bytes(random.Random(3).choice([0, 1, 1, 2, 2, 3, 5, 6, 8]) for _ in range(20_000))
    cost, audit = repair.cheapest(rows)
    assert len(audit) - audit.count("I") == 20_000 and cost > 0


def test_damaged_conversations_against_plain_python(spark, sf):
    given = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        kind = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        x = "" if kind == 1 else re.sub("[.!?]", "", r.text) if kind == 2 else r.text
        given[r.conv_id] += [(r.turn, "user" if kind == 4 else r.role, x)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    got = {r.conv_id: tuple(r)[1:] for r in repair.op12_conversation_repair(spark, sf).collect()}
    assert got == {i: plain_repair(rows) for i, rows in given.items()}


@pytest.mark.parametrize("held_chars", [repair.HELD_CHARS, 3])
def test_repair_of_odd_rows(spark, held_chars):
    """Nulls everywhere, ties, repeated rows, other roles, long texts, clashing columns; texts held and streamed."""
    rows = [
        (None, 1, "user", "No id."), (None, None, "assistant", "Yes."), (1, 2, "user", None), (1, 2**60 + 1, None, "x."), (1, 2**60, "system", "Be."),
        (2, None, None, None), (3, 0, "user", "Hi."), (3, 0, "user", "Hi."), (3, 0, "assistant", "é" * 100_000), (3, 5, "tool", "?"), (3, 6, "", "b."),
        (4, 0, "system", "Only."), (5, 0, "user", " \t\n"), (6, -3, "assistant", "a!\x0b"), (6, -1, "user", " "), (7, 1, "user", "Same."), (7, 2, "user", "Same."),
    ]
    schema = "conv_id long, turn long, role string, text string, key string, part string, audit string, cost string"
    frame = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], schema)
    want = defaultdict(list)
    for i, *r in rows:
        want[i].append(r)
    assert {r.conv_id: tuple(r)[1:] for r in repair.repair(frame, held_chars=held_chars).collect()} == {i: plain_repair(r) for i, r in want.items()}
    assert repair.repair(frame.limit(0)).collect() == []


def test_conversations_that_lose_all_rows_stay(spark, tmp_path):
    turn = next(t for t in range(1000) if zlib.crc32(f" :{t}".encode()) % 20 == 0)
    frame = spark.createDataFrame([(None, turn, "user", "Gone.", 1)], "conv_id long, turn long, role string, text string, cost int")
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in repair.op12_conversation_repair(spark, str(tmp_path)).collect()] == [(None, 0, 0, 0, 0, 0, 0, "", empty)]


# --- divergence audit --------------------------------------------------------------------


def plain_audit(rows, min_docs, top):
    """(lang, source, part, item, value, rank) of (lang, source, text) rows."""
    docs, count, groups = defaultdict(set), defaultdict(Counter), defaultdict(set)
    for k, (lang, source, text) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        for term in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")):
            docs[lang, term].add(k)
            count[lang, source][term] += 1
    out = set()
    for lang, sources in groups.items():
        kept = sorted(t for (own, t), d in docs.items() if own == lang and len(d) >= min_docs)
        share = {}
        for s in sources:
            total = sum(count[lang, s][t] for t in kept)
            share[s] = {t: 1 + 10**9 * (count[lang, s][t] + 1) // (total + len(kept)) for t in kept}
        both = {t: sum(count[lang, s][t] for s in sources) for t in kept}
        whole = {t: 1 + 10**9 * (both[t] + 1) // (sum(both.values()) + len(kept)) for t in kept}
        f = lambda p, q: (p - q) * (p - q) // q
        for s in sources:
            pairs = [(-sum(f(share[s][t], share[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(-f(share[s][t], whole[t]), t.encode()) for t in kept if count[lang, s][t] and share[s][t] > whole[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, i.decode(), -v, k + 1) for k, (v, i) in enumerate(found)}
    return out


@pytest.mark.parametrize(("min_docs", "top", "block"), [(3, 200, 1 << 21), (2, 5, 64), (1, 3, 64)])
def test_divergence_against_plain_python(monkeypatch, odd, odd_rows, docs, min_docs, top, block):
    monkeypatch.setattr(divergence, "BLOCK", block)
    rows = [(i, t, s) for i, t, s in docs[:60]] + odd_rows + [(500, "a\x1cb c Éa's x_y", "z"), (501, None, "without"), (502, "", None)]
    got = [tuple(r) for r in divergence.audit(odd(rows), min_docs, top).collect()]
    want = plain_audit([("en", s, t) for _, t, s in rows], min_docs, top)
    assert len(got) == len(want) and set(got) == want


def test_divergence_without_terms_and_rows(odd, spark):
    got = {tuple(r) for r in divergence.audit(odd([(1, None, "a"), (2, "", None)])).collect()}
    assert got == {("en", "a", "pair", "", 0, 1), ("en", "", "pair", "a", 0, 1)}
    assert divergence.audit(odd([])).collect() == []


@pytest.mark.parametrize(("slab", "held"), [(1 << 23, 1 << 20), (400, 200), (2000, 1)])
def test_sums_of_a_task_are_those_of_plain_counts(monkeypatch, docs, slab, held):
    """Whatever is passed on early: occurrences, documents, and who the one or two documents are."""
    monkeypatch.setattr(divergence, "SLAB", slab)
    monkeypatch.setattr(divergence, "HELD_ROWS", held)
    rows = [(i % 3, i % 5, (t or "").encode()) for i, t, s in docs[:50]] + [(1, 2, b"x y x \xe2\x80\x83 " * 300), (1, 2, b"")]
    columns = [pa.array([r[k] for r in rows]) for k in range(3)]
    batches = pa.table(dict(zip(("lang", "source", "text"), columns, strict=True))).to_batches(max_chunksize=7)
    got = defaultdict(lambda: [0, 0, set()])
    for batch in divergence.counted(iter(batches), 3):
        records, row = divergence._unpack(batch.column("groups"), divergence.OF_CHUNK)
        chunks = batch.column("chunk").to_pylist()
        for r, k in zip(records, row, strict=True):
            entry = got[r["lang"], r["source"], chunks[k]]
            entry[0] += r["n"]
            entry[1] += r["docs"]
            if r["docs"] < 3:
                entry[2] |= {r["low"], r["low"] + r["span"]}
    want = defaultdict(lambda: [0, 0, set()])
    for k, (lang, source, text) in enumerate(rows):
        for chunk, n in Counter(c for c in re.split(rb"[\x20\x09-\x0D]+", text) if c).items():
            entry = want[lang, source, chunk]
            entry[0] += n
            entry[1] += 1
            entry[2].add((3 << 40) + k)
    assert {k: v[:2] for k, v in got.items()} == {k: v[:2] for k, v in want.items()}
    assert all(got[k][2] == v[2] for k, v in want.items() if v[1] < 3)


def test_chunks_of_long_texts_are_whole(monkeypatch):
    monkeypatch.setattr(divergence, "SLAB", 16)
    text = "a bb\tccc " + "x" * 50 + "\n" + "é é a \u2003 \x1c " * 9
    want = Counter(c.encode() for c in re.split(r"[\x20\x09-\x0D]+", text) if c)
    assert divergence.chunk_counts(text.encode()) == want


def test_divergence_query_against_sql(spark, sf):
    got = {tuple(r) for r in divergence.op13_source_divergence(spark, sf).collect()}
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert got == set(db.execute(divergence.OP13_SQL).fetchall())
