"""Repair of conversation structure by depth-first branch and bound.

A repaired conversation has no blank and no repeated rows and its role initials read `(s?(ua)+)?`. Rows are kept, given
another role, deleted, or rows are inserted; the cheapest edits win, and of equally cheap ones those whose initials
come first in ASCII order.

Conversations are dealt by their id, sorted by turn and streamed. A task holds the texts of one conversation up to a
bound; beyond it, only one digit a row, and a second pass over just those conversations streams their texts through the hash.
The search visits audits in ASCII order from an explicit stack. Suffix lower bounds (the cheapest repair of the
remaining rows on their own, entered in whichever state suits them) end branches that can't beat the incumbent; a table
of the least cost at which (row, state) was met ends branches that an earlier prefix dominates. The bounds are at most
two insertions below the truth, so each row is met a bounded number of times however long the conversation is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, table

# Fixed values of the contract.
REROLE, DELETE, INSERT, UNTIDY = 3, 4, 3, 3
NAMES = {"u": "user", "a": "assistant"}
STRIPPED = " \t\n\x0b\x0c\r"

#: States of the pattern by what was emitted last, and the state after each initial.
START, SYSTEM, USER, ASSISTANT = range(4)
STEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The initial that may be inserted or given, and the state after it.
FILL = (("u", USER), ("u", USER), ("a", ASSISTANT), ("u", USER))
ACCEPTED = (START, ASSISTANT)
NEVER = 1 << 60
#: No repair is dearer than the bound of its suffix by more: two insertions reach every state.
SLACK = 2 * INSERT

#: Rows as digits: initial (s, u, a, other) + 4 where truncated; GONE where the row must go.
INITIALS = "sua"
GONE = 8

#: Text of one conversation that a task holds before it falls back to digits, in characters.
HELD_CHARS = 32 << 20

RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def digit(role: str, must_go: bool, untidy: bool) -> int:
    return GONE if must_go else (INITIALS.find(role[0]) if role and role[0] in INITIALS else 3) + 4 * untidy


def suffix_bounds(rows: bytes) -> list[int]:
    """Per row the least cost of it and all later rows, whatever state they are entered in."""
    after = [0 if s in ACCEPTED else NEVER for s in range(4)]
    bounds = [0] * (len(rows) + 1)

    def insertions(costs: list[int]) -> None:
        for _ in range(2):
            for s in range(4):
                costs[s] = min(costs[s], INSERT + costs[FILL[s][1]])

    insertions(after)
    for i in range(len(rows) - 1, -1, -1):
        row, now = rows[i], []
        for s in range(4):
            best = DELETE + after[s]
            if row != GONE:
                extra = UNTIDY if row >= 4 else 0
                best = min(best, extra + REROLE + after[FILL[s][1]])
                kept = STEP[s].get(INITIALS[row % 4]) if row % 4 < 3 else None
                if kept is not None:
                    best = min(best, extra + after[kept])
            now.append(best)
        insertions(now)
        bounds[i], after = min(now), now
    return bounds


def cheapest(rows: bytes) -> tuple[int, str]:
    """Cost and audit of the cheapest edits; of several the audit that is least in ASCII order.

    >>> cheapest(bytes([digit("user", False, False), digit("assistant", False, False)]))
    (0, 'KK')
    """
    n, bounds = len(rows), suffix_bounds(rows)
    best, audit = bounds[0] + SLACK + 1, None
    met = [NEVER] * (4 * (n + 1))
    path = bytearray()
    stack = [(0, START, 0, 0, 0)]
    while stack:
        i, state, cost, depth, edit = stack.pop()
        if depth:
            del path[depth - 1 :]
            path.append(edit)
        # Audits come in ASCII order, so an equal cost later on is never better.
        if cost + bounds[i] >= best or cost >= met[4 * i + state]:
            continue
        met[4 * i + state] = cost
        if i == n and state in ACCEPTED:
            best, audit = cost, path.decode("ascii")
            continue
        # Pushed in reverse: D, I, K, R are popped in this order.
        below, (initial, filled) = depth + 1, FILL[state]
        if i < n and rows[i] != GONE:
            row = rows[i]
            extra = UNTIDY if row >= 4 else 0
            own = INITIALS[row % 4] if row % 4 < 3 else ""
            if own != initial:
                stack.append((i + 1, filled, cost + REROLE + extra, below, 82))
            if own in STEP[state]:
                stack.append((i + 1, STEP[state][own], cost + extra, below, 75))
        stack.append((i, filled, cost + INSERT, below, 73))
        if i < n:
            stack.append((i + 1, state, cost + DELETE, below, 68))
    return best, audit


class Lines:
    """Streams repaired `role:text` lines into a hash; edits come from the audit, rows as they arrive."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.sha, self.first = audit, 0, START, hashlib.sha256(), True

    def _emit(self, initial: str, role: str, text: str) -> None:
        self.sha.update((("" if self.first else "\n") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.first, self.state = False, STEP[self.state][initial]

    def _insertions(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._emit(FILL[self.state][0], NAMES[FILL[self.state][0]], "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._insertions()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._emit(role[0], role, text)
        elif edit == "R":
            self._emit(FILL[self.state][0], NAMES[FILL[self.state][0]], text)

    def digest(self) -> str:
        self._insertions()
        return self.sha.hexdigest()


class Conversation:
    """Faults and digits of the rows of one conversation, in order."""

    def __init__(self, key, held_chars: int):
        self.key, self.held_chars = key, held_chars
        self.rows, self.seen = bytearray(), set()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = None
        self.turns, self.chars, self.last = 0, 0, None
        self.texts: list[tuple[str, str]] | None = []

    def add(self, turn, role: str, text: str) -> None:
        if turn is not None and turn != self.high:  # turns arrive in order
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        if self.last is not None:
            self.illegal += (self.last + role[:1]) not in ("su", "ua", "au")
        self.last = role[:1]
        body = text.rstrip(STRIPPED)
        same = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        blank, duplicate = not body, same in self.seen
        self.seen.add(same)
        truncated = not blank and not duplicate and body[-1] not in ".!?"
        self.blank += blank
        self.duplicate += duplicate and not blank
        self.truncated += truncated
        self.rows.append(digit(role, blank or duplicate, truncated))
        if self.texts is not None:
            self.chars += len(role) + len(text)
            self.texts.append((role, text))
            if self.chars > self.held_chars:
                self.texts = None

    def result(self) -> tuple:
        cost, audit = cheapest(bytes(self.rows))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        sha = None
        if self.texts is not None:
            lines = Lines(audit)
            for role, text in self.texts:
                lines.row(role, text)
            sha = lines.digest()
        return self.key, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, sha


def _solve(held_chars: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in ["key k", *RESULT.split(", ")]]
        now, done = None, []
        for batch in batches:
            for key, turn, no_turn, role, text in zip(*(batch[c] for c in ("key", "turn", "no_turn", "role", "text")), strict=True):
                if now is None or now.key != key:
                    if now is not None:
                        done.append(now.result())
                    now = Conversation(key, held_chars)
                now.add(None if no_turn else int(turn), role, text)
            if done:
                yield pd.DataFrame(done, columns=names)
                done = []
        if now is not None:
            yield pd.DataFrame([now.result()], columns=names)

    return run


def _hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of a conversation after the row that carries its audit."""
    key, lines = None, None
    for batch in batches:
        done = []
        for own, audit, role, text in zip(batch["key"], batch["audit"], batch["role"], batch["text"], strict=True):
            if own != key:
                if lines is not None:
                    done.append((key, lines.digest()))
                key, lines = own, Lines(audit)
            else:
                lines.row(role, text)
        if done:
            yield pd.DataFrame(done, columns=["key", "sha"])
    if lines is not None:
        yield pd.DataFrame([(key, lines.digest())], columns=["key", "sha"])


def name_of(conv: Column) -> Column:
    """A string that stands for an id, null included."""
    return F.when(conv.isNull(), F.lit("n")).otherwise(F.concat(F.lit("="), conv.cast("string")))


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", held_chars: int = HELD_CHARS) -> DataFrame:
    """Faults, cheapest edits and the hash of the repaired text: one row per id of df.

    Rows go by turn (nulls first), those of one turn by role and text. Null roles and texts count as one space, which makes
    such a text blank; all rows without an id are one conversation. Only a row's first fault counts: blank, repeated (role and
    text as in an earlier row), truncated. Any id, a conversation of one row included, gets a row; no rows give no rows.
    Further columns are ignored. `audit` has K, R, D, I for keep, rerole, delete, insert.
    """
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    own_turn = (F.coalesce(F.col(turn).cast("long"), F.lit(0)).alias("turn"), F.col(turn).isNull().alias("no_turn"))
    rows = df.select(name_of(F.col(conv)).alias("key"), *own_turn, plain(role).alias("role"), plain(text).alias("text"))
    in_order = (F.desc("no_turn"), "turn", "role", "text")
    dealt = rows.repartition("key").sortWithinPartitions("key", *in_order)
    found = cut(dealt.mapInPandas(_solve(held_chars), f"key string, {RESULT}"), "repair")
    long = found.filter(F.col("repaired_sha256").isNull()).select("key", "audit")
    if not long.isEmpty():
        texts = rows.join(long.select("key"), "key", "left_semi").withColumn("part", F.lit(1))
        both = texts.unionByName(long.withColumn("part", F.lit(0)), allowMissingColumns=True)
        streamed = both.repartition("key").sortWithinPartitions("key", "part", *in_order)
        hashed = streamed.select("key", "audit", "role", "text").mapInPandas(_hashes, "key string, sha string")
        found = found.join(hashed, "key", "left").withColumn("repaired_sha256", F.coalesce("repaired_sha256", "sha")).drop("sha")
    own = F.when(F.col("key") != "n", F.substring("key", 2, 2**31 - 1)).cast(df.schema[conv].dataType)
    return found.select(own.alias(conv), *[c.split()[0] for c in RESULT.split(", ")])


def damage(df: DataFrame) -> DataFrame:
    """Rows of conversations with the faults that crc32 of `conv_id:turn` chooses: 0 drops a row, 1 empties its text,
    2 takes its full stops, 3 repeats it, 4 makes it the user's. Nulls count as one space in texts and in the chosen number."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    rows = df.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), fault.alias("fault")).filter("fault != 0")
    text = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies)).drop("col")


def op12_conversation_repair(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    ids = rows.select("conv_id").distinct()
    found = repair(damage(rows)).withColumnRenamed("conv_id", "_id")
    zero = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    empty = {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256))}
    return ids.join(found, F.col("conv_id").eqNullSafe(F.col("_id")), "left").drop("_id").withColumns({**zero, **empty})
