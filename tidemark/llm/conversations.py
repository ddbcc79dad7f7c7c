"""Conversation structure repair by alignment with an alternating grammar.

A conversation is sound when its role initials read ``(s?(ua)+)?``.  Its
turns are aligned with each feasible length of that string (Wagner-Fischer:
keep, rerole, delete, insert), within Ukkonen bands that the cheapest cost
found so far sets, and the backtraced audits of the cheapest lengths are
compared.  Costs of suffixes are kept by the number of target positions
left, so that one matrix holds every length of one ending.

1. Built-in functions judge each turn by itself; repeated (role, text)
   pairs come from one pre-aggregated minimum per pair, joined back.
2. Turns without their texts (a code of one byte each) are shuffled by
   conversation, sorted and streamed; a conversation's codes are aligned in
   blocks of ``BLOCK`` turns, whose audits are composed by phase.
3. Turns with texts are shuffled once, behind the audit of their
   conversation, and hashed as they stream by.

Scale: a task never holds a conversation's texts; it holds one byte a turn,
as many as the letters of the audit that is its result.  A conversation's
hash is one sequential SHA-256, so its turns pass through one task.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Lookup, Scratch, shuffle_partitions

#: Costs of the edits; a truncated turn that stays adds one.
KEEP, REROLE, INSERT, DELETE, TRUNCATED = 0, 2, 2, 3, 1
#: Codes of a turn: its role's initial, and its fault.
SYSTEM, USER, ASSISTANT, OTHER = 0, 1, 2, 3
BLANK_CODE, DUPLICATE_CODE, TRUNCATED_CODE = 4, 8, 16
#: Turns that are aligned at once.
BLOCK = 1024
#: Phases between turns: nothing yet, behind s, behind u, behind a.
START, AFTER_S, AFTER_U, AFTER_A = 0, 1, 2, 3
_FAR = 1 << 28
_WHITE = "\t\n\x0b\x0c\r "


class Suffixes(NamedTuple):
    """``cost[i, k]``: cheapest alignment of the turns from ``i`` with the
    last ``free[i] - half + k`` positions of an alternating string that ends
    in ``end``; ``free[i]``: turns from ``i`` that need not be deleted."""
    cost: np.ndarray
    free: np.ndarray
    half: int
    end: int

    def at(self, i: int, left: int) -> int:
        k = left - int(self.free[i]) + self.half
        return int(self.cost[i, k]) if left >= 0 and 0 <= k < self.cost.shape[1] else _FAR


def _symbol(left: int, end: int) -> int:
    """Initial at the position with ``left`` positions to go, itself included."""
    return end if left % 2 else USER + ASSISTANT - end


def suffix_costs(codes: np.ndarray, end: int, half: int) -> Suffixes:
    """Wagner-Fischer from the last turn back, within a band of ``half``."""
    n, width = len(codes), 2 * half + 1
    initial, must_go = codes & 3, (codes & (BLANK_CODE | DUPLICATE_CODE)) != 0
    free = np.concatenate([np.cumsum(~must_go[::-1])[::-1], [0]]).astype(np.int64)
    k = np.arange(width)
    cost = np.full((n + 1, width), _FAR, np.int64)
    left = k - half
    cost[n] = np.where(left >= 0, INSERT * left, _FAR)
    for i in range(n - 1, -1, -1):
        left = free[i] - half + k
        below = cost[i + 1]
        if must_go[i]:
            best = below + DELETE
        else:
            best = np.append(below[1:], _FAR) + DELETE
            stay = below + np.where(np.where(left % 2, end, USER + ASSISTANT - end) == initial[i], KEEP, REROLE)
            stay = stay + (TRUNCATED if codes[i] & TRUNCATED_CODE else 0)
            best = np.where(left >= 1, np.minimum(best, stay), best)
        best = np.where(left >= 0, best, _FAR)
        # insertions: the cheapest shorter suffix and as many as are missing
        best = np.minimum.accumulate(best - INSERT * k) + INSERT * k
        cost[i] = np.where(left >= 0, np.minimum(best, _FAR), _FAR)
    return Suffixes(cost, free, half, end)


def audit_of(codes: np.ndarray, s: Suffixes, i: int, left: int) -> str:
    """ASCII-least audit (D, I, K, R) of the cheapest alignments from turn
    ``i`` with ``left`` positions."""
    out, n = [], len(codes)
    while i < n or left:
        now = s.at(i, left)
        if i < n and s.at(i + 1, left) + DELETE == now:
            out.append("D")
            i += 1
        elif left and s.at(i, left - 1) + INSERT == now:
            out.append("I")
            left -= 1
        else:
            same = _symbol(left, s.end) == int(codes[i]) & 3
            out.append("K" if same else "R")
            i, left = i + 1, left - 1
    return "".join(out)


def _choices(codes: np.ndarray, s: Suffixes, first: int, least: int):
    """(cost, turn, positions) of alignments without s, of every feasible
    length in the band that starts with ``first``."""
    base = int(s.free[0]) - s.half
    for k in range(s.cost.shape[1]):
        left = base + k
        if left >= least and s.cost[0, k] < _FAR and (left == 0 or _symbol(left, s.end) == first):
            if left or first != s.end:
                yield int(s.cost[0, k]), 0, left


def _choices_after_s(codes: np.ndarray, s: Suffixes):
    """The same, for those that keep a turn as s and delete all before it."""
    for i in np.flatnonzero((codes & (3 | BLANK_CODE | DUPLICATE_CODE)) == SYSTEM).tolist():
        spent = DELETE * i + (TRUNCATED if codes[i] & TRUNCATED_CODE else 0)
        base = int(s.free[i + 1]) - s.half
        for k in range(s.cost.shape[1]):
            left = base + k
            if left >= 1 and s.cost[i + 1, k] < _FAR and _symbol(left, s.end) == USER:
                yield spent + int(s.cost[i + 1, k]), i + 1, left


def _cheapest(codes: np.ndarray, s: Suffixes, choices) -> tuple[int, str] | None:
    """Least (cost, audit): the audits of all cheapest choices are compared."""
    choices = list(choices)
    if not choices:
        return None
    least = min(c for c, _, _ in choices)
    audits = (("D" * (i - 1) + "K" if i else "") + audit_of(codes, s, i, left)
              for c, i, left in choices if c == least)
    return least, min(audits)


def align_block(codes: np.ndarray, entries, exits) -> dict[tuple[int, int], tuple[int, str]]:
    """(entry phase, exit phase) -> least (cost, audit) of the turns between."""
    n = len(codes)
    must_go = (codes & (BLANK_CODE | DUPLICATE_CODE)) != 0
    truncated = (codes & TRUNCATED_CODE) != 0
    # what any repair costs: forced deletions, truncated turns that stay
    base = DELETE * int(must_go.sum()) + int((truncated & ~must_go).sum())
    out: dict[tuple[int, int], tuple[int, str]] = {}
    for p in entries:
        if p in (START, AFTER_S) and p in exits:
            out[p, p] = DELETE * n, "D" * n
    if START in entries and AFTER_S in exits:
        kept = [(DELETE * (n - 1) + int(truncated[i]), "D" * i + "K" + "D" * (n - 1 - i))
                for i in np.flatnonzero((codes & 3 == SYSTEM) & ~must_go).tolist()]
        if kept:
            out[START, AFTER_S] = min(kept)
    for q, end in ((AFTER_U, USER), (AFTER_A, ASSISTANT)):
        if q not in exits:
            continue
        half = 2
        while True:
            s, found = suffix_costs(codes, end, half), {}
            for p in entries:
                first = ASSISTANT if p == AFTER_U else USER
                best = _cheapest(codes, s, _choices(codes, s, first, 0 if p == q else 1))
                if p == START:
                    other = _cheapest(codes, s, _choices_after_s(codes, s))
                    best = min((x for x in (best, other) if x), default=None)
                found[p, q] = best
            if all(found.values()):
                # the incumbents' band: every edit off the diagonal costs two
                needed = max(0, max(c for c, _ in found.values()) - base) // 2
                if needed <= half:
                    break
                half = needed
            else:
                half *= 2
        out.update(found)
    return out


def align(codes: bytes, block: int = BLOCK) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair, ties to the ASCII-least audit.

    Of equally dear audits of the same turns none starts another, so least
    audits of consecutive blocks compose to the least audit."""
    codes = np.frombuffer(codes, np.uint8).astype(np.int64)
    state: dict[int, tuple[int, str]] = {START: (0, "")}
    cuts = list(range(0, len(codes), block)) or [0]
    for at in cuts:
        part = codes[at:at + block]
        last = at == cuts[-1]
        exits = {START, AFTER_A} if last else {START, AFTER_S, AFTER_U, AFTER_A}
        steps = align_block(part, set(state), exits)
        new: dict[int, tuple[int, str]] = {}
        for (p, q), (cost, audit) in steps.items():
            there = state[p][0] + cost, state[p][1] + audit
            if q not in new or there < new[q]:
                new[q] = there
        state = new
    return min(state.values())


# -- turns --------------------------------------------------------------------

_RESULT = ("conv long, gaps long, blank long, duplicate long, truncated long, illegal long, "
           "cost long, audit string")
_ILLEGAL = np.ones((4, 4), bool)
_ILLEGAL[SYSTEM, USER] = _ILLEGAL[USER, ASSISTANT] = _ILLEGAL[ASSISTANT, USER] = False


class _Conversation:
    """Running figures of the conversation that streams by."""

    def __init__(self, key):
        self.key, self.codes, self.last = key, [], None
        self.low = self.high = self.turn = None
        self.distinct = self.illegal = 0

    def add(self, codes: np.ndarray, turns: np.ndarray) -> None:
        if len(codes):
            initial = codes & 3
            pairs = initial if self.last is None else np.concatenate([[self.last], initial])
            self.illegal += int(_ILLEGAL[pairs[:-1], pairs[1:]].sum())
            self.last = int(initial[-1])
            self.codes.append(codes.astype(np.uint8).tobytes())
        if len(turns):
            self.distinct += int((turns[1:] != turns[:-1]).sum()) + (self.turn != turns[0])
            self.low = int(turns[0]) if self.low is None else self.low
            self.turn = self.high = int(turns[-1])

    def row(self, aligned) -> tuple:
        codes = b"".join(self.codes)
        n = np.bincount(np.frombuffer(codes, np.uint8), minlength=32)
        kinds = np.arange(len(n))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        cost, audit = aligned[codes]
        return (self.key, min(gaps, 2 ** 63 - 1),
                *(int(n[kinds & c != 0].sum()) for c in (BLANK_CODE, DUPLICATE_CODE, TRUNCATED_CODE)),
                self.illegal, cost, audit)


def _runs(column: pa.Array):
    """(value, start, end) of runs of equal values of a sorted column."""
    n = len(column)
    known = column.is_valid().to_numpy(zero_copy_only=False)
    values = pa.compute.fill_null(column, 0).to_numpy()
    new = np.flatnonzero((values[1:] != values[:-1]) | (known[1:] != known[:-1])) + 1
    for a, b in zip([0, *new.tolist()], [*new.tolist(), n]):
        yield (int(values[a]) if known[a] else None), a, b


def _audit(block: int):
    """Sorted (conv, turn, lost, code) to a row per conversation."""
    schema = pa.schema([("conv", pa.int64()), *((c, pa.int64()) for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string())])

    def run(batches):
        aligned = Lookup(lambda codes: align(codes, block), 50_000)
        now, rows = None, []

        def emit():
            return pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            turn, lost, code = (batch.column(i) for i in (1, 2, 3))
            stay = ~lost.to_numpy(zero_copy_only=False)
            code = code.to_numpy(zero_copy_only=False).astype(np.int64)
            timed = stay & turn.is_valid().to_numpy(zero_copy_only=False)
            turn = pa.compute.fill_null(turn, 0).to_numpy()
            for key, a, b in _runs(batch.column(0)):
                if now is None or now.key != key:
                    if now is not None:
                        rows.append(now.row(aligned))
                        if len(rows) >= 1000 or len(rows[-1][-1]) > 1 << 20:
                            yield emit()
                            rows = []
                    now = _Conversation(key)
                now.add(code[a:b][stay[a:b]], turn[a:b][timed[a:b]])
        if now is not None:
            rows.append(now.row(aligned))
            yield emit()
    return run


class _Repaired:
    """Hash of a conversation's repaired turns as they stream by."""

    def __init__(self, audit: str):
        self._audit, self._at, self._first, self._wants = audit, 0, True, "user"
        self._sha = hashlib.sha256()

    def _line(self, role: str, text: str) -> None:
        if not self._first:
            self._sha.update(b"\n")
        self._first = False
        self._sha.update(f"{role}:".encode("utf-8", "surrogatepass"))
        self._sha.update(text.encode("utf-8", "surrogatepass"))
        self._wants = "assistant" if role[:1] == "u" else "user"

    def _insertions(self) -> None:
        while self._at < len(self._audit) and self._audit[self._at] == "I":
            self._at += 1
            self._line(self._wants, "")

    def turn(self, role: str, text: str) -> None:
        self._insertions()
        edit = self._audit[self._at]
        self._at += 1
        if edit != "D":
            self._line(role if edit == "K" else self._wants, text)

    def digest(self) -> str:
        self._insertions()
        return self._sha.hexdigest()


def _hash(batches):
    """Sorted (conv, behind, head, role, text) to the heads and their hashes."""
    now, heads, hashes, known = None, [], [], False

    def emit():
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays(heads), pa.array(hashes, pa.string())], ["head", "repaired_sha256"])

    for batch in batches:
        behind = batch.column(1).to_pylist()
        audits = batch.column(2).field(batch.schema.field("head").type.get_field_index("audit"))
        for at in range(0, batch.num_rows, 256):
            roles, texts = (batch.column(i).slice(at, 256).to_pylist() for i in (3, 4))
            for i, (role, text) in enumerate(zip(roles, texts), at):
                if not behind[i]:
                    if now is not None:
                        hashes.append(now.digest())
                        if len(heads) >= 1000:
                            yield emit()
                            heads, hashes = [], []
                    heads.append(pa.concat_arrays([batch.column(2).slice(i, 1)]))
                    now = _Repaired(audits[i].as_py())
                else:
                    now.turn(role, text)
    if now is not None:
        hashes.append(now.digest())
        yield emit()


def repair_conversations(turns: DataFrame, *, key: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text", lost: str | None = None,
                         block: int = BLOCK) -> DataFrame:
    """One row per ``key``: ``gaps`` (turn numbers missing between the least
    and the greatest), ``blank``, ``duplicate`` and ``truncated`` (turns by
    their first fault), ``illegal`` (adjacent role initials other than su,
    ua, au), ``cost`` and ``audit`` (of the cheapest repair) and
    ``repaired_sha256`` (of its ``role:text`` lines).

    Turns are ordered by ``turn``, nulls first, then by their place in the
    input.  Null roles and texts are one space; a null key is a
    conversation of its own.  Rows whose ``lost`` column is true only make
    their conversation known: without other rows it has zeros, an empty
    audit and the hash of the empty string.  Repeated rows are duplicates;
    turns with equal numbers count once in ``gaps``; other columns are not
    read; no rows give no rows.
    """
    scratch = Scratch(turns.sparkSession, "conversations")
    n = shuffle_partitions(turns.sparkSession)
    rows = turns.select(
        F.col(f"`{key}`").cast("bigint").alias("conv"), F.col(f"`{turn}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
        (F.coalesce(F.col(f"`{lost}`"), F.lit(False)) if lost else F.lit(False)).alias("lost"),
        F.monotonically_increasing_id().alias("rid"))
    end = F.rtrim(F.col("text"), F.lit(_WHITE))
    initial = F.substring("role", 1, 1)
    rows = scratch.keep(rows.select(
        "*", F.md5(F.concat_ws(":", F.coalesce(F.col("conv").cast("string"), F.lit("null")),
                               F.length("role").cast("string"), "role", "text")).alias("digest"),
        (F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT)
         .otherwise(OTHER)
         + F.when(end == "", BLANK_CODE).when(~F.right(end, F.lit(1)).isin(*".!?"), TRUNCATED_CODE)
         .otherwise(0)).cast("int").alias("code")), "turns")

    # the first of each (conversation, role, text) that occurs again
    place = F.struct("turn", "rid")
    again = scratch.keep(rows.where("NOT lost").groupBy("digest").agg(
        F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"),
        "again")
    judged = rows.drop("role", "text").join(again, "digest", "left").select(
        "conv", "turn", "rid", "lost",
        F.when((F.col("code").bitwiseAND(BLANK_CODE) == 0) & F.col("first").isNotNull()
               & (F.col("first.rid") != F.col("rid")),
               F.col("code").bitwiseAND(3) + DUPLICATE_CODE).otherwise(F.col("code")).alias("code"))
    audits = (judged.repartition(n, "conv").sortWithinPartitions("conv", "turn", "rid")
              .select("conv", "turn", "lost", "code").mapInArrow(_audit(block), _RESULT))
    audits = scratch.keep(audits, "audits")

    head = F.struct(*audits.columns)
    line = rows.where("NOT lost").select(
        "conv", F.lit(True).alias("behind"), "turn", "rid", "role", "text")
    stream = audits.select("conv", F.lit(False).alias("behind"), head.alias("head")).unionByName(
        line, allowMissingColumns=True)
    hashed = (stream.repartition(n, "conv").sortWithinPartitions("conv", "behind", "turn", "rid")
              .select("conv", "behind", "head", "role", "text")
              .mapInArrow(_hash, f"head struct<{_RESULT.replace(' ', ':').replace(',:', ',')}>, "
                                 "repaired_sha256 string"))
    return hashed.select(F.col("head.conv").alias(key),
                         *(f"head.{c}" for c in audits.columns[1:]), "repaired_sha256")


def damage(conversations: DataFrame, *, key: str = "conv_id", turn: str = "turn",
           role: str = "role", text: str = "text") -> DataFrame:
    """Turns with faults by the crc32 of ``key:turn`` modulo 20: 0 loses the
    turn (``lost``), 1 empties its text, 2 takes the marks that end
    sentences out of it, 3 repeats it, 4 makes its role user.  Nulls are one
    space."""
    spaced = {c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (key, turn, role, text)}
    kind = F.crc32(F.concat(spaced[key], F.lit(":"), spaced[turn]).cast("binary")) % 20
    texts = (F.when(F.col("_kind") == 1, F.lit(""))
             .when(F.col("_kind") == 2, F.translate(spaced[text], ".!?", "")).otherwise(spaced[text]))
    return (conversations.withColumn("_kind", kind)
            .withColumn("_copy", F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1)))
                                           .otherwise(F.array(F.lit(0)))))
            .select(F.col(f"`{key}`"), F.col(f"`{turn}`"),
                    F.when(F.col("_kind") == 4, F.lit("user")).otherwise(spaced[role]).alias(role),
                    texts.alias(text), (F.col("_kind") == 0).alias("lost")))
