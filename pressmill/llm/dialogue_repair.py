"""Conversation structure repair: cheapest edits by Dial's bucket-queue shortest paths.

A conversation should have the role initials (s?(ua)+)?, that is: nothing, or a system turn if any and then pairs of user
and assistant. Rows are taken by turn (nulls first; then by role and digest of the text). Each may be kept (K), given the
role user or assistant (R), or deleted (D), and empty turns of either role may be inserted anywhere (I). Blank rows and
rows whose role and text came before must go; a row that stops short costs more where it stays.

The nodes of the graph are (rows read, role so far), four for each row; the arcs are the edits, with the small integer costs
below. Dial's queue, a ring of as many buckets as the dearest arc costs plus one, gives the distance of every node to
the goal. Walking from the start along tight arcs (those whose cost is the difference of distances), always by the letter
that is first in ASCII, gives the least audit among the cheapest. At a node no two arcs of one letter lead to different
nodes, so the audit fixes the repaired turns.

Conversations of up to LONG_ROWS rows and LONG_BYTES bytes are sorted into partitions by conversation and repaired one by
one as they stream by. Longer ones never meet in one task: their rows are dealt by range of (conversation, turn, role,
digest), cut into segments of 2**SEGMENT_BITS rows, and each segment becomes a matrix of distances from the four roles
before it to the four behind it (Dial's queue again). The matrices, one row for a segment, give the distances at
all borders; then segments are walked by themselves. Only the hash of the repaired text takes the rows of one
conversation in order, as a stream.

Edge cases: null roles and texts count as one blank, so a null text is a blank row; a null conv_id is a conversation, null
turns come first; a conversation without rows has an empty result; a role that begins otherwise than s, u and a can't be
kept; very long texts are rows like any other; rows that repeat are duplicates; ties between rows of one turn are settled
by role and digest; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

REROLE, DELETE, INSERT, SHORT_TEXT = 3, 4, 3, 3  # costs; keeping is free
DEAREST = REROLE + SHORT_TEXT
LONG_ROWS, LONG_BYTES, SEGMENT_BITS = 4096, 8 << 20, 12

START, SYSTEM, USER, ASSISTANT = range(4)  # the last role so far
GOALS = (START, ASSISTANT)
ROLE = (None, "system", "user", "assistant")
FOLLOWING = (USER, USER, ASSISTANT, USER)  # the role, user or assistant, that may come next
KEPT = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
FAR = 1 << 60

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
SHORT_RESULT = f"conv string, {', '.join(f'{c} long' for c in COUNTS)}, audit string, turns array<struct<role: string, text: string>>"
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

_SPACE = " \t\n\x0b\x0c\r"


def row_code(role: str, text: str, seen: bool) -> str:
    """Two letters for a row: its role's initial (s, u, a or -) and its first fault (b blank, d duplicate, t truncated, k none)."""
    tail = text.rstrip(_SPACE)
    fault = "b" if not tail else "d" if seen else "k" if tail[-1] in ".!?" else "t"
    return (role[:1] if role[:1] in ("s", "u", "a") else "-") + fault


def arcs(code: str | None, state: int) -> Iterator[tuple[str, int, int, int]]:
    """(letter, cost, rows read, role after) of the edits at a row, or behind the last one, in the order of letters."""
    if code is not None:
        yield "D", DELETE, 1, state
    yield "I", INSERT, 0, FOLLOWING[state]
    if code is not None and code[1] in "kt":
        more = SHORT_TEXT if code[1] == "t" else 0
        if (code[0], state) in KEPT:
            yield "K", more, 1, KEPT[code[0], state]
        yield "R", REROLE + more, 1, FOLLOWING[state]


CODES = [i + f for i in "sua-" for f in "kbdt"]
ARCS = {code: [list(arcs(code, s)) for s in range(4)] for code in (*CODES, None)}
#: (role before, cost) of the arcs into each role: of a row, and of inserts
INTO = {code: [[(s, cost) for s in range(4) for _, cost, read, after in ARCS[code][s] if read and after == t] for t in range(4)] for code in CODES}
INSERTED = [[s for s in range(4) if FOLLOWING[s] == t] for t in range(4)]


def dial(codes: list[str], goals: Iterable[int]) -> list[int]:
    """The distance of each node 4 * (rows read) + role to the nearest of the roles `goals` behind the last row; FAR if there is no way."""
    distance = [FAR] * (4 * len(codes) + 4)
    ring: list[list[int]] = [[] for _ in range(DEAREST + 1)]
    waiting = now = 0

    def reach(node: int, at: int) -> int:
        if at >= distance[node]:
            return 0
        distance[node] = at
        ring[at % len(ring)].append(node)
        return 1

    for goal in goals:
        waiting += reach(4 * len(codes) + goal, 0)
    while waiting:
        bucket = ring[now % len(ring)]
        while bucket:
            node = bucket.pop()
            waiting -= 1
            if distance[node] < now:  # reached again on a shorter way
                continue
            read, role = divmod(node, 4)
            for before in INSERTED[role]:
                waiting += reach(4 * read + before, now + INSERT)
            if read:
                for before, cost in INTO[codes[read - 1]][role]:
                    waiting += reach(4 * read - 4 + before, now + cost)
        now += 1
    return distance


def walk(codes: list[str], distance: list[int], role: int = START, last: bool = True) -> list[tuple[str, int]]:
    """(letter, role after) of the edits from `role` on along tight arcs, by the first letter at each node; up to the goal if these are the last rows, else up to their end."""
    read, steps = 0, []
    while read < len(codes) or (last and distance[4 * read + role] > 0):
        here = distance[4 * read + role]
        for letter, cost, moved, after in ARCS[codes[read] if read < len(codes) else None][role]:
            if cost + distance[4 * (read + moved) + after] == here:
                steps.append((letter, after))
                read, role = read + moved, after
                break
    return steps


def counted(codes: list[str]) -> dict[str, int]:
    faults = [c[1] for c in codes]
    illegal = sum((a[0], b[0]) not in LEGAL for a, b in zip(codes, codes[1:], strict=False))
    return {"blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"), "illegal": illegal}


def repaired_rows(steps: list[tuple[str, int]], rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """(role, text) of the repaired conversation."""
    out, left = [], iter(rows)
    for letter, after in steps:
        role, text = (ROLE[after], "") if letter == "I" else next(left)
        if letter != "D":
            out.append((ROLE[after] if letter == "R" else role, text))
    return out


def _short(turns: DataFrame) -> DataFrame:
    """SHORT_RESULT of conversations that are repaired whole: conv, turn, role, text in, sorted by conversation."""

    def one(rows: Iterable[tuple]) -> tuple:
        numbers, held, seen, codes = set(), [], set(), []
        for turn, role, text in rows:
            if turn is not None:
                numbers.add(turn)
            codes.append(row_code(role, text, (role, text) in seen))
            seen.add((role, text))
            held.append((role, text))
        distance = dial(codes, GOALS)
        steps, counts = walk(codes, distance), counted(codes)
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        return (gaps, *[counts[c] for c in COUNTS[1:-1]], distance[START], "".join(s for s, _ in steps), repaired_rows(steps, held))

    names = ["conv", *COUNTS, "audit", "turns"]
    types = [pa.string(), *[pa.int64()] * len(COUNTS), pa.string(), _TURNS]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*[c.to_pylist() for c in b.columns], strict=True))
        out, size = [], 0
        for conv, group in groupby(rows, key=lambda r: r[0]):
            out.append((conv, *one(r[1:] for r in group)))
            size += sum(len(t) for _, t in out[-1][-1])
            if len(out) >= C.CHUNK_ROWS or size >= C.CHUNK:
                yield batch_of(out)
                out, size = [], 0
        if out:
            yield batch_of(out)

    return turns.select("conv", "turn", "role", "text", "digest").repartition("conv").sortWithinPartitions("conv", "turn", "role", "digest").select("conv", "turn", "role", "text").mapInArrow(repair, SHORT_RESULT)


def normal(conversations: DataFrame) -> DataFrame:
    """conv (conv_id as text, null: a blank), turn, role, text and a digest that orders rows of one turn."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    named = conversations.select(blank("conv_id"), F.col("turn").cast("long").alias("turn"), blank("role"), blank("text"))
    return named.select(F.col("conv_id").alias("conv"), "turn", "role", "text", F.md5(F.encode("text", "UTF-8")).alias("digest"))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with the faults to be mended: by crc32 of 'conv_id:turn' modulo 20, 0 drops the row, 1 empties its text, 2 takes its full stops, exclamation and question marks, 3 repeats it, 4 gives it the role user."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.encode(F.concat(blank("conv_id"), F.lit(":"), blank("turn")), "UTF-8")) % 20
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), fate.alias("fate")).where("fate != 0")
    text = F.when(F.col("fate") == 1, F.lit("")).when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("time")).drop("time")


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each segment: distances from each role before it to each role behind it (row by row), its counts and its first and last initial."""
    for batch in batches:
        rows = []
        for conv, block, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            codes = [text[k : k + 2] for k in range(0, len(text), 2)]
            to = [dial(codes, [goal]) for goal in range(4)]
            rows.append((conv, block, [to[goal][role] for role in range(4) for goal in range(4)], *counted(codes).values(), codes[0][0], codes[-1][0]))
        types = (pa.string(), pa.int64(), pa.list_(pa.int64()), *[pa.int64()] * 4, pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["conv", "block", "matrix", "blank", "duplicate", "truncated", "illegal", "first", "last"])


def _borders(group: pd.DataFrame) -> pd.DataFrame:
    """Of the segments of one conversation: the distances to the goal behind each, the pairs that its border makes illegal and the distance before it."""
    group = group.sort_values("block")
    behind, before, follow = [], [], [0 if r in GOALS else FAR for r in range(4)]
    for matrix in group["matrix"][::-1]:
        behind.append(follow)
        follow = [min(min(matrix[4 * r + g] + follow[g] for g in range(4)), FAR) for r in range(4)]
        before.append(follow[START])
    initials = list(zip(group["last"][:-1], group["first"][1:], strict=True))
    bad = [0, *[int(p not in LEGAL) for p in initials]]
    ends = [False] * (len(group) - 1) + [True]
    return pd.DataFrame({"conv": group["conv"], "block": group["block"], "behind": behind[::-1], "final": ends, "illegal": group["illegal"] + bad, "cost": before[::-1]})


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each segment, for each role before it: the role behind it and the edits, as letters and roles."""
    for batch in batches:
        rows = []
        for conv, block, text, behind, final in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            codes = [text[k : k + 2] for k in range(0, len(text), 2)]
            to = [dial(codes, [goal]) for goal in range(4)]
            distance = [min(min(d[node] + b for d, b in zip(to, behind, strict=True)), FAR) for node in range(len(to[0]))]
            ways = [walk(codes, distance, role, final) if distance[role] < FAR else [] for role in range(4)]
            rows.append((conv, block, [w[-1][1] if w else r for r, w in enumerate(ways)], ["".join(s for s, _ in w) for w in ways], ["".join(str(a) for _, a in w) for w in ways]))
        types = (pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["conv", "block", "exits", "letters", "roles"])


def _entries(group: pd.DataFrame) -> pd.DataFrame:
    """The role before each segment of one conversation."""
    group = group.sort_values("block")
    role, entry = START, []
    for exits in group["exits"]:
        entry.append(role)
        role = int(exits[role])
    return pd.DataFrame({"conv": group["conv"], "block": group["block"], "entry": entry})


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each row of a segment: the roles inserted before it, its letter and role after, the roles inserted behind it (at the very end)."""
    for batch in batches:
        for ats, letters, roles in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            rows, inserted = [], []
            for letter, after in zip(letters, roles, strict=True):
                if letter == "I":
                    inserted.append(ROLE[int(after)])
                else:
                    rows.append((ats[len(rows)], inserted, letter, ROLE[int(after)], []))
                    inserted = []
            rows[-1] = (*rows[-1][:4], inserted)
            types = (pa.int64(), pa.list_(pa.string()), pa.string(), pa.string(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["at", "ahead", "letter", "now", "after"])


def _long(turns: DataFrame, scratch: C.Scratch, bits: int) -> tuple[DataFrame, DataFrame]:
    """Of long conversations: conv, COUNTS and audit; and (conv, part, turns), the repaired turns in order of part."""
    dealt = turns.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange("conv", "turn", "role", "digest", "copy")
    rows = scratch.table(dealt.sortWithinPartitions("conv", "turn", "role", "digest").drop("copy").withColumn("at", F.monotonically_increasing_id()), "rows")
    again = scratch.table(rows.groupBy("conv", "role", "digest").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "again")
    known = rows.join(again.hint("merge"), ["conv", "role", "digest"], "left").withColumn("seen", F.coalesce(F.col("at") > F.col("first"), F.lit(False)))
    bare = F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", "")
    fault = F.when(bare == "", "b").when(F.col("seen"), "d").when(bare.rlike(r"[.!?]\z"), "k").otherwise("t")
    initial = F.substring("role", 1, 1)
    code = F.concat(F.when(initial.isin("s", "u", "a"), initial).otherwise("-"), fault)
    codes = scratch.table(known.select("conv", "turn", "at", F.shiftright("at", bits).alias("block"), code.alias("code")), "codes")
    # a segment has at most 2**bits rows
    listed = codes.groupBy("conv", "block").agg(F.array_sort(F.collect_list(F.struct("at", "code"))).alias("rows"))
    segments = scratch.table(listed.select("conv", "block", F.transform("rows", lambda r: r["at"]).alias("ats"), F.array_join(F.transform("rows", lambda r: r["code"]), "").alias("text")), "segments")
    measured = segments.select("conv", "block", "text").mapInArrow(_matrices, "conv string, block long, matrix array<long>, blank long, duplicate long, truncated long, illegal long, first string, last string")
    measured = scratch.table(measured, "matrices")
    borders = measured.select("conv", "block", "matrix", "illegal", "first", "last").groupBy("conv").applyInPandas(_borders, "conv string, block long, behind array<long>, final boolean, illegal long, cost long")
    borders = scratch.table(borders, "borders")
    ways = segments.join(borders, ["conv", "block"]).select("conv", "block", "text", "behind", "final").mapInArrow(_walks, "conv string, block long, exits array<long>, letters array<string>, roles array<string>")
    ways = scratch.table(ways, "walks")
    entries = ways.select("conv", "block", "exits").groupBy("conv").applyInPandas(_entries, "conv string, block long, entry long")
    way = lambda c: F.element_at(c, F.col("entry").cast("int") + 1).alias(c)
    chosen = scratch.table(ways.join(entries, ["conv", "block"]).select("conv", "block", way("letters"), way("roles")), "chosen")
    audits = chosen.groupBy("conv").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "letters"))), lambda s: s["letters"]), "").alias("audit"))
    sums = measured.groupBy("conv").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    costs = borders.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.min_by("cost", "block").alias("cost"))
    turn_counts = codes.where("turn is not null").groupBy("conv", "turn").count().groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    summary = sums.join(costs, "conv").join(audits, "conv").join(turn_counts, "conv", "left").select("conv", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in COUNTS], "audit")
    edits = segments.join(chosen, ["conv", "block"]).select("ats", "letters", "roles").mapInArrow(_placed, "at long, ahead array<string>, letter string, now string, after array<string>")
    empty = lambda c: F.transform(c, lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))
    own = F.struct(F.when(F.col("letter") == "R", F.col("now")).otherwise(F.col("role")).alias("role"), F.col("text"))
    nothing = F.array().cast("array<struct<role: string, text: string>>")
    parts = rows.join(scratch.table(edits, "edits").hint("merge"), "at")
    parts = parts.select("conv", F.col("at").alias("part"), F.concat(empty("ahead"), F.when(F.col("letter") == "D", nothing).otherwise(F.array(own)), empty("after")).alias("turns"))
    return summary, parts


def _told(turns: str) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")


def _hashes(parts: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of conversations in parts, each conversation streamed in order and none held."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*[c.to_pylist() for c in b.columns], strict=True))
        for conv, group in groupby(rows, key=lambda r: r[0]):
            digest, lead = hashlib.sha256(), ""
            for _, text in group:
                digest.update(f"{lead}{text}".encode())
                lead = "\n"
            yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([digest.hexdigest()])], ["conv", "repaired_sha256"])

    told = parts.where("size(turns) > 0").select("conv", "part", _told("turns").alias("text"))
    return told.repartition("conv").sortWithinPartitions("conv", "part").select("conv", "text").mapInArrow(stream, "conv string, repaired_sha256 string")


def _parted(conversations: DataFrame, scratch: C.Scratch, long_rows: int, long_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of conversations that are repaired whole, and those of long ones if there are any."""
    turns = normal(conversations)
    sizes = turns.groupBy("conv").agg(F.count("*").alias("n"), F.sum(F.octet_length("text").cast("long")).alias("bytes"))
    long = scratch.table(sizes.where((F.col("n") > long_rows) | (F.col("bytes") > long_bytes)).select("conv"), "long")
    if not long.limit(1).count():
        return turns, None
    return turns.join(long, "conv", "left_anti"), turns.join(long, "conv", "left_semi")


def _id(conv: Column) -> Column:
    return F.when(conv != " ", conv.cast("long")).alias("conv_id")


def repaired_turns(conversations: DataFrame, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES, segment_bits: int = SEGMENT_BITS) -> DataFrame:
    """conv_id, part, place, role, text: the turns of the repaired conversations, in order of part and place."""
    scratch = C.Scratch(conversations.sparkSession, "dialogue")
    short, long = _parted(conversations, scratch, long_rows, long_bytes)
    parts = _short(short).select("conv", F.lit(0).cast("long").alias("part"), "turns")
    if long is not None:
        parts = parts.union(_long(long, scratch, segment_bits)[1])
    return parts.select(_id(F.col("conv")), "part", F.posexplode("turns").alias("place", "turn")).select("conv_id", "part", "place", "turn.role", "turn.text")


def repair(conversations: DataFrame, ids: DataFrame | None = None, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES, segment_bits: int = SEGMENT_BITS) -> DataFrame:
    """conv_id, COUNTS, audit and repaired_sha256 of each conversation. ids: a table whose conv_id are all to be named, also those without rows."""
    scratch = C.Scratch(conversations.sparkSession, "dialogue")
    short, long = _parted(conversations, scratch, long_rows, long_bytes)
    out = _short(short).select("conv", *COUNTS, "audit", F.sha2(F.encode(_told("turns"), "UTF-8"), 256).alias("repaired_sha256"))
    if long is not None:
        summary, parts = _long(long, scratch, segment_bits)
        out = out.union(summary.join(_hashes(parts), "conv", "left").select(*out.columns))
    if ids is not None:
        named = ids.select(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv")).distinct()
        out = named.join(scratch.table(out, "repaired"), "conv", "left")
    nothing = hashlib.sha256().hexdigest()
    return out.select(_id(F.col("conv")), *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in COUNTS], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    return repair(damage(conversations), conversations)


def oracle() -> str:
    """The same rows in DuckDB: a recursive query reads one row after the other and keeps, for each last role, the cheapest edits (cost, audit, repaired text; the least audit of equal ones)."""

    def step(state: str, cost: str, letter: str, line: str) -> str:
        more = f"{state}.r || CASE WHEN {state}.r = '' THEN '' ELSE chr(10) END || ({line})"
        return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'r': {more if line else state + '.r'}}} END"

    def closed(prefix: str, columns: str) -> str:
        """One insert, then a second one, from the states before a row or at the end."""
        once = {t: f"least({t}, {', '.join(step(s, '3', 'I', line) for s in froms)})" for t, froms, line in (("u", ("n", "s", "a"), "'user:'"), ("a", ("u",), "'assistant:'"))}
        return f"SELECT {columns}, n, s, {once['u']} AS u, {once['a']} AS a FROM {prefix}"

    free = "code NOT IN ('b', 'd')"
    extra = "(CASE WHEN code = 't' THEN 3 ELSE 0 END)"
    kept = lambda state, initial: f"CASE WHEN {free} AND initial = '{initial}' THEN {step(state, extra, 'K', 'role || chr(58) || text')} END"
    roled = lambda state, to: f"CASE WHEN {free} THEN {step(state, f'3 + {extra}', 'R', f'{chr(39)}{to}:{chr(39)} || text')} END"
    gone = lambda state: step(state, "4", "D", "")
    into_u = ", ".join(f(s, x) for s in ("n", "s", "a") for f, x in ((kept, "u"), (roled, "user")))
    return f"""
WITH RECURSIVE w AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
-- crc32, bit by bit
x AS (SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
  lambda acc, b: list_reduce(list_prepend(xor(acc, b), range(8)), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295) % 20 AS fate FROM w),
d AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE WHEN fate = 3 THEN [1, 2] ELSE [1] END) AS copy FROM x WHERE fate != 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again, substr(role, 1, 1) AS initial FROM d),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b' WHEN again > 1 THEN 'd' WHEN regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'k' ELSE 't' END AS code,
  lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS earlier FROM o),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE code = 'b') AS blank, count(*) FILTER (WHERE code = 'd') AS duplicate, count(*) FILTER (WHERE code = 't') AS truncated,
  count(*) FILTER (WHERE earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS rows FROM f GROUP BY conv_id),
p AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, rows, {{'c': 0, 'a': '', 'r': ''}} AS n, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, r VARCHAR)) AS s, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, r VARCHAR)) AS u, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, r VARCHAR)) AS a FROM g
  UNION ALL
  SELECT conv_id, i, rows, {gone("n")} AS n, least({gone("s")}, {kept("n", "s")}) AS s, least({gone("u")}, {into_u}) AS u, least({gone("a")}, {kept("u", "a")}, {roled("u", "assistant")}) AS a
  FROM ({closed(f"({closed('(SELECT q.conv_id, f.i, q.rows, f.role, f.text, f.initial, f.code, n, s, u, a FROM p q JOIN f ON f.conv_id IS NOT DISTINCT FROM q.conv_id AND f.i = q.i + 1)', 'conv_id, i, rows, role, text, initial, code')})", "conv_id, i, rows, role, text, initial, code")})
),
e AS (SELECT conv_id, least(n, a) AS best FROM ({closed(f"({closed('(SELECT conv_id, n, s, u, a FROM p WHERE i = rows)', 'conv_id')})", "conv_id")}))
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(best.r, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""
