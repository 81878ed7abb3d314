"""Conversation repair against every way of editing, and long conversations against whole ones."""

import hashlib
import os
import random
import re
import zlib
from itertools import product

import pyarrow.parquet as pq
import pytest

from pressmill.llm import dialogue_repair as dr
from pressmill.llm import queries

D = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NONE = hashlib.sha256().hexdigest()


def plain(rows):
    """counts, cost, audit and repaired turns of (turn, role, text) in order, by dynamic programming over prefixes."""
    faults, seen = [], set()
    for _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        faults.append("b" if not body else "d" if (role, text) in seen else "k" if body[-1] in ".!?" else "t")
        seen.add((role, text))
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    full = {"u": "user", "a": "assistant"}

    def inserted(ways):
        best = dict(ways)
        for _ in range(3):
            for last, (cost, audit, out) in list(best.items()):
                way = (cost + 3, audit + "I", [*out, (full[follow[last]], "")])
                if follow[last] not in best or way[:2] < best[follow[last]][:2]:
                    best[follow[last]] = way
        return best

    ways = {"": (0, "", [])}
    for (_, role, text), fault in zip(rows, faults, strict=True):
        after = {}

        def offer(last, way, after=after):
            if last not in after or way[:2] < after[last][:2]:
                after[last] = way

        for last, (cost, audit, out) in inserted(ways).items():
            offer(last, (cost + 4, audit + "D", out))
            if fault in "kt":
                more, first = 3 * (fault == "t"), role[:1]
                if first == follow[last] or (first == "s" and last == ""):
                    offer(first, (cost + more, audit + "K", [*out, (role, text)]))
                offer(follow[last], (cost + 3 + more, audit + "R", [*out, (full[follow[last]], text)]))
        ways = after
    cost, audit, out = min((w for last, w in inserted(ways).items() if last in ("", "a")), key=lambda w: w[:2])
    numbers = {t for t, _, _ in rows if t is not None}
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, out)


def ordered(rows):
    blank = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(blank, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))


def digest(out):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()


def checked(frame, conversations):
    got = {r.conv_id: tuple(r)[1:] for r in frame.collect()}
    assert set(got) == set(conversations)
    for conv, rows in conversations.items():
        want = plain(ordered(rows))
        assert got[conv] == (*want[:7], digest(want[7])), (conv, rows)


def made(seed, n, most):
    r = random.Random(seed)
    texts = ["Yes.", "no", "", " \n", "What?", "Go on!\t", "so it", "Yes."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    return {k: [(r.choice([None, *range(6)]), r.choice(roles), r.choice([*texts, None, str(r.random())])) for _ in range(r.randint(1, most))] for k in range(n)}


def table(spark, conversations):
    return spark.createDataFrame([(k, *row, "extra", 1) for k, rows in conversations.items() for row in rows], "conv_id long, turn long, role string, text string, conv string, digest int")


def test_distances_are_those_of_plain_relaxation():
    for n in range(4):
        for codes in map(list, product(["sk", "uk", "at", "-k", "ub", "ad"], repeat=n)):
            want = [dr.FAR] * (4 * n + 4)
            for goal in dr.GOALS:
                want[4 * n + goal] = 0
            for _ in range(4 * n + 4):
                for read in range(n + 1):
                    for role in range(4):
                        for _, cost, moved, after in dr.arcs(codes[read] if read < n else None, role):
                            want[4 * read + role] = min(want[4 * read + role], cost + want[4 * (read + moved) + after])
            assert dr.dial(codes, dr.GOALS) == want


def test_random_conversations(spark):
    conversations = made(1, 400, 9)
    checked(dr.repair(table(spark, conversations)), conversations)


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_long_conversations_are_cut_and_joined(spark, bits):
    conversations = made(2, 25, 12) | {k + 100: v for k, v in made(3, 2, 150).items()}
    frame = table(spark, conversations)
    checked(dr.repair(frame, long_rows=3, segment_bits=bits), conversations)
    turns = {}
    for row in sorted(dr.repaired_turns(frame, long_bytes=60, segment_bits=bits).collect()):
        turns.setdefault(row.conv_id, []).append((row.role, row.text))
    for conv, rows in conversations.items():
        assert turns.get(conv, []) == plain(ordered(rows))[7]


def test_one_very_long_conversation(spark):
    rows = {7: [(k // 3, ["user", "assistant"][k % 2], f"text {k}" + "." * (k % 5 > 0)) for k in range(9000)]}
    checked(dr.repair(table(spark, rows)), rows)


def test_damage_and_repair_of_every_conversation(spark):
    by_conv = {}
    for r in pq.read_table(f"{D}/conversations.parquet").to_pylist():
        rows, fate = by_conv.setdefault(r["conv_id"], []), zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", r["text"]) if fate == 2 else r["text"]
        rows += [(r["turn"], "user" if fate == 4 else r["role"], text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    checked(queries.op13_dialogue_repair(spark, D), by_conv)


def test_nulls_empty_tables_and_conversations_without_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (None, 2, "assistant", "Hi."), (4, 1, "user", "x" * 300_000 + "."), (4, 1, "user", "x" * 300_000 + ".")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    ids = spark.createDataFrame([(None,), (4,), (5,), (5,)], "conv_id long")
    got = {r.conv_id: tuple(r)[1:] for r in dr.repair(frame, ids).collect()}
    assert got[5] == (0, 0, 0, 0, 0, 0, "", NONE) and len(got) == 3
    assert got[None][:7] == (0, 1, 0, 0, 1, 4, "DKK") and got[4][:7] == (0, 0, 1, 0, 1, 7, "KDI")
    assert dr.repair(frame.limit(0)).count() == 0 and dr.repair(frame.limit(0), ids).count() == 3 and dr.repair(frame.limit(0), ids.limit(0)).count() == 0
    damaged = dr.damage(spark.createDataFrame([(None, None, None, "a.b")] * 3, "conv_id long, turn long, role string, text string")).collect()
    fate = zlib.crc32(b" : ") % 20
    assert len(damaged) == (0 if fate == 0 else 6 if fate == 3 else 3)
