"""SimHash: fingerprints, anchors and components against plain Python and all pairs."""

import os
import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

from pressmill.llm import common, queries, simhash

D = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    values = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def plain_components(prints):
    """{doc_id: smallest linked doc_id}, by all pairs of different fingerprints."""
    distinct = np.array(sorted(set(prints.values())), np.uint64)
    root = list(range(len(distinct)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(distinct)):
        for j in np.flatnonzero(np.bitwise_count(distinct[i + 1 :] ^ distinct[i]) <= 2) + i + 1:
            root[find(int(j))] = find(i)
    place = {int(f): find(k) for k, f in enumerate(distinct)}
    least = {}
    for doc, f in prints.items():
        least[place[f]] = min(doc, least.get(place[f], doc))
    return {doc: least[place[f]] for doc, f in prints.items()}


def signed(fp):
    return fp - (1 << 64) if fp >> 63 else fp


def test_the_code_covers_and_replicas_reach_every_home():
    pattern, begin, up_to = simhash.cosets()
    assert (up_to[:, 0] == 1).all() and up_to[:, 2].sum() == len(pattern) == sum(1 for _ in pattern)
    r = np.random.default_rng(3)
    fp = r.integers(0, 1 << 64, 600, dtype=np.uint64)
    home = simhash.homes_of(fp)
    assert (np.bitwise_count((home ^ fp) & np.uint64((1 << 23) - 1)) <= 3).all() and (np.bitwise_count((home ^ fp) >> np.uint64(23) & np.uint64((1 << 23) - 1)) <= 3).all()
    anchors, who = simhash.replicas_of(fp)
    reached = [set() for _ in fp]
    for a, i in zip(anchors.tolist(), who.tolist(), strict=True):
        assert a not in reached[i]
        reached[i].add(a)
    for _ in range(30):
        near = fp.copy()
        for _ in range(2):
            near ^= np.uint64(1) << r.integers(0, 64, len(fp), dtype=np.uint64)
        assert all(int(h) in reached[i] for i, h in enumerate(simhash.homes_of(near)))


def test_fingerprints_of_odd_texts(monkeypatch):
    r = random.Random(5)
    texts = ["", " \n\t", "One", "one TWO", "A b\x0bC", "É é x y", "a b a b a b", "word " * 5000]
    texts += ["".join(r.choice(["a", "B", " ", "\n", "é", "xy "]) for _ in range(r.randint(0, 60))) for _ in range(300)]
    monkeypatch.setattr(simhash, "PIECE", 7)
    raw = [t.encode() for t in texts]
    got = simhash.fingerprints_of(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert got.tolist() == [plain_fingerprint(t) for t in texts]


@pytest.mark.parametrize("homes", [0, 1, 16])
def test_components_of_dense_and_lone_fingerprints(spark, homes):
    """Balls of near fingerprints, chains two bits apart and pairs three bits apart; crowded anchors give the same links."""
    r = random.Random(homes)
    prints = [0, (1 << 64) - 1]
    for _ in range(6):
        centre = r.getrandbits(64)
        prints += [centre ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 3))) for _ in range(60)]
        chain = r.getrandbits(64)
        for _ in range(20):
            prints.append(chain := chain ^ sum(1 << b for b in r.sample(range(64), r.choice([1, 2, 2, 3]))))
    prints += [r.getrandbits(64) for _ in range(300)]
    prints = dict(enumerate(dict.fromkeys(prints)))
    fps = spark.createDataFrame([(signed(f),) for f in prints.values()], "fp long")
    scratch = common.Scratch(spark, "test")
    root = {f: f for f in prints.values()}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    pairs = [(u & (1 << 64) - 1, v & (1 << 64) - 1) for u, v in simhash.links(fps, scratch, homes).collect()]
    for u, v in pairs:
        assert (u ^ v).bit_count() <= 2
        root[find(u)] = find(v)
    want = plain_components(prints)
    groups = {}
    for doc, f in prints.items():
        groups.setdefault(find(f), set()).add(want[doc])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))


def test_crowded_groups_do_not_give_all_pairs(spark):
    r = random.Random(9)
    prints = list({sum(1 << b for b in r.sample(range(24), 3)) for _ in range(2500)})
    fps = spark.createDataFrame([(f,) for f in prints], "fp long")
    n = simhash.links(fps, common.Scratch(spark, "test")).count()
    near = sum((a ^ b).bit_count() <= 2 for k, a in enumerate(prints) for b in prints[:k])
    assert len(prints) - 1 <= n < near and n < 65 * len(prints)


def test_every_document_against_plain_python(spark):
    docs = pq.read_table(f"{D}/documents.parquet").to_pylist()
    prints = {d["doc_id"]: plain_fingerprint(d["text"]) for d in docs}
    want = plain_components(prints)
    got = queries.op12_simhash(spark, D).collect()
    assert sorted(map(tuple, got)) == sorted((i, f"{prints[i]:016x}", want[i]) for i in prints)


def test_odd_and_empty_tables(odd_documents, no_documents):
    rows = simhash.near_duplicates(odd_documents).collect()
    got = {}
    for row in rows:
        got.setdefault(row.doc_id, []).append((row.fingerprint, row.component_id))
    assert len(rows) == odd_documents.count() and all(len(f) == 16 for x in got.values() for f, _ in x)
    assert got[2] == got[3] == got[6] == [("0" * 16, 2)] and got[5] == [got[1][0]] * 2 and got[1][0][1] == 1
    assert got[None][0][1] is None and [c for _, c in got[9]] == [9, 9]
    for d in odd_documents.select("doc_id", "text").collect():
        assert f"{plain_fingerprint(d.text):016x}" in {f for f, _ in got[d.doc_id]}
    assert simhash.near_duplicates(no_documents).count() == 0
