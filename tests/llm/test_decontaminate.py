"""Decontamination where windows are frequent: the same results as by every diagonal, in bounded memory."""

import time
import tracemalloc

import numpy as np
import pytest

from pressmill.llm import decontaminate


def words(r, n, kinds=None):
    return r.integers(1, kinds or 1 << 60, n).astype(np.uint64)


def plain_best(item, doc):
    """The best run of all diagonals on which some mask has a hit: (aligned, agreeing, document token, item token) or None."""
    n, best = len(item), None
    for d in range(1 - n, len(doc)):
        agree = np.array([0 <= d + q < len(doc) and item[q] == doc[d + q] for q in range(n)])
        hits = [q for m in decontaminate.masks_of(n) for q in range(n - len(m) + 1) if all(agree[q + j] for j, c in enumerate(m) if c == "1")]
        if not hits:
            continue
        a, b = decontaminate._best_run(agree, np.unique(hits))
        same = int(agree[a:b].sum())
        if same >= decontaminate.needed(n) and same >= 0.75 * (b - a) and (best is None or (-same, d + a) < (-best[1], best[2])):
            best = (b - a, same, d + a, a)
    return best


@pytest.mark.parametrize("pairs,cells,narrow", [(1 << 20, 1 << 21, 200), (40, 3000, 20)])
def test_frequent_windows_give_what_every_diagonal_gives(monkeypatch, pairs, cells, narrow):
    monkeypatch.setattr(decontaminate, "PAIRS", pairs)
    monkeypatch.setattr(decontaminate, "CELLS", cells)
    monkeypatch.setattr(decontaminate, "NARROW", narrow)
    r = np.random.default_rng(12)
    stretch = words(r, 9)
    for kinds in (2, 3, 6):
        items = [words(r, int(n), kinds) for n in r.integers(5, 34, 9)] + [np.concatenate([words(r, 4), *[stretch] * 3, words(r, 3)]), np.full(20, 7, np.uint64)]
        rows = [words(r, int(n), kinds) for n in r.integers(0, 70, 6)] + [np.concatenate([*[stretch] * 5, words(r, 6, kinds), stretch]), np.full(50, 7, np.uint64)]
        got = decontaminate.find(np.concatenate(rows), np.array([len(x) for x in rows]), decontaminate.build(list(enumerate(items))))
        want = [(k, i, *b[:4], len(item)) for k, row in enumerate(rows) for i, item in enumerate(items) if (b := plain_best(item, row))]
        assert got == want and want


@pytest.mark.parametrize("many,length,period", [(20, 4000, 40), (200, 1000, 40), (200, 4000, 40), (200, 2000, 1)])
def test_frequent_windows_take_bounded_memory(many, length, period):
    r = np.random.default_rng(13)
    stretch = words(r, period)
    items = [(k, np.concatenate([words(r, 5), *[stretch] * (80 // period), words(r, 5)])) for k in range(many)]
    block, doc = decontaminate.build(items), np.concatenate([stretch] * (length // period))
    tracemalloc.start()
    began = time.time()
    got = decontaminate.find(doc, np.array([len(doc)]), block)
    took, peak = time.time() - began, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [x[:4] for x in got] == [(0, k, 80, 80) for k in range(many)] and {x[4] for x in got} == {0}
    assert peak < 200 << 20 and took < 30


def test_blocks_one_after_another_and_short_items_on_request(spark):
    docs = spark.createDataFrame([(1, "one two three four five six"), (2, "three four"), (3, "five"), (4, None), (1, "Four! five?")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "three four"), (2, "five"), (3, "two three four five six"), (4, ""), (5, None), (None, "five"), (6, "seven")], "item_id long, text string")
    told = lambda **k: sorted((x.doc_id, x.item_id, x.n_agree) for x in decontaminate.leaks(docs, items, **k).collect())
    want = [(1, 1, 2), (1, 2, 1), (1, 2, 1), (1, 3, 5), (2, 1, 2), (3, 2, 1)]
    assert told() == [(1, 3, 5)] and told(least=1) == want and told(least=1, block_hashes=4) == want
    assert sorted((x.doc_id, x.text) for x in decontaminate.without_leaks(docs, items, least=1, block_hashes=4).collect()) == [(4, None)]
    assert decontaminate.without_leaks(docs, items, block_hashes=4).count() == 4
