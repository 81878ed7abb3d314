"""Quality classifier by attention-based multiple-instance learning.

A text is a bag of passages of PASSAGE bytes. A passage is described by its character shapes (pairs of byte classes and
a few shares), encoded by one hidden layer; a gated attention (tanh times sigmoid) gives each passage a weight, and the
weighted sum of the encodings is scored. Encoder, gates and score are learned together from document labels alone, in
numpy, on a bounded sample of labelled documents (`max_train` rows and `train_bytes` of text at most, smallest hash),
each with all its passages; scoring uses every passage of every text.

Only documents whose crc32(doc_id as text) modulo 3 is not 1 are learned from; labels, lang, source and doc_id are not
inputs. Edge cases: null and empty texts are one empty passage; a very long text has as many passages as it needs and is
handled alone; without labels of both kinds every score is 0.5; equal texts get equal scores, of equal weights the first
passage is the top one; repeated rows give repeated results; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

PASSAGE = 1024
MAX_TRAIN, TRAIN_BYTES = 4000, 16 << 20
HIDDEN, GATES = 24, 12

RESULT = "doc_id long, held_out boolean, score double, predicted int, n_passages long, top_passage long"

_MARKS = "\n.,;:!?'\"()-|#*$%&<>=/@"
_CLASS = np.full(256, len(_MARKS) + 4, np.int64)
_CLASS[0x20] = _CLASS[[9, 11, 12, 13]] = 0
_CLASS[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
for _k, _c in enumerate(_MARKS):
    _CLASS[ord(_c)] = 4 + _k
CLASSES = len(_MARKS) + 5
WIDTH = CLASSES * CLASSES + 4


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of each passage, passages of each row); a row without bytes has one passage of zeros."""
    sizes = np.diff(offsets)
    many = np.maximum(1, -(-sizes // PASSAGE))
    base = np.concatenate(([0], np.cumsum(many)))
    n = int(base[-1])
    at = np.repeat(base[:-1], sizes) + (np.arange(len(data)) - np.repeat(offsets[:-1], sizes)) // PASSAGE
    cls = _CLASS[data]
    x = np.zeros((n, WIDTH), np.float32)
    if len(data) > 1:
        same = at[1:] == at[:-1]
        pairs = (at[1:] * (CLASSES * CLASSES) + cls[:-1] * CLASSES + cls[1:])[same]
        x[:, :-4] = np.bincount(pairs, minlength=n * CLASSES * CLASSES).reshape(n, -1)
    length = np.maximum(np.bincount(at, minlength=n), 1).astype(np.float32)
    starts, ends, _ = C.spans_of(~C.SPACE[data], offsets)
    if len(starts):
        h = C.span_hashes(data, starts, ends)
        where = at[starts]
        words = np.maximum(np.bincount(where, minlength=n), 1)
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (where[1:] == where[:-1])
        order = np.argsort(C.mix(h ^ C.mix(where.astype(np.uint64) + np.uint64(7))), kind="stable")
        key = C.mix(h ^ C.mix(where.astype(np.uint64) + np.uint64(7)))[order]
        copy = np.zeros(len(h), bool)
        copy[order[1:]] = key[1:] == key[:-1]
        x[:, -4] = np.bincount(where[again], minlength=n) / words
        x[:, -3] = np.bincount(where[copy], minlength=n) / words
        x[:, -2] = length / words / 32
    x[:, -1] = length / PASSAGE
    x[:, :-4] = np.sqrt(x[:, :-4] / length[:, None])
    return x, many


class AttentionModel:
    """Encoder, gated attention and score; all parameters in one dictionary."""

    def __init__(self, parts: dict[str, np.ndarray]) -> None:
        self.p = parts

    @classmethod
    def fresh(cls, width: int, seed: int = 1) -> AttentionModel:
        r = np.random.default_rng(seed)
        w = lambda a, b: (r.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        return cls({"e": w(width, HIDDEN) * 3, "eb": np.zeros(HIDDEN, np.float32), "v": w(HIDDEN, GATES), "u": w(HIDDEN, GATES), "g": w(GATES, 1)[:, 0], "s": w(HIDDEN, 1)[:, 0], "sb": np.zeros(1, np.float32)})

    def forward(self, x: np.ndarray, many: np.ndarray) -> dict[str, np.ndarray]:
        p, first = self.p, np.concatenate(([0], np.cumsum(many)))[:-1]
        bag = np.repeat(np.arange(len(many)), many)
        h = np.tanh(x @ p["e"] + p["eb"])
        t, o = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        a = (t * o) @ p["g"]
        w = np.exp(a - np.maximum.reduceat(a, first)[bag])
        w /= np.add.reduceat(w, first)[bag]
        z = np.add.reduceat(w[:, None] * h, first, axis=0)
        score = 1 / (1 + np.exp(-(z @ p["s"] + p["sb"][0])))
        return {"first": first, "bag": bag, "h": h, "t": t, "o": o, "w": w, "z": z, "score": score}

    def gradient(self, x: np.ndarray, many: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.p, self.forward(x, many)
        d = (f["score"] - y) / len(y)
        out = {"s": f["z"].T @ d, "sb": np.array([d.sum()])}
        dz = (d[:, None] * p["s"])[f["bag"]]
        dw = (dz * f["h"]).sum(1)
        da = f["w"] * (dw - np.add.reduceat(f["w"] * dw, f["first"])[f["bag"]])
        out["g"] = (f["t"] * f["o"]).T @ da
        dg = da[:, None] * p["g"]
        dt, do = dg * f["o"] * (1 - f["t"] ** 2), dg * f["t"] * f["o"] * (1 - f["o"])
        out["v"], out["u"] = f["h"].T @ dt, f["h"].T @ do
        dh = (f["w"][:, None] * dz + dt @ p["v"].T + do @ p["u"].T) * (1 - f["h"] ** 2)
        out["e"], out["eb"] = x.T @ dh, dh.sum(0)
        return out


def fit(x: np.ndarray, many: np.ndarray, y: np.ndarray, steps: int = 800, batch: int = 64, rate: float = 4e-3, l2: float = 1e-4, seed: int = 1) -> AttentionModel:
    """Adam over bags in seeded order."""
    model, r = AttentionModel.fresh(x.shape[1], seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    s = {k: np.zeros_like(v) for k, v in model.p.items()}
    first, step = np.concatenate(([0], np.cumsum(many))), 0
    while step < steps:
        order = r.permutation(len(many))
        for i in range(0, len(order), batch):
            pick = order[i : i + batch]
            rows = np.concatenate([np.arange(first[b], first[b + 1]) for b in pick])
            step += 1
            for k, g in model.gradient(x[rows], many[pick], y[pick]).items():
                g = g + l2 * model.p[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                model.p[k] = (model.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def train(documents: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, train_bytes: int = TRAIN_BYTES) -> AttentionModel | None:
    """Fit on a bounded sample of the labelled documents outside the held-out fold; a doc_id with several labels has the highest."""
    known = labels.where("doc_id is not null and quality is not null").where(C.crc_mod("doc_id", 3) != 1)
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality").cast("double")).alias("label"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offs in C.text_chunks(batches):
            x, many = passages(data, offs)
            cut = np.concatenate(([0], np.cumsum(many)))
            bags = [x[a:b].astype(np.float16).tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bags, pa.binary())], ["label", "bag"])

    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = C.training_texts(source, known, max_train, train_bytes).mapInArrow(describe, "label double, bag binary").collect()
    if len({r.label > 0 for r in rows}) < 2:
        return None
    rows.sort(key=lambda r: (r.label, bytes(r.bag)))
    each = [np.frombuffer(bytes(r.bag), np.float16).reshape(-1, WIDTH) for r in rows]
    return fit(np.concatenate(each).astype(np.float32), np.array([len(e) for e in each]), np.array([float(r.label > 0) for r in rows], np.float32))


def score(documents: DataFrame, model: AttentionModel | None) -> DataFrame:
    """One row of RESULT per document row; top_passage: the one with the largest weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offs in C.text_chunks(batches):
            x, many = passages(data, offs)
            if model is None:
                p, top = np.full(len(many), 0.5), np.zeros(len(many), np.int64)
            else:
                f = model.forward(x, many)
                p = f["score"].astype(np.float64)
                best = np.lexsort((np.arange(len(x)), -f["w"], f["bag"]))
                top = best[f["first"]] - f["first"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(many), pa.array(top)], ["doc_id", "held_out", "score", "predicted", "n_passages", "top_passage"])

    held = F.coalesce(C.crc_mod("doc_id", 3) == 1, F.lit(False))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "text").mapInArrow(run, RESULT)
