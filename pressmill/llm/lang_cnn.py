"""Language identification by a byte convolutional network.

A text is lower-cased, everything but letters (ASCII letters and non-ASCII bytes) becomes one space, and the bytes are cut
into windows of WINDOW bytes, the last one filled with zeros. The network embeds bytes, applies filters of several
widths, takes each filter's maximum over the window and ends in a softmax over the learned languages. A text's answer is
the softmax of its windows' mean log chances, weighted by their letters: every window of every text takes part.

Training is in numpy, on a bounded sample of labelled texts (`max_train` rows and `train_bytes` of text at most, smallest
hash) with all their windows, only from documents whose crc32(doc_id as text) modulo 5 is not 0. lang, source and doc_id
are not inputs of a prediction.

Edge cases: a null text and one without a letter are 'und' with score 0; null lang values are not learned; with no
labelled text everything is 'und'; a very long text has as many windows as it needs; ties go to the first language in code point order; repeated rows give repeated
results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

WINDOW = 128
WIDTHS, FILTERS, EMBED = (2, 3, 4), 16, 8
MAX_TRAIN, TRAIN_BYTES = 3000, 8 << 20
BATCH = 64
UNKNOWN = "und"

RESULT = "doc_id long, held_out boolean, lang_pred string, score double"

_SPAN = max(WIDTHS)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
_FOLD = np.where(_LETTER, np.arange(256), 0x20).astype(np.uint8)


def windows(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows as bytes, padded by the widest filter; windows of each row; letter bytes of each window)."""
    data, offs = C.utf8(pc.utf8_lower(column))
    flat = _FOLD[data]
    keep = np.ones(len(flat), bool)
    keep[1:] = (flat[1:] != 0x20) | (flat[:-1] != 0x20)  # one space for a run; at a row's start it may be lost
    offs = np.concatenate(([0], np.cumsum(keep)))[offs]
    flat = flat[keep]
    sizes = np.diff(offs)
    many = np.maximum(1, -(-sizes // WINDOW))
    base = np.concatenate(([0], np.cumsum(many)))
    x = np.zeros((int(base[-1]), WINDOW + _SPAN - 1), np.uint8)
    place = np.arange(len(flat)) - np.repeat(offs[:-1], sizes)
    x[np.repeat(base[:-1], sizes) + place // WINDOW, place % WINDOW] = flat
    return x, many, _LETTER[x].sum(1)


class ByteNet:
    """Embedding, filters (narrow ones padded with zero weights), biases and the last layer."""

    def __init__(self, parts: dict[str, np.ndarray], names: list[str]) -> None:
        self.p, self.names = parts, names

    @classmethod
    def fresh(cls, names: list[str], seed: int = 3) -> ByteNet:
        r, n = np.random.default_rng(seed), FILTERS * len(WIDTHS)
        w = (r.standard_normal((_SPAN * EMBED, n)) * 0.3).astype(np.float32)
        return cls({"e": (r.standard_normal((256, EMBED)) * 0.5).astype(np.float32), "w": w * cls.mask(), "b": np.zeros(n, np.float32), "o": (r.standard_normal((n, len(names))) * 0.2).astype(np.float32), "ob": np.zeros(len(names), np.float32)}, names)

    @staticmethod
    def mask() -> np.ndarray:
        m = np.zeros((_SPAN * EMBED, FILTERS * len(WIDTHS)), np.float32)
        for k, width in enumerate(WIDTHS):
            m[: width * EMBED, k * FILTERS : (k + 1) * FILTERS] = 1
        return m

    def columns(self, x: np.ndarray) -> np.ndarray:
        """Each position's bytes as embedded, side by side."""
        e = self.p["e"][x]
        n, _, d = e.shape
        s = e.strides
        return np.lib.stride_tricks.as_strided(e, (n, WINDOW, _SPAN * d), (s[0], s[1], s[2])).reshape(n * WINDOW, _SPAN * d)

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.names)), np.float32)
        for i in range(0, len(x), BATCH):
            part = x[i : i + BATCH]
            top = (self.columns(part) @ self.p["w"]).reshape(len(part), WINDOW, -1).max(1)
            out[i : i + BATCH] = np.maximum(top + self.p["b"], 0) @ self.p["o"] + self.p["ob"]
        return out

    def gradient(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.p, len(x)
        cols = self.columns(x)
        maps = (cols @ p["w"]).reshape(n, WINDOW, -1)
        where = maps.argmax(1)
        top = np.take_along_axis(maps, where[:, None], 1)[:, 0] + p["b"]
        act = np.maximum(top, 0)
        q = np.exp((z := act @ p["o"] + p["ob"]) - z.max(1, keepdims=True))
        q /= q.sum(1, keepdims=True)
        q[np.arange(n), y] -= 1
        q /= n
        d = (q @ p["o"].T) * (top > 0)
        at = (np.arange(n)[:, None] * WINDOW + where).reshape(-1)
        picked = cols[at].reshape(n, -1, cols.shape[1])
        dw = np.einsum("nf,nfk->kf", d, picked) * self.mask()
        de = np.zeros_like(p["e"])
        back = (d[:, :, None] * p["w"].T[None]).reshape(n, -1, _SPAN, EMBED)
        for j in range(_SPAN):
            np.add.at(de, x[np.arange(n)[:, None], where + j], back[:, :, j])
        return {"o": act.T @ q, "ob": q.sum(0), "b": d.sum(0), "w": dw, "e": de}


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


def fit(x: np.ndarray, y: np.ndarray, names: list[str], steps: int = 450, batch: int = 128, rate: float = 5e-3, seed: int = 3) -> ByteNet:
    net, r = ByteNet.fresh(names, seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    s = {k: np.zeros_like(v) for k, v in net.p.items()}
    step = 0
    while step < steps:
        order = r.permutation(len(x))
        for i in range(0, len(order), batch):
            pick = order[i : i + batch]
            step += 1
            for k, g in net.gradient(x[pick], y[pick]).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                net.p[k] = (net.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def train(documents: DataFrame, max_train: int = MAX_TRAIN, train_bytes: int = TRAIN_BYTES) -> ByteNet | None:
    """Fit on a bounded sample of the labelled texts outside the held-out fold."""
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    known = source.where("lang is not null and doc_id is not null").where(C.crc_mod("doc_id", 5) != 0)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _ in C.text_chunks(batches):
            x, many, letters = windows(batch.column(1))
            ends = np.cumsum(many)
            out = [x[e - k : e][letters[e - k : e] > 0].tobytes() for e, k in zip(ends.tolist(), many.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["lang", "x"])

    rows = C.training_texts(known, known.select("doc_id"), max_train, train_bytes).mapInArrow(cut, "lang string, x binary").collect()
    rows = sorted((r for r in rows if len(r.x)), key=lambda r: (r.lang, bytes(r.x)))
    if not rows:
        return None
    names = sorted({r.lang for r in rows})
    each = [np.frombuffer(bytes(r.x), np.uint8).reshape(-1, WINDOW + _SPAN - 1) for r in rows]
    return fit(np.concatenate(each), np.repeat([names.index(r.lang) for r in rows], [len(e) for e in each]), names)


def predict(documents: DataFrame, net: ByteNet | None) -> DataFrame:
    """One row of RESULT per document row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _ in C.text_chunks(batches):
            text = batch.column(2)
            some = np.asarray(pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False))
            names, best = np.full(len(text), UNKNOWN, object), np.zeros(len(text))
            if net is not None and some.any():
                x, many, letters = windows(text)
                first = np.concatenate(([0], np.cumsum(many)))[:-1]
                weight = letters.astype(np.float64) + 1e-9
                z = np.add.reduceat(log_softmax(net.logits(x)) * weight[:, None], first, axis=0) / np.add.reduceat(weight, first)[:, None]
                chance = np.exp(log_softmax(z))
                names = np.where(some, np.array(net.names, object)[chance.argmax(1)], UNKNOWN)
                best = np.where(some, chance.max(1), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names.tolist(), pa.string()), pa.array(best)], ["doc_id", "held_out", "lang_pred", "score"])

    held = F.coalesce(C.crc_mod("doc_id", 5) == 0, F.lit(False))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "text").mapInArrow(run, RESULT)
