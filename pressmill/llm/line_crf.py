"""Quality rules: line sequence labelling by a linear-chain conditional random field.

Every text is cut at newlines; each line with a word gets binary features (see `FEATURES`), and Viterbi decoding marks
it content or boilerplate. A text is kept when at least `content_share` of its words stand in content lines and the
base rules (too few words, mostly repeated words) pass.

Training: only documents are labelled, so the labels of their lines are latent. In a good document every line counts as
content; of a bad one it is only known that boilerplate holds most of its words. The chain is fitted here by hard
expectation maximisation under that constraint: the lines of each bad document are decoded by the present chain, all their
scores raised by one common shift, as small as it can be, with which boilerplate holds BAD_SHARE of the words; then the
weights follow the gradient of the conditional log likelihood of these labels. So prose between junk lines of a bad
document stays content, and the transitions learn real changes. The sample is bounded: at most `max_train` labelled rows
and `train_bytes` of text (smallest hash), each text whole. Without both kinds of label the model marks every line
content, so that the base rules alone decide.

Edge cases: null and empty texts have no words, fail the base rules and are not kept; a text of one line is a chain of
length 1, a very long text is one long chain, in time and memory linear in its length; of equally good label sequences
Viterbi takes the one with content where they differ last; repeated rows give repeated results; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

MIN_WORDS = 50
CONTENT_SHARE = 0.5
MAX_TRAIN, TRAIN_BYTES = 3000, 16 << 20
BAD_SHARE = 0.6
SYMBOLS = "#*$%&|<>"

RESULT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_words long, n_lines long, n_content_lines long, kept boolean"

FEATURES = [
    "bias", "symbols over 2%", "symbols over 8%", "marks over 8%", "marks over 20%", "capitals over half of letters", "digits over 20%", "same word as the one before over 20%",
    "same word as the one before over 60%", "equal to an earlier line", "equal to a later line", "1 or 2 words", "at most 6 words", "over 20 words", "ends in a full stop", "starts with a capital",
    "mean word over 12 bytes", "trigrams repeated over 30%", "short and near the end", "short and at the start",
]

_SYM, _MARK, _UP, _LOW, _DIGIT, _STOP = (np.zeros(256, bool) for _ in range(6))
_SYM[list(SYMBOLS.encode())] = True
_MARK[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) not in ".,;:'\"()-"]] = True
_UP[ord("A") : ord("Z") + 1] = True
_LOW[ord("a") : ord("z") + 1] = True
_DIGIT[ord("0") : ord("9") + 1] = True
_STOP[list(b".!?")] = True


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[offsets])


def _sums_at(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[ends] - total[starts]


def _copies(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: does an equal key stand before it, and after it?"""
    before, after = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    if len(keys):
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        before[order[1:]] = same
        after[order[:-1]] = same
    return before, after


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Base counts of each row, and the feature rows of each line that has a word (line_row: its row)."""
    n = len(offsets) - 1
    row_salt = C.mix(np.arange(1, n + 1, dtype=np.uint64))
    ws, we, n_words = C.spans_of(~C.SPACE[data], offsets)
    w_row = np.repeat(np.arange(n), n_words)
    h = C.span_hashes(data, ws, we)
    lead = (data & 0xC0) != 0x80
    out = {"n_words": n_words, "word_chars": _sums(lead & ~C.SPACE[data], offsets), "n_symbols": _sums(_SYM[data], offsets)}

    covered = np.zeros(len(h), bool)
    if len(h) > 2:
        inner = w_row[2:] == w_row[:-2]
        tri = C.mix(h[:-2] + C.mix(h[1:-1] + C.mix(h[2:] + row_salt[w_row[2:]])))
        at = np.flatnonzero(inner)
        before, after = _copies(tri[at])
        hit = at[before | after]
        covered[hit] = covered[hit + 1] = covered[hit + 2] = True
    words_at = np.concatenate(([0], np.cumsum(n_words)))
    out["n_repeat_words"] = _sums(covered, words_at)

    ls, le, n_lines = C.spans_of(data != 10, offsets)
    first, last = np.searchsorted(ws, ls), np.searchsorted(ws, le)
    line_row, some = np.repeat(np.arange(n), n_lines), last > first
    ls, le, first, last, line_row = ls[some], le[some], first[some], last[some], line_row[some]
    before, after = _copies(C.mix(C.span_hashes(data, ls, le) + row_salt[line_row]))
    out["n_dup_lines"] = np.bincount(line_row[before], minlength=n)
    k = last - first
    again = np.zeros(len(h), bool)
    if len(h) > 1:
        again[1:] = (h[1:] == h[:-1]) & (w_row[1:] == w_row[:-1])
    size = np.maximum(_sums_at(~C.SPACE[data], ls, le), 1)
    up, low = _sums_at(_UP[data], ls, le), _sums_at(_LOW[data], ls, le)
    sym, mark, digit = (_sums_at(x[data], ls, le) / size for x in (_SYM, _MARK, _DIGIT))
    twice, tris = _sums_at(again, first, last) / k, _sums_at(covered, first, last) / k
    per_row = np.bincount(line_row, minlength=n)
    place = np.arange(len(line_row)) - np.repeat(np.concatenate(([0], np.cumsum(per_row)))[:-1], per_row)
    to_end = per_row[line_row] - 1 - place
    last_byte, first_byte = (data[we[last - 1] - 1], data[ws[first]]) if len(k) else (np.zeros(0, np.uint8),) * 2
    x = [
        np.ones(len(k), bool), sym > 0.02, sym > 0.08, mark > 0.08, mark > 0.2, up > low, digit > 0.2, twice > 0.2, twice > 0.6, before, after, k <= 2, k <= 6, k > 20, _STOP[last_byte], _UP[first_byte],
        size > 12 * k, tris > 0.3, (k <= 12) & (to_end <= 1), (k <= 12) & (place == 0),
    ]
    return out | {"line_row": line_row, "line_words": k, "lines": per_row, "x": np.stack(x, 1).astype(np.float32)}


@dataclass
class Chain:
    """Two labels (0 content, 1 boilerplate): weights of the features for label 1, transition scores, start scores."""

    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray

    def decode(self, x: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """Viterbi over all rows at once; lines: how many of the rows of x belong to each sequence, in order."""
        return viterbi(x @ self.weights, self.moves, self.start, lines)


def viterbi(score: np.ndarray, moves: np.ndarray, start: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """The best labels of sequences that stand end to end; score: of label 1 at each line."""
    starts = np.concatenate(([0], np.cumsum(lines)))[:-1]
    order = np.argsort(-lines, kind="stable")
    starts, lengths = starts[order], lines[order]
    longest = int(lengths[0]) if len(lengths) else 0
    back = np.zeros((len(score), 2), np.int8)
    best = np.zeros((len(lengths), 2))
    for t in range(longest):
        live = int(np.searchsorted(-lengths, -t, "left"))
        emit = np.stack((np.zeros(live), score[starts[:live] + t]), 1)
        if t == 0:
            best[:live] = start + emit
            continue
        both = best[:live, :, None] + moves
        back[starts[:live] + t] = both.argmax(1)
        best[:live] = both.max(1) + emit
    label = np.zeros(len(score), np.int8)
    now = best.argmax(1).astype(np.int8)
    for t in range(longest - 1, -1, -1):
        live = int(np.searchsorted(-lengths, -t, "left"))
        at = starts[:live] + t
        label[at] = now[:live]
        now[:live] = back[at, now[:live]]
    return label


def _expect(score: np.ndarray, moves: np.ndarray, start: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward: chance of label 1 for each line, expected moves, expected starts. Sequences stand by falling length."""
    n, longest = len(lengths), int(lengths[0]) if len(lengths) else 0
    live = [int(np.searchsorted(-lengths, -t, "left")) for t in range(longest)]
    alpha = np.zeros((len(score), 2))
    for t in range(longest):
        at = starts[: live[t]] + t
        emit = np.stack((np.zeros(len(at)), score[at]), 1)
        alpha[at] = emit + (start if t == 0 else np.logaddexp(alpha[at - 1][:, :1] + moves[0], alpha[at - 1][:, 1:] + moves[1]))
    beta = np.zeros((n, 2))
    total = np.logaddexp.reduce(alpha[starts + lengths - 1], 1)
    p1, pair = np.zeros(len(score)), np.zeros((2, 2))
    for t in range(longest - 1, -1, -1):
        k = live[t]
        at = starts[:k] + t
        p1[at] = np.exp(alpha[at, 1] + beta[:k, 1] - total[:k])
        if t:
            emit = np.stack((np.zeros(k), score[at]), 1) + beta[:k]
            pair += np.exp(alpha[at - 1][:, :, None] + moves + emit[:, None, :] - total[:k, None, None]).sum(0)
            beta[:k] = np.logaddexp(moves[:, 0] + emit[:, :1], moves[:, 1] + emit[:, 1:])
    return p1, pair, np.array([1 - p1[starts], p1[starts]]).sum(1)


class _Ascent:
    """Adam, upwards."""

    def __init__(self, now: list[np.ndarray], rate: float) -> None:
        self.now, self.rate, self.step = now, rate, 0
        self.m, self.v = [np.zeros_like(p) for p in now], [np.zeros_like(p) for p in now]

    def go(self, gradients: list[np.ndarray]) -> None:
        self.step += 1
        for i, g in enumerate(gradients):
            self.m[i] = 0.9 * self.m[i] + 0.1 * g
            self.v[i] = 0.99 * self.v[i] + 0.01 * g * g
            self.now[i] = self.now[i] + self.rate * (self.m[i] / (1 - 0.9**self.step)) / (np.sqrt(self.v[i] / (1 - 0.99**self.step)) + 1e-8)


def fit(
    x: np.ndarray, bad: np.ndarray, lines: np.ndarray, words: np.ndarray, share: float = BAD_SHARE, turns: int = 3, steps: int = 40, rate: float = 0.15, l2: float = 1e-4
) -> Chain:
    """The chain of texts (lines: rows of x of each; words: of each line) of which it is known whether they are bad."""
    owner = np.repeat(np.arange(len(lines)), lines)
    starts = np.concatenate(([0], np.cumsum(lines)))[:-1]
    order = np.argsort(-lines, kind="stable")
    starts_by, lengths_by = starts[order], lines[order]
    # the lines of bad documents; before the first turn each line is taken by itself, with its document's label
    loose = bad[owner]
    owner_of, lines_of, words_of = np.repeat(np.arange(bad.sum()), lines[bad]), lines[bad], words[loose]
    enough = share * np.bincount(owner_of, words_of)
    y = loose.astype(np.float64)
    alone = _Ascent([np.zeros(x.shape[1])], rate)
    for _ in range(2 * steps):
        alone.go([x.T @ (y - 1 / (1 + np.exp(-(x @ alone.now[0])))) / len(y) - l2 * alone.now[0]])
    climb = _Ascent([alone.now[0], np.zeros((2, 2)), np.zeros(2)], rate)
    inner = np.setdiff1d(np.arange(len(owner)), starts)
    for _ in range(turns):
        weights, moves, start = climb.now
        score, low, high = (x @ weights)[loose], np.zeros(len(lines_of)), np.full(len(lines_of), 64.0)
        told = lambda shift: viterbi(score + shift[owner_of], moves, start, lines_of)  # noqa: B023, E731
        high[np.bincount(owner_of, told(low) * words_of) >= enough] = 0.0
        for _ in range(10):
            mid = (low + high) / 2
            met = np.bincount(owner_of, told(mid) * words_of) >= enough
            high, low = np.where(met, mid, high), np.where(met, low, mid)
        label = np.zeros(len(owner), np.int64)
        label[loose] = told(high)
        seen = np.zeros((2, 2))
        np.add.at(seen, (label[inner - 1], label[inner]), 1)
        want = (x.T @ label.astype(np.float64), seen, np.bincount(label[starts], minlength=2).astype(float))
        for _ in range(steps):
            p1, pair, begin = _expect(x @ climb.now[0], climb.now[1], climb.now[2], starts_by, lengths_by)
            climb.go([(w - h) / len(owner) - l2 * p for w, h, p in zip(want, (x.T @ p1, pair, begin), climb.now, strict=True)])
    return Chain(*climb.now)


def train(documents: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, train_bytes: int = TRAIN_BYTES) -> Chain | None:
    """Fit the chain on a bounded sample of the labelled documents; a doc_id with several labels has the highest."""
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality").cast("double")).alias("label"))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offs in C.text_chunks(batches):
            got = measure(data, offs)
            y = np.asarray(batch.column(0)) <= 0
            cut = np.concatenate(([0], np.cumsum(got["lines"])))
            x, k = np.packbits(got["x"].astype(bool), axis=1), got["line_words"].astype("<u4")
            rows = [(bool(y[i]), int(got["lines"][i]), x[a:b].tobytes(), k[a:b].tobytes()) for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]
            types = (pa.bool_(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["bad", "lines", "x", "words"])

    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = C.training_texts(source, known, max_train, train_bytes).mapInArrow(lines, "bad boolean, lines long, x binary, words binary").collect()
    if len({r.bad for r in rows}) < 2:
        return None
    rows.sort(key=lambda r: (r.bad, r.lines, bytes(r.x), bytes(r.words)))
    counts = np.array([r.lines for r in rows])
    packed = np.frombuffer(b"".join(bytes(r.x) for r in rows), np.uint8).reshape(int(counts.sum()), -1)
    x = np.unpackbits(packed, axis=1, count=len(FEATURES)).astype(np.float32)
    return fit(x, np.array([r.bad for r in rows]), counts, np.frombuffer(b"".join(bytes(r.words) for r in rows), "<u4").astype(np.float64))


def judge(documents: DataFrame, chain: Chain | None, content_share: float = CONTENT_SHARE, min_words: int = MIN_WORDS) -> DataFrame:
    """One row of RESULT per document row."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offs in C.text_chunks(batches):
            got = measure(data, offs)
            label = chain.decode(got["x"], got["lines"]) if chain is not None else np.zeros(len(got["x"]), np.int8)
            good = label == 0
            n = len(offs) - 1
            content = np.bincount(got["line_row"][good], got["line_words"][good], n).astype(np.int64)
            words = got["n_words"]
            failed = (words < min_words) | (100 * got["n_repeat_words"] > 50 * words)
            kept = ~failed & (content >= content_share * words)
            counts = [words, got["word_chars"], got["n_symbols"], got["n_dup_lines"], got["n_repeat_words"]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c.astype(np.int64)) for c in counts), pa.array(failed), pa.array(content), pa.array(got["lines"].astype(np.int64)), pa.array(np.bincount(got["line_row"][good], minlength=n).astype(np.int64)), pa.array(kept)],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "content_words", "n_lines", "n_content_lines", "kept"],
            )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, RESULT)


def keep_documents(documents: DataFrame, chain: Chain | None, content_share: float = CONTENT_SHARE) -> DataFrame:
    """The rows of documents that are kept, with all their columns, in one pass over the text."""
    schema, at = documents.schema, documents.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = C.utf8(batch.column(at))
            for i, j in C.row_ranges(offs):
                part, o = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
                got = measure(part, o)
                good = (chain.decode(got["x"], got["lines"]) if chain is not None else np.zeros(len(got["x"]), np.int8)) == 0
                content = np.bincount(got["line_row"][good], got["line_words"][good], j - i)
                words = got["n_words"]
                ok = (words >= MIN_WORDS) & (100 * got["n_repeat_words"] <= 50 * words) & (content >= content_share * words)
                yield batch.slice(i, j - i).filter(pa.array(ok))

    return documents.mapInArrow(keep, schema)
