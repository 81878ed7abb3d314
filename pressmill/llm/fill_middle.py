"""Fill-in-the-middle transformation by an Aho-Corasick event scan.

A unit is a run of ASCII letters or one other code point. One automaton holds every pair of ASCII characters of which one
is a letter and the other not, and the sentinels; a single scan of a text yields the few places at which letters begin or
end, and whether a sentinel stands in it. Other code points are read as '?', one for one, so places are code points and a
pair with a letter still shows. Between two events the units need no look: letters make one unit, other characters one
each. So the units before an event are a running sum over the events, and the place that has a given number of units
before it is found by a binary search among them plus the rest of the gap.

Each text is cut at two ranks drawn from its doc_id into prefix, middle and suffix, which are put out with sentinels in
the order prefix, suffix, middle (psm) or suffix, prefix, middle (spm); some stay plain. Texts are handled one at a time,
from Arrow batches cut into small ranges, so memory follows the longest text. Nothing is shuffled.

Edge cases: a null text counts as empty, an empty one is plain, and so is one that holds a sentinel; a very long text is
one text like any other (its events are held as one integer each); a null doc_id draws from the empty number; repeated
rows give repeated results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "1"
PLAIN_FROM = 90  # of 100 draws, those from here on stay plain
SPM_BELOW = 20  # of 100 draws, those below are suffix first

RESULT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

_BEGIN, _END, _SENTINEL = 0, 1, 2


@cache
def automaton() -> ahocorasick.Automaton:
    """Pairs of ASCII characters that change the class, by what they mean, and the sentinels."""
    out = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    letters = string.ascii_letters
    for other in map(chr, range(128)):
        if other not in letters:
            for letter in letters:
                out.add_word(other + letter, _BEGIN)
                out.add_word(letter + other, _END)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        out.add_word(mark, _SENTINEL)
    out.make_automaton()
    return out


@dataclass
class Events:
    """Places in a text at which the class changes (0 and the end among them) and the number of units before each."""

    at: np.ndarray
    units: np.ndarray
    sentinel: bool

    @property
    def n(self) -> int:
        return int(self.units[-1])

    def place(self, rank: int) -> int:
        """The code point that has `rank` units before it."""
        k = int(np.searchsorted(self.units, rank, "right")) - 1
        return int(self.at[k]) + rank - int(self.units[k])


def events(text: str) -> Events:
    # the blank before and behind makes letters at either end events as well; a pair's second character stands at `end` - 1
    ascii_text = f" {text.encode('ascii', 'replace').decode('ascii')} "
    found = np.fromiter((3 * end + kind for end, kind in automaton().iter(ascii_text)), np.int64)
    kind, at = found % 3, found // 3 - 1
    begins, ends = at[kind == _BEGIN], at[kind == _END]
    places = np.empty(2 * len(begins) + 2, np.int64)
    places[0], places[1:-1:2], places[2:-1:2], places[-1] = 0, begins, ends, len(text)
    gaps = np.diff(places)
    gaps[1::2] = 1  # a run of letters
    return Events(places, np.concatenate(([0], np.cumsum(gaps))), bool((kind == _SENTINEL).any()))


def draws(doc_id: int | None) -> list[int]:
    """h1 to h4 of a document."""
    digest = hashlib.sha256(f"{SEED}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def transformed(doc_id: int | None, text: str) -> tuple[int, str, int | None, int | None, str]:
    """n, form, code points of prefix and middle (None if plain) and output."""
    found, (h1, h2, h3, h4) = events(text), draws(doc_id)
    n = found.n
    if not text or found.sentinel or h3 % 100 >= PLAIN_FROM:
        return n, "plain", None, None, text
    a, b = (found.place(rank) for rank in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SPM_BELOW:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def transform(documents: DataFrame) -> DataFrame:
    """One row of RESULT for each document row."""
    names = [c.split()[0] for c in RESULT.split(", ")]
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _ in C.text_chunks(batches):
            ids = batch.column(0).to_pylist()
            rows = [(i, *transformed(i, t)) for i, t in zip(ids, map(lambda t: t.as_py() or "", batch.column(1)), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, RESULT)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made of. Parts hold no sentinel, so the first of each kind is the one put in."""
    out = F.col(output)
    from_char = lambda text, k: F.substring(text, k, 2**31 - 1)
    first, second = from_char(out, len(PREFIX) + 1), F.when(F.col(form) == "psm", F.lit(SUFFIX)).otherwise(F.lit(PREFIX))
    one = F.call_function("substring_index", first, second, F.lit(1))
    rest = from_char(first, F.char_length(one) + len(SUFFIX) + 1)
    two = F.substring_index(rest, MIDDLE, 1)
    middle = from_char(rest, F.char_length(two) + len(MIDDLE) + 1)
    return F.when(F.col(form) == "plain", out).when(F.col(form) == "psm", F.concat(one, middle, two)).otherwise(F.concat(two, middle, one))


def digests(documents: DataFrame) -> DataFrame:
    """The transformed documents with digests in place of texts, the restored text's among them."""
    sha = lambda text: F.sha2(F.encode(text, "UTF-8"), 256)
    out = transform(documents)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored()).alias("restored_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
e AS (SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u,
  CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
f AS (SELECT *, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM e),
g AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM f)
SELECT doc_id, CAST(len(u) AS BIGINT) AS n, form,
  CASE WHEN form != 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form != 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM g
"""
