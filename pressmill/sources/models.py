"""Interfaces of the external models (layout, transcription, word boxes, text classes) and deterministic fakes for tests.

A model is made once in each Python worker by a factory, so that only the factory travels; the request step runs in
`concurrency` tasks, and answers are kept by request key, so that a second run asks only for what is missing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame


class LayoutModel(Protocol):
    def detect(self, page_id: str, image: bytes) -> list[dict]: ...


class OcrModel(Protocol):
    def transcribe(self, image: bytes, region_class: str, prompt: str, max_tokens: int) -> dict: ...


class WordBoxModel(Protocol):
    def words(self, image: bytes) -> list[dict]: ...


class TextClassifier(Protocol):
    def logits(self, texts: list[str]) -> list[list[float]]: ...


class FakeOcr:
    """Answers with words made from the image's hash."""

    def transcribe(self, image: bytes, region_class: str, prompt: str, max_tokens: int) -> dict:
        h = hashlib.sha256(image + prompt.encode()).hexdigest()
        text = " ".join(h[k : k + 5] for k in range(0, 30, 5))
        return {"content": text, "finish_reason": "stop", "prompt_tokens": len(prompt), "completion_tokens": 6}


class FakeLayout:
    def detect(self, page_id: str, image: bytes) -> list[dict]:
        h = hashlib.sha256(page_id.encode()).digest()
        return [{"class": ("title", "plain text", "figure")[h[k] % 3], "confidence": h[k + 1] / 255, "x1": 10.0 * k, "y1": float(h[k + 2]), "x2": 10.0 * k + 200, "y2": h[k + 2] + 120.0} for k in range(0, 12, 3)]


class FakeWords:
    """Words from the image's hash, three to a line; an empty image is broken."""

    def words(self, image: bytes) -> list[dict]:
        if not image:
            raise ValueError("no image")
        h = hashlib.sha256(image).hexdigest()
        spots = [(60.0 * (k % 3), 30.0 * (k // 3)) for k in range(6)]
        return [{"text": h[5 * k : 5 * k + 5], "conf": 90.0, "line": k // 3, "x1": x, "y1": y, "x2": x + 50, "y2": y + 20} for k, (x, y) in enumerate(spots)]


class FakeClassifier:
    def __init__(self, classes: int) -> None:
        self.classes = classes

    def logits(self, texts: list[str]) -> list[list[float]]:
        return [[float(b) / 64 for b in hashlib.sha256(t.encode()).digest()[: self.classes]] for t in texts]


ANSWER = "content string, finish_reason string, prompt_tokens int, completion_tokens int"


def ask(requests: DataFrame, factory: Callable[[], OcrModel], answered: DataFrame | None = None, concurrency: int = 2, tries: int = 3, problem: Callable[[str, dict], str | None] | None = None, again: int = 2, order: Sequence[str] = ()) -> DataFrame:
    """request_key and ANSWER for requests (request_key, image, region_class, prompt, max_tokens) that aren't in `answered`; answers kept so far are added.

    An answer in which `problem` (of class and answer) finds something is asked for again, up to `again` times, each time with
    twice the tokens; if that fails, the last answer stays. Within a task requests go out by the columns of `order`.
    """
    columns = ["request_key", "image", "region_class", "prompt", "max_tokens"]
    todo = requests.select(*columns, *order).dropDuplicates(["request_key"])
    if answered is not None:
        todo = todo.join(answered.select("request_key"), "request_key", "left_anti")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for part in frames:
            rows = []
            for key, image, kind, prompt, most in part[columns].itertuples(index=False):
                for left in range(tries - 1, -1, -1):
                    try:
                        got = model.transcribe(bytes(image), kind, prompt, int(most))
                        break
                    except (ConnectionError, TimeoutError):
                        if not left:
                            raise
                for attempt in range(1, again + 1):
                    if problem is None or problem(kind, got) is None:
                        break
                    try:
                        got = model.transcribe(bytes(image), kind, prompt, int(most) * 2**attempt)
                    except Exception:
                        break
                rows.append((key, got["content"], got["finish_reason"], got["prompt_tokens"], got["completion_tokens"]))
            yield pd.DataFrame(rows, columns=["request_key", "content", "finish_reason", "prompt_tokens", "completion_tokens"])

    kind = dict(requests.dtypes)["request_key"]
    tasks = todo.repartition(concurrency)
    new = (tasks.sortWithinPartitions(*order) if order else tasks).mapInPandas(run, f"request_key {kind}, {ANSWER}")
    return new if answered is None else answered.unionByName(new)


def detect(pages: DataFrame, factory: Callable[[], LayoutModel]) -> DataFrame:
    """Detections of pages (page_id, image), one row per box."""
    schema = f"page_id {dict(pages.dtypes)['page_id']}, class string, confidence double, x1 double, y1 double, x2 double, y2 double"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for part in frames:
            rows = [{"page_id": p} | d for p, image in zip(part["page_id"], part["image"], strict=True) for d in model.detect(str(p), bytes(image))]
            yield pd.DataFrame(rows, columns=["page_id", "class", "confidence", "x1", "y1", "x2", "y2"])

    return pages.select("page_id", "image").mapInPandas(run, schema)
