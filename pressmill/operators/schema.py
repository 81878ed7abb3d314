"""Documents against a JSON schema: the keywords that document formats use, messages sorted by place."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame

TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "integer": int, "number": (int, float), "null": type(None)}


def _is(value: Any, kind: str) -> bool:
    if isinstance(value, bool):
        return kind == "boolean"
    return isinstance(value, TYPES[kind]) or (kind == "integer" and isinstance(value, float) and value.is_integer())


def _faults(value: Any, rule: Any, root: dict, at: tuple) -> Iterator[tuple[tuple, str]]:
    if rule is True or rule is False:
        if not rule:
            yield at, "nothing is allowed here"
        return
    if "$ref" in rule:
        target = root
        for step in rule["$ref"].lstrip("#").strip("/").split("/"):
            target = target[step] if step else target
        yield from _faults(value, target, root, at)
        return
    kinds = rule.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        yield at, f"{json.dumps(value)[:100]} is not of type {' or '.join(kinds)}"
        return
    if "const" in rule and value != rule["const"]:
        yield at, f"{json.dumps(rule['const'])} was expected"
    if "enum" in rule and value not in rule["enum"]:
        yield at, f"{json.dumps(value)[:100]} is none of {json.dumps(rule['enum'])}"
    if isinstance(value, str) and "pattern" in rule and not re.search(rule["pattern"], value):
        yield at, f"{json.dumps(value)[:100]} does not match {rule['pattern']}"
    if _is(value, "number"):
        if "minimum" in rule and value < rule["minimum"]:
            yield at, f"{value} is less than {rule['minimum']}"
        if "exclusiveMinimum" in rule and value <= rule["exclusiveMinimum"]:
            yield at, f"{value} is not more than {rule['exclusiveMinimum']}"
    if isinstance(value, list):
        if len(value) < rule.get("minItems", 0):
            yield at, f"fewer than {rule['minItems']} items"
        if isinstance(rule.get("items", None), (dict, bool)):
            for k, item in enumerate(value):
                yield from _faults(item, rule["items"], root, (*at, k))
    if isinstance(value, dict):
        for name in rule.get("required", []):
            if name not in value:
                yield at, f"{name} is missing"
        known = rule.get("properties", {})
        for name, inner in value.items():
            if name in known:
                yield from _faults(inner, known[name], root, (*at, name))
            elif "additionalProperties" in rule:
                yield from _faults(inner, rule["additionalProperties"], root, (*at, name))
    for part in rule.get("allOf", []):
        yield from _faults(value, part, root, at)
    for word, fits in (("anyOf", lambda n: n > 0), ("oneOf", lambda n: n == 1)):
        if word in rule and not fits(sum(next(_faults(value, part, root, at), None) is None for part in rule[word])):
            yield at, f"does not fit {word}"


def faults(document: str | None, schema: dict) -> list[str]:
    """'place: message' for each fault, by place; '<root>' is the document itself, which may also be no JSON."""
    try:
        value = json.loads(document or "")
    except ValueError:
        return ["<root>: no JSON"]
    found = sorted(_faults(value, schema, schema, ()), key=lambda f: ([(isinstance(s, str), s) for s in f[0]], f[1]))
    return [f"{'/'.join(map(str, at)) or '<root>'}: {message}" for at, message in found]


def schema_faults(documents: DataFrame, key: str, column: str, schema: dict) -> DataFrame:
    """key and `faults` (ARRAY<STRING>, empty if valid) of JSON documents; keywords outside this module's are not looked at. No shuffle."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in frames:
            yield pd.DataFrame({key: part[key], "faults": [faults(d, schema) for d in part[column]]})

    return documents.select(key, column).mapInPandas(run, f"`{key}` {dict(documents.dtypes)[key]}, faults array<string>")
