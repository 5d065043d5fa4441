"""Frames of awkward rows and brute-force versions shared by the tests."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
_UPPER = {i: i + 32 for i in range(65, 91)}


def docs_of(spark, texts, first: int = 0):
    """Documents of texts, numbered from ``first``; a pair gives its own id."""
    rows = []
    for i, text in enumerate(texts, first):
        own, text = text if isinstance(text, tuple) else (i, text)
        rows.append((own, text, "en", "s", None if text is None else len(text)))
    return spark.createDataFrame(rows, DOCS)


def clashing(frame):
    """The frame with columns named like those that operators add themselves."""
    for name in ("score", "anchor", "entry", "pivot", "component_id", "copy_of", "n", "blob", "spans", "host", "path"):
        frame = frame.withColumn(name, F.lit("x"))
    return frame


def shingles(text, k: int = 5) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_UPPER))
    if len(words) >= k:
        return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return frozenset([tuple(words)] if words else [])


def smallest_reachable(ids, links) -> dict:
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def rows_of(frame) -> list[tuple]:
    return [tuple(r) for r in frame.collect()]
