"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram is bound by
multiplying its letters' vectors, rotated by two, one and no places; a text or
a language is the bundle (sum) of its trigrams. Texts are compared with the
language prototypes by cosine.

The dot product of a text's bundle with a prototype is the sum, over the
text's trigrams, of the products of trigram vector and prototype. These
products are computed once per trigram, so a text costs one table lookup per
letter and never an explicit vector. Since all cosines of a text share its
norm, the best language and the score, the best cosine's share of the positive
ones, are those of the explicit vectors.

Defined results: null text or text without a letter is ``und`` with score 0,
as is every text if no language was learned. Rows repeat as they come, ties
between languages go to the smaller name, further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
#: Places of a vector and number of letters kept apart; other letters share slots.
PLACES = 4096
LETTERS = 64
#: Weight of one training text in whole units, so that sums do not depend on their order.
UNITS = 1_000_000
#: Characters handled in one vectorised step; a longer text is a step of its own.
STEP = 1 << 20


@lru_cache(1)
def _slots() -> np.ndarray:
    """Slot of every code point: 0 for non-letters, 1 to 26 for a to z, the rest dealt out."""
    slots = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        if (own := chr(code)).isalpha():
            low = ord(own.lower()[0])
            slots[code] = low - 96 if 97 <= low <= 122 else 27 + (low * 2654435761 >> 7) % (LETTERS - 27)
    return slots


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all trigrams around a letter, and the first trigram of each text."""
    joined = "\n".join(texts)
    slots = _slots()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    # A text's edge counts as a blank, like any run of other characters.
    slots = np.concatenate([[0], slots, [0]]).astype(np.int32)
    middle = np.flatnonzero(slots[1:-1]) + 1
    codes = (slots[middle - 1] * LETTERS + slots[middle]) * LETTERS + slots[middle + 1]
    return codes, np.searchsorted(middle - 1, starts)


def _texts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Rows in steps: the number of the first and the texts, null as empty."""
    first, held, size = 0, [], 0
    for i, text in enumerate(column):
        held.append(text.as_py() or "")
        size += len(held[-1])
        if size >= STEP:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def _profile(batches):
    """Weights of trigrams by language, summed inside the task."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for at, texts in _texts(batch.column("text")):
            codes, first = trigrams(texts)
            for i in range(len(texts)):
                own = codes[first[i] : first[i + 1]]
                if len(own):
                    grams, counts = np.unique(own, return_counts=True)
                    if langs[at + i] not in total:
                        total[langs[at + i]] = np.zeros(LETTERS**3, np.int64)
                    total[langs[at + i]][grams] += counts * UNITS // len(own)
    for lang, weights in total.items():
        grams = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(weights[grams])],
            ["lang", "gram", "weight"],
        )


def letter_vectors(places: int = PLACES, seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).choice(np.array([-1.0, 1.0], np.float32), (LETTERS, places))


def _bound(vectors: np.ndarray, first: int, second: int) -> np.ndarray:
    return np.roll(vectors[first], 2) * np.roll(vectors[second], 1)


def prototypes(weights: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The bundles of languages (rows) from their trigram weights, each of length one."""
    shaped = weights.reshape(len(weights), LETTERS, LETTERS, LETTERS)
    out = np.zeros((len(weights), vectors.shape[1]))
    for a in range(LETTERS):
        for b in range(LETTERS):
            if shaped[:, a, b].any():
                out += _bound(vectors, a, b) * (shaped[:, a, b] @ vectors)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-30)


def products(protos: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Dot product of every trigram's vector with every prototype."""
    out = np.zeros((LETTERS, LETTERS, LETTERS, len(protos)), np.float32)
    for a in range(LETTERS):
        for b in range(1, LETTERS):
            out[a, b] = vectors @ (_bound(vectors, a, b) * protos).T.astype(np.float32)
    return out.reshape(LETTERS**3, len(protos))


def learn(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and trigram products from all rows of ``labelled`` (text, lang).

    The driver gets one row per language and trigram seen (at most 2**18 a language).
    """
    rows = (
        labelled.where("lang is not null and text is not null")
        .select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
        .mapInArrow(_profile, "lang string, gram bigint, weight bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("weight").alias("weight"))
        .toPandas()
    )
    langs = sorted(rows["lang"].unique())
    weights = np.zeros((len(langs), LETTERS**3))
    weights[rows["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(int), rows["gram"].to_numpy(int)] = rows["weight"]
    weights /= np.maximum(weights.sum(axis=1, keepdims=True), 1)
    vectors = letter_vectors()
    return langs, products(prototypes(weights, vectors), vectors)


def _predict(model):
    def run(batches):
        langs, table = model.value
        for batch in batches:
            names, scores = [], []
            for _, texts in _texts(batch.column("text")):
                codes, first = trigrams(texts)
                some = np.flatnonzero(first[1:] > first[:-1]) if langs else np.zeros(0, int)
                name, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                if len(some):
                    cosine = np.maximum(np.add.reduceat(table[codes].astype(np.float64), first[some]), 0)
                    best = cosine.argmax(axis=1)
                    whole = cosine.sum(axis=1)
                    score[some] = np.round(cosine[np.arange(len(some)), best] / np.where(whole > 0, whole, 1), 6)
                    for i, b in zip(some, best):
                        name[i] = langs[b]
                names += name
                scores += list(score)
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["doc_id", "held_out"]).columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def identify(docs: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs`` (doc_id, text, lang).

    Rows whose crc32 of doc_id leaves ``held_out`` modulo ``folds`` are not
    learned from. A null doc_id is held out and reported as held_out null.
    """
    mine = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
        (F.crc32(F.col("doc_id").cast("string")) % folds == held_out).alias("held_out"),
    )
    model = docs.sparkSession.sparkContext.broadcast(learn(mine.where("not held_out")))
    return mine.select("doc_id", "held_out", "text").mapInArrow(
        _predict(model), "doc_id bigint, held_out boolean, lang_pred string, score double"
    )
