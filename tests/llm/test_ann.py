import math

import numpy as np

from tests.llm.common import rows_of
from tripmart.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(vectors: dict, queries, k=5):
    out = {}
    for q in queries:
        a = np.array(vectors[q], np.float64)
        scored = []
        for i, v in vectors.items():
            if i != q:
                b = np.array(v, np.float64)
                scored.append((-round(float(a @ b / math.sqrt(a @ a) / math.sqrt(b @ b)), 12), i))
        out[q] = [i for _, i in sorted(scored)[:k]]
    return out


def test_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAF", 16)
    monkeypatch.setattr(ann, "BLOCK", 100)
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(12, 16))
    vectors = {i: (centres[i % 12] + 0.3 * draw.normal(size=16)).astype(np.float32).tolist() for i in range(900)}
    frame = spark.createDataFrame([(i, v, 0) for i, v in vectors.items()], SCHEMA)
    result, about = ann.nearest_neighbours(frame, "vec_id % 50 = 0")
    got = {}
    for q, rank, i, score in rows_of(result):
        got.setdefault(q, {})[rank] = (i, score)
    want = brute(vectors, [i for i in vectors if i % 50 == 0])
    assert got.keys() == want.keys() and all(sorted(g) == [1, 2, 3, 4, 5] for g in got.values())
    hits = sum(len({i for i, _ in got[q].values()} & set(want[q])) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    assert about["visits"] < about["leaves"] and about["recall"] >= ann.TARGET
    for q, own in got.items():
        for i, score in own.values():
            a, b = np.array(vectors[q]), np.array(vectors[i])
            assert abs(score - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-9


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (50, [0.0, 0.0]), (100, None), (150, []), (1, [nan, 1.0]), (2, [inf, 1.0]), (3, [None, 1.0]),
        (4, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (9, [2.0, 1.0]), (8, [2.0, 1.0]), (7, [0.0, 1.0]), (7, [0.0, 1.0]),
    ]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).withColumnRenamed("label", "rank")
    result, _ = ann.nearest_neighbours(frame, "vec_id % 50 = 0")
    got = [(q, rank, i) for q, rank, i, _ in sorted(rows_of(result))]
    # Equal vectors go by id; a repeated row is repeated.
    assert got == [(0, 1, 8), (0, 2, 9), (0, 3, 7), (0, 4, 7)]


def test_empty_and_single(spark):
    empty, _ = ann.nearest_neighbours(spark.createDataFrame([], SCHEMA), "vec_id % 50 = 0")
    assert empty.collect() == []
    single, _ = ann.nearest_neighbours(spark.createDataFrame([(0, [1.0], 0)], SCHEMA), "vec_id % 50 = 0")
    assert single.collect() == []


def test_many_equal_vectors_give_the_smallest_ids(spark):
    frame = spark.createDataFrame([(i, [1.0, 1.0], 0) for i in range(200)] + [(1000, [1.0, 0.9], 0)], SCHEMA)
    result, _ = ann.nearest_neighbours(frame, "vec_id = 100 or vec_id = 1000")
    got = {}
    for q, rank, i, _ in rows_of(result):
        got.setdefault(q, []).append((rank, i))
    assert sorted(got[100]) == [(i + 1, i) for i in range(5)] and sorted(got[1000]) == [(i + 1, i) for i in range(5)]
