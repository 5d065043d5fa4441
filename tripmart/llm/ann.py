"""Nearest neighbours with a hierarchical k-means tree and best-bin-first search.

Index. Vectors are brought to length one and equal vectors (same components)
are one entry, which keeps the smallest ids only as far as a result can need
them. The tree is fitted on at most SAMPLE entries (those with the smallest
hash) and has at most SAMPLE / LEAF * 2 leaves; every entry is placed in a leaf
by descending to the nearest centre.

Search. A query walks the tree with a priority queue: it descends to the
nearest child and queues the others by distance, so leaves come in a best-first
order. The number of leaves to visit is widened until the recall of calibration
queries, held against an exact search over all rows, reaches the target; all
queries then visit that many. Small leaves share a shelf, shelves are cut into
blocks of entries and of queries, so neither a full leaf nor a much visited one
meets in one task.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part, neither do rows with a null id or of another length
than most; fewer candidates than wanted give fewer rows; ties go to the smaller
id. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.shared import stored

#: Entries on which the tree is fitted, entries of a leaf of the fit, children of a node.
SAMPLE, LEAF, BRANCH = 20_000, 64, 8
#: Calibration queries and their target recall.
CALIBRATION, TARGET = 100, 0.97
#: Entries and queries that meet in one task.
BLOCK = 4096


class Tree:
    """Hierarchical k-means over unit vectors; nodes are numbered, leaves apart."""

    def __init__(self, sample: np.ndarray, seed: int = 11):
        self.centres: list[np.ndarray] = []  # of a node's children
        self.children: list[list[int]] = []  # a node's number, or -1 - leaf
        self.leaves = 0
        self._random = np.random.default_rng(seed)
        self.root = self._grow(sample)

    def _leaf(self) -> int:
        self.leaves += 1
        return -self.leaves

    def _grow(self, points: np.ndarray) -> int:
        if len(points) <= LEAF:
            return self._leaf()
        centres, of = self._split(points)
        if np.bincount(of, minlength=len(centres)).max() == len(points):
            return self._leaf()
        node = len(self.centres)
        self.centres.append(centres)
        self.children.append([])
        self.children[node] = [self._grow(points[of == i]) for i in range(len(centres))]
        return node

    def _split(self, points: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
        centres = points[self._random.choice(len(points), min(BRANCH, len(points)), replace=False)]
        for _ in range(rounds):
            of = (points @ centres.T).argmax(axis=1)
            sums = np.zeros_like(centres)
            np.add.at(sums, of, points)
            long = np.linalg.norm(sums, axis=1, keepdims=True)
            centres = np.where(long > 0, sums / np.maximum(long, 1e-12), centres)
        return centres, (points @ centres.T).argmax(axis=1)

    def place(self, points: np.ndarray) -> np.ndarray:
        """Leaf of each point by descending to the nearest centre."""
        out = np.zeros(len(points), np.int64)
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -1 - node
                continue
            of = (points[rows] @ self.centres[node].T).argmax(axis=1)
            todo += [(child, rows[of == i]) for i, child in enumerate(self.children[node]) if (of == i).any()]
        return out

    def order(self, point: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves in best-bin-first order."""
        queue, out = [(0.0, self.root)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            if node < 0:
                out.append(-1 - node)
                continue
            near = self.centres[node] @ point
            for distance, child in zip(1 - near, self.children[node]):
                heapq.heappush(queue, (float(distance), child))
        return out


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _unit(points: np.ndarray) -> np.ndarray:
    return points / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-300)


def _place(tree):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            leaf = tree.value.place(_unit(_matrix(batch.column("v"))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], [*batch.schema.names, "leaf"])

    return run


def _visit(tree, most: int, shelves: list[int]):
    """One row per query and shelf with the leaves to visit there."""
    shelf_of = np.array(shelves)

    def run(batches):
        for batch in batches:
            rows = batch.column("query_id").to_pylist()
            picked, shelf, leaves = [], [], []
            for i, point in enumerate(_unit(_matrix(batch.column("v")))):
                order = np.array(tree.value.order(point, most))
                for s in np.unique(shelf_of[order]):
                    picked.append(i)
                    shelf.append(s)
                    leaves.append(order[shelf_of[order] == s])
            v = batch.column("v").take(pa.array(picked, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([rows[i] for i in picked], pa.int64()),
                    v,
                    pa.array(shelf, pa.int64()),
                    pa.array(leaves, pa.list_(pa.int64())),
                ],
                ["query_id", "v", "shelf", "leaves"],
            )

    return run


def _nearest(k: int):
    """Per query the k + 1 best entries of its leaves in a block, by cosine in double precision."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        q, x = left.combine_chunks(), right.combine_chunks()
        out: list[list] = [[], [], [], []]
        if q.num_rows and x.num_rows:
            a, b = (_matrix(t.column("v").combine_chunks()) for t in (q, x))
            unit, norms = _unit(b), np.linalg.norm(b, axis=1)
            own, ids, leaf = (c.to_numpy() for c in (q.column("query_id"), x.column("entry"), x.column("leaf")))
            for i, leaves in enumerate(q.column("leaves").to_pylist()):
                there = np.flatnonzero(np.isin(leaf, leaves))
                if not len(there):
                    continue
                point = a[i]
                # Blocks find the best; each kept cosine is then summed on its own,
                # so that equal vectors score equally wherever they lie.
                near = unit[there] @ (point / np.linalg.norm(point))
                take = min(len(near), k + 1)
                best = there[near >= np.partition(near, len(near) - take)[len(near) - take] - 1e-12]
                score = (b[best] * point).sum(axis=1) / (norms[best] * np.linalg.norm(point))
                keep = np.lexsort((ids[best], -score))[: k + 1]
                for j, s in zip(best[keep], score[keep]):
                    for column, value in zip(out, (own[i], ids[j], s, leaf[j])):
                        column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_id", "entry", "score", "leaf"), out, kinds)})

    return run


_ENTRY = "v array<double>, ids array<bigint>, entry bigint"
_FOUND = "query_id bigint, entry bigint, score double, leaf bigint"
_VISIT = "query_id bigint, v array<double>, shelf bigint, leaves array<bigint>"


def _shelves(entries: DataFrame, leaves: int) -> list[int]:
    """Shelf of each leaf: neighbouring leaves share one while they hold up to BLOCK entries."""
    held = {r["leaf"]: r["count"] for r in entries.groupBy("leaf").count().collect()}
    out, shelf, full = [], 0, 0
    for leaf in range(leaves):
        n = held.get(leaf, 0)
        if full and full + n > BLOCK:
            shelf, full = shelf + 1, 0
        out.append(shelf)
        full += n
    return out


def _search(visits: DataFrame, entries: DataFrame, shelves: list[int], k: int) -> DataFrame:
    """The k + 1 best entries of each query among the leaves it visits.

    A shelf is cut into blocks of entries and parts of queries; each block
    meets each part in one task.
    """
    spark = entries.sparkSession
    places = F.broadcast(spark.createDataFrame(list(enumerate(shelves)), "leaf bigint, shelf bigint"))
    there = entries.join(places, "leaf")
    asked = visits.groupBy("shelf").agg(F.count("*").alias("q"))
    held = there.groupBy("shelf").agg(F.count("*").alias("n"))
    parts = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    cuts = asked.join(held, "shelf").select("shelf", parts("n").alias("blocks"), parts("q").alias("parts"))
    cuts = F.broadcast(stored(cuts, "ann-cuts"))  # a row per shelf, of which there are fewer than leaves

    def numbers(n):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n).cast("bigint") - 1))

    left = visits.join(cuts, "shelf").withColumn("part", F.pmod(F.xxhash64("query_id"), "parts"))
    left = left.select("query_id", "v", "leaves", "shelf", "part", numbers("blocks").alias("block"))
    right = there.join(cuts, "shelf").withColumn("block", F.pmod(F.xxhash64("entry"), "blocks"))
    right = right.select("entry", "v", "leaf", "shelf", "block", numbers("parts").alias("part"))
    keys = ("shelf", "block", "part")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_nearest(k), _FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "entry")
    return found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)


def clean_vectors(rows: DataFrame) -> DataFrame:
    """vec_id and v (doubles) of the rows that take part."""
    rows = rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")
    ).where("vec_id is not null and size(v) > 0")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite & F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (common["d"] if common else 0))


def nearest_neighbours(rows: DataFrame, is_query, k: int = 5, target: float = TARGET) -> tuple[DataFrame, dict]:
    """query_id, rank, vec_id, score for rows (vec_id, embedding) where ``is_query`` holds.

    Also returns what the calibration found: leaves, visits and recall.
    """
    spark = rows.sparkSession
    good = stored(clean_vectors(rows), "ann-vectors")
    # Equal vectors are one entry with its k + 1 smallest ids.
    place = Window.partitionBy("v").orderBy("vec_id")
    firsts = good.withColumn("place", F.row_number().over(place)).where(F.col("place") <= k + 1)
    grouped = firsts.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    grouped = grouped.select("v", "ids", F.get("ids", F.lit(0)).alias("entry"))
    grouped = stored(grouped, "ann-distinct")
    sample = grouped.orderBy(F.xxhash64("entry"), "entry").limit(SAMPLE).select("v").toArrow().column("v")
    points = _unit(_matrix(sample.combine_chunks()))
    if not len(points):
        empty = "query_id bigint, rank int, vec_id bigint, score double"
        return spark.createDataFrame([], empty), {"leaves": 0, "visits": 0, "recall": 1.0}
    tree = spark.sparkContext.broadcast(Tree(points))
    entries = stored(
        grouped.mapInArrow(_place(tree), _ENTRY + ", leaf bigint"), "ann-entries"
    )
    queries = stored(good.where(is_query).select(F.col("vec_id").alias("query_id"), "v"), "ann-queries")

    shelves = _shelves(entries, tree.value.leaves)

    visits, recall = _calibrate(tree, queries, entries, shelves, k, target)
    ordered = stored(queries.mapInArrow(_visit(tree, visits, shelves), _VISIT), "ann-visits")
    found = _search(ordered, entries, shelves, k)
    each = found.join(entries.select("entry", "ids"), "entry").select(
        "query_id", "score", F.explode("ids").alias("vec_id")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    result = (
        each.where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
    return result, {"leaves": tree.value.leaves, "visits": visits, "recall": recall}


def _calibrate(tree, queries: DataFrame, entries: DataFrame, shelves: list[int], k: int, target: float) -> tuple[int, float]:
    """Fewest leaf visits, doubled from one, at which calibration queries reach the target.

    The calibration queries (a bounded number) visit all leaves, which is the
    exact search over all rows in blocks; the place of a true neighbour's leaf
    in a query's own order then tells the recall of any number of visits.
    """
    leaves = tree.value.leaves
    some = stored(queries.orderBy(F.xxhash64("query_id"), "query_id").limit(CALIBRATION), "ann-calibration")
    asked = stored(some.mapInArrow(_visit(tree, leaves, shelves), _VISIT), "ann-asked")
    true = _search(asked, entries, shelves, k).where("query_id <> entry").select("query_id", "leaf").collect()
    points = {r["query_id"]: np.array(r["v"]) for r in some.collect()}
    places = {q: {leaf: i for i, leaf in enumerate(tree.value.order(_unit(v[None])[0], leaves), 1)} for q, v in points.items()}
    at = [places[r["query_id"]][r["leaf"]] for r in true]
    visits = 1
    while visits < leaves and sum(a <= visits for a in at) < target * len(at):
        visits = min(leaves, visits * 2)
    return visits, sum(a <= visits for a in at) / max(1, len(at))
