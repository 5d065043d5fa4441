"""Whitening of embeddings with FEAST: contour integration of the covariance.

Vectors are put on a grid of whole numbers, so the sums behind the covariance
are exact: entries are centred on the rounded mean before they are multiplied,
products are added as whole numbers in map tasks and by Spark, and the rest of
the mean is taken out exactly. The driver holds one matrix of dimension x
dimension, never vectors.

FEAST then finds the largest eigenvalues interval by interval:

1. the inertia of shifted covariances (signs of an LDL' factorisation) counts
   the eigenvalues beyond any point; bisection cuts the range of the wanted
   ones into intervals of few eigenvalues each;
2. in one task per interval, a Gauss-Legendre quadrature along the circle
   around it adds up solves with complex shifts of a random block, which
   projects the block onto the interval's eigenvectors; Rayleigh-Ritz extracts
   them, and both are repeated until the residuals stand;
3. a last Rayleigh-Ritz over all intervals together makes the components
   orthogonal, and their number must be the count by inertia: none is missed.

Defined results: vectors that are null or hold null or non-finite entries take
no part, nor do those with an entry beyond LARGEST in size, which has no place
on the grid, or with another length than most have (among equally frequent
lengths the longest counts). Equal vectors count once in the fit and have rows
of their own in the result. Directions without variance (up to FLAT of the
trace) cannot be whitened and are no components; so a single distinct vector
and an empty table give no rows. Equal eigenvalues have some orthogonal vectors of their
space. ``deviation`` is null where it does not fit into a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.shared import stored

#: Components returned.
COMPONENTS = 16
#: Steps of the grid in one unit, and the number added to each step.
STEPS, OFFSET = 64, 1_000_000
#: Largest entry: its square still adds up exactly.
LARGEST = float(1 << 40)
#: Share of the trace up to which an eigenvalue counts as zero.
FLAT = 1e-11
#: Eigenvalues in one interval, quadrature points on its half circle, rounds at most.
PER_INTERVAL, POINTS, ROUNDS = 8, 12, 40
#: Share of the trace within which eigenvalues are not parted; steps that look for the ends of a gap.
CLOSE, GAP_STEPS = 1e-6, 10


# The grid --------------------------------------------------------------------


def on_grid(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """The valid rows of ``vectors`` (vec_id and the column) as vec_id and x (array of long)."""

    def fits(entry: Column) -> Column:
        return entry.isNotNull() & ~F.isnan(entry) & (F.abs(entry) <= LARGEST)

    mine = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col(column).cast("array<double>").alias("c"))
    return mine.where(F.col("c").isNotNull() & F.forall("c", lambda e: F.coalesce(fits(e), F.lit(False)))).select(
        "vec_id", F.transform("c", lambda e: F.floor(e * STEPS).cast("bigint") + OFFSET).alias("x")
    )


def usual_length(grid: DataFrame) -> int:
    found = grid.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    return found["length"] if found else 0


def _matrix(batch: pa.RecordBatch, length: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


# Exact sums ------------------------------------------------------------------

_DECIMAL = pa.decimal128(38, 0)


def _rows(i, j, values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(int(v)) for v in values], _DECIMAL)], ["i", "j", "value"]
    )


def _sums(length: int):
    """(i, -1, sum of entry i), and (-1, -1, number of rows)."""

    def run(batches):
        total, n = np.zeros(length, object), 0
        for batch in batches:
            x = _matrix(batch, length)
            n += len(x)
            total += _exact_sum(x)
        yield _rows([-1, *range(length)], [-1] * (length + 1), [n, *total])

    return run


def _exact_sum(x: np.ndarray) -> np.ndarray:
    # LARGEST * STEPS is 2**46, so up to 2**16 rows of a part fit a long.
    return sum((x[at : at + (1 << 16)].sum(axis=0).astype(object) for at in range(0, len(x), 1 << 16)), np.zeros(x.shape[1], object))


def _products(length: int, centre: list[int]):
    """(i, j, sum of products) of entries around the centre, for i <= j; (i, -1, sum)."""

    def run(batches):
        first, second = np.zeros(length, object), np.zeros((length, length), object)
        for batch in batches:
            y = _matrix(batch, length) - np.array(centre, np.int64)
            first += _exact_sum(y)
            second += _exact_products(y)
        i, j = np.triu_indices(length)
        yield _rows([*i, *range(length)], [*j, *[-1] * length], [*second[i, j], *first])

    return run


def _exact_products(y: np.ndarray) -> np.ndarray:
    most = int(np.abs(y).max(initial=0))
    if most * most * max(len(y), 1) < 1 << 53:
        # Whole numbers that a double holds exactly, sums included.
        return (y.astype(np.float64).T @ y.astype(np.float64)).astype(np.int64).astype(object)
    wide = y.astype(object)
    return wide.T @ wide


def _added(frame: DataFrame, task) -> dict[tuple[int, int], int]:
    """The tasks' rows added up; length**2 / 2 numbers at most reach the driver."""
    rows = frame.mapInArrow(task, "i int, j int, value decimal(38,0)").groupBy("i", "j").agg(F.sum("value").alias("value"))
    return {(r["i"], r["j"]): int(r["value"]) for r in rows.toLocalIterator()}


def moments(fit: DataFrame, length: int) -> tuple[int, list[int], list[int], np.ndarray]:
    """Number of rows, sums, whole centre and covariance (divisor n) of ``fit`` (x)."""
    sums = _added(fit, _sums(length))
    n = sums[-1, -1]
    total = [sums[i, -1] for i in range(length)]
    if n == 0:
        return 0, total, total, np.zeros((length, length))
    centre = [(2 * s + n) // (2 * n) for s in total]
    added = _added(fit, _products(length, centre))
    cov = np.zeros((length, length))
    for i in range(length):
        for j in range(i, length):
            # Whole numbers up to one correctly rounded division.
            cov[i, j] = cov[j, i] = (n * added[i, j] - added[i, -1] * added[j, -1]) / (n * n)
    return n, total, centre, cov


# Inertia and intervals -------------------------------------------------------


def count_above(matrix: np.ndarray, point: float) -> int:
    """Eigenvalues above a point: positive ones of D in L D L' of the shifted matrix.

    Pivots are single entries or pairs, chosen over the whole rest (Bunch and Parlett).
    """
    rest = matrix - point * np.eye(len(matrix))
    positive, bound = 0, (1 + np.sqrt(17)) / 8
    while (size := len(rest)) > 0:
        diagonal = np.abs(np.diag(rest))
        one = int(diagonal.argmax())
        off = np.abs(np.triu(rest, 1))
        i, j = np.unravel_index(int(off.argmax()), off.shape) if size > 1 else (0, 0)
        largest = off[i, j] if size > 1 else 0.0
        if diagonal[one] == largest == 0:
            break
        if diagonal[one] >= bound * largest:
            pivots = [one]
            positive += rest[one, one] > 0
        else:
            # The determinant of such a pair is negative: one eigenvalue of each sign.
            pivots = [i, j]
            positive += 1
        keep = np.delete(np.arange(size), pivots)
        side = rest[np.ix_(keep, pivots)]
        rest = rest[np.ix_(keep, keep)] - side @ np.linalg.solve(rest[np.ix_(pivots, pivots)], side.T)
    return int(positive)


def intervals(cov: np.ndarray, wanted: int = COMPONENTS, most: int = PER_INTERVAL) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues between) from the largest down, at least ``wanted`` in all if there are so many.

    Only eigenvalues above FLAT of the trace count. An interval holds more than
    ``most`` if they are closer than CLOSE of the trace. Its ends lie in the
    middle of the gaps to the next eigenvalues, as far as bisection tells.
    """
    trace = float(np.trace(cov))
    if trace <= 0:
        return []
    floor = FLAT * trace
    total = count_above(cov, floor)
    wanted = min(wanted, total)
    out: list[tuple[float, float, int]] = []
    high = float(np.abs(cov).sum(axis=1).max()) * (1 + 1e-9)
    found = 0
    while found < wanted:
        # None of the rest lies above ``above``; too many, or all that count, above ``below``.
        above, below, inside = high, floor, total - found
        low = floor
        while inside > most and above - below > CLOSE * trace:
            middle = (above + below) / 2
            n = count_above(cov, middle) - found
            if n == 0:
                above = middle
            elif n > most:
                below = middle
            else:
                low, inside = middle, n
        if low == floor and inside > most:
            low, inside = below, count_above(cov, below) - found

        def here(point: float, number: int = found + inside) -> bool:
            return count_above(cov, point) == number

        ends = []
        for beyond in (above, below):
            near = low
            for _ in range(GAP_STEPS):
                middle = (near + beyond) / 2
                if here(middle):
                    near = middle
                else:
                    beyond = middle
            ends.append(near)
        low = sum(ends) / 2
        out.append((low, above, inside))
        found += inside
        high = low
    return out


# FEAST -----------------------------------------------------------------------


def rayleigh_ritz(cov: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalue estimates, falling, and vectors within the span of a block."""
    base, _ = np.linalg.qr(block)
    values, turns = np.linalg.eigh(base.T @ cov @ base)
    return values[::-1], (base @ turns)[:, ::-1]


def feast(cov: np.ndarray, low: float, high: float, inside: int) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvalues in (low, high] and their vectors, ``inside`` by inertia."""
    size, scale = len(cov), float(np.abs(cov).max())
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    middle, radius = (low + high) / 2, (high - low) / 2
    turn = np.exp(-0.5j * np.pi * (nodes - 1))
    columns = min(size, 2 * inside + 4)
    draw = np.random.default_rng(13)
    block = draw.standard_normal((size, columns))
    for _ in range(ROUNDS):
        # The filter: quadrature of the resolvent along the half circle, the other half is its conjugate.
        image = np.zeros((size, columns))
        for t, w in zip(turn, weights):
            shifted = (middle + radius * t) * np.eye(size) - cov
            image += (w / 2) * (radius * t * np.linalg.solve(shifted, block.astype(complex))).real
        values, vectors = rayleigh_ritz(cov, image)
        # By inertia the eigenvalues of the interval are the first after those above it.
        order = np.argsort(np.abs(values - middle))[:inside]
        order = order[np.argsort(-values[order])]
        rest = np.linalg.norm(cov @ vectors[:, order] - vectors[:, order] * values[order], axis=0)
        if rest.max(initial=0) <= 64 * np.finfo(float).eps * scale * np.sqrt(size):
            slack = 1e-10 * (abs(low) + abs(high))
            if ((values[order] > low - slack) & (values[order] <= high + slack)).all():
                return values[order], vectors[:, order]
        block = vectors if columns == vectors.shape[1] else draw.standard_normal((size, columns))
    raise ArithmeticError(f"the eigenvalues between {low} and {high} did not settle")


def _solve(cov):
    def run(batches):
        for batch in batches:
            for low, high, inside in zip(*(batch.column(c).to_pylist() for c in ("low", "high", "inside"))):
                values, vectors = feast(cov.value, low, high, inside)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values), pa.array(list(vectors.T), pa.list_(pa.float64()))], ["value", "vector"]
                )

    return run


def principal(spark, cov: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues (falling) and unit vectors as columns; one task per interval."""
    parts = intervals(cov, wanted)
    size = len(cov)
    if not parts:
        return np.zeros(0), np.zeros((size, 0))
    shared = spark.sparkContext.broadcast(cov)
    given = spark.createDataFrame(parts, "low double, high double, inside int").repartition(len(parts), "low")
    rows = given.mapInArrow(_solve(shared), "value double, vector array<double>").collect()
    values, vectors = rayleigh_ritz(cov, np.array([r["vector"] for r in rows]).T)
    lowest, counted = parts[-1][0], sum(p[2] for p in parts)
    if len(values) != counted or not (values > lowest - 1e-10 * abs(values[0])).all():
        raise ArithmeticError(f"{len(values)} components instead of the {counted} counted by inertia")
    values, vectors = values[:wanted], vectors[:, :wanted]
    # The sign is free: the entry largest in size is positive.
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    return values, vectors * np.where(signs == 0, 1, signs)


# Whitened rows ---------------------------------------------------------------


def _project(x: np.ndarray, model: dict) -> np.ndarray:
    """x minus its mean on the components, over the roots of their eigenvalues."""
    return ((x - model["centre"]).astype(np.float64) - model["rest"]) @ model["axes"]


def _spread(shared):
    """(i, j, sum of products) of whitened values, and (i, -1, sum)."""

    def run(batches):
        model = shared.value
        length, k = model["axes"].shape
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = _project(_matrix(batch, length), model)
            first += w.sum(axis=0)
            second += w.T @ w
        i, j = np.indices((k, k)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*i, *range(k)], pa.int32()),
                pa.array([*j, *[-1] * k], pa.int32()),
                pa.array([*second.ravel(), *first], pa.float64()),
            ],
            ["i", "j", "value"],
        )

    return run


def identity_error(fit: DataFrame, shared, n: int, k: int) -> float:
    """Largest entry of the whitened covariance minus the identity, measured over ``fit``."""
    rows = fit.mapInArrow(_spread(shared), "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
    found = {(r["i"], r["j"]): r["value"] for r in rows}
    return max(
        abs(found[i, j] / n - found[i, -1] / n * found[j, -1] / n - (i == j)) for i in range(k) for j in range(k)
    )


def deviations(x: np.ndarray, n: int, total: list[int], centre: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n * x - total)**2 of each row, exact."""
    y = x - centre
    rest = [s - n * int(m) for s, m in zip(total, centre)]
    most = n * (int(np.abs(y).max(initial=0)) + 1)
    if most * most * x.shape[1] < 1 << 63:
        gap = n * y - np.array(rest, np.int64)
        return (gap * gap).sum(axis=1).tolist()
    sums = [sum((n * int(v) - r) ** 2 for v, r in zip(row, rest)) for row in y]
    return [s if s < 1 << 63 else None for s in sums]


_WHITENED = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def _whitened(shared):
    def run(batches) -> Iterator[pa.RecordBatch]:
        model = shared.value
        length, k = model["axes"].shape
        for batch in batches:
            rows = batch.num_rows
            if rows == 0:
                continue
            x = _matrix(batch, length)
            each = np.repeat(np.arange(rows), k)
            values = _project(x, model)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                    pa.array(np.full(rows * k, model["n"]), pa.int64()),
                    pa.array(deviations(x, model["n"], model["total"], model["centre"]), pa.int64()).take(pa.array(each)),
                    pa.array(values.ravel(), pa.float64()),
                    pa.array(np.tile(model["explained"], rows), pa.float64()),
                    pa.array(np.full(rows * k, model["error"]), pa.float64()),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS, column: str = "embedding") -> DataFrame:
    """Per valid row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    grid = on_grid(vectors, column)
    length = usual_length(grid)
    grid = grid.where(F.size("x") == length)
    if length == 0:
        return spark.createDataFrame([], _WHITENED)
    fit = stored(grid.select("x").distinct(), "whitening-fit")
    n, total, centre, cov = moments(fit, length)
    values, axes = principal(spark, cov, components)
    if len(values) == 0:
        return spark.createDataFrame([], _WHITENED)
    model = {
        "n": n,
        "total": total,
        "centre": np.array(centre, np.int64),
        "rest": np.array([(s - n * m) / n for s, m in zip(total, centre)]),
        "axes": axes / np.sqrt(values),
        "explained": values / np.trace(cov),
        "error": 0.0,
    }
    model["error"] = identity_error(fit, spark.sparkContext.broadcast(dict(model)), n, len(values))
    return grid.mapInArrow(_whitened(spark.sparkContext.broadcast(model)), _WHITENED)
