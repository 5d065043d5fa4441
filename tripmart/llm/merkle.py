"""A Merkle manifest of a dataset by time-forward processing.

Every row is a leaf. Leaves of one tree stand in a given order; while several
nodes remain, each run of ARITY consecutive ones becomes its parent, the digest
of their digests. The roots of all trees, in the order of the trees, form one
tree more in the same way.

A node's label is (tree, level, place). Digests travel as messages to the label
of the parent through a priority queue, smallest label first, so a node is
handled when all its children have reported. The queue is external: the places
of a tree are cut into blocks of ARITY**CLIMB, the messages of many blocks are
dealt out and sorted by label in a shuffle, on disk where needed, and a heap
holds the messages of one block only. A block ends in one message to the next
round, so a tree of n leaves needs log(n) / log(BLOCK) rounds, and a tree that
holds most leaves is worked on by as many tasks as it has blocks.

The reversed sweep goes from the last round to the first, largest label first.
A node sends each child the proof suffix: the child's siblings, then what the
node itself was sent. Leaves end up with their whole proof.

Defined results: a null field is ``-``, any other its UTF-8 byte count, a colon
and its value. Leaves are ordered by doc_id (null first), then by digest; equal
rows are leaves of their own, next to each other, and rows with null source are
a tree of their own. A tree of one leaf has that leaf as root. An empty table
gives no rows. Texts of any length only pass a hash function. Further columns
are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.shared import small_side, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
#: Levels that one block climbs; a block has ARITY**CLIMB nodes.
CLIMB = 7
#: Rows of one output batch.
ROWS = 4096


def leaf_digest(fields: tuple[str, ...] = FIELDS, **changed: Column) -> Column:
    """The digest of a row's fields, some of them replaced."""

    def part(name: str) -> Column:
        value = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(part, fields)), 256)


def folded(leaf: Column, left: Column, right: Column) -> Column:
    """The root that a leaf and the siblings left and right of its path give."""
    return F.aggregate(
        F.arrays_zip(left.alias("left"), right.alias("right")),
        leaf,
        lambda own, level: F.sha2(F.concat(level["left"], own, level["right"]), 256),
    )


def proof_digest(left: Column, right: Column) -> Column:
    """The digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.zip_with(left, right, lambda a, b: F.concat(a, b)), ""), 256)


def climbs(n: int) -> int:
    """Levels above n nodes of which one remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def forward(digests: list[str], levels: int) -> list[list[str]]:
    """Digests of all nodes of a block by level, delivered to parents in label order."""
    done: list[list[str]] = [digests, *([] for _ in range(levels))]
    # Sorted by label, so a heap already.
    queue = [((1, place // ARITY), place, own) for place, own in enumerate(digests)] if levels else []
    while queue:
        label, children = queue[0][0], []
        while queue and queue[0][0] == label:
            children.append(heapq.heappop(queue)[2])
        own = sha256("".join(children).encode()).hexdigest()
        level, place = label
        done[level].append(own)
        if level < levels:
            heapq.heappush(queue, ((level + 1, place // ARITY), place, own))
    return done


def backward(done: list[list[str]], left: list[str], right: list[str]) -> list[tuple[list[str], list[str]]]:
    """The proofs of a block's leaves, from the suffix sent to its root."""
    proofs: list[tuple[list[str], list[str]]] = [([], [])] * len(done[0])
    queue = [(1 - len(done), 0, left, right)]
    while queue:
        level, place, left, right = heapq.heappop(queue)
        level, place = -level, -place
        if level == 0:
            proofs[place] = (left, right)
            continue
        run = done[level - 1][place * ARITY : (place + 1) * ARITY]
        for i in range(len(run)):
            suffix = (["".join(run[:i]), *left], ["".join(run[i + 1 :]), *right])
            heapq.heappush(queue, (1 - level, -(place * ARITY + i), *suffix))
    return proofs


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """The rows with their place in their tree (from 0) and the tree's number of rows.

    Rows are sorted over all tasks; equal ones are kept apart by their place in
    the input, so that they may fill several tasks. Only the number of rows per
    tree and task decides where each task begins to count.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    laid = stored(
        rows.withColumn("salt_", F.monotonically_increasing_id())
        .repartitionByRange(*keys, "salt_")
        .sortWithinPartitions(*keys, "salt_")
        .drop("salt_")
        .withColumn("at_", F.monotonically_increasing_id()),
        "merkle-ordered",
    ).withColumn("part_", F.shiftright("at_", 33))
    every = Window.partitionBy("tree_")
    before = every.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        laid.groupBy(F.col("tree").alias("tree_"), "part_")
        .agg(F.min("at_").alias("first_"), F.count("*").alias("rows_"))
        .select(
            "tree_",
            F.col("part_").alias("own_part_"),
            (F.coalesce(F.sum("rows_").over(before), F.lit(0)) - F.col("first_")).alias("shift_"),
            F.sum("rows_").over(every).alias("size"),
        )
    )
    return laid.join(
        small_side(starts), (F.col("part_") == F.col("own_part_")) & F.col("tree").eqNullSafe(F.col("tree_"))
    ).select(*rows.columns, (F.col("at_") + F.col("shift_")).alias("place"), "size")


def _by_label(messages: DataFrame) -> DataFrame:
    """Messages of one block together and in the order of their labels."""
    return messages.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")


def _blocks(batches, names: list[str]) -> Iterator[list[tuple]]:
    """Rows (tree, block, ...) of one block after the other."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in names)):
            if held and row[:2] != held[0][:2]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _levels(size: int, span: int) -> int:
    """Levels that the nodes of a tree climb in one round."""
    return span if size > ARITY**span else climbs(size)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_NODES = pa.schema([("tree", pa.string()), ("place", pa.int64()), ("size", pa.int64()), ("digest", pa.string())])


def _climb(span: int):
    def run(batches):
        def rows():
            for block in _blocks(batches, ["tree", "block", "size", "digest"]):
                tree, place, size, _ = block[0]
                done = forward([row[3] for row in block], _levels(size, span))
                yield tree, place, -(-size // ARITY**span), done[-1][0]

        return _batches(rows(), _NODES)

    return run


def _descend(schema: pa.Schema, passed: list[str], span: int):
    def run(batches):
        def rows():
            for block in _blocks(batches, ["tree", "block", "size", "digest", "place", "left", "right", "top", *passed]):
                # The first row is the message from above, its place is before all others.
                head, nodes = block[0], block[1:]
                done = forward([row[3] for row in nodes], _levels(nodes[0][2], span))
                for row, (left, right) in zip(nodes, backward(done, head[5], head[6])):
                    yield row[0], row[4], left, right, head[7], *([row[3], *row[8:]] if passed else [])

        return _batches(rows(), schema)

    return run


def _arrow_type(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "string": pa.string()}[kind]


def roots(rounds: list[DataFrame]) -> DataFrame:
    """(tree, digest) of all trees, from the rounds of ``climb``."""
    return rounds[-1].select("tree", "digest")


def climb(leaves: DataFrame, span: int = CLIMB) -> list[DataFrame]:
    """The nodes (tree, place, size, digest) that enter each round, the roots last."""
    block = ARITY**span
    rounds = [leaves]
    most = leaves.agg(F.max("size")).first()[0] or 0
    while len(rounds) == 1 or most > 1:
        own = rounds[-1].select("tree", F.expr(f"place div {block}").alias("block"), "place", "size", "digest")
        rounds.append(stored(_by_label(own).mapInArrow(_climb(span), "tree string, place bigint, size bigint, digest string"), "merkle-nodes"))
        most = -(-most // block)
    return rounds


def descend(rounds: list[DataFrame], sent: DataFrame, passed: dict[str, str], span: int = CLIMB) -> DataFrame:
    """The leaves with their proofs: tree, place, left, right, top, digest and the columns ``passed``.

    ``sent`` (tree, left, right, top) is what the roots are sent; ``top`` goes
    down as it is.
    """
    suffixes = sent.select("tree", F.lit(0).cast("bigint").alias("place"), "left", "right", "top")
    lists = pa.list_(pa.string())
    for depth in range(len(rounds) - 2, -1, -1):
        more = passed if depth == 0 else {}
        nodes = rounds[depth].select(
            "tree", F.expr(f"place div {ARITY**span}").alias("block"), "place", "size", "digest", *more
        )
        heads = suffixes.select("tree", F.col("place").alias("block"), F.lit(-1).cast("bigint").alias("place"), "left", "right", "top")
        both = nodes.unionByName(heads, allowMissingColumns=True)
        schema = pa.schema([
            ("tree", pa.string()), ("place", pa.int64()), ("left", lists), ("right", lists), ("top", pa.string()),
            *([("digest", pa.string())] if more else []), *((c, _arrow_type(t)) for c, t in more.items()),
        ])
        ddl = "tree string, place bigint, left array<string>, right array<string>, top string"
        ddl += (", digest string" if more else "") + "".join(f", {c} {t}" for c, t in more.items())
        suffixes = _by_label(both).mapInArrow(_descend(schema, list(more), span), ddl)
        if depth:
            suffixes = stored(suffixes, "merkle-suffixes")
    return suffixes


def manifest(leaves: DataFrame, order: tuple[str, ...], passed: dict[str, str], span: int = CLIMB) -> DataFrame:
    """Proofs of all leaves (tree, digest, the columns of ``order`` and ``passed``).

    Returns tree, place, digest, left, right (siblings on each side, per level up
    to the root), subroot, root and the columns ``passed`` (name to bigint or string).
    """
    trees = climb(numbered(leaves, *order, "digest"), span)
    # One tree of all roots, in the order of their trees.
    tops = roots(trees).select(F.lit(None).cast("string").alias("tree"), F.col("tree").alias("name"), "digest")
    above = climb(numbered(tops, "name"), span)
    found = roots(above).first()
    root = found["digest"] if found else None
    empty = F.array().cast("array<string>")
    none = F.lit(None).cast("string")
    sent = roots(above).select(none.alias("tree"), empty.alias("left"), empty.alias("right"), none.alias("top"))
    heads = descend(above, sent, {"name": "string"}, span).select(F.col("name").alias("tree"), "left", "right", F.col("digest").alias("top"))
    proofs = descend(trees, heads, passed, span)
    return proofs.select(
        "tree", "place", "digest", "left", "right", F.col("top").alias("subroot"), F.lit(root).cast("string").alias("root"), *passed
    )


def dataset_manifest(docs: DataFrame, tampered: Column | None = None, span: int = CLIMB) -> DataFrame:
    """doc_id, source, place, leaf, left, right, subroot and root of every row of ``docs`` (FIELDS).

    ``tampered`` is a digest of the row to be returned with it.
    """
    passed = {"doc_id": "bigint"} | ({} if tampered is None else {"tampered": "string"})
    leaves = stored(
        docs.select(
            F.col("source").cast("string").alias("tree"),
            F.col("doc_id").cast("bigint").alias("doc_id"),
            leaf_digest().alias("digest"),
            *([] if tampered is None else [tampered.alias("tampered")]),
        ),
        "merkle-leaves",
    )
    found = manifest(leaves, ("doc_id",), passed, span)
    return found.select(
        "doc_id", F.col("tree").alias("source"), "place", F.col("digest").alias("leaf"), "left", "right", "subroot", "root",
        *[c for c in passed if c != "doc_id"],
    )


def verify_tampered(docs: DataFrame, span: int = CLIMB) -> DataFrame:
    """The manifest's digests, and the root that each row gives after tampering.

    Rows whose crc32 of doc_id is even lose the line ends of their text; a row
    without doc_id or text stays as it is.
    """
    own = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.col("n_chars").cast("bigint").alias("n_chars"),
        F.col("text").cast("string").alias("text"),
    )
    hit = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n"))
    cut = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    found = dataset_manifest(own, F.when(hit, leaf_digest(text=cut)), span)
    again = folded(F.coalesce("tampered", "leaf"), F.col("left"), F.col("right"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("left"), F.col("right")).alias("proof_sha256"), again.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
