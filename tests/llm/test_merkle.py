"""The manifest against one that walks whole trees in memory."""

import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm.common import DOCS, clashing, rows_of
from tripmart.llm import merkle, queries
from tripmart.llm.shared import table

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def whole_tree(leaves):
    """The root and each leaf's siblings (left, right) by level."""
    level, paths, owners = list(leaves), [[] for _ in leaves], [[i] for i in range(len(leaves))]
    while len(level) > 1:
        above, held = [], []
        for at in range(0, len(level), 3):
            run = level[at : at + 3]
            for j in range(len(run)):
                for i in owners[at + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            above.append(h("".join(run)))
            held.append(sum(owners[at : at + 3], []))
        level, owners = above, held
    return level[0], paths


def brute_force(rows):
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[3]].append(row[:1] + (row[3], row[2], row[4], row[1]))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        own = sorted(by_source[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[source] = own, *whole_tree([leaf_of(r) for r in own])
    root, tops = whole_tree([trees[s][1] for s in sources]) if sources else (None, [])
    out = []
    for source, top in zip(sources, tops):
        own, subroot, paths = trees[source]
        for row, path in zip(own, paths):
            changed = row
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                changed = (*row[:4], row[4].replace("\n", ""))
            fold = leaf_of(changed)
            for left, right in path + top:
                fold = h(left + fold + right)
            out.append((row[0], leaf_of(row), subroot, root, h("".join(a + b for a, b in path + top)), fold, fold == root))
    return sorted(out, key=repr)


def given(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def awkward():
    rows = [
        (None, "no id\n", "en", "a", 6), (None, None, None, None, None), (7, "x\ny", "en", None, 3),
        (1, None, "de", "a", None), (2, "", "", "", 0), (3, "\n\n", "en", "a", 2), (3, "other\n", "en", "a", 6),
        (4, "same\n", "en", "a", 5), (4, "same\n", "en", "a", 5), (5, "ü漢😀\n" * 3, "zh", "é", 12), (6, "z" * 300_000 + "\n", "en", "Z", 9),
        (-3, "1:2-\n", "en", "a", -1),
    ]
    return rows + [(i, f"text {i}\n", "en", "big", i) for i in range(100, 185)]


def same(found, rows):
    assert found.columns == COLUMNS
    assert sorted(rows_of(found), key=repr) == brute_force(rows)


def test_query_equals_whole_trees(spark):
    rows = rows_of(table(spark, SMALL, "documents").select("doc_id", "text", "lang", "source", "n_chars"))
    same(queries.QUERIES["op11_merkle_manifest"](spark, SMALL), rows)


@pytest.mark.parametrize("span", [1, 2, 4])
def test_any_number_of_rounds_gives_the_same(spark, span):
    rows = awkward()
    same(merkle.verify_tampered(given(spark, rows).repartition(5), span), rows)


def test_sizes_around_whole_runs(spark):
    for n in (1, 2, 3, 4, 9, 10, 27, 28):
        rows = [(i, f"{i}\n", None, None, i) for i in range(n)]
        same(merkle.verify_tampered(given(spark, rows), 1), rows)


def test_many_trees_and_many_equal_rows(spark):
    rows = [(i, f"t{i}\n", "en", f"s{i % 40}", 1) for i in range(120)] + [(8, "copy\n", "en", "s1", 5)] * 60
    same(merkle.verify_tampered(given(spark, rows).repartition(7), 2), rows)


def test_empty_table_and_other_columns(spark):
    found = merkle.verify_tampered(given(spark, []))
    assert found.columns == COLUMNS and rows_of(found) == []
    rows = awkward()[:10]
    docs = clashing(given(spark, rows))
    for name in ("tree", "place", "size", "digest", "tampered", "left", "right", "top", "at_", "salt_", "part_"):
        docs = docs.withColumn(name, F.lit(1))
    same(merkle.verify_tampered(docs), rows)


def test_proofs_fold_to_the_root_and_name_their_place(spark):
    docs = given(spark, awkward())
    found = merkle.dataset_manifest(docs, span=2)
    again = merkle.folded(F.col("leaf"), F.col("left"), F.col("right"))
    assert found.where(again != F.col("root")).count() == 0
    # A leaf under another leaf's proof does not give the root.
    wrong = merkle.folded(F.sha2("leaf", 256), F.col("left"), F.col("right"))
    assert found.where(wrong == F.col("root")).count() == 0
    places = sorted(r["place"] for r in found.where("source = 'big'").collect())
    assert places == list(range(85))


def test_heap_delivers_in_label_order():
    done = merkle.forward([str(i) for i in range(10)], 3)
    assert [len(level) for level in done] == [10, 4, 2, 1]
    assert done[1][3] == h("9") and done[2][1] == h(done[1][3])
    proofs = merkle.backward(done, ["l"], ["r"])
    assert proofs[9] == (["", "", done[2][0], "l"], ["", "", "", "r"])
    assert proofs[1][0][0] == "0" and proofs[1][1][0] == "2"
