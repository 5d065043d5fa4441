"""Benchmark decontamination by CGK embedding, bit-sampling LSH and edit verification.

Texts and items are sequences of words (ASCII punctuation and white space
separate, A-Z count as a-z).

* The CGK walk writes the current word at every step and then stays or moves on
  by a random bit of word and step. Equal sequences write the same, and sequences
  of small edit distance differ in few steps: edit distance becomes Hamming
  distance. Walks begin at every word of a text and at every word of an item, so
  a change near an item's beginning does not spoil the walks behind it.
* A table samples some steps of one walk; a window and an item that agree on all
  of them are candidates. The places of both walks tell where the item would
  begin, and nearby places share one window of the item's size and the edits
  allowed around it.
* k edits spread evenly over n words, which leaves the shortest runs, leave k + 1
  unchanged runs of (n - k) / (k + 1) words, rounded down or up. A walk from a
  run's first word that is still in it at the last sampled step (its chance is a
  binomial sum) is a hit. A table misses the pair if it misses all runs, and
  tables are added until the product of their misses leaves a recall of RECALL
  for the n and k of an item. The chances take the random bits of a run's words as
  independent; items that repeat few words have fewer. Items that have to be
  exact are sampled within their words only and cannot be missed.
* Windows with fewer words of their item than the edits allow are skipped; this
  loses none.
* The rest is verified by the exact edit distance between the item and the best
  stretch of words in the window, many windows at once.

Defined results: the best stretch has the fewest edits, then the earliest end,
then the latest first word; null and empty texts, empty tables and items without
words match nothing; long texts are searched whole; repeated rows give repeated
rows; a null doc_id is reported as null; further columns are ignored. Items of
fewer words than 1 / allowed have to be exact.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.shared import byte_view, let_go, small_side, steps, stored
from tripmart.llm.words import mix, word_hashes

#: Edits allowed, as a share of an item's words.
ALLOWED = 0.2
#: Least chance that a pair at the allowed distance becomes a candidate.
RECALL = 0.999
#: Longest run of unchanged words that a walk is fitted to, and steps of a walk.
RUN, STEPS = 8, 16
#: Items and bytes of items sent to all tasks at once; more are handled in further passes.
ITEMS, ITEM_BYTES = 20_000, 8 << 20
#: Hits expanded and words of windows verified at once.
HITS, CELLS = 1_000_000, 1_000_000

# Multipliers of the sampled steps.
_STEP = np.random.default_rng(20240917).integers(1, 2**63, STEPS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_APART = np.zeros(256, bool)
_APART[:128] = [not chr(i).isalnum() for i in range(128)]


def words_of(texts: list[str]) -> list[np.ndarray]:
    at, raw = byte_view(pa.array(texts, pa.string()))
    words, _, _, first = word_hashes(raw, at, _APART)
    return [words[a:b] for a, b in zip(first[:-1], first[1:])]


def edits_allowed(size: int, allowed: float) -> int:
    # 0.2 * 15 and the like have to be whole, also where floats fall short of it.
    return int(allowed * size + 1e-9)


def sampled(run: int, walk: int, loose: bool) -> tuple[int, ...]:
    """The steps a table samples of a walk: within a run if its item has to be exact, else of twice as many."""
    if not loose:
        return tuple(range(run))
    steps = min(2 * run, STEPS)
    random = np.random.default_rng([run, walk])
    return tuple(sorted(random.choice(steps, run + 1, replace=False).tolist()))


def chance_of_a_run(run: int, steps: tuple[int, ...]) -> float:
    """The chance that a walk is still within its first ``run`` words at the last of the steps."""
    last = steps[-1]
    return sum(math.comb(last, moves) for moves in range(min(run, last + 1))) / 2**last


@cache
def tables_of(size: int, most: int) -> tuple[int, int]:
    """The longest run of words an item surely keeps unchanged, and how many tables reach RECALL."""
    short, longer = divmod(size - most, most + 1)
    run = min(RUN, short + (longer > 0))
    if not most:
        return run, 1
    miss, tables = 1.0, 0
    while miss > 1 - RECALL:
        steps = sampled(run, tables, True)
        miss *= (1 - chance_of_a_run(short, steps)) ** (most + 1 - longer) * (1 - chance_of_a_run(short + 1, steps)) ** longer
        tables += 1
    return run, tables


def _walk(words: np.ndarray, walk: int, wanted: dict):
    """(name, key, place at its last step) of every name in ``wanted``, whose steps are given, for walks from all words."""
    ends = {steps[-1] for steps in wanted.values()}
    bits = mix(words ^ np.uint64((walk + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
    keys = {name: np.zeros(len(words), np.uint64) for name in wanted}
    at = np.arange(len(words))
    for step in range(max(ends) + 1):
        # Walks past the last word stay there; such keys are dropped by their place.
        here = np.minimum(at, len(words) - 1)
        written = words[here]
        for name, steps in wanted.items():
            if step in steps:
                keys[name] += written * _STEP[step]
                if step == steps[-1]:
                    yield name, keys.pop(name), at.copy()
        at += (bits[here] >> np.uint64(step) & np.uint64(1)).astype(np.int64)


class Table:
    """Items and places in them by key."""

    def __init__(self, keys: np.ndarray, items: np.ndarray, places: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, first = np.unique(keys[order], return_index=True)
        self.first = np.r_[first, len(order)]
        self.items, self.places = items[order].astype(np.int32), places[order].astype(np.int32)
        bits = max(16, int(8 * len(self.keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.maybe = np.zeros(1 << bits, bool)
        self.maybe[self.keys >> self.shift] = True

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``keys`` that are known, and their numbers."""
        at = np.flatnonzero(self.maybe[keys >> self.shift])
        number = np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)
        same = self.keys[number] == keys[at]
        return at[same], number[same]


class Index:
    """The items with words of one pass."""

    def __init__(self, items: list[tuple[int, np.ndarray]], allowed: float):
        self.ids = [i for i, _ in items]
        self.sizes = np.array([len(w) for _, w in items], np.int64)
        self.edits = np.array([edits_allowed(n, allowed) for n in self.sizes.tolist()], np.int64)
        self.first = np.r_[0, np.cumsum(self.sizes)]
        flat = np.concatenate([w for _, w in items])
        self.vocabulary, self.numbers = np.unique(flat, return_inverse=True)
        own = np.repeat(np.arange(len(items)), self.sizes)
        self.members = np.unique(own * (len(self.vocabulary) + 1) + self.numbers)
        kinds = [(*tables_of(n, k), k > 0) for n, k in zip(self.sizes.tolist(), self.edits.tolist())]
        runs, counts, loose = (np.array(x) for x in zip(*kinds))
        place = np.arange(len(flat)) - self.first[own]
        self.walks: list[dict] = []
        self.tables = {}
        for walk in range(int(counts.max())):
            names = sorted({(r, l) for r, t, l in kinds if t > walk})
            wanted = {(r, l): sampled(r, walk, l) for r, l in names}
            self.walks.append(wanted)
            for name, keys, at in _walk(flat, walk, wanted):
                held = (runs == name[0]) & (loose == name[1]) & (counts > walk)
                inside = at < self.first[own + 1]
                mine = np.flatnonzero(held[own] & inside & (loose[own] | (place == 0)))
                if len(mine):
                    self.tables[walk, name] = Table(keys[mine], own[mine], place[mine])

    def hits(self, words: np.ndarray, ends: np.ndarray):
        """Blocks of (item, place in ``words``, place in the item) that agree in a table."""
        for walk, wanted in enumerate(self.walks):
            for name, keys, reached in _walk(words, walk, wanted):
                own = self.tables.get((walk, name))
                if own is None:
                    continue
                at, number = own.find(keys)
                inside = reached[at] < ends[at]
                at, number = at[inside], number[inside]
                count = own.first[number + 1] - own.first[number]
                upto = np.r_[0, np.cumsum(count)]
                cut = 0
                while cut < len(at):
                    end = max(cut + 1, int(np.searchsorted(upto, upto[cut] + HITS, side="right")) - 1)
                    many = count[cut:end]
                    each = np.arange(upto[end] - upto[cut]) + np.repeat(own.first[number[cut:end]] - upto[cut:end] + upto[cut], many)
                    yield own.items[each].astype(np.int64), np.repeat(at[cut:end], many), own.places[each].astype(np.int64)
                    cut = end


def best_stretches(items: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least edits that turn each item into a stretch of its window; that stretch's first word and end.

    Items and windows are rows of words. Of equal stretches the earliest end
    counts, then the latest first word.
    """
    rows, n = windows.shape
    place = np.arange(n + 1, dtype=np.int64)
    # One number holds the edits and, below them, how far the first word is from the window's end.
    one = n + 1
    row = np.tile(n - place, (rows, 1))
    for i in range(items.shape[1]):
        new = row + one
        new[:, 0] = (i + 1) * one + n
        np.minimum(new[:, 1:], row[:, :-1] + one * (windows != items[:, i : i + 1]), out=new[:, 1:])
        # Insertions run along the row: a running minimum of what each place offers.
        row = np.minimum.accumulate(new - place * one, axis=1) + place * one
    edits = row // one
    end = edits.argmin(axis=1)
    each = np.arange(rows)
    return edits[each, end], n - row[each, end] % one, end


def edits_within(item: np.ndarray, words: np.ndarray, most: int) -> tuple[int, int]:
    """Least edits that turn the item into any stretch of ``words``, and that stretch's end.

    Returns (most + 1, -1) if there are more.
    """
    edits, _, end = best_stretches(np.asarray(item)[None, :], np.asarray(words)[None, :])
    return (int(edits[0]), int(end[0])) if edits[0] <= most else (most + 1, -1)


def build(items: list[tuple[int, str]], allowed: float = ALLOWED) -> Index | None:
    """The index of all items with words; None if there are none."""
    words = [(i, w) for (i, _), w in zip(items, words_of([t for _, t in items])) if len(w)]
    return Index(words, allowed) if words else None


def _windows(index: Index, words: np.ndarray, text: np.ndarray, ends: np.ndarray):
    """Blocks of distinct (item, text, first place at which the item may begin)."""
    texts, most = int(text[-1]) + 1, len(words) + int(index.sizes.max()) + 1
    for item, at, place in index.hits(words, ends):
        # The item may begin anywhere in a bucket of as many places as edits are allowed, and one.
        wide = index.edits[item] + 1
        bucket = (at - place) // wide
        key = np.unique((item * texts + text[at]) * (2 * most) + bucket + most)
        item, bucket = key // (2 * most) // texts, key % (2 * most) - most
        yield item, key // (2 * most) % texts, bucket * (index.edits[item] + 1)


def search(words: np.ndarray, first: np.ndarray, index: Index | None):
    """(text, item id, edits, item words, first word) of the best match of each text and item."""
    if not len(words) or index is None:
        return []
    best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    numbers = None
    for items, texts, begins in _windows(index, words, text, first[1:][text]):
        if numbers is None:
            at = np.minimum(np.searchsorted(index.vocabulary, words), len(index.vocabulary) - 1)
            numbers = np.where(index.vocabulary[at] == words, at, len(index.vocabulary))
        sizes = index.sizes[items]
        for size in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == size)
            most = int(index.edits[items[own[0]]])
            length = size + 3 * most
            for cut in range(0, len(own), max(1, CELLS // length)):
                some = own[cut : cut + max(1, CELLS // length)]
                item, low = items[some], begins[some] - most
                where = low[:, None] + np.arange(length)
                inside = (where >= first[texts[some], None]) & (where < first[texts[some] + 1, None])
                seen = np.where(inside, numbers[np.clip(where, 0, len(words) - 1)], len(index.vocabulary))
                codes = item[:, None] * (len(index.vocabulary) + 1) + seen
                known = np.minimum(np.searchsorted(index.members, codes), len(index.members) - 1)
                enough = np.flatnonzero((index.members[known] == codes).sum(axis=1) >= size - most)
                item = item[enough]
                wanted = index.numbers[index.first[item][:, None] + np.arange(size)]
                edits, start, end = best_stretches(wanted, seen[enough])
                for i in np.flatnonzero(edits <= most).tolist():
                    here = int(texts[some[enough[i]]])
                    move = int(low[enough[i]])
                    key = (here, index.ids[item[i]])
                    value = (int(edits[i]), size, move + int(end[i]), -(move + int(start[i])))
                    if key not in best or value < best[key]:
                        best[key] = value
    return [(*key, edits, size, -start - int(first[key[0]])) for key, (edits, size, _, start) in sorted(best.items())]


def _match(index):
    def run(batches):
        let_go()
        own = index.value
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            at, raw = byte_view(batch.column("text"))
            rows = []
            for first, end in steps(at):
                words, _, _, begin = word_hashes(raw, at[first : end + 1], _APART)
                rows += [(ids[first + d], *rest) for d, *rest in search(words, begin, own)]
            columns = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "edits", "item_words", "first_word"]
            )

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, allowed: float = ALLOWED) -> DataFrame:
    """doc_id, item_id, edits, item_words and first_word of every item found in a document.

    ``docs`` has (doc_id, text), ``benchmark`` (item_id, text). Items go to the
    tasks in passes of some ITEMS items and ITEM_BYTES bytes; a longer item is
    sent whole.
    """
    if not 0 <= allowed < 1:
        raise ValueError(f"allowed is a share below 1, not {allowed}")
    spark = docs.sparkSession
    mine = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.where("item_id is not null and text is not null").select(
        F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")
    )
    count, size = items.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    passes = max(1, -(-count // ITEMS), -(-(size or 0) // ITEM_BYTES))
    result = None
    for number in range(passes):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == number).collect()
        built = spark.sparkContext.broadcast(build([(r["item_id"], r["text"]) for r in part], allowed))
        found = mine.mapInArrow(
            _match(built), "doc_id bigint, item_id bigint, edits bigint, item_words bigint, first_word bigint"
        )
        result = found if result is None else result.unionAll(found)
    return result


def drop_leaks(docs: DataFrame, benchmark: DataFrame, allowed: float = ALLOWED) -> DataFrame:
    """The rows of ``docs`` in which no item was found, with all their columns."""
    leaks = find_leaks(docs, benchmark, allowed).select("doc_id").where("doc_id is not null").distinct()
    return docs.join(small_side(stored(leaks, "decontam-leaks")), "doc_id", "left_anti").select(*docs.columns)
