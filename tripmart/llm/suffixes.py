"""Removal of repeated byte strings with sharded suffix arrays.

A byte goes if a string of WINDOW bytes that covers it also starts earlier.

* Every window is assigned to its least hashed PIECE-byte string, its anchor.
  Equal windows have equal anchors, so the windows of one anchor can be compared
  apart from all others. Neighbouring windows with one anchor form a stretch.
* Two equal windows agree on the anchor and on SIDE bytes before or behind it.
  The occurrences of both are counted exactly (packed, by 32 bits of a hash),
  and those counted twice mark a bit filter of fixed size; a stretch with neither
  side marked cannot repeat, one passed wrongly costs work, never a result.
* Equal stretches are one class: all but its first occurrence go entirely.
* Anchors with different stretches are dealt into shards of bounded size. A
  shard's texts are joined, sorted by suffix (induced sorting) and compared with
  their neighbours (permuted common prefixes): windows with a common prefix of
  WINDOW bytes are equal, and all but the first of them go.
* An anchor with more text than a shard holds is resolved window by window:
  equal windows meet in an aggregation that combines inside map tasks.

Defined results: null text is empty; rows without doc_id take no part and keep
everything; rows that repeat a doc_id count as one document and should carry
one text (else the spans of all are removed from each). Further columns are
ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.sais import common_prefixes, suffix_array
from tripmart.llm.shared import byte_view, small_side, steps, stored
from tripmart.llm.tally import PACKED, merge, pack
from tripmart.llm.words import mix, powers

WINDOW, PIECE = 100, 24
SIDE = (WINDOW - PIECE) // 2
#: Bytes of text in one suffix array, and of one anchor beyond which its windows are compared singly.
SHARD_BYTES, HOT_BYTES = 1 << 20, 4 << 20
#: Bits of the filter of repeated anchor sides (sent to all tasks, 16 MB).
FILTER_BITS = 27
#: Bytes of a text looked at in one step; a longer text is cut, overlapping by a window.
LONGEST = 1 << 23

_BYTE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def stretches(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Document, first byte, number of windows, anchor, content hash and the hashes of the
    anchor with the bytes before and behind it (0 if the stretch holds fewer) of all stretches.

    ``at`` holds the offsets of the documents in ``raw``; first bytes are
    relative to ``at[0]``.
    """
    raw, at = raw[at[0] : at[-1]], at - at[0]
    n = len(raw)
    none = np.zeros(0, np.int64)
    open_at = np.flatnonzero(np.diff(at) >= WINDOW)
    if not len(open_at):
        return none, none, none, *[none.astype(np.uint64)] * 4
    up, down = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[:n], out=total[1:])
    least = mix((total[PIECE:] - total[:-PIECE]) * down[: n - PIECE + 1])
    # 40 bits of hash, then the place: the minimum is the leftmost of the least hashes.
    least = (least >> np.uint64(24) << np.uint64(24)) | np.arange(len(least), dtype=np.uint64)
    width, have = WINDOW - PIECE + 1, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    inside = np.zeros(n + 1, np.int32)
    np.add.at(inside, at[open_at], 1)
    np.add.at(inside, at[open_at + 1] - WINDOW + 1, -1)
    windows = np.flatnonzero(np.cumsum(inside[:-1]))
    chosen = least[windows]
    first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    start = windows[first]
    number = np.diff(np.r_[first, len(windows)])
    content = mix((total[start + number + WINDOW - 1] - total[start]) * down[start] + number.astype(np.uint64))
    place = (chosen[first] & np.uint64((1 << 24) - 1)).astype(np.int64)
    end = start + number + WINDOW - 1

    def side(low, high, fits, tag):
        low, high = np.where(fits, low, 0), np.where(fits, high, 0)
        return np.where(fits, mix((total[high] - total[low]) * down[low] + np.uint64(tag)) | np.uint64(1), np.uint64(0))

    before = side(place - SIDE, place + PIECE, place - SIDE >= start, 1)
    behind = side(place, place + PIECE + SIDE, place + PIECE + SIDE <= end, 2)
    doc = np.searchsorted(at, start, side="right") - 1
    return doc, start, number, chosen[first] >> np.uint64(24), content, before, behind


def _pieces(batch):
    """doc_id, first byte in the document and the rest of ``stretches`` of a batch."""
    at, raw = byte_view(batch.column("text"))
    ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
    for first, end in steps(at):
        if end == first + 1 and at[end] - at[first] > LONGEST:
            for cut in range(at[first], at[end], LONGEST):
                part = np.array([cut, min(at[end], cut + LONGEST + WINDOW - 1)])
                _, start, *rest = stretches(raw, part)
                yield np.full(len(start), ids[first]), start + cut - at[first], *rest
            continue
        doc, start, *rest = stretches(raw, at[first : end + 1])
        yield ids[first + doc], start - (at[first + doc] - at[first]), *rest


def _key(side: np.ndarray) -> np.ndarray:
    return (side >> np.uint64(32)).astype(np.uint32)


def _tally(shards: int):
    def run(batches):
        held, size = [], 0
        for batch in batches:
            for *_, before, behind in _pieces(batch):
                for side in (before, behind):
                    held.append(_key(side[side > 0]))
                    size += len(held[-1])
            if size > 8_000_000:
                yield pack(np.concatenate(held), shards)
                held, size = [], 0
        if size:
            yield pack(np.concatenate(held), shards)

    return run


def _mark(shards: int):
    """The bits of a shard's keys that occur twice or more, as a slice of the filter."""

    def run(key, rows):
        keys, _ = merge(rows, 2)
        shard = key[0].as_py()
        bits = np.zeros((1 << FILTER_BITS) // shards, bool)
        bits[(keys >> np.uint32(32 - FILTER_BITS)).astype(np.int64) - shard * len(bits)] = True
        return pa.table({"shard": pa.array([shard], pa.int32()), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    return run


def repeated_filter(docs: DataFrame) -> np.ndarray:
    """Packed bits of the anchor sides that occur twice or more, of fixed size."""
    shards = 1 << max(6, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")).bit_length())
    rows = (
        docs.mapInArrow(_tally(shards), PACKED)
        .groupBy("shard")
        .applyInArrow(_mark(shards), "shard int, bits binary")
    )
    out = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    part = len(out) // shards
    for row in rows.toLocalIterator():
        out[row["shard"] * part : (row["shard"] + 1) * part] = np.frombuffer(row["bits"], np.uint8)
    return out


_SPAN = "doc_id bigint, start bigint, bytes bigint"
_CLASS = "anchor bigint, content bigint, number int, doc_id bigint, start bigint"


def _candidates(bits):
    """First occurrences of a task's classes; its further ones as spans (anchor null)."""

    def run(batches):
        packed = bits.value
        parts = []
        for batch in batches:
            for piece in _pieces(batch):
                keep = np.zeros(len(piece[0]), bool)
                for side in piece[5:]:
                    at = (_key(side) >> np.uint32(32 - FILTER_BITS)).astype(np.int64)
                    keep |= (side > 0) & ((packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1) > 0)
                parts.append([column[keep] for column in piece[:5]])
            if sum(len(p[0]) for p in parts) > 4_000_000:
                yield from _split(parts)
                parts = []
        if parts:
            yield from _split(parts)

    return run


def _split(parts):
    doc, start, number, anchor, content = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((start, doc, number, content, anchor))
    doc, start, number, anchor, content = (c[order] for c in (doc, start, number, anchor, content))
    new = np.ones(len(doc), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1]) | (number[1:] != number[:-1])
    yield _class_rows(anchor[new].view(np.int64), content[new].view(np.int64), number[new], doc[new], start[new])
    d, s, e = _joined(doc[~new], start[~new], start[~new] + number[~new] + WINDOW - 1)
    yield _class_rows(None, None, e - s, d, s)


def _class_rows(anchor, content, number, doc, start) -> pa.RecordBatch:
    """Rows of classes or, without an anchor, of spans with their bytes as number."""
    n = len(doc)
    none = pa.nulls(n, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            none if anchor is None else pa.array(anchor),
            none if content is None else pa.array(content),
            pa.array(number.astype(np.int32)),
            pa.array(doc.astype(np.int64)),
            pa.array(start.astype(np.int64)),
        ],
        ["anchor", "content", "number", "doc_id", "start"],
    )


def _joined(doc, start, end):
    """Spans of documents with overlapping and touching ones joined."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    # Ends grow along a document; documents are set apart by a large offset.
    fresh = np.r_[True, doc[1:] != doc[:-1]]
    base = np.cumsum(fresh).astype(np.int64) << 40
    reach = np.maximum.accumulate(base + end)
    new = np.ones(len(doc), bool)
    new[1:] = base[1:] + start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    last = np.r_[at[1:] - 1, len(doc) - 1]
    return doc[at], start[at], reach[last] - base[last]


def _resolve(batches):
    """Rows sorted by (anchor, content, number, doc_id, start), all of an anchor in one task.

    Further occurrences of a class come out as spans (anchor null). The first
    ones come out with their anchor if it has two classes or more. Only the
    last class is carried from batch to batch, so a hot anchor is streamed.
    """
    last = pending = None
    for batch in batches:
        a, c, n, d, s = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        if not len(a):
            continue
        new_a, new_c = np.ones(len(a), bool), np.ones(len(a), bool)
        new_a[1:] = a[1:] != a[:-1]
        new_c[1:] = new_a[1:] | (c[1:] != c[:-1]) | (n[1:] != n[:-1])
        if last is not None:
            new_a[0] = a[0] != last[0]
            new_c[0] = new_a[0] or (c[0], n[0]) != last[1:]
        yield _class_rows(None, None, n[~new_c] + WINDOW - 1, d[~new_c], s[~new_c])
        # Classes per anchor in this batch, counting one that began in an earlier batch.
        group = np.cumsum(new_a)
        classes = np.bincount(group, weights=new_c, minlength=group[-1] + 1).astype(int)
        held = pending
        if not new_a[0]:
            if classes[0] and held is not None:
                yield _class_rows(*[np.array([x]) for x in held])
                held = None
            # An anchor continued without a pending class has had two already.
            classes[0] += 1 if pending is not None else 2
        else:
            held = None
        several = classes[group] >= 2
        out = new_c & several
        yield _class_rows(a[out], c[out], n[out], d[out], s[out])
        pending = held if group[-1] == 0 else None
        if not several[-1]:
            if group[-1] > 0 or new_a[0]:
                i = np.flatnonzero(new_c)[-1]
                pending = (a[i], c[i], n[i], d[i], s[i])
        last = (a[-1], c[-1], n[-1])


def _cut_out(batches):
    """The bytes of the stretches named in ``wanted`` (anchor, number, start) of each text."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        ids = batch.column("doc_id").to_pylist()
        out = [[], [], [], []]
        for doc, text, wanted in zip(ids, texts, batch.column("wanted").to_pylist()):
            raw = (text or "").encode()
            for w in wanted:
                row = (w["anchor"], doc, w["start"], raw[w["start"] : w["start"] + w["number"] + WINDOW - 1])
                for column, value in zip(out, row):
                    column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["anchor", "doc_id", "start", "piece"])


def repeated_windows(doc: np.ndarray, start: np.ndarray, pieces: list[bytes]) -> tuple[np.ndarray, ...]:
    """Spans (doc, start, bytes) of the windows of ``pieces`` that also start earlier."""
    size = np.array([len(p) for p in pieces], np.int64)
    # 0 ends the text, 1 ends a piece, bytes follow.
    text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.int64) + 2
    first = np.cumsum(np.r_[0, size[:-1] + 1])
    text[first + size] = 1
    text = np.r_[text, 0]
    order = suffix_array(text, 258)
    prefix = common_prefixes(text, order, WINDOW)
    of = np.searchsorted(first, np.arange(len(text)), side="right") - 1
    valid = (np.arange(len(text)) - first[of] <= size[of] - WINDOW) & (np.arange(len(text)) < len(text) - 1)
    windows = order[valid[order]]
    place = start[of[windows]] + windows - first[of[windows]]
    owner = doc[of[windows]]
    # Equal windows stand together; those whose prefix with the one before is shorter begin anew.
    group = np.cumsum(prefix[windows] < WINDOW)
    sort = np.lexsort((place, owner, group))
    later = np.ones(len(windows), bool)
    later[sort[np.flatnonzero(np.r_[True, np.diff(group[sort]) > 0])]] = False
    # The same window of a document may be in two pieces: it is the first in both.
    head = sort[np.maximum.accumulate(np.where(~later[sort], np.arange(len(sort)), 0))]
    same = np.zeros(len(windows), bool)
    same[sort] = (owner[sort] == owner[head]) & (place[sort] == place[head])
    later &= ~same
    d, s, e = _joined(owner[later], place[later], place[later] + WINDOW)
    return d, s, e - s


def _shard(rows):
    doc, start = (rows.column(c).to_numpy() for c in ("doc_id", "start"))
    d, s, n = repeated_windows(doc, start, rows.column("piece").to_pylist())
    return pa.table({"doc_id": pa.array(d), "start": pa.array(s), "bytes": pa.array(n)})


def _single(batches):
    """Every window of the pieces as a row of its own."""
    for batch in batches:
        for doc, start, piece in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "piece"))):
            number = len(piece) - WINDOW + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([piece[i : i + WINDOW] for i in range(number)], pa.binary()),
                    pa.array([doc] * number, pa.int64()),
                    pa.array(range(start, start + number), pa.int64()),
                ],
                ["window", "doc_id", "start"],
            )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Spans (doc_id, start, bytes) whose union is what has to go, for docs (doc_id, text)."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = spark.sparkContext.broadcast(repeated_filter(docs))
    seen = stored(docs.mapInArrow(_candidates(bits), _CLASS), "suffix-candidates")
    resolved = stored(
        seen.where("anchor is not null")
        .repartition(parts, "anchor")
        .sortWithinPartitions("anchor", "content", "number", "doc_id", "start")
        .mapInArrow(_resolve, _CLASS),
        "suffix-classes",
    )
    spans = seen.unionAll(resolved).where("anchor is null").select("doc_id", "start", F.col("number").cast("bigint").alias("bytes"))

    # Texts of the classes whose anchors have several.
    several = resolved.where("anchor is not null")
    wanted = several.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "number", "start")).alias("wanted"))
    ids = small_side(stored(several.select("doc_id").distinct(), "suffix-docs"))
    texts = docs.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    pieces = stored(
        texts.join(wanted, "doc_id").mapInArrow(_cut_out, "anchor bigint, doc_id bigint, start bigint, piece binary"),
        "suffix-pieces",
    )
    size = stored(pieces.groupBy("anchor").agg(F.sum(F.length("piece")).alias("size")), "suffix-sizes")
    total = size.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    shards = max(1, -(-int(total) // SHARD_BYTES))
    hot = size.where(F.col("size") > HOT_BYTES).select("anchor")
    cold = pieces.join(hot, "anchor", "left_anti")
    found = cold.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).groupBy("shard").applyInArrow(
        _shard, _SPAN
    )
    single = pieces.join(hot, "anchor", "left_semi").mapInArrow(_single, "window binary, doc_id bigint, start bigint")
    single = stored(single, "suffix-single")
    earliest = single.groupBy("window").agg(F.min(F.struct("doc_id", "start")).alias("least"))
    later = (
        single.join(earliest, "window")
        .where((F.col("doc_id") != F.col("least.doc_id")) | (F.col("start") != F.col("least.start")))
        .select("doc_id", "start", F.lit(WINDOW).cast("bigint").alias("bytes"))
    )
    return spans.unionAll(found).unionAll(later)


def _kept(batches):
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for text, spans in zip(batch.column("text"), batch.column("spans")):
            raw = (text.as_py() or "").encode()
            spans = spans.as_py() or []
            s = np.array([x["start"] for x in spans], np.int64)
            e = np.minimum(s + np.array([x["bytes"] for x in spans], np.int64), len(raw))
            fits = s < e
            _, s, e = _joined(np.zeros(fits.sum(), np.int64), s[fits], e[fits])
            at, digest = 0, hashlib.sha256()
            for a, b in zip(s.tolist(), e.tolist()):
                digest.update(raw[at:a])
                at = b
            digest.update(raw[at:])
            for column, value in zip(out, (len(raw), int((e - s).sum()), len(s), digest.hexdigest())):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(out, kinds)]],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = repeated_spans(docs.where("doc_id is not null"))
    by_doc = found.groupBy("doc_id").agg(F.collect_list(F.struct("start", "bytes")).alias("spans"))
    by_doc = stored(by_doc, "suffix-spans")
    touched = small_side(by_doc.select("doc_id"))
    result = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    hit = docs.join(touched, "doc_id", "left_semi").join(by_doc, "doc_id")
    whole = docs.join(touched, "doc_id", "left_anti").withColumn(
        "spans", F.lit(None).cast("array<struct<start:bigint,bytes:bigint>>")
    )
    return hit.select("doc_id", "text", "spans").unionAll(whole.select("doc_id", "text", "spans")).mapInArrow(_kept, result)
