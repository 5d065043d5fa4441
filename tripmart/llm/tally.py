"""Exact counts of 32-bit keys over all tasks, shuffled as packed sorted blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PACKED = "shard int, gaps binary, counts binary"


def pack(keys: np.ndarray, shards: int) -> pa.RecordBatch:
    """The distinct keys with their counts, one packed row per shard (a range of keys)."""
    keys, counts = np.unique(keys, return_counts=True)
    cut = np.searchsorted(keys, [(s << 32) // shards for s in range(1, shards)])
    rows = [
        (s, _thin(a), np.minimum(c, 0xFFFF).astype(np.uint16).tobytes())
        for s, (a, c) in enumerate(zip(np.split(keys, cut), np.split(counts, cut)))
        if len(a)
    ]
    shard, gaps, number = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(shard, pa.int32()), pa.array(gaps, pa.binary()), pa.array(number, pa.binary())],
        ["shard", "gaps", "counts"],
    )


def _thin(keys: np.ndarray) -> bytes:
    """Sorted keys as gaps of two bytes where they fit, marked by the first byte."""
    gaps = np.diff(keys).astype(np.uint32)
    head = keys[:1].astype(np.uint32).tobytes()
    if len(gaps) and gaps.max() > 0xFFFF:
        return b"4" + head + gaps.tobytes()
    return b"2" + head + gaps.astype(np.uint16).tobytes()


def _wide(blob: bytes) -> np.ndarray:
    gaps = np.frombuffer(blob, np.uint32 if blob[:1] == b"4" else np.uint16, offset=5)
    return np.cumsum(np.concatenate([np.frombuffer(blob, np.uint32, 1, 1), gaps]), dtype=np.uint64).astype(np.uint32)


def merge(rows: pa.Table, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of one shard counted at least so often over all tasks, and their counts."""
    keys = np.concatenate([_wide(b) for b in rows.column("gaps").to_pylist()])
    counts = np.concatenate([np.frombuffer(b, np.uint16) for b in rows.column("counts").to_pylist()]).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    total = np.add.reduceat(counts, first)
    keep = total >= least
    return keys[first][keep], total[keep]
