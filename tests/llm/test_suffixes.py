import hashlib
import random

import numpy as np
import pytest

from tests.conftest import SMALL
from tests.llm.common import clashing, docs_of
from tripmart.llm import suffixes
from tripmart.llm.sais import common_prefixes, suffix_array
from tripmart.llm.shared import table


def brute(texts) -> dict:
    seen, out = set(), {}
    for i, text in sorted(texts):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for at in range(len(raw) - 99):
            window = raw[at : at + 100]
            if window in seen:
                gone[at : at + 100] = True
            seen.add(window)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = int(np.sum(np.diff(np.r_[0, gone.astype(int)]) == 1))
        out[i] = (len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def found(frame) -> dict:
    return {r["doc_id"]: tuple(r)[1:] for r in suffixes.remove_repeats(frame).collect()}


def test_equals_brute_force_on_the_smallest_tables(spark):
    documents = table(spark, SMALL, "documents")
    texts = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert found(documents) == brute(texts)


@pytest.mark.parametrize("hot", [1 << 22, 300])
def test_edited_copies_and_passages(spark, monkeypatch, hot):
    """Also with every anchor resolved window by window, and with tiny shards."""
    monkeypatch.setattr(suffixes, "HOT_BYTES", hot)
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 4000)
    draw = random.Random(9)
    letters = "abcdefgh äß\n"
    passage = "".join(draw.choice(letters) for _ in range(400))
    texts = []
    for i in range(30):
        own = "".join(draw.choice(letters) for _ in range(draw.randrange(50, 300)))
        cut, size = draw.randrange(200), draw.randrange(60, 400)
        texts.append(own + passage[cut : cut + size] + own[: draw.randrange(1, 250)])
    texts += ["ab" * 300, "x" * 99, "x" * 100, "x" * 101, "y" * 350, "ab" * 60, texts[3]]
    rows = list(enumerate(texts))
    assert found(docs_of(spark, rows).repartition(5)) == brute(rows)


def test_awkward_rows(spark):
    long = "".join(f"{i} and more; " for i in range(20_000))
    rows = [(0, None), (1, ""), (2, "short"), (3, long), (4, long), (5, "\0" * 120), (6, "ü" * 80)]
    result = found(clashing(docs_of(spark, rows)))
    assert result == brute(rows)
    assert found(docs_of(spark, [])) == {}
    null = suffixes.remove_repeats(docs_of(spark, [(None, long), (1, long)])).collect()
    assert all(r["n_removed"] == 0 for r in null) and len(null) == 2


def test_suffix_arrays_equal_sorted_suffixes():
    draw = np.random.default_rng(2)
    for _ in range(150):
        kinds = int(draw.integers(2, 6))
        text = np.r_[draw.integers(1, kinds, int(draw.integers(1, 80))), 0]
        order = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert suffix_array(text, kinds).tolist() == order
        wide = np.where(text > 0, text + 1000, 0)
        assert suffix_array(wide, 1100).tolist() == order
        prefix = common_prefixes(text, np.array(order), 7)
        for a, b in zip(order, order[1:]):
            n = 0
            while n < 7 and max(a, b) + n < len(text) and text[a + n] == text[b + n]:
                n += 1
            assert prefix[b] == n
