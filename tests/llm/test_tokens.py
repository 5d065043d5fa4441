"""Token counts against the library's own encodings."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm.common import clashing, docs_of, rows_of
from tripmart.llm import queries, tokens
from tripmart.llm.shared import table


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokens.MODEL)
    return lambda text: len(own.encode(text or "", add_special_tokens=False).ids)


def by_library(docs, library):
    return sorted(
        (r["doc_id"], len((r["text"] or "").encode()), n := library(r["text"]), n > tokens.LIMIT)
        for r in docs.select("doc_id", "text").collect()
    )


def test_query_equals_the_library(spark, library):
    docs = table(spark, SMALL, "documents")
    assert sorted(rows_of(queries.QUERIES["op12_token_counts"](spark, SMALL))) == by_library(docs, library)


def test_no_common_table_and_whole_table_agree(spark, library):
    docs = table(spark, SMALL, "documents")
    expected = by_library(docs, library)
    assert sorted(rows_of(tokens.count_tokens(docs, most=0))) == expected
    assert sorted(rows_of(tokens.count_tokens(docs, most=300))) == expected


def test_awkward_rows(spark, library):
    texts = [
        None, "", " \n\t", "Hello", "hello", "Hello", "don't I'LL 'sit ''s 'x ?'s",
        "a<|endoftext|>b<|startoftext|><|ENDOFTEXT|>", "<|endoftext|>" * 3, "x" * 60_000, "ab " * 40_000,
        "y" * 65, "ü" * 33, "ü" * 32, "é ΑΣ ΟΔΟΣ İ ǅ ﬁ ½ ² 漢字 \U0001f600 \x00 \x1c \x85  ", "각",
    ]
    docs = docs_of(spark, texts)
    docs = docs.unionAll(docs.limit(8)).unionAll(docs_of(spark, [(None, "null id")]))
    found = tokens.count_tokens(clashing(docs).withColumn("key", F.lit(1)).withColumn("mark", F.lit("m")))
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    expected = [(r["doc_id"], len((r["text"] or "").encode()), n := library(r["text"]), n > 2048) for r in docs.collect()]
    assert sorted(rows_of(found), key=key) == sorted(expected, key=key)


def test_empty_table(spark):
    assert rows_of(tokens.count_tokens(docs_of(spark, []))) == []


def test_split_of_every_low_letter_and_of_random_texts(library):
    splitter = tokens.Splitter(open(tokens.MODEL, encoding="utf-8").read())
    draw = random.Random(5)

    def count(text):
        words, special = splitter.split(text)
        return special + sum(map(splitter.pieces, words))

    lowered = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and max(chr(c).lower()) < "\u0250"]
    assert len(lowered) > 0x230
    for code in {*range(0x250), *lowered}:
        text = f"ab{chr(code)}cd {chr(code)}{chr(code)} 1{chr(code)}'s{chr(code)}"
        assert count(text) == library(text), hex(code)
    low = [chr(c) for c in range(0x250)] + list("'''''stmdrevell   \n<|>") * 20
    wide = low + ["́", "̈", "Σ", "ς", "İ", "ก", "ा", "漢", "😀", " ", " ", "Ⅷ", "٣", "<|endoftext|>", "가", "ᄀ", "ᅡ"] * 20
    for letters in (low, wide):
        for _ in range(1500):
            text = "".join(draw.choices(letters, k=draw.randrange(40)))
            assert count(text) == library(text), text


def test_other_tokenizer_by_its_own_rules(spark):
    from tokenizers import Tokenizer

    path = "/opt/tokenizers/byte_bpe_50k.json"
    own = Tokenizer.from_file(path)
    docs = table(spark, SMALL, "documents").limit(40)
    expected = sorted((r["doc_id"], len(own.encode(r["text"], add_special_tokens=False).ids)) for r in docs.collect())
    assert sorted(rows_of(tokens.count_tokens(docs, path).select("doc_id", "n_tokens"))) == expected


def test_common_cut_stays_within_its_bound(spark):
    rows = [(str(i), 2 ** (i % 9) + i % 2) for i in range(900)]
    counts = spark.createDataFrame(rows, "key string, texts bigint")
    for most in (0, 50, 100, 250, 900, 5000):
        cut = tokens.common_cut(counts, most)
        assert sum(n >= cut for _, n in rows) <= most
    assert tokens.common_cut(counts, 900) == 1
