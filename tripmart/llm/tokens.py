"""Token counts from pre-tokens: every distinct one is encoded once, no ids are kept.

A text's pre-tokens are what the tokenizer's normalizer and pre-tokenizer make
of it; no token crosses them, so a text has as many tokens as its pre-tokens
together. Three steps:

1. the distinct pre-tokens of all texts with the number of texts they occur in,
   combined in map tasks; each is given to the tokenizer's model once;
2. per document the frequencies of its pre-tokens. Those found in most texts
   (a table of bounded size) are added up in the task that splits the text, the
   others leave it as (key, frequency);
3. these are joined with the piece counts by key and summed per document.

A key is the pre-token itself, or a digest behind a blank (which no pre-token
holds) for long ones, so no key is wide. No key of the shuffle join is hot: the
pre-tokens of most documents are in the bounded table.

Defined results: null text is empty and has no token; special strings inside a
text are one token each, as the library counts them by default; documents
without pre-tokens have their row; rows repeat as they come, also those that
share doc_id and text; further columns are ignored; an empty table gives no
rows. A very long text, or one very long word, is split and counted whole.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.shared import stored

#: Default place of the public tokenizer; a parameter of the operators.
MODEL = "/opt/tokenizers/word_bpe_49k.json"
#: Tokens beyond which a document is over the limit.
LIMIT = 2048
#: Rows of the table of common pre-tokens that every task gets (at most KEY_BYTES + 16 bytes each).
COMMON = 1 << 17
#: Longer pre-tokens are known by their digest.
KEY_BYTES = 64
#: Pre-tokens held in one step of a task.
HELD = 1 << 18

# The normalizer and pre-tokenizer for which _Splitter has a rule of its own.
_KNOWN_NORMALIZER = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_KNOWN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Letters, numbers and white space below U+0250, after lower-casing.
_LETTERS, _NUMBERS, _BLANKS = "a-zªµºß-öø-ɏ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"


class Splitter:
    """Pre-tokens of texts, as the tokenizer file says."""

    def __init__(self, source: str):
        own = json.loads(source)
        self.source = source
        if own["truncation"] or own["padding"]:
            raise ValueError("a tokenizer with truncation or padding has no count per pre-token")
        added = own["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("only plain special strings are supported")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        steps = (own["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.known = (
            (own["normalizer"] or {}).get("normalizers") == _KNOWN_NORMALIZER
            and steps[0].get("pattern") == {"Regex": _KNOWN_PATTERN}
            and (steps[0]["behavior"], steps[0]["invert"]) == ("Removed", True)
            and [s["type"] for s in steps] == ["Split", "ByteLevel"]
            and not steps[1]["use_regex"]
            and not steps[1]["add_prefix_space"]
        )
        self.beyond = re.compile("[^\x00-ɏ]")
        self.words = re.compile(
            f"[{_LETTERS}]+|[{_NUMBERS}]|'(?:[stmd]|re|ve|ll)|[^{_BLANKS}{_LETTERS}{_NUMBERS}]+"
        )
        self._tokenizer = None

    @property
    def tokenizer(self):
        if self._tokenizer is None:
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_str(self.source)
        return self._tokenizer

    def _plain(self, text: str) -> list[str]:
        if self.known and not self.beyond.search(low := text.lower()):
            return self.words.findall(low)
        if self.tokenizer.normalizer is not None:
            text = self.tokenizer.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def split(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens of a text and the number of its special strings."""
        if self.special is None or not self.special.search(text):
            return self._plain(text), 0
        parts = self.special.split(text)
        return list(chain.from_iterable(map(self._plain, parts))), len(parts) - 1

    def pieces(self, word: str) -> int:
        """Number of pieces of one pre-token, by the tokenizer's model."""
        model = self.tokenizer.model
        return sum(len(model.tokenize(part)) for part, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(word))


def key_of(word: str) -> str:
    if len(word) * 4 <= KEY_BYTES or len(raw := word.encode()) <= KEY_BYTES:
        return word
    return " " + hashlib.sha256(raw).hexdigest()


def _distinct(source):
    """(key, text, texts): distinct pre-tokens of a step; text only where the key is a digest."""

    def rows(seen: Counter) -> pa.RecordBatch:
        words = list(seen)
        keys = list(map(key_of, words))
        texts = [None if k is w or k == w else w for k, w in zip(keys, words)]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array(texts, pa.string()), pa.array(list(seen.values()), pa.int64())],
            ["key", "word", "texts"],
        )

    def run(batches):
        splitter = Splitter(source.value)
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                seen.update(set(splitter.split(text.as_py() or "")[0]))
                if len(seen) > HELD:
                    yield rows(seen)
                    seen.clear()
        yield rows(seen)

    return run


def _count(source):
    def run(batches):
        splitter = Splitter(source.value)
        for batch in batches:
            words = [w if w is not None else k for k, w in zip(batch.column("key").to_pylist(), batch.column("word").to_pylist())]
            counts = pa.array([splitter.pieces(w) for w in words], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("texts"), counts], ["key", "texts", "pieces"])

    return run


def piece_counts(texts: DataFrame, source) -> DataFrame:
    """(key, texts, pieces): every distinct pre-token of ``texts`` (text), encoded once."""
    distinct = (
        texts.select("text")
        .mapInArrow(_distinct(source), "key string, word string, texts bigint")
        .groupBy("key", "word")
        .agg(F.sum("texts").alias("texts"))
    )
    return stored(distinct.mapInArrow(_count(source), "key string, texts bigint, pieces bigint"), "tokens-pieces")


def common_cut(counts: DataFrame, most: int = COMMON) -> int:
    """The smallest number of texts such that at most ``most`` pre-tokens occur in as many.

    Found on a scale of powers of two, so the driver sees at most 64 rows.
    """
    by_size = (
        counts.groupBy(F.floor(F.log2(F.col("texts").cast("double"))).cast("int").alias("step")).count().collect()
    )
    cut, total = 1 << 62, 0
    for step, rows in sorted(((r["step"], r["count"]) for r in by_size), reverse=True):
        total += rows
        if total > most:
            break
        cut = 1 << step
    return cut


_PARTS = "doc_id bigint, mark bigint, n_bytes bigint, n_tokens bigint, keys array<string>, times array<int>"


def _documents(source, common):
    """Per document the tokens of common pre-tokens, and keys and frequencies of the others."""

    def run(batches):
        splitter, table = Splitter(source.value), common.value
        get = table.get
        for batch in batches:
            texts, first = batch.column("text"), 0
            while first < batch.num_rows:
                sums, keys, times, ends = [], [], [], [0]
                while first + len(sums) < batch.num_rows and len(keys) < HELD:
                    words, total = splitter.split(texts[first + len(sums)].as_py() or "")
                    for word, n in Counter(words).items():
                        pieces = get(word)
                        if pieces is None:
                            key = key_of(word)
                            pieces = get(key) if key is not word else None
                            if pieces is None:
                                keys.append(key)
                                times.append(n)
                                continue
                        total += pieces * n
                    sums.append(total)
                    ends.append(len(keys))
                at = pa.array(ends, pa.int32())
                own = batch.slice(first, len(sums))
                yield pa.RecordBatch.from_arrays(
                    [
                        *own.select(["doc_id", "mark", "n_bytes"]).columns,
                        pa.array(sums, pa.int64()),
                        pa.ListArray.from_arrays(at, pa.array(keys, pa.string())),
                        pa.ListArray.from_arrays(at, pa.array(times, pa.int32())),
                    ],
                    ["doc_id", "mark", "n_bytes", "n_tokens", "keys", "times"],
                )
                first += len(sums)

    return run


def count_tokens(docs: DataFrame, model: str = MODEL, limit: int = LIMIT, most: int = COMMON) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of ``docs`` (doc_id, text).

    ``model`` is a tokenizer file of the library ``tokenizers``, read on the driver.
    """
    spark = docs.sparkSession
    with open(model, encoding="utf-8") as file:
        source = spark.sparkContext.broadcast(file.read())
    mine = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    counts = piece_counts(mine, source)
    cut = common_cut(counts, most)
    # At most ``most`` rows of narrow keys, by the choice of the cut.
    table = {r["key"]: r["pieces"] for r in counts.where(F.col("texts") >= cut).select("key", "pieces").toLocalIterator()}
    common = spark.sparkContext.broadcast(table)
    # Rows of equal doc_id and text are equal: they are summed together and shared out again.
    marked = mine.select("doc_id", F.xxhash64("text").alias("mark"), F.octet_length("text").cast("bigint").alias("n_bytes"), "text")
    parts = stored(marked.mapInArrow(_documents(source, common), _PARTS), "tokens-documents")
    rest = (
        parts.select("doc_id", "mark", "n_bytes", F.explode(F.arrays_zip("keys", "times")).alias("p"))
        .select("doc_id", "mark", "n_bytes", F.col("p.keys").alias("key"), F.col("p.times").alias("times"))
        .join(counts.where(F.col("texts") < cut), "key")
        .select("doc_id", "mark", "n_bytes", (F.col("times") * F.col("pieces")).alias("n_tokens"), F.lit(0).alias("rows"))
    )
    both = parts.select("doc_id", "mark", "n_bytes", "n_tokens", F.lit(1).alias("rows")).unionAll(rest)
    summed = both.groupBy("doc_id", "mark", "n_bytes").agg(F.sum("n_tokens").alias("total"), F.sum("rows").alias("rows"))
    return summed.select(
        "doc_id", "n_bytes", F.expr("total div rows").alias("n_tokens"), F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("copy")
    ).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
