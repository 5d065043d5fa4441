"""Toxicity scores from a learned lexicon, misspellings and context windows.

1. Spark counts, over all labelled training texts, in how many toxic and clean
   texts each word and each word beginning occurs. Those that lean clearly
   towards toxic texts form the lexicon, however many they are. A beginning with
   the counts of the one a letter shorter says nothing else and is left out.
2. The lexicon is a trie. A word matches a term exactly, by a beginning that is
   a term, or misspelled: the trie is walked together with the term's
   Levenshtein automaton, here the word's row of distances, cut off where no
   continuation stays within one edit.
3. Each match is judged in its window of words: quotation marks around it or a
   reporting word before it speak for quotation, other matches for abuse.
4. A logistic regression on the sums of these matches is fitted on at most
   FIT_ROWS labelled rows (those with the smallest hash of doc_id).

Defined results: null and empty texts get the score of a text without matches;
repeated rows give equal rows; without labels of both kinds the score is 0.
Further columns are ignored. A null doc_id is never learned from.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.shared import held, small_side, stored

#: Least log-likelihood ratio statistic of a term (about five standard errors, since
#: hundreds of thousands of terms are tried), and least toxic texts with it.
LEAST_G, LEAST_TEXTS = 25.0, 4
#: Letters of the shortest term of each kind.
WORD, STEM, FUZZY = 3, 4, 5
LONGEST_STEM = 9
#: Words on each side of a match that count as its context.
WINDOW = 8
FIT_ROWS = 50_000
#: Words remembered as matching nothing, per process.
REMEMBERED = 400_000

_WORD = re.compile(r"[^\W\d_]+")
_OPEN, _CLOSE = "\"“„«‹‘'", "\"”“»›’'"
# Words that report what somebody else said.
_REPORTING = frozenset(
    "said says say called calls wrote writes quote quoted quotes reported dit disait écrit cite citation "
    "sagte sagt schrieb zitat zitiert nannte dijo dice escribió cita citó llamó".split()
)
FEATURES = 8


def _terms(text: str) -> set[str]:
    """Words and, marked by a star, word beginnings of a text."""
    words = {w for w in _WORD.findall(text.lower()) if len(w) >= WORD}
    return words | {f"{w[:n]}*" for w in words for n in range(STEM, min(len(w), LONGEST_STEM + 1))}


def _count(batches):
    toxic: Counter = Counter()
    clean: Counter = Counter()

    def rows():
        terms = list(toxic.keys() | clean.keys())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(terms, pa.string()),
                pa.array([toxic[t] for t in terms], pa.int64()),
                pa.array([clean[t] for t in terms], pa.int64()),
            ],
            ["term", "toxic", "clean"],
        )

    for batch in batches:
        for text, label in zip(batch.column("text"), batch.column("toxic")):
            (toxic if label.as_py() else clean).update(_terms(text.as_py() or ""))
            if len(toxic) + len(clean) > 1_500_000:
                yield rows()
                toxic.clear()
                clean.clear()
    yield rows()


def learn_lexicon(labelled: DataFrame) -> dict[str, float]:
    """Terms with their log odds, from all rows of ``labelled`` (text, toxic)."""
    texts = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = texts.get(1, 0), texts.get(0, 0)
    if not bad or not good:
        return {}
    counted = (
        labelled.mapInArrow(_count, "term string, toxic bigint, clean bigint")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") >= LEAST_TEXTS)
    )
    half = F.lit(0.5)
    odds = F.log((F.col("toxic") + half) / (bad - F.col("toxic") + half)) - F.log(
        (F.col("clean") + half) / (good - F.col("clean") + half)
    )
    texts = bad + good

    def times_log(x):
        x = x.cast("double") if hasattr(x, "cast") else F.lit(float(x))
        return F.when(x > 0, x * F.log(x)).otherwise(0.0)

    ratio = 2 * (
        times_log(F.col("toxic"))
        + times_log(F.col("clean"))
        + times_log(bad - F.col("toxic"))
        + times_log(good - F.col("clean"))
        - times_log(F.col("toxic") + F.col("clean"))
        - times_log(texts - F.col("toxic") - F.col("clean"))
        - times_log(bad)
        - times_log(good)
        + times_log(texts)
    )
    kept = stored(
        counted.select("term", "toxic", "clean", odds.alias("odds"), F.round(ratio, 6).alias("g")).where(
            (F.col("g") >= LEAST_G) & (F.col("odds") >= 1)
        ),
        "toxicity-lexicon",
    )
    # The longest beginning counts: without one that has the counts, and so the weight, of the
    # beginning a letter shorter, that one gives every word the same weight.
    stems = kept.where("term like '%*'")
    longer = F.concat(F.expr("substring(term, 1, length(term) - 2)"), F.lit("*"))
    same = stems.select(F.col("term").alias("shorter"), F.col("toxic").alias("toxic_"), F.col("clean").alias("clean_"))
    own = kept.withColumn("shorter_", F.when(F.col("term").endswith("*"), longer))
    rows = own.join(
        same,
        (own.shorter_ == same.shorter) & (own.toxic == same.toxic_) & (own.clean == same.clean_),
        "left_anti",
    ).select("term", "odds").orderBy("term").collect()
    return {r["term"]: r["odds"] for r in rows}


def build_trie(words: list[str]) -> dict:
    """Nested dictionaries by letter; the empty key holds the term that ends there."""
    root: dict = {}
    for word in words:
        node = root
        for letter in word:
            node = node.setdefault(letter, {})
        node[""] = word
    return root


def near_terms(word: str, trie: dict) -> list[str]:
    """Terms of the trie within one edit of a word.

    The states of the word's Levenshtein automaton are a place in the word and
    whether the edit is spent. The unspent states follow the word itself; from
    each of them every edit leads to a spent state, which has to match exactly.
    """
    found = set()

    def exact(node: dict, at: int) -> None:
        while at < len(word):
            node = node.get(word[at])
            if node is None:
                return
            at += 1
        if "" in node:
            found.add(node[""])

    node: dict | None = trie
    for at in range(len(word) + 1):
        exact(node, at + 1) if at < len(word) else None  # a letter too many
        for letter, child in node.items():
            if letter:
                exact(child, at)  # a letter missing
                if at < len(word) and letter != word[at]:
                    exact(child, at + 1)  # another letter
        if at == len(word):
            if "" in node:
                found.add(node[""])
            break
        node = node.get(word[at])
        if node is None:
            break
    return sorted(found)


def _shorter(word: str) -> list[str]:
    """A word and all its forms with one letter left out."""
    return [word, *[word[:i] + word[i + 1 :] for i in range(len(word))]]


def _whole_word(text: str, word: str, start: int) -> int:
    """Place of the next occurrence of a word that is not part of a longer one."""
    at = text.find(word, start)
    while (at > 0 and _WORD.match(text, at - 1)) or _WORD.match(text, at).end() != at + len(word):
        at = text.find(word, at + 1)
    return at


class Matcher:
    """Finds lexicon terms in texts and turns them into features."""

    def __init__(self, lexicon: dict[str, float]):
        self.words = {t: w for t, w in lexicon.items() if t[-1] != "*"}
        self.stems = {t[:-1]: w for t, w in lexicon.items() if t[-1] == "*"}
        fuzzy = [t for t in self.words if len(t) >= FUZZY]
        self.trie = build_trie(fuzzy)
        # Within one edit, a word and a term share themselves or a form with one letter less.
        self.forms = {form for t in fuzzy for form in _shorter(t)}
        self.known: dict[str, tuple[float, int]] = {}
        self.none: set[str] = set()

    def classify(self, word: str) -> tuple[float, int] | None:
        """Weight and kind (0 exact, 1 beginning, 2 misspelled) of a word."""
        if word in self.words:
            return self.words[word], 0
        for n in range(min(len(word) - 1, LONGEST_STEM), STEM - 1, -1):
            if word[:n] in self.stems:
                return self.stems[word[:n]], 1
        if len(word) >= FUZZY - 1 and not self.forms.isdisjoint(_shorter(word)):
            near = near_terms(word, self.trie)
            if near:
                return max(self.words[t] for t in near), 2
        return None

    def features(self, text: str) -> list[float]:
        low = text.lower()
        found = _WORD.findall(low)
        hits = []
        for word in set(found) - self.none:
            own = self.known.get(word)
            if own is None:
                own = self.classify(word) if len(word) >= WORD else None
                if own is None:
                    if len(self.none) >= REMEMBERED:
                        self.none.clear()
                    self.none.add(word)
                    continue
                self.known[word] = own
            hits.append((word, own))
        n = len(found)
        if not hits:
            return [0.0] * (FEATURES - 1) + [np.log1p(n)]
        return self._judge(low, found, dict(hits), n)

    def _judge(self, low: str, found: list[str], hits: dict[str, tuple[float, int]], n: int) -> list[float]:
        at = [i for i, word in enumerate(found) if word in hits]
        places = set(at)
        end = 0
        sums, number, abuse, quoted = [0.0, 0.0, 0.0], 0, 0.0, 0.0
        for i in at:
            word = found[i]
            start = _whole_word(low, word, end)
            end = start + len(word)
            weight, kind = hits[word]
            sums[kind] += weight
            number += 1
            window = range(max(0, i - WINDOW), min(n, i + WINDOW + 1))
            before, after = low[max(0, start - 1) : start], low[end : end + 1]
            is_quoted = (before and before in _OPEN and after and after in _CLOSE) or any(
                found[j] in _REPORTING for j in window if j < i
            )
            if is_quoted:
                quoted += weight
            else:
                abuse += weight * (1 + sum(j in places for j in window if j != i))
        distinct = sum(w for w, _ in hits.values())
        return [
            float(np.log1p(sums[0])),
            float(np.log1p(sums[1])),
            float(np.log1p(sums[2])),
            float(np.log1p(distinct)),
            float(np.log1p(abuse)),
            float(np.log1p(quoted)),
            float(sum(sums) / max(n, 1)),
            float(np.log1p(n)),
        ]


def matcher_of(lexicon: dict[str, float]) -> Matcher:
    """The matcher of this process, with the words it has met in earlier tasks."""
    return held(("toxicity", hash(frozenset(lexicon.items()))), lambda: Matcher(lexicon))


def _measure(lexicon):
    def run(batches):
        matcher = matcher_of(lexicon.value)
        for batch in batches:
            rows = [matcher.features(text.as_py() or "") for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(rows, pa.list_(pa.float64()))],
                ["doc_id", "toxic", "features"],
            )

    return run


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, scales and coefficients (constant last) by Newton's method."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    beta = np.zeros(z.shape[1])
    penalty = np.r_[np.full(z.shape[1] - 1, ridge), 1e-6]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, beta


def learn(labelled: DataFrame):
    """Lexicon and classifier from ``labelled`` (doc_id, text, toxic in 0 and 1)."""
    spark = labelled.sparkSession
    labelled = stored(labelled, "toxicity-labelled")
    lexicon = spark.sparkContext.broadcast(learn_lexicon(labelled))
    sample = (
        labelled.mapInArrow(_measure(lexicon), "doc_id bigint, toxic int, features array<double>")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic")
        .limit(FIT_ROWS)
        .collect()
    )
    sample = sorted(sample, key=lambda r: (r["doc_id"], r["toxic"], r["features"]))
    y = np.array([r["toxic"] for r in sample], float)
    if not len(y) or y.min() == y.max() or not lexicon.value:
        return lexicon, None
    return lexicon, fit_logistic(np.array([r["features"] for r in sample]), y)


def _scores(matcher: Matcher, model, texts: pa.Array) -> np.ndarray:
    if model is None:
        return np.zeros(len(texts))
    mean, scale, beta = model
    x = np.array([matcher.features(text.as_py() or "") for text in texts]).reshape(-1, FEATURES)
    odds = ((x - mean) / scale * beta[:-1]).sum(axis=1) + beta[-1]
    return np.round(1 / (1 + np.exp(-np.clip(odds, -30, 30))), 6)


def _score(lexicon, model, threshold: float):
    def run(batches):
        matcher = matcher_of(lexicon.value)
        for batch in batches:
            score = _scores(matcher, model, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["doc_id", "held_out"]).columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return run


def _keep(lexicon, model, threshold: float):
    def run(batches):
        matcher = matcher_of(lexicon.value)
        for batch in batches:
            yield batch.filter(pa.array(_scores(matcher, model, batch.column("text")) < threshold))

    return run


def training_rows(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """Labelled texts outside the held-out fold."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("toxic in (0, 1)").where(F.crc32(F.col("doc_id").cast("string")) % folds != held_out)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(small_side(known), "doc_id").select("doc_id", "text", "toxic")


def score_texts(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, folds: int = 3, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs`` (doc_id, text)."""
    lexicon, model = learn(training_rows(docs, labels, folds, held_out))
    mine = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.crc32(F.col("doc_id").cast("string")) % folds == held_out).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    return mine.mapInArrow(
        _score(lexicon, model, threshold), "doc_id bigint, held_out boolean, score double, predicted int"
    )


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose score stays below the threshold, with all their columns."""
    lexicon, model = learn(training_rows(docs, labels))
    return docs.mapInArrow(_keep(lexicon, model, threshold), docs.schema)
