"""SentencePiece encoding and decoding by a forward pass over a trie of words.

Texts are marked as SentencePiece does (a leading and inner mark for blanks)
and cut before each run of marks, which no piece crosses. The distinct words
of a step are sorted, which makes them the leaves of their trie in order: a
word starts from the state of the prefix it shares with the word before it.
The forward pass of merge models takes all prefixes of one length at a time as
arrays; long words and unigram models walk the trie depth first, word by word.

The forward state of a prefix is the piece that ends its encoding. For unigram
models this is the piece of the best sum of scores. A merge (BPE) model's
scores are merge ranks whose sums mean nothing; there the last piece is the one
that the merges themselves leave at the end, found from the states of shorter
prefixes: two pieces may follow each other if merging their joined text gives
just these two. The result is the library's own encoding of the model.

Defined results: null text is empty and has no piece; letters outside the
vocabulary become byte pieces (or the unknown piece if there are none); mark
characters in a text decode as blanks.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.shared import give_back, held

MARK = "▁"
#: Default place of the public vocabulary; a parameter of the operators.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Characters encoded in one step, and words remembered per process.
STEP, REMEMBERED = 1 << 18, 200_000

#: Letters of a word that is encoded together with others, words encoded together, and pairs of pieces
#: remembered per process.
TOGETHER, GROUP, PAIRS = 48, 1 << 14, 2_000_000

#: Rank of what is no piece, and the key that ends a sorted list of keys.
NONE = float("inf")
_END = np.iinfo(np.int64).max

_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def load_vocabulary(path: str) -> dict:
    """Pieces, scores and kinds of a model file, read once on the driver."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    plain = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in range(size)]
    return {
        "pieces": [model.id_to_piece(i) for i in range(size)],
        "scores": [model.get_score(i) for i in range(size)],
        "plain": plain,
        "bytes": {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)},
        "unknown": model.unk_id(),
    }


class Encoder:
    """Encodes words and whole texts with a vocabulary."""

    def __init__(self, vocabulary: dict, unigram: bool = False):
        self.pieces = vocabulary["pieces"]
        self.scores = vocabulary["scores"]
        self.ids = {p: i for i, p in enumerate(self.pieces) if vocabulary["plain"][i]}
        self.bytes, self.unknown = vocabulary["bytes"], vocabulary["unknown"]
        self.byte_of = {i: bytes([b]) for b, i in self.bytes.items()}
        self.unigram = unigram
        # Pieces of higher scores merge first.
        self.rank = {p: -self.scores[i] for p, i in self.ids.items()}
        # Lengths of the pieces that end in two given letters, longest first.
        ends: dict[str, set[int]] = {}
        for piece in self.ids:
            if len(piece) > 1:
                ends.setdefault(piece[-2:], set()).add(len(piece))
        self.lengths = {e: (*sorted(n, reverse=True), 1) for e, n in ends.items()}
        # Bytes below 128 are letters wherever they stand, others need their neighbours.
        self.is_part = np.zeros(len(self.pieces), bool)
        self.is_part[[i for b, i in self.bytes.items() if b >= 128]] = True
        letters = {i: chr(b) for b, i in self.bytes.items() if b < 128}
        self._spellings = [letters.get(i, p) for i, p in enumerate(self.pieces)]
        self.penalty = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10.0
        # Words may be cut before marks only if no piece has a mark after another letter.
        self.cuts = all(MARK not in p.lstrip(MARK) for p in self.ids)
        # Ids of a word as the bytes of an int32 array; the words before the last turn are kept apart.
        self.words: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._numbers = {**self.ids, "": len(self.pieces)}
        self._pairs: dict[int | tuple[str, str], bool] = {}
        # The same as sorted numbers, for words encoded together, and what came to them in this step.
        self._keys, self._fits, self._fresh = np.array([_END]), np.zeros(1, bool), dict[int, bool]()
        if not unigram:
            self._plant()

    def _plant(self) -> None:
        """The trie of the pieces read backwards, its edges as sorted keys (node, letter)."""
        alphabet = sorted(p for p in self.ids if len(p) == 1)
        code = {c: i for i, c in enumerate(alphabet, 1)}
        # Letters as small numbers. The last is that of letters in no piece, 0 that of letters in longer ones only.
        used = [ord(c) for c in set(chain.from_iterable(self.ids))]
        self._letters = len(alphabet) + 2
        self._codes = np.full(max(used, default=0) + 2, self._letters - 1, np.int32)
        self._codes[used] = [code.get(chr(c), 0) for c in used]
        edges: dict[int, int] = {}
        ends = [-1]
        for piece, own in self.ids.items():
            if all(c in code for c in piece):
                node = 0
                for c in reversed(piece):
                    child = edges.setdefault(node * self._letters + code[c], len(ends))
                    if child == len(ends):
                        ends.append(-1)
                    node = child
                ends[node] = own
        self._edges = np.array([*sorted(edges), _END])
        self._children = np.array([*(edges[k] for k in sorted(edges)), 0])
        # The piece that is spelled on the way to a node, or -1.
        self._ends = np.array(ends, np.int32)
        self._longest = max(map(len, self.ids), default=1)

    def merged(self, text: str) -> list[str]:
        """Pieces left by merging the best scored neighbours first, leftmost among equals."""
        get = self.rank.get
        parts = list(text)
        ranks = [get(a + b, NONE) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == NONE:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = get(parts[at] + parts[at + 1], NONE)
            if at:
                ranks[at - 1] = get(parts[at - 1] + parts[at], NONE)
        return parts

    def _follows(self, one: str, two: str) -> bool:
        first, second = self._numbers.get(one), self._numbers.get(two)
        # One number takes a third of the memory of two strings.
        key = (one, two) if first is None or second is None else first * (len(self.pieces) + 1) + second
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) > PAIRS:
                self._pairs.clear()
            known = self._pairs[key] = self.merged(one + two) == ([one, two] if one else [two])
        return known

    def _state(self, word: str, end: int, states: list[tuple[int, float]]) -> tuple[int, float]:
        """Length and score of the piece that ends the encoding of ``word[:end]``."""
        best: tuple[int, float] | None = None
        for n in self.lengths.get(word[end - 2 : end], (1,)) if end > 1 else (1,):
            if n > end:
                continue
            piece = word[end - n : end]
            own = self.ids.get(piece)
            if own is None and n > 1:
                continue
            if self.unigram:
                score = states[end - n][1] + (self.penalty if own is None else self.scores[own])
                if best is None or score > best[1]:
                    best = (n, score)
                continue
            before = word[end - n - states[end - n][0] : end - n]
            if (n == 1 or self._follows("", piece)) and (not before or self._follows(before, piece)):
                return n, 0.0
        return best or (1, 0.0)

    def _spelled(self, letter: str) -> list[int]:
        """The ids of a letter that is no piece."""
        return [self.bytes[b] for b in letter.encode("utf-8", "replace")] if self.bytes else [self.unknown]

    def _follow(self, keys: np.ndarray) -> np.ndarray:
        """Of each key (piece before, piece), whether the one may follow the other."""
        at = np.searchsorted(self._keys, keys)
        fits = self._fits[at]
        for j in np.flatnonzero(self._keys[at] != keys).tolist():
            key = int(keys[j])
            known = self._fresh.get(key)
            if known is None:
                first, second = divmod(key, len(self.pieces) + 1)
                two = self.pieces[second]
                one = self.pieces[first] if first < len(self.pieces) else ""
                known = self._fresh[key] = self.merged(one + two) == ([one, two] if one else [two])
            fits[j] = known
        return fits

    def _keep_pairs(self) -> None:
        """Sort the pairs of this step into the others."""
        if len(self._keys) + len(self._fresh) > PAIRS:
            self._keys, self._fits = self._keys[-1:], self._fits[-1:]
        new = np.array(sorted(self._fresh), np.int64)
        at = np.searchsorted(self._keys, new)
        self._fits = np.insert(self._fits, at, [self._fresh[k] for k in new.tolist()])
        self._keys = np.insert(self._keys, at, new)
        self._fresh = {}

    def _pieces_ending(self, letters: np.ndarray, word: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """For each length less one, the piece that ends in each node of the words' trie, or -1."""
        found = np.full((self._longest, len(word)), -1, np.int32)
        nodes, state = np.arange(len(word)), np.zeros(len(word), np.int64)
        for n in range(self._longest):
            inside = depth[nodes] >= n
            nodes, state = nodes[inside], state[inside]
            keys = state * self._letters + letters[word[nodes], depth[nodes] - n]
            at = np.searchsorted(self._edges, keys)
            known = self._edges[at] == keys
            nodes, state = nodes[known], self._children[at[known]]
            if not len(nodes):
                break
            found[n, nodes] = self._ends[state]
        return found

    def _learn_together(self, words: list[str]) -> list[str]:
        """Encode words given in sorted order, one length of prefixes after the other; those left out."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self._codes[np.minimum(points, len(self._codes) - 1)]
        fit = (np.minimum.reduceat(codes, np.cumsum(sizes) - sizes) > 0) & (sizes <= TOGETHER)
        mine = [words[i] for i in np.flatnonzero(fit).tolist()]
        rest = [words[i] for i in np.flatnonzero(~fit).tolist()]
        if not mine:
            return rest
        codes, sizes = codes[np.repeat(fit, sizes)], sizes[fit]
        letters = np.zeros((len(mine), int(sizes.max())), np.int32)
        letters[np.arange(letters.shape[1]) < sizes[:, None]] = codes
        # A prefix is a node of the words' trie, numbered from 1 by length and word; 0 is the empty one.
        shared = np.zeros(len(mine), np.int64)
        shared[1:] = (letters[1:] != letters[:-1]).argmax(axis=1)
        depths = np.arange(letters.shape[1])[:, None]
        new = (depths >= shared) & (depths < sizes)
        node = np.zeros((letters.shape[1] + 1, len(mine)), np.int64)
        node[1:] = np.cumsum(new).reshape(new.shape)
        depth, word = np.nonzero(new)
        found = self._pieces_ending(letters, word, depth)
        # Length and number of the piece that ends the encoding of each prefix. What follows
        # a letter in no piece is encoded as at the beginning.
        none = len(self.pieces)
        length, last = np.zeros(len(word) + 1, np.int64), np.full(len(word) + 1, none)
        bounds = np.searchsorted(depth, np.arange(letters.shape[1] + 1)).tolist()
        for d, (first, end) in enumerate(zip(bounds[:-1], bounds[1:])):
            open_ = np.arange(first, end)
            length[first + 1 : end + 1] = 1
            last[first + 1 : end + 1] = np.where(found[0, first:end] < 0, none, found[0, first:end])
            for n in range(min(self._longest - 1, d), 0, -1):
                hit = np.flatnonzero(found[n, open_] >= 0)
                if len(hit):
                    rows = open_[hit]
                    piece = found[n, rows]
                    before = last[node[d - n, word[rows]]]
                    fits = self._follow(before * (none + 1) + piece)
                    length[rows[fits] + 1], last[rows[fits] + 1] = n + 1, piece[fits]
                    open_ = np.delete(open_, hit[fits])
        # Pieces of all words at once, from their ends.
        rows, ends = np.arange(len(mine)), sizes.copy()
        turns = []
        while len(rows):
            at = node[ends[rows], rows]
            turns.append((rows, last[at]))
            ends[rows] -= length[at]
            rows = rows[ends[rows] > 0]
        counts = np.bincount(np.concatenate([r for r, _ in turns]), minlength=len(mine))
        stops = np.cumsum(counts)
        out = np.zeros(int(stops[-1]), np.int32)
        for turn, (rows, own) in enumerate(turns, 1):
            out[stops[rows] - turn] = own
        raw = out.tobytes()
        stops = [0, *(4 * stops).tolist()]
        self.words.update((w, raw[a:b]) for w, a, b in zip(mine, stops[:-1], stops[1:]))
        for i in np.unique(np.nonzero(letters == self._letters - 1)[0]).tolist():
            strange = [c for c in mine[i] if c not in self.ids]
            own = array("i", self.words[mine[i]])
            for letter in reversed(strange):
                at = len(own) - 1 - own[::-1].index(none)
                own[at : at + 1] = array("i", self._spelled(letter))
            self.words[mine[i]] = own.tobytes()
        if self._fresh:
            self._keep_pairs()
        return rest

    def learn(self, words) -> None:
        """Encode all new words of an iterable in sorted order."""
        new = []
        for word in words:
            if word not in self.words:
                known = self._older.get(word)
                if known is None:
                    new.append(word)
                else:
                    self.words[word] = known
        new.sort()
        if new and new[0] and not self.unigram:
            new = [w for first in range(0, len(new), GROUP) for w in self._learn_together(new[first : first + GROUP])]
        states: list[tuple[int, float]] = [(0, 0.0)]
        last = ""
        for word in new:
            shared, most = 0, min(len(word), len(last))
            while shared < most and word[shared] == last[shared]:
                shared += 1
            del states[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                states.append(self._state(word, end, states))
            out: list[int] = []
            end = len(word)
            while end:
                n = states[end][0]
                piece = word[end - n : end]
                own = self.ids.get(piece)
                if own is not None:
                    out.append(own)
                else:
                    out += reversed(self._spelled(piece))
                end -= n
            self.words[word] = array("i", reversed(out)).tobytes()
            last = word

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        return _WORDS.findall(marked) if self.cuts else [marked]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.split(t) for t in texts]
        if len(self.words) > REMEMBERED // 2:
            # Words met since the last turn stay, the others go.
            self._older, self.words = self.words, {}
        self.learn(set(chain.from_iterable(split)))
        get = self.words.__getitem__
        return [np.frombuffer(b"".join(map(get, words)), np.int32) for words in split]

    def decode(self, ids: np.ndarray) -> str:
        own = ids.tolist()
        if not self.is_part[ids].any():
            return "".join(map(self._spellings.__getitem__, own)).replace(MARK, " ")[1:]
        out, held = [], b""
        for i in own:
            byte = self.byte_of.get(i)
            if byte is not None:
                held += byte
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held = b""
            out.append(self.pieces[i])
        if held:
            out.append(held.decode("utf-8", "replace"))
        return "".join(out).replace(MARK, " ")[1:]


def encoder_of(vocabulary: dict, unigram: bool = False) -> Encoder:
    """The encoder of this process, with the words it has met in earlier tasks."""
    key = ("pieces", hash(tuple(vocabulary["pieces"])), hash(tuple(vocabulary["scores"])), unigram)
    return held(key, lambda: Encoder(vocabulary, unigram))


def _encode(vocabulary, unigram: bool):
    def run(batches):
        encoder = encoder_of(vocabulary.value, unigram)
        for batch in batches:
            texts = batch.column("text")
            first = 0
            while first < batch.num_rows:
                own, size = [], 0
                while first + len(own) < batch.num_rows and (not own or size < STEP):
                    own.append(texts[first + len(own)].as_py() or "")
                    size += len(own[-1])
                ids = encoder.encode_all(own)
                decoded = [encoder.decode(i) for i in ids]
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                ends = np.cumsum([0, *map(len, ids)])
                digests = [hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in decoded]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(own)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                        pa.array(list(map(len, ids)), pa.int64()),
                        pa.array(digests, pa.string()),
                        pa.array([d == t for d, t in zip(decoded, own)], pa.bool_()),
                    ],
                    ["doc_id", "ids", "n_pieces", "decoded_sha256", "exact"],
                )
                first += len(own)
            give_back()

    return run


def encode_texts(docs: DataFrame, model: str = MODEL, unigram: bool = False) -> DataFrame:
    """doc_id, ids, n_pieces, decoded_sha256 and exact of every row of ``docs`` (doc_id, text).

    ``exact`` tells whether decoding the ids gives the text again.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(load_vocabulary(model))
    mine = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return mine.mapInArrow(
        _encode(vocabulary, unigram),
        "doc_id bigint, ids array<int>, n_pieces bigint, decoded_sha256 string, exact boolean",
    )


def _decode(vocabulary):
    def run(batches):
        encoder = encoder_of(vocabulary.value)
        for batch in batches:
            texts = [encoder.decode(np.array(i.as_py() or [], np.int64)) for i in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return run


def decode_pieces(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and text of every row of ``encoded`` (doc_id, ids)."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(load_vocabulary(model))
    return encoded.select("doc_id", "ids").mapInArrow(_decode(vocabulary), "doc_id bigint, text string")
