"""What the piece encoder keeps between steps."""

import random
import tracemalloc

from tripmart.llm import pieces


def _texts():
    some = random.Random(7)
    word = lambda: "".join(some.choices("abcdefghiklmnoprstuvé", k=some.randint(4, 9)))
    often = [word() for _ in range(50)]
    return [" ".join([*often, *(word() for _ in range(5_000))]) for _ in range(24)]


def test_kept_words_and_pairs_are_small():
    texts = _texts()
    encoder = pieces.Encoder(pieces.load_vocabulary(pieces.MODEL))
    tracemalloc.start()
    for text in texts:
        encoder.encode_all([text])
    kept = tracemalloc.get_traced_memory()[0] / 1e6
    tracemalloc.stop()
    assert kept < 50


def test_turns_forget_no_id(monkeypatch):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    monkeypatch.setattr(pieces, "REMEMBERED", 400)
    encoder = pieces.Encoder(pieces.load_vocabulary(pieces.MODEL))
    often = "the of and river stone"
    for text in _texts()[:4]:
        parts = text.split(" ")
        for at in range(0, 1500, 150):
            own = f"{often} {' '.join(parts[at : at + 150])} 漢 🙂"
            assert encoder.encode_all([own])[0].tolist() == library.encode(own)
            assert len(encoder.words) + len(encoder._older) <= 800
    assert "▁river" in encoder.words


def test_words_of_a_step_are_encoded_together(monkeypatch):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    encoder = pieces.Encoder(pieces.load_vocabulary(pieces.MODEL))
    walked = []
    state = encoder._state
    monkeypatch.setattr(encoder, "_state", lambda *a: walked.append(a) or state(*a))
    odd = "end.\nThe a\n\nb\u0301 漢\n字 🙂x🙂 \x00 \x00\x00a é\r\nß nœud naïve <0x0A> </s> " + "x" * 48 + " " + "ab" * 23
    texts = [odd, *_texts()]
    for text, ids in zip(texts, encoder.encode_all(texts)):
        assert ids.tolist() == library.encode(text)
        assert encoder.decode(ids) == text
    # Only words too long for a row of their own length walk the trie by themselves.
    assert len({a[0] for a in walked}) == 1 and {len(a[0]) for a in walked} == {49}


def test_letters_only_in_longer_pieces(monkeypatch):
    own = {"pieces": ["<unk>", "▁", "a", "ab", "▁a", "bc", "c"], "scores": [0, -4.0, -5.0, -1.0, -2.0, -3.0, -6.0]}
    own |= {"plain": [False] + [True] * 6, "bytes": {}, "unknown": 0}
    words = ["▁ab", "▁abc", "▁b", "▁bc", "▁a?bc", "▁aab", "▁?", "▁c"]
    ways = []
    for together in (pieces.TOGETHER, 0):
        monkeypatch.setattr(pieces, "TOGETHER", together)
        encoder = pieces.Encoder(own)
        encoder.learn(words)
        ways.append(encoder.words)
    assert ways[0] == ways[1] and len(ways[0]) == len(words)
