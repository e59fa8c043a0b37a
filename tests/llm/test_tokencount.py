from __future__ import annotations

import random

import numpy as np
import pytest

from tillscope.llm import tokencount
from tillscope.llm.tokencount import BYTE_PENALTY, MARK, VOCABULARY, TokenTrie, count_tokens


@pytest.fixture(scope="module")
def pieces():
    return tokencount.load_pieces(VOCABULARY)


def brute_force(pieces, word):
    """Tokens of the best segmentation, over all pieces that end at each place."""
    text = MARK + word
    worst = min(pieces.values()) - BYTE_PENALTY
    longest = max(map(len, pieces))
    best = [(0.0, 0)]
    for end in range(1, len(text) + 1):
        n_bytes = len(text[end - 1].encode())
        score, fewest = best[end - 1]
        options = [(score + n_bytes * worst, -(fewest + n_bytes))]
        for start in range(max(0, end - longest), end):
            if text[start:end] in pieces:
                score, fewest = best[start]
                options.append((score + pieces[text[start:end]], -(fewest + 1)))
        score, negative = max(options)
        best.append((score, -negative))
    return best[-1][1]


def _counts(pieces, text):
    words = [word.decode() for word in (text or "").encode().split()]
    return len(words), sum(brute_force(pieces, word) for word in words)


def test_driver_documents(documents, texts, pieces):
    got = {r.id: (r.n_words, r.n_tokens) for r in count_tokens(documents).collect()}
    assert got.keys() == texts.keys()
    for number in list(texts)[::4]:
        assert got[number] == _counts(pieces, texts[number])


def test_odd_rows(odd, nothing, pieces):
    got = sorted((str(r.id), r.n_words, r.n_tokens) for r in count_tokens(odd).collect())
    known = {}
    expected = []
    for row in odd.collect():
        words = [word.decode() for word in (row.text or "").encode().split()]
        for word in set(words) - known.keys():
            known[word] = brute_force(pieces, word)
        expected.append((str(row.doc_id), len(words), sum(map(known.__getitem__, words))))
    assert got == sorted(expected)
    assert count_tokens(nothing).count() == 0


def test_a_prefix_is_scored_once(pieces, monkeypatch):
    trie = TokenTrie(pieces)
    assert trie.count([b"inter", b"international", b"internal"]) == [
        brute_force(pieces, word) for word in ("inter", "international", "internal")
    ]
    # The root, the mark, and each distinct prefix.
    assert len(trie.nodes) == 2 + len({w[:k] for w in ("international", "internal")
                                       for k in range(1, len(w) + 1)})
    before = len(trie.nodes)
    trie.count([b"intern"])
    assert len(trie.nodes) == before
    monkeypatch.setattr(tokencount, "MOST_NODES", 3)
    assert trie.count([b"new"]) == [brute_force(pieces, "new")]
    assert len(trie.nodes) < before


def test_any_words(pieces):
    trie = TokenTrie(pieces)
    drawn = random.Random(9)
    letters = "aeinrst,.'*#$!|0123é漢\x02\x01▁-_()"
    for _ in range(800):
        text = "".join(drawn.choice(letters) for _ in range(drawn.randrange(0, 90)))
        data = np.frombuffer(text.encode(), np.uint8)
        parts, more = trie.parts(data)
        assert (len(parts) - more, sum(trie.count(parts))) == _counts(pieces, text), text
