from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tillscope.llm import packing
from tillscope.llm.packing import SEQUENCE, VOCABULARY, WordEncoder, pack_documents, place


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def _ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def _check(rows, texts, tokenizer):
    """``texts``: one for each row of the table, by id; a repeated id is packed twice."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for row in rows:
        pieces[row.id].append(row)
        sequences[row.sequence_id].append(row)
    assert pieces.keys() == texts.keys()
    for number, own in pieces.items():
        copies = len(texts[number])
        ids = _ids(tokenizer, texts[number][0])
        assert sum(p.length for p in own) == copies * len(ids)
        covered = np.zeros(len(ids), dtype=int)
        for p in own:
            assert p.doc_tokens == len(ids)
            part = np.array(ids[p.start : p.start + p.length], dtype="<u4")
            assert len(part) == p.length and zlib.crc32(part.tobytes()) == p.ids_crc32
            covered[p.start : p.start + p.length] += 1
        assert (covered == copies).all()
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == SEQUENCE or at & (at - 1) == 0


def test_driver_documents(documents, texts, tokenizer):
    rows = pack_documents(documents).collect()
    _check(rows, {k: [text] for k, text in texts.items()}, tokenizer)
    again = pack_documents(documents.repartition(3)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


@pytest.mark.parametrize("group_bytes", [packing.GROUP_BYTES, 2_000])
def test_odd_rows(odd, nothing, tokenizer, monkeypatch, group_bytes):
    monkeypatch.setattr(packing, "GROUP_BYTES", group_bytes)
    texts = defaultdict(list)
    for row in odd.collect():
        texts[row.doc_id].append(row.text)
    _check(pack_documents(odd).collect(), texts, tokenizer)
    assert pack_documents(nothing).count() == 0


def test_parts_are_encoded_like_whole_texts(tokenizer):
    encoder = WordEncoder(VOCABULARY)
    drawn = random.Random(4)
    letters = "abZ'sSt'lLdDrReEvVmM 19.,!—é×ñÀ÷́“\n\x0b\x85"
    lengths = [drawn.randrange(14) for _ in range(3000)]
    texts = ["".join(drawn.choice(letters) for _ in range(n)) for n in lengths]
    texts += ["a<|endoftext|>b C <|ENDOFTEXT|> d1", "İstanbul ΣΑΣ ﬁ x", "ß.ẞ,ſ" * 40, ""]
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        got, bounds = encoder.texts(data, np.array([0, len(data)]))
        assert got.tolist() == _ids(tokenizer, text)[:-1] and bounds.tolist() == [0, len(got)], text
    # All of them as one block: nothing is read across the end of a text.
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    starts = np.cumsum([0, *(len(text.encode()) for text in texts)])
    got, bounds = encoder.texts(data, starts, np.array([2], dtype="<u4").tobytes())
    for a, b, text in zip(bounds[:-1], bounds[1:], texts, strict=True):
        assert got[a:b].tolist() == _ids(tokenizer, text), text


def test_sequences_are_balanced_by_cost():
    drawn = random.Random(6)
    lengths = sorted((drawn.randrange(1, SEQUENCE) for _ in range(400)), reverse=True)
    pieces = place(lengths)
    cost, size = defaultdict(float), defaultdict(int)
    for _, _, length, sequence in pieces:
        cost[sequence] += length + length**2 / packing.QUADRATIC
        size[sequence] += length
    full = sum(lengths) // SEQUENCE
    assert [size[k] for k in range(full)] == [SEQUENCE] * full
    assert sum(size.values()) == sum(lengths)
    # Few are cut: at most one document where a sequence gets full.
    assert len(pieces) <= len(lengths) + len(size)
    # A sequence of one long document costs a third more than one of many short ones can.
    costs = [cost[k] for k in range(full)]
    assert max(costs) - min(costs) < 0.2 * max(costs)


def _cheapest_with_room(lengths):
    """`place` by looking at every sequence."""
    full, left = divmod(sum(lengths), SEQUENCE)
    cost, room = [0.0] * full, [SEQUENCE] * full
    tails = [1 << bit for bit in range(12, -1, -1) if left >> bit & 1]
    pieces = []
    for item, length in enumerate(lengths):
        start = 0
        while length:
            able = [k for k in range(full) if room[k] >= length] or [
                k for k in range(full) if room[k]
            ]
            if able:
                k = min(able, key=lambda k: (cost[k], k))
                taken = min(length, room[k])
                room[k] -= taken
                cost[k] += taken + taken * taken / packing.QUADRATIC
            else:
                k = next(full + n for n, tail in enumerate(tails) if tail)
                taken = min(length, tails[k - full])
                tails[k - full] -= taken
            pieces.append((item, start, taken, k))
            start += taken
            length -= taken
    return pieces


@pytest.mark.parametrize("seed", range(4))
def test_the_cheapest_sequence_with_room_is_chosen(seed):
    drawn = random.Random(seed)
    lengths = [min(SEQUENCE - 1, int(drawn.expovariate(1 / 900)) + 1) for _ in range(600)]
    lengths.sort(reverse=True)
    assert place(lengths) == _cheapest_with_room(lengths)


def test_ids_of_a_large_vocabulary_are_not_cut(odd, monkeypatch):
    some = sorted(map(tuple, pack_documents(odd.filter("doc_id > 5")).collect()))
    monkeypatch.setattr(packing.encoder(VOCABULARY), "largest_id", 1 << 16)
    assert sorted(map(tuple, pack_documents(odd.filter("doc_id > 5")).collect())) == some


def test_equal_rows_are_dealt_over_groups(spark, tokenizer, monkeypatch):
    for name, value in (("GROUP_BYTES", 200), ("HOT_BYTES", 2_000)):
        monkeypatch.setattr(packing, name, value)
    rows = [(None, "")] * 1_000 + [(7, "some words of a text")] * 500
    rows += [(k, f"text {k}") for k in range(100, 300)]
    frame = spark.createDataFrame(rows, "doc_id int, text string").repartition(6)
    got = pack_documents(frame).collect()
    texts = defaultdict(list)
    for k, text in rows:
        texts[k].append(text)
    _check(got, texts, tokenizer)
    sizes = defaultdict(int)
    for row in got:
        sizes[row.sequence_id >> 32] += 1
    assert max(sizes.values()) < 150


def test_place_of_little():
    assert place([]) == []
    assert place([1]) == [(0, 0, 1, 0)]
    assert place([3, 2]) == [(0, 0, 3, 0), (1, 0, 1, 0), (1, 1, 1, 1)]
