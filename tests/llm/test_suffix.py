from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillscope.llm.staging import in_blocks
from tillscope.llm.suffix import LENGTH, remove_repeats
from tillscope.llm.suffixsort import BlindTrie, as_words, deep_shallow_sort


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 3), st.binary(max_size=6)), max_size=40), st.integers(1, 3)
)
def test_deep_shallow_sort(items, shallow):
    # Long common prefixes, so that the shallow sort doesn't tell the strings apart.
    items = sorted((g, (b"prefix of 16 byt" * (g % 2) + s).ljust(32, b"\0")) for g, s in items)
    random.Random(1).shuffle(items)
    items.sort(key=lambda item: item[0])
    groups = np.array([g for g, _ in items], dtype=np.int64)
    data = np.frombuffer(b"".join(s for _, s in items), dtype=np.uint8)
    lengths = np.full(len(items), 32)
    words = as_words(data, np.arange(len(items)) * 32, lengths, 32)
    order, common = deep_shallow_sort(words, groups, shallow)
    ordered = [items[k] for k in order.tolist()]
    assert ordered == sorted(items)
    for k, (group, string) in enumerate(ordered):
        if k == 0 or ordered[k - 1][0] != group:
            assert common[k] == -1
        else:
            before = ordered[k - 1][1]
            agree = next((i for i in range(32) if before[i] != string[i]), 32)
            assert common[k] == agree


@given(st.sets(st.binary(min_size=5, max_size=5), max_size=60))
def test_blind_trie(strings):
    trie = BlindTrie()
    for string in strings:
        trie.insert(string)
        trie.insert(string)
    assert trie.in_order() == sorted(strings)


def brute_force(rows):
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of each (id, text)."""
    first = {}
    for number, text in rows:
        data = (text or "").encode()
        rank = float("inf") if number is None else number
        for at in range(len(data) - LENGTH + 1):
            window = data[at : at + LENGTH]
            first[window] = min(rank, first.get(window, rank))
    out = []
    for number, text in rows:
        data = (text or "").encode()
        rank = float("inf") if number is None else number
        gone = np.zeros(len(data), dtype=bool)
        for at in range(len(data) - LENGTH + 1):
            if first[data[at : at + LENGTH]] < rank:
                gone[at : at + LENGTH] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        digest = hashlib.sha256(kept).hexdigest()
        out.append((number, len(data), int(gone.sum()), spans, digest))
    return sorted(out, key=str)


def _got(frame, **settings):
    return sorted(map(tuple, remove_repeats(frame, **settings).collect()), key=str)


@pytest.fixture(scope="module")
def shared_passages():
    """Texts of few letters that share passages of about the length that counts."""
    drawn = random.Random(2)
    passages = [
        "".join(drawn.choice("abcdefghij ") for _ in range(n)) for n in (49, 50, 51, 80, 300)
    ]
    rows = []
    for number in range(60):
        parts = []
        for _ in range(drawn.randrange(1, 5)):
            parts.append("".join(drawn.choice("xyz ") for _ in range(drawn.randrange(0, 40))))
            passage = drawn.choice(passages)
            cut = drawn.randrange(0, 3)
            parts.append(passage[cut : len(passage) - drawn.randrange(0, 3)])
        rows.append((drawn.randrange(50), "".join(parts) + "é" * drawn.randrange(3)))
    rows += [(70, rows[0][1]), (71, rows[0][1]), (72, "ab" * 200), (73, "ab" * 40), (74, "\0" * 90)]
    return [*rows, (75, "\0" * 60), (76, "q" * 49), (77, "q" * 49)]


@pytest.mark.parametrize(
    "settings", [{}, {"hot": 1}, {"block_bytes": 700}, {"block_bytes": 700, "hot": 4}]
)
def test_passages(spark, shared_passages, settings):
    frame = spark.createDataFrame(shared_passages, "doc_id long, text string")
    assert _got(frame, **settings) == brute_force(shared_passages)


def test_driver_documents(documents, texts):
    assert _got(documents) == brute_force(list(texts.items()))


def test_odd_rows(odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert _got(odd) == brute_force(rows)
    assert remove_repeats(nothing).count() == 0


def test_equal_rows_are_dealt_over_blocks(spark):
    text = "the same passage of more than fifty bytes, again and again and again"
    rows = [(None, text)] * 400 + [(3, f"{text} {k}") for k in range(5)] + [(9, "")] * 100
    frame = spark.createDataFrame(rows, "id long, text string").repartition(4)
    sizes = in_blocks(frame, 40, 2_000).groupBy("block").count().agg(F.max("count")).first()[0]
    assert sizes < 60
    frame = frame.withColumnRenamed("id", "doc_id")
    assert _got(frame, block_bytes=500) == brute_force(rows)


def test_texts_are_shuffled_once(documents):
    plan = remove_repeats(documents)
    plan.collect()
    executed = plan._jdf.queryExecution().executedPlan().toString()
    assert executed.count("ReusedExchange") >= 2
