from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from tillscope.llm import queries, simhash
from tillscope.llm.simhash import majorities, near_fingerprints, shingle_hashes

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _fingerprint(text):
    words = WORDS.findall((text or "").translate(_LOWER))
    runs = [words[k : k + 4] for k in range(len(words) - 3)] or [words] * bool(words)
    hashes = [xxhash.xxh64(" ".join(run).encode(), seed=42).intdigest() for run in runs]
    ones = [sum(h >> bit & 1 for h in hashes) for bit in range(64)]
    return sum(1 << bit for bit in range(64) if 2 * ones[bit] > len(hashes))


def _components(fingerprints):
    """fingerprint: the smallest one that is reachable over at most four differing bits."""
    every = sorted(set(fingerprints))
    root = {k: k for k in every}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for at, a in enumerate(every):
        for b in every[at + 1 :]:
            if (a ^ b).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in every}


def brute_force(texts):
    signed = {k: _fingerprint(text) for k, text in texts.items()}
    component = _components(signed.values())
    least = {}
    for k in sorted(texts):
        least.setdefault(component[signed[k]], k)
    return {k: (f"{f:016x}", least[component[f]]) for k, f in signed.items()}


def test_query_on_driver_documents(spark, texts):
    rows = queries.QUERIES["op13_simhash"](spark, "/root/testdata/sf0.001")
    assert rows.columns == ["doc_id", "fingerprint", "component_id"]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in rows.collect()}
    assert got == brute_force(texts)


def test_odd_rows(odd, nothing):
    rows = near_fingerprints(odd).collect()
    assert len(rows) == odd.count() and near_fingerprints(nothing).count() == 0
    found = defaultdict(set)
    for row in rows:
        found[row.id].add((row.fingerprint, row.component_id))
    assert found[1] == {(found[2].copy().pop()[0], 1)}
    assert all(found[k] == {("0" * 16, 3)} for k in (3, 4, 5, 13))
    assert found[10] == {(f"{_fingerprint('three little words'):016x}", 10)}
    assert found[None].pop()[1] is None
    assert {f for f, _ in found[12]} == {f"{_fingerprint('x' * 50_000):016x}"}


def test_a_long_text_is_read_in_parts(monkeypatch):
    text = " ".join(f"w{k % 71}" for k in range(4_000)).encode()
    whole = shingle_hashes(text)
    assert len(whole) == 3_997
    monkeypatch.setattr(simhash, "word_lists", lambda t: iter([[w] for w in t.split()]))
    assert shingle_hashes(text) == whole and len(shingle_hashes(b"a b")) == 1


def test_majorities():
    drawn = np.random.default_rng(1)
    counts = np.array([0, 1, 2, 700, 0, 255, 256, 0])
    hashes = drawn.integers(0, 2**63, counts.sum()).astype(np.uint64)
    expected, at = [], 0
    for n in counts:
        own = [int(h) for h in hashes[at : at + n]]
        at += n
        expected.append(sum((2 * sum(h >> b & 1 for h in own) > n) << b for b in range(64)))
    assert majorities(hashes, counts).tolist() == expected


def _neighbours(many):
    """Fingerprints at 1 to 7 bits from each other, and a crowd about one centre."""
    drawn = random.Random(2)
    every = {0, 1, 2**64 - 1, 2**63}
    for _ in range(many):
        start = drawn.getrandbits(64)
        for far in range(1, 8):
            every.add(start ^ sum(1 << bit for bit in drawn.sample(range(64), far)))
    centre = drawn.getrandbits(64)
    for _ in range(2 * many):
        every.add(centre ^ sum(1 << bit for bit in drawn.sample(range(64), drawn.randrange(9))))
    return every


def _check_links(every, links):
    expected = defaultdict(set)
    for f, root in _components(every).items():
        expected[root].add(f)
    root = {f: f for f in every}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in links:
        a, b = find(a & (1 << 64) - 1), find(b & (1 << 64) - 1)
        root[max(a, b)] = min(a, b)
    got = defaultdict(set)
    for f in every:
        got[find(f)].add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


@pytest.mark.parametrize(("place_rows", "many"), [(1 << 20, 60), (300, 60), (40, 12)])
def test_links_of_fingerprints(spark, monkeypatch, place_rows, many):
    """Also where places get too many fingerprints, and are divided by further bits."""
    monkeypatch.setattr(simhash, "PLACE_ROWS", place_rows)
    every = _neighbours(many)
    signed = [f - (1 << 64) if f >> 63 else f for f in every]
    classes = spark.createDataFrame([(f,) for f in signed], "fingerprint bigint")
    _check_links(every, [(r.a, r.b) for r in simhash._links(classes).collect()])


@pytest.mark.parametrize("listed", [1 << 22, 5_000, 50])
def test_links_of_one_place(monkeypatch, listed):
    monkeypatch.setattr(simhash, "_LISTED", listed)
    monkeypatch.setattr(simhash, "_KEPT_LINKS", 500)
    every = _neighbours(12)
    values = np.array(sorted(every), dtype=np.uint64)
    forest = simhash._Forest()
    left = np.full(len(values), simhash.HALF)
    simhash.collisions(values.view(np.int64), values, left, 0, forest)
    one, other = forest.links()
    assert len(one) < len(every)
    _check_links(every, zip(one.tolist(), other.tolist(), strict=True))
