from __future__ import annotations

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tillscope.llm import minhash
from tillscope.llm.minhash import near_duplicates, without_near_duplicates
from tillscope.llm.textblocks import shingles

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _set(text):
    words = WORDS.findall((text or "").translate(_LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def brute_force(texts):
    """doc_id: (size of the set, smallest id reachable)."""
    sets = {k: _set(text) for k, text in texts.items()}
    root = {k: k for k in texts}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    holders = defaultdict(list)
    for k, one in sets.items():
        for shingle in one:
            holders[shingle].append(k)
    both = defaultdict(int)
    for members in holders.values():
        for pair in itertools.combinations(sorted(members), 2):
            both[pair] += 1
    for (a, b), n in both.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {k: (len(sets[k]), find(k)) for k in texts}


def _got(frame):
    return {r.id: (r.n_shingles, r.component_id) for r in near_duplicates(frame).collect()}


def test_driver_documents(documents, texts):
    assert _got(documents) == brute_force(texts)


@pytest.fixture(scope="module")
def crowd():
    """A family of near copies, of which many are not similar to the first one."""
    drawn = random.Random(8)
    base = [f"w{k}" for k in range(120)]
    texts = {}
    for k in range(150):
        words = list(base)
        for _ in range(drawn.randrange(1, 9)):
            words[drawn.randrange(len(words))] = f"x{drawn.randrange(40)}"
        texts[k] = " ".join(words)
    for k in range(150, 170):
        texts[k] = " ".join(f"y{drawn.randrange(30)}" for _ in range(60))
    texts[170] = texts[3].upper()
    return texts


def test_a_crowd(spark, crowd):
    frame = spark.createDataFrame(list(crowd.items()), "doc_id long, text string")
    assert _got(frame) == brute_force(crowd)


def test_odd_rows(odd, nothing):
    rows = {r.id: tuple(r)[1:] for r in near_duplicates(odd).collect()}
    assert near_duplicates(odd).count() == odd.count()
    assert rows[1] == (5, 1, True) and rows[2] == (5, 1, False)
    assert rows[3] == (0, 3, True) and rows[4] == (0, 4, True) and rows[5] == (0, 5, True)
    assert rows[6] == (1, 6, True) and rows[7] == (1, 7, True)
    assert rows[9][1] == 8 and rows[8][2] and not rows[9][2]
    assert rows[None] == (1, None, True)
    assert rows[11] == (1, 10, False) and rows[12] == (1, 12, True)
    kept = without_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {1, 3, 4, 5, 6, 7, 8, None, 10, 12, 13}
    assert near_duplicates(nothing).count() == without_near_duplicates(nothing).count() == 0


def test_shingles_of_one_block_and_of_parts():
    texts = ["a b c d e f", "", "A B C D E F", "a b", "\t", "x  a b c d e f"]
    data = "".join(texts).encode()
    starts = np.cumsum([0, *map(len, texts)])
    hashes, counts = shingles(np.frombuffer(data, np.uint8), starts)
    assert counts.tolist() == [2, 0, 2, 1, 0, 3]
    assert hashes[:2].tolist() == hashes[2:4].tolist()
    assert set(hashes[:2].tolist()) < set(hashes[5:].tolist())
    alone = shingles(np.frombuffer(b"a b", np.uint8), np.array([0, 3]))[0]
    assert alone.tolist() == hashes[4:5].tolist()


def test_signatures_estimate_similarity():
    drawn = np.random.default_rng(3)
    common = drawn.integers(0, 2**62, 600).astype(np.uint64)
    sets = [
        np.unique(np.concatenate((common, drawn.integers(0, 2**62, 100).astype(np.uint64))))
        for _ in range(2)
    ]
    counts = np.array([len(one) for one in sets])
    one, other = minhash.min_max_signatures(np.concatenate(sets), counts)
    assert abs((one == other).mean() - 0.75) < 0.12


def _random_sets(seed, n, tokens, sizes):
    drawn = random.Random(seed)
    pool = [drawn.getrandbits(63) for _ in range(tokens)]
    sets = []
    for _ in range(n):
        if sets and drawn.random() < 0.5:
            one = set(drawn.choice(sets))
            for _ in range(drawn.randrange(1 + len(one) // 4)):
                one.discard(drawn.choice(sorted(one)))
                one.add(drawn.choice(pool))
        else:
            one = set(drawn.sample(pool, drawn.randrange(*sizes)))
        sets.append(one)
    return sets


def _pairs(sets, components):
    return {
        (a, b)
        for a, b in itertools.combinations(range(len(sets)), 2)
        if components[a] != components[b]
        and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    }


def _prefix_pairs(spark, sets, components):
    rows = [(k, c, sorted(s)) for k, (s, c) in enumerate(zip(sets, components, strict=True))]
    kinds = "number long, component long, shingles array<long>"
    frame = spark.createDataFrame(rows, kinds).repartition(3)
    return frame, {(r.a, r.b) for r in minhash.prefix_pairs(frame).collect()}


@pytest.mark.parametrize("sizes", [(1, 9), (3, 17), (20, 60)])
def test_no_similar_pair_is_missed_by_prefixes(spark, sizes):
    sets = _random_sets(sizes[1], 160, 4 * sizes[1], sizes)
    drawn = random.Random(3)
    for components in (range(len(sets)), [drawn.choice((0, 0, 0, 1, 2, k)) for k in range(160)]):
        components = list(components)
        frame, found = _prefix_pairs(spark, sets, components)
        expected = _pairs(sets, components)
        assert expected and expected <= found
        assert all(components[a] != components[b] for a, b in found)
        candidates = spark.createDataFrame(sorted(found), "a long, b long")
        links = minhash._confirmed(candidates, frame)
        assert {(r.a, r.b) for r in links.collect()} == expected


def test_a_crowd_just_below_the_limit_has_few_candidates(spark):
    """Texts of a common half and a half of their own, 20,000 of them, and five similar pairs."""
    common = list(range(1, 41))
    sets = [set(common) | {1_000 + 31 * k + j for j in range(31)} for k in range(19_995)]
    sets += [set(list(sets[k])[:-3]) | {7, 5, 3} for k in range(5)]
    _, found = _prefix_pairs(spark, sets, list(range(20_000)))
    assert {(k, 19_995 + k) for k in range(5)} <= found and len(found) < 100


def test_small_sets_are_searched_exactly(spark, monkeypatch):
    """Links of texts of up to 16 shingles are found without any centre."""
    confirmed = minhash._confirmed
    calls = []

    def last_only(pairs, sets):
        calls.append(1)
        return confirmed(pairs, sets).filter("a < 0" if len(calls) < 3 else "true")

    monkeypatch.setattr(minhash, "_confirmed", last_only)
    texts = {k: " ".join(f"w{j}" for j in range(n)) for k, n in enumerate((8, 9, 10, 11, 12, 6))}
    texts[6] = " ".join(f"v{j}" for j in range(20))
    texts[7] = texts[6] + " more"
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert _got(frame) == brute_force(texts)


def test_copies_are_told_apart_by_row(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(5, a), (5, b), (3, a + " more"), (None, a), (None, a.upper()), (None, c), (4, "")]
    rows += [(None, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = Counter((r.doc_id, r.text) for r in without_near_duplicates(frame).collect())
    assert kept == Counter([(5, b), (3, a + " more"), (None, c), (4, ""), (None, "")])


def test_of_equal_rows_one_stays(spark):
    long, other = ("word " * 30).strip(), " ".join(f"o{k}" for k in range(30))
    rows = [(1, long)] * 5 + [(2, other)] + [(None, long.upper())] * 5
    for repeated, left in ((rows[:6], [1, 2]), (rows[6:], [None]), (rows, [1, 2])):
        frame = spark.createDataFrame(repeated, "doc_id long, text string").repartition(3)
        kept = [r.doc_id for r in without_near_duplicates(frame).collect()]
        assert sorted(kept, key=str) == left


def test_rows_are_known_by_their_files(spark, tmp_path):
    base = " ".join(f"w{k}" for k in range(60))
    rows = [(1, f"{base} {k % 2}") for k in range(40)] + [(2, "x y z")]
    path = str(tmp_path / "rows")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(path)
    table = spark.read.parquet(path)
    assert sorted(r.doc_id for r in without_near_duplicates(table).collect()) == [1, 2]
    twice = table.crossJoin(spark.createDataFrame([(1,), (2,)], "other int"))
    assert sorted(r.doc_id for r in without_near_duplicates(twice).collect()) == [1, 2]


def test_null_and_repeated_ids_are_linked(spark):
    base = [f"w{k}" for k in range(60)]
    near = [" ".join([*base, f"end{k}"]) for k in range(3)]
    other = [" ".join(f"o{k}" for k in range(30)) + end for end in ("", " more")]
    rows = [(None, near[0]), (None, near[1]), (7, other[0]), (7, "x y z"), (9, near[2])]
    rows += [(2, other[1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.id, r.component_id) for r in near_duplicates(frame).collect())
    assert got == Counter([(None, 9), (None, 9), (7, 2), (7, 7), (9, 9), (2, 2)])
