from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tillscope.llm import divergence
from tillscope.llm.divergence import audit_sources, pair_sums, sort_pointers

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERMS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute_force(rows, least=10, ranks=10):
    """Tuples of the result for rows (text, lang, source)."""
    documents, counts, groups = Counter(), Counter(), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = TERMS.findall((text or "").translate(_LOWER))
        documents.update((lang, term) for term in set(terms))
        counts.update((lang, source, term) for term in terms)
    out = []
    for lang, sources in groups.items():
        kept = [term for (of, term), n in documents.items() if of == lang and n >= least]
        v = len(kept)

        def shares(names):
            held = {t: sum(counts[lang, s, t] for s in names) for t in kept}
            total = sum(held.values())
            return {t: 1 + 10**9 * (n + 2) // (total + 2 * v) for t, n in held.items()}

        p = {s: shares([s]) for s in sources}
        q = shares(sources)

        def apart(a, b):
            return (a - b) ** 2 // (a + b)

        for s in sources:
            pairs = [
                (-sum(apart(p[s][t], p[o][t]) for t in kept), o.encode(), o)
                for o in sources - {s}
            ]
            terms = [
                (-apart(p[s][t], q[t]), t.encode(), t)
                for t in kept
                if counts[lang, s, t] and p[s][t] > q[t]
            ]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:ranks])):
                out += [(lang, s, part, x[2], -x[0], k + 1) for k, x in enumerate(found)]
    return Counter(out)


def _got(frame):
    result = audit_sources(frame)
    assert result.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert [kind for _, kind in result.dtypes][4:] == ["bigint", "int"]
    return Counter(map(tuple, result.collect()))


def _random_rows(n):
    drawn = random.Random(9)
    terms = ["a", "the", "Käse", "abcdefgh", "abcdefghi", "abcdefghij", "x" * 40, "x" * 41, "Ω"]
    rows = []
    for k in range(n):
        source = drawn.choice(["web", "web", "web", "books", None, "ünï"])
        text = " ".join(drawn.choice(terms[k % 3 :]) for _ in range(drawn.randrange(9)))
        rows.append((text if k % 11 else None, drawn.choice(["en", "de", None]), source))
    # A language whose terms are too rare, one of a single source, and groups without terms.
    return rows + [("rare", "fr", s) for s in "abc"] + [("one " * 3, "it", "s")] * 12 + [
        ("", "en", "silent"), ("12 34", "de", "numbers")
    ]


@pytest.mark.parametrize("cells", [1 << 21, 8])
def test_equals_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr(divergence, "PIECE_CELLS", cells)
    rows = _random_rows(400)
    frame = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    assert _got(frame) == brute_force(rows)


def test_odd_rows(odd, nothing, monkeypatch):
    rows = [(r.text, r.lang, r.source) for r in odd.collect()]
    assert _got(odd) == brute_force(rows)
    monkeypatch.setattr(divergence, "LEAST_DOCUMENTS", 2)
    assert _got(odd) == brute_force(rows, least=2)
    assert audit_sources(nothing).count() == 0


def test_pointers_are_sorted_stably():
    drawn = random.Random(1)
    terms = ["".join(drawn.choice("abxyä") for _ in range(drawn.randrange(1, 30))) for _ in range(400)]
    terms = [t.encode() for t in terms + ["q" * 8, "q" * 16, "q" * 9] * 7 + ["é" * 20] * 3]
    drawn.shuffle(terms)
    data = np.frombuffer(b" ".join(terms), np.uint8)
    lengths = np.array([len(t) for t in terms])
    begins = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    order, runs = sort_pointers(data, begins, lengths)
    assert order.tolist() == sorted(range(len(terms)), key=lambda k: (terms[k], k))
    expected = [k for k in range(len(order)) if not k or terms[order[k]] != terms[order[k - 1]]]
    assert runs.tolist() == expected
    order, runs = sort_pointers(data[:0], begins[:0], lengths[:0])
    assert len(order) == len(runs) == 0


def test_shares_are_exact():
    counts = np.array([0, 5, 10**11, 3 * 10**12])
    totals = np.array([2, 7, 10**13, 9 * 10**12])
    expected = [
        1 + 10**9 * (c + 2) // t for c, t in zip(counts.tolist(), totals.tolist(), strict=True)
    ]
    assert divergence._shares(counts, totals).tolist() == expected
    assert divergence._shares(counts[:2], totals[:2]).tolist() == expected[:2]


def test_sums_of_pairs():
    drawn = np.random.default_rng(2)
    shares = drawn.integers(1, 1000, (30, 4))
    held = drawn.random((30, 4)) < 0.4
    sums, rows = pair_sums(held, shares)
    for a in range(4):
        for b in set(range(4)) - {a}:
            seen = held[:, a] | held[:, b]
            x, y = shares[seen, a], shares[seen, b]
            assert sums[a, b] == ((x - y) ** 2 // (x + y)).sum() and rows[a, b] == seen.sum()
