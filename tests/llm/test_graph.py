from __future__ import annotations

import random

import numpy as np
import pytest

from tillscope.llm.graph import connected_components, smallest_reachable


def brute_force(links):
    root = {}

    def find(k):
        while root.setdefault(k, k) != k:
            k = root[k]
        return k

    for a, b in links:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {k: find(k) for k in root}


def _random_links(seed, nodes, n):
    drawn = random.Random(seed)
    return [(drawn.randrange(-nodes, nodes), drawn.randrange(-nodes, nodes)) for _ in range(n)]


CASES = {
    "none": [],
    "loops and nulls": [(1, 1), (None, 2), (3, None)],
    "path": [(k, k + 1) for k in range(60)],
    "path of shuffled nodes": [(k * 7919 % 1009, (k + 1) * 7919 % 1009) for k in range(150)],
    "hub": [(k, 5_000) for k in range(2_000)] + [(9_000, 5_000), (9_000, -7)],
    "repeated": [(2, 1)] * 50 + [(1, 2)] * 50,
    "many small ones": _random_links(3, 2_000, 1_500),
    "one large one": _random_links(4, 300, 2_000),
    "far apart": [(-(2**62), 2**62), (2**62, 0)],
}


@pytest.mark.parametrize("case", CASES)
def test_components(spark, case):
    links = CASES[case]
    frame = spark.createDataFrame(links, "a bigint, b bigint").repartition(7)
    got = {r.node: r.component for r in connected_components(frame).collect()}
    assert got == brute_force(links)
    assert connected_components(frame).count() == len(got)


def test_contraction_of_one_partition():
    links = _random_links(5, 500, 400)
    one, other = (np.array(side) for side in zip(*links, strict=True))
    nodes, roots = smallest_reachable(one, other)
    expected = {k: k for link in links for k in link} | brute_force(links)
    assert dict(zip(nodes.tolist(), roots.tolist(), strict=True)) == expected
