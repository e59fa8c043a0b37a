from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

from tillscope.llm.exact import exact_groups, without_exact_copies

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _expected(rows):
    groups = defaultdict(list)
    for number, text in rows:
        groups[(text or "").translate(_LOWER)].append(number)
    out = []
    for text, members in groups.items():
        keep = max((m for m in members if m is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(m, keep, len(members), m == keep, digest) for m in members]
    return sorted(out, key=str)


def _got(frame):
    columns = ("id", "keep_id", "group_size", "kept", "digest")
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


def test_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert _got(exact_groups(odd, every_digest=True)) == _expected(rows)
    # Only rows that share length and beginning with another have their whole text hashed.
    hashed = {r.id for r in exact_groups(odd).collect() if r.digest is not None}
    assert hashed == {1, 2, 3, 4, 10, 11}


def test_equal_beginnings_are_told_apart(spark):
    start = "b" * 100
    rows = [(1, start + "x"), (2, start + "y"), (3, start + "X"), (4, "B" * 100 + "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert _got(exact_groups(frame)) == _expected(rows)


def test_documents_that_stay(odd, nothing):
    kept = without_exact_copies(odd)
    assert kept.columns == odd.columns
    # Of equal rows one stays, and a row without an id that is unlike all others.
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(
        map(str, [2, 4, 5, 6, 7, 8, 9, None, 11, 12, 13])
    )
    assert exact_groups(nothing).count() == 0
    assert without_exact_copies(nothing).count() == 0


def test_copies_are_told_apart_by_row(spark):
    a, b, c = ("letter " * 9 + x for x in "abc")
    rows = [(5, a), (5, b), (9, a.upper()), (None, a), (None, a), (None, c), (5, c), (7, None)]
    rows += [(None, None), (None, "alone")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = Counter((r.doc_id, r.text) for r in without_exact_copies(frame).collect())
    assert kept == Counter([(5, b), (9, a.upper()), (5, c), (7, None), (None, "alone")])


def test_of_equal_rows_one_stays(spark):
    rows = [(1, "same")] * 5 + [(2, "other")] + [(None, "none")] * 5 + [(3, None)] * 2 + [(3, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = Counter((r.doc_id, r.text or "") for r in without_exact_copies(frame).collect())
    assert kept == Counter([(1, "same"), (2, "other"), (None, "none"), (3, "")])


def test_documents_are_shuffled_once(documents):
    """Whole texts are hashed only where length and beginning are shared, and not moved again."""
    plan = without_exact_copies(documents)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("Join") == 1
