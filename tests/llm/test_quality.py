from __future__ import annotations

import itertools
import math
import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillscope.llm import quality, queries
from tillscope.llm.quality import (
    fit_model,
    good_documents,
    held_out,
    line_features,
    line_marginals,
    score_documents,
    train,
)

TABLES = os.environ.get("LABELS_SF_DIR", "/root/testdata/sf0.01")


def test_marginals_are_those_of_all_labellings():
    drawn = np.random.default_rng(1)
    counts = np.array([4, 1, 3])
    odds, transitions = drawn.normal(size=8), drawn.normal(size=(2, 2))
    marginals, pairs = line_marginals(odds, counts, transitions)
    expected, expected_pairs, at = [], np.zeros((2, 2)), 0
    for n in counts:
        good, together, total = np.zeros(n), np.zeros((2, 2)), 0.0
        for labels in itertools.product((0, 1), repeat=int(n)):
            score = sum(odds[at + k] for k in range(n) if labels[k])
            score += sum(transitions[a, b] for a, b in itertools.pairwise(labels))
            weight = np.exp(score)
            total += weight
            good += weight * np.array(labels)
            for a, b in itertools.pairwise(labels):
                together[a, b] += weight
        expected += list(good / total)
        expected_pairs += together / total
        at += n
    assert marginals == pytest.approx(expected)
    assert pairs == pytest.approx(expected_pairs)


def _features(*texts):
    data = "".join(texts).encode()
    return line_features(
        np.frombuffer(data, np.uint8), np.cumsum([0, *(len(t.encode()) for t in texts)])
    )


def test_features_do_not_depend_on_neighbouring_documents():
    texts = ["One line.\nTwo lines!!", "", "\n", "A | b |\n\nA | b | c", "x"]
    together = _features(*texts)
    assert together.counts.tolist() == [2, 1, 2, 3, 1]
    assert together.lengths.tolist() == [9, 11, 0, 0, 0, 7, 0, 9, 1]
    alone = [_features(text) for text in texts]
    assert together.features == pytest.approx(np.vstack([a.features for a in alone]))


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{TABLES}/{name}.parquet") for name in ("documents", "labels")]


@pytest.fixture(scope="module")
def model(tables):
    return train(*tables)


def test_held_out_accuracy(tables, model):
    documents, labels = tables
    scored = score_documents(documents, model).join(
        labels.withColumnRenamed("doc_id", "id"), "id"
    )
    rows = scored.withColumn("held_out", held_out(F.col("id"))).collect()
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.id).encode()) % 4 == 2)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.7)
    unseen = [row for row in rows if row.held_out]
    right = [row.predicted == row.quality for row in unseen]
    assert len(unseen) > 50 and sum(right) / len(right) > 0.96
    clean = [row.predicted for row in unseen if row.quality == 1]
    assert sum(clean) / len(clean) > 0.98


def test_query_equals_brute_force(spark, tables, model):
    """Every line's marginal by all labellings is another test; here the mean and the curve."""
    documents, labels = tables
    rows = queries.QUERIES["op10_quality"](spark, TABLES).collect()
    assert sorted(rows[0].asDict()) == ["doc_id", "held_out", "predicted", "score"]
    got = {r.doc_id: (r.held_out, r.score, r.predicted) for r in rows}
    expected = {}
    for r in documents.collect():
        lines = _features(r.text or "")
        marginals, _ = line_marginals(
            lines.features @ model.weights, lines.counts, model.transitions
        )
        weights = [max(len(line), 1) for line in (r.text or "").encode().split(b"\n")]
        quality = sum(m * w for m, w in zip(marginals, weights, strict=True)) / sum(weights)
        score = 1 / (1 + math.exp(-(model.slope * quality + model.intercept)))
        held = zlib.crc32(str(r.doc_id).encode()) % 4 == 2
        expected[r.doc_id] = (held, pytest.approx(score, abs=1e-9), int(score >= 0.7))
    assert got == expected


def test_the_curve_is_fitted_on_whole_texts(spark):
    """Long texts whose bad lines lie between the windows; the curve sees all of them."""
    good = [f"The {k} word line goes on and on, as text does." for k in range(4_000)]
    bad = [f"#### $$$ %%% {k} &&& !!!" for k in range(40)]
    rows, labels = [], []
    for k in range(120):
        lines = list(good[k : k + 3_000])
        if k % 2:
            lines[100:100] = bad * 20
        rows.append((k, "\n".join(lines)))
        labels.append((k, 1 - k % 2))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    fitted = train(frame, spark.createDataFrame(labels, "doc_id long, quality int"))
    scored = {r.id: r.score for r in score_documents(frame, fitted).collect()}
    assert min(scored[k] for k in range(0, 120, 2)) > max(scored[k] for k in range(1, 120, 2))


def test_labels_of_held_out_rows_are_not_learnt(tables, model):
    documents, labels = tables
    turned = labels.withColumn(
        "quality",
        F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")),
    )
    again = train(documents.repartition(3), turned)
    assert again.weights == pytest.approx(model.weights)
    assert (again.slope, again.intercept) == pytest.approx((model.slope, model.intercept))


def test_good_documents(tables, model):
    documents, _ = tables
    predicted = {r.id for r in score_documents(documents, model).filter("predicted = 1").collect()}
    kept = good_documents(documents, model)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == predicted


def test_odd_rows(spark, odd, nothing, model):
    rows = score_documents(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    by_text = {}
    for text, number in ((r.text, r.doc_id) for r in odd.collect()):
        by_text.setdefault(text or "", set()).update(r.score for r in rows if r.id == number)
    assert all(len(scores) == 1 for scores in by_text.values())
    assert good_documents(odd, model).schema == odd.schema
    assert score_documents(nothing, model).count() == good_documents(nothing, model).count() == 0
    known = [(1, 1), (1, 0), (None, 1), (2, None)]
    labels = spark.createDataFrame(known, "doc_id long, quality int")
    for known, share in ((labels, 0.0), (labels.limit(0), 0.5)):
        fitted = train(odd, known)
        assert {round(r.score, 6) for r in score_documents(odd, fitted).collect()} == {share}


def test_lines_of_bad_documents_are_told_apart():
    good = "\n".join(f"The {k} word line goes on and on, as text does." for k in range(6))
    bad = "#### $$$ %%% &&&\n$$$ *** !!!"
    texts = [good, good.replace("word", "plain"), f"{good}\n{bad}", bad] * 10
    lines = _features(*texts)
    fitted = fit_model(lines, np.array([1, 1, 0, 0] * 10))
    marginals, _ = line_marginals(lines.features @ fitted.weights, lines.counts, fitted.transitions)
    mixed = marginals[12:20]
    assert (mixed[:5] > 0.5).all() and (mixed[6:] < 0.5).all()
    assert quality.OWN_FEATURES * 3 + 1 == lines.features.shape[1]
