"""The queries that SQL can express against DuckDB on the driver's tables."""

from __future__ import annotations

import hashlib
import os
from collections import Counter

import duckdb
import numpy as np
import pytest
from test_lz import _likeness, _slow_ends
from test_minhash import brute_force as near_groups
from test_packing import _check as check_pieces
from test_suffix import brute_force as kept_bytes
from test_tokencount import _counts as token_counts
from tokenizers import Tokenizer

from tillscope.llm.lz import SLOTS
from tillscope.llm.packing import VOCABULARY
from tillscope.llm.queries import ORACLES, QUERIES
from tillscope.llm.textblocks import mix, substring_hashes
from tillscope.llm.tokencount import VOCABULARY as PIECES
from tillscope.llm.tokencount import load_pieces

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def _by_name(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)


def test_there_is_a_query_for_every_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_oracle(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    got = _by_name(result.columns, map(tuple, result.collect()))
    relation = duck.sql(ORACLES[name])
    assert got == _by_name(relation.columns, relation.fetchall())


COLUMNS = {
    "op1_lz_fingerprint": "doc_id bigint, n_chars bigint, edited_sha256 string, "
    "fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    "op2_warc": "page_id bigint, payload_bytes bigint, payload_digest string, "
    "record_type string, refers_to bigint",
    "op3_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
    "kept_sha256 string",
    "op4_licences": "doc_id bigint, path string, own_licence string, cosine double, "
    "licence string, licence_from string",
    "op5_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, "
    "text_sha256 string",
    "op6_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op7_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, "
    "doc_tokens bigint, sequence_id bigint, offset bigint",
    "op8_minhash": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op9_token_counts": "doc_id bigint, n_words bigint, n_tokens bigint",
    "op10_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op11_importance_resampling": "doc_id bigint, n_features bigint, weight bigint, "
    "score bigint, rank bigint",
    "op12_divergence": "lang string, source string, part string, item string, value bigint, "
    "rank int",
    "op13_simhash": "doc_id bigint, fingerprint string, component_id bigint",
}


@pytest.mark.parametrize("name", QUERIES)
def test_columns(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    found = ", ".join(f"{column} {kind}" for column, kind in result.dtypes)
    assert found == COLUMNS[name]


def _phrase_slots(text):
    """The printed fingerprint, phrase by phrase."""
    ends = _slow_ends(text)
    slots = {}
    for phrase in {text[a:b] for a, b in zip([0, *ends], ends, strict=False)}:
        points = np.array([ord(c) for c in phrase], dtype=np.uint64)
        (found,) = substring_hashes(
            mix(points + np.uint64(1)), np.array([0]), np.array([len(phrase)])
        )
        slot = int(found) * SLOTS >> 64
        slots[slot] = min(int(found), slots.get(slot, 1 << 64))
    short = np.zeros(SLOTS, dtype=">u2")
    for slot, least in slots.items():
        short[slot] = 1 + int(mix(np.array([least], dtype=np.uint64))[0]) % 65_535
    return short.tobytes().hex()


def test_op1_equals_brute_force(spark, texts):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op1_lz_fingerprint"](spark, SF_DIR).collect()}
    ids = sorted(texts)
    prints = {k: _phrase_slots(texts[k] or "") for k in ids}
    expected = {}
    for k, after in zip(ids, [*ids[1:], ids[0]], strict=True):
        text, following = texts[k] or "", texts[after] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        of_edited = _phrase_slots(edited)
        expected[k] = (
            len(text), hashlib.sha256(edited.encode()).hexdigest(), prints[k], of_edited,
            _likeness(prints[k], of_edited), _likeness(prints[k], prints[after]),
        )
    assert got == expected


def test_op2_with_revisits_equals_oracle(spark, tmp_path):
    """The driver's pages have no two equal payloads of 1,000 bytes."""
    long = "<p>ü</p>" * 200
    rows = [(k, f"http://x/{k}", long + str(k % 3)) for k in range(20)]
    rows += [(20 + k, None, "x" * (990 + k)) for k in range(20)] + [(50, "u", None)]
    rows += [(60 + k, "http://y", "x" * (999 + k % 2)) for k in range(9)]
    schema = "page_id bigint, url string, html string"
    frame = spark.createDataFrame(rows, schema).repartition(4)
    frame.write.parquet(str(tmp_path / "pages.parquet"))
    result = QUERIES["op2_warc"](spark, str(tmp_path))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    relation = connection.sql(ORACLES["op2_warc"])
    got = _by_name(result.columns, map(tuple, result.collect()))
    assert got == _by_name(relation.columns, relation.fetchall())
    kinds = Counter(row.record_type for row in result.collect())
    assert kinds["revisit"] > 20 and kinds["response"] > 20


def test_op3_equals_brute_force(spark, texts):
    got = QUERIES["op3_suffix_dedup"](spark, SF_DIR).collect()
    assert sorted(map(tuple, got), key=str) == kept_bytes(texts.items())


def test_op7_against_the_tokenizer(spark, texts):
    rows = QUERIES["op7_packing"](spark, SF_DIR).withColumnRenamed("doc_id", "id").collect()
    check_pieces(rows, {k: [text] for k, text in texts.items()}, Tokenizer.from_file(VOCABULARY))


def test_op8_equals_brute_force(spark, texts):
    rows = QUERIES["op8_minhash"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == near_groups(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_op9_equals_brute_force(spark, texts):
    pieces = load_pieces(PIECES)
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op9_token_counts"](spark, SF_DIR).collect()}
    assert got.keys() == texts.keys()
    assert all(got[k] == token_counts(pieces, texts[k]) for k in list(texts)[::12])
