from __future__ import annotations

import base64
import gzip
import hashlib
import io
import os
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, In, IsNotNull, Not, StringStartsWith

from tillscope.llm import warc
from tillscope.llm.warc import (
    gzip_member,
    header_test,
    page_records,
    parse_headers,
    read_archive,
    read_warc,
    record_bytes,
    write_warc,
)

BIG, OTHER = "<p>ü</p>" * 200, "x" * 1000
PAGES = [
    (1, "http://a/1", BIG),
    (5, "http://a/5", BIG),
    (3, None, BIG),
    (2, "http://b/ü x\r\nWARC-Type: revisit", "small"),
    (4, "http://b/4", "small"),
    (6, "http://c/6", None),
    (7, "http://c/7", ""),
    (8, "http://c/8", OTHER),
    (8, "http://c/8", OTHER),
    (9, "http://c/9", OTHER[:-1]),
    (10, "http://c/10", OTHER[:-1]),
    (None, "http://d", "no id"),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*page, "clash", 0) for page in PAGES]
    schema = "page_id long, url string, html string, digest string, id int"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def archive(spark, pages, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('warc')}/pages"
    write_warc(page_records(pages), path)
    return path


def _files(path):
    folder = path.removeprefix("file://")
    return sorted(os.path.join(folder, name) for name in os.listdir(folder))


def test_round_trip(spark, archive):
    got = Counter(
        (*tuple(r)[:2], r.refers_to, r.payload_length, r.payload_digest, bytes(r.payload))
        for r in read_warc(spark, archive).collect()
    )
    expected = Counter()
    for number, _, html in PAGES:
        payload = (html or "").encode()
        same = [k for k, _, other in PAGES if (other or "").encode() == payload and k is not None]
        first = max(same) if len(payload) >= 1000 else number
        revisit = number != first
        name = "urn:page:" + ("" if number is None else str(number))
        expected[
            name,
            "revisit" if revisit else "response",
            f"urn:page:{first}" if revisit else None,
            len(payload),
            hashlib.sha1(payload).hexdigest(),
            b"" if revisit else payload,
        ] += 1
    assert got == expected
    targets = {r.record_id: r.target_uri for r in read_warc(spark, archive).collect()}
    assert targets["urn:page:3"] is None
    assert targets["urn:page:2"] == "http://b/ü%20x%0D%0AWARC-Type:%20revisit"


def test_other_gzip_readers_read_the_archives(archive):
    for file in _files(archive):
        content = gzip.open(file).read()
        assert content.startswith(b"WARC/1.1\r\n") and content.endswith(b"\r\n\r\n")


def test_predicates_belong_to_the_table(spark, archive):
    kind = ("record_type", "=", "response")
    responses = read_warc(spark, archive, where=(kind,))
    some = read_warc(spark, archive, False, (kind, ("target_uri", "startswith", "http://c")))
    assert {r.record_id for r in some.collect()} == {f"urn:page:{k}" for k in range(6, 11)}
    listed = read_warc(spark, archive, where=(("record_id", "in", ["urn:page:1", "urn:page:2"]),))
    assert listed.count() == 2
    assert responses.filter("target_uri = 'http://a/5'").count() == 1
    assert responses.union(responses.filter("record_id = 'urn:page:2'")).count() == len(PAGES) - 1
    with pytest.raises(Exception, match="where is on the columns"):
        read_warc(spark, archive, where=(("payload", "=", "x"),)).collect()


def test_filters_of_the_query_are_pushed_down(spark, archive):
    setting = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(setting)
    with warc.pushed_filters(spark):
        frame = read_warc(spark, archive, payload=False, pushdown=True).filter(
            (F.col("record_type") == "response") & F.col("target_uri").startswith("http://c")
        )
        assert {r.record_id for r in frame.collect()} == {f"urn:page:{k}" for k in range(6, 11)}
        assert "Filter" not in frame._jdf.queryExecution().executedPlan().toString().replace(
            "RuntimeFilters", ""
        )
        # Two loads have a filter each.
        kinds = [
            read_warc(spark, archive, pushdown=True).filter(F.col("record_type") == kind)
            for kind in ("response", "revisit")
        ]
        assert kinds[0].union(kinds[1]).count() == len(PAGES)
    assert spark.conf.get(setting) == before


def test_unwanted_payloads_are_not_decoded(spark, tmp_path):
    """The second record's compressed payload is damaged, far behind its headers."""
    rows = [
        {"record_id": f"urn:{k}", "record_type": kind, "target_uri": None, "refers_to": None,
         "payload": os.urandom(60_000)}
        for k, kind in enumerate(("response", "resource", "response"))
    ]
    members = [bytearray(gzip_member(record_bytes(row))) for row in rows]
    members[1][30_000:30_100] = b"\0" * 100
    (tmp_path / "damaged.warc.gz").write_bytes(b"".join(members))
    frame = read_warc(spark, str(tmp_path))
    kind = (("record_type", "=", "response"),)
    wanted = read_warc(spark, str(tmp_path), where=kind).collect()
    assert [(r.record_id, bytes(r.payload)) for r in wanted] == [
        (f"urn:{k}", rows[k]["payload"]) for k in (0, 2)
    ]
    assert read_warc(spark, str(tmp_path), payload=False).count() == 3
    with pytest.raises(Exception, match="(?i)error|invalid"):
        frame.collect()


def _rows(n, size=lambda k: k * 5000, header=""):
    """Rows and the bytes of their records; ``header`` goes into those of HTTP."""
    rows = [
        {"record_id": f"urn:{k}", "record_type": "response", "target_uri": f"http://{k}",
         "refers_to": None, "payload": os.urandom(size(k) // 2).hex().encode()}
        for k in range(n)
    ]
    records = []
    for row in rows:
        record = record_bytes(row)
        if header:
            line = f"X-Policy: {header}\r\n".encode()
            record = record.replace(b"Content-Type: text/html", line + b"Content-Type: text/html")
            _, block = parse_headers(record)
            length = len(record) - block - 4
            front = record[:block].rpartition(b"Content-Length: ")[0]
            record = front + f"Content-Length: {length}\r\n\r\n".encode() + record[block:]
        records.append(record)
    return rows, records


def _members(kind, records):
    whole = b"".join(records)
    if kind == "plain":
        return whole
    if kind == "one member":
        return gzip.compress(whole)
    if kind == "one member with lengths":
        return gzip_member(whole)
    if kind == "members of two records":
        pairs = [records[k : k + 2] for k in range(0, len(records), 2)]
        return b"".join(gzip_member(b"".join(pair)) for pair in pairs)
    if kind == "records run on":
        return b"".join(gzip.compress(whole[k : k + 700]) for k in range(0, len(whole), 700))
    if kind == "records run on, with lengths":
        return b"".join(gzip_member(whole[k : k + 700]) for k in range(0, len(whole), 700))
    if kind == "lengths":
        return b"".join(map(gzip_member, records))
    return b"".join(map(gzip.compress, records))


KINDS = [
    "plain", "no lengths", "lengths", "one member", "one member with lengths",
    "members of two records", "records run on", "records run on, with lengths",
]


@pytest.mark.parametrize("kind", KINDS)
def test_archives_of_others(kind):
    rows, records = _rows(5)
    content = _members(kind, records)
    columns = ["record_id", "payload", "payload_length"]

    def read(wanted, columns, *bounds):
        file = pa.PythonFile(io.BytesIO(content), mode="r")
        return list(read_archive(file, wanted, columns, *bounds))

    expected = [(row["record_id"], row["payload"], len(row["payload"])) for row in rows]

    def tuples(found):
        return [(r["record_id"], r["payload"], r["payload_length"]) for r in found]

    assert tuples(read(lambda row: True, columns)) == expected
    lengths = read(lambda row: True, ["record_id", "payload_length"])
    assert [r["payload_length"] for r in lengths] == [len(row["payload"]) for row in rows]
    last = read(lambda row: row["target_uri"] == "http://3", columns[:1])
    assert [r["record_id"] for r in last] == ["urn:3"]
    if kind != "plain":
        for width in (len(content) // 2 + 1, 3_000, 500):
            found = []
            for start in range(0, len(content), width):
                end = min(start + width, len(content))
                found += tuples(read(lambda row: True, columns, start, end))
            assert found == expected


def test_an_archive_that_ends_within_a_record():
    _, records = _rows(2)
    for content in (b"".join(map(gzip.compress, records))[:-500], gzip.compress(records[1][:-500])):
        with pytest.raises(EOFError):
            list(read_archive(pa.PythonFile(io.BytesIO(content), mode="r"), lambda row: True, ["payload"]))


@pytest.mark.parametrize("kind", KINDS)
def test_long_http_headers(spark, tmp_path, kind):
    rows, records = _rows(3, lambda k: 5_000, header="p" * 8_000)
    suffix = "warc" if kind == "plain" else "warc.gz"
    (tmp_path / f"long.{suffix}").write_bytes(_members(kind, records))
    for payload in (True, False):
        found = read_warc(spark, str(tmp_path), payload).collect()
        assert sorted((r.record_id, r.payload_length) for r in found) == [
            (f"urn:{k}", 5_000) for k in range(3)
        ]


def test_subfolders_and_ranges_of_large_archives(spark, tmp_path):
    rows, records = _rows(40)
    (tmp_path / "2024" / "part=1").mkdir(parents=True)
    (tmp_path / "_temporary-1").mkdir()
    (tmp_path / "2024" / "part=1" / "a.warc.gz").write_bytes(_members("lengths", records))
    (tmp_path / "2024" / "b.warc").write_bytes(_members("plain", records[:3]))
    (tmp_path / "_temporary-1" / "c.warc.gz").write_bytes(_members("lengths", records[:5]))
    table = read_warc(spark, str(tmp_path))
    assert table.count() == 43
    options = {"path": str(tmp_path), "splitbytes": "100000"}
    reader = warc.WarcReader(table.schema, options)
    planned = reader.partitions()
    ranges = [r for part in planned for r in part.ranges]
    large = [r for r in ranges if r[0].endswith("a.warc.gz")]
    assert len(large) == len(planned) - 1 > 10 and large[0][1] == 0
    found = [batch.num_rows for part in planned for batch in reader.read(part)]
    assert sum(found) == 43 and len(found) > 10


def test_headers():
    row = {"record_id": "urn:1", "record_type": "revisit", "target_uri": "http://x",
           "refers_to": "urn:2", "payload": b"abc"}
    headers, block = parse_headers(record_bytes(row))
    assert headers["warc-refers-to"] == "<urn:2>"
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    assert base64.b32decode(digest) == hashlib.sha1(b"abc").digest()
    assert record_bytes(row)[block : block + int(headers["content-length"])].endswith(
        b"Content-Length: 3\r\n\r\n"
    )


def test_predicates_follow_where():
    row = {"record_type": "response", "target_uri": None}
    kind, uri = ("record_type",), ("target_uri",)
    assert header_test(EqualTo(kind, "response"))(row)
    assert header_test(In(kind, ("a", "response")))(row)
    assert not header_test(Not(EqualTo(kind, "response")))(row)
    assert not header_test(StringStartsWith(uri, "h"))(row)
    assert not header_test(Not(StringStartsWith(uri, "h")))(row)
    assert header_test(Not(IsNotNull(uri)))(row)
    assert header_test(EqualTo(("payload",), b"")) is None


def test_a_failed_write_leaves_nothing(spark, pages, tmp_path):
    path = str(tmp_path / "failed")
    bad = page_records(pages).withColumn(
        "target_uri", F.when(F.col("record_id") == "urn:page:9", F.raise_error(F.lit("stop")))
    )
    with pytest.raises(Exception, match="stop"):
        write_warc(bad, path)
    assert not os.path.isdir(path) or not [n for n in os.listdir(path) if n.endswith(".gz")]


def test_empty_table_and_planning(spark, pages, archive, tmp_path):
    empty = str(tmp_path / "empty")
    write_warc(page_records(pages.limit(0)), empty)
    assert read_warc(spark, empty).count() == 0
    assert read_warc(spark, str(tmp_path / "nowhere")).count() == 0
    options = {"path": archive, "splitbytes": "1000"}
    reader = warc.WarcReader(read_warc(spark, archive).schema, options)
    ranges = [r for part in reader.partitions() for r in part.ranges]
    assert len(ranges) >= len(_files(archive)) and all(b - a <= 1000 for _, a, b in ranges)
    assert sum(b - a for _, a, b in ranges) == sum(map(os.path.getsize, _files(archive)))
    whole = warc.WarcReader(read_warc(spark, archive).schema, {"path": archive})
    assert len(whole.partitions()) == 1
