"""Exact dedup by progressive refinement.

Rows are told apart first by the length of their text, then by a hash of its beginning,
and only rows that still share both with another have their whole text hashed. Texts
are equal when identical after lower-casing A-Z only.

Defined cases: a null text is empty, and empty texts are equal; rows are compared one by
one, so rows that repeat an id are members of a group like any others. All
rows with the id that stays are marked as kept; `without_exact_copies` keeps exactly one row of each
group, one with the largest id, where a null is less than any id. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm.staging import own_shuffle, staged
from tillscope.llm.textblocks import LOWER, Block, blocks

PREFIX_CHARS = 64
_HEAD = ["n_bytes", "beginning"]


def _digests(block: Block, wanted: Iterable[bool]) -> list[str | None]:
    data, starts = memoryview(LOWER[block.data]), block.starts.tolist()
    return [
        hashlib.sha256(data[a:b]).hexdigest() if want else None
        for a, b, want in zip(starts, starts[1:], wanted, strict=False)
    ]


def _hash_whole(every_row: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            wanted = block.rows.column("shared").to_pylist()
            digests = _digests(block, [every_row or want for want in wanted])
            yield pa.RecordBatch.from_arrays(
                [
                    block.rows.column("id"),
                    block.rows.column("shared"),
                    pa.array(digests, pa.string()),
                ],
                names=["id", "shared", "digest"],
            )

    return run


def _lowered(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _with_shared(rows: DataFrame, text: Column) -> tuple[DataFrame, DataFrame]:
    """The rows with length and beginning of their text, and those that several rows have."""
    beginning = F.xxhash64(_lowered(F.substring(text, 1, PREFIX_CHARS)))
    rows = rows.withColumns({"n_bytes": F.octet_length(text), "beginning": beginning})
    heads = staged(rows.select(*_HEAD), "exact-heads")
    lengths = heads.groupBy("n_bytes").count().filter("count > 1").select("n_bytes")
    # Rows of one length may be many, but those of a large group begin alike: counted first.
    classes = (
        heads.groupBy(*_HEAD)
        .count()
        .join(lengths, "n_bytes", "left_semi")
        .filter("count > 1")
        .select(*_HEAD, F.lit(True).alias("shared"))
    )
    return rows, classes


def exact_groups(
    documents: DataFrame, row_id: str = "doc_id", text: str = "text", every_digest: bool = False
) -> DataFrame:
    """For every row: id, keep_id (the largest of its group), group_size, kept and digest.

    ``digest`` is the SHA-256 of the normalised text. A row that length or beginning
    already tells apart has none, unless ``every_digest`` asks for it. Each text is
    shuffled once, to meet the classes that are shared; a class of very many rows
    is a skewed join key, which adaptive execution splits.
    """
    rows = documents.select(
        F.col(row_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    rows, classes = _with_shared(rows, F.col("text"))
    hashed = (
        rows.join(own_shuffle(classes), _HEAD, "left")
        .select("id", "text", F.coalesce("shared", F.lit(False)).alias("shared"))
        .mapInArrow(
            _hash_whole(every_digest),
            f"id {rows.schema['id'].dataType.simpleString()}, shared boolean, digest string",
        )
    )
    hashed = staged(hashed, "exact-hashes")
    groups = (
        hashed.filter("shared")
        .groupBy("digest")
        .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
        .filter("group_size > 1")
    )
    # Only shared rows are joined: the others would meet in one task by their null digest.
    alone = hashed.filter(~F.col("shared")).select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "digest"
    )
    compared = (
        hashed.filter("shared")
        .join(own_shuffle(groups), "digest", "left")
        .select(
            "id",
            F.coalesce("keep_id", "id").alias("keep_id"),
            F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
            "digest",
        )
    )
    kept = F.col("id").eqNullSafe(F.col("keep_id"))
    return alone.unionByName(compared).select(
        "id", "keep_id", "group_size", kept.alias("kept"), "digest"
    )


def without_exact_copies(documents: DataFrame) -> DataFrame:
    """One row of each group, with all its columns.

    The documents are shuffled once, to meet the classes that are shared, and written
    with a number each. After that only shared rows are moved, each by its own number.
    """
    columns = [f"c{k}" for k in range(len(documents.columns))]
    row_id, text = (columns[documents.columns.index(name)] for name in ("doc_id", "text"))
    whole = F.coalesce(F.col(text), F.lit(""))
    rows, classes = _with_shared(documents.toDF(*columns), whole)
    marked = rows.join(own_shuffle(classes), _HEAD, "left")
    numbered = staged(
        marked.select(
            *columns,
            F.when(F.col("shared"), F.sha2(_lowered(whole), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("number"),
        ),
        "exact-rows",
    )
    shared = numbered.filter(F.col("digest").isNotNull())
    stays = shared.groupBy("digest").agg(F.max(F.struct(row_id, "number")).alias("row"))
    kept = shared.join(stays.select("row.number"), "number", "left_semi")
    alone = numbered.filter(F.col("digest").isNull())
    return alone.select(*columns).union(kept.select(*columns)).toDF(*documents.columns)
