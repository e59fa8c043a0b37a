"""Importance resampling towards a target by hashed n-grams.

Each text goes through one 256-byte table that lower-cases A-Z and blanks all ASCII but
letters and digits, and is split at the blanks. An n-gram's bucket is the CRC-32 of its words
joined by spaces; a longer one goes on from the checksum of the shorter one as its seed.
Counters reduce the checksums of a task's texts to one count per bucket before anything is
shuffled. A bucket's gain is the logarithm of its share of the target over its share of the
documents; a document's weight is the sum of its features' gains. Weights get Gumbel noise that
depends on the id alone, and the highest scores are drawn: sampling without replacement in
proportion to the exponential of the weights.

Ranks come from a range partitioning of the scores, as a position within a partition plus
the sizes of the partitions before it; so no task sees all rows. The gains, one number per
bucket, are all that the driver holds.

Defined cases: a null text has no words, so no features and weight 0, and like all texts of fewer
than `LEAST_WORDS` words it is never drawn; a null id is hashed like an empty one and comes
last among ties; rows that repeat an id are scored and drawn one by one; an empty target or an
empty table has count 0 in every bucket.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.staging import staged
from tillscope.llm.textblocks import blocks, word_lists

NGRAMS = 1
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
_KNOWN = 400_000

_WORD = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
TABLE = bytes(b if b in _WORD else 0x20 for b in bytes(range(256)).lower())


class _Checksums(dict):
    """CRC-32 of words, of a bounded number of them at a time."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN:
            self.clear()
        found = self[word] = zlib.crc32(word)
        return found


def features(text: bytes, ngrams: int, known: dict[bytes, int]) -> Iterator[list[int]]:
    """Checksums of a text's n-grams, in lists; those of single words come first of each part."""
    before: list[bytes] = []
    for words in word_lists(text.translate(TABLE)):
        for n in range(1, ngrams + 1):
            run = before[max(0, len(before) - n + 1) :] + words
            sums = [known[word] for word in run[: max(0, len(run) - n + 1)]]
            for k in range(1, n):
                sums = [zlib.crc32(b" " + w, s) for w, s in zip(run[k:], sums, strict=False)]
            yield sums
        before = (before + words)[-ngrams:]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for block in blocks(batches, "text"):
        data, bounds = block.data.tobytes(), block.starts.tolist()
        yield block.rows, [data[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


def _count(ngrams: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = _Checksums(), Counter()
        total = np.zeros(buckets, dtype=np.int64)

        def reduce() -> None:
            bucket = np.fromiter(seen.keys(), np.int64, len(seen)) % buckets
            np.add.at(total, bucket, np.fromiter(seen.values(), np.int64, len(seen)))
            seen.clear()

        for _, texts in _texts(batches):
            for text in texts:
                for sums in features(text, ngrams, known):
                    seen.update(sums)
                    if len(seen) > _KNOWN:
                        reduce()
        reduce()
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int64()), pa.array(total[held])], names=["bucket", "n"]
        )

    return run


def _weigh(ngrams: int, gains: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, gain = _Checksums(), np.array(gains, dtype=np.int64)
        for rows, texts in _texts(batches):
            found = np.zeros((len(texts), 3), dtype=np.int64)
            for row, text in enumerate(texts):
                for part, sums in enumerate(features(text, ngrams, known)):
                    bucket = np.array(sums, dtype=np.int64) % len(gain)
                    found[row] += (len(sums), 0 if part % ngrams else len(sums), gain[bucket].sum())
            columns = [pa.array(np.ascontiguousarray(column)) for column in found.T]
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), *columns], names=["id", "n_features", "n_words", "weight"]
            )

    return run


def bucket_counts(texts: DataFrame, ngrams: int = NGRAMS, buckets: int = BUCKETS) -> list[int]:
    """How many features of all rows of ``texts`` (text) each bucket holds."""
    counted = (
        texts.mapInArrow(_count(ngrams, buckets), "bucket bigint, n bigint")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
    )
    held = {row.bucket: row.n for row in counted.collect()}  # one row per bucket at most
    return [held.get(bucket, 0) for bucket in range(buckets)]


def bucket_gains(source: list[int], target: list[int]) -> list[int]:
    """Thousandths of the logarithm of the shares' quotient, each count with one added."""
    buckets = float(len(source))
    all_source, all_target = sum(source) + buckets, sum(target) + buckets
    return [
        math.floor(1000 * math.log((t + 1.0) * all_source / ((s + 1.0) * all_target)))
        for s, t in zip(source, target, strict=True)
    ]


def resample(
    documents: DataFrame,
    target: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
    ngrams: int = NGRAMS,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
) -> DataFrame:
    """For every row: id, n_features, weight, score and rank; no rank where it isn't drawn.

    ``target`` has its texts in a column of the same name.
    """
    rows = documents.select(F.col(row_id).alias("id"), F.col(text).alias("text"))
    wanted = target.select(F.col(text).alias("text"))
    gains = bucket_gains(
        bucket_counts(rows.select("text"), ngrams, buckets), bucket_counts(wanted, ngrams, buckets)
    )
    kind = rows.schema["id"].dataType.simpleString()
    weighed = rows.mapInArrow(
        _weigh(ngrams, gains), f"id {kind}, n_features bigint, n_words bigint, weight bigint"
    )
    named = F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))
    scored = staged(
        weighed.withColumn("score", F.col("weight") + noise).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "scores",
    )
    able = scored.filter(F.col("n_words") >= LEAST_WORDS)
    draws = percent * able.count() // 100
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    ordered = staged(
        able.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()),
        "ranked",
    )
    # An increasing id is the partition's number and, in its last 33 bits, the position there.
    partition = F.shiftright("place", 33)
    sizes = ordered.groupBy(partition.alias("partition")).count()
    before = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "partition", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")
    )
    position = F.col("place").bitwiseAND((1 << 33) - 1)
    rank = F.col("before") + position + 1
    ranked = (
        ordered.withColumn("partition", partition)
        .join(starts, "partition")
        .withColumn("rank", F.when(rank <= draws, rank))
    )
    others = scored.filter(F.col("n_words") < LEAST_WORDS).withColumn(
        "rank", F.lit(None).cast("long")
    )
    names = ["id", "n_features", "weight", "score", "rank"]
    return ranked.select(*names).union(others.select(*names))
