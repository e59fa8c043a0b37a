"""Lempel-Ziv phrase fingerprints.

A text is parsed from left to right into phrases, each the shortest string that is
not a phrase yet, as Lempel and Ziv's dictionary grows. Texts that compress well together
share phrases. The phrases are hashed, and of the phrase set the smallest hash in each of
`SLOTS` equal parts of the hash range is kept; the share of slots that agree estimates the
similarity of the phrase sets.

Defined cases: a null text is empty, and an empty text has no phrases; two empty texts are
alike (1), an empty and another are not (0). A text's last phrase may be one that is
known already. Rows that repeat an id come in the order of their texts' hashes.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.staging import shuffle_partitions
from tillscope.llm.textblocks import blocks, mix, spread_starts, substring_hashes

SLOTS = 128
_EMPTY = np.uint64(2**64 - 1)
_WIDTH = np.uint64(2**64 // SLOTS)
_ROUND_BYTES = 1 << 19
_LEAST = -(2**63)


def _parse(text: str, start: int, known: set[str]) -> list[int]:
    """Ends of the phrases from ``start`` on; ``known`` grows by them."""
    ends = []
    add, put = known.add, ends.append
    phrase = ""
    for end, char in enumerate(text[start:], start + 1):
        phrase += char
        if phrase not in known:
            add(phrase)
            put(end)
            phrase = ""
    if phrase:
        put(len(text))
    return ends


def phrase_ends(text: str) -> list[int]:
    """Where each phrase of the parse ends."""
    return _parse(text, 0, set())


def forked_ends(text: str, edited: str, same: int) -> tuple[list[int], list[int]]:
    """The parses of two texts of which the first ``same`` characters agree, parsed once."""
    known: set[str] = set()
    common = _parse(text[:same], 0, known)
    if len(common) > len(known):
        common.pop()  # known already, so in the longer texts it goes on
    start = common[-1] if common else 0
    other = known.copy()
    return common + _parse(text, start, known), common + _parse(edited, start, other)


def fingerprints(texts: list[str], phrases: list[list[int]]) -> np.ndarray:
    """A row of `SLOTS` integers of 16 bits for each text, 0 for an empty slot.

    They are cut from the smallest hashes; two that differ are cut alike once in 65,535 times.
    """
    slots = np.full(len(texts) * SLOTS, _EMPTY)
    points, starts = code_points(texts)
    if len(points):
        counts = np.array([len(ends) for ends in phrases], dtype=np.int64)
        cuts = np.fromiter(chain.from_iterable(phrases), np.int64, int(counts.sum()))
        row = np.repeat(np.arange(len(texts)), counts)
        ends = cuts + starts[row]
        begins = np.empty_like(ends)
        begins[1:] = ends[:-1]
        begins[spread_starts(counts)[:-1][counts > 0]] = starts[:-1][counts > 0]
        values = mix(points.astype(np.uint64) + np.uint64(1))
        hashes = substring_hashes(values, begins, ends)
        np.minimum.at(slots, row * SLOTS + (hashes // _WIDTH).astype(np.int64), hashes)
    cut = np.uint64(1) + mix(slots) % np.uint64(2**16 - 1)
    cut[slots == _EMPTY] = 0
    return cut.astype(np.uint16).reshape(len(texts), SLOTS)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    return points, spread_starts(np.array([len(text) for text in texts], dtype=np.int64))


def likeness(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Row by row, the share of slots that agree among those that either text fills."""
    filled = ((one != 0) | (other != 0)).sum(axis=1)
    alike = ((one == other) & (one != 0)).sum(axis=1)
    return np.where(filled > 0, alike / np.maximum(filled, 1), 1.0)


def printed(slots: np.ndarray) -> list[str]:
    """Four hexadecimal digits for every slot, in their order; likeness is that of these."""
    return [row.tobytes().hex() for row in slots.astype(">u2")]


def edited_text(text: str, following: str) -> str:
    """The last quarter replaced by as much of the next text's beginning."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _rounds(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Some rows at a time, and after them the row that follows; it begins the next round."""
    ids, texts = [], []
    for batch in batches:
        for block in blocks(iter([batch]), "text", _ROUND_BYTES):
            ids += block.rows.column("id").to_pylist()
            texts += block.rows.column("text").to_pylist()
            if len(ids) > 1:
                yield ids, texts
                ids, texts = ids[-1:], texts[-1:]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of their ids, and last the row that follows all of them."""
    for ids, texts in _rounds(batches):
        edits = [edited_text(a, b) for a, b in zip(texts, texts[1:], strict=False)]
        forked = [
            forked_ends(text, edit, len(text) - len(text) // 4)
            for text, edit in zip(texts, edits, strict=False)
        ]
        # The last text's own turn comes with the next rows; here it is only a successor.
        own = fingerprints(texts, [own for own, _ in forked] + [phrase_ends(texts[-1])])
        edited = fingerprints(edits, [other for _, other in forked])
        yield pa.RecordBatch.from_pydict(
            {
                "id": pa.array(ids[:-1], pa.int64()),
                "n_chars": pa.array([len(text) for text in texts[:-1]], pa.int64()),
                "edited_sha256": [hashlib.sha256(text.encode()).hexdigest() for text in edits],
                "fingerprint": printed(own[:-1]),
                "edited_fingerprint": printed(edited),
                "near_edited": likeness(own[:-1], edited),
                "near_next": likeness(own[:-1], own[1:]),
            }
        )


class _Ranges(NamedTuple):
    """Where ranges of rows begin, in the order of (id, hash, salt).

    ``firsts`` has (id, hash) of the row that each range begins with, where those are known;
    else it is the row of the smallest hash with the id. ``before`` is the range of rows before.
    """

    starts: list[tuple[int, int, int]]
    firsts: list[tuple[int, int] | None] | None
    before: list[int]


def _range_of(ranges: _Ranges):
    starts = np.array(ranges.starts, dtype=np.int64)
    before = np.array(ranges.before)

    def part_of(keys: np.ndarray) -> np.ndarray:
        every = np.concatenate((starts, keys))
        is_key = np.arange(len(every)) >= len(starts)
        order = np.lexsort((is_key, *every.T[::-1]))
        part = np.empty(len(every), dtype=np.int64)
        part[order] = np.cumsum(~is_key[order]) - 1
        return part[len(starts) :]

    @F.pandas_udf("part int, guest_of int")
    def place(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        sent: set[int] = set()
        for ids, hashes, salts in batches:
            keys = np.stack([ids.to_numpy(), hashes.to_numpy(), salts.to_numpy()], axis=1)
            part = part_of(keys)
            if ranges.firsts is None:
                guest = starts[part, 0] == keys[:, 0]
            else:
                firsts = np.array([first or (0, 0) for first in ranges.firsts], dtype=np.int64)
                guest = (firsts[part] == keys[:, :2]).all(axis=1)
                # Equal in id and hash are equal rows, of which any is the successor.
                at = np.flatnonzero(guest)
                once = at[np.unique(part[at], return_index=True)[1]]
                guest[:] = False
                guest[[k for k in once if part[k] not in sent]] = True
                sent.update(part[once].tolist())
            yield pd.DataFrame({"part": part, "guest_of": np.where(guest, before[part], -1)})

    return place


def _even(pieces: int) -> list[int]:
    """Where the pieces of all 64-bit integers begin, but for the first."""
    return [-(2**63) + k * 2**64 // pieces for k in range(1, pieces)]


def _ranges(rows: DataFrame, parts: int) -> _Ranges:
    """At most some rows per partition come to the driver."""
    cuts = rows.agg(
        F.min("id").alias("least"),
        F.count("*").alias("rows"),
        F.percentile_approx("id", [k / parts for k in range(1, parts)] or [0.5], 20 * parts).alias(
            "bounds"
        ),
    ).first()
    if cuts.least is None:
        return _Ranges([(0, _LEAST, _LEAST)], None, [0])
    times = Counter(cuts.bounds if parts > 1 else [])
    starts = {(k, _LEAST, _LEAST) for k in (cuts.least, *times)}
    hot = [k for k, n in times.items() if n > 1]
    if not hot:
        return _with_neighbours(sorted(starts), None)
    # An id of several ranges is divided by the hashes of its texts, and rows that are equal in
    # both, if they would still be much of a range, by a salt.
    starts |= {(k, at, _LEAST) for k in hot for at in _even(times[k])}
    heavy = (
        rows.filter(F.col("id").isin(hot))
        .groupBy("id", "hash")
        .count()
        .filter(F.col("count") > cuts.rows // parts)
        .collect()
    )
    for row in heavy:
        pieces = 1 + row["count"] * parts // cuts.rows
        starts |= {(row.id, row.hash, at) for at in (_LEAST, *_even(pieces))}
        if row.hash < 2**63 - 1:
            starts.add((row.id, row.hash + 1, _LEAST))
    ordered = sorted(starts)
    place = _range_of(_Ranges(ordered, None, [0] * len(ordered)))
    found = (
        rows.select("id", "hash", place("id", "hash", "salt")["part"].alias("part"))
        .groupBy("part")
        .agg(F.min(F.struct("id", "hash")).alias("first"))
        .collect()
    )
    firsts = {row["part"]: tuple(row["first"]) for row in found}
    return _with_neighbours(ordered, [firsts.get(k) for k in range(len(ordered))])


def _with_neighbours(
    starts: list[tuple[int, int, int]], firsts: list[tuple[int, int] | None] | None
) -> _Ranges:
    """The range before each, of those that have rows; before the first of all is the last."""
    used = [k for k in range(len(starts)) if firsts is None or firsts[k] is not None]
    before = [0] * len(starts)
    for at, k in enumerate(used):
        before[k] = used[at - 1]
    return _Ranges(starts, firsts, before)


def compare_with_next(
    documents: DataFrame, row_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Each row's fingerprint, that of its edited text, and their likeness.

    Rows are dealt by ranges of ids, whose bounds are quantiles of the ids, so the texts are
    shuffled once. An id that would be several ranges, as the null can be, is divided. The row that
    a range begins with goes to the range before it too; the
    first of all goes to the last range. Every range is read in the order of ids with
    only some rows at hand. Integer ids; a null id is below all others.
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.coalesce(F.col(row_id).cast("long"), F.lit(_LEAST)).alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumns(
        {"hash": F.xxhash64("text"), "salt": F.xxhash64(F.monotonically_increasing_id())}
    )
    ranges = _ranges(rows, shuffle_partitions(spark))
    own = F.struct(F.col("place.part").alias("part"), F.lit(0).alias("guest"))
    guest = F.struct(F.col("place.guest_of").alias("part"), F.lit(1).alias("guest"))
    both = F.when(F.col("place.guest_of") >= 0, F.array(own, guest)).otherwise(F.array(own))
    placed = (
        rows.withColumn("place", _range_of(ranges)("id", "hash", "salt"))
        .select("id", "text", "hash", F.explode(both).alias("at"))
        .select("id", "text", "hash", "at.part", "at.guest")
    )
    ordered = placed.repartitionById(len(ranges.starts), F.col("part")).sortWithinPartitions(
        "guest", "id", "hash"
    )
    compared = ordered.select("id", "text", "guest").mapInArrow(
        _without_extra_guests,
        "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
    return compared.withColumn("id", F.when(F.col("id") != F.lit(_LEAST), F.col("id")))


def _without_extra_guests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the guests, rows of one repeated id perhaps, only the first is the successor."""

    def checked() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            guests = batch.column("guest").to_numpy()
            first = int(np.searchsorted(guests, 1))
            yield batch.slice(0, min(first + 1, batch.num_rows))
            if first < batch.num_rows:
                # What follows is further guests.
                for _ in batches:
                    pass
                return

    return _compare(checked())
