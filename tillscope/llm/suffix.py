"""Substring dedup by a distributed, sparse suffix array.

A byte is removed if a string of `LENGTH` bytes that covers it also starts in a document of a
smaller id. Every such string, a window, has one anchor: the leftmost of its `GRAM`-byte grams
of the least hash. Equal windows have equal grams at equal places, so comparing the suffixes
that start at anchors, and what stands before them, finds every match.

1. Texts are dealt over blocks of bounded size. A block reports its anchors' grams, hashed.
2. The grams that occur in different surroundings or documents are reported back.
3. Of these a block sends each distinct surrounding (the bytes of all windows of
   an anchor) with the smallest id that it has in the block, to the gram's part.
4. A part orders the suffixes by deep-shallow sorting, and the strings before the anchors,
   reversed, likewise. Common prefixes of neighbours give the classes of equal
   windows; those that are not of their class's smallest id are reported back.
5. A block covers and removes the bytes.

A gram of very many distinct surroundings (the end of a passage that a third of all documents
hold) is divided: its windows are sent one by one, each to the part of its own hash.
A block reports a gram, a surrounding or a window once, however often it has it.

Defined cases: a null text is empty; texts shorter than a window lose nothing; rows of one id
are one document for the rule, so they take nothing from each other, and a null id is above
all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.staging import by_number, in_blocks, shuffle_partitions
from tillscope.llm.suffixsort import as_words, deep_shallow_sort
from tillscope.llm.textblocks import byte_values, mix, substring_hashes, text_bytes

LENGTH = 50
GRAM = 24
WINDOW = LENGTH - GRAM + 1  # grams of a window
BLOCK_BYTES = 8 << 20
HOT_BLOCKS = 4
BLOCKS_PER_TASK = 16
HOT_SURROUNDINGS = 100_000
_CHUNK = 1 << 18
_SHALLOW = GRAM // 8
_FACTORS = np.array([0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)
_GRAM_SEED = np.uint64(0xA24BAED4963EE407)
_LEFT_FACTOR = np.uint64(0x9E6C63D0876A9A47)
# Marks a window that is sent by itself: in its place of the anchor, and in its answer.
_SINGLE = 64
_SINGLE_ANSWER = 1 << 30
_HALF = np.uint64(32)
_LOW = np.uint64(0xFFFFFFFF)


class Anchors:
    """The anchors of a block: position, first and last window, row, and the gram's hash."""

    def __init__(self, data: np.ndarray, starts: np.ndarray) -> None:
        self.data = data
        found = [_anchors_of_chunk(data, at, valid) for at, valid in _valid_windows(starts)]
        found = [part for part in found if part is not None]
        if not found:
            self.position = self.first = self.last = self.row = np.zeros(0, dtype=np.int64)
            self.gram = np.zeros(0, dtype=np.uint64)
            return
        position, first, last, gram = (np.concatenate(part) for part in zip(*found, strict=True))
        # An anchor whose windows lie in two chunks has been found twice.
        new = np.concatenate(([True], position[1:] != position[:-1]))
        self.position, self.first, self.gram = position[new], first[new], gram[new]
        self.last = last[np.append(np.flatnonzero(new)[1:] - 1, len(new) - 1)]
        self.row = np.searchsorted(starts, self.position, "right") - 1

    def surroundings(self, chosen: np.ndarray) -> np.ndarray:
        """A hash of all bytes of the chosen anchors' windows, and of the anchors' place there."""
        left = (self.position - self.first)[chosen].astype(np.uint64)
        hashes = range_hashes(self.data, self.first[chosen], self.last[chosen] + LENGTH)
        return surrounding_keys(hashes, left)


def surrounding_keys(hashes: np.ndarray, left: np.ndarray) -> np.ndarray:
    return mix(hashes + (left + np.uint64(1)) * _LEFT_FACTOR)


def range_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[begin:end], for ascending begins, some at a time."""
    hashes = np.empty(len(begins), dtype=np.uint64)
    at = 0
    while at < len(begins):
        to = int(np.searchsorted(begins, begins[at] + _CHUNK))
        low, high = int(begins[at]), int(ends[at:to].max())
        values = byte_values(data[low:high])
        hashes[at:to] = substring_hashes(values, begins[at:to] - low, ends[at:to] - low)
        at = to
    return hashes


def _valid_windows(starts: np.ndarray):
    """Chunks of positions, and which of them a window of one document starts at."""
    n = int(starts[-1])
    for at in range(0, n, _CHUNK):
        to = min(at + _CHUNK, n)
        change = np.zeros(to - at + 1, dtype=np.int64)
        rows = slice(
            int(np.searchsorted(starts, at, "right")) - 1, int(np.searchsorted(starts, to)) + 1
        )
        begins, ends = starts[rows][:-1], starts[rows][1:]
        # The last LENGTH - 1 positions of a document start none.
        np.add.at(change, np.clip(np.maximum(begins, ends - LENGTH + 1) - at, 0, to - at), 1)
        np.add.at(change, np.clip(ends - at, 0, to - at), -1)
        yield at, np.cumsum(change)[:-1] == 0


def _anchors_of_chunk(data: np.ndarray, at: int, valid: np.ndarray):
    here = np.flatnonzero(valid)
    if not len(here):
        return None
    size = int(here[-1]) + WINDOW  # grams that these windows need
    chunk = np.ascontiguousarray(data[at : at + size + GRAM - 1])
    words = np.ndarray((len(chunk) - 7,), dtype="<u8", buffer=chunk, strides=(1,))
    hashes = words[:size] * _FACTORS[0]
    for k in range(1, GRAM // 8):
        hashes += words[8 * k : 8 * k + size] * _FACTORS[k]
    hashes = mix(hashes)
    # The place in the low half: of equal grams the leftmost is least.
    least = (hashes & ~_LOW) | np.arange(size, dtype=np.uint64)
    width = 1
    while 2 * width <= WINDOW:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = WINDOW - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    anchor = (least[here] & _LOW).astype(np.int64)
    new = np.concatenate(([True], anchor[1:] != anchor[:-1]))
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(anchor)) - 1
    position = anchor[begin]
    return position + at, here[begin] + at, here[end] + at, mix(hashes[position] ^ _GRAM_SEED)


# --- tables of lists: a row per block and part ---


def _lists(keys: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """Columns cut into lists where the ascending keys change."""
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    edges = np.flatnonzero(new)
    offsets = pa.array(np.append(edges, len(keys)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(column)) for column in columns]
    return keys[edges], lists


def _flat(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _owners(table: pa.Table, column: str, of: str) -> np.ndarray:
    """The value of column ``of`` for every element of the list column."""
    lengths = table.column(column).combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    return np.repeat(table.column(of).to_numpy(), lengths)


def _list_starts(table: pa.Table, column: str) -> np.ndarray:
    lengths = table.column(column).combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    return np.cumsum(lengths) - lengths


def _block(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, bytes and starts of a block's rows."""
    data, starts = text_bytes(table.column("text").combine_chunks())
    return table.column("id").to_numpy(), data, starts


def _split_gram(gram: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The part, and the 32 bits that name a gram there."""
    return ((gram >> _HALF) % np.uint64(parts)).astype(np.int64), (gram & _LOW).astype(np.int64)


def _first_of_each(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of equal keys the row of the smallest id, and whether the key has other ids."""
    order = np.lexsort((ids, keys))
    key, owner = keys[order], ids[order]
    new = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(key)) - 1 if len(key) else begin
    return order[begin], owner[begin] != owner[end]


# --- the steps ---


def _report_grams(parts: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        ids, data, starts = _block(table)
        anchors = Anchors(data, starts)
        everything = np.arange(len(anchors.position))
        keys = anchors.surroundings(everything)
        first, several = _first_of_each(keys, ids[anchors.row])
        part, gram = _split_gram(anchors.gram[first], parts)
        order = np.lexsort((gram, part))
        part, gram, several = part[order], gram[order], several[order]
        new = np.ones(len(gram), dtype=bool)
        new[1:] = (gram[1:] != gram[:-1]) | (part[1:] != part[:-1])
        begin = np.flatnonzero(new)
        # One surrounding that several documents hold counts as two.
        counts = np.add.reduceat(1 + several, begin) if len(begin) else begin
        key, (grams, counted) = _lists(
            part[begin], gram[begin].astype(np.uint32).view(np.int32), counts.astype(np.int32)
        )
        block = table.column("block")[0].as_py()
        return pa.table(
            {
                "part": pa.array(key),
                "block": pa.array(np.full(len(key), block)),
                "grams": grams,
                "counts": counted,
            }
        )

    return run


def _shared_grams(hot: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        grams = _flat(table, "grams").view(np.uint32)
        order = np.argsort(grams, kind="stable")
        sorted_grams = grams[order]
        new = np.ones(len(grams), dtype=bool)
        new[1:] = sorted_grams[1:] != sorted_grams[:-1]
        group = np.cumsum(new) - 1
        total = np.bincount(group, weights=_flat(table, "counts")[order])[group]
        held = np.empty(len(grams), dtype=np.int64)
        held[order] = total
        shared = held > 1
        part = table.column("part")[0].as_py()
        names = (np.int64(part) << 32) | grams[shared].astype(np.int64)
        block = _owners(table, "grams", "block")[shared]
        back = np.argsort(block, kind="stable")
        key, (keys, divided) = _lists(block[back], names[back], (held[shared] > hot)[back])
        return pa.table({"block": pa.array(key), "keys": keys, "divided": divided})

    return run


def _surroundings(parts: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(texts: pa.Table, replies: pa.Table) -> pa.Table:
        ids, data, starts = _block(texts)
        anchors = Anchors(data, starts)
        part, gram = _split_gram(anchors.gram, parts)
        names = (part << 32) | gram
        wanted, divided = _flat(replies, "keys"), _flat(replies, "divided")
        order = np.argsort(wanted)
        wanted, divided = wanted[order], divided[order]
        at = np.minimum(np.searchsorted(wanted, names), max(len(wanted) - 1, 0))
        known = wanted[at] == names if len(wanted) else np.zeros(len(names), dtype=bool)
        in_parts = np.zeros(len(names), dtype=bool)
        in_parts[known] = divided[at[known]]
        sent = [
            _whole_surroundings(anchors, ids, part, gram, np.flatnonzero(known & ~in_parts)),
            _single_windows(anchors, ids, parts, np.flatnonzero(in_parts)),
        ]
        joined = [np.concatenate(column) for column in zip(*sent, strict=True)]
        order = np.argsort(joined[0], kind="stable")
        part, gram, owner, left, begin, end, several = (column[order] for column in joined)
        key, lists = _lists(
            part,
            gram.astype(np.uint32).view(np.int32),
            owner,
            left.astype(np.int8),
            (end - begin).astype(np.int8),
            several,
        )
        edges = np.append(np.searchsorted(part, key), len(part))
        # Of single windows the shuffle's own compression makes little.
        content = [
            pa.compress(data[_spread(begin[a:b], end[a:b] - begin[a:b])], "zstd", asbytes=True)
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)
        ]
        block = texts.column("block")[0].as_py()
        names = ("grams", "ids", "lefts", "lengths", "several")
        return pa.table(
            {
                "part": pa.array(key),
                "block": pa.array(np.full(len(key), block)),
                **dict(zip(names, lists, strict=True)),
                "content": pa.array(content, pa.binary()),
            }
        )

    return run


def _spread(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one range after another."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(
        begins - (ends - lengths), lengths
    )


def _whole_surroundings(anchors: Anchors, ids, part, gram, chosen) -> tuple[np.ndarray, ...]:
    keys = anchors.surroundings(chosen)
    first, several = _first_of_each(keys, ids[anchors.row[chosen]])
    chosen = chosen[first]
    begin = anchors.first[chosen]
    return (
        part[chosen],
        gram[chosen],
        ids[anchors.row[chosen]],
        anchors.position[chosen] - begin,
        begin,
        anchors.last[chosen] + LENGTH,
        several,
    )


def _windows_of(anchors: Anchors, chosen) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of the chosen anchors: where each starts, its anchor, and the window's key."""
    counts = anchors.last[chosen] - anchors.first[chosen] + 1
    start = _spread(anchors.first[chosen], counts)
    of = np.repeat(chosen, counts)
    left = (anchors.position[of] - start).astype(np.uint64)
    return start, of, surrounding_keys(range_hashes(anchors.data, start, start + LENGTH), left)


def _single_windows(anchors: Anchors, ids, parts: int, chosen) -> tuple[np.ndarray, ...]:
    start, of, keys = _windows_of(anchors, chosen)
    first, several = _first_of_each(keys, ids[anchors.row[of]])
    start, of, keys = start[first], of[first], keys[first]
    part, name = _split_gram(mix(keys), parts)
    left = anchors.position[of] - start + _SINGLE
    return part, name, ids[anchors.row[of]], left, start, start + LENGTH, several


def duplicate_windows(
    groups: np.ndarray,
    ids: np.ndarray,
    left: np.ndarray,
    lengths: np.ndarray,
    content: np.ndarray,
) -> np.ndarray:
    """Bit j of a surrounding: its window j also occurs in a surrounding of a smaller id.

    ``groups`` must be ascending; only surroundings of one group are compared. Suffixes
    start at the anchors. Two windows that have their anchor at offset k are equal if the
    suffixes share LENGTH - k bytes and the reversed strings before them share k.
    """
    masks = np.zeros(len(groups), dtype=np.int32)
    begins = np.cumsum(lengths) - lengths
    size = np.bincount(np.unique(groups, return_inverse=True)[1]) if len(groups) else groups
    chosen = np.flatnonzero(np.repeat(size > 1, size)) if len(groups) else groups
    if not len(chosen):
        return masks
    groups, ids, left, lengths, begins = (
        column[chosen] for column in (groups, ids, left, lengths, begins)
    )
    after = as_words(content, begins + left, lengths - left, -(-LENGTH // 8) * 8)
    # Reversed: byte k is the one k + 1 before the anchor.
    turned = content[::-1]
    before = as_words(turned, len(content) - begins - left, left, -(-WINDOW // 8) * 8)
    by_suffix, shared_after = deep_shallow_sort(after, groups, _SHALLOW)
    by_prefix, shared_before = deep_shallow_sort(before, groups, 1)
    windows = lengths - LENGTH + 1
    found = np.zeros(len(chosen), dtype=np.int32)
    class_after, class_before = np.empty_like(chosen), np.empty_like(chosen)
    for offset in range(WINDOW):
        own = np.flatnonzero((offset <= left) & (left - offset < windows))
        if not len(own):
            continue
        class_after[by_suffix] = np.cumsum(shared_after < LENGTH - offset)
        class_before[by_prefix] = np.cumsum(shared_before < offset)
        key = class_after[own] * (len(chosen) + 1) + class_before[own]
        order = np.lexsort((ids[own], key))
        key, owner = key[order], ids[own][order]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        least = owner[np.flatnonzero(new)[np.cumsum(new) - 1]]
        again = own[order[owner > least]]
        found[again] |= np.int32(1) << (left[again] - offset).astype(np.int32)
    masks[chosen] = found
    return masks


def _compare(table: pa.Table) -> pa.Table:
    groups = _flat(table, "grams").view(np.uint32).astype(np.int64)
    ids = _flat(table, "ids")
    left, lengths = (_flat(table, name).astype(np.int64) for name in ("lefts", "lengths"))
    single = left >= _SINGLE
    left = left % _SINGLE
    several = _flat(table, "several")
    block = _owners(table, "grams", "block")
    sizes = np.add.reduceat(lengths, _list_starts(table, "lengths")) if len(lengths) else []
    content = np.frombuffer(
        b"".join(
            pa.decompress(packed, int(size), "zstd", asbytes=True)
            for packed, size in zip(table.column("content").to_pylist(), sizes, strict=True)
        ),
        dtype=np.uint8,
    )
    begins = np.cumsum(lengths) - lengths
    keys = surrounding_keys(
        range_hashes(content, begins, begins + lengths), left.astype(np.uint64)
    )
    order = np.argsort(groups, kind="stable")
    sorted_content = content[_spread(begins[order], lengths[order])]
    masks = np.empty(len(groups), dtype=np.int32)
    masks[order] = duplicate_windows(
        groups[order], ids[order], left[order], lengths[order], sorted_content
    )
    told = np.flatnonzero((masks != 0) | several)
    masks[single] |= _SINGLE_ANSWER
    back = told[np.argsort(block[told], kind="stable")]
    key, (key_lists, first_lists, mask_lists) = _lists(
        block[back], keys[back].view(np.int64), ids[back], masks[back]
    )
    return pa.table(
        {"block": pa.array(key), "keys": key_lists, "firsts": first_lists, "masks": mask_lists}
    )


def removed_windows(
    anchors: Anchors, ids: np.ndarray, keys: np.ndarray, firsts: np.ndarray, masks: np.ndarray
) -> np.ndarray:
    """Where windows start that a document of a smaller id has too."""
    if not len(keys):
        return np.zeros(0, dtype=np.int64)
    order = np.argsort(keys)
    keys, firsts, masks = keys[order], firsts[order], masks[order]

    single = masks >= _SINGLE_ANSWER

    def removed(of_windows: bool, found: np.ndarray, owners: np.ndarray, everything) -> np.ndarray:
        chosen = single == of_windows
        if not chosen.any():
            return np.zeros(len(found), dtype=np.int64)
        known = keys[chosen]
        at = np.minimum(np.searchsorted(known, found), len(known) - 1)
        # Later documents of the block lose all of the surrounding, the first what is marked.
        marked = masks[chosen][at].astype(np.int64) % _SINGLE_ANSWER
        bits = np.where(owners > firsts[chosen][at], everything, marked)
        return np.where(known[at] == found, bits, 0)

    chosen = np.arange(len(anchors.position))
    counts = anchors.last - anchors.first + 1
    bits = removed(
        False, anchors.surroundings(chosen), ids[anchors.row], (np.int64(1) << counts) - 1
    )
    starts = [anchors.first[(bits >> j) & 1 == 1] + j for j in range(WINDOW)]
    if single.any():
        for some in np.array_split(chosen[bits == 0], 1 + len(chosen) // _CHUNK):
            start, of, found = _windows_of(anchors, some)
            starts.append(start[removed(True, found, ids[anchors.row[of]], 1) == 1])
    return np.concatenate(starts)


def _remove(texts: pa.Table, replies: pa.Table) -> pa.Table:
    ids, data, starts = _block(texts)
    anchors = Anchors(data, starts)
    at = removed_windows(
        anchors,
        ids,
        _flat(replies, "keys").view(np.uint64),
        _flat(replies, "firsts"),
        _flat(replies, "masks"),
    )
    change = np.zeros(len(data) + LENGTH + 1, dtype=np.int32)
    np.add.at(change, at, 1)
    np.add.at(change, at + LENGTH, -1)
    gone = np.cumsum(change)[: len(data)] > 0
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[starts] = True
    run_starts = gone & (edge[:-1] | ~np.concatenate(([False], gone[:-1])))
    sums = np.concatenate(([0], np.cumsum(gone)))
    spans = np.concatenate(([0], np.cumsum(run_starts)))
    kept = [
        hashlib.sha256(data[a:b][~gone[a:b]]).hexdigest()
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)
    ]
    return pa.table(
        {
            "id": texts.column("id"),
            "n_bytes": pa.array(np.diff(starts)),
            "n_removed": pa.array(np.diff(sums[starts])),
            "n_spans": pa.array(np.diff(spans[starts])),
            "kept_sha256": pa.array(kept, pa.string()),
        }
    )


_NO_ID = 2**63 - 1


def remove_repeats(
    documents: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    hot: int = HOT_SURROUNDINGS,
) -> DataFrame:
    """For every row: id, n_bytes, n_removed, n_spans and the SHA-256 of what is kept.

    Integer ids. The texts are shuffled once: the three steps that read blocks use the same
    exchange. Blocks and parts are of bounded size, and their number grows with the texts.
    """
    rows = documents.select(
        F.coalesce(F.col(row_id).cast("long"), F.lit(_NO_ID)).alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1 + total // block_bytes, shuffle_partitions(documents.sparkSession))
    blocks = in_blocks(rows, parts, HOT_BLOCKS * block_bytes)
    tasks = max(min(parts, shuffle_partitions(documents.sparkSession)), parts // BLOCKS_PER_TASK)
    by_block = by_number(blocks, "block", tasks)
    grams = by_block.applyInArrow(
        _report_grams(parts), "part bigint, block bigint, grams array<int>, counts array<int>"
    )
    shared = by_number(grams, "part", tasks).applyInArrow(
        _shared_grams(hot), "block bigint, keys array<bigint>, divided array<boolean>"
    )
    surroundings = by_block.cogroup(by_number(shared, "block", tasks)).applyInArrow(
        _surroundings(parts),
        "part bigint, block bigint, grams array<int>, ids array<bigint>, lefts array<tinyint>, "
        "lengths array<tinyint>, several array<boolean>, content binary",
    )
    removals = by_number(surroundings, "part", tasks).applyInArrow(
        _compare, "block bigint, keys array<bigint>, firsts array<bigint>, masks array<int>"
    )
    kept = by_block.cogroup(by_number(removals, "block", tasks)).applyInArrow(
        _remove, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    )
    return kept.withColumn("id", F.when(F.col("id") != F.lit(_NO_ID), F.col("id")))
