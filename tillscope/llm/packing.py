"""Cost-balanced packing of token ids into training sequences.

A document is its token ids and one end id. What exceeds whole sequences of
`SEQUENCE` tokens is cut off first: those pieces fill sequences of their own. The rests are
dealt by a hash over groups of bounded size, and each group is packed by itself: the
longest rest first, each to the open sequence of the lowest estimated cost that still has
room for it. A piece costs what attention costs, a linear and a quadratic
term in its length. A rest that no sequence can take whole is cut, beginning with the cheapest, so
every one of them gets full, and a group's last tokens go into sequences whose
lengths are powers of two. So nothing is padded.

The tokenizer lower-cases, drops white space, and splits what is between further into runs of
letters, single digits, and runs of other characters. Texts are cut at those of the bounds that
are plain from their bytes (see `part_bounds`), and each distinct part of a block is looked up
once, and encoded once per worker. The test compares with encoding whole texts.

Defined cases: a null text is empty and has the end id alone; rows that are equal or
repeat an id are packed one by one, each whole; an empty table has no pieces.
"""

from __future__ import annotations

import heapq
import os
import zlib
from collections.abc import Iterator
from itertools import compress, repeat
from operator import is_

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.staging import by_number, in_blocks, shuffle_partitions
from tillscope.llm.textblocks import LOWER, SPACE, blocks, spread_starts

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
SEQUENCE = 4096
GROUP_BYTES = 4 << 20
GROUPS_PER_TASK = 16
HOT_BYTES = 16 * GROUP_BYTES
# Of a piece of n tokens: n + n * n / QUADRATIC. For a model of width 2,048 the scores
# cost as much as all else at about six times the width.
QUADRATIC = 12_288
_KNOWN_PARTS = 300_000
_LONGEST_KNOWN = 48
_LINE = 200

_encoders: dict[str, tuple] = {}


_OTHER, _LETTER, _DIGIT, _SIGN = range(4)
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[ord("!") : ord("~") + 1] = _SIGN
_CLASS[ord("a") : ord("z") + 1] = _CLASS[ord("A") : ord("Z") + 1] = _LETTER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
# The second bytes of the letters from U+00C0 to U+00FF; the first is C3.
_LATIN = np.zeros(256, dtype=bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False


def part_bounds(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where parts begin, and which bytes belong to any: texts cut at white space and more bounds.

    Those of letters, digits and signs, but only between ASCII characters, or after an accented
    Latin letter. Not after an apostrophe, which may belong to the letters that follow.
    """
    kind = _CLASS[data]
    after = kind[1:]
    before = kind[:-1].copy()
    accented = np.flatnonzero(data[:-2] == 0xC3)
    accented = accented[_LATIN[data[accented + 1]]]
    before[accented + 1] = _LETTER
    bound = (before != after) | (after == _DIGIT)
    bound &= (before != _OTHER) & (after != _OTHER) & (data[:-1] != ord("'"))
    inside = ~SPACE[data]
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[starts] = True
    begins = begins[: len(data)]
    begins[1:] |= bound | ~inside[:-1]
    return begins & inside, inside


class WordEncoder:
    """Token ids of texts as little-endian 32-bit integers; a bounded memory of known parts."""

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        # Such a token is found in the text before all else, so its text is left whole.
        self.special = [
            token.content.lower().encode()
            for token in self.tokenizer.get_added_tokens_decoder().values()
        ]
        self.known: dict[bytes, bytes] = {}

        names = self.tokenizer.get_vocab()
        self.largest_id = max(names.values())
        self.ends_word = np.zeros(self.largest_id + 1, dtype=bool)
        self.ends_word[[k for name, k in names.items() if name.endswith("</w>")]] = True

    def _encode(self, parts: list[bytes]) -> dict[bytes, bytes]:
        """Ids of each part. Words of letters alone are encoded many at a time, then cut."""
        texts = [part.decode() for part in parts]
        words = [text for text in texts if text.isalpha()]
        lines = [words[at : at + _LINE] for at in range(0, len(words), _LINE)]
        single = [text for text in texts if not text.isalpha()]
        ids = {}
        for line, found in zip(lines, self._ids([" ".join(line) for line in lines]), strict=True):
            cuts = np.flatnonzero(self.ends_word[np.frombuffer(found, "<u4")]) + 1
            if len(cuts) != len(line):  # a letter that isn't one in lower case
                single += line
                continue
            start = 0
            for word, cut in zip(line, (4 * cuts).tolist(), strict=True):
                ids[word.encode()] = found[start:cut]
                start = cut
        for text, found in zip(single, self._ids(single), strict=True):
            ids[text.encode()] = found
        return ids

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, dtype="<u4").tobytes() for one in found]

    def _distinct_parts(
        self, data: np.ndarray, starts: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Of each part its number among the distinct ones; parts per text; the distinct ones."""
        lowered = LOWER[data]
        begins, inside = part_bounds(data, starts)
        flat = lowered.tobytes()
        if any(token in flat for token in self.special):
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                if any(token in flat[a:b] for token in self.special):
                    lowered[a:b] = data[a:b]
                    begins[a + 1 : b] = inside[a + 1 : b] & ~inside[a : b - 1]
        counts = np.diff(spread_starts(begins)[starts])
        kept = spread_starts(inside)
        offsets = np.append(kept[:-1][begins], kept[-1]).astype(np.int64)
        parts = pa.Array.from_buffers(
            pa.large_binary(),
            len(offsets) - 1,
            [None, pa.py_buffer(offsets), pa.py_buffer(lowered[inside])],
        ).dictionary_encode()
        return parts.indices.to_numpy(), counts, parts.dictionary.to_pylist()

    def texts(
        self, data: np.ndarray, starts: np.ndarray, end: bytes = b""
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with ``end`` behind it, and where each text's begin."""
        number, counts, distinct = self._distinct_parts(data, starts)
        ids = list(map(self.known.get, distinct))
        made = self._encode(list(compress(distinct, map(is_, ids, repeat(None)))))
        ids = [made[part] if one is None else one for part, one in zip(distinct, ids, strict=True)]
        if len(self.known) + len(made) > _KNOWN_PARTS:
            self.known = {}
        self.known.update((k, v) for k, v in made.items() if len(k) <= _LONGEST_KNOWN)
        if end:
            number = np.insert(number, np.cumsum(counts), len(ids))
            ids.append(end)
            counts = counts + 1
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        # Each part's ids are copied from those of the distinct part.
        sizes = lengths[number]
        after = np.cumsum(sizes)
        moved = np.repeat(spread_starts(lengths)[number] - (after - sizes), sizes)
        every = np.frombuffer(b"".join(ids), dtype="<u4")[moved + np.arange(len(moved))]
        return every, np.append(0, after)[spread_starts(counts)]


def encoder(vocabulary: str) -> WordEncoder:
    """One per worker."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = WordEncoder(vocabulary)
    return _encoders[vocabulary]


def _tokenize(vocabulary: str, width: str):
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).texts
        for block in blocks(batches, "text"):
            ids, bounds = encode(block.data, block.starts, end)
            sums, rests = [], []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                whole = a + (b - a) // SEQUENCE * SEQUENCE
                sums.append([zlib.crc32(ids[k : k + SEQUENCE]) for k in range(a, whole, SEQUENCE)])
                rests.append(ids[whole:b].astype(width).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    block.rows.column("id"),
                    block.rows.column("bin"),
                    pa.array(np.diff(bounds)),
                    pa.array(sums, pa.list_(pa.int64())),
                    pa.array(rests, pa.binary()),
                ],
                names=["id", "bin", "doc_tokens", "whole_sums", "rest"],
            )

    return run


class _Open:
    """Open sequences by their room: the cheapest of those that have enough of it.

    A tree over all rooms has the cheapest sequence of every range of rooms.
    """

    _NONE = (float("inf"), 0, 0)

    def __init__(self) -> None:
        self.leaves = 1 << SEQUENCE.bit_length()
        self.tree = [self._NONE] * (2 * self.leaves)
        self.heaps: dict[int, list[tuple[float, int, int]]] = {}

    def _changed(self, room: int) -> None:
        tree, at = self.tree, room + self.leaves
        tree[at] = self.heaps[room][0] if self.heaps[room] else self._NONE
        while at > 1:
            at >>= 1
            tree[at] = min(tree[2 * at], tree[2 * at + 1])

    def put(self, cost: float, sequence: int, room: int) -> None:
        heapq.heappush(self.heaps.setdefault(room, []), (cost, sequence, room))
        self._changed(room)

    def take(self, room: int) -> tuple[float, int, int] | None:
        """Cost, number and room of the cheapest sequence with at least so much room."""
        best, low, high = self._NONE, room + self.leaves, 2 * self.leaves
        while low < high:
            if low & 1:
                best = min(best, self.tree[low])
                low += 1
            low, high = low >> 1, high >> 1
        if best is self._NONE:
            return None
        heapq.heappop(self.heaps[best[2]])
        self._changed(best[2])
        return best


def place(lengths: list[int]) -> list[tuple[int, int, int, int]]:
    """Pack items of the given lengths, each below `SEQUENCE`, which must be descending.

    Returns pieces (item, start in the item, length, sequence), in order of their place in
    the sequence. All sequences are full, but for the last ones, powers of two.
    """
    total = sum(lengths)
    full = total // SEQUENCE
    left = total - full * SEQUENCE
    tails = [1 << bit for bit in range(SEQUENCE.bit_length(), -1, -1) if left >> bit & 1]
    pieces = []
    open_ones = _Open()
    for sequence in range(full):
        open_ones.put(0.0, sequence, SEQUENCE)
    tail = full
    for item, length in enumerate(lengths):
        start = 0
        while length:
            found = open_ones.take(length) or open_ones.take(1)
            if found is None:
                taken = min(length, tails[0])
                pieces.append((item, start, taken, tail))
                tails[0] -= taken
                if not tails[0]:
                    del tails[0]
                    tail += 1
            else:
                cost, sequence, room = found
                taken = min(length, room)
                pieces.append((item, start, taken, sequence))
                if room > taken:
                    cost += taken + taken * taken / QUADRATIC
                    open_ones.put(cost, sequence, room - taken)
            start += taken
            length -= taken
    return pieces


def _pack(rows: pa.Table, width: str) -> pa.Table:
    """All pieces of one group's documents."""
    size = np.dtype(width).itemsize
    rests = rows.column("rest").to_pylist()
    tokens = rows.column("doc_tokens").to_pylist()
    sums = rows.column("whole_sums").to_pylist()
    ids = rows.column("id").to_pylist()
    # A total order of what the rows hold, so that reruns agree.
    order = sorted(
        range(len(ids)),
        key=lambda k: (-len(rests[k]), ids[k] is None, ids[k], rests[k], sums[k]),
    )
    bin_number = rows.column("bin")[0].as_py()
    out: list[tuple] = []
    sequence = bin_number << 32
    for k in order:
        for n, checksum in enumerate(sums[k]):
            out.append((k, n * SEQUENCE, SEQUENCE, checksum, sequence, 0))
            sequence += 1
    offsets: dict[int, int] = {}
    packed = [k for k in order if rests[k]]
    for item, start, length, number in place([len(rests[k]) // size for k in packed]):
        k = packed[item]
        piece = rests[k][size * start : size * (start + length)]
        checksum = zlib.crc32(np.frombuffer(piece, dtype=width).astype("<u4"))
        offset = offsets.get(number, 0)
        offsets[number] = offset + length
        before = len(sums[k]) * SEQUENCE
        out.append((k, before + start, length, checksum, sequence + number, offset))
    row = pa.array([piece[0] for piece in out], pa.int64())
    columns = {"id": rows.column("id").take(row)}
    for at, name in enumerate(("start", "length", "ids_crc32"), start=1):
        columns[name] = pa.array([piece[at] for piece in out], pa.int64())
    columns["doc_tokens"] = pa.array([tokens[piece[0]] for piece in out], pa.int64())
    columns["sequence_id"] = pa.array([piece[4] for piece in out], pa.int64())
    columns["offset"] = pa.array([piece[5] for piece in out], pa.int64())
    return pa.table(columns)


def pack_documents(
    documents: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id and offset."""
    rows = documents.select(F.col(row_id).alias("id"), F.col(text).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bins = 1 + total // GROUP_BYTES
    dealt = in_blocks(rows, bins, HOT_BYTES).withColumnRenamed("block", "bin")
    kind = rows.schema["id"].dataType.simpleString()
    # Half the bytes to shuffle where the vocabulary allows it.
    width = "<u2" if encoder(vocabulary).largest_id < 1 << 16 else "<u4"
    tokens = dealt.mapInArrow(
        _tokenize(vocabulary, width),
        f"id {kind}, bin bigint, doc_tokens bigint, whole_sums array<bigint>, rest binary",
    )
    tasks = max(min(bins, shuffle_partitions(rows.sparkSession)), bins // GROUPS_PER_TASK)
    return by_number(tokens, "bin", tasks).applyInArrow(
        lambda group: _pack(group, width),
        f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint",
    )
