"""Deep-shallow sorting of strings in groups (Manzini and Ferragina, 2004), on numpy arrays.

Strings are rows of big-endian 64-bit words. A multikey quicksort orders every group to
a shallow depth; all groups are partitioned together, so a round costs a few array
operations. Strings that still agree there have a long common prefix, and each such set is put
in order by a blind trie of its distinct strings.
"""

from __future__ import annotations

import numpy as np


def as_words(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """Strings as rows of ``width`` bytes, filled up with zeros; shape (n, width / 8)."""
    padded = np.zeros((len(starts), width), dtype=np.uint8)
    last = max(len(data) - 1, 0)
    for column in range(int(min(width, lengths.max(initial=0)))):
        there = column < lengths
        at = np.minimum(starts + column, last)
        padded[:, column] = np.where(there, data[at], 0)
    return padded.view(">u8").astype(np.uint64)


def multikey_quicksort(
    words: np.ndarray, begins: np.ndarray, ends: np.ndarray, shallow: int
) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order rows within [begin, end) groups on their first ``shallow`` words.

    Returns the order, and [begins, ends] of the sets that are equal so far.
    """
    order = np.arange(len(words))
    depth = np.zeros(len(begins), dtype=np.int64)
    deep_begins, deep_ends = [], []
    while True:
        finished = depth == shallow
        several = ends - begins > 1
        deep_begins.append(begins[finished & several])
        deep_ends.append(ends[finished & several])
        active = several & ~finished
        if not active.any():
            break
        begins, ends, depth = begins[active], ends[active], depth[active]
        sizes = ends - begins
        segment = np.repeat(np.arange(len(begins)), sizes)
        first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        position = np.arange(len(segment)) - first[segment] + begins[segment]
        rows = order[position]
        keys = words[rows, depth[segment]]
        pivots = keys[first + sizes // 2][segment]
        # Below the pivot, equal, above.
        side = segment * 3 + (keys >= pivots) + (keys > pivots)
        moved = np.argsort(side, kind="stable")
        order[position] = rows[moved]
        counts = np.bincount(side, minlength=3 * len(begins)).reshape(-1, 3)
        cuts = begins[:, None] + np.cumsum(counts, axis=1)
        starts = np.hstack((begins[:, None], cuts[:, :2]))
        depth = np.repeat(depth, 3) + np.tile([0, 1, 0], len(begins))
        begins, ends = starts.ravel(), cuts.ravel()
    return order, [np.concatenate(deep_begins), np.concatenate(deep_ends)]


class BlindTrie:
    """A trie that keeps branching bytes only; strings are of one length and distinct."""

    def __init__(self) -> None:
        self.root: list | bytes | None = None

    def insert(self, string: bytes) -> None:
        if self.root is None:
            self.root = string
            return
        # Blindly down by the branching bytes to some string, then compare with that one.
        node = self.root
        while not isinstance(node, bytes):
            depth, children = node
            node = children.get(string[depth]) or next(iter(children.values()))
        common = _common_prefix(string, node)
        if common == len(string):
            return
        parent, node = None, self.root
        while not isinstance(node, bytes) and node[0] < common:
            parent, node = node, node[1][string[node[0]]]
        if not isinstance(node, bytes) and node[0] == common:
            node[1][string[common]] = string
            return
        other = node
        while not isinstance(other, bytes):
            other = next(iter(other[1].values()))
        branch = [common, {other[common]: node, string[common]: string}]
        if parent is None:
            self.root = branch
        else:
            parent[1][string[parent[0]]] = branch

    def in_order(self) -> list[bytes]:
        found, waiting = [], [self.root] if self.root is not None else []
        while waiting:
            node = waiting.pop()
            if isinstance(node, bytes):
                found.append(node)
            else:
                waiting += [node[1][byte] for byte in sorted(node[1], reverse=True)]
        return found


def _common_prefix(one: bytes, other: bytes) -> int:
    differ = int.from_bytes(one, "big") ^ int.from_bytes(other, "big")
    return len(one) - (differ.bit_length() + 7) // 8


def deep_shallow_sort(
    words: np.ndarray, groups: np.ndarray, shallow: int
) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows, by group and then by string, and common prefixes in bytes.

    ``groups`` must be ascending. A row's common prefix is with the row before it in
    the order; -1 for the first of a group.
    """
    n = len(words)
    edges = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1]))) if n else groups[:0]
    order, (begins, ends) = multikey_quicksort(words, edges, np.append(edges[1:], n), shallow)
    if len(begins):
        _sort_deep(words, order, begins, ends)
    common = np.full(n, -1, dtype=np.int64)
    if n > 1:
        bytes_of = words[order].astype(">u8").view(np.uint8).reshape(n, -1)
        differ = bytes_of[1:] != bytes_of[:-1]
        length = np.where(differ.any(axis=1), differ.argmax(axis=1), bytes_of.shape[1])
        same = groups[order][1:] == groups[order][:-1]
        common[1:] = np.where(same, length, -1)
    return order, common


def _sort_deep(
    words: np.ndarray, order: np.ndarray, begins: np.ndarray, ends: np.ndarray
) -> None:
    """Put sets of a long common prefix in order, in place."""
    sizes = ends - begins
    owner = np.repeat(np.arange(len(begins)), sizes)
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    position = np.arange(len(owner)) - first[owner] + begins[owner]
    rows = order[position]
    # Sets of one distinct string need no trie.
    differs = (words[rows] != words[rows[first]][owner]).any(axis=1)
    mixed = np.zeros(len(begins), dtype=bool)
    mixed[owner[differs]] = True
    raw = words.astype(">u8")
    for begin, end in zip(begins[mixed].tolist(), ends[mixed].tolist(), strict=True):
        held: dict[bytes, list[int]] = {}
        for row in order[begin:end].tolist():
            held.setdefault(raw[row].tobytes(), []).append(row)
        trie = BlindTrie()
        for string in held:
            trie.insert(string)
        order[begin:end] = [row for string in trie.in_order() for row in held[string]]
