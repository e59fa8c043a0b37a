"""Token counts under a unigram vocabulary, by dynamic programming over a trie.

The tokens of a word are those of its segmentation into pieces of the highest total log
probability. The distinct words are inserted in a trie. Each trie node is a prefix and
holds the prefix's best score and its number of tokens (the forward scores of the dynamic
programme), computed once from the nodes above it, however many words share the prefix.
A word's count is stored at its terminal node.

The vocabulary file lists pieces by rank and not by probability, so a piece of rank r
counts as having log probability -ln(r + `RANK_OFFSET`) (Zipf's law). A character in no
piece is as many byte tokens as it has UTF-8 bytes.

Words are split at ASCII white space and begin with the vocabulary's mark of a word's
beginning. A word is divided further between two ASCII characters that stand next to each
other in no piece: every segmentation has a bound there, so the parts' tokens add up. Of
segmentations of equal score, that of the fewest tokens counts. Defined cases: a null text is
empty and has no tokens; a word of any length is one word; repeated rows are counted one by one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.textblocks import SPACE, blocks

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
MARK = "▁"
_CONTINUES = b"\x02"  # before a part that doesn't begin a word
RANK_OFFSET = 10
BYTE_PENALTY = 10.0
# The trie is memory, not a limit: once so large it is begun anew, and longer words are
# computed without being inserted.
MOST_NODES = 1_000_000
LONGEST_INSERTED = 64

_tries: dict[str, TokenTrie] = {}


def load_pieces(vocabulary: str) -> dict[str, float]:
    """Log probability of each piece but the special and byte ones."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    pieces = {}
    for rank in range(model.get_piece_size()):
        if not (model.is_control(rank) or model.is_byte(rank) or model.is_unknown(rank)):
            pieces[model.id_to_piece(rank)] = -math.log(rank + RANK_OFFSET)
    return pieces


class TokenTrie:
    def __init__(self, pieces: dict[str, float]) -> None:
        # All ends of pieces; what is no piece itself has no probability. Beyond a string
        # that no piece ends in, no longer one has to be looked up.
        self.ends: dict[str, float | None] = {}
        for piece in pieces:
            for start in range(len(piece)):
                self.ends.setdefault(piece[start:], None)
        self.ends.update(pieces)
        self.worst = min(pieces.values(), default=0.0) - BYTE_PENALTY
        # Whether some piece has these two bytes in a row, for ASCII; other bytes are never parted.
        self.joined = np.ones((256, 256), dtype=bool)
        self.joined[:128, :128] = False
        for piece in pieces:
            for one, other in zip(piece, piece[1:], strict=False):
                if one < "\x80" and other < "\x80":
                    self.joined[ord(one), ord(other)] = True
        self.joined[:, SPACE] = self.joined[SPACE, :] = True
        self.empty()

    def empty(self) -> None:
        # A node is named by its prefix and holds the prefix's best score and token count.
        self.nodes: dict[str, tuple[float, int]] = {"": (0.0, 0)}
        self.terminals: dict[bytes, int] = {}

    def _shared(self, text: str) -> int:
        """Length of the longest prefix that is a node; all shorter ones are nodes too."""
        low, high = 0, len(text)
        while low < high:
            middle = (low + high + 1) >> 1
            if text[:middle] in self.nodes:
                low = middle
            else:
                high = middle - 1
        return low

    def parts(self, data: np.ndarray) -> tuple[list[bytes], int]:
        """A text's parts, and how many of them continue a word."""
        raw = data.tobytes()
        if _CONTINUES in raw:
            # Words as what comes after nothing, so that none is taken for a continuation.
            return [_CONTINUES + MARK.encode() + word for word in raw.split()], 0
        bound = np.flatnonzero(~self.joined[data[:-1], data[1:]])
        place = np.arange(len(data))
        place += 2 * np.searchsorted(bound, place)
        out = np.full(len(data) + 2 * len(bound), ord(" "), dtype=np.uint8)
        out[place] = data
        out[place[bound + 1] - 1] = _CONTINUES[0]
        return out.tobytes().split(), len(bound)

    def _insert(self, word: bytes) -> int:
        text = word[1:].decode() if word[:1] == _CONTINUES else MARK + word.decode()
        nodes, ends = self.nodes, self.ends
        inserted = len(text) <= LONGEST_INSERTED
        shared = self._shared(text) if inserted else 0
        path = [nodes[text[:shared]]]
        for end in range(shared + 1, len(text) + 1):
            n_bytes = len(text[end - 1].encode())
            best, fewest = path[-1]
            best += n_bytes * self.worst
            fewest += n_bytes
            for start in range(end - 1, -1, -1):
                probability = ends.get(text[start:end], 0)
                if probability is None:
                    continue
                if not probability:
                    break
                score, count = path[start - shared] if start >= shared else nodes[text[:start]]
                score += probability
                if score > best or (score == best and count + 1 < fewest):
                    best, fewest = score, count + 1
            path.append((best, fewest))
            if inserted:
                nodes[text[:end]] = path[-1]
        if inserted:
            self.terminals[word] = path[-1][1]
        return path[-1][1]

    def count(self, words: list[bytes]) -> list[int]:
        """Tokens of each of the distinct parts."""
        if len(self.nodes) > MOST_NODES:
            self.empty()
        known = self.terminals.get
        counts = []
        for word in words:
            found = known(word)
            counts.append(self._insert(word) if found is None else found)
        return counts


def trie(vocabulary: str) -> TokenTrie:
    """One per worker."""
    if vocabulary not in _tries:
        _tries[vocabulary] = TokenTrie(load_pieces(vocabulary))
    return _tries[vocabulary]


def _count(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_of = trie(vocabulary)
        for block in blocks(batches, "text"):
            starts = block.starts.tolist()
            texts = [
                tokens_of.parts(block.data[a:b]) for a, b in zip(starts, starts[1:], strict=False)
            ]
            distinct = list(set().union(*(parts for parts, _ in texts)))
            counts = dict(zip(distinct, tokens_of.count(distinct), strict=True)).__getitem__
            yield pa.RecordBatch.from_arrays(
                [
                    block.rows.column("id"),
                    pa.array([len(parts) - more for parts, more in texts], pa.int64()),
                    pa.array([sum(map(counts, parts)) for parts, _ in texts], pa.int64()),
                ],
                names=["id", "n_words", "n_tokens"],
            )

    return run


def count_tokens(
    documents: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """Id, n_words and n_tokens of every row; nothing is shuffled."""
    rows = documents.select(F.col(row_id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_count(vocabulary), f"id {kind}, n_words bigint, n_tokens bigint")
