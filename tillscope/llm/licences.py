"""Licence scans: headers and licence files by TF-IDF cosine, then inheritance by directory.

Templates are one-sentence statements, usual headers (titles, notices, SPDX tags) and whole
licence texts. Files are compared with them in three ways, and a file's own licence is that of
the most similar template, if similar enough:

* every line with the statements. Lines and statements are sparse vectors over the
  statements' terms and all others taken together as a line's length;
* every run of terms as long as a template with that template, over line breaks and within
  long lines, so that a wrapped header, a statement in a long line and a licence text within
  a source file are found;
* every whole file with all templates.

A header within a run that is a licence text but for small changes (`SAME`) is part of that
text, which may name other licences, and does not count; in such a file lines are not compared.

A term of the templates weighs its inverse document frequency over all files of the corpus,
any other word that of a term in one file. A directory has the licence of its licence
files (``LICENSE``, ``COPYING`` and the like). A file without a licence of its own has
that of the nearest directory above it that has one, found by joining the directories'
ancestors to the licensed directories.

Defined cases: a null text is empty and has no licence; a null path is a file in no directory,
so it inherits nothing; of templates equally similar, and of licence files of one
directory, the most similar and then the first by name counts; repeated rows are
treated alike. CC BY texts are found by their titles, as their whole texts are not among the
templates; that of the AGPL is made of the GPL's.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.staging import own_shuffle, staged
from tillscope.llm.textblocks import (
    LOWER,
    blocks,
    byte_values,
    substring_hashes,
)

# Statements by which files name public licences.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "Subject to the terms of the Mozilla Public License, version 2.0.",
}
# Headers: titles of licence texts, notices and tags. They are longer than three terms, as
# shorter ones are too easily similar to a few words of prose.
_CC = "Creative Commons Attribution{} 4.0 International"
_NOTICE = (
    "This {0} is free software{1} you can redistribute it and/or modify it under the terms of "
    "the GNU {2} as published by the Free Software Foundation; either version {3} of the License, "
    "or (at your option) any later version."
)
HEADERS = [
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("AGPL-3.0", _NOTICE.format("program", ":", "Affero General Public License", "3")),
    ("Apache-2.0", "Apache License Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("CC-BY-4.0", _CC.format("")),
    ("CC-BY-NC-4.0", _CC.format("-NonCommercial")),
    ("CC-BY-SA-4.0", _CC.format("-ShareAlike")),
    ("CC-BY-4.0", _CC.format("") + " Public License"),
    ("CC-BY-NC-4.0", _CC.format("-NonCommercial") + " Public License"),
    ("CC-BY-SA-4.0", _CC.format("-ShareAlike") + " Public License"),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("GPL-1.0", "GNU General Public License Version 1, February 1989"),
    ("GPL-1.0", _NOTICE.format("program", ";", "General Public License", "1")),
    ("GPL-2.0", "GNU General Public License Version 2"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-2.0", _NOTICE.format("program", ";", "General Public License", "2")),
    ("GPL-3.0", "GNU General Public License Version 3"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("GPL-3.0", _NOTICE.format("program", ":", "General Public License", "3")),
    ("LGPL-2.0", "GNU Library General Public License Version 2, June 1991"),
    ("LGPL-2.0", _NOTICE.format("library", ";", "Library General Public License", "2")),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-2.1", _NOTICE.format("library", ";", "Lesser General Public License", "2.1")),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("LGPL-3.0", _NOTICE.format("library", ":", "Lesser General Public License", "3")),
    ("MIT", "The MIT License (MIT)"),
    ("MPL-1.1", "Mozilla Public License Version 1.1"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ),
]
BODIES = (
    "AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-1.0", "GPL-2.0",
    "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-1.1", "MPL-2.0",
)
for _name in sorted({*TEMPLATES, *BODIES}):
    _gnu = re.fullmatch("[AL]?GPL-.*", _name)
    for _id in (_name, f"{_name}-only", f"{_name}-or-later") if _gnu else (_name,):
        HEADERS.append((_name, f"SPDX-License-Identifier: {_id}"))
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([._-].*)?$"
SIMILAR = 0.8
PIECE_DIRECTORIES = 100_000
SAME = 0.95

_TERM = np.zeros(256, dtype=bool)
_TERM[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


def _terms(text: str) -> list[str]:
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", text.lower())


TERMS = sorted({term for text in TEMPLATES.values() for term in _terms(text)})
NAMES = sorted(TEMPLATES)


def _body(name: str) -> str:
    if name == "AGPL-3.0":
        # They differ in their names and a section of network use.
        text = _body("GPL-3.0").replace("GNU GENERAL PUBLIC", "GNU AFFERO GENERAL PUBLIC")
        return text.replace("GNU General Public", "GNU Affero General Public")
    return resources.files(__package__).joinpath("licence_texts", f"{name}.txt").read_text("utf-8")


#: Name and terms of everything that runs of terms are compared with, licence texts first.
PATTERNS = [(name, _terms(_body(name))) for name in BODIES]
PATTERNS += [(name, _terms(text)) for name, text in (*TEMPLATES.items(), *HEADERS)]
WORDS = sorted({term for _, terms in PATTERNS for term in terms})
# Which statement term each word is, -1 for the others; the last place is that of other words.
_STATED = np.array([TERMS.index(word) if word in TERMS else -1 for word in WORDS] + [-1])


def _term_hashes() -> tuple[np.ndarray, np.ndarray]:
    """The words' hashes in ascending order, and which word each is."""
    data = np.frombuffer(" ".join(WORDS).encode(), dtype=np.uint8)
    lengths = np.array([len(word.encode()) for word in WORDS])
    begins = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    hashes = substring_hashes(byte_values(data), begins, begins + lengths)
    order = np.argsort(hashes)
    return hashes[order], order


_HASHES, _WHICH = _term_hashes()


def _words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Line number and place in `WORDS` (-1 for others) of every word, and the rows' first lines."""
    inside = _TERM[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[starts] = True
    begins = np.flatnonzero(inside & (~np.concatenate(([False], inside[:-1])) | edge[:-1]))
    ends = np.flatnonzero(inside & (~np.concatenate((inside[1:], [False])) | edge[1:])) + 1
    hashes = substring_hashes(byte_values(data), begins, ends)
    at = np.minimum(np.searchsorted(_HASHES, hashes), len(_HASHES) - 1)
    term = np.where(_HASHES[at] == hashes, _WHICH[at], -1)
    breaks = np.flatnonzero(data == ord("\n"))
    rows = np.searchsorted(starts, begins, "right") - 1
    # Line numbers rise by one at a line break and at a document's end.
    line = np.searchsorted(breaks, begins) + rows
    firsts = np.searchsorted(breaks, starts) + np.arange(len(starts))
    return line, term, firsts


def _document_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of the batch hold each of `WORDS`."""
    for block in blocks(batches, "text"):
        line, term, firsts = _words(LOWER[block.data], block.starts)
        row = np.searchsorted(firsts, line, "right") - 1
        known = term >= 0
        pairs = np.unique(row[known] * len(WORDS) + term[known])
        counts = np.bincount(pairs % len(WORDS), minlength=len(WORDS))
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held), pa.array(counts[held].astype(np.int64))], names=["term", "documents"]
        )


def inverse_frequencies(files: int, holding: dict[int, int]) -> np.ndarray:
    """Of each of `WORDS`, and at the end of a word in one file."""
    held = [holding.get(term, 0) for term in range(len(WORDS))] + [1]
    return np.array([1 + math.log((1 + files) / (1 + n)) for n in held])


def pattern_vectors(idf: np.ndarray) -> np.ndarray:
    """A row of unit length for each of `PATTERNS`."""
    vectors = np.zeros((len(PATTERNS), len(WORDS)))
    place = {word: k for k, word in enumerate(WORDS)}
    for row, (_, terms) in enumerate(PATTERNS):
        np.add.at(vectors[row], [place[term] for term in terms], 1)
    vectors *= idf[:-1]
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


class _Runs:
    """Runs of one file's terms (places in `WORDS`, -1 for others)."""

    def __init__(self, term: np.ndarray, idf: np.ndarray) -> None:
        self.n = len(term)
        self.place = term
        self.weight = idf[term]
        # Other words: as if each were another term.
        self.key = np.where(term < 0, len(WORDS) + np.arange(self.n), term) * (2 * self.n)
        order = np.argsort(self.key, kind="stable")
        self.sorted = self.key[order] + order
        self.rank = np.empty(self.n, dtype=np.int64)
        self.rank[order] = np.arange(self.n)
        self.lengths: dict[int, np.ndarray] = {}

    def squares(self, size: int) -> np.ndarray:
        """The squared length of every run of so many terms, by where it begins."""
        if size not in self.lengths:
            ends = self.key[: self.n - size] + np.arange(size, self.n)
            leaving = np.searchsorted(self.sorted, ends) - self.rank[: self.n - size]
            begins = self.key[size:] + np.arange(1, self.n - size + 1)
            entering = self.rank[size:] + 1 - np.searchsorted(self.sorted, begins)
            square = self.weight**2
            counts = np.unique(self.key[:size], return_inverse=True)[1]
            same = np.bincount(counts)[counts]
            steps = square[size:] * (2 * entering - 1) - square[: self.n - size] * (2 * leaving - 1)
            self.lengths[size] = (square[:size] * same).sum() + np.concatenate(
                ([0], np.cumsum(steps))
            )
        return self.lengths[size]

    def cosines(self, pattern: np.ndarray, size: int) -> tuple[np.ndarray, float]:
        """Cosines of all runs of so many terms, by where they begin, and of the whole file.

        The pattern is a vector of length one; a shorter file has no runs.
        """
        known = self.place >= 0
        parts = np.where(known, pattern[self.place], 0) * self.weight
        sums = np.concatenate(([0], np.cumsum(parts)))
        whole = round(float(sums[-1] / math.sqrt(self.squares(self.n)[0])), 6)
        if size > self.n:
            return np.zeros(0), whole
        dots = sums[size:] - sums[: self.n - size + 1]
        return np.round(dots / np.sqrt(self.squares(size)), 6), whole


def _best_of_file(
    term: np.ndarray, idf: np.ndarray, vectors: np.ndarray, possible: list[int]
) -> tuple[float, str, bool]:
    """The most similar of the possible patterns, its cosine, and whether the file has a text."""
    runs = _Runs(term, idf)
    found = []
    # The end of the licence texts that begin at a term or before it.
    ends = np.zeros(runs.n, dtype=np.int64)
    bodies = [k for k in possible if k < len(BODIES)]
    for k in bodies:
        name, terms = PATTERNS[k]
        cosines, whole = runs.cosines(vectors[k], len(terms))
        found.append((max(cosines.max(initial=0), whole), name))
        begins = np.flatnonzero(cosines >= SAME)
        ends[begins] = np.maximum(ends[begins], begins + len(terms))
        if whole >= SAME:
            ends[0] = runs.n
    ends = np.maximum.accumulate(ends)
    for k in possible[len(bodies) :]:
        name, terms = PATTERNS[k]
        cosines, whole = runs.cosines(vectors[k], len(terms))
        begins = np.arange(len(cosines))
        outside = cosines[begins + len(terms) > ends[: len(cosines)]]
        whole = whole if ends[0] < runs.n else 0
        found.append((max(outside.max(initial=0), whole), name))
    cosine, name = min(found, key=lambda one: (-one[0], one[1]))
    return float(cosine), name, bool(ends[-1])


def best_patterns(
    line: np.ndarray, term: np.ndarray, firsts: np.ndarray, idf: np.ndarray, vectors: np.ndarray
) -> dict[int, tuple[float, str, bool]]:
    """`_best_of_file` of each row whose cosine can be `SIMILAR`.

    No cosine is above what the row's words have of the pattern's length.
    """
    row = np.searchsorted(firsts, line, "right") - 1
    known = term >= 0
    pairs = np.unique(row[known] * len(WORDS) + term[known])
    found = {}
    rows, begins = np.unique(pairs // len(WORDS), return_index=True)
    stops = np.append(begins[1:], len(pairs))
    squares = np.ascontiguousarray((vectors**2).T)
    at = np.searchsorted(row, np.arange(len(firsts) + 1))
    for number, begin, stop in zip(rows.tolist(), begins, stops, strict=True):
        mass = squares[pairs[begin:stop] % len(WORDS)].sum(axis=0)
        possible = np.flatnonzero(mass >= (SIMILAR - 1e-6) ** 2).tolist()
        if possible:
            terms = term[at[number] : at[number + 1]]
            found[number] = _best_of_file(terms, idf, vectors, possible)
    return found


def template_vectors(idf: np.ndarray) -> np.ndarray:
    """A row of unit length for each name of `NAMES`, over `TERMS`."""
    vectors = np.zeros((len(NAMES), len(TERMS)))
    for row, name in enumerate(NAMES):
        for term in _terms(TEMPLATES[name]):
            vectors[row, TERMS.index(term)] += 1
    vectors *= _of_statements(idf)[:-1]
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _of_statements(idf: np.ndarray) -> np.ndarray:
    """The weights of `TERMS`, and at the end that of all other words."""
    return np.append(idf[[WORDS.index(term) for term in TERMS]], idf[-1])


def best_templates(
    line: np.ndarray, term: np.ndarray, firsts: np.ndarray, idf: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Each text's most similar template over all its lines, and that cosine.

    The cosine is 0 where no line's can be `SIMILAR`.
    """
    term = _STATED[term]
    n, likest = len(firsts) - 1, template_vectors(idf)
    idf = _of_statements(idf)
    best, cosine = np.zeros(n, dtype=np.int64), np.zeros(n)
    known = term >= 0
    pairs, counts = np.unique(line[known] * len(TERMS) + term[known], return_counts=True)
    if not len(pairs):
        return best, cosine
    lines, slot = np.unique(pairs // len(TERMS), return_inverse=True)
    weights = counts * idf[pairs % len(TERMS)]
    shared = np.bincount(slot, weights=weights**2)
    # Other words: as if each were another term.
    at = np.minimum(np.searchsorted(lines, line[~known]), len(lines) - 1)
    others = np.bincount(at[lines[at] == line[~known]], minlength=len(lines))
    whole = shared + others * idf[-1] ** 2
    # No cosine is above what the templates' terms have of the line's length.
    possible = shared >= (SIMILAR - 1e-6) ** 2 * whole
    if not possible.any():
        return best, cosine
    place = np.cumsum(possible) - 1
    weighed = np.zeros((int(possible.sum()), len(TERMS)))
    kept = possible[slot]
    weighed[place[slot[kept]], pairs[kept] % len(TERMS)] = weights[kept]
    lines, norms = lines[possible], np.sqrt(whole[possible])
    likeness = np.round(weighed @ likest.T / norms[:, None], 6)
    which, most = likeness.argmax(axis=1), likeness.max(axis=1)
    row = np.searchsorted(firsts, lines, "right") - 1
    order = np.lexsort((which, -most, row))
    row, which, most = row[order], which[order], most[order]
    first = np.concatenate(([True], row[1:] != row[:-1]))
    best[row[first]], cosine[row[first]] = which[first], most[first]
    return best, cosine


def own_licences(files: DataFrame) -> DataFrame:
    """``files`` (id, path, text): id, path, own licence and its cosine, or nulls.

    Two passes over the texts and no shuffle of them: the words' document counts, of
    which there are as many as the templates have words, and then the comparison.
    """
    counted = (
        files.select("text")
        .mapInArrow(_document_terms, "term bigint, documents bigint")
        .groupBy("term")
        .agg(F.sum("documents").alias("documents"))
        .collect()
    )
    idf = inverse_frequencies(files.count(), {row.term: row.documents for row in counted})

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, vectors = np.array(NAMES, dtype=object), pattern_vectors(idf)
        for block in blocks(batches, "text"):
            words = _words(LOWER[block.data], block.starts)
            best, cosine = best_templates(*words, idf)
            found = names[best]
            for row, (likeness, name, text) in best_patterns(*words, idf, vectors).items():
                if text or (-likeness, name) < (-cosine[row], found[row]):
                    found[row], cosine[row] = name, likeness
            similar = cosine >= SIMILAR
            found = np.where(similar, found, None)
            yield pa.RecordBatch.from_arrays(
                [
                    block.rows.column("id"),
                    block.rows.column("path"),
                    pa.array(found, pa.string()),
                    pa.array(cosine, mask=~similar),
                ],
                names=["id", "path", "own_licence", "cosine"],
            )

    kind = files.schema["id"].dataType.simpleString()
    return files.select("id", "path", "text").mapInArrow(
        scan, f"id {kind}, path string, own_licence string, cosine double"
    )


def _below_licensed(expanded: DataFrame, licensed: DataFrame) -> DataFrame:
    """Directories with those above them that are licensed; joined in pieces.

    A root has every directory below it, so directories that have many below are licensed in copies
    and each piece of what is below gets one. Of such there are fewer than `PIECE_DIRECTORIES`
    goes into the rows, which bounds their broadcast.
    """
    hot = (
        expanded.groupBy("above")
        .count()
        .filter(F.col("count") > PIECE_DIRECTORIES)
        .select("above", F.ceil(F.col("count") / PIECE_DIRECTORIES).alias("pieces"))
    )
    pieces = F.coalesce("pieces", F.lit(1).cast("long"))
    dealt = expanded.join(F.broadcast(hot), "above", "left").select(
        "above", "directory", F.pmod(F.xxhash64("directory"), pieces).alias("piece")
    )
    copies = licensed.join(F.broadcast(hot), "above", "left").select(
        "above",
        "inherited",
        F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)).alias("piece"),
    )
    return dealt.join(copies, ["above", "piece"]).drop("piece")


def scan_licences(files: DataFrame) -> DataFrame:
    """``files`` (id, path, text): own_licence, cosine, licence and licence_from of each.

    ``licence_from`` is the directory a licence is inherited from. Only distinct directories
    are expanded to their ancestors, of which each has as many as it is deep.
    """
    parts = F.split("path", "/")
    own = staged(own_licences(files), "own-licences").withColumns(
        {
            "directory": F.when(
                F.col("path").isNotNull(), F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/")
            ),
            "name": F.element_at(parts, -1),
        }
    )
    licensed = (
        own.filter(F.col("name").rlike(LICENCE_FILE) & F.col("own_licence").isNotNull())
        .groupBy("directory")
        .agg(F.min(F.struct(-F.col("cosine"), "name", "own_licence")).alias("first"))
        .select(F.col("directory").alias("above"), F.col("first.own_licence").alias("inherited"))
    )
    steps = F.split("directory", "/")
    above = F.explode(
        F.transform(
            F.sequence(F.lit(0), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/")
        )
    )
    expanded = (
        own.filter("own_licence is null and directory is not null")
        .select("directory")
        .distinct()
        .select("directory", above.alias("above"))
    )
    nearest = (
        _below_licensed(expanded, licensed)
        .groupBy("directory")
        .agg(F.max(F.struct(F.length("above").alias("depth"), "above", "inherited")).alias("n"))
        .select("directory", "n.above", "n.inherited")
    )
    return own.join(own_shuffle(nearest), "directory", "left").select(
        "id",
        "path",
        "own_licence",
        "cosine",
        F.coalesce("own_licence", "inherited").alias("licence"),
        F.when(F.col("own_licence").isNull(), F.col("above")).alias("licence_from"),
    )
