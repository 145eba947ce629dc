"""License scans: sparse TF-IDF cosine to templates, then inheritance by path (operator 8).

Every line of a file may be its header, and a licence file is compared as a whole too. So
that notices wrapped over lines, or inside a longer line, are found, each template is also
compared with every window of as many consecutive words as it has (the whole file, if that
is shorter). Terms are words, weighted by their count and inverse document frequency over all files;
words that no template has count as if one file had them. Per line only the templates'
terms are looked up, which gives each template's product and a bound on its cosine; the
lines and windows whose bound reaches the threshold get their exact cosine. Files without
enough of a template's terms to reach it have no windows. A file's licence is the best
template's; "All rights reserved" names no licence, so it stands only where none is found.

Licences of a family differ in a word or a number, which moves the cosine little. So a template fits
only text that has the numbers of its licence's version and its telling words ("Lesser", "ShareAlike"),
in the families of GNU and Creative Commons none of the others; an SPDX line needs all of its words.
A notice does not fit after "not", unless it holds that word itself.

A file without one takes the licence of the nearest directory above it that has a licence
file: each distinct directory is joined to its ancestors' licences, the deepest is kept,
and files are joined to their directory.

Defined cases: a null text is empty and has no licence of its own; a null path has no
directory, so it inherits nothing; of equal scores the template that comes first wins, of
several licence files in a directory the one with the best score, then the first path;
repeated rows get the same answer; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lograft.llm.shared import cut, join_hot
from lograft.llm.spans import TextBatch, chunks, ragged

THRESHOLD = 0.75
NEWLINE = 0x0A
WINDOW_WORDS = 1 << 20  # of the windows compared at once

_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. '
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_NO_ENDORSEMENT = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
)
_MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: '
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. '
    "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. '
    "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_GNU = (
    "This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
)
NO_LICENCE = "Proprietary"

_GNU_ONLY = (
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version {version} as published by the Free Software Foundation."
)
# Creative Commons licences: short form, and what their names add to "Attribution" (fixed values).
_CC = (
    ("BY", ""), ("BY-SA", "-ShareAlike"), ("BY-ND", "-NoDerivatives"), ("BY-NC", "-NonCommercial"),
    ("BY-NC-SA", "-NonCommercial-ShareAlike"), ("BY-NC-ND", "-NonCommercial-NoDerivatives"),
)
# Words that tell the licences of a family apart, and the families (fixed values).
TELLING = ("lesser", "affero", "noncommercial", "sharealike", "noderivatives", "nc", "sa", "nd")
FAMILIES = r"^(?:[AL]?GPL|CC-)"
_SPDX = "SPDX-License-Identifier: "

# Licences and the notices that stand for them (fixed values, public texts). The long texts of Apache, GNU,
# Mozilla and Creative Commons are known by the notice or title that they hold themselves.
NOTICES = (
    ("MIT", _MIT),
    ("BSD-3-Clause", _BSD + _NO_ENDORSEMENT + _AS_IS),
    ("BSD-2-Clause", _BSD + _AS_IS),
    ("ISC", _ISC),
    ("GPL-2.0", _GNU.format(what="program", name="General Public", version="2")),
    ("GPL-3.0", _GNU.format(what="program", name="General Public", version="3")),
    ("LGPL-2.1", _GNU.format(what="library", name="Lesser General Public", version="2.1")),
    ("LGPL-3.0", _GNU.format(what="program", name="Lesser General Public", version="3")),
    ("AGPL-3.0", _GNU.format(what="program", name="Affero General Public", version="3")),
    ("GPL-2.0", _GNU_ONLY.format(version="2")),
    ("GPL-3.0", _GNU_ONLY.format(version="3")),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    *((f"CC-{short}-4.0", f"Creative Commons Attribution{full} 4.0 International Public License") for short, full in _CC),
    ("CC0-1.0", "Creative Commons CC0 1.0 Universal"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    *((f"CC-{short}-4.0", f"Licensed under CC {short} 4.0.") for short, _ in _CC),
    ("CC0-1.0", "Released under CC0 1.0 Universal."),
    (NO_LICENCE, "All rights reserved."),
)
#: The notices, and an SPDX line for each of their licences.
TEMPLATES = (*NOTICES, *((name, _SPDX + name) for name in dict.fromkeys(n for n, _ in NOTICES) if name != NO_LICENCE))


def _must_hold(licence: str, text: str) -> set[str]:
    """The words that text must have to be this template's, however high its cosine."""
    words = set(re.findall(r"[^\W_]+", text.lower()))
    if text.startswith(_SPDX):
        return words
    version = re.search(r"(\d+)\.(\d+)$", licence)
    return words & {*TELLING, *(version.groups() if version else ())}


def _must_lack(licence: str, text: str) -> set[str]:
    """The words that it must not have."""
    words = set(re.findall(r"[^\W_]+", text.lower()))
    told = TELLING if re.match(FAMILIES, licence) else ()
    return {"not", *told} - words


class Words:
    """The words (runs of letters or digits, lower-cased) of texts, with their hash and line."""

    def __init__(self, texts: Sequence[str | None]):
        batch = TextBatch(texts, lower=True)
        starts, ends = batch.word_spans()
        self.names = batch.hashes(starts, ends)
        new = np.concatenate((batch.begins[:-1], np.flatnonzero(batch.cp == NEWLINE) + 1))
        lines = np.unique(new)
        self.line = np.searchsorted(lines, starts, side="right") - 1
        self.doc_of_line = batch.doc_of(lines)
        self.doc = self.doc_of_line[self.line]


class Templates:
    """The templates' terms and, once frequencies are known, their weights."""

    def __init__(self, templates: Sequence[tuple[str, str]]):
        self.licences = [name for name, _ in templates]
        words = Words([text for _, text in templates])
        self.terms = np.unique(words.names)
        self.counts = np.zeros((len(self.terms), len(templates)))
        np.add.at(self.counts, (np.searchsorted(self.terms, words.names), words.doc), 1)
        self.sizes = self.counts.sum(axis=0).astype(np.int64)
        #: Templates of a licence come before those that name none, whatever their scores.
        self.last = np.array([name == NO_LICENCE for name in self.licences], dtype=bool)
        self.needs = self._table([_must_hold(*t) for t in templates])
        self.bars = self._table([_must_lack(*t) for t in templates])
        self.negation = int(self.number(Words(["not"]).names)[0])

    def _table(self, words: Sequence[set[str]]) -> np.ndarray:
        """Terms by templates: 1 where the template's set has the term. Words that no template has are left out."""
        table = np.zeros((len(self.terms), len(words)), dtype=np.float32)
        for t, own in enumerate(words):
            term = self.number(Words([" ".join(sorted(own))]).names)
            table[term[term >= 0], t] = 1
        return table

    def number(self, names: np.ndarray) -> np.ndarray:
        """The number of each word among the terms, -1 for other words."""
        at = np.minimum(np.searchsorted(self.terms, names), max(len(self.terms) - 1, 0))
        return np.where(self.terms[at] == names, at, -1)

    def weigh(self, files: int, with_term: np.ndarray) -> None:
        inverse = lambda df: np.log((1 + files) / (1 + df)) + 1
        self.idf, self.other = inverse(with_term), float(inverse(1))
        weights = self.counts * self.idf[:, None]
        self.unit = weights / np.sqrt((weights**2).sum(axis=0))

    def best(self, names: np.ndarray, unit_of: np.ndarray, n: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """For each of ``n`` units of text (``unit_of`` every word): the best template and its cosine;
        -1 and 0 below the threshold."""
        which, score = np.full(n, -1, dtype=np.int64), np.zeros(n)
        term = self.number(names)
        known = term >= 0
        cell, tf = np.unique(unit_of[known] * len(self.terms) + term[known], return_counts=True)
        unit, term_of = cell // len(self.terms), cell % len(self.terms)
        weight = tf * self.idf[term_of]
        square = np.bincount(unit, weights=weight**2, minlength=n)
        others = np.bincount(unit_of[~known], minlength=n) * self.other**2
        some = np.flatnonzero(square)
        if not len(some):
            return which, score
        place = np.zeros(n, dtype=np.int64)
        place[some] = np.arange(len(some))
        product = np.zeros((len(some), len(self.licences)))
        np.add.at(product, place[unit], weight[:, None] * self.unit[term_of])
        bound = product.max(axis=1) / np.sqrt(square[some] + others[some])
        likely = bound >= threshold - 1e-9
        # the exact length: other words by their own counts
        wanted = np.zeros(n, dtype=bool)
        wanted[some[likely]] = True
        rest = ~known & wanted[unit_of]
        pairs = np.stack((unit_of[rest].astype(np.uint64), names[rest]))
        (at, _), count = np.unique(pairs, axis=1, return_counts=True)
        own = np.bincount(at.astype(np.int64), weights=(count * self.other) ** 2, minlength=n)
        at = some[likely]
        cosine = product[likely] / np.sqrt(square[at] + own[at])[:, None]
        held = np.zeros((len(at), len(self.terms)), dtype=np.float32)
        row = np.full(n, -1, dtype=np.int64)
        row[at] = np.arange(len(at))
        here = row[unit] >= 0
        held[row[unit[here]], term_of[here]] = 1
        cosine[(held @ self.needs < self.needs.sum(axis=0)) | (held @ self.bars > 0)] = 0
        top = cosine.argmax(axis=1)
        value = cosine[np.arange(len(at)), top]
        hit = value >= threshold
        which[at[hit]], score[at[hit]] = top[hit], value[hit]
        return which, score

    def windows(self, names: np.ndarray, doc: np.ndarray, n: int, threshold: float) -> list[tuple[int, int, float]]:
        """``template, document, cosine`` of the best window of each of ``n`` documents, where it reaches the
        threshold. ``doc``: the document of every word, in order."""
        out: list[tuple[int, int, float]] = []
        term = self.number(names)
        known = term >= 0
        begins = np.searchsorted(doc, np.arange(n + 1))
        has = np.zeros((n, len(self.terms)), dtype=np.float32)
        has[doc[known], term[known]] = 1
        # no window has more of a template's terms than its document
        reach = has @ (self.unit**2).astype(np.float32) >= threshold**2 - 1e-4
        weight = np.where(known, self.idf[term], self.other)
        for t in np.flatnonzero(reach.any(axis=0)):
            docs, size = np.flatnonzero(reach[:, t]), int(self.sizes[t])
            lengths = begins[docs + 1] - begins[docs]
            words = ragged(begins[docs], lengths)
            product = np.concatenate(([0.0], np.cumsum(np.where(known[words], weight[words] * self.unit[term[words], t], 0.0))))
            # at least the square of the length: words that come again count more
            square = np.concatenate(([0.0], np.cumsum(weight[words] ** 2)))
            count = np.maximum(lengths - size, 0) + 1
            start = ragged(np.cumsum(lengths) - lengths, count)
            end = start + np.repeat(np.minimum(lengths, size), count)
            bound = (product[end] - product[start]) / np.sqrt(np.maximum(square[end] - square[start], 1e-12))
            fits = bound >= threshold - 1e-6
            of = np.repeat(docs, count)
            if self.negation >= 0 and self.bars[self.negation, t]:
                begin = np.repeat(np.cumsum(lengths) - lengths, count)
                for back in (1, 2):  # "not licensed under", "not be licensed under"
                    before = words[np.maximum(start - back, 0)] if len(words) else start
                    fits &= (start - back < begin) | (term[before] != self.negation)
            likely = np.flatnonzero(fits)
            needed = self.needs[:, t].sum()
            step = max(1, WINDOW_WORDS // size)
            best = np.zeros(n)
            for k in range(0, len(likely), step):
                at = likely[k : k + step]
                width = end[at] - start[at]
                unit = np.repeat(np.arange(len(at)), width)
                word = words[ragged(start[at], width)]
                # equal words of a window stand together
                order = np.lexsort((names[word], unit))
                unit, word = unit[order], word[order]
                new = np.ones(len(word), dtype=bool)
                new[1:] = (unit[1:] != unit[:-1]) | (names[word[1:]] != names[word[:-1]])
                first = np.flatnonzero(new)
                tf = np.diff(np.append(first, len(word)))
                unit, word = unit[first], word[first]
                length = np.bincount(unit, weights=(tf * weight[word]) ** 2, minlength=len(at))
                score = np.bincount(unit, weights=np.where(known[word], tf * weight[word] * self.unit[term[word], t], 0.0), minlength=len(at))
                terms, has_it = np.where(known[word], term[word], 0), known[word]
                needs = np.bincount(unit, weights=np.where(has_it, self.needs[terms, t], 0.0), minlength=len(at))
                bars = np.bincount(unit, weights=np.where(has_it, self.bars[terms, t], 0.0), minlength=len(at))
                score[(needs < needed) | (bars > 0)] = 0
                np.maximum.at(best, of[at], score / np.sqrt(length))
            out += [(int(t), int(d), float(best[d])) for d in np.flatnonzero(best >= threshold)]
        return out


def _frequencies(files: DataFrame, templates: Templates, text_col: str) -> tuple[int, np.ndarray]:
    """How many files there are, and how many hold each term: counted in the tasks, then by term."""

    def run(batches):
        total, held = 0, np.zeros(len(templates.terms), dtype=np.int64)
        for b in batches:
            texts = b.column(0).to_pylist()
            total += len(texts)
            for i, j in chunks(texts):
                words = Words(texts[i:j])
                term = templates.number(words.names)
                known = term >= 0
                cells = np.unique(words.doc[known] * len(held) + term[known])
                held += np.bincount(cells % len(held), minlength=len(held))
        numbers = np.concatenate(([total], held))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(numbers)) - 1), pa.array(numbers)], names=["term", "n"])

    counts = files.select(text_col).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    table = {r["term"]: r["n"] for r in counts.collect()}  # a row per term of the templates
    return table.get(-1, 0), np.array([table.get(t, 0) for t in range(len(templates.terms))], dtype=np.float64)


def own_licences(
    files: DataFrame,
    is_licence_file: Column,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    path_col: str = "path",
    text_col: str = "text",
) -> DataFrame:
    """``id, path, is_licence_file, own, score`` of every file: the licence that its text names, if any."""
    model = Templates(templates)
    files = files.select(
        F.col(id_col).alias("id"), F.col(path_col).alias("path"),
        F.coalesce(is_licence_file, F.lit(False)).alias("is_licence_file"), F.col(text_col).alias("text"),
    )
    kind = files.schema["id"].dataType.simpleString()
    model.weigh(*_frequencies(files, model, "text"))
    sent = files.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = sent.value
        for b in batches:
            texts, whole = b.column("text").to_pylist(), b.column("is_licence_file").to_pylist()
            for i, j in chunks(texts):
                words, n = Words(texts[i:j]), j - i
                which, score = model.best(words.names, words.line, len(words.doc_of_line), threshold)
                found = [(w, d, s) for s, w, d in zip(score, which, words.doc_of_line, strict=True) if w >= 0]
                if any(whole[i:j]):
                    all_which, all_score = model.best(words.names, words.doc, n, threshold)
                    found += [(all_which[d], d, all_score[d]) for d in range(n) if whole[i + d] and all_which[d] >= 0]
                found += model.windows(words.names, words.doc, n, threshold)
                own, best = [None] * n, [0.0] * n
                # the best comes last; equal scores are equal to nine digits
                for w, d, s in sorted(found, key=lambda f: (model.last[f[0]], -round(f[2], 9), f[0]), reverse=True):
                    own[d], best[d] = model.licences[w], float(s)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(b.column(c)[i:j] for c in ("id", "path", "is_licence_file")),
                        pa.array(own, pa.string()), pa.array(best, pa.float64()),
                    ],
                    names=["id", "path", "is_licence_file", "own", "score"],
                )

    return files.mapInArrow(run, f"id {kind}, path string, is_licence_file boolean, own string, score double")


def directory(path: Column) -> Column:
    """The directory of a path: all before the last ``/``, empty at the top."""
    return F.regexp_extract(path, r"^(?s:(.*))/", 1)


def inherit(found: DataFrame) -> DataFrame:
    """``id, path, licence, score, licence_from`` of the rows of ``own_licences``: the own licence, or that
    of the nearest directory upwards with a licence file (``licence_from``: that file's path)."""
    found = found.withColumn("dir", directory(F.col("path")))
    files = found.where("is_licence_file and own is not null and path is not null")
    best = F.max_by(F.struct("own", "score", "path"), F.struct("score", F.expr("transform(split(path, ''), c -> -ascii(c))")))
    granted = files.groupBy(F.col("dir").alias("above")).agg(best.alias("grant"))

    dirs = found.where("dir is not null").select("dir").distinct()
    parts = F.split("dir", "/")
    upwards = F.when(F.col("dir") == "", F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.size(parts)))
    steps = dirs.select("dir", F.explode(upwards).alias("depth"))
    steps = steps.select("dir", "depth", F.array_join(F.slice(F.split("dir", "/"), F.lit(1), F.col("depth")), "/").alias("above"))
    nearest = steps.join(granted, "above").groupBy("dir").agg(F.max_by("grant", "depth").alias("grant"))

    joined = join_hot(found, nearest, "dir", "id")
    own = F.col("own").isNotNull()
    return joined.select(
        "id",
        "path",
        F.coalesce("own", "grant.own").alias("licence"),
        F.when(own, F.col("score")).otherwise(F.col("grant.score")).alias("score"),
        F.when(~own, F.col("grant.path")).alias("licence_from"),
    )


def scan(files: DataFrame, is_licence_file: Column, **options) -> DataFrame:
    """Own and inherited licences of every file."""
    return inherit(cut(own_licences(files, is_licence_file, **options)))


def document_path(source: str = "source", doc_id: str = "doc_id") -> Column:
    """A path for rows that have none: ``source/thousand/fifty/name``, where the first of each fifty ids
    stands as that directory's LICENSE."""
    number = F.col(doc_id)
    name = F.when(F.pmod(number, F.lit(50)) == 0, "LICENSE").otherwise(F.concat(number.cast("string"), F.lit(".txt")))
    thousand, fifty = (F.floor(number / n).cast("string") for n in (1000, 50))
    return F.concat_ws("/", F.coalesce(F.col(source), F.lit("none")), thousand, fifty, name)
