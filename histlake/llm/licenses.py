"""License scans by a positional rare-token index (operator 10).

Every template is a licence text cut into words; its postings tell at which
positions a word stands.  A file's licence words are ranked by their inverse
document frequency over all scanned documents, and its rarest ones that a
template has are looked up.  A template that is found may lack ``1 -
min_score`` of its words, so as many of the file's rarest words are looked
up as it may lack, and two more: two at least then stand in the notice.
Where the postings of two (or of a template's only word) agree on a relative
position the template would stand.  There its mandatory key phrases must
stand, a few words apart at most, and the share of its words found in order
around that place is the score.

Edge cases: a null or empty text has no words and no labels; a text may hold
several licences, all are found; every place of a base phrase counts, also
where places overlap; repeated rows are scanned each; an empty table gives
no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import py_lower_ascii, ship

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# words that must agree on a place
AGREE = 2
SLACK = 3
MIN_SCORE = 0.7

# Base phrases and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# (label, notice, key phrases that must stand in it)
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license", "2 0")),
    ("mit", "Released under the MIT License", ("mit license",)),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files", ("permission is hereby granted", "free of charge")),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3", ("general public license", "version 3")),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2", ("general public license", "version 2")),
    ("lgpl", "licensed under the GNU Lesser General Public License", ("lesser general public license",)),
    ("agpl-3.0", "licensed under the GNU Affero General Public License, version 3",
     ("affero general public license", "version 3")),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted",
     ("redistribution and use", "source and binary forms")),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
     ("mozilla public license", "2 0")),
    ("isc", "Permission to use, copy, modify, and or distribute this software for any purpose with or without fee is "
            "hereby granted", ("with or without fee", "hereby granted")),
    ("cc-by-4.0", "licensed under CC BY 4.0", ("cc by 4 0",)),
    ("cc-by-sa-4.0", "licensed under CC BY-SA 4.0", ("cc by sa",)),
    ("cc-by-nc-4.0", "licensed under CC BY-NC 4.0", ("cc by nc",)),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License",
     ("creative commons attribution", "4 0")),
    ("cc0-1.0", "dedicated to the public domain under CC0 1.0 Universal", ("public domain", "cc0")),
    ("unlicense", "This is free and unencumbered software released into the public domain",
     ("unencumbered software", "public domain")),
    ("epl-2.0", "made available under the terms of the Eclipse Public License 2.0", ("eclipse public license",)),
    ("boost-1.0", "Distributed under the Boost Software License, Version 1.0", ("boost software license",)),
    # standard file headers, titles and clauses
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version", ("gnu general public license", "version 3 of the license")),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
                "option) any later version", ("gnu general public license", "version 2 of the license")),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation", ("lesser general public license",)),
    ("agpl-3.0", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
                 "published by the Free Software Foundation, either version 3 of the License",
     ("affero general public license", "version 3")),
    ("gpl-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", ("gnu general public license", "version 3")),
    ("gpl-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", ("gnu general public license", "version 2")),
    ("apache-2.0", "Apache License Version 2.0, January 2004", ("apache license", "version 2 0")),
    ("mit", "The MIT License (MIT)", ("mit license mit",)),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
            "products derived from this software without specific prior written permission",
     ("names of its contributors", "endorse or promote products")),
    ("mpl-2.0", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
     ("mpl was not distributed", "mozilla org mpl 2 0")),
    # machine-readable lines
    *[(label, f"SPDX-License-Identifier: {name}", (" ".join(["license identifier", *re.split("[^a-z0-9]+", name.lower())]),))
      for label, name in (("mit", "MIT"), ("apache-2.0", "Apache-2.0"), ("gpl-3.0", "GPL-3.0"), ("gpl-2.0", "GPL-2.0"),
                          ("lgpl", "LGPL"), ("agpl-3.0", "AGPL-3.0"), ("bsd", "BSD"), ("mpl-2.0", "MPL-2.0"),
                          ("isc", "ISC"), ("cc0-1.0", "CC0-1.0"), ("unlicense", "Unlicense"), ("epl-2.0", "EPL-2.0"),
                          ("boost-1.0", "BSL-1.0"))],
)

_WORDS = re.compile(WORD)
RESULT = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double")


def words_of(text: str) -> list[str]:
    return _WORDS.findall(py_lower_ascii(text))


class LicenseIndex:
    """Postings of all words of the templates, and the words ranked by ``idf``."""

    def __init__(self, idf: dict[str, float], templates=TEMPLATES, base=BASE, agree: int = AGREE,
                 slack: int = SLACK, min_score: float = MIN_SCORE):
        self.slack, self.min_score = slack, min_score
        self.base = [(p.split(), label) for p, label in base]
        self.templates = [(label, words_of(t), [k.split() for k in keys]) for label, t, keys in templates]
        # (words that must agree, words that may be absent, different words) of a template
        self.need = []
        self.postings: dict[str, dict[int, list[int]]] = defaultdict(dict)
        for t, (_, ws, _) in enumerate(self.templates):
            for pos, w in enumerate(ws):
                self.postings[w].setdefault(t, []).append(pos)
            n = len(set(ws))
            self.need.append((min(agree, n), len(ws) - math.ceil(len(ws) * min_score - 1e-9), n))
        starts: dict[str, list[int]] = defaultdict(list)
        for b, (phrase, _) in enumerate(self.base):
            # a phrase is looked for where its rarest word stands
            k = max(range(len(phrase)), key=lambda i: (idf.get(phrase[i], math.inf), phrase[i]))
            starts[phrase[k]].append((b, k))
        self.starts = starts
        by_idf = sorted(self.postings, key=lambda w: (-idf.get(w, math.inf), w))
        self.rank = {w: r for r, w in enumerate(by_idf)}
        self.lookup = frozenset(self.postings) | frozenset(starts)

    def anchors(self, hits: frozenset[str]) -> dict[str, list[int]]:
        """Word -> templates it is looked up for, of a file with licence words ``hits``."""
        by_template: dict[int, list[str]] = defaultdict(list)
        for w in sorted(hits & self.rank.keys(), key=self.rank.__getitem__):
            for t in self.postings[w]:
                by_template[t].append(w)
        out: dict[str, list[int]] = defaultdict(list)
        for t, ws in by_template.items():
            agree, absent, n = self.need[t]
            if len(ws) >= n - absent:
                for w in ws[:absent + agree]:
                    out[w].append(t)
        return out

    def scan(self, text: str) -> tuple:
        words = words_of(text)
        hits = self.lookup.intersection(words)
        anchors = self.anchors(hits)
        wanted = anchors.keys() | (self.starts.keys() & hits)
        if not wanted:
            return len(words), 0, None, None, "", "", 0.0
        found, places = set(), []
        votes: dict[tuple[int, int], set[str]] = defaultdict(set)
        for i, w in enumerate(words):
            if w not in wanted:
                continue
            for b, k in self.starts.get(w, ()):
                phrase = self.base[b][0]
                if i >= k and words[i - k:i - k + len(phrase)] == phrase:
                    places.append(i - k)
                    found.add(self.base[b][1])
            for t in anchors.get(w, ()):
                for pos in self.postings[w][t]:
                    votes[t, i - pos].add(w)
        labels, score = set(found), 0.0
        for t, at in list(votes):
            near: set[str] = set()
            for d in range(-self.slack, self.slack + 1):
                near |= votes.get((t, at + d), set())
            if len(near) < self.need[t][0]:
                continue
            got = self._verify(t, at, words)
            if got >= self.min_score:
                labels.add(self.templates[t][0])
                score = max(score, got)
        if found and not score:
            score = 1.0
        return (len(words), len(places), min(places, default=None), max(places, default=None),
                ",".join(sorted(found)), ",".join(sorted(labels)), score)

    def _verify(self, t: int, at: int, words: list[str]) -> float:
        """Share of the template's words that stand in order around ``at``, or
        0 if a key phrase is missing."""
        _, ws, keys = self.templates[t]
        lo, hi = max(0, at - self.slack), at + len(ws) + self.slack
        here = words[lo:hi]
        for key in keys:
            if not any(here[i:i + len(key)] == key for i in range(len(here) - len(key) + 1)):
                return 0.0
        # longest common subsequence of two short lists
        row = [0] * (len(here) + 1)
        for w in ws:
            prev = 0
            for j, x in enumerate(here, 1):
                prev, row[j] = row[j], (prev + 1 if w == x else max(row[j], row[j - 1]))
        return row[-1] / len(ws)


@lru_cache(1)
def _index(idf: tuple[tuple[str, float], ...]) -> LicenseIndex:
    """A worker's index, built for its first batch."""
    return LicenseIndex(dict(idf))


def licence_words(templates=TEMPLATES, base=BASE) -> list[str]:
    return sorted({w for _, t, _ in templates for w in words_of(t)} | {w for p, _ in base for w in p.split()})


def document_frequencies(docs: DataFrame, templates=TEMPLATES, base=BASE) -> dict[str, float]:
    """Inverse document frequency of every licence word over all documents;
    the table is as long as the templates, whatever the corpus."""
    ship(docs.sparkSession)
    vocab = frozenset(licence_words(templates, base))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: Counter = Counter()
        n = 0
        for batch in batches:
            for t in batch.column(0):
                df.update(vocab.intersection(words_of(t.as_py() or "")))
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([*df, ""], pa.string()), pa.array([*df.values(), n], pa.int64())],
                                         ["word", "n"])

    rows = (docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).collect())
    df = {r.word: r.n for r in rows}
    total = df.pop("", 0)
    return {w: math.log((total + 1) / (df.get(w, 0) + 1)) for w in vocab}


def scan_licenses(text: Column, idf: dict[str, float]) -> Column:
    """Struct of the scan's results for a text column."""
    ship()
    names = [f.split()[0] for f in RESULT.split(", ")]
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    known = tuple(sorted(idf.items()))

    @F.arrow_udf(RESULT)
    def run(texts: pa.Array) -> pa.Array:
        index = _index(known)
        rows = [index.scan(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays(
            [pa.array([r[c] for r in rows], types[c]) for c in range(len(names))], names)

    return run(F.coalesce(text.cast("string"), F.lit("")))
