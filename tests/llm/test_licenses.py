"""Base phrases against a plain search, templates on edited notices."""

from __future__ import annotations

import re

import duckdb
from conftest import SF01
from llm_fixtures import make_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F

from histlake.llm import licenses as L
from histlake.llm.queries import queries

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = {c: c + 32 for c in range(65, 91)}


def brute(text):
    ws = WORDS.findall((text or "").translate(AZ))
    places, labels = [], set()
    for phrase, label in L.BASE:
        p = phrase.split()
        at = [i for i in range(len(ws)) if ws[i:i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(ws), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_query_base_matches_brute_force(spark):
    docs = dict(duckdb.sql(f"select doc_id, text from '{SF01}/documents.parquet'").fetchall())
    got = queries()["op10_licenses"](spark, SF01).collect()
    assert len(got) == len(docs)
    for r in got:
        assert tuple(r)[1:6] == brute(docs[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
        own = re.search("Apache License", docs[r.doc_id])
        assert bool(own) == ("apache-2.0" in r.labels)
        assert bool(re.search("MIT License", docs[r.doc_id])) == ("mit" in r.labels.split(","))


def test_every_template_finds_itself():
    index = L.LicenseIndex({})
    for label, notice, _ in L.TEMPLATES:
        for text in (notice, f"some words before\n * {notice.upper()}\n and after", notice.replace(", ", " , ")):
            got = index.scan(text)
            assert label in got[5].split(","), text
            assert got[6] >= L.MIN_SCORE


def test_key_phrases_and_places():
    index = L.LicenseIndex({})
    near = "Licensed under the terms of the Apache License, Version 2.0"        # two words more
    assert "apache-2.0" in index.scan(near)[5]
    assert "apache-2.0" not in index.scan("Licensed under the Apache License, Version 3.1")[5]
    assert index.scan("Version Apache the 2.0 License under licensed")[5] == ""
    assert index.scan("the license of this mit building is not released")[5] == ""
    two = "Released under the MIT License. " + "filler " * 50 + "Licensed under the Apache License, Version 2.0"
    assert {"mit", "apache-2.0"} <= set(index.scan(two)[5].split(","))


def test_edge_cases(spark, odd_docs, make_docs):  # noqa: F811
    idf = L.document_frequencies(odd_docs)
    got = odd_docs.select("text", L.scan_licenses(F.col("text"), idf).alias("s")).collect()
    assert [tuple(r.s)[:5] for r in got] == [brute(r.text) for r in got]
    docs = make_docs([(1, "cc by cc by all rights reserved", "s"), (2, "all rights all rights reserved", "s")])
    got = docs.select("text", L.scan_licenses(F.col("text"), idf).alias("s")).collect()
    assert [tuple(r.s)[:5] for r in got] == [brute(r.text) for r in got]
    assert L.document_frequencies(odd_docs.limit(0)) and odd_docs.limit(0).select(
        L.scan_licenses(F.col("text"), idf).alias("s")).count() == 0


HEADERS = {
    "gpl-3.0": "/* This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General "
               "Public License as published by\n * the Free Software Foundation, either version 3 of the License, or\n * (at your "
               "option) any later version. */",
    "gpl-2.0": "GNU GENERAL PUBLIC LICENSE\n  Version 2, June 1991\n Copyright",
    "lgpl": "# This library is free software; you can redistribute it and/or\n# modify it under the terms of the GNU Lesser General "
            "Public\n# License as published by the Free Software Foundation; either version 2.1",
    "agpl-3.0": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by "
                "the Free Software Foundation, either version 3 of the License, or later",
    "apache-2.0": "Apache License\n   Version 2.0, January 2004\n   http://www.apache.org/licenses/",
    "mit": "The MIT License (MIT)\n\nCopyright (c) 2020",
    "bsd": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
           "derived from this software without specific prior written permission.",
    "mpl-2.0": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "isc": "// SPDX-License-Identifier: ISC\nint main;", "cc0-1.0": "SPDX-License-Identifier: CC0-1.0",
    "epl-2.0": "SPDX-License-Identifier: EPL-2.0",
}
NEAR = ["the program is free to redistribute and modify under some terms of the general public", "version 3 of the licence fee",
        "an identifier of a license plate", "Apache helicopters, version 2", "a MIT course on licenses",
        "names of contributors may promote products", "Mozilla browser version 2.0 was distributed with this file",
        "SPDX is a format", "the free software foundation published version 3 of a book"]


def test_standard_headers_titles_and_spdx_lines(spark, make_docs):  # noqa: F811
    texts = [*HEADERS.values(), *NEAR]
    docs = make_docs([(i, t, "s") for i, t in enumerate(texts)])
    idf = L.document_frequencies(docs)
    got = [r.s for r in docs.select("doc_id", L.scan_licenses(F.col("text"), idf).alias("s")).orderBy("doc_id").collect()]
    for label, s in zip(HEADERS, got, strict=False):
        assert label in s.labels.split(",") and s.score >= L.MIN_SCORE, (label, s)
        others = set(s.labels.split(",")) - {label, "gpl"}
        assert not others, (label, s)
    assert all(s.labels == s.base_labels for s in got[len(HEADERS):])
    assert L._index(tuple(sorted(idf.items()))) is L._index(tuple(sorted(idf.items())))


def test_anchors_are_the_files_own_rarest_words():
    """Any notice that keeps enough words in place is found, whatever else is common in the corpus."""
    import random
    rng = random.Random(3)
    idf = {w: rng.random() * 9 for w in L.licence_words()}
    index = L.LicenseIndex(idf)
    for t, (label, ws, keys) in enumerate(index.templates):
        agree, absent, n = index.need[t]
        got = index.anchors(frozenset(ws))
        mine = [w for w in got if t in got[w]]
        assert len(mine) == min(n, agree + absent)
        assert max(map(index.rank.get, mine)) == sorted(map(index.rank.get, set(ws)))[len(mine) - 1]
        keep = {w for k in keys for w in k}
        for _ in range(5):
            gone = [i for i, w in enumerate(ws) if w not in keep][:absent]
            gone = set(rng.sample(gone, rng.randint(0, len(gone))))
            text = [f"other{i}" if i in gone else w for i, w in enumerate(ws)]
            # the lost words stand elsewhere in the file
            file = " ".join(["start", *text, *["filler"] * 60, *[ws[i] for i in gone]])
            assert label in index.scan(file)[5].split(","), (label, gone)
