"""The edit join against all pairs (its links have no practical form in SQL)."""

from __future__ import annotations

import os
import random
import re
from collections import Counter

import duckdb
import pyarrow as pa
from llm_fixtures import make_docs, odd_docs, stage  # noqa: F401
from conftest import SF001
from pyspark.sql import functions as F

from histlake.llm import linededup as L
from histlake.llm.queries import queries


WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def distance(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y)))
        prev = row
    return prev[-1]


def edited(rng, s, k, alphabet):
    s = list(s)
    for _ in range(k):
        p, what = rng.randint(0, len(s)), rng.randint(0, 2)
        if what == 0 or p == len(s):
            s.insert(p, rng.choice(alphabet))
        elif what == 1:
            s[p] = rng.choice(alphabet)
        else:
            del s[p]
    return "".join(s)


def test_banded_distance():
    rng = random.Random(1)
    for _ in range(20_000):
        tau = rng.choice([1, 2, 3, 4])
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))
        b = edited(rng, a, rng.randint(0, tau + 2), "abc")
        assert L.within(a, b, tau) == (distance(a, b) <= tau)


def brute_links(texts, tau, least):
    """Linked pairs of distinct texts; the count checks only save time."""
    texts = sorted({t for t in texts if len(t) >= least})
    words = {t: WORDS.findall(t) for t in texts}
    out = set()
    by_len = {}
    for t in texts:
        if len(words[t]) < 40:
            by_len.setdefault(len(t), []).append(t)
    for n, group in by_len.items():
        for i, a in enumerate(group):
            for b in group[i + 1:] + [y for d in range(1, tau + 1) for y in by_len.get(n + d, [])]:
                if sum((a.count(c) - b.count(c)) ** 2 for c in "aeinort ") <= (2 * tau) ** 2 and distance(a, b) <= tau:
                    out.add(frozenset((a, b)))
    many = sorted((t for t in texts if len(words[t]) >= 20), key=lambda t: len(words[t]))
    bags = {t: Counter(words[t]) for t in many}
    for i, a in enumerate(many):
        most = 2 if len(words[a]) >= 40 else 1       # a is the shorter one
        for b in many[i + 1:]:
            if len(words[b]) - len(words[a]) > most:
                break
            if (bags[a] - bags[b]).total() <= most and distance(words[a], words[b]) <= most:
                out.add(frozenset((a, b)))
    return out


def classes(rows, links, least):
    """(doc_id, line_no) -> (class place, links, kept) by union of links."""
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    degree = {}
    for link in links:
        a, b = link
        parent[find(a)] = find(b)
        for x in link:
            degree[x] = degree.get(x, 0) + 1
    first = {}
    grouped = lambda line: len(line) >= least or line.strip(" \t\n\x0b\x0c\r")
    for place, line in sorted(rows):
        if grouped(line):
            first.setdefault(find(line), place)
    return {place: (first[find(line)], degree.get(line, 0), first[find(line)] == place)
            if grouped(line) else (place, 0, True) for place, line in rows}


def test_classes_of_edited_lines(spark, make_docs, stage):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcde fgé") for _ in range(rng.randint(30, 60))) for _ in range(40)]
    docs = [(i, "\n".join(edited(rng, rng.choice(base), rng.choice([0, 0, 1, 2, 3]), "abcé ")
                          for _ in range(rng.randint(0, 6)))) for i in range(120)]
    rows = [((i, k), line) for i, t in docs for k, line in enumerate(t.split("\n"))]
    links = brute_links([x for _, x in rows], L.TAU, L.MIN_CHARS)
    assert len(links) > 30
    want = classes(rows, links, L.MIN_CHARS)
    got = L.line_classes(make_docs([(i, t, "s") for i, t in docs]), stage).collect()
    assert {(r.doc_id, r.line_no): ((r.class_doc_id, r.class_line_no), r.n_links, r.kept) for r in got} == want


def test_query_matches_all_pairs(spark):
    docs = duckdb.sql(f"select doc_id, text from '{SF001}/documents.parquet'").fetchall()
    rows = [((i, k), line) for i, t in docs for k, line in enumerate(t.split("\n"))]
    want = classes(rows, brute_links([x for _, x in rows], L.TAU, L.MIN_CHARS), L.MIN_CHARS)
    got = queries()["op4_linededup"](spark, SF001).collect()
    assert {(r.doc_id, r.line_no): ((r.class_doc_id, r.class_line_no), r.n_links, r.kept) for r in got} == want


def test_edited_words_of_long_lines(spark, make_docs, stage, monkeypatch):
    """Lines of 20 and more words by word edits, at the borders of the bands and in blocks cut by size."""
    rng = random.Random(8)
    vocab = ["".join(rng.choices("abcdefgé", k=rng.randint(1, 9))) for _ in range(300)]
    base = [rng.choices(vocab, k=n) for n in [18, 19, 20, 21, 22, 30, 38, 39, 40, 41, 42, 43, 60, 200] for _ in range(3)]

    def line():
        ws = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3])):
            at, what = rng.randint(0, len(ws)), rng.randint(0, 3)
            if what == 0 or at == len(ws):
                ws.insert(at, rng.choice(vocab))
            elif what == 1:
                del ws[at]
            else:
                ws[at] = rng.choice(vocab)
        return rng.choice(["", " ", "\t"]) + rng.choice([" ", " ", "  "]).join(ws)

    docs = [(i, "\n".join(line() for _ in range(rng.randint(0, 8)))) for i in range(120)]
    rows = [((i, k), x) for i, t in docs for k, x in enumerate(t.split("\n"))]
    links = brute_links([x for _, x in rows], L.TAU, L.MIN_CHARS)
    assert len(links) > 300
    want = classes(rows, links, L.MIN_CHARS)
    docs = make_docs([(i, t, "s") for i, t in docs])
    for chars in (L.BLOCK_CHARS, 3000):
        monkeypatch.setattr(L, "BLOCK_CHARS", chars)
        got = L.line_classes(docs, stage).collect()
        assert {(r.doc_id, r.line_no): ((r.class_doc_id, r.class_line_no), r.n_links, r.kept) for r in got} == want


def test_dropping_lines(spark, odd_docs, make_docs, stage):
    out = L.drop_duplicate_lines(odd_docs, stage)
    assert out.schema == odd_docs.schema
    line = "a line that is long enough to count as one"
    docs = make_docs([(1, f"{line}\nshort\n{line}", "s"), (2, f"{line}!\nother words here", "s"),
                      (3, line, "s"), (4, "short", "s"), (None, line, "s")])
    got = {r.doc_id: r.text for r in L.drop_duplicate_lines(docs, stage).collect()}
    assert got == {1: f"{line}\nshort", 2: "other words here"}     # 4 is a copy of a short line
    extra = docs.withColumn("drop", F.lit(1)).withColumn("row", F.lit("x"))
    assert L.drop_duplicate_lines(extra, stage).columns == extra.columns
    assert L.drop_duplicate_lines(docs.limit(0), stage).count() == 0


def test_long_lines_and_many_lines(spark, make_docs, stage):
    """Megabytes in a line and 200,000 lines in a text take linear time."""
    import time
    rng = random.Random(7)
    a = "x" + "".join(rng.choices("abcdefgh ", k=4_000_000)) + "yz"
    start = time.time()
    assert L.within(a, "q" + a[1:-1], 2) and not L.within(a, "qq" + a[2:-2] + "qq", 2)
    assert time.time() - start < 20
    many = "\n".join(f"line {i % 100_000} of this text" for i in range(200_000))
    start = time.time()
    got = L.drop_duplicate_lines(make_docs([(1, many, "s"), (2, "\n \nline 7 of this text\n}", "s"), (3, "}", "s")]),
                                 stage).collect()
    assert time.time() - start < 120
    assert [(r.doc_id, len(r.text.split("\n"))) for r in sorted(got)] == [(1, 100_000), (2, 3)]


def test_short_copies_are_found_at_every_length(make_docs, stage):
    docs = make_docs([(1, "ab\n\n  \nno", "s"), (2, "ab\n\n  \nyes", "s"), (None, "yes\nab", "s"), (3, "Ab\nyess", "s")])
    got = {(r.doc_id, r.line_no): ((r.class_doc_id, r.class_line_no), r.n_links, r.kept)
           for r in L.line_classes(docs, stage).collect()}
    assert got == {(1, 0): ((1, 0), 0, True), (1, 1): ((1, 1), 0, True), (1, 2): ((1, 2), 0, True),
                   (1, 3): ((1, 3), 0, True), (2, 0): ((1, 0), 0, False), (2, 1): ((2, 1), 0, True),
                   (2, 2): ((2, 2), 0, True), (2, 3): ((2, 3), 0, True), (None, 0): ((2, 3), 0, False),
                   (None, 1): ((1, 0), 0, False), (3, 0): ((3, 0), 0, True), (3, 1): ((3, 1), 0, True)}


def test_a_block_gives_counts_not_pairs(spark, make_docs, stage, monkeypatch):
    """A dense group leaves the join in a row a line and block; its blocks count each pair once."""
    rng = random.Random(3)
    base = "".join(rng.choices("abcdefgh ", k=60))
    texts = sorted({edited(rng, base, rng.choice([0, 1, 1]), "abcdxyz") for _ in range(150)})
    lines = spark.createDataFrame([(t,) for t in texts * 2], "line string")
    want = Counter(x for link in brute_links(texts, L.TAU, L.MIN_CHARS) for x in link)
    hashed = {r.h1: r.line for r in lines.select(F.xxhash64("line").alias("h1"), "line").collect()}
    assert want.total() / 2 > 40 * len(texts)
    for block in (L.BLOCK, 40):
        monkeypatch.setattr(L, "BLOCK", block)
        got = L.edit_links(lines, stage).collect()
        n_links = Counter()
        for r in got:
            n_links[hashed[r.h1]] += r.n_links
        assert n_links == want
        if block == L.BLOCK:
            assert len(got) <= 10 * len(texts)


def test_lines_without_a_near_one_stage_nothing(spark, make_docs, stage):
    """Signatures of lines that share no key are neither written nor grouped row by row."""
    rng = random.Random(11)
    texts = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(30, 90))) for _ in range(300)]
    texts += [" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(45)) for _ in range(50)]
    assert L.edit_links(spark.createDataFrame([(t,) for t in texts * 2], "line string"), stage).count() == 0
    assert os.listdir(stage.root)
    assert [spark.read.parquet(f"{stage.root}/{name}").count() for name in os.listdir(stage.root)] \
        == [0] * len(os.listdir(stage.root))


def test_many_slots(spark, stage, monkeypatch):
    """Lines are dealt to many slots from many small pieces; the links are those of all pairs."""
    rng = random.Random(12)
    base = ["".join(rng.choices("abcdefgh é", k=rng.randint(30, 70))) for _ in range(30)]
    base += [" ".join("".join(rng.choices("abcdé", k=4)) for _ in range(n)) for n in (19, 20, 21, 40, 42) for _ in range(4)]
    texts = [edited(rng, rng.choice(base), rng.choice([0, 1, 1, 2, 3]), "abc é") for _ in range(300)]
    want = Counter(x for link in brute_links(texts, L.TAU, L.MIN_CHARS) for x in link)
    assert len(want) > 100
    lines = spark.createDataFrame([(t,) for t in texts], "line string").repartition(5)
    hashed = {r.h1: r.line for r in lines.select(F.xxhash64("line").alias("h1"), "line").collect()}
    for name, value in [("SLOT_LINES", 3), ("SIGN_ROWS", 100), ("SIGN_CHARS", 300), ("BLOCK", 4)]:
        monkeypatch.setattr(L, name, value)
    n_links = Counter()
    for r in L.edit_links(lines, stage).collect():
        n_links[hashed[r.h1]] += r.n_links
    assert n_links == want


def test_a_shared_key_keeps_its_different_lines():
    """A slot leaves each line of a key once, if two differ and one of them is a segment."""
    rng = random.Random(13)
    ids = [rng.randint(0, 3) for _ in range(150)]
    rows = [(rng.randint(-40, 40), i, 60 + 2 * i + rng.randint(0, 1)) for i in ids]
    slot = pa.table({c: [[r[k] for r in rows[a::3]] for a in range(3)] for k, c in enumerate(["key", "id", "mark"])})
    groups = {}
    for key, line, mark in rows:
        groups.setdefault(key, {}).setdefault(line, []).append(mark)
    want = sorted((key, line, max(marks)) for key, g in groups.items() for line, marks in g.items()
                  if len(g) > 1 and any(m % 2 for ms in g.values() for m in ms))
    assert 0 < len(want) < sum(map(len, groups.values()))
    assert sorted(tuple(r.values()) for r in L._shared(slot).to_pylist()) == want
    assert L._shared(slot.slice(0, 0)).num_rows == 0
