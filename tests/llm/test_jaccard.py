"""The Jaccard join against all pairs; the blocked product against plain overlaps."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from llm_fixtures import make_docs, odd_docs, stage  # noqa: F401
from pyspark.sql import functions as F

from histlake.llm import jaccard as J

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
AZ = {c: c + 32 for c in range(65, 91)}


def grams(text):
    w = WORDS.findall((text or "").translate(AZ))
    return {tuple(w[i:i + 4]) for i in range(max(len(w) - 3, 1))} if w else set()


def brute(rows):
    """Per row: set size, smallest doc_id reachable, number of linked rows."""
    sets = [grams(t) for _, t in rows]
    near = [{j for j, b in enumerate(sets) if j != i and a and b
             and 100 * len(a & b) >= 85 * len(a | b)} for i, a in enumerate(sets)]
    out = []
    for i, s in enumerate(sets):
        seen, todo = {i}, [i]
        while todo:
            todo = [y for x in todo for y in near[x] if not (y in seen or seen.add(y))]
        ids = [rows[x][0] for x in seen if rows[x][0] is not None]
        out.append((rows[i][0], len(s), min(ids) if ids else None, len(near[i])))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in df.collect()), key=str)


def test_edge_cases(odd_docs, stage):
    docs = odd_docs.withColumn("size", F.lit(1)).withColumn("hash", F.lit("clash")).withColumn("at", F.lit(2))
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert got(J.components(docs, stage)) == brute(rows)
    assert J.components(odd_docs.limit(0), stage).count() == 0


def planted(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=3))
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(25):
        base = [word() for _ in range(rng.choice([3, 8, 30, 90, 200]))]
        if rng.random() < .5:
            base += passage
        for _ in range(rng.randint(1, 5)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy[:rng.choice([len(copy), len(copy) - 1])] if len(copy) > 1 else copy))
    one = [word() for _ in range(80)]
    for _ in range(120):  # many near copies of one text, in a chain of sizes
        copy = one + [word() for _ in range(rng.randint(0, 40))]
        copy[rng.randrange(80)] = word()
        texts.append(" ".join(copy))
    texts += ["Same Case four words", "same case FOUR words", "a b c", "a b c", "a b", ""]
    return [(rng.choice([None, n, n // 2]) if n % 9 == 0 else n, t) for n, t in enumerate(texts)]


@pytest.mark.parametrize("block", [512, 16])
def test_planted_copies_against_all_pairs(make_docs, stage, monkeypatch, block):
    """Blocks of 16 rows cut the large group by band of size and by hash."""
    monkeypatch.setattr(J, "BLOCK_ROWS", block)
    monkeypatch.setattr(J, "BLOCK_TEXT", 5000)
    rows = planted(block)
    docs = make_docs([(i, t, "s") for i, t in rows]).repartition(4)
    assert got(J.components(docs, stage)) == brute(rows)


def test_product_against_plain_overlaps():
    rng = random.Random(1)
    common = rng.sample(range(5000), 3000)
    sets = []
    for _ in range(60):
        own = set(rng.sample(common, rng.randint(0, 3000))) | set(rng.sample(range(5000, 9000), rng.randint(0, 200)))
        sets.append(np.array(sorted(own), np.uint64))
        if rng.random() < .5:
            sets.append(np.array(sorted(set(own) - set(rng.sample(sorted(own), len(own) // 40))), np.uint64))
    sizes = np.array([len(s) + rng.randint(0, 3) for s in sets])
    side = np.array([rng.randint(0, 1) for _ in sets])
    for across in (None, side):
        links = J.Overlaps(sizes, sets, across).links()
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                n = len(np.intersect1d(a, b))
                want = i != j and 100 * n >= 85 * (sizes[i] + sizes[j] - n) and (across is None or side[i] != side[j])
                assert links[i, j] == want, (i, j)
