"""The filter audit against its SQL, its definition, and a plain trie."""

from __future__ import annotations

import random
from itertools import permutations

from llm_fixtures import make_docs, odd_docs, stage  # noqa: F401
from pyspark.sql import functions as F

from histlake.llm import audit as A
from histlake.llm.common import Stage

LABELS = "doc_id long, quality int, toxic int"
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def brute(docs, labels):
    """(part, order, step) -> figures, document by document."""
    import re
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    low = {}
    for i, text, _ in docs:
        if i is not None:
            low[text or ""] = min(low.get(text or "", i), i)
    fails = []
    for i, text, part in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails.append((part or "", i, {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and i > low[t]}))
    out = {}
    for part in {p for p, _, _ in fails}:
        own = [(i, f) for p, i, f in fails if p == part]
        first = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for _, f in own:
                hit = next((x for x in order if f[x]), None)
                if hit:
                    first[hit] += 1
        for order in permutations("ABCDE"):
            for k, x in enumerate(order):
                before = [(i, f, any(f[y] for y in order[:k])) for i, f in own]
                removed = [i for i, f, gone in before if f[x] and not gone]
                out[part, "".join(order), k + 1] = (
                    sum(not f[x] and not gone for _, f, gone in before), len(removed),
                    sum(f[x] and gone for _, f, gone in before),
                    sum(f[x] and sum(f.values()) == 1 for _, f in own),
                    sum(i in good for i in removed), sum(i in toxic for i in removed), first[x])
    return out


def as_dict(df):
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in FIGURES) for r in df.collect()}


def rows_of(docs):
    return [(r.doc_id, r.text, r.source) for r in docs.collect()]


def test_edge_cases_by_definition(spark, odd_docs, stage):
    labels = [(1, 1, 0), (1, 0, 1), (4, 1, 1), (6, 1, 0), (None, 1, 1), (8, None, None), (999, 1, 1)]
    lab = spark.createDataFrame(labels, LABELS).withColumn("part", F.lit("x"))
    docs = odd_docs.withColumn("mask", F.lit(7)).withColumn("rid", F.lit("clash"))
    got = A.audit(docs, lab, stage)
    assert as_dict(got) == brute(rows_of(odd_docs), labels)
    assert A.audit(odd_docs.limit(0), lab, stage).count() == 0
    assert as_dict(A.audit(odd_docs, lab.limit(0), stage)) == brute(rows_of(odd_docs), [])


def test_ranges_split_by_adaptive_prefixes(spark, make_docs, monkeypatch):
    """Copies, long shared openings and tiny ranges: the answer stays, the
    prefixes grow only where texts crowd."""
    monkeypatch.setattr(A, "LEAST_RANGE", 400)
    monkeypatch.setattr(A, "HELD_BYTES", 3000)
    rng = random.Random(3)
    opening = " ".join(f"w{i}" for i in range(300))
    texts = [opening + " " + "".join(rng.choices("ab ", k=rng.randint(0, 9))) for _ in range(150)]
    texts += ["copy of one text $"] * 80 + ["Ü" * n for n in range(1, 20)]
    texts += ["".join(rng.choices("abcdEF #", k=rng.randint(0, 40))) for _ in range(200)]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = [(i, t, f"s{i % 3}") for i, t in zip(ids, texts, strict=True)]
    docs = make_docs(rows).repartition(7)
    stage = Stage(spark, "ranges")
    labels = [(i, i % 2, i % 5 == 0) for i in range(0, 300, 3)]
    lab = spark.createDataFrame([(i, q, int(t)) for i, q, t in labels], LABELS)
    assert as_dict(A.audit(docs, lab, stage)) == brute(rows, labels)
    texts = docs.select(F.col("text").cast("binary").alias("text"))
    heavy = A.heavy_prefixes(texts, 400, stage)
    depths = [d for d, _ in heavy]
    assert depths[:3] == [4, 8, 16] and max(depths) >= 1024
    ranged = A.text_ranges(texts, 400, stage)
    big = (ranged.select("range", "text").distinct().groupBy("range")
           .agg(F.sum(F.length("text")).alias("n"), F.count("*").alias("k")))
    assert big.where("n > 400 and k > 1").count() == 0
    # a range is the texts with one prefix, and one text is in one range
    assert ranged.where(~F.startswith("text", "range")).count() == 0
    assert ranged.distinct().count() == docs.select("text").distinct().count()


def test_trie_against_a_dict():
    rng = random.Random(5)
    trie, want = A.RadixTrie(), {}
    texts = [bytes(rng.choices(b"ab", k=rng.randint(0, 12))) for _ in range(3000)]
    texts += [b"x" * n for n in (0, 1, 50, 5000, 5001)] * 2
    for t in texts:
        assert trie.insert(t) == want.setdefault(t, len(want))
    order = sorted(want)
    assert list(trie.terminals()) == [want[t] for t in order]
