"""Rules against Python, the model on names it was not trained on."""

from __future__ import annotations

import re

import duckdb
import numpy as np
import pytest
from conftest import SF01
from pyspark.sql import functions as F

from histlake.llm import urlfilter as U
from histlake.llm.queries import queries


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(c.lower() if c.isascii() else c for c in host), path


def rule(host, path):
    fit = [r for r in U.RULES if (host == r[0].split("/", 1)[0] or host.endswith("." + r[0].split("/", 1)[0]))
           and path.startswith("/" + r[0].split("/", 1)[1])]
    return max(fit, key=lambda r: len(r[0]), default=(None, None))


def test_query_against_brute_force(spark):
    rows = duckdb.sql(f"select page_id, url from '{SF01}/pages.parquet'").fetchall()
    got = {r.page_id: r for r in queries()["op7_urlfilter"](spark, SF01).collect()}
    assert len(got) == len(rows)
    for i, url in rows:
        host, path = parts(url)
        name, verdict = rule(host, path)
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, name)
        assert r.verdict == (verdict or ("block" if r.p_block >= 0.5 else "allow"))
    plan = queries()["op7_urlfilter"](spark, SF01)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_training_matches_plain_descent(spark):
    """Dual steps are gradient steps on the weights."""
    rows = [("https://cheap-pills.example.com/a", 1), ("https://museum.example.com/a", 0),
            ("https://win-casino.example.net/b", 1), ("https://library.example.net/b", 0)]
    df = U.label_table(spark, rows)
    f = {r.url: r.f for r in df.select("url", U.features(U.host_of(F.col("url")), U.path_of(F.col("url"))).alias("f")).collect()}
    names = sorted(f)
    x = np.zeros((4, U.DIM + 1))
    for e, u in enumerate(names):
        x[e, 0] = 1
        for j in f[u]:
            x[e, j + 1] += 1 / np.sqrt(len(f[u]))
    y = np.array([dict(rows)[u] for u in names], float)
    w = np.zeros(U.DIM + 1)
    for _ in range(U.STEPS):
        p = 1 / (1 + np.exp(-x @ w))
        w = w * (1 - U.RATE * U.DECAY) + U.RATE * 10 / 4 * x.T @ (y - p)
    assert U.train(df).first()["w"] == pytest.approx(list(w), abs=1e-8)


def test_held_out_names(spark):
    """Names left out of the table, in shapes and hosts not seen."""
    bad = ["cheap-viagra-pills", "casino-bonus", "spam-link-farm", "free-casino-money", "adult-xxx-cams"]
    fine = ["city-museum", "history-archive", "school-library", "science-journal", "river-news"]
    pages = spark.createDataFrame([(i, f"https://{n}.example.edu/{i}?q=1") for i, n in enumerate(bad + fine)],
                                  "page_id long, url string")
    got = {r.page_id: r.verdict for r in U.judge(pages, U.label_table(spark)).collect()}
    assert sum(got[i] == ("block" if i < 5 else "allow") for i in range(10)) >= 9


def test_edge_cases(spark):
    urls = [None, "", "no scheme", "://", "x://", "HTTP://WWW.EXAMPLE.ORG/es/1", "http://org", "http://org/",
            "http://a.com/de/x", "http://a.com#/fr/", "http://É.example.org/en/12", "http://h/" + "p" * 50_000,
            "a://b://c/d", "http://x.org?/a"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(7, urls[7]), (None, urls[8])],
                                  "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("w", F.lit(1))
    got = U.judge(pages, U.label_table(spark)).collect()
    assert len(got) == len(urls) + 2
    for r in got:
        if r.page_id is not None:
            host, path = parts(urls[r.page_id])
            assert (r.host, r.path, r.rule) == (host, path, rule(host, path)[0])
            assert r.verdict in ("allow", "block")
    assert U.judge(pages.limit(0), U.label_table(spark)).count() == 0
    with pytest.raises(ValueError):
        U.train(U.label_table(spark, [(f"http://h{i}/", i % 2) for i in range(U.MAX_LABELS + 1)]))
