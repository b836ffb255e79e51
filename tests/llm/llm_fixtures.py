from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def make_docs(spark):
    """documents from (doc_id, text, source) triples."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS)
    return make


@pytest.fixture()
def odd_docs(make_docs):
    """Nulls in any column, empty and long texts, ties, repeated rows."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(40_000))
    return make_docs([
        (1, None, "a"), (2, "", "a"), (3, " \n\t", None), (4, "one", "b"), (None, "no id here", "b"),
        (None, None, None), (5, long, "c"), (6, "same text twice over\nsame text twice over", "c"),
        (6, "same text twice over\nsame text twice over", "c"), (7, "É ÉÉ 日本 🙂", "é"),
        (8, "ab " * 300, "a"), (9, long + " end", "c")])


@pytest.fixture()
def stage(spark):
    from histlake.llm.common import Stage
    return Stage(spark, "test")
