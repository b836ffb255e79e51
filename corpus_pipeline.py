"""Five stages from raw documents to token counts, each a corpus operator.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame, which ``run`` writes as Parquet and reads
again as the next stage's documents.  All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histlake.llm import linededup, mixing, pieces, repetition, simhash
from histlake.llm.common import Stage, read_table
from histlake.llm.queries import piece_model


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the repetition rules reject go."""
    return repetition.quality_filter(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line, exactly or nearly, go."""
    return linededup.drop_duplicate_lines(docs, Stage(spark, "pipeline-lines"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.keep_one_of_each(docs, Stage(spark, "pipeline-simhash"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none, one or two rows."""
    return mixing.mixed_documents(docs, Stage(spark, "pipeline-mix"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and the digests of ids and decoded text."""
    coded = pieces.encode_decode(F.col("text"), piece_model())
    return docs.select("doc_id", "source", coded.alias("c")).select("doc_id", "source", "c.*")


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("source_mix", source_mix), ("encode", encode)]

# The fingerprints, the Newton steps and the vocabulary have no form in SQL;
# tests/llm/test_pipeline.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    stage = Stage(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage.put(function(spark, docs, sf_dir), name)
    return docs
