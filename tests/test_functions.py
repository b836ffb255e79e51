"""Batch time, slots, surrogate ids and fingerprints."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from histlake.functions import (batch_minutes, batch_text, check_key, day_slot, row_checksum,
                                slot_of, surrogate_id)


def test_batch_text_truncates_and_accepts_forms():
    assert batch_text("2022-04-20 10:11:12.987") == "2022-04-20 10:11:12"
    assert batch_text(dt.datetime(2022, 4, 20, 10, 11, 12, 5)) == "2022-04-20 10:11:12"
    assert batch_text(dt.date(2022, 4, 20)) == "2022-04-20 00:00:00"
    aware = dt.datetime(2022, 4, 20, 18, 11, 12, tzinfo=dt.timezone(dt.timedelta(hours=8)))
    assert batch_text(aware) == "2022-04-20 10:11:12"
    with pytest.raises(TypeError):
        batch_text(12)


def test_slots_match_calendar():
    assert slot_of("2022-04-20 10:00:00", "week") == 3          # Wednesday
    assert slot_of("2022-04-24 10:00:00", "week") == 7          # Sunday
    assert slot_of("2022-04-20 10:00:00", "month") == 20
    with pytest.raises(ValueError):
        slot_of("2022-04-20", "year")


def test_day_slot_column(spark):
    df = spark.createDataFrame([("2022-04-18 00:00:00",), ("2022-04-24 23:59:59",), ("2022-05-31 12:00:00",)],
                               "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    rows = df.select(day_slot("t", "week").alias("w"), day_slot("t", "month").alias("m")).collect()
    assert [(r.w, r.m) for r in rows] == [(1, 18), (7, 24), (2, 31)]


def test_batch_minutes_epoch():
    # midnight 2000-01-01 at UTC+8 is minute 0
    assert batch_minutes("1999-12-31 16:00:00") == 0
    assert batch_minutes("1999-12-31 16:01:59") == 1


# known answers of the compatible layout at 2022-04-20 10:11:12: (row number, id)
KNOWN_IDS = [
    (0, "206354424752720838656"),
    (1073741824, "206354424753794580480"),
    (8589934591, "206354424761310773247"),
    (8589934592, "206354424753794580480"),
    (42949672977, "206354424758089547793"),
]


def test_surrogate_id_known_answers(spark):
    got = spark.createDataFrame(KNOWN_IDS, "oid long, id string").select(
        surrogate_id("2022-04-20 10:11:12", "oid").alias("got"), "id").collect()
    assert all(r.got == r.id for r in got)


def test_wide_ids_of_two_minutes_never_meet(spark):
    """Partition 16,384 at one minute, partition 0 at the next; the last rows of either."""
    oid = spark.createDataFrame([(16_384 << 33,), (0,), (((1 << 30) - 1) << 33,), ((1 << 63) - 1,)], "oid long")
    at = ["2022-04-20 10:11:12", "2022-04-20 10:12:12"]
    wide = [r.id for t in at for r in oid.select(surrogate_id(t, "oid", wide=True).alias("id")).collect()]
    assert len(set(wide)) == len(wide)
    assert max(map(int, wide[:4])) < min(map(int, wide[4:]))
    short = [r.id for t in at for r in oid.limit(2).select(surrogate_id(t, "oid").alias("id")).collect()]
    assert short[0] == short[3]          # why the wide layout is the default


def test_surrogate_id_default_is_unique_per_batch(spark):
    df = spark.range(0, 5000, numPartitions=7).select(surrogate_id("2022-04-20 10:11:12").alias("id"))
    assert df.distinct().count() == 5000


def test_strict_checksum_separates_fields_and_nulls(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("ab", "c", None), ("a", "bc", None)],
                               "x string, y string, z string")
    strict = [r.c for r in df.select(row_checksum(["x", "y", "z"]).alias("c")).collect()]
    compat = [r.c for r in df.select(row_checksum(["x", "y", "z"], strict=False).alias("c")).collect()]
    assert len(set(strict)) == 4
    assert compat[0] == compat[1] and compat[2] == compat[3]       # the collisions of the compat form


def test_check_key_prefixes_keys(spark):
    df = spark.createDataFrame([(1, "x")], "k int, v string")
    row = df.select(check_key(["k"], row_checksum(["k", "v"])).alias("ck"),
                    row_checksum(["k", "v"]).alias("c")).first()
    assert row.ck == "1\x1f" + row.c
    compat = df.select(check_key(["k"], F.lit("abc"), strict=False).alias("ck")).first().ck
    assert compat == "1abc"
