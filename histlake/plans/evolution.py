"""Columns added and types widened between two loads of a table.

The versions of a table's columns are kept beside its main table, each with the
batch time it holds from.  Old files stay as they are: a column they lack reads
as null, a narrower type as the wider one.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from ..functions.slots import batch_text
from ..operators.evolve import ColumnVersion
from ..session import checkpoint_root
from ..sources.publish import _fs, _names, _read, _write, finish_pending
from ..sources.tables import (_add_partitions, _q, create_layers, delete_path, partition_location, partitions,
                              table_location)
from .spec import TableSpec, spark_type

_VERSIONS = "_histlake_columns"
# The types that the Parquet reader widens, from -> to.
WIDENS = {("tinyint", "smallint"), ("tinyint", "int"), ("smallint", "int"), ("tinyint", "bigint"),
          ("smallint", "bigint"), ("int", "bigint"), ("float", "double"), ("int", "double")}


def _typed(spec: TableSpec) -> list[list[str]]:
    return [[c, spark_type(t).simpleString()] for c, t in spec.columns]


def column_versions(spark: SparkSession, spec: TableSpec) -> list[ColumnVersion]:
    """The versions of the table's columns, oldest first (one if never changed)."""
    folder = f"{table_location(spark, spec.m_table)}/{_VERSIONS}"
    names = [n for n in _names(spark, folder) if n.endswith(".columns")]
    found = [json.loads(_read(spark, f"{folder}/{n}")) for n in names]
    return [(v["since"], [tuple(c) for c in v["columns"]]) for v in found] or [
        (None, [tuple(c) for c in _typed(spec)])]


def _check(old: TableSpec, new: TableSpec) -> None:
    before, after = dict(_typed(old)), dict(_typed(new))
    if (old.keys, old.buckets, old.name, old.database) != (new.keys, new.buckets, new.name, new.database):
        raise ValueError(f"{old.name}: name, key and buckets of a table cannot change")
    for c, t in before.items():
        if c not in after:
            raise ValueError(f"{old.name}: column {c} is gone")
        if after[c] != t and (t, after[c]) not in WIDENS:
            raise ValueError(f"{old.name}: column {c} cannot go from {t} to {after[c]}")
        if after[c] != t and c in old.keys:
            raise ValueError(f"{old.name}: key column {c} cannot change its type")


def evolve(spark: SparkSession, old: TableSpec, new: TableSpec, batch_ts) -> None:
    """The layers of ``old`` get the columns of ``new``; versions opened from
    ``batch_ts`` on have them.  Data files are not touched: the tables' catalog
    entries are made anew over the same folders.  What is to be done is noted in
    the shared folder first, so a call that died can be made again."""
    _check(old, new)
    note = f"{checkpoint_root(spark)}/histlake/evolve-{old.database}-{old.name}.note"
    fs, path = _fs(spark, note)
    if fs.exists(path):
        plan = json.loads(_read(spark, note))
    else:
        finish_pending(spark, old)
        folder = f"{table_location(spark, old.m_table)}/{_VERSIONS}"
        versions = column_versions(spark, old)
        if [list(c) for c in versions[-1][1]] == _typed(new):
            return
        root, suffix = table_location(spark, old.m_table), f"/{old.prefixes[2]}{old.name}"
        if not root.endswith(suffix):
            raise ValueError(f"{old.m_table} does not lie where create_layers puts it")
        kept = {t: [(p, partition_location(spark, t, p)) for p in partitions(spark, t)]
                for t in (old.ff_table, old.m_table)}
        after = [*versions, (batch_text(batch_ts), _typed(new))]
        plan = {"root": root.removesuffix(suffix), "parts": kept, "versions": [
            [f"{folder}/v{i:04d}.columns", json.dumps({"since": since, "columns": columns})]
            for i, (since, columns) in enumerate(after)]}
        _write(spark, note, json.dumps(plan))
    for t in (old.f_table, old.ff_table, old.m_table):
        spark.sql(f"DROP TABLE IF EXISTS {_q(t)}")
    create_layers(spark, new, plan["root"])
    for t, kept in plan["parts"].items():
        _add_partitions(spark, t, [p for p, _ in kept], [loc for _, loc in kept])
        spark.catalog.refreshTable(t)
    for path_of, text in plan["versions"]:
        if path_of.rsplit("/", 1)[1] not in _names(spark, path_of.rsplit("/", 1)[0]):
            _write(spark, path_of, text)
    delete_path(spark, note)


__all__ = ["column_versions", "evolve"]
