"""Publication of staged results, resumable at every statement.

A load first stages everything it will publish, then writes one journal file
beside the main table: the list of catalog statements and file moves, with
absolute partition specs and folders.  Every action may run twice with the
same outcome, so a load that dies anywhere is finished by replaying its
journal; every load of the table does that before anything else.  A finished
journal is renamed, and its name tells a re-run that the batch is in place.

Staged partitions the target lacks are attached where they were written; the
files of the others are moved (renamed) into the target's folder, so nothing
is written twice and no copy stays behind.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession

from ..plans.spec import TableSpec
from .tables import (_add_partitions, _matching, _pkey, _q, _spec_sql, _staged_locations, delete_path,
                     partition_location, partitions, table_location)

_LOG = "_histlake_log"            # hidden from readers of the table


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _write(spark: SparkSession, path: str, text: str) -> None:
    """Write under another name, then rename: a journal is whole or absent."""
    fs, tmp = _fs(spark, f"{path}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(tmp, _fs(spark, path)[1]):
        raise OSError(f"cannot write {path}")


def _read(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _move(spark: SparkSession, src: str, dst: str) -> None:
    """Every data file of ``src`` goes into ``dst``; names are unique by their uuid."""
    for name in _names(spark, src):
        if not name.startswith(("_", ".")):
            fs, a = _fs(spark, f"{src}/{name}")
            if not fs.rename(a, _fs(spark, f"{dst}/{name}")[1]):
                raise OSError(f"cannot move {src}/{name} to {dst}")
    delete_path(spark, src)


def _do(spark: SparkSession, a: dict) -> None:
    """One action of a journal."""
    table = _q(a["table"]) if "table" in a else ""
    if a["do"] == "add":
        _add_partitions(spark, a["table"], a["parts"], a["locs"])
    elif a["do"] == "set":
        spark.sql(f"ALTER TABLE {table} PARTITION ({_spec_sql(a['part'])}) SET LOCATION '{a['loc']}'")
    elif a["do"] == "drop":
        specs = ", ".join(f"PARTITION ({_spec_sql(p)})" for p in a["parts"])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    elif a["do"] == "move":
        _move(spark, a["src"], a["dst"])
    elif a["do"] == "refresh":
        spark.catalog.refreshTable(a["table"])
    elif a["do"] == "delete":
        delete_path(spark, a["path"])
    elif a["do"] == "drop_table":
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    else:
        raise ValueError(f"unknown action {a['do']!r}")


def _log_dir(spark: SparkSession, spec: TableSpec) -> str:
    return f"{table_location(spark, spec.m_table)}/{_LOG}"


def _journal_id(load: str, batch: str) -> str:
    return f"{load}-{re.sub(r'[^0-9A-Za-z]', '', batch)}"


def finish_pending(spark: SparkSession, spec: TableSpec) -> int:
    """Replay every journal a failed load of the table left behind."""
    log = _log_dir(spark, spec)
    pending = [n for n in _names(spark, log) if n.endswith(".json")]
    for name in pending:
        for action in json.loads(_read(spark, f"{log}/{name}")):
            _do(spark, action)
        _close(spark, f"{log}/{name}")
    return len(pending)


def _close(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if not fs.rename(p, _fs(spark, path.removesuffix(".json") + ".done")[1]):
        raise OSError(f"cannot close {path}")


def was_published(spark: SparkSession, spec: TableSpec, load: str, batch: str) -> bool:
    """Did this load of this batch run to its end?"""
    return f"{_journal_id(load, batch)}.done" in _names(spark, _log_dir(spark, spec))


class Publication:
    """Collects the actions of one load; :meth:`run` journals and performs them."""

    def __init__(self, spark: SparkSession, spec: TableSpec, load: str, batch: str | None = None):
        self.spark, self.spec = spark, spec
        self.id = _journal_id(load, batch or uuid.uuid4().hex)
        self.actions: list[dict] = []
        self.after: list[dict] = []

    def relocate(self, table: str, stage_table: str, match: dict, purge: bool = True, within=None) -> None:
        """``table``'s partitions under ``match`` become exactly the stage's:
        new ones attached, present ones pointed at the staged folder, others
        dropped.  Superseded folders are deleted at the end when ``purge``
        (readers that planned against them earlier would fail)."""
        keep = within or (lambda p: True)
        new = [p for p in _matching(partitions(self.spark, stage_table), match) if keep(p)]
        old = {_pkey(p): p for p in _matching(partitions(self.spark, table), match) if keep(p)}
        add, add_locs = [], []
        for p, loc in zip(new, _staged_locations(self.spark, stage_table, new), strict=True):
            if _pkey(p) in old:
                self._supersede(table, p, purge)
                self.actions.append({"do": "set", "table": table, "part": p, "loc": loc})
                del old[_pkey(p)]
            else:
                add.append(p)
                add_locs.append(loc)
        if add:
            self.actions.append({"do": "add", "table": table, "parts": add, "locs": add_locs})
        if old:
            for p in old.values():
                self._supersede(table, p, purge)
            self.actions.append({"do": "drop", "table": table, "parts": list(old.values())})
        self.actions.append({"do": "refresh", "table": table})

    def _supersede(self, table: str, part: dict, purge: bool) -> None:
        if purge:
            self.after.append({"do": "delete", "path": partition_location(self.spark, table, part)})

    def append(self, table: str, stage_table: str, match: dict) -> None:
        """Add the stage's partitions under ``match``: attached where they are
        new, their files moved into the partition where it exists."""
        new = _matching(partitions(self.spark, stage_table), match)
        have = {_pkey(p) for p in partitions(self.spark, table)}
        add, add_locs = [], []
        for p, loc in zip(new, _staged_locations(self.spark, stage_table, new), strict=True):
            if _pkey(p) in have:
                self.actions.append({"do": "move", "src": loc, "dst": partition_location(self.spark, table, p)})
            else:
                add.append(p)
                add_locs.append(loc)
        if add:
            self.actions.append({"do": "add", "table": table, "parts": add, "locs": add_locs})
        if new:
            self.actions.append({"do": "refresh", "table": table})

    def forget(self, stage_table: str) -> None:
        """Drop a stage table's catalog entry once its files have their place."""
        self.after.append({"do": "drop_table", "table": stage_table})

    def delete(self, path: str) -> None:
        self.after.append({"do": "delete", "path": path})

    def run(self) -> None:
        path = f"{_log_dir(self.spark, self.spec)}/{self.id}.json"
        actions = [*self.actions, *self.after]
        _write(self.spark, path, json.dumps(actions))
        for action in actions:
            _do(self.spark, action)
        _close(self.spark, path)
