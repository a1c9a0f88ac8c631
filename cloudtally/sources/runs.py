"""Runs: their intermediate tables, the lease on them, and saved runs that reports can start from.

A run's tables lie in a folder of its own under the work folder and go when the run ends. The folder has a lease, a
small file with the time until which it is in use, renewed with each table; ``sweep`` deletes folders whose lease has
run out, which are those of runs that died. A run that is kept writes its tables to a folder that it is given, and a
manifest last: schemas, row counts, months. A run that starts from a manifest reads those tables and builds none.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cloudtally.session import demand_ansi, work_folder
from cloudtally.sources import folders
from cloudtally.sources.snapshots import load_snapshot, save_snapshot, save_snapshot_by_month

LEASE = dt.timedelta(hours=24)
_LEASE_FILE = "_lease"
_MANIFEST = "_manifest.json"


class NoSavedRun(ValueError):
    """The folder holds no whole run, or not the tables that its manifest names."""


def _root(spark: SparkSession) -> str:
    return f"{work_folder(spark)}/cloudtally"


def _clock() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def renew(spark: SparkSession, folder: str) -> None:
    """Lease a folder from now on."""
    folders.write_text(spark, f"{folder}/{_LEASE_FILE}", (_clock() + LEASE).isoformat())


@contextmanager
def leased(spark: SparkSession, name: str) -> Iterator[str]:
    """A leased folder for intermediate tables, deleted at the end, however that comes."""
    folder = f"{_root(spark)}/{name}_{uuid.uuid4().hex[:8]}"
    renew(spark, folder)
    try:
        yield folder
    finally:
        folders.delete(spark, folder)


def sweep(spark: SparkSession) -> list[str]:
    """Delete the folders of runs that died: those whose lease has run out. Returns their names.

    A folder without a lease is not known to be a run's and stays.
    """
    gone = []
    for name in folders.children(spark, _root(spark)):
        until = folders.read_text(spark, f"{_root(spark)}/{name}/{_LEASE_FILE}")
        if until and dt.datetime.fromisoformat(until) < _clock():
            folders.delete(spark, f"{_root(spark)}/{name}")
            gone.append(name)
    return gone


@dataclass
class Run:
    """Where a program's core tables are: built into ``folder``, or read from the manifest of a saved run."""

    spark: SparkSession
    folder: str
    staging: str
    facts: dict = field(default_factory=dict)
    tables: dict[str, dict] = field(default_factory=dict)
    from_saved: bool = False

    def table(self, name: str, build: Callable[[], DataFrame], month: str | None = None) -> DataFrame:
        """A core table: that of the saved run, or built and written (by ``month``, if it has one) and read again."""
        if self.from_saved:
            if name not in self.tables:
                raise NoSavedRun(f"{self.folder} has no table {name}")
            saved = load_snapshot(self.spark, self.folder, name, StructType.fromJson(self.tables[name]["schema"]))
            rows = saved.count()
            if rows != self.tables[name]["rows"]:
                raise NoSavedRun(f"{name} in {self.folder} has {rows} rows, not {self.tables[name]['rows']}")
            return saved
        renew(self.spark, self.staging)
        df = build()
        if month:
            save_snapshot_by_month(df, self.folder, name, month)
        else:
            save_snapshot(df, self.folder, name)
        written = load_snapshot(self.spark, self.folder, name, df.schema)
        self.tables[name] = {"schema": df.schema.jsonValue(), "month": month}
        return written


@contextmanager
def program_run(
    spark: SparkSession, program: str, name: str, keep: str | None = None, saved: str | None = None, **facts: object
) -> Iterator[Run]:
    """A program's run. ``facts`` (its months) go to the manifest; those of a saved run replace them."""
    demand_ansi(spark)
    if saved:
        with leased(spark, name) as staging:
            yield _opened(spark, program, saved, staging)
        return
    with leased(spark, name) as staging:
        run = Run(spark, f"{keep}/{name}" if keep else staging, staging, facts)
        yield run
        if keep:
            for table in run.tables:
                schema = StructType.fromJson(run.tables[table]["schema"])
                run.tables[table]["rows"] = load_snapshot(spark, run.folder, table, schema).count()
            manifest = {"program": program, "run": name, "facts": run.facts, "tables": run.tables}
            folders.write_text(spark, f"{run.folder}/{_MANIFEST}", json.dumps(manifest))


def _opened(spark: SparkSession, program: str, saved: str, staging: str) -> Run:
    text = folders.read_text(spark, f"{saved}/{_MANIFEST}")
    if text is None:
        raise NoSavedRun(f"{saved} has no manifest: the run there was not kept, or did not end")
    manifest = json.loads(text)
    if manifest["program"] != program:
        raise NoSavedRun(f"{saved} is a run of {manifest['program']}, not of {program}")
    return Run(spark, saved, staging, manifest["facts"], manifest["tables"], True)


def saved_runs(spark: SparkSession, keep: str) -> list[str]:
    """Folders of the whole runs under ``keep``, the oldest first."""
    names = folders.children(spark, keep)
    return [f"{keep}/{n}" for n in names if folders.exists(spark, f"{keep}/{n}/{_MANIFEST}")]
