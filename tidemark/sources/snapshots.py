"""Storage of a type 2 snapshot as plain Parquet folders.

Each run that changes something writes one new folder, ``run=T``, holding the versions open after it
and the versions it closed, and marks it as complete with a file of its own, whatever the committer
leaves behind. A run whose write did not complete is ignored, so the previous state stays readable.
Versions closed by earlier runs are never read or rewritten, and the open rows of only two runs are
kept, so storage grows with the changes and a run costs what the open rows cost.

A run older than the last writes all versions anew, into ``run=L+N+T``: the N-th late run since run L,
at time T. Readers begin at the newest such folder. What lies before it goes when the next run begins.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.scd2 import ABSENT, scd2_merge, scd2_splice
from tidemark.sources.files import children, exists, mark, remove, write_text
from tidemark.sources.tables import laid_out, read_or_empty

_RUN_FORMAT = "%Y-%m-%dT%H-%M-%S-%f"
_LATE = "+"


def time_of(run: str) -> str:
    """The time of a stored run, that of a late one too."""
    return run.split(_LATE)[-1]


def _base(runs: Sequence[str]) -> str:
    """The first run that readers need."""
    return max((run for run in runs if _LATE in run), default="")


@dataclass(frozen=True)
class SnapshotTable:
    path: str
    schema: T.StructType
    key: str
    check_cols: Sequence[str]
    published: str | None = None  # where the last run is noted for catalog views

    def query(self) -> str:
        """``history`` as the text of a view, which finds the last noted run when it is queried."""
        first, last = (f"(SELECT max({name}) FROM json.`{self.published}/*.json`)" for name in ("base", "run"))
        columns = ", ".join(f"`{name}`" for name in self.schema.names)
        stored = f"SELECT {columns} FROM parquet.`{self.path}` WHERE run BETWEEN {first} AND {last}"
        return f"{stored} AND (NOT is_open OR run = {last})"

    def _rows(self, spark: SparkSession) -> DataFrame:
        folders = [T.StructField("run", T.StringType()), T.StructField("is_open", T.BooleanType())]
        noted = T.StructField(ABSENT, T.ArrayType(T.TimestampType()))
        rows = read_or_empty(spark, self.path, T.StructType([*self.schema.fields, noted, *folders]))
        return rows.withColumn(ABSENT, F.coalesce(ABSENT, F.array().cast("array<timestamp>")))

    def _folders(self, spark: SparkSession) -> list[str]:
        names = [name for name in children(spark, self.path) if name.startswith("run=")]
        return sorted(name.removeprefix("run=") for name in names)

    def runs(self, spark: SparkSession) -> list[str]:
        """Completed runs that changed something, oldest first."""
        return [run for run in self._folders(spark) if exists(spark, self._marker(run))]

    def _marker(self, run: str) -> str:
        return f"{self.path}/run={run}/_COMPLETE"

    def times(self, spark: SparkSession) -> list[str]:
        """The times of all completed runs, those that changed nothing too, oldest first."""
        noted = [name for name in children(spark, f"{self.path}/_runs") if not name.endswith(".tmp")]
        return sorted({*noted, *map(time_of, self.runs(spark))})

    def _open(self, spark: SparkSession, run: str | None) -> DataFrame:
        return self._rows(spark).filter(F.col("is_open") & (F.col("run") == run)).drop("run", "is_open")

    def open_rows(self, spark: SparkSession, run: str | None) -> DataFrame:
        """The versions open after ``run``; both filters are on folders, so only those are read."""
        return self._open(spark, run).select(*self.schema.names)

    def _versions(self, spark: SparkSession) -> DataFrame:
        runs = self.runs(spark)
        last = runs[-1] if runs else None
        rows = self._rows(spark).filter(F.col("run").between(_base(runs), last))
        return rows.filter(~F.col("is_open") | (F.col("run") == last)).drop("run", "is_open")

    def history(self, spark: SparkSession) -> DataFrame:
        """Every version: those closed by any completed run and those open after the last.

        Runs that did not complete are removed before the next one begins, so the only one there
        can be is later than the last that did.
        """
        return self._versions(spark).select(*self.schema.names)

    def run(self, incoming: DataFrame, as_of: datetime) -> None:
        """Fold ``incoming``, one row per key, into the snapshot as of the given time.

        Repeating the last run replaces its outcome. A run older than the last is spliced in, so runs
        in any order leave the same versions; it reads and writes all of them, once. An older run that
        has completed is refused. A run that changes nothing stores nothing but its time; a key that
        goes missing is a change. The open rows of the last two runs are kept, older ones are in the
        files of the run that closed them. ``as_of`` is in the session's time zone, or has one.
        """
        spark, time = incoming.sparkSession, as_of.strftime(_RUN_FORMAT)
        done, times = self.runs(spark), self.times(spark)
        late = bool(times) and time < times[-1]
        if late and time in times or any(name.startswith(time + _LATE) for name in done):
            raise ValueError(f"the snapshot run at {as_of} has completed, and later ones build on it")
        before = done if late else [name for name in done if name < time]
        for name in self._folders(spark):
            if name not in before or name < _base(before):
                remove(spark, f"{self.path}/run={name}")
        before = [name for name in before if name >= _base(before)]
        for known in times:  # a run that died after it completed has not noted its time
            self._note(spark, known)
        if late:
            number = sum(_LATE in name for name in done) + 1
            run = f"{before[-1].split(_LATE)[0]}{_LATE}{number:06d}{_LATE}{time}" if before else time
            moments = [datetime.strptime(t, _RUN_FORMAT).replace(tzinfo=as_of.tzinfo) for t in times]
            decided = scd2_splice(self._versions(spark), incoming, self.key, self.check_cols, as_of, moments)
        else:
            run = time
            previous = self._open(spark, before[-1] if before else None)
            decided = scd2_merge(previous, incoming, self.key, self.check_cols, as_of)
        folder = f"{self.path}/run={run}"
        laid_out(
            decided.withColumn("is_open", F.col("dbt_valid_to").isNull()), ["is_open"], [self.key]
        ).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            "is_open"
        ).parquet(folder)
        moment = F.lit(as_of).cast("timestamp")
        changed = self._rows(spark).filter(F.col("run") == run).filter(
            (F.col("dbt_valid_from") == moment)
            | (F.col("dbt_valid_to") == moment)
            | F.array_contains(ABSENT, moment)
        )
        if before and changed.isEmpty():
            remove(spark, folder)
            self._note(spark, time)
            return
        mark(spark, self._marker(run))
        self._note(spark, time)
        if self.published:
            state = {"run": run, "base": _base([*before, run])}
            write_text(spark, f"{self.published}/last.json", json.dumps(state))
        for old in before[:-1]:
            remove(spark, f"{self.path}/run={old}/is_open=true")

    def _note(self, spark: SparkSession, time: str) -> None:
        place = f"{self.path}/_runs/{time}"
        if not exists(spark, place):
            mark(spark, place)
