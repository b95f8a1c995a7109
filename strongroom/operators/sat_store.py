"""A satellite stored by load date, with heads for loads that read little.

``<path>/history/LOAD_DATE=…`` holds the versions.  ``<path>/heads/AS_OF=…``
holds, per key, the primary key and HASH_DIFF of its last version before that
day.  A timeline load compares a batch with the versions since its first day
and, for the keys without one there, with the last version before; so it reads
one heads folder and the partitions from its day on, however long the history
is.

Heads are derived: each is made of the one before and the partitions in
between.  Heads of days after a batch's first row may change by it and are
removed before it is appended, so a load that fails half way leaves nothing
wrong, and the next one makes them again from an older one.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strongroom.operators.common import last_per_key
from strongroom.operators.satellite import load_sat, parent_is_valid
from strongroom.operators.specs import HASH_DIFF, LOAD_DTS, SatSpec
from strongroom.sources.io import append, counted, overwrite, read_or_none, remove, subfolders, written

LOAD_DATE, AS_OF = "LOAD_DATE", "AS_OF"


@dataclass(frozen=True)
class SatStore:
    """The stored satellite of ``spec`` below ``path``.

    ``roll_days``: new heads are made when a batch begins so many days after
    the last ones.  More days write heads more rarely and read more
    partitions per load."""

    spark: SparkSession
    path: str
    spec: SatSpec
    roll_days: int = 1

    def read(self, since: dt.date | None = None, before: dt.date | None = None) -> DataFrame | None:
        """Versions, all or of some load dates (a partition filter); None before the first load."""
        rows = read_or_none(self.spark, f"{self.path}/history")
        if rows is None:
            return None
        if since is not None:
            rows = rows.filter(F.col(LOAD_DATE) >= F.lit(since))
        if before is not None:
            rows = rows.filter(F.col(LOAD_DATE) < F.lit(before))
        return rows.drop(LOAD_DATE)

    def heads_days(self) -> list[dt.date]:
        """Days of the finished heads, ascending."""
        names = [n for n in subfolders(self.spark, f"{self.path}/heads") if n.startswith(f"{AS_OF}=")]
        return [dt.date.fromisoformat(n.split("=")[1]) for n in names if written(self.spark, f"{self.path}/heads/{n}")]

    def _heads_path(self, day: dt.date) -> str:
        return f"{self.path}/heads/{AS_OF}={day.isoformat()}"

    def _narrow(self, rows: DataFrame | None) -> DataFrame | None:
        return None if rows is None else rows.select(*self.spec.pk(), HASH_DIFF)

    def _base(self, first: dt.date) -> tuple[dt.date | None, DataFrame | None]:
        day = max((d for d in self.heads_days() if d <= first), default=None)
        return day, None if day is None else self.spark.read.parquet(self._heads_path(day))

    def boundary(self, first: dt.date) -> DataFrame | None:
        """Primary keys and HASH_DIFFs that decide on a batch from ``first`` on:
        the last version before some day up to ``first`` of every key, and all
        versions since that day.  None before the first load."""
        day, heads = self._base(first)
        later = self._narrow(self.read(since=day))
        return later if heads is None or later is None else heads.unionByName(later)

    def roll(self, first: dt.date) -> None:
        """Make the heads of ``first`` where the last ones are ``roll_days`` older or there are none."""
        day, heads = self._base(first)
        if day is not None and (first - day).days < self.roll_days:
            return
        between = self._narrow(self.read(since=day, before=first))
        if between is None:
            return
        rows = between if heads is None else heads.unionByName(between)
        keys = self.spec.part_keys()
        overwrite(last_per_key(rows, keys, [LOAD_DTS, HASH_DIFF]), self._heads_path(first))

    def forget(self, after: dt.date) -> None:
        """Remove heads that rows of day ``after`` may change."""
        for name in subfolders(self.spark, f"{self.path}/heads"):
            if name.startswith(f"{AS_OF}=") and dt.date.fromisoformat(name.split("=")[1]) > after:
                remove(self.spark, f"{self.path}/heads/{name}")

    def new_rows(self, stg: DataFrame, first: dt.date) -> DataFrame:
        """Rows that a load of ``stg``, whose first valid row is of day ``first``, would append."""
        return load_sat(stg, self.boundary(first), self.spec)

    def load(self, stg: DataFrame) -> int:
        """Timeline load of a batch, appended by load date; the number of rows
        appended.  The batch may overlap earlier ones, be one of them again, or
        bring late rows; a load that is tried again adds only what is missing."""
        first = stg.filter(parent_is_valid(self.spec)).agg(F.min(LOAD_DTS).cast("date")).first()[0]
        if first is None:
            return 0
        self.forget(first)
        self.roll(first)
        rows = self.new_rows(stg, first).withColumn(LOAD_DATE, F.col(LOAD_DTS).cast("date"))
        # Rebalanced by date: few files per date, and a date with most rows is split.
        return counted(rows.hint("rebalance", LOAD_DATE), lambda df: append(df, f"{self.path}/history", [LOAD_DATE]))
