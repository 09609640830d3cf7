"""Tables that change as a whole: numbered versions, and a log of parts that are merged when read.

In both a version counts once its record is written, after its data, and data that a record names are
never written again.  So a failed or half-done write changes nothing, a batch that runs again after it was
recorded does nothing, and readers always have a whole table.  One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelspark.sources.folders import remove

COMMIT = "version bigint, attempt bigint, rows bigint, run string, batch bigint"
MANIFEST = "version bigint, parts array<struct<folder:string,level:int>>, runs map<string,bigint>"


def _records(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _latest(seen: DataFrame, keys: list[str]) -> DataFrame:
    return seen.groupBy(*keys).agg(F.max("last_seen").alias("last_seen"))


@dataclass(frozen=True)
class VersionedTable:
    """Replaced as a whole.  ``keep`` versions stay readable after a newer one is written; older ones are removed.

    A commit record names the run and batch that wrote the version; a new run goes on after the last version, whatever its
    batches are numbered.
    """

    spark: SparkSession
    path: str
    keep: int = 5

    def _commits(self) -> DataFrame | None:
        return _records(self.spark, f"{self.path}/commits", COMMIT)

    def last_version(self, below: int | None = None) -> int | None:
        commits = self._commits()
        if commits is None:
            return None
        if below is not None:
            commits = commits.filter(F.col("version") < below)
        return commits.agg(F.max("version")).first()[0]

    def has(self, run: str, batch: int) -> bool:
        """Whether a batch of a run, or a later one, has been committed."""
        commits = self._commits()
        return commits is not None and not commits.filter((F.col("run") == run) & (F.col("batch") >= batch)).isEmpty()

    def _attempt(self, version: int) -> int | None:
        """The attempt of a version that counts."""
        commits = self._commits()
        if commits is None:
            return None
        return commits.filter(F.col("version") == version).agg(F.max(F.coalesce("attempt", F.lit(0)))).first()[0]

    def _data(self, version: int, attempt: int) -> str:
        return f"{self.path}/data/v{version}" + (f"-{attempt}" if attempt else "")

    def at(self, version: int | None) -> DataFrame | None:
        return None if version is None else self.spark.read.parquet(self._data(version, self._attempt(version) or 0))

    def current(self) -> DataFrame | None:
        return self.at(self.last_version())

    def write(self, df: DataFrame, version: int, run: str | None = None, batch: int | None = None) -> None:
        """Write a version; one that is there already gets a folder beside the one that readers have."""
        before = self._attempt(version)
        attempt = 0 if before is None else before + 1
        data = self._data(version, attempt)
        df.write.mode("overwrite").parquet(data)
        record = self.spark.read.parquet(data).agg(F.count("*").alias("rows"))
        told = {"attempt": (attempt, "bigint"), "run": (run, "string"), "batch": (batch, "bigint")}
        record = record.withColumns({name: F.lit(value).cast(kind) for name, (value, kind) in told.items()})
        record.coalesce(1).write.mode("append").parquet(f"{self.path}/commits/version={version}")
        self._forget(version - self.keep)

    def _forget(self, last: int) -> None:
        """Remove the versions up to ``last``: first their records, then their data."""
        old = [] if last < 0 else self._commits().filter(F.col("version") <= last).collect()
        for row in old:
            remove(self.spark, f"{self.path}/commits/version={row['version']}")
        for row in old:
            remove(self.spark, self._data(row["version"], row["attempt"] or 0))
            remove(self.spark, f"{self.path}/parts/v{row['version']}")

    def replace(self, df: DataFrame, run: str | None = None, batch: int | None = None) -> int:
        """Write the next version and make it the current one."""
        last = self.last_version()
        version = 0 if last is None else last + 1
        self.write(df, version, run, batch)
        return version

    def absorb(self, seen: DataFrame, keys: list[str], run: str, batch: int) -> None:
        """The next version: the last one with the latest ``last_seen`` of each key."""
        if self.has(run, batch):
            return
        before = self.current()
        self.replace(seen if before is None else _latest(before.unionByName(seen), keys), run, batch)


@dataclass(frozen=True)
class State:
    """A manifest: the parts that make up a version, and the last batch of each run in it."""

    version: int = -1
    parts: tuple[tuple[str, int], ...] = ()
    runs: Mapping[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class LogTable:
    """A log of parts, merged when read.

    Each batch adds a part of its own size.  Whenever ``fan`` parts of a level have come together they are merged into one
    of the next level, so that a row is written anew as many times as there are levels, however long the log runs.
    A manifest, written last, lists the parts of a version; nothing else makes a part visible.

    Rows with equal ``keys`` are merged column by column by the functions in ``merged``; a table without keys keeps all rows.
    ``by`` are columns that the parts are partitioned by.  ``keep`` manifests and their parts stay readable.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...] = ()
    merged: Mapping[str, Column] = field(default_factory=dict)
    by: tuple[str, ...] = ()
    fan: int = 10
    keep: int = 5

    def _manifests(self) -> DataFrame | None:
        return _records(self.spark, f"{self.path}/_manifests", MANIFEST)

    def state(self, version: int | None = None) -> State:
        """The manifest of a version, by default the last."""
        found = self._manifests()
        if found is None:
            return State()
        if version is not None:
            found = found.filter(F.col("version") == version)
        row = found.orderBy(F.desc("version")).first()
        if row is None:
            return State()
        return State(row["version"], tuple((p["folder"], p["level"]) for p in row["parts"]), dict(row["runs"]))

    def last_version(self) -> int | None:
        version = self.state().version
        return None if version < 0 else version

    def _read(self, folders: list[str]) -> DataFrame:
        """The merged rows of some parts."""
        read = [self.spark.read.parquet(f"{self.path}/{folder}") for folder in folders]
        return self.merge(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), read))

    def merge(self, rows: DataFrame) -> DataFrame:
        if not self.keys:
            return rows
        return rows.groupBy(*self.keys).agg(*(how.alias(name) for name, how in self.merged.items()))

    def at(self, version: int | None) -> DataFrame | None:
        parts = self.state(version).parts
        return self._read([folder for folder, _ in parts]) if parts else None

    def current(self) -> DataFrame | None:
        return self.at(None)

    def _write(self, df: DataFrame, folder: str) -> str:
        folder = f"{folder}/try={uuid.uuid4().hex}"
        df.write.partitionBy(*self.by).parquet(f"{self.path}/{folder}")
        return folder

    def _commit(self, before: State, parts: tuple[tuple[str, int], ...], runs: Mapping[str, int]) -> State:
        now = State(before.version + 1, parts, runs)
        row = (now.version, [{"folder": f, "level": n} for f, n in parts], dict(runs))
        record = self.spark.createDataFrame([row], MANIFEST).drop("version")
        record.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_manifests/version={now.version}")
        return now

    def has(self, run: str, batch: int) -> bool:
        """Whether a batch of a run, or a later one, is in the table."""
        return self.state().runs.get(run, -1) >= batch

    def append(self, df: DataFrame, run: str = "", batch: int | None = None) -> State:
        """Add rows as a part.  A batch of a run that is in the table already, or an earlier one, adds nothing."""
        before = self.state()
        batch = before.runs.get(run, -1) + 1 if batch is None else batch
        if before.runs.get(run, -1) >= batch:
            return before
        part = self._write(self.merge(df), f"run={run or 'none'}/batch={batch}")
        now = self._commit(before, (*before.parts, (part, 0)), {**before.runs, run: batch})
        now = self._compact_levels(now)
        self._forget(now)
        return now

    def absorb(self, seen: DataFrame, keys: list[str], run: str, batch: int) -> None:
        """Add what a batch has seen; the keys are those of the table."""
        self.append(seen, run, batch)

    def _compact_levels(self, now: State) -> State:
        level = 0
        while level <= max((n for _, n in now.parts), default=-1):
            full = [folder for folder, n in now.parts if n == level]
            if len(full) >= self.fan:
                now = self._merge_parts(now, full, level + 1)
            level += 1
        return now

    def _merge_parts(self, now: State, folders: list[str], level: int) -> State:
        rows = self._read(folders)
        if self.by:
            rows = rows.hint("rebalance", *self.by)
        part = self._write(rows, f"run=merged/batch={now.version + 1}")
        rest = tuple(p for p in now.parts if p[0] not in set(folders))
        return self._commit(now, (*rest, (part, level)), now.runs)

    def compact(self) -> State:
        """Merge all parts into one."""
        now = self.state()
        if len(now.parts) > 1:
            now = self._merge_parts(now, [f for f, _ in now.parts], 1 + max(n for _, n in now.parts))
            self._forget(now)
        return now

    def _forget(self, now: State) -> None:
        """Remove the manifests before the last ``keep``, then the parts that only these named."""
        rows = self._manifests().collect()
        old = [r for r in rows if r["version"] <= now.version - self.keep]
        held = {p["folder"] for r in rows if r["version"] > now.version - self.keep for p in r["parts"]}
        for row in old:
            remove(self.spark, f"{self.path}/_manifests/version={row['version']}")
        for folder in {p["folder"] for r in old for p in r["parts"]} - held:
            remove(self.spark, f"{self.path}/{folder}")


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of a streaming run; it stays with the checkpoint, so a restart has the same and a new checkpoint another."""
    return spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]
