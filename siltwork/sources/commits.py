"""Runs whose writes become visible at once.

A run writes its tables' versions and its log rows under its own id, and one marker last: the marker names the versions
and the logs, and up to where the run has read. Readers take what marked runs wrote, and a job's watermark is its last
marker's. A run that a crash cut short has no marker: what it wrote is not seen, and is written over when the
same range is read again, so no row of a log can come twice and no version without its logs.

Only failures are told at once, each attempt's in a folder of its own.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from siltwork.sources import tables

RUN = "run"
_SEEN: dict[str, dict] = {}


@dataclass
class Run:
    """What a run has written so far."""

    run_id: str
    layer: str
    upto: int
    ts: str
    versions: dict[str, int] = field(default_factory=dict)
    logs: list[str] = field(default_factory=list)
    notes: dict[str, str] = field(default_factory=dict)
    #: Rows for logs that are written at the end.
    lines: dict[str, list[DataFrame]] = field(default_factory=dict)


@dataclass(frozen=True)
class Commits:
    root: str

    @property
    def path(self) -> str:
        return f"{self.root}/commits"

    def all(self, spark: SparkSession) -> list[Run]:
        """The markers in the order of their making; a small file for each run, which never changes."""
        fs, at = tables.files(spark, self.path)
        if not fs.exists(at):
            return []
        names = {f.getPath().getName(): f.getPath() for f in fs.listStatus(at)}
        out = []
        for name in sorted((n for n in names if n.endswith(".json")), key=lambda n: int(n[:-5])):
            key = f"{self.path}/{name}"
            if key not in _SEEN:
                stream = fs.open(names[name])
                _SEEN[key] = json.loads(bytes(stream.readAllBytes()).decode())
                stream.close()
            out.append(Run(**_SEEN[key]))
        return out

    def last(self, spark: SparkSession, layer: str) -> Run | None:
        """The last marker of a layer, by how far it has read."""
        return max((r for r in self.all(spark) if r.layer == layer), key=lambda r: (r.upto, r.ts), default=None)

    def version(self, spark: SparkSession, table: str) -> int | None:
        """The version of a table that readers see."""
        return max((r.versions[table] for r in self.all(spark) if table in r.versions), default=None)

    def next_version(self, spark: SparkSession, table: str) -> int:
        n = self.version(spark, table)
        return 0 if n is None else n + 1

    def log(self, run: Run, name: str, rows: DataFrame, at: str | None = None) -> None:
        """Rows of a run for a log, in days of a timestamp column if one is named."""
        if at is None:
            rows.write.mode("overwrite").parquet(f"{self.root}/{name}/{RUN}={run.run_id}")
        else:
            days = [f"log_{k}" for k in ("year", "month", "day")]
            tables.with_day(rows, at, "log").write.mode("overwrite").partitionBy(*days).parquet(f"{self.root}/{name}/{RUN}={run.run_id}")
        run.logs.append(name)

    def log_lines(self, run: Run, name: str, at: str) -> None:
        """The rows that a run has gathered for a log, if any."""
        if run.lines.get(name):
            every, *rest = run.lines[name]
            for more in rest:
                every = every.unionByName(more)
            self.log(run, name, every.coalesce(1), at)

    def failed(self, name: str, rows: DataFrame) -> None:
        """Rows about an attempt that failed; seen at once."""
        rows.write.parquet(f"{self.root}/{name}_failures/{RUN}={uuid.uuid4().hex}")

    def mark(self, spark: SparkSession, run: Run) -> None:
        """Makes the run visible: its marker is written beside the others and then takes its name, all at once."""
        fs, at = tables.files(spark, self.path)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        n = 1 + max((int(f.getPath().getName()[:-5]) for f in fs.listStatus(at) if f.getPath().getName().endswith(".json")), default=-1) if fs.exists(at) else 0
        held = {"run_id": run.run_id, "layer": run.layer, "upto": run.upto, "ts": run.ts, "versions": run.versions, "logs": sorted(set(run.logs)), "notes": run.notes}
        half, whole = path(f"{self.path}/_{uuid.uuid4().hex}"), path(f"{self.path}/{n}.json")
        out = fs.create(half, True)
        out.write(bytearray(json.dumps(held).encode()))
        out.close()
        if not fs.rename(half, whole):
            raise OSError(f"marker {n} of {self.path} could not be made: has another run made it?")

    def read(self, spark: SparkSession, name: str, *, layers: Sequence[str] = ()) -> DataFrame | None:
        """A log's rows of marked runs, with those of failures; None if no run wrote any."""
        at = f"{self.root}/{name}"
        runs = [r.run_id for r in self.all(spark) if name in r.logs and (not layers or r.layer in layers)]
        rows = spark.read.option("basePath", at).option("mergeSchema", "true").parquet(*[f"{at}/{RUN}={r}" for r in runs]).drop(RUN, *[f"log_{k}" for k in ("year", "month", "day")]) if runs else None
        fs, there = tables.files(spark, f"{at}_failures")
        if not fs.exists(there):
            return rows
        failures = spark.read.parquet(f"{at}_failures").drop(RUN)
        return failures if rows is None else rows.unionByName(failures, allowMissingColumns=True)

