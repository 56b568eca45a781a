"""The layered jobs: change feed to history, to current state, to published tables."""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltwork.operators import audit, changes, conform, control, deltas, merge, scd2
from siltwork.operators.gate import GateResult, Rule, gate_log, quality_gate, quarantine_dedup, quarantined, scoped
from siltwork.sources import buckets, history, tables
from siltwork.sources.commits import Commits, Run
from siltwork.sources.scratch import written


@dataclass(frozen=True)
class Entity:
    """An entity's keys and business columns, and its published columns with their formulas."""

    name: str
    keys: tuple[str, ...]
    business: tuple[str, ...]
    gold: tuple[str, ...] = ()
    formulas: Mapping[str, str] | None = None


ORDERS = Entity("orders", ("order_id",), ("order_id", "customer_name", "status", "amount"), ("order_id", "customer_name", "status", "amount", "total_tax_amount"), {"total_tax_amount": "CAST(amount AS DOUBLE) * 1.18"})


def history_feed(after: DataFrame, ts: str) -> DataFrame:
    """What the run at ``ts`` changed in the history: versions that it closed, and versions that it opened."""
    touched = (F.col(scd2.TO) == scd2.moment(ts)) | (F.col(scd2.FROM) == scd2.moment(ts))
    return after.where(touched)


def silver_source(feed: DataFrame, entity: Entity) -> DataFrame:
    """One row a key of a history feed: the open version counts more than the one that the same run closed."""
    return changes.latest_per_key(feed, entity.keys, [F.col(scd2.CURRENT).desc(), F.col(scd2.FROM).desc()])


def silver_merge(target: DataFrame, feed: DataFrame, entity: Entity, ts: str, rules: Sequence[Rule] = ()) -> tuple[DataFrame, GateResult]:
    """(Silver after the merge, the gate). Rows that are no longer current are deletes, and no check applies to them."""
    source = silver_source(feed, entity)
    gate = quality_gate(source, scoped(rules, scd2.CURRENT))
    rows = conform.silver_rows(gate.good, [*entity.business, scd2.CURRENT], ts)
    merged = merge.apply_changes(target, rows, entity.keys, ~F.col(scd2.CURRENT))
    return merged, gate


def gold_merge(target: DataFrame, source: DataFrame, entity: Entity, ts: str) -> DataFrame:
    """Gold after changes of Silver with ``_change_type``."""
    rows = conform.gold_rows(source, entity.gold, entity.formulas or {}, ts)
    marked = conform.gold_rows(source, [*entity.gold, changes.CHANGE_TYPE], entity.formulas or {}, ts)
    return merge.apply_changes(target.select(*rows.columns), marked, entity.keys, F.col(changes.CHANGE_TYPE) == changes.DELETE)


#: Layers whose rows pass a gate, and the logs that hold what it kept back.
QUARANTINE = {"silver": "quarantine", "gold": "quarantine_gold", "summary": "quarantine_summary"}
REPLAY = "replay"
#: Tables with one row a key.
BUCKETED = ("silver", "gold")


@dataclass
class Layers:
    """One entity's layers and logs under a root folder; each layer reads what the one before it wrote since its own last run.

    A gate stands before Silver, before Gold and before the derived table, on the first load as on every run after it.
    A run writes its rows, its quarantine and its logs under its own id and one marker last (``Commits``): only then are
    they seen, all at once, and only then has the layer read its range. A run that a crash cut short is done again from
    the same range and writes over what it left. A failure is told in the audit log at once.

    Bronze's current rows, Silver and Gold lie in hash buckets of the keys: a run reads and writes those that its changes
    reach, and refers to the others where they are.

    gates: rules of ``gold`` and ``summary``; Silver's rules are given to the run. per_bucket: rows that a bucket should hold.
    """

    root: str
    entity: Entity = ORDERS
    gates: Mapping[str, Sequence[Rule]] = field(default_factory=dict)
    per_bucket: int = buckets.ROWS

    @property
    def commits(self) -> Commits:
        return Commits(self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def log(self, spark: SparkSession, name: str) -> DataFrame | None:
        """A log's rows: quarantine, quarantine_gold, quarantine_summary, gate_log, audit_log, refresh_log, schema_log, resolved, late_changes."""
        return self.commits.read(spark, name)

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        """silver, gold, summary or summary_state as the last finished run left it."""
        return self._at(spark, name, self.commits.version(spark, name))

    def _at(self, spark: SparkSession, name: str, version: int) -> DataFrame:
        return buckets.read(spark, self.path(name), version) if name in BUCKETED else tables.read_snapshot(spark, self.path(name), version)[0]

    def history(self, spark: SparkSession) -> DataFrame:
        """Bronze's whole history."""
        return history.read(spark, self.path("bronze"), self.commits.version(spark, "bronze"))

    def watermark(self, spark: SparkSession, layer: str) -> int | None:
        last = self.commits.last(spark, layer)
        return None if last is None else last.upto

    @contextmanager
    def _run(self, spark: SparkSession, layer: str, upto: int, ts: str, action: str) -> Iterator[Run]:
        """A run of a layer: marked at its end, or told as a failure."""
        run, began = Run(f"{layer}-{upto}", layer, upto, ts), time.monotonic()
        took = lambda: int(1000 * (time.monotonic() - began))
        try:
            yield run
            lines = run.lines.setdefault("audit_log", [])
            if action != "merge":  # a merge has three rows of its own
                lines.append(audit.entry(spark, f"{run.notes.get('table', layer)}.{self.entity.name}", action, int(run.notes.get("rows", 0)), ts, duration_ms=took(), run_id=run.run_id))
            self.commits.log_lines(run, "audit_log", "event_timestamp")
            self.commits.log_lines(run, "gate_log", "event_timestamp")
            self.commits.mark(spark, run)
        except Exception as error:
            self.commits.failed("audit_log", audit.entry(spark, f"{layer}.{self.entity.name}", action, 0, ts, status="failure", duration_ms=took(), error=error, run_id=run.run_id))
            raise

    def _gate(self, run: Run, layer: str, rows: DataFrame, rules: Sequence[Rule], label: str, in_scope: str | None = None) -> DataFrame:
        """The rows that pass a layer's gate; what fails is in its quarantine, and the gate log has one row about it."""
        rules = scoped(rules, in_scope) if in_scope else rules
        result = quality_gate(rows, rules, run_id=run.run_id, run_ts=run.ts)
        result = GateResult(written(result.flagged, "gate"), result.columns, result.skipped)
        self.commits.log(run, QUARANTINE[layer], quarantined(result, label, run.ts, job_run_id=run.run_id))
        line = gate_log(result, rules, layer=layer, entity=self.entity.name, label=label, ts=run.ts, target=f"{layer}.{self.entity.name}", quarantine=self.path(QUARANTINE[layer]), run_id=run.run_id)
        run.lines.setdefault("gate_log", []).append(line)
        return result.good

    def _write(self, spark: SparkSession, run: Run, table: str, rows: DataFrame) -> int:
        """The next version of a table, seen once the run is marked."""
        run.versions[table] = tables.write_version(rows, self.path(table), self.commits.next_version(spark, table), redo=True)
        return run.versions[table]

    def _load(self, spark: SparkSession, run: Run, table: str, rows: DataFrame) -> int:
        """A whole table with one row a key, in buckets."""
        run.versions[table] = buckets.create(rows, self.path(table), self.entity.keys, self.commits.next_version(spark, table), per_bucket=self.per_bucket, redo=True)
        return run.versions[table]

    def _merge(self, spark: SparkSession, run: Run, table: str, rows: DataFrame, gone: Column) -> DataFrame:
        """Upserts and deletes by key into the buckets that they reach; what these held before. Metrics are logged after the write."""
        keys, path = self.entity.keys, self.path(table)
        into = buckets.reach(spark, path, rows, self.commits.version(spark, table))
        run.versions[table] = buckets.replace(into, merge.apply_changes(into.rows, rows, keys, gone), path, self.commits.next_version(spark, table), redo=True)
        metrics = merge.merge_metrics(into.rows, rows, keys, gone)
        run.lines.setdefault("audit_log", []).append(audit.merge_entries(metrics, f"{table}.{self.entity.name}", run.ts, run_id=run.run_id))
        return into.rows

    def _written(self, spark: SparkSession, run: Run, table: str) -> DataFrame:
        return self._at(spark, table, run.versions[table])

    # --- the first load -----------------------------------------------------------------------------------------

    def bootstrap(self, spark: SparkSession, snapshot: DataFrame, version: int, ts: str, rules: Sequence[Rule] = ()) -> None:
        """The first load of all layers from a snapshot of Staging at a version of its feed; layers that have been loaded stay."""
        e = self.entity
        if self.watermark(spark, "bronze") is None:
            with self._run(spark, "bronze", version, ts, "bootstrap") as run:
                run.versions["bronze"] = history.create(scd2.bootstrap(snapshot.select(*e.business), e.business, ts), self.path("bronze"), 0, keys=e.keys, per_bucket=self.per_bucket, redo=True)
                run.notes["rows"] = str(history.current(spark, self.path("bronze"), 0)[0].count())
        bronze = self.commits.version(spark, "bronze")
        if self.watermark(spark, "silver") is None:
            with self._run(spark, "silver", bronze, ts, "bootstrap") as run:
                now, _ = history.current(spark, self.path("bronze"), bronze)
                good = self._gate(run, "silver", now, rules, "bootstrap")
                rows = conform.silver_bootstrap(good, e.business, ts)
                self._drift(spark, run, "silver", rows)
                self._load(spark, run, "silver", rows)
                run.notes["rows"] = str(self._written(spark, run, "silver").count())
        if self.watermark(spark, "gold") is None:
            silver = self.commits.version(spark, "silver")
            with self._run(spark, "gold", silver, ts, "bootstrap") as run:
                rows = self._at(spark, "silver", silver)
                good = self._gate(run, "gold", conform.gold_rows(rows, e.gold, e.formulas or {}, ts), self.gates.get("gold", ()), "bootstrap")
                self._load(spark, run, "gold", good)
                gold = self._written(spark, run, "gold")
                run.notes["rows"] = str(gold.count())
                self._write(spark, run, "summary_state", deltas.state_of(gold, deltas.STATUS, deltas.status_measures()))
                self._publish(spark, run, ts, "bootstrap")

    # --- the runs after it --------------------------------------------------------------------------------------

    def run_bronze(self, spark: SparkSession, to_version: int, ts: str) -> int | None:
        """Staging's changes up to a version into the history; None if there is nothing to read."""
        mark = self.watermark(spark, "bronze")
        control.check_bootstrap(bool(tables.versions(spark, self.path("bronze"))), mark)
        if mark is not None and mark >= to_version:
            return None
        return self.run_feed(spark, changes.read_changes(spark.read.parquet(self.path("staging")), mark, to_version), to_version, ts)

    def run_feed(self, spark: SparkSession, feed: DataFrame, to_version: int, ts: str, *, batch: str | None = None) -> int:
        """Changes after Bronze's watermark, up to a version, into the history. batch: the name of a stream's batch, held in the marker."""
        e = self.entity
        with self._run(spark, "bronze", to_version, ts, "scd2") as run:
            if batch is not None:
                run.notes["batch"] = batch
            before = self.commits.version(spark, "bronze")
            run.versions["bronze"] = history.run(spark, self.path("bronze"), feed, e.keys, e.business, ts, before, before + 1, redo=True)
            run.notes["rows"] = str(history.changes(spark, self.path("bronze"), before, before + 1).count())
        return run.versions["bronze"]

    def log_late(self, spark: SparkSession, rows: DataFrame, batch: str, ts: str) -> None:
        """Changes that a stream's batch brought after their version had been passed; told once a batch."""
        run = Run(f"late-{batch}", "late", len(self.commits.all(spark)), ts)
        if any(r.run_id == run.run_id for r in self.commits.all(spark)):
            return
        self.commits.log(run, "late_changes", rows.withColumns({"_batch": F.lit(batch), "_seen_at": F.lit(ts).cast("timestamp")}))
        self.commits.mark(spark, run)

    def run_silver(self, spark: SparkSession, ts: str, rules: Sequence[Rule] = ()) -> int | None:
        """Bronze's changes through the gate into Silver; rows that fail are in quarantine, and Silver keeps what it had of them."""
        e, mark, to = self.entity, self.watermark(spark, "silver"), self.commits.version(spark, "bronze")
        if to is None or (mark is not None and mark >= to):
            return None
        with self._run(spark, "silver", to, ts, "merge") as run:
            feed = history.changes(spark, self.path("bronze"), -1 if mark is None else mark, to)
            source = changes.latest_per_key(feed, e.keys, [F.col(history.VERSION).desc(), F.col(scd2.CURRENT).desc(), F.col(scd2.FROM).desc()]).drop(history.VERSION)
            good = self._gate(run, "silver", source, rules, "incremental", scd2.CURRENT)
            self._merge_silver(spark, run, conform.silver_rows(good, [*e.business, scd2.CURRENT], ts))
        return run.versions["silver"]

    def _merge_silver(self, spark: SparkSession, run: Run, rows: DataFrame) -> None:
        """Rows that passed, with whether they are current, into Silver."""
        target = self.table(spark, "silver")
        self._drift(spark, run, "silver", rows.select(*target.columns))
        moved = rows.withColumn(changes.CHANGE_TYPE, F.when(F.col(scd2.CURRENT), changes.UPDATE).otherwise(changes.DELETE))
        version = self.commits.next_version(spark, "silver")
        # What changed is written before the version that has it, so no version is without its changes.
        moved.write.mode("overwrite").parquet(f"{self.path('silver_changes')}/v={version}")
        self._merge(spark, run, "silver", rows, ~F.col(scd2.CURRENT))

    def run_gold(self, spark: SparkSession, ts: str) -> int | None:
        """Silver's changes through Gold's gate into Gold, and by signed changes into the table that is derived from it."""
        e, mark, to = self.entity, self.watermark(spark, "gold"), self.commits.version(spark, "silver")
        if to is None or (mark is not None and mark >= to):
            return None
        first = 0 if mark is None else mark + 1
        with self._run(spark, "gold", to, ts, "merge") as run:
            moved = spark.read.option("basePath", self.path("silver_changes")).parquet(*[f"{self.path('silver_changes')}/v={v}" for v in range(max(first, 1), to + 1)])
            source = changes.latest_per_key(moved, e.keys, [F.col("v").desc()]).drop("v")
            source = conform.gold_rows(source, [*e.gold, changes.CHANGE_TYPE], e.formulas or {}, ts)
            good = self._gate(run, "gold", source, self.gates.get("gold", ()), "incremental", f"{changes.CHANGE_TYPE} <> '{changes.DELETE}'")
            gone = F.col(changes.CHANGE_TYPE) == changes.DELETE
            target = self._merge(spark, run, "gold", good, gone)
            state = self.table(spark, "summary_state")
            touched = deltas.folded(state, deltas.of_merge(target, good, e.keys, gone), deltas.STATUS, deltas.status_measures())
            self._write(spark, run, "summary_state", deltas.replaced(state, touched, deltas.STATUS))
            self._publish(spark, run, ts, "incremental")
        return run.versions["gold"]

    def _publish(self, spark: SparkSession, run: Run, ts: str, label: str) -> None:
        """The derived table from its state through its own gate, and the refresh log of what was published."""
        rows = deltas.status_summary(self._written(spark, run, "summary_state"))
        self._write(spark, run, "summary", self._gate(run, "summary", rows, self.gates.get("summary", ()), f"derived_{label}"))
        lines = [audit.refresh_entry(spark, f"{t}.{self.entity.name}", self._written(spark, run, t).count(), ts) for t in ("gold", "summary")]
        self.commits.log(run, "refresh_log", lines[0].unionByName(lines[1]), "refreshed_at")

    # --- quarantine ---------------------------------------------------------------------------------------------

    def open_quarantine(self, spark: SparkSession) -> DataFrame:
        """Silver's quarantined rows, the last of each key, that are still what Bronze has of the key and have not been resolved."""
        e, bronze = self.entity, self.watermark(spark, "silver")
        held = quarantine_dedup(self.log(spark, "quarantine"), e.keys)
        now = history.current(spark, self.path("bronze"), bronze)[0]
        same = [*e.keys, scd2.HASH, scd2.FROM]
        marks = now.select(*[F.col(c).alias(f"_now_{c}") for c in same])
        rows = held.join(marks, [held[c].eqNullSafe(marks[f"_now_{c}"]) for c in same], "left_semi")
        done = self.log(spark, "resolved")
        if done is None:
            return rows
        done = done.select(*[F.col(c).alias(f"_done_{c}") for c in same])
        return rows.join(done, [rows[c].eqNullSafe(done[f"_done_{c}"]) for c in same], "left_anti")

    def run_replay(self, spark: SparkSession, ts: str, rules: Sequence[Rule]) -> int | None:
        """Open quarantined rows through the rules as they are now; what passes is merged into Silver and marked resolved.

        Rows that fail again stay open. The merge is a version of Silver like any other, so Gold reads it once; a row that
        Bronze has replaced or closed since is never replayed. None if nothing passes.
        """
        e, last = self.entity, self.commits.last(spark, "silver")
        if last is None:
            return None
        rows = self.open_quarantine(spark)
        own = [c for c in rows.columns if not c.startswith("_dq_") and c != "_errors"]
        result = quality_gate(rows.select(*own), scoped(rules, scd2.CURRENT))
        good = written(result.good, "replay")
        if good.isEmpty():
            return None
        n = sum(1 for r in self.commits.all(spark) if r.layer == REPLAY)
        with self._run(spark, REPLAY, n, ts, "replay") as run:
            run.notes["table"], run.notes["rows"] = "silver", str(good.count())
            self._merge_silver(spark, run, conform.silver_rows(good, [*e.business, scd2.CURRENT], ts))
            self.commits.log(run, "resolved", good.select(*e.keys, scd2.HASH, scd2.FROM, F.lit(ts).cast("timestamp").alias("resolved_at")))
        return run.versions["silver"]

    # --- schemas ------------------------------------------------------------------------------------------------

    def _held_schema(self, spark: SparkSession, layer: str) -> str | None:
        held = [r.notes[f"schema_{layer}"] for r in self.commits.all(spark) if f"schema_{layer}" in r.notes]
        return held[-1] if held else None

    def _drift(self, spark: SparkSession, run: Run, layer: str, rows: DataFrame) -> None:
        """Before a write: how its columns differ from what the layer's last run had. A lost or retyped column halts the run, each
        time, until ``accept_schema``; the difference is told at once either way."""
        table, held, now = f"{layer}.{self.entity.name}", self._held_schema(spark, layer), control.schema_snapshot(rows)
        run.notes[f"schema_{layer}"] = now
        if held is None or held == now:
            return
        drift, halt = control.schema_contract(control.snapshot_rows(spark, table, held), control.schema_rows(spark, {table: rows}))
        drift = drift.withColumn("event_timestamp", F.lit(run.ts).cast("timestamp"))
        if halt:
            self.commits.failed("schema_log", drift)
            raise ValueError(f"columns were lost or retyped: {'; '.join(halt)}")
        self.commits.log(run, "schema_log", drift, "event_timestamp")

    def accept_schema(self, spark: SparkSession, layer: str, schema: str, ts: str) -> None:
        """Columns (JSON of names and types) that a layer's next write is measured by."""
        n = sum(1 for r in self.commits.all(spark) if r.layer == "schema")
        self.commits.mark(spark, Run(f"schema-{n}", "schema", n, ts, notes={f"schema_{layer}": schema}))

    def run(self, spark: SparkSession, to_version: int, ts: str, rules: Sequence[Rule] = ()) -> dict[str, int | None]:
        """All layers once."""
        return {"bronze": self.run_bronze(spark, to_version, ts), "silver": self.run_silver(spark, ts, rules), "gold": self.run_gold(spark, ts)}
