"""Scenarios of the layered jobs on a few rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltwork.functions import checks
from siltwork.operators import changes, compare, conform, control, dataset_checks, deltas, gate, merge, scd2
from siltwork.plans.layers import ORDERS, Layers
from siltwork.plans.queries import ORDER_RULES
from siltwork.sources import buckets, commits, history, tables
from siltwork.sources.scratch import written
from siltwork.streaming.incremental import incremental_apply
from siltwork.streaming.layered import stream_layers

KEYS, COLUMNS = list(ORDERS.keys), list(ORDERS.business)
ROW = "order_id string, customer_name string, status string, amount double"
T = [f"2024-0{m}-01 00:00:00" for m in range(1, 8)]


def rows(spark, *values):
    return spark.createDataFrame(values, ROW)


def feed(spark, *values):
    return spark.createDataFrame(values, ROW + ", _change_type string, _commit_version long")


@pytest.fixture
def three(spark):
    return rows(spark, ("ORD-001", "Alice Johnson", "pending", 150.0), ("ORD-002", "Bob Smith", "completed", 75.5), ("ORD-003", "Carol White", "pending", 200.0))


def test_life_of_orders(spark, three):
    h = scd2.bootstrap(three, COLUMNS, T[0])
    assert h.count() == 3 and scd2.current_rows(h).count() == 3
    h = scd2.apply(h, feed(spark, ("ORD-002", "Bob Smith", "refunded", 75.5, "update_postimage", 1)), KEYS, COLUMNS, T[1])
    two = h.where("order_id = 'ORD-002'").orderBy(scd2.FROM).collect()
    assert [r[scd2.CURRENT] for r in two] == [False, True] and two[0][scd2.TO] == two[1][scd2.FROM]
    h = scd2.apply(h, feed(spark, ("ORD-003", "Carol White", "pending", 200.0, "delete", 2)), KEYS, COLUMNS, T[2])
    assert [r[scd2.CURRENT] for r in h.where("order_id = 'ORD-003'").collect()] == [False]
    assert h.count() == 4 and scd2.current_rows(h).count() == 2
    silver = conform.silver_bootstrap(h, COLUMNS, T[3])
    assert {(r.order_id, r.status) for r in silver.collect()} == {("ORD-001", "pending"), ("ORD-002", "refunded")}


def test_edges_of_a_feed(spark, three):
    h = scd2.bootstrap(three, COLUMNS, T[0])
    batch = feed(
        spark,
        ("ORD-001", "Alice Johnson", "pending", 150.0, "update_postimage", 1),  # changes nothing
        ("ORD-009", "Nobody", "pending", 1.0, "delete", 1),  # an unknown key
        ("ORD-002", "Bob Smith", "completed", 75.5, "delete", 1),  # goes and comes back
        ("ORD-002", "Bob Smith", "completed", 80.0, "insert", 2),
        ("ORD-003", "Carol White", "x", 1.0, "update_postimage", 3),  # two in one version: the delete counts
        ("ORD-003", "Carol White", "pending", 200.0, "delete", 3),
    )
    actions = {r.order_id: r._action for r in scd2.classify(batch, h, KEYS, COLUMNS).collect()}
    assert actions == {"ORD-001": "UNCHANGED", "ORD-009": "DELETED", "ORD-002": "CHANGED", "ORD-003": "DELETED"}
    once = scd2.apply(h, batch, KEYS, COLUMNS, T[1])
    assert {r.order_id for r in scd2.current_rows(once).collect()} == {"ORD-001", "ORD-002"}
    again = scd2.apply(once, batch, KEYS, COLUMNS, T[2])
    assert sorted(again.collect()) == sorted(once.collect())


def test_hash_tells_null_from_empty(spark):
    df = rows(spark, ("a", None, "s", 1.0), ("a", "", "s", 1.0), ("a", "b|c", "s", 1.0))
    hashes = [r[0] for r in scd2.bootstrap(df, COLUMNS, T[0]).select(scd2.HASH).collect()]
    assert len(set(hashes)) == 3
    with pytest.raises(ValueError):
        scd2.row_hash(["a"], exclude=["a"])


def test_null_keys_are_closed_null_safely(spark):
    h = scd2.bootstrap(rows(spark, (None, "x", "s", 1.0)), COLUMNS, T[0])
    closed = scd2.close(h, spark.createDataFrame([(None,)], "order_id string"), KEYS, T[1])
    assert [r[scd2.CURRENT] for r in closed.collect()] == [False]


def test_merge_equals_recompute(spark, three):
    source = feed(spark, ("ORD-001", "A", "refunded", 1.0, "update_postimage", 1), ("ORD-002", "B", "x", 1.0, "delete", 1), ("ORD-004", "D", "pending", 4.0, "insert", 1), ("ORD-005", "E", "x", 1.0, "delete", 1))
    out = merge.apply_changes(three, source, KEYS, "_change_type = 'delete'")
    assert {(r.order_id, r.amount) for r in out.collect()} == {("ORD-001", 1.0), ("ORD-003", 200.0), ("ORD-004", 4.0)}
    counts = {r.action: r["rows"] for r in merge.merge_metrics(three, source, KEYS, "_change_type = 'delete'").collect()}
    assert counts == {"INSERT": 1, "UPDATE": 1, "DELETE": 1}
    with pytest.raises(ValueError):
        merge.guard_source(source.union(source), KEYS)


def test_snapshot_diff_leads_from_old_to_new(spark, three):
    new = rows(spark, ("ORD-001", "Alice Johnson", "completed", 150.0), ("ORD-003", "Carol White", "pending", 200.0), ("ORD-007", "Grace", "pending", 7.0))
    diff = changes.snapshot_diff(three, new, KEYS, 5)
    assert {(r.order_id, r._change_type) for r in diff.collect()} == {("ORD-001", "update_postimage"), ("ORD-002", "delete"), ("ORD-007", "insert")}
    assert sorted(merge.apply_changes(three, diff, KEYS, "_change_type = 'delete'").collect()) == sorted(new.collect())


def test_gate_routes_good_and_bad(spark):
    df = rows(spark, ("T-1", "Alice", "completed", 100.0), ("T-2", "", "pending", 50.0), ("T-3", "Carol", "shipped", 75.0), ("T-4", "Dan", "refunded", -5.0), (None, "Eve", "completed", 20.0))
    result = gate.quality_gate(df, ORDER_RULES)
    assert [r.order_id for r in result.good.collect()] == ["T-1"] and result.good.columns == df.columns
    why = {r.customer_name: [e["name"] for e in r._errors] for r in result.bad.collect()}
    assert why == {"": ["customer_name_not_empty"], "Carol": ["status_allowed_values"], "Dan": ["amount_positive"], "Eve": ["order_id_not_empty"]}


def test_gate_skips_what_it_can_not_run(spark, three):
    rules = [gate.Rule("gone", "is_not_null", {"column": "no_such"}), gate.Rule("scoped", "is_in_list", {"column": "status", "allowed": ["'x'"]}, filter="amount > 100")]
    result = gate.quality_gate(three, rules)
    assert result.skipped == ["gone"] and {r.order_id for r in result.bad.collect()} == {"ORD-001", "ORD-003"}
    assert gate.quality_gate(three, []).good.count() == 3
    assert gate.quality_gate(three.limit(0), ORDER_RULES).flagged.count() == 0


def test_each_column_gets_its_rule():
    rules = gate.rules_from([{"name": "there", "check": {"function": "is_not_null", "for_each_column": ["a", "b"]}}])
    assert [(r.name, r.arguments) for r in rules] == [("there_a", {"column": "a"}), ("there_b", {"column": "b"})]


def test_contract(spark, three):
    with pytest.raises(ValueError, match="missing \\['x'\\].*extra \\['status'\\]"):
        conform.enforce_columns(three, ["order_id", "customer_name", "amount", "x"])
    safe = conform.cast_to_contract(three.select("status"), {"status": "double"}, safe=True)
    assert [r.status for r in safe.collect()] == [None] * 3
    assert conform.project_by_sensitivity(three, {"order_id": "restricted"}) is None


def test_drift_is_named(spark, three):
    before, live = control.schema_rows(spark, {"t": three}), control.schema_rows(spark, {"t": three.drop("status").withColumn("extra", F.lit(1))})
    drift, halt = control.schema_contract(before, live)
    assert {(r.column_name, r.change_type) for r in drift.collect()} == {("status", "COLUMN_DROPPED"), ("extra", "COLUMN_ADDED")}
    assert halt == ["t.status: COLUMN_DROPPED"]


def test_watermarks(spark):
    empty = feed(spark).limit(0)
    assert control.watermark_advance(empty, "j", 3, 3, T[0]) is None
    row = control.watermark_advance(empty, "j", 3, 5, T[0])
    assert control.watermark(row, "j") == 5 and control.watermark(row, "other") is None
    with pytest.raises(ValueError):
        control.check_bootstrap(False, 4)


def test_versions_of_a_table(spark, three, tmp_path):
    at = str(tmp_path / "t")
    assert tables.versions(spark, at) == []
    tables.write_version(three, at)
    tables.write_version(three.limit(1), at)
    assert tables.versions(spark, at) == [0, 1]
    assert tables.read_snapshot(spark, at)[0].count() == 1 and tables.read_snapshot(spark, at, 0)[0].count() == 3


def test_a_half_written_version_is_neither_read_nor_in_the_way(spark, three, tmp_path):
    at = str(tmp_path / "t")
    tables.write_version(three, at)
    (tmp_path / "t" / "v=1").mkdir()
    (tmp_path / "t" / "v=1" / "part-0.parquet").write_bytes(b"cut off")
    assert tables.versions(spark, at) == [0] and tables.read_snapshot(spark, at)[0].count() == 3
    assert tables.write_version(three, at) == 2
    assert tables.write_version(three.limit(2), at, 1) == 1 and tables.read_snapshot(spark, at, 1)[0].count() == 2
    with pytest.raises(ValueError, match="finished"):
        tables.write_version(three, at, 0)


def test_history_keeps_what_is_closed(spark, three, tmp_path):
    at = str(tmp_path / "h")
    history.create(scd2.bootstrap(three, COLUMNS, T[0]), at)
    for n, status in enumerate(("refunded", "pending"), 1):
        now, _ = history.current(spark, at)
        history.append(scd2.run(now, feed(spark, ("ORD-002", "Bob Smith", status, 75.5, "update_postimage", n)), KEYS, COLUMNS, T[n]), at)
    assert history.read(spark, at).count() == 5 and history.read(spark, at, 1).count() == 4 and history.current(spark, at)[0].count() == 3
    moved = history.changes(spark, at, 1, 2).collect()
    assert sorted((r.status, r[scd2.CURRENT]) for r in moved) == [("pending", True), ("refunded", False)]


def test_a_null_key_has_one_open_version(spark):
    h = scd2.bootstrap(rows(spark, (None, "x", "s", 1.0)), COLUMNS, T[0])
    change = feed(spark, (None, "x", "s", 2.0, "update_postimage", 1))
    once = scd2.apply(h, change, KEYS, COLUMNS, T[1])
    again = scd2.apply(once, change, KEYS, COLUMNS, T[2])
    assert [r.amount for r in scd2.current_rows(again).collect()] == [2.0] and again.count() == 2


@pytest.fixture
def job(spark, three, tmp_path):
    out = Layers(str(tmp_path / "job"))
    changes_ = feed(spark, ("ORD-002", "Bob Smith", "refunded", 75.5, "update_postimage", 1), ("ORD-003", "Carol White", "pending", 200.0, "delete", 1), ("ORD-004", "", "pending", 4.0, "insert", 1), ("ORD-001", "Alice Johnson", "lost", 150.0, "update_postimage", 2))
    tables.write_changes(changes_, out.path("staging"))
    out.bootstrap(spark, three, 0, T[0])
    return out


def logged(spark, job, name):
    return job.log(spark, name)


def test_a_run_through_the_layers(spark, job):
    job.run(spark, 1, T[1], ORDER_RULES)
    for layer in ("silver", "gold"):
        now = job.table(spark, layer)
        assert {(r.order_id, r.status) for r in now.collect()} == {("ORD-001", "pending"), ("ORD-002", "refunded")}
    held = logged(spark, job, "quarantine").collect()
    assert [(r.order_id, [e["name"] for e in r._errors]) for r in held] == [("ORD-004", ["customer_name_not_empty"])]
    log = logged(spark, job, "gate_log").where("layer = 'silver' AND label = 'incremental'").first()
    assert (log.status, log.rows_checked, log.rows_quarantined, log.failed_rules) == ("quarantined", 3, 1, {"customer_name_not_empty": 1})
    entries = {(r.table_name, r.action): r.row_count for r in logged(spark, job, "audit_log").where("status = 'success'").collect()}
    assert entries[("silver.orders", "merge_update")] == 1 and entries[("silver.orders", "merge_delete")] == 1 and entries[("silver.orders", "merge_insert")] == 0
    assert {r.status: r.order_count for r in job.table(spark, "summary").collect()} == {"pending": 1, "refunded": 1}
    assert job.run(spark, 1, T[2], ORDER_RULES) == {"bronze": None, "silver": None, "gold": None}


def test_no_failing_row_is_lost(spark, job):
    """What a run reads is in the target or in quarantine, and what the target had of a failing key stays."""
    job.run(spark, 2, T[1], ORDER_RULES)
    silver = {r.order_id: r.status for r in job.table(spark, "silver").collect()}
    held = {r.order_id: r.status for r in logged(spark, job, "quarantine").collect()}
    assert silver == {"ORD-001": "pending", "ORD-002": "refunded"} and held == {"ORD-001": "lost", "ORD-004": "pending"}


def everything(spark, job):
    """All that readers see of a job, without times and ids of runs."""
    out = {n: sorted(map(str, job.table(spark, n).drop("_silver_processed_at", "_gold_refreshed_at").collect())) for n in ("silver", "gold", "summary")}
    out["history"] = sorted((r.order_id, r.status, r[scd2.CURRENT]) for r in job.history(spark).collect())
    for name in ("quarantine", "quarantine_gold"):
        out[name] = sorted((r.order_id, r._dq_label) for r in job.log(spark, name).collect())
    out["gate_log"] = sorted((r.layer, r.label, r.rows_checked, r.rows_quarantined) for r in job.log(spark, "gate_log").collect())
    out["audit_log"] = sorted((r.table_name, r.action, r.row_count) for r in job.log(spark, "audit_log").where("status = 'success'").collect())
    out["refresh_log"] = sorted((r.object_fqn, r.row_count) for r in job.log(spark, "refresh_log").collect())
    return out


class Killed(OSError):
    pass


def test_a_run_that_is_killed_at_any_write_goes_on_and_leaves_each_row_once(spark, three, tmp_path, monkeypatch):
    """The n-th write of the whole job is cut short, or is the last that is done, for every n; the job is then run again."""
    changes_ = feed(spark, ("ORD-002", "Bob Smith", "refunded", 75.5, "update_postimage", 1), ("ORD-003", "Carol White", "pending", 200.0, "delete", 1), ("ORD-004", "", "pending", 4.0, "insert", 1), ("ORD-005", "Eve", "completed", 900.0, "insert", 1))
    gates = {"gold": [gate.Rule("cap", "sql_expression", {"expression": "amount < 500", "columns": ["amount"]})]}
    write, log, mark = tables.write_version, commits.Commits.log, commits.Commits.mark
    left = {"n": -1}

    def counted(whole):
        def out(*args, **options):
            left["n"] -= 1
            if left["n"] == 0:
                whole(*args, **options)  # written, and then nothing more
                raise Killed("the driver is gone")
            return whole(*args, **options)

        return out

    def job_at(name):
        out = Layers(str(tmp_path / name), gates=gates)
        tables.write_changes(changes_, out.path("staging"))
        return out

    def whole_job(job, ts):
        job.bootstrap(spark, three, 0, T[0], ORDER_RULES)
        job.run(spark, 1, ts, ORDER_RULES)

    want = None
    monkeypatch.setattr(tables, "write_version", counted(write))
    monkeypatch.setattr(commits.Commits, "log", counted(log))
    monkeypatch.setattr(commits.Commits, "mark", counted(mark))
    whole_job(good := job_at("good"), T[1])
    writes, want = -1 - left["n"], everything(spark, good)
    assert want["quarantine"] == [("ORD-004", "incremental")] and want["quarantine_gold"] == [("ORD-005", "incremental")] and writes > 20
    for n in (2, 9, 14, 19, writes):
        job = job_at(f"killed-{n}")
        left["n"] = n
        with pytest.raises(Killed):
            whole_job(job, T[1])
        left["n"] = -1
        whole_job(job, T[1])
        assert everything(spark, job) == want
        failures = [r.error_type for r in job.log(spark, "audit_log").where("status = 'failure'").collect()]
        assert failures in ([], ["Killed"])  # none if the marker itself had been written


@pytest.mark.parametrize("layer", ["bronze", "silver", "gold", "summary"])
def test_a_half_written_table_is_written_anew_and_the_failure_is_told(spark, job, layer, monkeypatch):
    whole = tables.write_version

    def killed(df, path, version=None, **options):
        if path == job.path(layer):
            df.limit(1).drop(scd2.KIND).write.mode("overwrite").parquet(f"{path}/v={version}/_temporary/0")
            raise OSError("the executor is gone")
        return whole(df, path, version, **options)

    monkeypatch.setattr(tables, "write_version", killed)
    with pytest.raises(OSError):
        job.run(spark, 1, T[1], ORDER_RULES)
    failed = logged(spark, job, "audit_log").where("status = 'failure'").collect()
    assert [(r.table_name, r.error_type) for r in failed] == [(f"{'gold' if layer == 'summary' else layer}.orders", "OSError")]
    assert not {"merge_insert", "merge_update"} & {r.action for r in logged(spark, job, "audit_log").where(f"table_name = '{layer}.orders'").collect()}
    monkeypatch.setattr(tables, "write_version", whole)
    job.run(spark, 1, T[2], ORDER_RULES)
    assert {(r.order_id, r.status) for r in job.table(spark, "gold").collect()} == {("ORD-001", "pending"), ("ORD-002", "refunded")}
    assert logged(spark, job, "quarantine").count() == 1 and job.history(spark).count() == 5


def test_a_lost_column_stops_every_run_until_it_is_accepted(spark, job):
    job.run(spark, 1, T[1], ORDER_RULES)
    now = control.schema_snapshot(job.table(spark, "silver"))
    job.accept_schema(spark, "silver", '{"order_id": "string", "gone": "string"}', T[1])
    for _ in range(2):
        with pytest.raises(ValueError, match="gone"):
            job.run(spark, 2, T[2], ORDER_RULES)
    assert "gone" in {r.column_name for r in logged(spark, job, "schema_log").collect()}
    assert job.watermark(spark, "silver") == 1
    job.accept_schema(spark, "silver", now, T[3])
    assert job.run(spark, 2, T[4], ORDER_RULES)["silver"] is not None


def test_gates_hold_on_the_first_load_and_before_gold_and_the_derived_table(spark, three, tmp_path):
    gates = {"gold": [gate.Rule("cap", "sql_expression", {"expression": "total_tax_amount < 200", "columns": ["amount"]}, user_metadata={"team": "tax"})], "summary": [gate.Rule("few", "sql_expression", {"expression": "order_count > 1", "columns": ["order_count"]})]}
    out = Layers(str(tmp_path / "job"), gates=gates)
    out.bootstrap(spark, three.union(rows(spark, ("ORD-009", "", "pending", 1.0), ("ORD-010", "Dan", "completed", 7.0))), 0, T[0], ORDER_RULES)
    assert {r.order_id for r in out.table(spark, "silver").collect()} == {"ORD-001", "ORD-002", "ORD-003", "ORD-010"}
    assert [(r.order_id, r._dq_label) for r in out.log(spark, "quarantine").collect()] == [("ORD-009", "bootstrap")]
    assert {r.order_id for r in out.table(spark, "gold").collect()} == {"ORD-001", "ORD-002", "ORD-010"}
    held = out.log(spark, "quarantine_gold").collect()
    assert [(r.order_id, r._errors[0]["user_metadata"]) for r in held] == [("ORD-003", {"team": "tax"})]
    assert [r.status for r in out.table(spark, "summary").collect()] == ["completed"]
    assert [(r.status, r._dq_label) for r in out.log(spark, "quarantine_summary").collect()] == [("pending", "derived_bootstrap")]
    assert {(r.layer, r.label, r.status) for r in out.log(spark, "gate_log").collect()} == {("silver", "bootstrap", "quarantined"), ("gold", "bootstrap", "quarantined"), ("summary", "derived_bootstrap", "quarantined")}
    assert {(r.object_fqn, r.row_count) for r in out.log(spark, "refresh_log").collect()} == {("gold.orders", 3), ("summary.orders", 1)}
    assert {(r.table_name, r.row_count) for r in out.log(spark, "audit_log").collect()} == {("bronze.orders", 5), ("silver.orders", 4), ("gold.orders", 3)}


def test_quarantine_is_replayed_once_and_never_over_what_came_later(spark, job):
    job.run(spark, 1, T[1], ORDER_RULES)  # ORD-004 has no name and is held
    relaxed = [r for r in ORDER_RULES if r.name != "customer_name_not_empty"]
    assert job.run_replay(spark, T[2], ORDER_RULES) is None and job.open_quarantine(spark).count() == 1
    assert job.run_replay(spark, T[2], relaxed) is not None
    job.run_gold(spark, T[2])
    assert {r.order_id for r in job.table(spark, "gold").collect()} == {"ORD-001", "ORD-002", "ORD-004"}
    assert job.run_replay(spark, T[3], relaxed) is None and job.run_gold(spark, T[3]) is None and job.open_quarantine(spark).count() == 0
    # The next run holds ORD-001 ("lost"); before it is replayed, the source mends it.
    tables.write_changes(feed(spark, ("ORD-001", "Alice Johnson", "completed", 150.0, "update_postimage", 3)), job.path("staging"))
    job.run(spark, 2, T[4], ORDER_RULES)
    assert {r.order_id for r in job.open_quarantine(spark).collect()} == {"ORD-001"}
    job.run(spark, 3, T[5], ORDER_RULES)
    assert job.open_quarantine(spark).count() == 0 and job.run_replay(spark, T[6], []) is None
    assert {r.order_id: r.status for r in job.table(spark, "silver").collect()}["ORD-001"] == "completed"


def test_signed_changes_keep_aggregates_up(spark):
    kind = "g string, k string, x long"
    measures = deltas.Measures({"total": F.col("x")}, {"most": F.col("x")})
    rng, now = np.random.default_rng(7), {}
    frame = lambda values: spark.createDataFrame([(g, k, x) for k, (g, x) in values.items()], kind)
    state = deltas.state_of(frame(now), ["g"], measures)
    for _ in range(4):
        after = dict(now)
        for k in rng.integers(0, 40, 15).tolist():
            after.pop(str(k), None)
        for k in rng.integers(0, 40, 12).tolist():
            after[str(k)] = (rng.choice(["a", "b", "c", None]), int(rng.integers(-5, 6)))
        moved = {k for k in now.keys() | after.keys() if now.get(k) != after.get(k)}
        changes_ = deltas.signed(frame({k: v for k, v in now.items() if k in moved}), frame({k: v for k, v in after.items() if k in moved}))
        touched = deltas.folded(state, changes_, ["g"], measures, frame(after))
        state = written(deltas.replaced(state, touched, ["g"]), "state")
        assert sorted(map(str, state.collect())) == sorted(map(str, deltas.state_of(frame(after), ["g"], measures).select(*state.columns).collect()))
        now = after


def test_late_changes_are_not_applied_by_the_stream(spark, three, tmp_path):
    path, source, mark = (str(tmp_path / n) for n in ("history", "source", "mark"))
    history.create(scd2.bootstrap(three, COLUMNS, T[0]), path)
    first = feed(spark, ("ORD-001", "Alice Johnson", "completed", 150.0, "update_postimage", 5))
    first.write.parquet(source)
    run = lambda ts: incremental_apply(spark, source, first.schema, path, mark, ORDERS, ts)
    run(T[1])
    late = feed(spark, ("ORD-001", "Alice Johnson", "lost", 150.0, "update_postimage", 4), ("ORD-002", "Bob Smith", "refunded", 75.5, "update_postimage", 6))
    late.write.mode("append").parquet(source)
    out = run(T[2])
    assert {(r.order_id, r.status) for r in scd2.current_rows(out).collect()} == {("ORD-001", "completed"), ("ORD-002", "refunded"), ("ORD-003", "pending")}


def test_a_stream_goes_on_after_a_half_written_version(spark, three, tmp_path):
    path, source, mark = (str(tmp_path / n) for n in ("history", "source", "mark"))
    history.create(scd2.bootstrap(three, COLUMNS, T[0]), path)
    (tmp_path / "history" / "v=1" / "_kind=kept").mkdir(parents=True)
    one = feed(spark, ("ORD-001", "Alice Johnson", "completed", 150.0, "update_postimage", 5))
    one.write.parquet(source)
    out = incremental_apply(spark, source, one.schema, path, mark, ORDERS, T[1])
    assert {r.status for r in scd2.current_rows(out).where("order_id = 'ORD-001'").collect()} == {"completed"} and out.count() == 4


@pytest.mark.parametrize("n", [1, 2, 7, 5001])
def test_exact_medians(spark, n):
    rng = np.random.default_rng(n)
    inf = float("inf")
    for values in (rng.normal(size=n), np.round(rng.normal(size=n)), np.full(n, 3.0), np.repeat([1.0, 9.0], n), np.repeat([-inf, inf], [n, n + 1])):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "x double")
        assert dataset_checks.exact_median(df, "x") == np.median(values)
    assert dataset_checks.exact_median(df.limit(0), "x") is None
    assert np.isnan(dataset_checks.exact_median(spark.createDataFrame([(-inf,)] * n + [(inf,)] * n, "x double"), "x"))


def test_medians_of_groups_without_a_task_that_sees_a_group(spark):
    rng = np.random.default_rng(3)
    values = {"hot": rng.normal(size=4000), "few": np.array([1.0, 4.0]), None: np.array([7.0]), "same": np.full(900, 2.0), "none": np.array([np.nan])}
    df = spark.createDataFrame([(g, float(v)) for g, vs in values.items() for v in vs] + [("few", None)], "g string, x double").repartition(6)
    got = {r.g: r._value for r in dataset_checks.medians(df, ["g"], "x").collect()}
    assert got == {g: None if g == "none" else np.median(v) for g, v in values.items()}
    # Values are dealt by range over group and value: the hot group's lie in several partitions.
    marked = dataset_checks.is_aggr_not_greater_than(df, "bad", "x", 1.5, "median", ["g"])
    assert {r.g for r in marked.where("bad").collect()} == {"few", None, "same"}
    plan = dataset_checks.is_aggr_not_greater_than(df, "bad", "x", 1.5, "median")._jdf.queryExecution().optimizedPlan().toString()
    assert "median(" not in plan and "percentile" not in plan


def test_outliers_of_infinite_values_end(spark):
    inf = float("inf")
    df = spark.createDataFrame([(-inf,)] * 50 + [(inf,)] * 50 + [(1.0,)], "x double")
    assert dataset_checks.has_no_outliers(df, "bad", "x").where("bad").count() == 0


@pytest.mark.parametrize(
    ("doc", "paths"),
    [
        ('{"a": {"b": 1}, "c": [{"d": 1}]}', []),
        ('{"a": {"b": "x"}}', ["$.c (missing)", "$.a.b"]),
        ('{"a": {}, "c": []}', ["$.a.b (missing)"]),
        ('{"a": 5, "c": [{"d": "x"}, {"d": null}]}', ["$.a", "$.c[*].d (missing)", "$.c[*].d"]),
        ('{"c": {"d": 1}}', ["$.c"]),
        ('{"c": [], "m": {"x": [1, 2], "y": ["z"]}}', ["$.m[*][*]"]),
        ("[1]", ["$"]),
        ("{", ["$"]),
        (None, []),
    ],
)
def test_json_schemas_at_any_depth(spark, doc, paths):
    schema = "a STRUCT<b: INT NOT NULL>, c ARRAY<STRUCT<d: DOUBLE NOT NULL>> NOT NULL, m MAP<STRING, ARRAY<INT>>"
    df = spark.createDataFrame([(doc,)], "doc string")
    assert sorted(df.select(checks.json_misfits("doc", schema)).first()[0]) == sorted(paths)
    assert df.select(checks.fails("has_valid_json_schema", {"column": "doc", "schema": schema})).first()[0] == bool(paths)


def test_code_tables(spark):
    codes = spark.createDataFrame([("DE-BY", "DE", "276"), ("FR-75", "FR", "250")], "code string, country string, number string")
    df = spark.createDataFrame([("DE-BY", "DE"), ("DE-ZZZ", "DE"), ("FR-75", "DE"), ("de-by", "de"), (None, "DE"), ("DE-BY", None)], "sub string, country string")
    bad = lambda **more: [r.bad for r in dataset_checks.is_valid_code(df, "bad", "sub", codes, "code", "country", "country", **more).collect()]
    assert bad() == [False, True, True, True, False, False]
    assert bad(case_sensitive=False) == [False, True, True, False, False, False]


def test_windows_with_gaps(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:10:00' + make_interval(0, 0, 0, 0, h) AS ts FROM VALUES (0), (0), (1), (4) t(h)")
    gaps = dataset_checks.has_no_gaps_per_time_window(df, "ts", 60, trailing_gap_until="2024-01-01 07:00:00").orderBy("gap_after").collect()
    assert [r.empty_windows for r in gaps] == [2, 2]
    thin = dataset_checks.is_data_fresh_per_time_window(df, "ts", 60, 1, lookback_windows=3, curr_timestamp="2024-01-01 05:30:00").orderBy("window_start").collect()
    assert [(str(r.window_start), r.n) for r in thin] == [("2024-01-01 03:00:00", 0), ("2024-01-01 05:00:00", 0)]


def test_outliers_without_spread(spark):
    same = spark.range(5).withColumn("x", F.lit(1.0))
    assert not any(r.bad for r in dataset_checks.has_no_outliers(same, "bad", "x").collect())
    assert dataset_checks.has_no_outliers(same.limit(0), "bad", "x").count() == 0


def size_of(folder):
    return sum(f.stat().st_size for f in folder.rglob("*.parquet"))


def test_merges_write_only_the_buckets_that_changes_reach(spark, tmp_path):
    """Bronze, Silver and Gold of many keys in many buckets: a run of two changed keys writes two buckets and refers to the rest."""
    many = spark.range(4000).selectExpr("concat('K-', id) AS order_id", "concat('name ', id) AS customer_name", "'pending' AS status", "CAST(id + 1 AS DOUBLE) AS amount")
    job = Layers(str(tmp_path / "job"), per_bucket=100)
    tables.write_changes(feed(spark, ("K-7", "name 7", "completed", 8.0, "update_postimage", 1), ("K-8", "name 8", "pending", 9.0, "delete", 1)), job.path("staging"))
    job.bootstrap(spark, many, 0, T[0])
    job.run(spark, 1, T[1])
    for name in ("bronze", "silver", "gold"):
        first, then = (tmp_path / "job" / name / f"v={n}" for n in (0, 1))
        assert len(list(first.glob("_bucket=*"))) == 40 and len(list(then.glob("_bucket=*"))) <= 2
        assert size_of(then) < size_of(first) / 5
    for name in ("silver", "gold"):
        now = {r.order_id: r.status for r in job.table(spark, name).collect()}
        assert len(now) == 3999 and now["K-7"] == "completed" and "K-8" not in now and now["K-3999"] == "pending"
    assert job.history(spark).count() == 4001 and scd2.current_rows(job.history(spark)).count() == 3999
    assert {r.status: r.order_count for r in job.table(spark, "summary").collect()} == {"pending": 3998, "completed": 1}


def test_buckets_empty_grow_and_keep_null_keys(spark, three, tmp_path):
    at = str(tmp_path / "t")
    gone = F.col("_change_type") == "delete"

    def merged(batch, n):
        into = buckets.reach(spark, at, batch, n)
        return buckets.replace(into, merge.apply_changes(into.rows, batch, KEYS, gone), at)

    assert buckets.create(three.unionByName(rows(spark, (None, "nobody", "pending", 1.0))), at, KEYS, per_bucket=1) == 0
    n = merged(feed(spark, (None, "somebody", "pending", 2.0, "update_postimage", 1), ("ORD-001", "Alice Johnson", "pending", 150.0, "delete", 1)), 0)
    assert {(r.order_id, r.customer_name) for r in buckets.read(spark, at, n).collect()} == {("ORD-002", "Bob Smith"), ("ORD-003", "Carol White"), (None, "somebody")}
    assert buckets.read(spark, at, 0).count() == 4  # older versions stay as they were
    # No change reaches nothing, and a crash before the layout leaves no version.
    n = merged(feed(spark).limit(0), n)
    assert buckets.read(spark, at).count() == 3 and not list((tmp_path / "t" / f"v={n}").glob("_bucket=*"))
    tables.write_version(three, at, n + 1)
    assert buckets.versions(spark, at) == [0, 1, 2] and buckets.read(spark, at).count() == 3
    # All rows go, the table is empty and comes back.
    n = merged(feed(spark, *[(k, "x", "s", 0.0, "delete", 2) for k in ("ORD-002", "ORD-003", None)]), n)
    assert n == 4 and buckets.read(spark, at).count() == 0 and buckets.read(spark, at).columns == three.columns
    n = merged(feed(spark, *[(f"N-{i}", "x", "s", float(i), "insert", 3) for i in range(60)]), n)
    assert buckets.layout(spark, at, n).n == 4 and buckets.layout(spark, at, n).outgrown
    n = merged(feed(spark, ("N-0", "y", "s", 0.0, "update_postimage", 4)), n)
    assert buckets.layout(spark, at, n).n == 60 and {(r.order_id, r.customer_name) for r in buckets.read(spark, at).collect()} == {("N-0", "y"), *[(f"N-{i}", "x") for i in range(1, 60)]}


def test_digests_lead_to_the_rows_that_differ(spark, tmp_path):
    many = spark.range(20000).selectExpr("concat('K-', id) AS order_id", "CASE WHEN id % 5 = 0 THEN NULL ELSE concat('n', id) END AS customer_name", "CASE WHEN id % 5 = 1 THEN NULL ELSE 'pending' END AS status", "CAST(id AS DOUBLE) AS amount")
    many = written(many.unionByName(rows(spark, (None, "nobody", "s", 1.0), ("Z", None, "moved", 0.0))), "left")
    other = many.withColumn("amount", F.when(F.col("order_id") == "K-77", F.lit(0.5)).otherwise(F.col("amount"))).where("order_id IS NULL OR order_id <> 'K-88'")
    # NULL and a value that change places are told, and so is the row without a key.
    other = other.withColumns({"customer_name": F.when(F.col("order_id") == "Z", F.col("status")).otherwise(F.col("customer_name")), "status": F.when(F.col("order_id") == "Z", F.lit(None)).otherwise(F.col("status"))})
    other = written(other.withColumn("amount", F.when(F.col("order_id").isNull(), 2.0).otherwise(F.col("amount"))).unionByName(rows(spark, ("new", "x", "s", 1.0))).repartition(3), "right")
    want = compare.compare_datasets(many, other, KEYS).collect()
    assert len(want) == 5
    assert sorted(map(str, compare.compare_by_digest(many, other, KEYS).collect())) == sorted(map(str, want))
    a, b = compare.differing(many, other, KEYS)
    assert a.count() <= 12 and b.count() <= 12 and a.columns == many.columns
    a, b = compare.differing(many, many.repartition(5), KEYS)
    assert a.count() == b.count() == 0
    assert compare.compare_by_digest(many, other, KEYS, exclude_columns=["amount", "customer_name", "status"]).count() == 2
    assert compare.compare_by_digest(many, many.limit(0), KEYS, ranges=4).count() == 20002
    tolerant = compare.compare_by_digest(many, many.withColumn("amount", F.col("amount") + 0.001), KEYS, ranges=4, abs_tolerance=0.01)
    assert tolerant.count() == 0


def test_a_stream_through_the_layers_equals_the_batch_job(spark, three, tmp_path, monkeypatch):
    """Two batches, the second with a late change and killed before Gold: tables, quarantines and logs are the batch job's, the late row is told once."""
    gates = {"gold": [gate.Rule("cap", "sql_expression", {"expression": "amount < 500", "columns": ["amount"]})]}
    first = feed(spark, ("ORD-002", "Bob Smith", "refunded", 75.5, "update_postimage", 1), ("ORD-004", "", "pending", 4.0, "insert", 2))
    second = feed(spark, ("ORD-003", "Carol White", "pending", 200.0, "delete", 3), ("ORD-005", "Eve", "completed", 900.0, "insert", 3))
    late = feed(spark, ("ORD-001", "Alice Johnson", "lost", 150.0, "update_postimage", 2))
    batch, streamed = (Layers(str(tmp_path / n), gates=gates) for n in ("batch", "streamed"))
    tables.write_changes(first.unionByName(second), batch.path("staging"))
    for job in (batch, streamed):
        job.bootstrap(spark, three, 0, T[0], ORDER_RULES)
    batch.run(spark, 2, T[1], ORDER_RULES)
    batch.run(spark, 3, T[2], ORDER_RULES)
    source, mark = str(tmp_path / "source"), str(tmp_path / "mark")
    go = lambda ts: stream_layers(spark, source, first.schema, streamed, mark, ts, ORDER_RULES)
    first.coalesce(1).write.parquet(source)
    go(T[1])
    second.unionByName(late).coalesce(1).write.mode("append").parquet(source)
    with monkeypatch.context() as m:
        m.setattr(Layers, "run_gold", lambda *_: (_ for _ in ()).throw(Killed("the driver is gone")))
        with pytest.raises(Exception, match="the driver is gone"):
            go(T[2])
    go(T[2])
    assert everything(spark, streamed) == everything(spark, batch)
    assert [(r.order_id, r._commit_version) for r in streamed.log(spark, "late_changes").collect()] == [("ORD-001", 2)]
    assert streamed.watermark(spark, "bronze") == 3
