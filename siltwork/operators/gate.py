"""The quality gate: rules split a frame into rows that pass and rows that go to quarantine with their reasons."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwork.functions.checks import CHECKS, fails
from siltwork.operators.dataset_checks import DATASET_CHECKS
from siltwork.sources.scratch import written

ERRORS = "_errors"
#: Checks that look at the whole table before they mark a row.
READ_AGAIN = ("has_no_outliers", "has_no_aggr_outliers", "sql_query")


@dataclass(frozen=True)
class Rule:
    """One check. ``filter``: only rows where it holds can fail. ``user_metadata``: labels that each of its failures carries."""

    name: str
    function: str
    arguments: Mapping[str, Any] = field(default_factory=dict)
    filter: str | None = None
    user_metadata: Mapping[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        """Columns that the rule names."""
        a = self.arguments
        named = [a[k] for k in ("column", "column1", "column2", "time_column", "country_column") if isinstance(a.get(k), str)]
        listed = [c for k in ("columns", "group_by", "merge_columns") for c in (a.get(k) or ()) if isinstance(c, str)]
        return [c for c in dict.fromkeys([*named, *listed]) if c != "*"]

    @property
    def message(self) -> str:
        return str(self.arguments.get("msg") or f"{self.function} failed for {', '.join(self.columns) or 'the table'}")


def rules_from(checks: Iterable[Mapping[str, Any]]) -> list[Rule]:
    """Rules from parsed YAML: {name, filter?, user_metadata?, check: {function, for_each_column?, arguments}}."""
    out = []
    for c in checks:
        body = c["check"]
        arguments = dict(body.get("arguments") or {})
        for column in body.get("for_each_column") or [None]:
            own = arguments if column is None else {**arguments, **({"columns": column} if isinstance(column, list) else {"column": column})}
            name = c.get("name") or f"{body['function']}_{column or own.get('column', '')}"
            out.append(Rule(name if column is None or "name" not in c else f"{name}_{column}", body["function"], own, c.get("filter"), c.get("user_metadata") or {}))
    return out


def scoped(rules: Sequence[Rule], scope_filter: str) -> list[Rule]:
    """The rules for rows in scope only; the others pass."""
    return [Rule(r.name, r.function, r.arguments, scope_filter if r.filter is None else f"({scope_filter}) AND ({r.filter})", r.user_metadata) for r in rules]


@dataclass
class GateResult:
    """flagged: all rows with ``_errors``; skipped: rules that name columns which are not there, so did not run."""

    flagged: DataFrame
    columns: list[str]
    skipped: list[str]

    @property
    def good(self) -> DataFrame:
        return self.flagged.where(F.size(ERRORS) == 0).select(*self.columns)

    @property
    def bad(self) -> DataFrame:
        return self.flagged.where(F.size(ERRORS) > 0)


def _known(df: DataFrame, rule: Rule) -> bool:
    """Whether every column that the rule names by itself is there; expressions are resolved by Spark."""
    return all(c in df.columns or not c.replace("_", "").isalnum() for c in rule.columns)


def quality_gate(df: DataFrame, rules: Sequence[Rule], *, refs: Mapping[str, DataFrame] | None = None, run_id: str | None = None, run_ts: str | None = None) -> GateResult:
    """df through all rules. Row checks are one projection without a shuffle; a dataset check adds its own join.

    refs: tables by the names that rules use as ref_table. Without rules all rows pass. Rules that ask for figures of the
    whole table read it several times, so with one of them the rows are written to the shared folder first.
    """
    columns, skipped, failed = list(df.columns), [], []
    if any(r.function in READ_AGAIN and _known(df, r) for r in rules):
        df = written(df, "gate")
    for n, r in enumerate(rules):
        if not _known(df, r):
            skipped.append(r.name)
            continue
        if r.function in CHECKS:
            bad = fails(r.function, dict(r.arguments))
        elif r.function in DATASET_CHECKS:
            into, a = f"_failed_{n}", dict(r.arguments)
            if "ref_table" in a:
                a["ref"] = (refs or {})[a.pop("ref_table")]
            df = DATASET_CHECKS[r.function](df, into, **a)
            bad = F.col(into)
        else:
            raise ValueError(f"rule {r.name}: no check is called {r.function}")
        if r.filter:
            bad = bad & F.coalesce(F.expr(r.filter), F.lit(False))
        failed.append((r, bad))
    labels = lambda r: F.create_map(*[F.lit(str(x)) for kv in r.user_metadata.items() for x in kv]).cast("map<string,string>")
    error = lambda r: F.struct(F.lit(r.name).alias("name"), F.lit(r.message).alias("message"), F.array(*[F.lit(c) for c in r.columns]).cast("array<string>").alias("columns"), F.lit(r.function).alias("function"), F.lit(run_id).cast("string").alias("run_id"), F.lit(run_ts).cast("timestamp").alias("run_time"), labels(r).alias("user_metadata"))
    items: list[Column] = [F.when(bad, error(r)) for r, bad in failed]
    kind = "array<struct<name:string,message:string,columns:array<string>,function:string,run_id:string,run_time:timestamp,user_metadata:map<string,string>>>"
    errors = F.filter(F.array(*items), lambda x: x.isNotNull()) if items else F.array()
    return GateResult(df.select(*columns, errors.cast(kind).alias(ERRORS)), columns, skipped)


def quarantined(result: GateResult, label: str, run_ts: str, job_id: str | None = None, job_run_id: str | None = None) -> DataFrame:
    """The failing rows in the form that a quarantine table keeps."""
    return result.bad.withColumns({"_dq_label": F.lit(label), "_dq_run_ts": F.lit(run_ts).cast("timestamp"), "_dq_job_id": F.lit(job_id).cast("string"), "_dq_job_run_id": F.lit(job_run_id).cast("string")})


def failed_rule_counts(bad: DataFrame) -> DataFrame:
    """(rule, n) of failing rows."""
    return bad.select(F.explode(ERRORS).alias("e")).groupBy(F.col("e.name").alias("rule")).agg(F.count("*").alias("n"))


def gate_counts(flagged: DataFrame, *by: str) -> DataFrame:
    """Rows checked, passed and quarantined, in one pass."""
    bad = F.size(ERRORS) > 0
    return flagged.groupBy(*by).agg(F.count("*").alias("rows_checked"), F.count_if(~bad).alias("rows_passed"), F.count_if(bad).alias("rows_quarantined"))


def gate_log(result: GateResult, rules: Sequence[Rule], *, layer: str, entity: str, label: str, ts: str, target: str | None = None, quarantine: str | None = None, run_id: str | None = None) -> DataFrame:
    """One row about a gate's run, also when all rows passed: counts, failed rules with their rows, status. One pass over the rows."""
    names = list(dict.fromkeys(r.name for r in rules))
    bad = F.size(ERRORS) > 0
    failed_names = F.transform(ERRORS, lambda e: e["name"])
    per = [F.count_if(F.array_contains(failed_names, n)).alias(f"_rule_{i}") for i, n in enumerate(names)]
    one = result.flagged.agg(F.count("*").alias("rows_checked"), F.count_if(~bad).alias("rows_passed"), F.count_if(bad).alias("rows_quarantined"), *per)
    counts = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.col(f"_rule_{i}"))]) if names else F.create_map().cast("map<string,bigint>")
    failed = F.map_filter(counts, lambda _, n: n > 0)
    some = F.col("rows_quarantined") > 0
    return one.select(
        F.lit(ts).cast("timestamp").alias("event_timestamp"), F.lit(layer).alias("layer"), F.lit(entity).alias("entity"), F.lit(target).cast("string").alias("target_table"), F.lit(label).alias("label"),
        F.when(some, "quarantined").otherwise("passed").alias("status"), "rows_checked", "rows_passed", "rows_quarantined", F.when(some, failed).alias("failed_rules"),
        F.when(some, F.lit(quarantine).cast("string")).alias("quarantine_table"), F.lit(run_id).cast("string").alias("run_id"),
    )


def quarantine_dedup(quarantine: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of the same bad record arriving again, the last."""
    last = F.max_by(F.struct(*[c for c in quarantine.columns if c not in keys]), "_dq_run_ts").alias("_r")
    return quarantine.groupBy(*keys).agg(last).select(*keys, "_r.*")


def quarantine_status(quarantine: DataFrame, target: DataFrame, keys: Sequence[str], at: str, rejected: DataFrame | None = None) -> DataFrame:
    """(keys, status): resolved when the target has a row of the key that is younger than the last quarantine of it, rejected when listed, else open."""
    last = quarantine.groupBy(*keys).agg(F.max("_dq_run_ts").alias("_ts"))
    now = target.select(*keys, F.col(at).alias("_at"))
    rows = last.join(now, list(keys), "left")
    if rejected is not None:
        rows = rows.join(rejected.select(*keys).distinct().withColumn("_no", F.lit(True)), list(keys), "left")
    else:
        rows = rows.withColumn("_no", F.lit(None).cast("boolean"))
    return rows.select(*keys, F.when(F.col("_at") > F.col("_ts"), "resolved").when(F.col("_no"), "rejected").otherwise("open").alias("status"))


def replay_quarantine(quarantine: DataFrame, rules: Sequence[Rule], target: DataFrame, keys: Sequence[str], at: str, **gate: Any) -> GateResult:
    """The last quarantined row of each key through the current rules, without rows that are no younger than the target's."""
    own = [c for c in quarantine.columns if c != ERRORS and not c.startswith("_dq_")]
    last = quarantine_dedup(quarantine, keys).select(*own, "_dq_run_ts")
    now = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys], F.col(at).alias("_at"))
    fresh = last.join(now, [last[k].eqNullSafe(now[f"_t_{k}"]) for k in keys], "left").where(F.col("_at").isNull() | (F.col("_at") < F.col("_dq_run_ts")))
    return quality_gate(fresh.select(*own), rules, **gate)


def failure_threshold(gate_log: DataFrame, limit: float) -> DataFrame:
    """Runs of the gate log whose failed share is above the limit, in percent."""
    share = F.col("rows_quarantined") * 100.0 / F.col("rows_checked")
    return gate_log.where(F.col("rows_checked") > 0).withColumn("failed_pct", share).where(F.col("failed_pct") > limit)


def top_failing_rules(bad: DataFrame, n: int = 10) -> DataFrame:
    return failed_rule_counts(bad).orderBy(F.desc("n"), "rule").limit(n)
