"""Aggregates kept up by signed changes: what a change took away and what it brought, folded into stored sums.

A changed row is two signed rows, the old one with -1 and the new one with +1. Counts and sums add up by group, so a
batch costs its own rows and one row of state for each group that it touches. A maximum can't be taken back: if the
greatest value of a group goes and nothing as great comes, this group alone is computed again from its base rows. Groups
match null-safely, so the group of a NULL key is kept up as any other. A group without rows left goes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltwork.functions.money import cents
from siltwork.sources.scratch import written

SIGN, ROWS = "_sign", "_rows"


@dataclass(frozen=True)
class Measures:
    """sums: name to a whole-number expression; maxima: name to an expression. Rows are always counted."""

    sums: Mapping[str, Column] = field(default_factory=dict)
    maxima: Mapping[str, Column] = field(default_factory=dict)


def on_keys(a: DataFrame, b: DataFrame, keys: Sequence[str], prefix: str) -> list[Column]:
    return [a[k].eqNullSafe(b[f"{prefix}{k}"]) for k in keys]


def _keys_of(rows: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return rows.select(*[F.col(k).alias(f"{prefix}{k}") for k in keys]).distinct()


def only(rows: DataFrame, of: DataFrame, keys: Sequence[str]) -> DataFrame:
    """rows whose keys are among those of another frame, NULL keys too."""
    marks = _keys_of(of, keys, "_of_")
    return rows.join(marks, on_keys(rows, marks, keys, "_of_"), "left_semi")


def without(rows: DataFrame, of: DataFrame, keys: Sequence[str]) -> DataFrame:
    marks = _keys_of(of, keys, "_of_")
    return rows.join(marks, on_keys(rows, marks, keys, "_of_"), "left_anti")


def signed(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows that go with -1 and rows that come with +1."""
    return before.withColumn(SIGN, F.lit(-1).cast("long")).unionByName(after.withColumn(SIGN, F.lit(1).cast("long")))


def of_merge(target: DataFrame, source: DataFrame, keys: Sequence[str], gone: Column) -> DataFrame:
    """The signed rows of a merge by key: what the target had of the source's keys, and the source's rows but deletes."""
    left = F.coalesce(gone, F.lit(False))
    return signed(only(target, source, keys), source.where(~left).select(*target.columns))


def state_of(base: DataFrame, keys: Sequence[str], measures: Measures) -> DataFrame:
    """The state of each group, from its rows."""
    found = base.groupBy(*keys).agg(
        F.count("*").alias(ROWS),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for n, c in measures.sums.items()],
        *[F.max(c).alias(n) for n, c in measures.maxima.items()],
    )
    return found


def folded(state: DataFrame, changes: DataFrame, keys: Sequence[str], measures: Measures, base: DataFrame | Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The state of the groups that signed rows touch, after them; of a group that is gone a row with 0 rows.

    base: all rows after the changes, of which only groups that lost their greatest value are read, or what gives the
    rows of such groups. With maxima the folded rows are written first, so the changes are folded once.
    """
    came, went = F.col(SIGN) > 0, F.col(SIGN) < 0
    deltas = changes.groupBy(*[F.col(k).alias(f"_d_{k}") for k in keys]).agg(
        F.sum(SIGN).alias(f"_d{ROWS}"),
        *[F.coalesce(F.sum(F.col(SIGN) * c), F.lit(0)).cast("long").alias(f"_d_{n}") for n, c in measures.sums.items()],
        *[F.max(F.when(came, c)).alias(f"_up_{n}") for n, c in measures.maxima.items()],
        *[F.max(F.when(went, c)).alias(f"_down_{n}") for n, c in measures.maxima.items()],
    )
    both = deltas.join(state, on_keys(state, deltas, keys, "_d_"), "left")
    plus = lambda n: (F.coalesce(F.col(n), F.lit(0)) + F.col(f"_d{n}" if n == ROWS else f"_d_{n}")).alias(n)
    lost = F.lit(False)
    for n in measures.maxima:
        lost = lost | (F.col(f"_down_{n}").isNotNull() & (F.col(f"_down_{n}") >= F.col(n)) & ~F.coalesce(F.col(f"_up_{n}") >= F.col(n), F.lit(False)))
    rows = both.select(
        *[F.col(f"_d_{k}").alias(k) for k in keys],
        plus(ROWS),
        *[plus(n) for n in measures.sums],
        *[F.greatest(F.col(n), F.col(f"_up_{n}")).alias(n) for n in measures.maxima],
        (F.coalesce(lost, F.lit(False)) & (F.coalesce(F.col(ROWS), F.lit(0)) + F.col(f"_d{ROWS}") > 0)).alias("_again"),
    )
    if not measures.maxima:
        return rows.drop("_again")
    if base is None:
        raise ValueError("maxima need the base rows, for groups that lose their greatest value")
    rows = written(rows, "folded")
    lost = rows.where("_again")
    again = state_of(base(lost) if callable(base) else only(base, lost, keys), keys, measures)
    return rows.where("NOT _again").drop("_again").unionByName(again)


def replaced(state: DataFrame, touched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The whole state after touched groups have been folded."""
    return without(state, touched, keys).unionByName(touched.where(F.col(ROWS) > 0).select(*state.columns))


# --- derived tables ---------------------------------------------------------------------------------------------

STATUS = ["status"]


def status_measures() -> Measures:
    return Measures({"cents": cents(F.col("amount")), "amounts": F.col("amount").isNotNull().cast("long")})


def rounded_mean(c: str, n: str) -> Column:
    """Cents over a number, rounded half away from zero to the cent."""
    return F.signum(F.col(c).cast("double")) * F.floor((2 * F.abs(c) + F.col(n)).cast("double") / (2 * F.col(n)).cast("double")) / 100


def status_summary(state: DataFrame) -> DataFrame:
    """order_status_summary as its state gives it; amounts that are all NULL have neither sum nor mean."""
    known = F.col("amounts") > 0
    return state.select("status", F.col(ROWS).alias("order_count"), F.when(known, F.col("cents").cast("double") / 100).alias("total_amount"), F.when(known, rounded_mean("cents", "amounts")).alias("avg_amount"))


POSITION, OWNER = ["position_id"], ["owner_id"]


def transaction_measures() -> Measures:
    return Measures({"cents": cents(F.col("amount")), "amounts": F.col("amount").isNotNull().cast("long")}, {"last": F.col("trade_date")})


def _owned_measures() -> Measures:
    return Measures({"txns": F.col(ROWS), "cents": F.col("cents"), "amounts": F.col("amounts")}, {"last": F.col("last")})


#: Positions up to which those that lost their last day are broadcast to the transactions.
BROADCAST_LOST = 100_000


@dataclass
class Exposure:
    """owner_exposure kept up by changes of transactions and positions.

    Two states: each position with its owner and the sums of its transactions, and sums of each owner's positions. A
    position that is touched, by its transactions or by a change of its own (another owner, opened, gone), takes its old
    sums from its old owner and brings its new ones to the new owner; nothing else is read. Sums of transactions whose
    position is not there wait without an owner. Keys tell a position, which is there once; with a NULL in them none is meant.

    Each step is written before the next reads it, and rows go to their position once a step, so the disk that it takes
    is the largest step's.
    """

    per_position: DataFrame
    per_owner: DataFrame
    keys: Sequence[str] = tuple(POSITION)

    @staticmethod
    def _owned(per_position: DataFrame) -> DataFrame:
        return per_position.where(F.col("owner_id").isNotNull() & (F.col(ROWS) > 0))

    @classmethod
    def of(cls, transactions: DataFrame, positions: DataFrame, keys: Sequence[str] = tuple(POSITION)) -> Exposure:
        """transactions and positions (with owner_id) have the keys."""
        sums = state_of(transactions.dropna(subset=list(keys)), keys, transaction_measures())
        both = sums.join(positions.dropna(subset=list(keys)).select(*keys, "owner_id"), list(keys), "full")
        counts = [F.coalesce(n, F.lit(0)).alias(n) for n in (ROWS, *transaction_measures().sums)]
        per = written(both.select(*keys, "owner_id", *counts, "last"), "positions")
        return cls(per, written(state_of(cls._owned(per), OWNER, _owned_measures()), "owners"), keys)

    def _touched(self, changed: DataFrame, moved: DataFrame, transactions: DataFrame) -> DataFrame:
        """Positions that changes reach, as they are after them, with what they had before as _was_<column>."""
        keys, sums = list(self.keys), transaction_measures().sums
        owner = self.per_position.schema["owner_id"].dataType
        day = self.per_position.schema["last"].dataType
        came = F.col(SIGN) > 0
        zero = F.lit(0).cast("long")
        # Changes of either kind in one shape, so that one shuffle brings all of a position together.
        by_rows = changed.select(
            *keys, F.col(SIGN).alias(f"_d{ROWS}"), *[(F.col(SIGN) * F.coalesce(c, F.lit(0))).cast("long").alias(f"_d_{n}") for n, c in sums.items()],
            F.when(came, F.col("trade_date")).alias("_up"), F.when(~came, F.col("trade_date")).alias("_down"), F.lit(None).cast(owner).alias("_to"), F.lit(False).alias("_moved"),
        )
        by_moves = moved.select(
            *keys, zero.alias(f"_d{ROWS}"), *[zero.alias(f"_d_{n}") for n in sums],
            F.lit(None).cast(day).alias("_up"), F.lit(None).cast(day).alias("_down"), F.when(came, F.col("owner_id")).alias("_to"), F.lit(True).alias("_moved"),
        )
        deltas = by_rows.unionByName(by_moves).dropna(subset=keys).groupBy(*keys).agg(
            *[F.sum(f"_d{n}").alias(f"_d{n}") for n in (ROWS, *[f"_{n}" for n in sums])], F.max("_up").alias("_up"), F.max("_down").alias("_down"), F.max("_to").alias("_to"), F.max("_moved").alias("_moved")
        )
        both = deltas.join(self.per_position, keys, "left")
        plus = lambda n, d: F.coalesce(F.col(n), F.lit(0)) + F.col(d)
        lost = F.coalesce((F.col("_down") >= F.col("last")) & ~F.coalesce(F.col("_up") >= F.col("last"), F.lit(False)), F.lit(False))
        touched = written(both.select(
            *keys, F.when(F.col("_moved"), F.col("_to")).otherwise(F.col("owner_id")).alias("owner_id"),
            plus(ROWS, f"_d{ROWS}").alias(ROWS), *[plus(n, f"_d_{n}").alias(n) for n in sums],
            F.when(plus(ROWS, f"_d{ROWS}") > 0, F.greatest("last", "_up")).alias("last"),
            *[F.col(c).alias(f"_was_{c}") for c in ("owner_id", ROWS, *sums, "last")], (lost & (plus(ROWS, f"_d{ROWS}") > 0)).alias("_again"),
        ), "touched")
        again = touched.where("_again")
        marks, n = again.select(*keys), again.count()
        if not n:
            return touched.drop("_again")
        few = (lambda df: F.broadcast(df)) if n <= BROADCAST_LOST else (lambda df: df)
        last = transactions.join(few(marks), keys, "left_semi").groupBy(*keys).agg(F.max("trade_date").alias("last"))
        return touched.where("NOT _again").unionByName(again.drop("last").join(few(last), keys)).drop("_again")

    def after(self, changed: DataFrame, transactions: DataFrame, moved: DataFrame) -> tuple[Exposure, DataFrame]:
        """(exposure, state of the touched owners) after signed transactions and signed positions; transactions: all after them."""
        keys, columns = list(self.keys), self.per_position.columns
        touched = self._touched(changed, moved, transactions)
        now = touched.select(*columns)
        was = touched.select(*keys, *[F.col(f"_was_{c}").alias(c) for c in columns if c not in keys])

        def of_owners(lost: DataFrame) -> DataFrame:
            """All positions of some owners after the changes; only theirs are looked up among the touched ones."""
            kept = only(self._owned(self.per_position), lost, OWNER).join(touched.select(*keys), keys, "left_anti")
            return kept.unionByName(only(self._owned(now), lost, OWNER).select(*kept.columns))

        owners = written(folded(self.per_owner, signed(self._owned(was), self._owned(now)), OWNER, _owned_measures(), of_owners), "owners")
        per = self.per_position.join(touched.select(*keys), keys, "left_anti").unionByName(now.where(F.col("owner_id").isNotNull() | (F.col(ROWS) > 0)))
        return Exposure(per, replaced(self.per_owner, owners, OWNER), self.keys), owners


def owner_exposure(per_owner: DataFrame, owners: DataFrame) -> DataFrame:
    """owner_exposure as its state gives it, with the owners' names."""
    names = owners.select(F.col("entity_master_owner_id").alias("owner_id"), "owner_name")
    known = F.col("amounts") > 0
    rows = per_owner.join(names, "owner_id")
    return rows.select("owner_id", "owner_name", F.col("txns").alias("txn_count"), F.when(known, F.col("cents").cast("double") / 100).alias("total_amount"), F.when(known, rounded_mean("cents", "amounts")).alias("avg_amount"), F.col("last").alias("last_trade_date"))
