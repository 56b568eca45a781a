"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

A source's documents, in the order of a hash, are cut into blocks. With a share a/d of the slots, block k of a
source (from 0) is released at slot ``floor(k * d / a)`` and due by slot ``ceil((k + 1) * d / a)``; in each slot
the released block with the earliest deadline goes first. Shares are whole numbers over d, so releases and
deadlines repeat every d slots: one period is scheduled and every block finds its slot by its number in its period,
``period * d + slot``, by a join with d rows. As long as every source lasts, each has had its share of the blocks at
any slot, to less than one block. What a source has beyond keeps its slots; the slots of one that has run out stay empty.

The period follows the smallest weight: it is so long that the source of the least target has LEAST_SLOTS slots in it
and each share differs from its target by less than one slot a period, between PERIOD and MOST_SLOTS slots. Targets
further apart than the longest period can tell get one slot each, and the rest goes by weight.

A source's order is cut into ranges of the hash, so a hot source is ranked in many tasks: rows before a range are
a sum of counts. Rows are never dropped. A null source is a source of its own; repeated rows get a place each;
ties of the hash are broken by doc_id. An empty table gives no rows. Columns may have any names. The schedule itself is
made in one task, in a time that grows with the slots of a period times the sources.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltwork.llm.common import kept

#: Documents in a block.
BLOCK = 16
#: Slots in a period of the schedule, at least and at most, and slots that the source of the least target has in it.
PERIOD, MOST_SLOTS, LEAST_SLOTS = 1000, 1 << 16, 4
#: Given weights become whole numbers of the largest one's size.
_UNITS = 10**9
#: Rows of one source that one range of the hash holds, about.
RANGE_ROWS = 4096
#: Sources up to which their shares and slots are broadcast; more are joined by a shuffle, if Spark finds them large.
BROADCAST_SOURCES = 10_000
NO_SOURCE = "\0"


def _hash(key: Column) -> Column:
    """A fixed order that SQL engines share: the md5 of the key, as its first 15 hex digits' number."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def weighed(counts: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(source, w): target weights as whole numbers, from (source, n). Without weights in proportion to the root of a source's rows; sources that weights don't name have 1."""
    if weights is None:
        target = F.floor(F.sqrt(F.col("n").cast("double")) * 1000)
    else:
        if any(not w >= 0 for w in weights.values()):
            raise ValueError("weights are numbers of zero or more")
        unit = _UNITS / max([1.0, *weights.values()])
        of = lambda w: F.lit(max(1, round(w * unit))).cast("long")
        target = reduce(lambda out, x: F.when(F.col("source") == x[0], of(x[1])).otherwise(out), weights.items(), of(1))
    return counts.select("source", F.greatest(target, F.lit(1)).cast("long").alias("w"))


def period_of(weights: DataFrame, period: int = PERIOD, most: int = MOST_SLOTS) -> int:
    """Slots of a period for weights (source, w): as many as the smallest needs, within bounds, and one a source at least."""
    n, total, least = weights.agg(F.count("*"), F.sum("w"), F.min("w")).first()
    return max(period, min(most, -(-LEAST_SLOTS * total // least)), 2 * n) if n else period


def shares(weights: DataFrame, period: int) -> DataFrame:
    """(source, share): whole numbers, one at least, that sum to the period, by largest remainder; of weights (source, w)."""
    whole = Window.partitionBy(F.lit(0))
    rows = weights.withColumns({"total": F.sum("w").over(whole), "least": F.min("w").over(whole), "n": F.count("*").over(whole)})
    # If the period is too short for the smallest target, each source has one slot first.
    rows = rows.withColumn("one", F.when(F.col("least") * period < F.col("total"), 1).otherwise(0))
    rows = rows.withColumn("free", F.lit(period) - F.col("one") * F.col("n"))
    rows = rows.withColumn("floor", F.expr("(w * free) div total"))
    rows = rows.withColumn("left", F.expr("(w * free) % total")).withColumn("short", F.col("free") - F.sum("floor").over(whole))
    nth = F.row_number().over(whole.orderBy(F.desc("left"), "source"))
    return rows.withColumn("nth", nth).select("source", (F.col("one") + F.col("floor") + (F.col("nth") <= F.col("short")).cast("long")).alias("share"))


def schedule(share: DataFrame, period: int = PERIOD) -> DataFrame:
    """(source, nth, slot, release, deadline): one period of earliest-deadline-first over the released blocks."""
    all_sources = share.groupBy().agg(F.array_sort(F.collect_list(F.struct("source", "share"))).alias("s")).where(F.size("s") > 0)
    # State: blocks each source has had, and the source of each slot. In slot t, of the sources whose next block is
    # released (had * d < (t + 1) * share), the one whose next deadline ceil((had + 1) * d / share) is first.
    step = f"""
        aggregate(sequence(0, {period - 1}),
          named_struct('had', transform(s, x -> 0L), 'picks', cast(array() as array<int>)),
          (acc, t) -> transform(array(
            array_min(filter(transform(s, (x, i) -> named_struct(
                'due', ((acc.had[i] + 1) * {period} + x.share - 1) div x.share,
                'i', i, 'ok', (acc.had[i] * {period}) div x.share <= t)), y -> y.ok)).i),
            pick -> named_struct('had', transform(acc.had, (h, i) -> if(i = pick, h + 1L, h)), 'picks', array_append(acc.picks, pick)))[0],
          acc -> acc.picks)"""
    slots = all_sources.select("s", F.posexplode(F.expr(step)).alias("slot", "i")).select(F.col("s")[F.col("i")].alias("x"), F.col("slot").cast("long").alias("slot"))
    nth = F.row_number().over(Window.partitionBy("x.source").orderBy("slot")) - 1
    rows = slots.select("x.source", "x.share", "slot", nth.cast("long").alias("nth"))
    return rows.select("source", "share", "nth", "slot", F.expr(f"(nth * {period}) div share").alias("release"), F.expr(f"((nth + 1) * {period} + share - 1) div share").alias("deadline"))


def _source() -> Column:
    return F.coalesce(F.col("source").cast("string"), F.lit(NO_SOURCE))


def _shares_of(docs: DataFrame, weights: dict[str, float] | None, period: int) -> tuple[DataFrame, int, int, DataFrame]:
    """(rows of each source, sources, the period, their shares of it)."""
    counts = kept(docs.groupBy(_source().alias("source")).agg(F.count("*").alias("n")))
    of = weighed(counts, weights)
    period = period_of(of, period)
    return counts, counts.count(), period, shares(of, period)


def targets(docs: DataFrame, *, weights: dict[str, float] | None = None, period: int = PERIOD) -> dict[str, int]:
    """Each source's share by which docs are scheduled, for what deals them later; a null source is NO_SOURCE."""
    return {r["source"]: r["share"] for r in _shares_of(docs, weights, period)[3].collect()}


def placed(docs: DataFrame, *, weights: dict[str, float] | None = None, block: int = BLOCK, period: int = PERIOD, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(_doc, _mix): each row as a struct, and its block (number in its source), place (row in the block), slot, release and deadline."""
    rows = docs.select(F.struct(*docs.columns).alias("_doc"), _source().alias("_mix_source"), _hash(F.col("doc_id")).alias("_mix_hash"))
    counts, sources, period, share = _shares_of(docs, weights, period)
    small = F.broadcast if sources <= BROADCAST_SOURCES else lambda df: df
    plan = kept(schedule(share, period))
    slots = plan.select(F.col("source").alias("_mix_source"), F.col("share").alias("_mix_share"), F.col("nth").alias("_mix_in"), F.col("slot").alias("_mix_slot"))
    # A row for each source, whatever the documents.
    of = slots.where("_mix_in = 0").select("_mix_source", "_mix_share").join(counts.withColumnRenamed("source", "_mix_source"), "_mix_source")
    of = small(of.select("_mix_source", "_mix_share", F.expr(f"(n + {range_rows - 1}) div {range_rows}").alias("_mix_ranges")))
    # Each source is cut into ranges of the hash of about range_rows rows.
    rows = rows.join(of, "_mix_source").withColumn("_mix_range", F.expr("shiftright(shiftright(_mix_hash, 30) * _mix_ranges, 30)"))
    sizes = rows.groupBy("_mix_source", "_mix_range").agg(F.count("*").alias("_mix_n"))
    before = Window.partitionBy("_mix_source").orderBy("_mix_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_mix_source", "_mix_range", F.coalesce(F.sum("_mix_n").over(before), F.lit(0)).alias("_mix_before"))
    nth = F.row_number().over(Window.partitionBy("_mix_source", "_mix_range").orderBy("_mix_hash", "_doc.doc_id")) - 1
    ranked = rows.join(sizes, ["_mix_source", "_mix_range"]).withColumn("_mix_rank", F.col("_mix_before") + nth)
    ranked = ranked.withColumn("_mix_block", F.expr(f"_mix_rank div {block}L"))
    ranked = ranked.withColumn("_mix_in", F.expr("_mix_block % _mix_share")).join(small(slots.drop("_mix_share")), ["_mix_source", "_mix_in"])
    mix = F.expr(f"""named_struct(
        'block', _mix_block, 'place', _mix_rank % {block}L, 'slot', (_mix_block div _mix_share) * {period} + _mix_slot,
        'release', (_mix_block * {period}) div _mix_share, 'deadline', ((_mix_block + 1) * {period} + _mix_share - 1) div _mix_share)""")
    return ranked.select("_doc", mix.alias("_mix"))


def mixing_schedule(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source and its place in the schedule."""
    return placed(docs.select("doc_id", "source"), **options).select("_doc.doc_id", "_doc.source", "_mix.block", "_mix.place", "_mix.slot", "_mix.release", "_mix.deadline")


def in_mixed_order(docs: DataFrame, **options) -> DataFrame:
    """docs, all of them, in the order of the schedule: over the partitions and in each, so over the files that they are written to and in each."""
    order = ["_mix.slot", "_mix.place"]
    return placed(docs, **options).repartitionByRange(*order).sortWithinPartitions(*order).select("_doc.*")


SCHEDULE_SQL = f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, source, coalesce(source, chr(0)) AS s, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
counts AS (SELECT s, greatest(CAST(floor(sqrt(CAST(count(*) AS DOUBLE)) * 1000) AS BIGINT), 1) AS w FROM rows GROUP BY s),
sums AS (SELECT count(*) AS k, CAST(sum(w) AS BIGINT) AS total, min(w) AS least, greatest({PERIOD}, least({MOST_SLOTS}, ({LEAST_SLOTS} * CAST(sum(w) AS BIGINT) + min(w) - 1) // min(w)), 2 * count(*)) AS d FROM counts),
ones AS (SELECT *, CASE WHEN least * d < total THEN 1 ELSE 0 END AS one FROM sums),
parts AS (SELECT s, d, one, (w * (d - one * k)) // total AS whole, (w * (d - one * k)) % total AS rest, d - one * k AS free FROM counts, ones),
shares AS (SELECT s, d, one + whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, s) <= free - sum(whole) OVER () THEN 1 ELSE 0 END AS share FROM parts),
listed AS (SELECT max(d) AS d, list(s ORDER BY s) AS ss, list(CAST(share AS BIGINT) ORDER BY s) AS aa FROM shares),
deal(t, had, pick) AS (
  SELECT CAST(-1 AS BIGINT), list_transform(aa, lambda x: CAST(0 AS BIGINT)), CAST(0 AS BIGINT) FROM listed
  UNION ALL
  SELECT t + 1, list_transform(had, lambda h, i: h + CASE WHEN i = p THEN 1 ELSE 0 END), p
  FROM (SELECT t, had, d, list_min(list_filter(list_transform(aa, lambda a, i: CASE WHEN (had[i] * d) // a <= t + 1 THEN (((had[i] + 1) * d + a - 1) // a) * 1000000 + i END), lambda x: x IS NOT NULL)) % 1000000 AS p
        FROM deal, listed WHERE t + 1 < d)),
slots AS (SELECT ss[pick] AS s, t AS slot, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS nth FROM deal, listed WHERE t >= 0),
ranked AS (SELECT doc_id, source, s, row_number() OVER (PARTITION BY s ORDER BY h, doc_id NULLS FIRST) - 1 AS r FROM rows),
placed AS (SELECT doc_id, source, s, r // {BLOCK} AS block, r % {BLOCK} AS place, share, d FROM ranked JOIN shares USING (s))
SELECT doc_id, source, CAST(block AS BIGINT) AS block, CAST(place AS BIGINT) AS place, CAST((block // share) * d + slot AS BIGINT) AS slot,
       CAST((block * d) // share AS BIGINT) AS release, CAST(((block + 1) * d + share - 1) // share AS BIGINT) AS deadline
FROM placed JOIN slots ON placed.s = slots.s AND placed.block % placed.share = slots.nth
"""
