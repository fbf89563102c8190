"""Exploratory queries: shares, breakdowns, (not) inspected facilities,
distributions, a common-sense ranking, column summaries, histograms.

Many-to-many joins are pre-aggregated on both sides before joining, and
order statistics use the distributed ``ordered_index``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazrank.config import NEVER_INSPECTED_DAYS
from hazrank.operators.ranking import _num_partitions, ordered_index
from hazrank.plans.timeline import label_years_from
from hazrank.session import checkpoint_dir

ENTITY = "handler_id"


def state_inspections(lt, state: str, lo_year: int, hi_year: int) -> DataFrame:
    """Inspections of one state in a year range (date-range predicate)."""
    i = lt.inspections
    return i.where((F.col("state") == state)
                   & (F.col("evaluation_start_date") >= F.make_date(F.lit(lo_year), F.lit(1), F.lit(1)))
                   & (F.col("evaluation_start_date") <= F.make_date(F.lit(hi_year), F.lit(12), F.lit(31))))


# --- B1 -----------------------------------------------------------------------
def share_by_value(df: DataFrame, col: str) -> DataFrame:
    """Count per value and its percentage of all rows, truncated to 2 decimals.
    The total is one aggregate number applied as a literal, so any number
    of values stays spread over the grouped partitions."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    total = df.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    # whole hundredths in integers: 29 of 10000 is 0.29
    hundredths = F.expr(f"count * 10000L div {max(total, 1)}L")
    return g.select(col, "count", (hundredths / F.lit(100.0)).alias("percentage"))


# --- B2 -----------------------------------------------------------------------
def breakdown_with_lookup(df: DataFrame, col: str, lookup: DataFrame) -> DataFrame:
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return g.join(lookup, col, "inner")


# --- B3/B4/B5 -----------------------------------------------------------------
def facilities_in(facilities: DataFrame, state: str) -> DataFrame:
    return facilities.where(F.col("activity_location") == state)


def not_inspected(facilities: DataFrame, events: DataFrame) -> DataFrame:
    return facilities.join(events.select(F.col(ENTITY).alias("id_number")), "id_number", "left_anti")


def inspected(facilities: DataFrame, events: DataFrame) -> DataFrame:
    return facilities.join(events.select(F.col(ENTITY).alias("id_number")), "id_number", "left_semi")


# --- B6 -----------------------------------------------------------------------
def distribution(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


# --- B7 -----------------------------------------------------------------------
def joined_distribution(events: DataFrame, reports: DataFrame, col: str) -> DataFrame:
    """Group count of the many-to-many join events x reports on the entity.

    Both sides are counted per key first; the join then multiplies counts,
    which is exact and never materialises the fan-out."""
    e = events.groupBy(ENTITY).agg(F.count(F.lit(1)).alias("_ne"))
    r = reports.groupBy(ENTITY, col).agg(F.count(F.lit(1)).alias("_nr"))
    return (r.join(e, ENTITY, "inner").groupBy(col)
             .agg(F.sum(F.col("_nr") * F.col("_ne")).alias("count")))


# --- B9 -----------------------------------------------------------------------
def commonsense_rank(lt, spine: DataFrame) -> DataFrame:
    """Per label year: days since the last inspection before Jan 1 of the
    label year (never inspected -> 2147483647) and days since the owner
    became current (owners reported in the cohort year); ranked by both,
    descending, missing owner dates first.  An inspection counts for every
    label year after it: the few label years are exploded, then grouped.

    ``lt``: tables up to the last cohort year."""
    sr = lt.report_keys
    sp = F.broadcast(spine.select("label_year", "cohort_year"))
    act = sr.join(sp, sr.report_year == sp.cohort_year).select(ENTITY, "label_year").distinct()
    last = (lt.inspections_core.groupBy(ENTITY, F.year("evaluation_start_date").alias("year"))
              .agg(F.max("evaluation_start_date").alias("_d")))
    last = (last.select(ENTITY, "_d", F.explode(label_years_from(spine, "year")).alias("label_year"))
                .groupBy(ENTITY, "label_year").agg(F.max("_d").alias("_last")))
    own = lt.owner.select(ENTITY, "report_year", "date_became_current")
    own = (own.join(sp, own.report_year == sp.cohort_year)
              .groupBy(ENTITY, "label_year").agg(F.max("date_became_current").alias("_cur")))
    jan1 = F.make_date(F.col("label_year"), F.lit(1), F.lit(1))
    j = act.join(last, [ENTITY, "label_year"], "left").join(own, [ENTITY, "label_year"], "left")
    d = j.select(ENTITY, "label_year",
                 F.coalesce(F.datediff(jan1, F.col("_last")).cast("long"), F.lit(NEVER_INSPECTED_DAYS).cast("long"))
                  .alias("days_since_inspection"),
                 F.datediff(jan1, F.col("_cur")).cast("long").alias("days_since_became_current"))
    return ordered_index(d, ["label_year"], [F.col("days_since_inspection").desc(),
                                             F.col("days_since_became_current").desc_nulls_first(),
                                             F.col(ENTITY).asc()], rn_col="rank")


# --- B16 ----------------------------------------------------------------------
def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    """Linear-interpolation quantiles (as pandas ``describe``) computed
    exactly: rows are counted per value, the counts cumulated over ranges of
    values, and only the values around each quantile position are kept, so a
    value's number of rows does not matter.  One output row, columns q_<p>."""
    v = df.select(F.col(col).alias("_v")).where(F.col("_v").isNotNull())
    counts = v.groupBy("_v").agg(F.count(F.lit(1)).alias("_n"))
    checkpoint_dir(df.sparkSession)
    # reliable checkpoint: the ranges must not change between reads
    ranged = counts.repartitionByRange(_num_partitions(df), "_v").withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    # at most one row per partition
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranged.groupBy("_pid").agg(F.sum("_n").alias("_cnt"))
    ranges = ranges.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
                           F.sum("_cnt").over(Window.partitionBy()).alias("group_size"))
    up_to = F.sum("_n").over(Window.partitionBy("_pid").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    idx = ranged.withColumn("_loc", up_to).join(ranges, "_pid").withColumn("_to", F.col("_off") + F.col("_loc"))
    holds = lambda rn: (F.col("_to") >= rn) & (F.col("_to") - F.col("_n") < rn)
    picks = []
    for p in probs:
        pos = (F.col("group_size") - 1) * F.lit(float(p))
        lo = F.floor(pos).cast("long") + 1
        frac = pos - F.floor(pos)
        picks.append((p, lo, frac))
    cond = None
    for _, lo, _f in picks:
        c = holds(lo) | holds(lo + 1)
        cond = c if cond is None else cond | c
    near = idx.where(cond)
    aggs = []
    for p, lo, frac in picks:
        v_lo = F.max(F.when(holds(lo), F.col("_v")))
        v_hi = F.coalesce(F.max(F.when(holds(lo + 1), F.col("_v"))), v_lo)
        aggs.append((v_lo + (v_hi - v_lo) * F.max(frac)).alias(f"q_{int(round(p * 100))}"))
    return near.agg(*aggs)


def describe_column(df: DataFrame, col: str) -> DataFrame:
    """count, mean, std (sample), min, 25/50/75 % (exact), max.

    Moments and extremes are one aggregate; the quantiles are attached
    as literals from their own one-row result (no join)."""
    q = exact_quantiles(df, col, (0.25, 0.5, 0.75)).first()
    lit = {k: F.lit(q[k]).cast("double") for k in ("q_25", "q_50", "q_75")}
    return df.agg(F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
                  F.min(col).alias("min"), lit["q_25"].alias("q_25"), lit["q_50"].alias("q_50"),
                  lit["q_75"].alias("q_75"), F.max(col).alias("max"))


# --- B17 ----------------------------------------------------------------------
def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bins between min and max (max falls in the last bin).
    min and max are one aggregate row, applied as literals."""
    mm = df.agg(F.min(col).cast("double").alias("mn"), F.max(col).cast("double").alias("mx")).first()
    if mm["mn"] is None:
        return df.where(F.lit(False)).select(F.lit(1).alias("bin"), F.lit(0).cast("long").alias("count"))
    width = mm["mx"] - mm["mn"]
    b = F.least(F.floor((F.col(col) - F.lit(mm["mn"])) / F.lit(width if width != 0 else 1.0)
                        * F.lit(float(bins))), F.lit(bins - 1)).cast("int") + 1
    return df.where(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))


# --- B18 ----------------------------------------------------------------------
def null_rows(df: DataFrame, col: str, keep: Sequence[str]) -> DataFrame:
    return df.where(F.col(col).isNull()).select(*keep)
