"""Timeline: label years, cohort years, look-back windows, temporal folds.

The year spine is derived from the years present in the reports (so the
work follows the data) and restricted to the configured label ranges.
It holds one row per label year, is therefore tiny and bounded by the
number of distinct years, and is the only side ever broadcast by hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazrank.config import Timeline, WINDOW_SPAN


def report_years(lt) -> DataFrame:
    """Distinct report years (one scan of the order dates, partial agg)."""
    return lt.wh.orders.select(F.year("o_orderdate").alias("year")).distinct()


# --- T1 ---------------------------------------------------------------------
def timeline_spine(lt, tl: Timeline) -> DataFrame:
    """label_year, cohort_year, feature_start, feature_end, is_train, is_val.

    A label year qualifies when it lies in a configured range and the
    cohort year (label_year - 1) has reports.
    """
    lo = min(tl.train_label_range[0], tl.val_label_range[0])
    hi = max(tl.train_label_range[1], tl.val_label_range[1])
    years = report_years(lt)
    cand = years.select((F.col("year") + 1).alias("label_year")).where(
        (F.col("label_year") >= lo) & (F.col("label_year") <= hi))
    ly = F.col("label_year")
    return ordered_windows(cand.select(
        ly.cast("int").alias("label_year"),
        (ly - 1).cast("int").alias("cohort_year"),
        (ly - 1 - tl.lookback).cast("int").alias("feature_start"),
        (ly - 1).cast("int").alias("feature_end"),
        ly.between(*tl.train_label_range).alias("is_train"),
        ly.between(*tl.val_label_range).alias("is_val"),
    ))


def ordered_windows(spine: DataFrame) -> DataFrame:
    """``spine``, failing in the plan where a window ends before it starts.
    (Ranges of label years are checked when the ``Timeline`` is made.)"""
    ok = F.col("feature_start") <= F.col("feature_end")
    wrong = F.concat(F.lit("feature window of "), F.col("label_year").cast("string"), F.lit(" starts after its end"))
    # the check hangs on a column that every reader needs
    return spine.withColumn("label_year", F.when(F.assert_true(ok, wrong).isNull(), F.col("label_year")))


def label_years_from(spine: DataFrame, year_col: str) -> F.Column:
    """The label years whose window ends in the year of ``year_col`` or later,
    as an array to explode: as-of joins become equi joins this way.  The
    spine's rows (one per label year) are read here."""
    ends = sorted((r["feature_end"], r["label_year"]) for r in spine.select("feature_end", "label_year").collect())
    years = F.array(*[F.struct(F.lit(e).alias("e"), F.lit(y).alias("y")) for e, y in ends]) if ends else F.expr("CAST(array() AS array<struct<e: int, y: int>>)")
    return F.transform(F.filter(years, lambda x: x["e"] >= F.col(year_col)), lambda x: x["y"])


def config_spine(spark, tl: Timeline) -> DataFrame:
    """The same spine from the configuration alone (a local relation of a
    few rows, no scan).  Used inside the other plans: a label year whose
    cohort year has no reports simply yields an empty cohort, so the
    result equals the data-derived spine while no query pays a scan of
    the order dates for it."""
    rows = [(y, y - 1, y - 1 - tl.lookback, y - 1,
             tl.train_label_range[0] <= y <= tl.train_label_range[1],
             tl.val_label_range[0] <= y <= tl.val_label_range[1]) for y in tl.label_years()]
    return spark.createDataFrame(rows, "label_year int, cohort_year int, feature_start int, feature_end int, "
                                       "is_train boolean, is_val boolean")


# --- T2 ---------------------------------------------------------------------
def window_start(window: str, start: F.Column, end: F.Column) -> F.Column:
    """First year of a look-back window (both ends inclusive)."""
    if window == "total":
        return start
    if window not in WINDOW_SPAN:
        raise ValueError(f"unknown window {window!r}")
    return end - F.lit(WINDOW_SPAN[window])


def lookback_windows(spine: DataFrame, windows=("total", "five_year", "three_year", "most_recent")) -> DataFrame:
    """(label_year, window_name, window_start, window_end) for every window."""
    parts = [spine.select("label_year", F.lit(w).alias("window_name"),
                          window_start(w, F.col("feature_start"), F.col("feature_end")).cast("int")
                          .alias("window_start"),
                          F.col("feature_end").alias("window_end"))
             for w in windows]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def window_year_spine(spine: DataFrame, windows=("total", "five_year", "three_year", "most_recent")) -> DataFrame:
    """(label_year, year, in_<window>...) for every year of the widest window.

    Used by the single-pass feature builder: facts pre-aggregated per
    (entity, year) join this on ``year`` and sum under the flags.
    """
    s = spine.select("label_year", "feature_start", "feature_end",
                     F.explode(F.sequence("feature_start", "feature_end")).alias("year"))
    flags = [(F.col("year") >= window_start(w, F.col("feature_start"), F.col("feature_end"))).alias(f"in_{w}")
             for w in windows]
    return s.select("label_year", F.col("year").cast("int").alias("year"), *flags)


# --- T3 ---------------------------------------------------------------------
def temporal_folds(spine: DataFrame) -> DataFrame:
    """Expanding-window folds: fold i trains on label years train[0..i] and
    validates on the i-th validation year.

    Output: (fold, val_year, train_year) -- one row per training year of a
    fold.  Each fold lists the indices up to its own, and an equi join looks
    up their years.
    """
    from pyspark.sql import Window
    tr = spine.where("is_train").select(F.col("label_year").alias("train_year"))
    va = spine.where("is_val").select(F.col("label_year").alias("val_year"))
    tr = tr.withColumn("train_idx", F.row_number().over(Window.orderBy("train_year")) - 1)
    va = va.withColumn("fold", F.row_number().over(Window.orderBy("val_year")) - 1)
    va = va.withColumn("train_idx", F.explode(F.sequence(F.lit(0), F.col("fold"))))
    return (va.join(tr, "train_idx", "inner")
              .select("fold", "val_year", "train_year"))


# --- T4 ---------------------------------------------------------------------
def split_dates(spine: DataFrame) -> DataFrame:
    """Calendar bounds of each label year and feature window."""
    return spine.select(
        "label_year",
        F.make_date("label_year", F.lit(1), F.lit(1)).alias("label_start_date"),
        F.make_date("label_year", F.lit(12), F.lit(31)).alias("label_end_date"),
        F.make_date("feature_start", F.lit(1), F.lit(1)).alias("feature_start_date"),
        F.make_date("feature_end", F.lit(12), F.lit(31)).alias("feature_end_date"),
    )
