"""Cohorts: who is scored in each label year.

All label years are computed in one plan: event tables are reduced to
distinct (entity, year) pairs first (partial aggregation before any
shuffle), then equi-joined with the broadcast year spine.  Membership
tests are semi / anti joins, never outer join + IS [NOT] NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazrank.plans.timeline import window_year_spine

ENTITY = "handler_id"


def inspection_entity_years(lt, ny_only: bool = False) -> DataFrame:
    """(handler_id, year): one row per entity and inspection year (only NY
    inspections with ``ny_only``; otherwise the entity attributes are not
    needed and the attribute lookup is skipped)."""
    if ny_only:
        i = lt.inspections.where(F.col("state") == "NY")
    else:
        i = lt.inspections_core
    return i.select(ENTITY, F.year("evaluation_start_date").alias("year")).distinct()


def _in_window(lt, spine: DataFrame, ny_only: bool) -> DataFrame:
    """(handler_id, label_year) inspected within the feature window."""
    ey = inspection_entity_years(lt, ny_only)
    wys = window_year_spine(spine, ("total",)).select("label_year", "year")
    return ey.join(F.broadcast(wys), "year").select(ENTITY, "label_year")


def _in_label_year(lt, spine: DataFrame, ny_only: bool) -> DataFrame:
    ey = inspection_entity_years(lt, ny_only)
    return ey.join(F.broadcast(spine.select("label_year")), ey.year == F.col("label_year")) \
             .select(ENTITY, "label_year")


# --- C1 ---------------------------------------------------------------------
def cohort_active(lt, spine: DataFrame) -> DataFrame:
    """Distinct entities with a report in the cohort year (label_year - 1)."""
    sr = lt.report_keys
    sp = F.broadcast(spine.select("label_year", "cohort_year"))
    return (sr.join(sp, sr.report_year == sp.cohort_year)
              .select(ENTITY, "label_year").distinct())


# --- C2 ---------------------------------------------------------------------
def cohort_train(lt, spine: DataFrame) -> DataFrame:
    """Active and inspected (in NY) during the label year itself."""
    return cohort_active(lt, spine).join(_in_label_year(lt, spine, True), [ENTITY, "label_year"], "left_semi")


# --- C3 ---------------------------------------------------------------------
def cohort_train_with_history(lt, spine: DataFrame) -> DataFrame:
    """Training cohort that was also inspected (in NY) in the feature window."""
    return cohort_train(lt, spine).join(_in_window(lt, spine, True), [ENTITY, "label_year"], "left_semi")


# --- C4 ---------------------------------------------------------------------
def cohort_val_with_history(lt, spine: DataFrame) -> DataFrame:
    """Active and inspected anywhere in the feature window (no state filter)."""
    return cohort_active(lt, spine).join(_in_window(lt, spine, False), [ENTITY, "label_year"], "left_semi")


# --- C5 ---------------------------------------------------------------------
def cohort_val_without_history(lt, spine: DataFrame) -> DataFrame:
    """Active and never inspected in the feature window (anti join)."""
    return cohort_active(lt, spine).join(_in_window(lt, spine, False), [ENTITY, "label_year"], "left_anti")


# --- C6 ---------------------------------------------------------------------
def inspected_years(lt) -> DataFrame:
    """(handler_id, year, ny): years with an inspection, and whether one of
    them was in NY."""
    return lt.inspections.groupBy(ENTITY, F.year("evaluation_start_date").alias("year")).agg(
        F.coalesce(F.max(F.col("state") == "NY"), F.lit(False)).alias("ny"))


def membership(report_keys: DataFrame, inspected: DataFrame, spine: DataFrame) -> DataFrame:
    """(handler_id, label_year, active, seen, seen_ny, inspected_ny): one
    aggregate over the sources, each reduced to entity and year
    (``inspected_years``).

    active: a report in the cohort year; seen, seen_ny: an inspection (in NY)
    in the feature window; inspected_ny: one in NY in the label year."""
    no = F.lit(False)
    reports = report_keys.select(ENTITY, F.col("report_year").alias("year"), F.lit(True).alias("r"), no.alias("i"), no.alias("ny"))
    ins = inspected.select(ENTITY, "year", no.alias("r"), F.lit(True).alias("i"), "ny")
    # the years that matter to a label year, and as what
    years = spine.select("label_year", "cohort_year", "feature_start", "feature_end",
                         F.explode(F.sequence("feature_start", "label_year")).alias("year"))
    years = years.select("label_year", F.col("year").cast("int").alias("year"), (F.col("year") == F.col("cohort_year")).alias("in_cohort"),
                         F.col("year").between(F.col("feature_start"), F.col("feature_end")).alias("in_window"),
                         (F.col("year") == F.col("label_year")).alias("in_label"))
    j = reports.unionByName(ins).join(F.broadcast(years), "year")
    return j.groupBy(ENTITY, "label_year").agg(
        F.max(F.col("r") & F.col("in_cohort")).alias("active"), F.max(F.col("i") & F.col("in_window")).alias("seen"),
        F.max(F.col("ny") & F.col("in_window")).alias("seen_ny"), F.max(F.col("ny") & F.col("in_label")).alias("inspected_ny"))


def cohort_route(lt, spine: DataFrame) -> DataFrame:
    return route_of(lt.report_keys, inspected_years(lt), spine)


def route_of(report_keys: DataFrame, inspected: DataFrame, spine: DataFrame) -> DataFrame:
    """All flavours in one frame: (handler_id, label_year, split, history).

    train/with = C3, train/without = C2 (history features are merely not
    used), val/with = C4, val/without = C5.  Train rows only for training
    label years, validation rows only for validation label years.  All four
    are read off the flags of one aggregate.
    """
    m = membership(report_keys, inspected, spine).where("active").join(F.broadcast(spine.select("label_year", "is_train", "is_val")), "label_year")
    flavour = lambda split, history, cond: F.when(F.expr(cond), F.struct(F.lit(split).alias("split"), F.lit(history).alias("history")))
    parts = F.array(flavour("train", True, "is_train AND inspected_ny AND seen_ny"), flavour("train", False, "is_train AND inspected_ny"),
                    flavour("val", True, "is_val AND seen"), flavour("val", False, "is_val AND NOT seen"))
    return m.select(ENTITY, "label_year", F.explode(F.filter(parts, lambda x: x.isNotNull())).alias("_f")).select(
        ENTITY, "label_year", "_f.split", "_f.history")


def validation_cohorts(lt, spine: DataFrame) -> DataFrame:
    """C4 and C5 as one frame with a ``history`` flag, in a single pass:
    active entities left-joined to a distinct in-window marker."""
    act = cohort_active(lt, spine)
    seen = _in_window(lt, spine, False).distinct().withColumn("_seen", F.lit(True))
    return act.join(seen, [ENTITY, "label_year"], "left").select(
        ENTITY, "label_year", F.coalesce(F.col("_seen"), F.lit(False)).alias("history"))


# --- C7 ---------------------------------------------------------------------
def cohort_sizes(lt, spine: DataFrame, labels_fn) -> DataFrame:
    """Per label year and history flavour of the validation cohorts:
    size, labelled, unlabelled, positives."""
    coh = validation_cohorts(lt, spine)
    lab = labels_fn(lt, coh, spine)
    return lab.groupBy("label_year", "history").agg(
        F.count(F.lit(1)).alias("cohort_size"),
        F.count("formal").alias("labelled"),
        (F.count(F.lit(1)) - F.count("formal")).alias("unlabelled"),
        F.coalesce(F.sum("formal"), F.lit(0)).alias("positives"))
