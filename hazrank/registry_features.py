"""Registered queries: feature families and the feature matrix.

Feature queries run on the active cohort of every label year of the
spine (1997-2000 by default), i.e. the union of both validation flavours.
"""

from __future__ import annotations

from hazrank.plans import cohorts as C
from hazrank.plans import features as FT
from hazrank.queries import ctx, register, rounded


def _cohort(c):
    return C.cohort_active(c.lt, c.spine)


@register("feat_inspection_history")
def q_f1(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return FT.feat_inspection_history(c.lt, _cohort(c), c.spine)


@register("feat_violation_history")
def q_f2(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return rounded(FT.feat_violation_history(c.lt, _cohort(c), c.spine))


@register("feat_facility_info")
def q_f3(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return FT.feat_facility_info(c.lt, _cohort(c), c.spine)


@register("feat_waste_info")
def q_f4(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return rounded(FT.feat_waste_info(c.lt, _cohort(c), c.spine))


@register("to_pounds")
def q_f5(spark, sf_dir):
    """Per waste page: quantity in pounds (unit conversion only)."""
    from pyspark.sql import functions as F
    from hazrank.functions.columns import to_pounds
    c = ctx(spark, sf_dir)
    w = c.lt_all.waste
    return rounded(w.select("handler_id", "report_year", "hz_pg", "unit_of_measure", "density_unit_of_measure",
                            to_pounds(F.col("unit_of_measure"), F.col("gen_qty"), F.col("wst_density"),
                                      F.col("density_unit_of_measure")).alias("gen_qty_pound")))


@register("feat_parent_company_size")
def q_f6(spark, sf_dir):
    c = ctx(spark, sf_dir)
    # literal mode links owners over all years: use the unbounded tables
    return FT.feat_parent_company_size(c.lt_all, _cohort(c), c.spine)


@register("feat_primary_naics")
def q_f7(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return FT.feat_primary_naics(c.lt, _cohort(c), c.spine)


@register("feat_waste_code")
def q_f8(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return rounded(FT.feat_waste_code(c.lt, _cohort(c), c.spine))


@register("feat_parent_company_peers")
def q_f9(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return rounded(FT.feat_parent_company_peers(c.lt_upto, _cohort(c), c.spine, rates=FT.entity_rates(c.lt, c.spine, FT.ALL_WINDOWS)))


@register("feat_geographic")
def q_f10(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return FT.feat_geographic(c.lt_all, _cohort(c), c.spine)


@register("feat_zip_peers")
def q_f11(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return rounded(FT.feat_zip_peers(c.lt_upto, _cohort(c), c.spine, rates=FT.entity_rates(c.lt, c.spine, FT.ALL_WINDOWS)))


@register("conditional_ratio")
def q_f12(spark, sf_dir):
    """The shared ratio core on its own: share of violation rows per entity
    and inspection year."""
    from pyspark.sql import functions as F
    from hazrank.functions.columns import conditional_ratio
    c = ctx(spark, sf_dir)
    i = c.lt_all.inspections_core
    return rounded(i.groupBy("handler_id", F.year("evaluation_start_date").alias("year")).agg(
        conditional_ratio(F.col("found_violation_flag") == "Y").alias("violation_per_inspection")))


@register("window_features_single_pass")
def q_f13(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return rounded(FT.window_features_single_pass(c.lt, _cohort(c), c.spine))
