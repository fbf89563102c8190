"""Registered queries: exploratory analysis (B1-B9, B16-B18).

The three-year window table of the analysis is the NY inspections of the
validation label years; the single-year table is the last of them.
"""

from __future__ import annotations

from hazrank.operators import eda as B
from hazrank.queries import ctx, register, rounded


def _window(c):
    lo, hi = c.tl.val_label_range
    return B.state_inspections(c.lt, "NY", lo, hi)


def _last_year(c):
    hi = c.tl.val_label_range[1]
    return B.state_inspections(c.lt, "NY", hi, hi)


@register("share_by_value")
def q_b1(spark, sf_dir):
    return B.share_by_value(_window(ctx(spark, sf_dir)), "found_violation_flag")


@register("breakdown_with_lookup")
def q_b2(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return B.breakdown_with_lookup(_window(c).where("found_violation_flag = 'Y'"), "violation_type",
                                   c.lt.violation_info)


@register("filter_project")
def q_b3(spark, sf_dir):
    return B.facilities_in(ctx(spark, sf_dir).lt_all.facilities, "NY").select("id_number")


_FAC_COLS = ["id_number", "fed_waste_generator", "transporter", "active_site", "operating_tsdf"]


@register("not_inspected")
def q_b4(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return B.not_inspected(B.facilities_in(c.lt_all.facilities, "NY").select(*_FAC_COLS), _window(c))


@register("inspected")
def q_b5(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return B.inspected(B.facilities_in(c.lt_all.facilities, "NY").select(*_FAC_COLS), _window(c))


@register("distribution")
def q_b6(spark, sf_dir):
    return B.distribution(_last_year(ctx(spark, sf_dir)).where("found_violation_flag = 'Y'"), "violation_type")


@register("distribution_enforcement")
def q_b6b(spark, sf_dir):
    return B.distribution(_last_year(ctx(spark, sf_dir)).where("found_violation_flag = 'Y'"), "enforcement_type")


def _ny_reports(c):
    return c.lt_all.waste_report.where("state = 'NY'")


@register("joined_distribution")
def q_b7(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return B.joined_distribution(_last_year(c).where("found_violation_flag = 'Y'"), _ny_reports(c), "waste_code_group")


@register("joined_distribution_method")
def q_b7b(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return B.joined_distribution(_last_year(c).where("found_violation_flag = 'Y'"), _ny_reports(c),
                                 "management_method")


@register("commonsense_rank")
def q_b9(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return B.commonsense_rank(c.lt_upto, c.val_spine)


@register("describe_column")
def q_b16(spark, sf_dir):
    return rounded(B.describe_column(ctx(spark, sf_dir).lt_all.income, "est_total_income"))


@register("histogram")
def q_b17(spark, sf_dir):
    return B.histogram(ctx(spark, sf_dir).lt_all.income, "est_total_income", 10)


@register("null_rows")
def q_b18(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return B.null_rows(c.lt_all.inspections, "land_type", ["handler_id", "evaluation_start_date", "state"])
