"""Feature families over look-back windows, all label years in one pass.

Single-pass form (F13): each source table is scanned once for every
label year and window.  Facts are first reduced to additive partials per
(entity, year) -- map-side partial aggregation, then one shuffle -- the
partials join the broadcast year spine (label_year, year, in_<window>)
and are summed under the window flags per (entity, label_year).  Ratios
are formed from the summed counts at the end, so every share is exact.
Families are finally left-joined onto the cohort on (entity, label_year);
an entity without rows in a window gets NULL columns, as in a left join
onto a per-window aggregate.

Column names are lower case: ``<feature>_<window>``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazrank.config import (
    CORROSIVE_CODE, DISPOSITION_CODES, FACILITY_FLAGS, FOLLOW_UP_EVALUATION_TYPES,
    FORMAL_ENFORCEMENT_CODES, IGNITABLE_CODE, REACTIVE_CODE, TOXIC_CODE_HIGH_EXCLUSIVE,
    TOXIC_CODE_LOW_EXCLUSIVE, WASTE_MIN_CONTINUED, WASTE_MIN_INITIATED, WASTE_MIN_NONE,
)
from hazrank.functions.columns import (
    conditional_count, count_if_sql, flag_yn, pounds_exact, sql_in,
)
from hazrank.plans.timeline import label_years_from, window_year_spine

ENTITY = "handler_id"
ALL_WINDOWS = ("total", "three_year", "most_recent")


# --- F13 core -----------------------------------------------------------------
def window_sums(pre: DataFrame, spine: DataFrame, windows: Sequence[str],
                measures: Sequence[str], year_col: str = "year", keys: DataFrame | None = None) -> DataFrame:
    """Sum per-(entity, year) partials over every (label_year, window).

    ``pre``: (handler_id, year, measures...).  Returns (handler_id,
    label_year, <measure>__<window>...).  A measure is NULL for a window
    in which the entity has no partial row.  ``keys`` (distinct
    (handler_id, label_year)): sums of these alone.
    """
    wys = F.broadcast(window_year_spine(spine, windows))
    if keys is not None:
        pre = pre.withColumnRenamed(year_col, "year")
        j = pre.join(keys.hint("shuffle_hash"), ENTITY).join(wys, ["label_year", "year"])
    else:
        j = pre.join(wys, pre[year_col] == wys["year"]) if year_col != "year" else pre.join(wys, "year")
    # SQL text: one driver call per aggregate instead of one per operator
    aggs = [F.expr(f"sum(CASE WHEN in_{w} THEN {m} END) AS {m}__{w}") for w in windows for m in measures]
    return j.groupBy(ENTITY, "label_year").agg(*aggs)


def _ratio(num: str, den: str, w: str) -> str:
    """SQL text of a share: summed count over summed rows, as DOUBLE."""
    return f"CAST({num}__{w} AS DOUBLE) / {den}__{w}"


def _agg(exprs: Sequence[str]) -> list[Column]:
    return [F.expr(e) for e in exprs]


def _onto_cohort(cohort: DataFrame, fam: DataFrame) -> DataFrame:
    return cohort.join(fam, [ENTITY, "label_year"], "left")


def _inspection_year(lt) -> DataFrame:
    i = lt.inspections_core
    return i.withColumn("year", F.year("evaluation_start_date"))


# --- F1 -----------------------------------------------------------------------
def inspection_history_family(lt, spine: DataFrame, windows=ALL_WINDOWS) -> DataFrame:
    pre = _inspection_year(lt).groupBy(ENTITY, "year").agg(F.count(F.lit(1)).alias("n"))
    s = window_sums(pre, spine, windows, ["n"])
    return s.selectExpr(ENTITY, "label_year", *[f"n__{w} AS inspection_num_{w}" for w in windows])


def feat_inspection_history(lt, cohort: DataFrame, spine: DataFrame, windows=ALL_WINDOWS) -> DataFrame:
    return _onto_cohort(cohort, inspection_history_family(lt, spine, windows))


# --- F2 -----------------------------------------------------------------------
def _violation_partials() -> tuple[list[str], list[Column]]:
    """(names, aggregate expressions) of the additive inspection partials."""
    parts = [
        ("n", "count(1)"),
        ("n_violation", count_if_sql("found_violation_flag = 'Y'")),
        ("n_complaint", count_if_sql("citizen_complaint_flag = 'Y'")),
        ("n_formal", count_if_sql(sql_in("enforcement_type", FORMAL_ENFORCEMENT_CODES))),
    ]
    parts += [(f"n_disp_{d.lower()}", count_if_sql(f"disposition_status = '{d}'")) for d in DISPOSITION_CODES]
    parts += [
        ("penalty_sum", "sum(coalesce(final_amount, 0.0D))"),
        ("n_penalty", count_if_sql("final_amount IS NOT NULL")),
        ("n_follow_up", count_if_sql(sql_in("evaluation_type", FOLLOW_UP_EVALUATION_TYPES))),
        ("n_fea", count_if_sql("violation_type = 'FEA'")),
    ]
    return [n for n, _ in parts], _agg([f"{e} AS {n}" for n, e in parts])


def _f2_sql(w: str) -> list[str]:
    cols = [f"{_ratio('n_violation', 'n', w)} AS violation_per_inspection_{w}",
            f"{_ratio('n_complaint', 'n', w)} AS complaint_per_inspection_{w}",
            f"{_ratio('n_formal', 'n', w)} AS formal_enforcement_per_inspection_{w}"]
    cols += [f"{_ratio('n_disp_' + d.lower(), 'n', w)} AS disposition_{d.lower()}_per_inspection_{w}"
             for d in DISPOSITION_CODES]
    cols += [f"penalty_sum__{w} AS sum_penalty_amount_{w}",
             f"{_ratio('n_penalty', 'n', w)} AS avg_num_violations_with_penalty_per_inspection_{w}",
             f"{_ratio('n_follow_up', 'n', w)} AS avg_evaluation_type_with_follow_up_{w}",
             f"{_ratio('n_fea', 'n', w)} AS avg_fea_violation_per_inspection_{w}"]
    return cols


def inspection_partials(lt) -> DataFrame:
    """(handler_id, year, measures): all additive counts of the inspections."""
    return _inspection_year(lt).groupBy(ENTITY, "year").agg(*_violation_partials()[1])


def violation_history_family(lt, spine: DataFrame, windows=ALL_WINDOWS) -> DataFrame:
    s = window_sums(inspection_partials(lt), spine, windows, _violation_partials()[0])
    return s.selectExpr(ENTITY, "label_year", *[c for w in windows for c in _f2_sql(w)])


def feat_violation_history(lt, cohort: DataFrame, spine: DataFrame, windows=ALL_WINDOWS) -> DataFrame:
    return _onto_cohort(cohort, violation_history_family(lt, spine, windows))


# --- F3 -----------------------------------------------------------------------
def facility_info_family(reports: DataFrame, spine: DataFrame) -> DataFrame:
    """Activity flags of the report in the most recent year (window end).

    No aggregation: duplicate report rows would fan out, exactly like the
    per-row join they model; ``assert_one_row_per_entity`` detects it.
    """
    sp = F.broadcast(spine.select("label_year", F.col("feature_end").alias("report_year")))
    return reports.join(sp, "report_year").select(
        ENTITY, "label_year", *[flag_yn(F.col(f)).alias(f"{f}_most_recent") for f in FACILITY_FLAGS])


def feat_facility_info(lt, cohort: DataFrame, spine: DataFrame) -> DataFrame:
    return _onto_cohort(cohort, facility_info_family(lt.site_report, spine))


# --- F4 -----------------------------------------------------------------------
WASTE_MEASURES = ["n", "n_none", "n_init", "n_cont", "n_rest", "n_on", "n_off", "pounds"]


def waste_partials(lt) -> DataFrame:
    """(handler_id, year, measures) of the waste pages; pounds as exact
    decimals, so their sums depend on no order."""
    w = lt.waste.withColumnRenamed("report_year", "year")
    return w.groupBy(ENTITY, "year").agg(
        *_agg(["count(1) AS n",
               f"{count_if_sql(sql_in('waste_min_code', WASTE_MIN_NONE))} AS n_none",
               f"{count_if_sql(sql_in('waste_min_code', WASTE_MIN_INITIATED))} AS n_init",
               f"{count_if_sql(sql_in('waste_min_code', WASTE_MIN_CONTINUED))} AS n_cont",
               f"{count_if_sql('NOT ' + sql_in('waste_min_code', WASTE_MIN_NONE + WASTE_MIN_INITIATED + WASTE_MIN_CONTINUED))} AS n_rest",
               count_if_sql("on_site_management = 'Y'") + " AS n_on",
               count_if_sql("on_site_management = 'N'") + " AS n_off"]),
        F.sum(pounds_exact(F.col("unit_of_measure"), F.col("gen_qty"), F.col("wst_density"),
                           F.col("density_unit_of_measure"))).alias("pounds"))


def waste_info_family(lt, spine: DataFrame, windows=("most_recent", "three_year"), pre: DataFrame | None = None,
                      keys: DataFrame | None = None) -> DataFrame:
    pre = waste_partials(lt) if pre is None else pre
    s = window_sums(pre, spine, windows, WASTE_MEASURES, keys=keys)
    cols = []
    for x in windows:
        cols += [f"{_ratio('n_none', 'n', x)} AS percent_no_waste_min_{x}",
                 f"{_ratio('n_init', 'n', x)} AS percent_initiated_waste_min_{x}",
                 f"{_ratio('n_cont', 'n', x)} AS percent_continue_waste_min_{x}",
                 f"{_ratio('n_rest', 'n', x)} AS percent_rest_waste_min_{x}",
                 f"n__{x} AS total_num_waste_{x}",
                 f"{_ratio('n_on', 'n', x)} AS percent_on_site_management_{x}",
                 f"{_ratio('n_off', 'n', x)} AS percent_off_site_management_{x}",
                 f"CAST(pounds__{x} AS DOUBLE) AS total_gen_qty_pound_{x}"]
    return s.selectExpr(ENTITY, "label_year", *cols)


def feat_waste_info(lt, cohort: DataFrame, spine: DataFrame, windows=("most_recent", "three_year")) -> DataFrame:
    return _onto_cohort(cohort, waste_info_family(lt, spine, windows))


# --- F6 -----------------------------------------------------------------------
def owner_links(lt) -> DataFrame:
    """(handler_id, year, owner_operator_name) of owner companies ('CO'),
    each once."""
    co = lt.owner.where(F.col("owner_operator_indicator") == "CO")
    return co.select(ENTITY, F.col("report_year").alias("year"), "owner_operator_name").distinct()


def company_sizes(links: DataFrame, spine: DataFrame, windows) -> DataFrame:
    """(owner_operator_name, label_year, nh__<window>): distinct entities of a
    company per window.

    Counted on two levels, so a company that holds a third of all rows is
    spread: first one row per (company, label year, entity) with the windows
    as flags, dealt out by all three; then plain counts, which every task adds
    up for itself before anything moves."""
    wys = F.broadcast(window_year_spine(spine, windows))
    flags = [F.max(f"in_{w}").alias(f"in_{w}") for w in windows]
    keys = ["owner_operator_name", "label_year"]
    entity = links.where(F.col("owner_operator_name").isNotNull()).join(wys, "year").groupBy(*keys, ENTITY).agg(*flags)
    return entity.groupBy(*keys).agg(*[F.count(F.when(F.col(f"in_{w}"), 1)).alias(f"nh__{w}") for w in windows])


def parent_company_size_family(lt, spine: DataFrame, windows=("most_recent", "three_year"),
                               as_of: bool = False, links: DataFrame | None = None,
                               by_entity: int | None = None, keys: DataFrame | None = None) -> DataFrame:
    """Largest number of distinct active entities among an entity's owner
    companies ('CO'), counted within each window.  ``by_entity``: see
    ``_brought_home``.  ``keys`` (distinct (handler_id, label_year)): rows of
    these alone, their companies counted over all entities.

    Literal mode links an entity to every owner it ever had (all years);
    ``as_of=True`` only to owners reported up to the window end.
    """
    oy = owner_links(lt) if links is None else links
    sizes = company_sizes(oy, spine, windows)
    if as_of:
        linked = oy.select(ENTITY, "owner_operator_name", F.explode(label_years_from(spine, "year")).alias("label_year")).distinct()
        j = linked.join(sizes, ["owner_operator_name", "label_year"])
    else:
        linked = oy.select(ENTITY, "owner_operator_name").distinct()
        j = (linked.join(sizes, "owner_operator_name") if keys is None else
             linked.join(keys.hint("shuffle_hash"), ENTITY).join(sizes, ["owner_operator_name", "label_year"]))
    # a company without entities in a window counts 0 there, the inner join
    # of a per-window aggregate has no row -> NULL.
    agg = _brought_home(j, by_entity).groupBy(ENTITY, "label_year").agg(
        *[F.max(F.when(F.col(f"nh__{w}") > 0, F.col(f"nh__{w}"))).alias(f"num_active_facilities_parent_company_{w}")
          for w in windows])
    return agg


def feat_parent_company_size(lt, cohort: DataFrame, spine: DataFrame,
                             windows=("most_recent", "three_year"), as_of: bool = False) -> DataFrame:
    return _onto_cohort(cohort, parent_company_size_family(lt, spine, windows, as_of))


# --- F7 -----------------------------------------------------------------------
def naics_family(naics: DataFrame, spine: DataFrame) -> DataFrame:
    """First two digits of the primary code (``two_digit``) in the most
    recent year."""
    sp = F.broadcast(spine.select("label_year", F.col("feature_end").alias("report_year")))
    return naics.join(sp, "report_year").select(ENTITY, "label_year", F.col("two_digit").alias("primary_naics_code_two_digit_most_recent"))


def primary_naics(lt) -> DataFrame:
    n = lt.naics.where(F.col("naics_seq") == "1")
    return n.select(ENTITY, "report_year", F.substring("naics_code", 1, 2).alias("two_digit"))


def feat_primary_naics(lt, cohort: DataFrame, spine: DataFrame) -> DataFrame:
    return _onto_cohort(cohort, naics_family(primary_naics(lt), spine))


# --- F8 -----------------------------------------------------------------------
CODE_MEASURES = ["n", "n_ign", "n_cor", "n_rea", "n_tox"]


def waste_code_partials(lt) -> DataFrame:
    """(handler_id, year, measures) of waste pages left-joined to their
    codes.  The codes are pre-aggregated per page key first, so a page with
    many codes never multiplies rows: a page contributes max(1, #codes)
    joined rows and its per-code counts."""
    keys = [ENTITY, "report_year", "hz_pg"]
    c = F.col("epa_waste_code")
    codes = lt.waste_code.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("c_n"),
        conditional_count(c == IGNITABLE_CODE).alias("c_ign"),
        conditional_count(c == CORROSIVE_CODE).alias("c_cor"),
        conditional_count(c == REACTIVE_CODE).alias("c_rea"),
        conditional_count((c > TOXIC_CODE_LOW_EXCLUSIVE) & (c < TOXIC_CODE_HIGH_EXCLUSIVE)).alias("c_tox"))
    pages = lt.waste.select(*keys)
    j = pages.join(codes, keys, "left")
    return j.groupBy(ENTITY, F.col("report_year").alias("year")).agg(
        F.sum(F.coalesce(F.col("c_n"), F.lit(1))).alias("n"),
        F.sum(F.coalesce(F.col("c_ign"), F.lit(0))).alias("n_ign"),
        F.sum(F.coalesce(F.col("c_cor"), F.lit(0))).alias("n_cor"),
        F.sum(F.coalesce(F.col("c_rea"), F.lit(0))).alias("n_rea"),
        F.sum(F.coalesce(F.col("c_tox"), F.lit(0))).alias("n_tox"))


def waste_code_family(lt, spine: DataFrame, windows=("most_recent", "three_year", "total"),
                      pre: DataFrame | None = None, keys: DataFrame | None = None) -> DataFrame:
    """Shares of characteristic waste codes over the waste pages."""
    s = window_sums(waste_code_partials(lt) if pre is None else pre, spine, windows, CODE_MEASURES, keys=keys)
    cols = []
    for w in windows:
        cols += [f"{_ratio('n_ign', 'n', w)} AS percent_ignitable_{w}",
                 f"{_ratio('n_cor', 'n', w)} AS percent_corrosive_{w}",
                 f"{_ratio('n_rea', 'n', w)} AS percent_reactive_{w}",
                 f"{_ratio('n_tox', 'n', w)} AS percent_toxic_{w}"]
    return s.selectExpr(ENTITY, "label_year", *cols)


def feat_waste_code(lt, cohort: DataFrame, spine: DataFrame,
                    windows=("most_recent", "three_year", "total")) -> DataFrame:
    return _onto_cohort(cohort, waste_code_family(lt, spine, windows))


# --- F9 / F11 -------------------------------------------------------------------
def entity_rates(lt, spine: DataFrame, windows) -> DataFrame:
    """(handler_id, label_year, v__w, c__w, f__w): the entity's own
    violation / complaint / formal shares per window."""
    pre = _inspection_year(lt).groupBy(ENTITY, "year").agg(*_agg([
        "count(1) AS n",
        count_if_sql("found_violation_flag = 'Y'") + " AS n_violation",
        count_if_sql("citizen_complaint_flag = 'Y'") + " AS n_complaint",
        f"{count_if_sql(sql_in('enforcement_type', FORMAL_ENFORCEMENT_CODES))} AS n_formal"]))
    s = window_sums(pre, spine, windows, ["n", "n_violation", "n_complaint", "n_formal"])
    return rates_from(s, windows)


def first_group(rows: DataFrame, group_col: str, spine: DataFrame, latest: bool = False) -> DataFrame:
    """(handler_id, label_year, group) of the entity's oldest row with
    report_year <= window end (``latest=True``: newest such row).

    Ties inside a year are broken by the group value.  The oldest row
    overall qualifies for every window end at or after its year, so one
    aggregation per entity serves all label years (no window function).
    The label years that a row serves are exploded from their short list, so
    no range join is needed.
    """
    if not latest:
        first = rows.groupBy(ENTITY).agg(
            F.min(F.struct(F.col("report_year"), F.col(group_col).isNull(), F.col(group_col))).alias("_f"))
        first = first.select(ENTITY, F.col("_f.report_year").alias("report_year"), F.col(f"_f.{group_col}").alias(group_col))
        return first.select(ENTITY, F.explode(label_years_from(spine, "report_year")).alias("label_year"), group_col)
    j = rows.select(ENTITY, "report_year", group_col, F.explode(label_years_from(spine, "report_year")).alias("label_year"))
    last = j.groupBy(ENTITY, "label_year").agg(
        F.max(F.struct(F.col("report_year"), F.col(group_col))).alias("_f"))
    return last.select(ENTITY, "label_year", F.col(f"_f.{group_col}").alias(group_col))


def _brought_home(df: DataFrame, by_entity: int | None) -> DataFrame:
    """Rows that came about by company or zip code, dealt to the ``by_entity``
    partitions in which bucketed partials hold their entities."""
    return df if by_entity is None else df.repartition(by_entity, ENTITY)


def peer_average(members: DataFrame, rates: DataFrame, group_col: str, windows,
                 names: dict[str, str], by_entity: int | None = None, keys: DataFrame | None = None) -> DataFrame:
    """Mean of the members' rates per (group, label_year), given back to each
    member, or to those of ``keys`` (distinct (handler_id, label_year)).  The
    mean is algebraic (sum, count), so a hot group is reduced
    by partial aggregation; NULL groups never match."""
    m = members.where(F.col(group_col).isNotNull())
    j = m.join(rates, [ENTITY, "label_year"], "left")
    aggs = [F.avg(f"{p}__{w}").alias(f"{names[p]}_{w}") for w in windows for p in ("v", "c", "f")]
    avg = j.groupBy(group_col, "label_year").agg(*aggs)
    if keys is not None:
        m = m.join(keys.hint("shuffle_hash"), [ENTITY, "label_year"], "left_semi")
    return _brought_home(m.join(avg, [group_col, "label_year"], "inner").drop(group_col), by_entity)


def parent_company_peers_family(lt, spine: DataFrame, windows=ALL_WINDOWS, latest: bool = False,
                                rates: DataFrame | None = None, links: DataFrame | None = None,
                                by_entity: int | None = None, keys: DataFrame | None = None) -> DataFrame:
    """``lt``: tables up to the last window end.  ``rates`` may come from
    tables bounded to the windows."""
    links = owner_links(lt) if links is None else links
    ho = first_group(links.withColumnRenamed("year", "report_year"), "owner_operator_name", spine, latest)
    rates = rates if rates is not None else entity_rates(lt, spine, windows)
    return peer_average(ho, rates, "owner_operator_name", windows,
                        {"v": "avg_violation_owner", "c": "avg_complaint_owner",
                         "f": "avg_formal_enforcement_owner"}, by_entity, keys)


def feat_parent_company_peers(lt, cohort: DataFrame, spine: DataFrame, windows=ALL_WINDOWS,
                              latest: bool = False, rates: DataFrame | None = None) -> DataFrame:
    return _onto_cohort(cohort, parent_company_peers_family(lt, spine, windows, latest, rates))


def zip_peers_family(lt, spine: DataFrame, windows=ALL_WINDOWS, latest: bool = False,
                     rates: DataFrame | None = None, reports: DataFrame | None = None,
                     by_entity: int | None = None, keys: DataFrame | None = None) -> DataFrame:
    """As ``parent_company_peers_family``, by zip code of the reports."""
    sr = (lt.site_report if reports is None else reports).select(ENTITY, "report_year", "location_zip")
    hz = first_group(sr, "location_zip", spine, latest)
    rates = rates if rates is not None else entity_rates(lt, spine, windows)
    return peer_average(hz, rates, "location_zip", windows,
                        {"v": "avg_violation_zip", "c": "avg_complaint_zip", "f": "avg_formal_enforcement_zip"}, by_entity, keys)


def feat_zip_peers(lt, cohort: DataFrame, spine: DataFrame, windows=ALL_WINDOWS, latest: bool = False,
                   rates: DataFrame | None = None) -> DataFrame:
    return _onto_cohort(cohort, zip_peers_family(lt, spine, windows, latest, rates))


# --- F10 ----------------------------------------------------------------------
def feat_geographic(lt, cohort: DataFrame, spine: DataFrame, as_of: bool = False) -> DataFrame:
    """Land type (max over the entity's inspections, none -> 'O') and
    state district (max over its reports).

    Literal mode uses all years, including years after the as-of date;
    ``as_of=True`` only years up to the window end.
    """
    i = lt.inspections.select(ENTITY, F.year("evaluation_start_date").alias("year"), "land_type")
    s = lt.site_report.select(ENTITY, F.col("report_year").alias("year"), "state_district")
    if as_of:
        years = lambda: F.explode(label_years_from(spine, "year")).alias("label_year")
        lt_ = i.select("*", years()).groupBy(ENTITY, "label_year").agg(F.max("land_type").alias("_lt"))
        st_ = s.select("*", years()).groupBy(ENTITY, "label_year").agg(F.max("state_district").alias("_sd"))
        j = cohort.join(lt_, [ENTITY, "label_year"], "left").join(st_, [ENTITY, "label_year"], "left")
    else:
        return onto_geographic(cohort, i, s)
    return j.withColumn("land_type_most_recent", F.coalesce(F.col("_lt"), F.lit("O"))) \
            .withColumn("state_district_most_recent", F.col("_sd")).drop("_lt", "_sd")


def onto_geographic(cohort: DataFrame, land_types: DataFrame, districts: DataFrame) -> DataFrame:
    """``cohort`` with the greatest land type ('O' without any) and district
    of each entity, of all rows given."""
    lt_ = land_types.groupBy(ENTITY).agg(F.max("land_type").alias("_lt"))
    st_ = districts.groupBy(ENTITY).agg(F.max("state_district").alias("_sd"))
    j = cohort.join(lt_, ENTITY, "left").join(st_, ENTITY, "left")
    return j.withColumn("land_type_most_recent", F.coalesce(F.col("_lt"), F.lit("O"))) \
            .withColumn("state_district_most_recent", F.col("_sd")).drop("_lt", "_sd")


# --- shared inspection aggregate --------------------------------------------------------
def inspection_family(pre: DataFrame, spine: DataFrame, windows=ALL_WINDOWS, keys: DataFrame | None = None) -> DataFrame:
    """All inspection-based partials summed per window: F1 counts,
    F2 shares and the entity rates behind the peer averages are derived
    from this aggregate of ``inspection_partials`` (of ``keys`` alone, if given)."""
    return window_sums(pre, spine, windows, _violation_partials()[0], keys=keys)


def f1_f2_columns(windows=ALL_WINDOWS) -> list[str]:
    """SQL select list of F1 counts and F2 shares over ``inspection_family``."""
    return [f"n__{w} AS inspection_num_{w}" for w in windows] + [c for w in windows for c in _f2_sql(w)]


def rates_from(s: DataFrame, windows=ALL_WINDOWS) -> DataFrame:
    cols = []
    for w in windows:
        cols += [f"{_ratio('n_violation', 'n', w)} AS v__{w}",
                 f"{_ratio('n_complaint', 'n', w)} AS c__{w}",
                 f"{_ratio('n_formal', 'n', w)} AS f__{w}"]
    return s.selectExpr(ENTITY, "label_year", *cols)


# --- F13 registered form -----------------------------------------------------------
def window_features_single_pass(lt, cohort: DataFrame, spine: DataFrame, windows=ALL_WINDOWS) -> DataFrame:
    """Inspection counts and violation shares for every window and label
    year from one scan of the inspections."""
    s = window_sums(inspection_partials(lt), spine, windows, _violation_partials()[0])
    cols = []
    for w in windows:
        cols += [f"n__{w} AS inspection_num_{w}",
                 f"{_ratio('n_violation', 'n', w)} AS violation_per_inspection_{w}",
                 f"{_ratio('n_complaint', 'n', w)} AS complaint_per_inspection_{w}",
                 f"{_ratio('n_formal', 'n', w)} AS formal_enforcement_per_inspection_{w}",
                 f"penalty_sum__{w} AS sum_penalty_amount_{w}"]
    return _onto_cohort(cohort, s.selectExpr(ENTITY, "label_year", *cols))
