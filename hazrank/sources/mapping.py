"""Logical tables of the risk model, derived from the star schema.

The risk model reads inspections (one row per evaluation x violation x
enforcement), yearly site reports, owners, NAICS codes, waste pages and
their waste codes, plus a facility list and an income table for
fairness audits.  The test warehouse only has TPC-H-like tables, so each
logical table is a deterministic projection of them (entity = customer).

All derivations are lazy DataFrame expressions.  The large ones share
``order_lines`` (orders joined to lineitem on the order key); Spark
reuses that exchange inside one query.  None of the joins carries a
broadcast hint: dimension sides (nation, part, supplier, customer) are
broadcast by the planner only when their measured size is under
``spark.sql.autoBroadcastJoinThreshold``, otherwise sort-merge joined.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values of the test mapping ---------------------------------------
URGENT_PRIORITY = "1-URGENT"
NY_NATION_LIMIT = 20                      # c_nationkey < 20 -> 'NY' else 'NJ'
DISPOSITION_BY_LINE = {1: "AS", 2: "DR", 3: "DS", 4: "PC", 5: "PR", 6: "RI"}  # 7 -> NULL
EVALUATION_BY_LINE = {1: "CDI", 2: "CSE", 3: "FUI"}                          # else 'CEI'
WASTE_MIN_BY_SUPPKEY_MOD8 = {0: "N", 1: "X", 2: "A", 3: "B", 4: "C", 5: "D", 6: "Z"}  # 7 -> NULL
DENSITY_UNIT_BY_RETURNFLAG = {"A": "1", "R": "2", "N": "0"}
VIOLATION_DESCRIPTIONS = (
    ("FEA", "financial assurance requirements"),
    ("262.A", "generator waste determination"),
    ("265.C", "preparedness and prevention"),
)
# -----------------------------------------------------------------------------


def _case(col: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def _state(nationkey: Column) -> Column:
    return F.when(nationkey < NY_NATION_LIMIT, F.lit("NY")).otherwise(F.lit("NJ"))


def _yn(cond: Column) -> Column:
    return F.when(cond, F.lit("Y")).otherwise(F.lit("N"))


def _ynnull(mod3: Column) -> Column:
    return F.when(mod3 == 0, F.lit("Y")).when(mod3 == 1, F.lit("N"))


class LogicalTables:
    """Lazily derived logical tables over a ``Warehouse``."""

    def __init__(self, wh, year_bounds: tuple[int | None, int] | None = None, lines: DataFrame | None = None):
        self.wh = wh
        self.spark = wh.spark
        self.year_bounds = year_bounds
        self.lines = lines

    def bounded(self, lo: int | None, hi: int) -> "LogicalTables":
        """Same tables restricted to report/event years lo..hi, or up to hi
        if ``lo`` is None.

        The bound is a literal range on the raw order date, so it reaches
        the parquet scan as a pushed filter (a ``year()`` predicate would
        not be pushed).
        """
        return LogicalTables(self.wh, (lo, hi), self.lines)

    def over(self, lines: DataFrame) -> "LogicalTables":
        """Same tables over ``order_lines`` of all years that were stored, so
        that tables which start from them share one join."""
        return LogicalTables(self.wh, self.year_bounds, lines)

    @cached_property
    def orders(self) -> DataFrame:
        return self._in_years(self.wh.orders)

    def _in_years(self, o: DataFrame) -> DataFrame:
        if self.year_bounds is None:
            return o
        lo, hi = self.year_bounds
        t = o.schema["o_orderdate"].dataType.simpleString()
        hi_lit = F.lit(f"{hi + 1:04d}-01-01 00:00:00").cast(t)
        o = o.where(F.col("o_orderdate") < hi_lit)
        return o if lo is None else o.where(F.col("o_orderdate") >= F.lit(f"{lo:04d}-01-01 00:00:00").cast(t))

    # -- shared building blocks ----------------------------------------------
    @cached_property
    def order_lines(self) -> DataFrame:
        if self.lines is not None:
            return self._in_years(self.lines)
        o = self.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        li = self.wh.lineitem.select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice",
            (F.col("l_discount") + F.lit(0.0)).alias("l_discount"),
            (F.col("l_tax") + F.lit(0.0)).alias("l_tax"),
            "l_returnflag", "l_linestatus")
        return o.join(li, o.o_orderkey == li.l_orderkey, "inner")

    # -- inspections (evaluation x violation x enforcement rows) -------------
    @cached_property
    def _inspection_rows(self) -> DataFrame:
        ol = self.order_lines.where(F.col("o_orderpriority") == URGENT_PRIORITY)
        rf, ls, q = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_quantity")
        tax, ln = F.col("l_tax"), F.col("l_linenumber")
        return ol.select(
            F.col("o_custkey").alias("handler_id"),
            F.col("o_orderdate").cast("date").alias("evaluation_start_date"),
            F.when((rf == "A") & (q > 40), F.lit("310"))
             .when((rf == "R") & (ls == "F") & (q > 25), F.lit("100")).alias("enforcement_type"),
            _yn(rf == "R").alias("found_violation_flag"),
            _yn(ls == "O").alias("citizen_complaint_flag"),
            _case(ln, DISPOSITION_BY_LINE).alias("disposition_status"),
            F.when(F.col("l_discount") >= 0.08,
                   F.col("l_extendedprice") * tax).alias("final_amount"),
            _case(ln, EVALUATION_BY_LINE, "CEI").alias("evaluation_type"),
            F.when(tax >= 0.06, F.lit("FEA")).when(tax >= 0.03, F.lit("262.A"))
             .when(tax >= 0.01, F.lit("265.C")).alias("violation_type"),
        )

    @cached_property
    def inspections_core(self) -> DataFrame:
        """Inspections without the entity attributes (state, land type).

        The attributes come from a lookup on the entity key, which always
        matches; consumers that need no attribute use this projection and
        skip that join (at scale a shuffle of every inspection row)."""
        return self._inspection_rows

    @cached_property
    def inspections(self) -> DataFrame:
        c = self.wh.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
        j = self._inspection_rows.join(c, F.col("handler_id") == c.c_custkey, "inner")
        seg1 = F.substring("c_mktsegment", 1, 1)
        return j.select(
            "handler_id", _state(F.col("c_nationkey")).alias("state"), "evaluation_start_date",
            "enforcement_type", "found_violation_flag", "citizen_complaint_flag", "disposition_status",
            "final_amount", "evaluation_type", "violation_type",
            F.when(seg1 != "H", seg1).alias("land_type"))

    # -- yearly site report (one row per entity and year) -------------------
    @cached_property
    def site_report(self) -> DataFrame:
        ey = (self.orders
              .select(F.col("o_custkey").alias("handler_id"),
                      F.year("o_orderdate").alias("report_year"))
              .distinct())
        c = self.wh.customer.select("c_custkey", "c_nationkey")
        n = self.wh.nation.select("n_nationkey", "n_regionkey")
        j = ey.join(c, ey.handler_id == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
        base = F.col("handler_id") + F.col("report_year")
        flags = [_ynnull((base + F.lit(j)) % 3).alias(name)
                 for j, name in enumerate(("importer_activity", "mixed_waste_generator",
                                           "transporter", "transfer_facility",
                                           "tsd_activity", "recycler_activity"))]
        return j.select(
            "handler_id", "report_year",
            F.col("n_regionkey").cast("string").alias("state_district"),
            F.col("c_nationkey").cast("string").alias("location_zip"),
            *flags)

    @cached_property
    def report_keys(self) -> DataFrame:
        """Distinct (handler_id, report_year) of the site reports, without
        the dimension lookups (which always match)."""
        return (self.orders.select(F.col("o_custkey").alias("handler_id"),
                                   F.year("o_orderdate").alias("report_year"))
                .distinct())

    # -- owners / operators per entity and year -----------------------------
    @cached_property
    def owner(self) -> DataFrame:
        ol = self.order_lines.where(F.col("l_linenumber") <= 2)
        g = (ol.groupBy(F.col("o_custkey").alias("handler_id"),
                        F.year("o_orderdate").alias("report_year"),
                        "l_suppkey", "l_linenumber")
             .agg(F.min("o_orderdate").cast("date").alias("date_became_current")))
        s = self.wh.supplier.select("s_suppkey", "s_name")
        return g.join(s, g.l_suppkey == s.s_suppkey).select(
            "handler_id", "report_year",
            F.col("s_name").alias("owner_operator_name"),
            F.when(F.col("l_linenumber") == 1, F.lit("CO")).otherwise(F.lit("CP"))
             .alias("owner_operator_indicator"),
            "date_became_current")

    # -- NAICS codes ---------------------------------------------------------
    @cached_property
    def naics(self) -> DataFrame:
        return self.site_report.select(
            "handler_id", "report_year", F.lit("1").alias("naics_seq"),
            F.concat(F.lpad("location_zip", 2, "0"), F.lit("1110")).alias("naics_code"))

    # -- waste pages (gm1) and their codes (gm2) ----------------------------
    @cached_property
    def waste(self) -> DataFrame:
        ol = self.order_lines
        return ol.select(
            F.col("o_custkey").alias("handler_id"),
            F.year("o_orderdate").alias("report_year"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("hz_pg"),
            _case(F.col("l_suppkey") % 8, WASTE_MIN_BY_SUPPKEY_MOD8).alias("waste_min_code"),
            _yn(F.col("l_linestatus") == "F").alias("on_site_management"),
            F.col("l_linenumber").cast("string").alias("unit_of_measure"),
            F.col("l_quantity").alias("gen_qty"),
            (F.lit(1.0) + F.col("l_discount")).alias("wst_density"),
            _case(F.col("l_returnflag"), DENSITY_UNIT_BY_RETURNFLAG).alias("density_unit_of_measure"),
        )

    @cached_property
    def waste_code(self) -> DataFrame:
        ol = self.order_lines.where(F.col("l_returnflag") != "N")
        p = self.wh.part.select("p_partkey", "p_size")
        return ol.join(p, ol.l_partkey == p.p_partkey).select(
            F.col("o_custkey").alias("handler_id"),
            F.year("o_orderdate").alias("report_year"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("hz_pg"),
            F.concat(F.lit("D0"), F.lpad(F.col("p_size").cast("string"), 2, "0")).alias("epa_waste_code"))

    # -- facilities, waste reports, violation lookup ------------------------
    @cached_property
    def facilities(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.wh.customer.select(
            k.alias("id_number"),
            _state(F.col("c_nationkey")).alias("activity_location"),
            F.col("c_mktsegment").alias("fed_waste_generator"),
            _yn(k % 2 == 0).alias("transporter"),
            _yn(k % 3 == 0).alias("active_site"),
            _yn(k % 5 == 0).alias("operating_tsdf"))

    @cached_property
    def waste_report(self) -> DataFrame:
        w = self.waste
        c = self.wh.customer.select("c_custkey", "c_nationkey")
        return w.join(c, w.handler_id == c.c_custkey).select(
            "handler_id", _state(F.col("c_nationkey")).alias("state"),
            F.col("waste_min_code").alias("waste_code_group"),
            F.col("unit_of_measure").alias("management_method"))

    @cached_property
    def violation_info(self) -> DataFrame:
        return self.spark.createDataFrame(
            list(VIOLATION_DESCRIPTIONS), "violation_type string, violation_short_description string")

    # -- income groups for fairness audits ----------------------------------
    @cached_property
    def income(self) -> DataFrame:
        """Area income of each entity."""
        return self.wh.customer.select(F.col("c_custkey").alias("handler_id"), F.col("c_acctbal").alias("est_total_income"))

    @cached_property
    def bias_data(self) -> DataFrame:
        """Area income and its two halves (1 = lower half, 2 = upper half).

        The split is an exact ntile(2) over (income, entity).  Its border is
        found by rank selection (``topk``), so nothing is sorted: the lower
        half is the top of the descending negative income.  A missing income
        comes first.
        """
        from hazrank.operators.topk import top_cutoffs, with_top
        rows = self.income.withColumn("_group", F.lit(0)).withColumn(
            "_rank", F.coalesce(-F.col("est_total_income").cast("double"), F.lit(float("inf"))))
        border = top_cutoffs(rows, ["_group"], lambda n: -(-n // 2), "_rank")
        marked = with_top(rows, border, ["_group"], "_low", "_rank")
        return marked.select("handler_id", "est_total_income", F.when(F.col("_low"), F.lit(1)).otherwise(F.lit(2)).alias("income_category"))
