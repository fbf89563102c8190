"""Registered queries: one callable (spark, sf_dir) -> DataFrame per
inventory item.  Defaults: label years 1997-1999 (train) and 1998-2000
(validation), five-year look-back, k = 21 %.

Results round DOUBLE columns to 6 decimals (engines sum doubles in
different orders); the library functions themselves are exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from hazrank.config import DEFAULT_TIMELINE, Timeline
from hazrank.sources.mapping import LogicalTables
from hazrank.sources.tables import Warehouse

K_DEFAULT = 0.21
REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Half-up rounding of every DOUBLE column (one selectExpr)."""
    from hazrank.functions.columns import round_half_up_sql
    cols = [f"{round_half_up_sql(_q(f.name), digits)} AS {_q(f.name)}"
            if isinstance(f.dataType, (DoubleType, FloatType)) else _q(f.name) for f in df.schema.fields]
    return df.selectExpr(*cols)


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


class Ctx:
    """Per-query context: warehouse, logical tables bounded to the years
    the timeline needs (pushed to the scan), and the year spine."""

    def __init__(self, spark: SparkSession, sf_dir: str, tl: Timeline = DEFAULT_TIMELINE,
                 bounded: bool = True):
        from hazrank.session import configure
        from hazrank.plans.timeline import config_spine
        configure(spark)
        self.spark = spark
        self.tl = tl
        self.wh = _warehouse(spark, sf_dir)
        lo = min(tl.label_years()) - 1 - tl.lookback
        hi = max(tl.label_years())
        self.lt_all = LogicalTables(self.wh)  # of this query alone
        self.lt = self.lt_all.bounded(lo, hi) if bounded else self.lt_all
        # the years of the feature windows, which end before the last label year
        self.lt_windows = self.lt_all.bounded(lo, hi - 1) if bounded else self.lt_all
        # all years before the last label year, for as-of tables
        self.lt_upto = self.lt_all.bounded(None, hi - 1)
        self.spine = config_spine(spark, tl)

    def partials(self):
        """The yearly partials of every source, stored by entity; once per
        query.  Four of the sources start from the order lines, which are joined
        and stored first.  The tables are opened in a session that joins by
        hashing where a join's measured sides allow it."""
        from hazrank.plans.matrix import hashing_session, partials, store_lines, store_partials
        if "_partials" not in self.__dict__:
            wh = Warehouse(hashing_session(self.spark), self.wh.location, self.wh.fmt)
            lines = store_lines(LogicalTables(wh).order_lines)
            windows, every = (LogicalTables(wh, lt.year_bounds, lines) for lt in (self.lt_windows, self.lt_all))
            self.__dict__["_partials"] = store_partials(partials(windows, every))
        return self.__dict__["_partials"]

    @property
    def val_spine(self) -> DataFrame:
        return self.spine.where("is_val")


_WAREHOUSES: dict[tuple[int, str], Warehouse] = {}


def _warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """One opened warehouse per session and folder: table scans (lazy
    DataFrames) are shared by the queries instead of re-reading footers."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir)
    wh = _WAREHOUSES.get(key)
    if wh is None or wh.spark is not spark:
        wh = _WAREHOUSES[key] = Warehouse(spark, sf_dir)
    return wh


def ctx(spark, sf_dir) -> Ctx:
    return Ctx(spark, sf_dir)
