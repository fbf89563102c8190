"""Hyper-parameter grids as DataFrames.

A grid is a tiny frame (one row per model) bounded by the product of the
configured value lists; it is built with ``explode`` over literal arrays
and broadcast where it joins model outputs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# --- G1 -----------------------------------------------------------------------
def grid_expand(base: DataFrame, params: Mapping[str, Sequence[str]], model_type: str,
                base_param: str) -> DataFrame:
    """Cartesian product of parameter value lists.

    ``base`` holds the values of ``base_param`` (one column); every other
    parameter is a literal list.  The model index runs with the last
    parameter varying fastest; ``model_name = <type>_<index>`` and
    ``model_param = 'k=v;k=v'``.
    """
    names = [base_param, *params]
    g = base.select(F.col(base_param).cast("string").alias(base_param))
    for k, vals in params.items():
        g = g.withColumn(k, F.explode(F.array(*[F.lit(str(v)) for v in vals])))
    # position of each value inside its list, for the index
    g = g.withColumn("_b", F.dense_rank().over(Window.orderBy(base_param)) - 1)
    idx = F.col("_b")
    for k, vals in params.items():
        pos = F.array_position(F.array(*[F.lit(str(v)) for v in vals]), F.col(k)) - 1
        idx = idx * F.lit(len(vals)) + pos
    g = g.withColumn("model_index", idx.cast("int"))
    return g.select(
        F.lit(model_type).alias("model_type"),
        F.concat(F.lit(model_type + "_"), F.col("model_index").cast("string")).alias("model_name"),
        "model_index", *names,
        F.concat_ws(";", *[F.concat(F.lit(f"{k}="), F.col(k)) for k in names]).alias("model_param"))


# --- G2 -----------------------------------------------------------------------
def grid_zip(lists: DataFrame, group_cols: Sequence[str], key_col: str = "param",
             values_col: str = "values") -> DataFrame:
    """Imported grid: the i-th value of every parameter list forms model i.

    ``lists``: (group..., param, values ARRAY) -- one row per parameter.
    A list of one value holds for every model of its group; all others must
    have equal length (checked: the ``length_ok`` column).
    Output: (group..., model_index, params MAP).
    """
    g = list(group_cols)
    n = F.size(values_col)
    longest = F.max(n).over(Window.partitionBy(*g))
    spread = lists.withColumn("_n", longest).withColumn(
        values_col, F.when(n == 1, F.array_repeat(F.get(values_col, F.lit(0)), F.col("_n"))).otherwise(F.col(values_col)))
    exploded = spread.select(*g, key_col, F.posexplode(values_col).alias("model_index", "value"))
    sizes = spread.groupBy(*g).agg((F.min(n) == F.max(n)).alias("length_ok"))
    models = exploded.groupBy(*g, "model_index").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(key_col), F.col("value"))))).alias("params"))
    return models.join(sizes, g, "inner")


# --- G3 -----------------------------------------------------------------------
def params_with_defaults(params: Column, defaults: Mapping[str, str]) -> Column:
    """Defaults overridden by given values; "None" becomes NULL; keys not
    among the defaults are ignored."""
    d = F.create_map(*[x for k, v in defaults.items() for x in (F.lit(k), F.lit(v))])
    known = F.map_filter(params, lambda k, v: F.array_contains(F.map_keys(d), k))
    merged = F.map_zip_with(d, known, lambda k, dv, gv: F.coalesce(gv, dv))
    return F.transform_values(merged, lambda k, v: F.when(v != F.lit("None"), v))


# --- G5 -----------------------------------------------------------------------
def best_so_far(results: DataFrame, group_cols: Sequence[str] = ("eval_year",),
                order_col: str = "model_index", value_col: str = "precision") -> DataFrame:
    """Running best value while the grid is evaluated in index order.

    The window is partitioned by evaluation year and holds one row per
    model: bounded by the grid size, not by the data."""
    w = Window.partitionBy(*group_cols).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    return results.withColumn(f"best_{value_col}_so_far", F.max(value_col).over(w))
