"""Model selection over grid results.

Results are long frames (model, eval_year, precision, support) --
``grid_result_record`` builds the one-record-per-model form with
';'-joined values and 'k=v;k=v' parameters, ``parse_overtime`` reads it
back.  All operators are per-row expressions or small aggregates over
the (bounded) set of models.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fmt6(x: Column) -> Column:
    """Fixed 6-decimal text of the half-up rounded value, 'nan' when missing."""
    from hazrank.functions.columns import round_half_up
    # format_string renders NULL as the text 'null', so test explicitly
    return F.when(x.isNull(), F.lit("nan")).otherwise(F.format_string("%.6f", round_half_up(x, 6)))


# --- S8 / G6 ------------------------------------------------------------------
def grid_result_record(results: DataFrame, id_cols: Sequence[str] = ("model_type", "model_name", "model_param"),
                       year_col: str = "eval_year") -> DataFrame:
    """One record per model: precision and support over the years joined
    by ';' in year order."""
    ids = list(id_cols)
    agg = results.groupBy(*ids).agg(
        F.array_sort(F.collect_list(F.struct(F.col(year_col), fmt6(F.col("precision")).alias("p"),
                                             fmt6(F.col("support")).alias("s")))).alias("_v"))
    return agg.select(*ids,
                      F.concat_ws(";", F.transform("_v", lambda x: x["p"])).alias("precision_overtime"),
                      F.concat_ws(";", F.transform("_v", lambda x: x["s"])).alias("support_overtime"))


def grid_results_wide(results: DataFrame, years: Sequence[int], id_cols: Sequence[str] = ("model_type", "model_name"),
                      year_col: str = "eval_year") -> DataFrame:
    """model x (precision_<year>, support_<year>) by conditional aggregation."""
    aggs = []
    for y in years:
        aggs.append(F.max(F.when(F.col(year_col) == y, F.col("precision"))).alias(f"precision_{y}"))
    for y in years:
        aggs.append(F.max(F.when(F.col(year_col) == y, F.col("support"))).alias(f"support_{y}"))
    return results.groupBy(*id_cols).agg(*aggs)


# --- D2 -----------------------------------------------------------------------
def parse_overtime(df: DataFrame, name: str, years: Sequence[int]) -> DataFrame:
    """Split '<name>_overtime' ('a;b;...') into DOUBLE columns <name>_<year>;
    'nan' and unparsable parts become NULL."""
    parts = F.split(F.col(f"{name}_overtime"), ";")
    cols = []
    for i, y in enumerate(years):
        v = F.get(parts, i)
        cols.append(F.when(F.lower(v) != "nan", v.try_cast("double")).alias(f"{name}_{y}"))
    return df.select("*", *cols)


# --- D3 -----------------------------------------------------------------------
def avg_overtime(df: DataFrame, name: str, years: Sequence[int]) -> DataFrame:
    """Row mean that is missing as soon as one year is missing."""
    total = None
    for y in years:
        total = F.col(f"{name}_{y}") if total is None else total + F.col(f"{name}_{y}")
    return df.withColumn(f"avg_{name}", total / F.lit(float(len(years))))


# --- D4 -----------------------------------------------------------------------
def filter_by_support(df: DataFrame, cutoff: float = 0.5, partition_cols: Sequence[str] = ()) -> DataFrame:
    """The models whose average support reaches the cutoff, with
    ``n_dropped``: how many of their group (all models, or those equal in
    ``partition_cols``) do not.  Missing support counts as not reached.  One
    row per model, bounded by the grid."""
    kept = F.coalesce(F.col("avg_support") >= F.lit(cutoff), F.lit(False))
    group = Window.partitionBy(*partition_cols) if partition_cols else Window.partitionBy(F.lit(0))
    return df.withColumn("n_dropped", F.sum(F.when(kept, 0).otherwise(1)).over(group)).where(kept)


# --- D5 -----------------------------------------------------------------------
def rank_models_avg(df: DataFrame, years: Sequence[int], partition_cols: Sequence[str] = ()) -> DataFrame:
    """Rank by average precision, then precision of the latest year back to
    the earliest, all descending with missing values last; model name
    breaks remaining ties."""
    order = [F.col("avg_precision").desc_nulls_last()] + \
            [F.col(f"precision_{y}").desc_nulls_last() for y in sorted(years, reverse=True)] + \
            [F.col("model_name").asc()]
    w = Window.partitionBy(*partition_cols).orderBy(*order) if partition_cols else Window.orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w))


# --- D6 -----------------------------------------------------------------------
def rank_models_discounted(df: DataFrame, years: Sequence[int], partition_cols: Sequence[str] = ()) -> DataFrame:
    """Weights 1, 1/2, 1/4, ... from the latest year back, normalised to
    sum 1; rank by the weighted precision."""
    ys = sorted(years, reverse=True)
    weights = [0.5 ** i for i in range(len(ys))]
    total = sum(weights)
    expr = None
    for y, wt in zip(ys, weights):
        term = F.col(f"precision_{y}") * F.lit(wt) / F.lit(total)
        expr = term if expr is None else expr + term
    d = df.withColumn("discounted_precision", expr)
    order = [F.col("discounted_precision").desc_nulls_last(), F.col("model_name").asc()]
    w = Window.partitionBy(*partition_cols).orderBy(*order) if partition_cols else Window.orderBy(*order)
    return d.withColumn("rank", F.row_number().over(w))


# --- D7 -----------------------------------------------------------------------
def take_top_n(ranked: DataFrame, n: int, with_history: bool | None = None) -> DataFrame:
    out = ranked.where(F.col("rank") <= n)
    if with_history is not None:
        out = out.withColumn("with_history", F.lit(with_history))
    return out.select("model_type", "model_name", "model_param", "with_history", "rank")


# --- G7 -----------------------------------------------------------------------
def param_map(model_param: Column) -> Column:
    """'k=v;k=v' (optionally quoted) -> MAP<STRING,STRING>."""
    return F.str_to_map(F.regexp_replace(model_param, "^'|'$", ""), F.lit(";"), F.lit("="))


def grid_from_selection(selected: DataFrame, group_cols: Sequence[str] = ("model_type", "with_history")) -> DataFrame:
    """Selected models -> one row per (group, parameter) with the values in
    rank order (the importable grid)."""
    g = list(group_cols)
    e = selected.select(*g, "rank", F.explode(param_map(F.col("model_param"))).alias("param", "value"))
    agg = e.groupBy(*g, "param").agg(F.array_sort(F.collect_list(F.struct("rank", "value"))).alias("_v"))
    return agg.select(*g, "param", F.transform("_v", lambda x: x["value"]).alias("values"))


# Parameters by type, as the grids name them.  All others are
# texts.
INT_PARAMS = ("num_boost_round", "gamma", "min_child_weight", "nthread", "n_estimators", "min_samples_split",
              "min_samples_leaf", "verbose", "random_state", "seed", "max_iter", "n_jobs")
FLOAT_PARAMS = ("eta", "subsample", "lambda", "alpha", "max_samples", "colsample_bytree", "colsample_bylevel",
                "colsample_bynode", "min_weight_fraction_leaf", "min_impurity_decrease", "tol", "C", "l1_ratio",
                "learning_rate", "reg_alpha", "reg_lambda")
OPTIONAL_INT_PARAMS = ("max_depth",)  # or "none"
BOOL_PARAMS = ("bootstrap", "fit_intercept", "with_history")
TRUE_TEXTS = ("yes", "true", "t", "y", "1")
FALSE_TEXTS = ("no", "false", "f", "n", "0")


def typed_values(param: Column, value: Column) -> list[Column]:
    """A parameter's text as its type: ``type`` and the columns ``int_value``,
    ``double_value``, ``bool_value``, ``string_value``, of which at most one is
    set, and ``type_ok``: could the text be read?  "none" of an optional
    parameter is read as no value; a float without fraction is an int."""
    kind = (F.when(param.isin(*INT_PARAMS), "int").when(param.isin(*FLOAT_PARAMS), "double")
            .when(param.isin(*OPTIONAL_INT_PARAMS), "optional int").when(param.isin(*BOOL_PARAMS), "bool").otherwise("string"))
    number = value.try_cast("double")
    whole = F.when(number == F.floor(number), number.try_cast("long"))
    none = F.lower(F.trim(value)) == "none"
    low = F.lower(F.trim(value))
    truth = F.when(low.isin(*TRUE_TEXTS), F.lit(True)).when(low.isin(*FALSE_TEXTS), F.lit(False))
    as_int = F.when((kind == "int") | ((kind == "optional int") & ~none), whole)
    as_double, as_bool, as_text = F.when(kind == "double", number), F.when(kind == "bool", truth), F.when(kind == "string", value)
    ok = as_int.isNotNull() | as_double.isNotNull() | as_bool.isNotNull() | as_text.isNotNull() | ((kind == "optional int") & none)
    return [kind.alias("type"), as_int.alias("int_value"), as_double.alias("double_value"), as_bool.alias("bool_value"),
            as_text.alias("string_value"), F.coalesce(ok, F.lit(False)).alias("type_ok")]


def typed_grid(selected: DataFrame, group_cols: Sequence[str] = ("model_type", "with_history")) -> DataFrame:
    """Selected models -> one row per model and parameter, its value in typed
    columns, in rank order: the grid to run again."""
    g = list(group_cols)
    e = selected.select(*g, "model_name", "rank", F.explode(param_map(F.col("model_param"))).alias("param", "value"))
    return e.select("*", *typed_values(F.col("param"), F.col("value")))


def grid_of(typed: DataFrame) -> list[tuple[str, str, dict]]:
    """The typed rows as the grid that models are fitted from: (model type,
    model name, parameters), by rank.  One entry per selected model.  A value
    that its type cannot hold is an error."""
    rows = typed.select("model_type", "model_name", "rank", "param", "value", "type_ok", "int_value", "double_value", "bool_value", "string_value").collect()
    bad = sorted({(r["param"], r["value"]) for r in rows if not r["type_ok"]})
    if bad:
        raise ValueError(f"values that are not of their parameter's type: {bad}")
    models: dict[tuple, dict] = {}
    for r in rows:
        found = [r[c] for c in ("int_value", "double_value", "bool_value", "string_value") if r[c] is not None]
        models.setdefault((r["rank"], r["model_type"], r["model_name"]), {})[r["param"]] = found[0] if found else None
    return [(t, n, p) for (_, t, n), p in sorted(models.items(), key=lambda x: x[0])]
