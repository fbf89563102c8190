"""Registered queries: evaluation (E), baseline grid (G), selection (D),
grid records (S8) and the result reshaping of the notebooks (B11-B15,
B19).

The "models" evaluated here are the baseline scorers of the risk model:
each history feature over each look-back window used directly as a
score.  They form a real grid evaluated on the validation years, so
selection and reshaping run on results derived from the tables.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazrank.operators import fairness as FA
from hazrank.operators import grid as G
from hazrank.operators import ranking as R
from hazrank.operators import selection as S
from hazrank.plans import cohorts as C
from hazrank.plans import features as FT
from hazrank.plans import labels as L
from hazrank.plans import timeline as T
from hazrank.queries import K_DEFAULT, ctx, register, rounded
from hazrank.registry_core import history_baseline_scores

# fixed grid of the baseline scorers
GRID_FEATURES = ["inspection_num", "violation_per_inspection", "complaint_per_inspection",
                 "formal_enforcement_per_inspection", "sum_penalty_amount"]
GRID_WINDOWS = list(FT.ALL_WINDOWS)
TOP_N_SELECT = 5
SUPPORT_CUTOFF = 0.2
FINAL_LIST_SIZE = 300


def baseline_grid(c, spine: DataFrame | None = None) -> DataFrame:
    """G1 over (window from the year spine) x (feature list)."""
    win = T.lookback_windows(c.spine if spine is None else spine).select(F.col("window_name").alias("window")) \
        .where(F.col("window").isin(*GRID_WINDOWS)).distinct()
    return G.grid_expand(win, {"feature": GRID_FEATURES}, "baseline", "window")


def grid_scores(c, history: bool | None = None, only: tuple[str, str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(grid, scores(with_history, model_id, eval_year, handler_id, score),
    labels(with_history, eval_year, handler_id, formal)) of one history
    flavour or, by default, of both in one plan; ``only`` a (feature, window)
    scores that model alone."""
    sp = c.val_spine
    coh = C.validation_cohorts(c.lt, sp)
    if history is not None:
        coh = C.cohort_val_with_history(c.lt, sp) if history else C.cohort_val_without_history(c.lt, sp)
        coh = coh.withColumn("history", F.lit(history))
    features, windows = ([only[0]], (only[1],)) if only else (GRID_FEATURES, GRID_WINDOWS)
    wide = FT.window_features_single_pass(c.lt, coh, sp, windows)
    cols = [f"{f}_{w}" for f in features for w in windows]
    long = wide.select(F.col("history").alias("with_history"), "handler_id", F.col("label_year").alias("eval_year"), F.explode(F.array(
        *[F.struct(F.lit(x).alias("feature_col"), F.col(x).cast("double").alias("value")) for x in cols])).alias("_f"))
    grid = baseline_grid(c)
    gk = grid.select("model_name", F.concat("feature", F.lit("_"), "window").alias("feature_col"))
    scores = long.join(F.broadcast(gk), F.col("_f.feature_col") == gk.feature_col).select(
        "with_history", F.col("model_name").alias("model_id"), "eval_year", "handler_id",
        F.coalesce(F.col("_f.value"), F.lit(0.0)).alias("score"))
    labels = L.label_formal(c.lt, coh, sp).select(F.col("history").alias("with_history"),
                                                  F.col("label_year").alias("eval_year"), "handler_id", "formal")
    return grid, scores, labels


#: A ranking, and a labelled year, of one history flavour.
GROUP = ["with_history", "model_id", "eval_year"]
LABEL_KEYS = ["with_history", "eval_year"]


def grid_results_long(c, history: bool | None = None) -> DataFrame:
    """Metrics of every baseline model and year, of one history flavour or of
    both (``with_history``)."""
    key = ("_grid_results", history)
    if key in c.__dict__:
        return c.__dict__[key]
    grid, scores, labels = grid_scores(c, history)
    m = R.precision_at_k(scores, labels, K_DEFAULT, GROUP, LABEL_KEYS, materialize_labels=True)
    out = (m.withColumnRenamed("model_id", "model_name")
              .join(grid.select("model_type", "model_name", "model_index", "model_param"), "model_name"))
    # grid results are one row per model and year: keep them for the
    # selection chain of the same query
    c.__dict__[key] = R.materialize(out)
    return c.__dict__[key]


def val_years(c) -> list[int]:
    lo, hi = c.tl.val_label_range
    return list(range(lo, hi + 1))


@register("grid_expand")
def q_grid_expand(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return baseline_grid(c, T.timeline_spine(c.lt_all, c.tl))


@register("fdr_at_k")
def q_fdr(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return rounded(grid_results_long(c, True).select("model_name", "eval_year", "fdr"))


@register("num_labelled_at_k")
def q_num_labelled(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return grid_results_long(c, True).select("model_name", "eval_year", "labelled_at_k")


@register("precision_recall_curve")
def q_curve(spark, sf_dir):
    c = ctx(spark, sf_dir)
    scores, labels = history_baseline_scores(c)
    scores, labels = R.materialize(scores), R.materialize(labels)
    return rounded(R.precision_recall_curve(R.rank_scores(scores, labels), sizes=R.group_sizes(scores),
                                            positives=R.year_positives(labels)))


def _share_model(c):
    _, scores, labels = grid_scores(c, True, ("violation_per_inspection", "total"))
    return scores.drop("with_history"), labels.drop("with_history")


@register("threshold_classify")
def q_threshold(spark, sf_dir):
    c = ctx(spark, sf_dir)
    s, _ = _share_model(c)
    return rounded(R.threshold_classify(s, 0.5))


@register("confusion_matrix")
def q_confusion(spark, sf_dir):
    """With label order (1, 0): the enforced row and column come first."""
    c = ctx(spark, sf_dir)
    s, labels = _share_model(c)
    j = R.threshold_classify(s, 0.5).join(labels, ["eval_year", "handler_id"], "inner")
    return R.confusion_matrix(j, labels=(1, 0))


@register("income_category")
def q_income_category(spark, sf_dir):
    return ctx(spark, sf_dir).lt_all.bias_data


def flavour_baseline_scores(c) -> tuple[DataFrame, DataFrame]:
    """(scores, labels) of both history groups, each by its own baseline:
    inspections in the window, or years with a report for entities that were
    never inspected in it."""
    sp = c.val_spine
    coh = C.validation_cohorts(c.lt, sp)
    ins = FT.window_sums(_counted(c.lt.inspections_core.select("handler_id", F.year("evaluation_start_date").alias("year"))), sp, ("total",), ["n"])
    rep = FT.window_sums(c.lt.report_keys.select("handler_id", F.col("report_year").alias("year"), F.lit(1).alias("nr")), sp, ("total",), ["nr"])
    keys = ["handler_id", "label_year"]
    n = F.when(F.col("history"), F.col("n__total")).otherwise(F.col("nr__total"))
    scores = coh.join(ins, keys, "left").join(rep, keys, "left").select(
        F.col("history").alias("with_history"), F.when(F.col("history"), "bl_inspections").otherwise("bl_reports").alias("model_id"),
        F.col("label_year").alias("eval_year"), "handler_id", F.coalesce(n, F.lit(0)).cast("double").alias("score"))
    labels = L.label_formal(c.lt, coh, sp).select(F.col("history").alias("with_history"),
                                                  F.col("label_year").alias("eval_year"), "handler_id", "formal")
    return scores, labels


def _counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy("handler_id", "year").agg(F.count(F.lit(1)).alias("n"))


@register("disparity_at_k")
def q_disparity(spark, sf_dir):
    c = ctx(spark, sf_dir)
    scores, labels = flavour_baseline_scores(c)
    return rounded(FA.disparity_at_k(scores, labels, c.lt_all.bias_data, K_DEFAULT, "income_category", 1, GROUP, LABEL_KEYS))


@register("bias_audit")
def q_bias_audit(spark, sf_dir):
    """All grid models x income groups, of both history flavours."""
    c = ctx(spark, sf_dir)
    grid, scores, labels = grid_scores(c)
    out = FA.audit_at_k(scores, labels, c.lt_all.bias_data, K_DEFAULT, "income_category", 1, GROUP, LABEL_KEYS)
    out = out.join(grid.select(F.col("model_name").alias("model_id"), "model_type"), "model_id")
    return rounded(out.select("with_history", F.col("model_id").alias("model_name"), "model_type", "eval_year", "group_name",
                              "precision_k", "recall_disparity", "fdr_ratio", "num_labeled_k", "num_labeled_ref_k"))


@register("proportional_top_n")
def q_proportional(spark, sf_dir):
    c = ctx(spark, sf_dir)
    scores, _ = flavour_baseline_scores(c)
    return FA.proportional_top_n(R.stored(scores), c.lt_all.bias_data, FINAL_LIST_SIZE, "income_category", GROUP)


@register("final_list_by_history")
def q_final_list(spark, sf_dir):
    """The yearly list over both history groups, each ranked by its own
    baseline."""
    both = R.stored(flavour_baseline_scores(ctx(spark, sf_dir))[0])
    return FA.proportional_top_n(both.select("eval_year", "handler_id", "score"),
                                 both.select("handler_id", "eval_year", "with_history"), FINAL_LIST_SIZE,
                                 "with_history", ["eval_year"], group_keys=["eval_year"])


@register("baseline_violations")
def q_baseline_violations(spark, sf_dir):
    """Rank by the number of previous violation rows (five-year window)."""
    c = ctx(spark, sf_dir)
    sp = c.val_spine
    coh = C.cohort_val_with_history(c.lt, sp)
    i = c.lt.inspections_core.where(F.col("found_violation_flag") == "Y")
    pre = i.groupBy("handler_id", F.year("evaluation_start_date").alias("year")).agg(F.count(F.lit(1)).alias("nv"))
    f = coh.join(FT.window_sums(pre, sp, ("total",), ["nv"]), ["handler_id", "label_year"], "left")
    scores = f.select(F.lit("bl_violations").alias("model_id"), F.col("label_year").alias("eval_year"), "handler_id",
                      F.coalesce(F.col("nv__total"), F.lit(0)).cast("double").alias("score"))
    labels = L.label_formal(c.lt, coh, sp).select(F.col("label_year").alias("eval_year"), "handler_id", "formal")
    return rounded(R.precision_at_k(scores, labels, K_DEFAULT).drop("fdr"))


# --- grid results and selection ------------------------------------------------
def records(c, history: bool | None = None) -> DataFrame:
    return S.grid_result_record(grid_results_long(c, history), ("model_type", "model_name", "model_param", "with_history"))


@register("grid_result_sink")
def q_grid_record(spark, sf_dir):
    return records(ctx(spark, sf_dir), True).drop("with_history")


@register("grid_results")
def q_grid_results(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return rounded(S.grid_results_wide(grid_results_long(c, True), val_years(c)))


@register("best_so_far")
def q_best_so_far(spark, sf_dir):
    c = ctx(spark, sf_dir)
    r = grid_results_long(c, True).select("model_name", "model_index", "eval_year", "precision")
    return rounded(G.best_so_far(r))


def union_results(c) -> DataFrame:
    """The records of both history flavours, from one evaluation."""
    return records(c)


def parsed(c) -> DataFrame:
    ys = val_years(c)
    d = S.parse_overtime(S.parse_overtime(union_results(c), "precision", ys), "support", ys)
    return S.avg_overtime(S.avg_overtime(d, "precision", ys), "support", ys)


@register("union_results")
def q_union_results(spark, sf_dir):
    return union_results(ctx(spark, sf_dir))


@register("parse_overtime")
def q_parse(spark, sf_dir):
    c = ctx(spark, sf_dir)
    ys = val_years(c)
    d = S.parse_overtime(S.parse_overtime(union_results(c), "precision", ys), "support", ys)
    return d.drop("precision_overtime", "support_overtime")


@register("avg_overtime")
def q_avg(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return rounded(parsed(c).select("model_name", "with_history", "avg_precision", "avg_support"))


def _filtered(c):
    return S.filter_by_support(parsed(c), SUPPORT_CUTOFF, ["with_history"])


@register("filter_by_support")
def q_filter(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return rounded(_filtered(c).select("model_name", "with_history", "avg_support", "n_dropped"))


@register("rank_models_avg")
def q_rank_avg(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return rounded(S.rank_models_avg(_filtered(c), val_years(c), ["with_history"])
                   .select("model_name", "with_history", "avg_precision", "rank"))


@register("rank_models_discounted")
def q_rank_disc(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return rounded(S.rank_models_discounted(_filtered(c), val_years(c), ["with_history"])
                   .select("model_name", "with_history", "discounted_precision", "rank"))


def _selected(c):
    ranked = S.rank_models_avg(_filtered(c), val_years(c), ["with_history"])
    return S.take_top_n(ranked, TOP_N_SELECT)


@register("take_top_n")
def q_take_top(spark, sf_dir):
    return _selected(ctx(spark, sf_dir))


@register("grid_from_selection")
def q_grid_from_selection(spark, sf_dir):
    """The value lists of the importable grid, with each parameter's type."""
    lists = S.grid_from_selection(_selected(ctx(spark, sf_dir)))
    typed = lists.select("*", F.transform("values", lambda v: F.struct(*S.typed_values(F.col("param"), v))).alias("_t"))
    return typed.select("model_type", "with_history", "param", "values", F.get("_t", F.lit(0))["type"].alias("type"),
                        F.forall("_t", lambda x: x["type_ok"]).alias("type_ok"))


@register("grid_zip")
def q_grid_zip(spark, sf_dir):
    lists = S.grid_from_selection(_selected(ctx(spark, sf_dir)))
    z = G.grid_zip(lists, ["model_type", "with_history"])
    return z.select("model_type", "with_history", "model_index", "length_ok",
                    F.col("params")["window"].alias("window"), F.col("params")["feature"].alias("feature"))


GRID_DEFAULTS = {"window": "total", "feature": "inspection_num", "k": "0.21", "list_size": "None"}


@register("params_with_defaults")
def q_params_defaults(spark, sf_dir):
    sel = _selected(ctx(spark, sf_dir))
    m = G.params_with_defaults(S.param_map(F.col("model_param")), GRID_DEFAULTS)
    return sel.select("model_name", "with_history", *[m[k].alias(k) for k in GRID_DEFAULTS])


# --- notebook reshaping ---------------------------------------------------------------
def _wide(c):
    return S.grid_results_wide(grid_results_long(c, True), val_years(c))


@register("unpivot_results")
def q_unpivot(spark, sf_dir):
    c = ctx(spark, sf_dir)
    w = _wide(c)
    ys = val_years(c)
    return rounded(w.unpivot(["model_name"], [f"precision_{y}" for y in ys], "year_col", "precision")
                   .select("model_name", F.regexp_extract("year_col", r"(\d+)$", 1).cast("int")
                           .alias("validation_year"), "precision"))


@register("unpivot_paired")
def q_unpivot_paired(spark, sf_dir):
    c = ctx(spark, sf_dir)
    w = _wide(c)
    ys = val_years(c)
    arr = F.array(*[F.struct(F.lit(y).alias("validation_year"), F.col(f"precision_{y}").alias("precision"),
                             F.col(f"support_{y}").alias("support")) for y in ys])
    return rounded(w.select("model_name", F.inline(arr)))


@register("model_type_from_name")
def q_model_type(spark, sf_dir):
    c = ctx(spark, sf_dir)
    r = grid_results_long(c, True).select("model_name").distinct()
    parts = F.split("model_name", "_")
    return r.select("model_name", F.get(parts, 0).alias("model_type"),
                    F.get(parts, 1).try_cast("int").alias("model_num"))


@register("top_models_in_year")
def q_top_models(spark, sf_dir):
    from pyspark.sql import Window
    c = ctx(spark, sf_dir)
    y = val_years(c)[-1]
    w = _wide(c).withColumn("rank", F.row_number().over(
        Window.orderBy(F.col(f"precision_{y}").desc_nulls_last(), F.col("model_name"))))
    return rounded(w.where(F.col("rank") <= 10).select("model_name", f"precision_{y}", "rank"))


def base_rates(c) -> DataFrame:
    """B8: share with formal enforcement among active entities inspected in
    the label year (label and cohort year from the spine)."""
    sp = c.val_spine
    coh = C.cohort_active(c.lt, sp)
    lab = L.label_formal(c.lt, coh, sp).where(F.col("formal").isNotNull())
    return lab.groupBy("label_year").agg((F.sum("formal") / F.count(F.lit(1))).alias("base_rate"))


@register("base_rate")
def q_base_rate(spark, sf_dir):
    return rounded(base_rates(ctx(spark, sf_dir)))


@register("append_baselines")
def q_append(spark, sf_dir):
    c = ctx(spark, sf_dir)
    models = grid_results_long(c, True).select("model_name", F.col("eval_year").alias("year"), "precision",
                                               "support")
    br = base_rates(c).select(F.lit("base_rate").alias("model_name"), F.col("label_year").alias("year"),
                              F.col("base_rate").alias("precision"))
    return rounded(models.unionByName(br, allowMissingColumns=True))


@register("transpose_years")
def q_transpose(spark, sf_dir):
    c = ctx(spark, sf_dir)
    r = grid_results_long(c, True)
    names = [f"baseline_{i}" for i in range(len(GRID_FEATURES) * len(GRID_WINDOWS))]
    return rounded(r.groupBy("eval_year").pivot("model_name", names).agg(F.first("precision")))
