"""Registered queries: timeline, cohorts, labels, minimum slice."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazrank.operators import ranking as R
from hazrank.plans import cohorts as C
from hazrank.plans import features as FT
from hazrank.plans import labels as L
from hazrank.plans import timeline as T
from hazrank.queries import K_DEFAULT, ctx, register, rounded


@register("timeline_spine")
def q_timeline_spine(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return T.timeline_spine(c.lt_all, c.tl)


@register("lookback_windows")
def q_lookback_windows(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return T.lookback_windows(T.timeline_spine(c.lt_all, c.tl))


@register("temporal_folds")
def q_temporal_folds(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return T.temporal_folds(T.timeline_spine(c.lt_all, c.tl))


@register("split_dates")
def q_split_dates(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return T.split_dates(T.timeline_spine(c.lt_all, c.tl))


@register("cohort_active")
def q_cohort_active(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return C.cohort_active(c.lt, c.spine)


@register("cohort_train")
def q_cohort_train(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return C.cohort_train(c.lt, c.spine)


@register("cohort_train_with_history")
def q_cohort_train_with_history(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return C.cohort_train_with_history(c.lt, c.spine)


@register("cohort_val_with_history")
def q_cohort_val_with_history(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return C.cohort_val_with_history(c.lt, c.spine)


@register("cohort_val_without_history")
def q_cohort_val_without_history(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return C.cohort_val_without_history(c.lt, c.spine)


@register("cohort_route")
def q_cohort_route(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return C.cohort_route(c.lt, c.spine)


@register("cohort_sizes")
def q_cohort_sizes(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return C.cohort_sizes(c.lt, c.val_spine, L.label_formal)


@register("label_formal")
def q_label_formal(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return L.label_formal(c.lt, C.cohort_active(c.lt, c.spine), c.spine)


@register("label_formal_listed")
def q_label_formal_listed(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return L.label_formal_listed(c.lt, C.cohort_active(c.lt, c.spine), c.spine)


def history_baseline_scores(c, model_id: str = "bl_inspections"):
    """Baseline score: inspection rows in the five-year window, for the
    with-history validation cohort; labels literal."""
    sp = c.val_spine
    coh = C.cohort_val_with_history(c.lt, sp)
    feats = FT.feat_inspection_history(c.lt, coh, sp, ("total",))
    scores = feats.select(F.lit(model_id).alias("model_id"), F.col("label_year").alias("eval_year"),
                          "handler_id", F.coalesce(F.col("inspection_num_total"), F.lit(0)).cast("double")
                          .alias("score"))
    labels = L.label_formal(c.lt, coh, sp).select(F.col("label_year").alias("eval_year"), "handler_id", "formal")
    return scores, labels


@register("rank_scores")
def q_rank_scores(spark, sf_dir):
    c = ctx(spark, sf_dir)
    scores, labels = history_baseline_scores(c)
    return R.rank_scores(scores, labels)


@register("precision_support_recall_at_k")
def q_precision_support_recall_at_k(spark, sf_dir):
    c = ctx(spark, sf_dir)
    scores, labels = history_baseline_scores(c)
    return rounded(R.precision_at_k(scores, labels, K_DEFAULT, materialize_labels=True)
                   .select("model_id", "eval_year", "ranked", "i", "labelled_at_k", "positives_at_k",
                           "all_positives", "precision", "support", "recall"))
