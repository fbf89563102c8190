"""Registered queries: model families, temporal cross-validation, model
persistence.

Fitted numbers cannot be stated in SQL, so each query returns what can: the
rows that were scored, the sizes and counts of the evaluation, and checks on the
fitted values (``*_ok``), which hold for any fit.  The scores themselves come
from the functions of ``operators.models``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazrank.operators import models as MD
from hazrank.operators.ranking import precision_at_k
from hazrank.plans import labels as L
from hazrank.plans import matrix as M
from hazrank.plans import timeline as T
from hazrank.queries import K_DEFAULT, ctx, register
from hazrank.sources import files as SF

ONEHOT_BASES = ["land_type", "state_district", "primary_naics_code_two_digit"]
# fixed default grid: one or two settings per family
DEFAULT_GRID = [
    ("lr", "lr_0", {"penalty": "l2", "C": 1.0, "max_iter": 100}),
    ("lr", "lr_1", {"penalty": "l1", "C": 0.1, "max_iter": 100}),
    ("dt", "dt_0", {"max_depth": 5, "min_samples_leaf": 10}),
    ("rf", "rf_0", {"n_estimators": 30, "max_depth": 6}),
    ("xgbClassifier", "xgbClassifier_0", {"n_estimators": 20, "learning_rate": 0.1, "max_depth": 3}),
    ("xgboost", "xgboost_0", {"num_boost_round": 20, "eta": 0.1, "max_depth": 3}),
]
ONE_OF_EACH = [g for g in DEFAULT_GRID if g[1].endswith("_0")]
#: Both history flavours with the share of their lists.
FLAVOURS = [(True, K_DEFAULT), (False, K_DEFAULT)]


def model_matrix(c, last: bool = True) -> DataFrame:
    """Training and validation rows of both history flavours (``split``,
    ``history``) with all features and labels; the rows of the last fold, or of
    all folds.

    Built from the stored partials, which hold the labels too, and stored once
    by flavour and split: every fold, model and schema probe then reads the
    columns and rows it needs.  Validation rows of earlier years are in no
    training set, so the last fold is built without them."""
    key = ("_matrix", last)
    if key not in c.__dict__:
        p = c.partials()
        route = p.cohort_route(c.spine)
        if last:
            _, train_years, val_year = folds(c)[-1]
            route = route.where(F.when(F.col("split") == "train", F.col("label_year").isin(*train_years))
                                .otherwise(F.col("label_year") == val_year))
        m = M.build_matrix(p, route, c.spine).join(L.label_formal_of(p.inspections, c.spine), M.KEYS, "left")
        with M.compiled_joins(m.sparkSession):
            c.__dict__[key] = SF.materialize(m, SF.shared_path(c.spark, "matrix"), ["history", "split"])
    return c.__dict__[key]


def flag_bases(matrix):
    return MD.numeric_features(matrix)


def folds(c):
    if "_folds" not in c.__dict__:
        out = {}
        for r in T.temporal_folds(c.spine).collect():   # years x years: tiny
            out.setdefault((r["fold"], r["val_year"]), []).append(r["train_year"])
        c.__dict__["_folds"] = [(f, sorted(ys), vy) for (f, vy), ys in sorted(out.items())]
    return c.__dict__["_folds"]


def _last_prepared(c, history: bool, *scalings: bool):
    """The last fold of a flavour, prepared with and without scaling as asked
    for: (fold by scaling, training years)."""
    m = model_matrix(c).where(F.col("history") == F.lit(history)).drop("history")
    _, train_years, val_year = folds(c)[-1]
    tr = m.where((F.col("split") == "train") & F.col("label_year").isin(*train_years)
                 & F.col("formal").isNotNull()).drop("split")
    va = m.where((F.col("split") == "val") & (F.col("label_year") == val_year)).drop("split")
    return MD.prepare_scalings(tr, va, flag_bases(m), ONEHOT_BASES, scalings), train_years


def _score_ok(model_type: str):
    """A probability, or a number (the squared-error booster)."""
    s = F.col("score")
    ok = s.between(0, 1) if model_type != "xgboost" else ~F.isnan(s)
    return F.coalesce(ok, F.lit(False)).alias("score_ok")


#: Fits of a flavour that run side by side where both flavours do.
FITS_OF_FLAVOUR = MD.PARALLEL_FITS // len(FLAVOURS)


def _each_flavour(one, c) -> dict:
    """``one`` of both flavours of the matrix of ``c``, side by side."""
    model_matrix(c), folds(c)
    histories = [h for h, _ in FLAVOURS]
    return dict(zip(histories, MD.side_by_side(c.spark, one, histories)))


def _by_flavour(one, c) -> DataFrame:
    """Both flavours of a result in one frame."""
    return reduce(DataFrame.unionByName, [o.withColumn("with_history", F.lit(h)) for h, o in _each_flavour(one, c).items()])


def _family(model_type):
    def q(spark, sf_dir):
        """The family fitted on all training years; the rows of the last
        validation year that it scores, of both flavours."""
        c = ctx(spark, sf_dir)
        params = next(p for t, _, p in DEFAULT_GRID if t == model_type)

        def one(history):
            prepared, _ = _last_prepared(c, history, model_type == "lr")
            fold, = prepared.values()
            s = MD.score_model(MD.fit_model(model_type, params, fold), fold.val_rows, model_type)
            return s.select("handler_id", "label_year", "formal", _score_ok(model_type))
        return _by_flavour(one, c)
    return q


register("model_lr")(_family("lr"))
register("model_dt")(_family("dt"))
register("model_rf")(_family("rf"))
register("model_gbt")(_family("xgbClassifier"))
register("model_gbt_raw")(_family("xgboost"))


def _evaluation(metrics: DataFrame) -> DataFrame:
    """Sizes and positives of an evaluation, and whether its counts and shares
    agree with one another."""
    lab, pos, i = F.col("labelled_at_k"), F.col("positives_at_k"), F.col("i")
    ok = (pos <= lab) & (lab <= i) & (pos <= F.col("all_positives"))
    ok = ok & F.when(lab > 0, F.col("precision") == pos / lab).otherwise(F.col("precision").isNull())
    ok = ok & F.when(i > 0, F.col("support") == lab / i).otherwise(F.col("support").isNull())
    return metrics.select("with_history", "model_id", "eval_year", "ranked", "i", "all_positives", F.coalesce(ok, F.lit(False)).alias("counts_ok"))


@register("score_model")
def q_score_model(spark, sf_dir):
    """The last fold scored by every family in one pass: evaluated rows per
    model, and whether its scores are numbers."""
    c = ctx(spark, sf_dir)

    def one(history):
        m = model_matrix(c).where(F.col("history") == F.lit(history)).drop("history")
        s = MD.cv_scores(m, folds(c)[-1:], ONE_OF_EACH, flag_bases(m), ONEHOT_BASES, parallel=FITS_OF_FLAVOUR)
        return s.groupBy("model_id", "eval_year").agg(
            F.count(F.lit(1)).alias("n_scored"), F.count("formal").alias("n_labelled"),
            F.count_distinct("handler_id").alias("n_entities"), F.every(F.coalesce(~F.isnan("score"), F.lit(False))).alias("score_ok"))
    return _by_flavour(one, c)


@register("feature_importance")
def q_importance(spark, sf_dir):
    """Per family, of the with-history flavour: are all features known, none
    with importance 0, in order, and what is their sum (trees: 1)?"""
    c = ctx(spark, sf_dir)
    prepared, _ = _last_prepared(c, True, False, True)

    def one(entry):
        model_type, name, params = entry
        fold = prepared[model_type == "lr"]
        got = MD.feature_importance(MD.fit_model(model_type, params, fold), fold.feature_names, model_type).collect()
        values = [r["importance"] for r in got]
        total = None if model_type == "lr" else round(float(sum(values)), 6)
        return (name, bool(got) and {r["feature"] for r in got} <= set(fold.feature_names), 0.0 not in values,
                values == sorted(values, reverse=model_type != "lr"), total)
    rows = MD.side_by_side(spark, one, ONE_OF_EACH)
    return spark.createDataFrame(rows, "model_name string, known_ok boolean, nonzero_ok boolean, order_ok boolean, total double")


@register("save_model")
def q_save_model(spark, sf_dir):
    """Fit, persist with the preparation under the shared folder, load back
    and score the validation rows of the matrix as they are: the difference to
    the scores before, for both flavours."""
    c = ctx(spark, sf_dir)

    def one(history):
        prepared, train_years = _last_prepared(c, history, False)
        fold = prepared[False]
        model = MD.fit_model("dt", dict(DEFAULT_GRID[2][2]), fold)
        path = MD.save_model(model, SF.shared_path(spark, "models"), "dt_0", train_years, fold.preparation)
        again = MD.score_model(MD.load_model(path), fold.raw_val, "dt").withColumnRenamed("score", "again").drop("formal")
        both = MD.score_model(model, fold.val_rows, "dt").join(again, ["handler_id", "label_year"])
        return both.select("handler_id", "label_year", "formal", F.abs(F.col("score") - F.col("again")).alias("difference"))
    return _by_flavour(one, c)


@register("temporal_cv_grid")
def q_cv_grid(spark, sf_dir):
    """Mode 'grid_search': all models over all folds, both flavours."""
    c = ctx(spark, sf_dir)
    m = model_matrix(c, last=False)
    return _evaluation(MD.run_mode("grid_search", m, folds(c), DEFAULT_GRID, FLAVOURS, flag_bases(m), ONEHOT_BASES))


@register("train_single")
def q_train_single(spark, sf_dir):
    """Every family and flavour fitted on all training years and evaluated on
    the last validation year."""
    c = ctx(spark, sf_dir)

    def one(history):
        m = model_matrix(c).where(F.col("history") == F.lit(history)).drop("history")
        return MD.temporal_cv_grid(m, folds(c)[-1:], ONE_OF_EACH, K_DEFAULT, flag_bases(m), ONEHOT_BASES, parallel=FITS_OF_FLAVOUR)
    return _evaluation(_by_flavour(one, c))


@register("fit_model")
def q_fit_model(spark, sf_dir):
    """Every family fitted on all training years of both flavours: training
    size, feature count, and whether the fit ranks its training rows better
    than chance (area under ROC)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    c = ctx(spark, sf_dir)
    prepared = _each_flavour(lambda history: _last_prepared(c, history, False, True)[0], c)

    def one(entry):
        history, (model_type, name, params) = entry
        fold = prepared[history][model_type == "lr"]
        model = MD.fit_model(model_type, params, fold)
        sc = MD.score_model(model, fold.train.withColumnRenamed("label", "formal"), model_type)
        auc = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="formal").evaluate(
            sc.withColumn("formal", F.col("formal").cast("double")))
        return history, model_type, name, fold.n_train, len(fold.feature_names), bool(auc > 0.5)
    rows = MD.side_by_side(spark, one, [(history, g) for history, _ in FLAVOURS for g in ONE_OF_EACH])
    return spark.createDataFrame(rows, "with_history boolean, model_type string, model_name string, n_train long, n_features long, "
                                       "learns_ok boolean")


@register("load_model")
def q_load_model(spark, sf_dir):
    """A persisted model re-opened from its folder and evaluated at k on the
    last validation year, for both flavours."""
    c = ctx(spark, sf_dir)

    def one(history):
        prepared, train_years = _last_prepared(c, history, False)
        fold = prepared[False]
        model = MD.fit_model("xgbClassifier", dict(DEFAULT_GRID[4][2]), fold)
        path = MD.save_model(model, SF.shared_path(spark, "models"), "xgbClassifier_0", train_years, fold.preparation)
        sc = MD.score_model(MD.load_model(path), fold.raw_val, "xgbClassifier")
        s = sc.select(F.lit("xgbClassifier_0").alias("model_id"), F.col("label_year").alias("eval_year"), "handler_id", "score")
        lab = sc.select(F.col("label_year").alias("eval_year"), "handler_id", "formal")
        return precision_at_k(s, lab, K_DEFAULT)
    return _evaluation(_by_flavour(one, c))
