"""Values, categories and parameters beyond the usual range."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazrank.functions.columns import round_half_up
from hazrank.operators.eda import exact_quantiles, share_by_value
from hazrank.operators.fairness import disparity_at_k
from hazrank.operators import models as MD
from hazrank.operators.models import make_estimator
from hazrank.operators.grid import grid_zip
from hazrank.operators.ranking import (
    group_sizes, precision_at_k, precision_recall_curve, rank_scores, year_positives,
)
from hazrank.operators.transform import onehot_fit_transform
from hazrank.sources.files import ingest_array_json, rejected_replies, scan_csv


def test_rounding_keeps_large_values(spark):
    values = [9.3e12, 1e13, 5e15, -1e13, 0.1234565, -0.3]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(round_half_up(F.col("x"))).collect()]
    assert got == pytest.approx(values, rel=1e-5) and got[4] == 0.123457


def test_shares_are_cut_exactly(spark):
    rows = spark.range(10000).select(F.when(F.col("id") < 29, "a").when(F.col("id") < 86, "b").otherwise("c").alias("v"))
    got = {r.v: r.percentage for r in share_by_value(rows, "v").collect()}
    assert got == {"a": 0.29, "b": 0.57, "c": 99.14}


def test_disparity_takes_any_number_of_categories(spark):
    n = 1500
    ids = spark.range(n).select(F.lit("m").alias("model_id"), F.lit(2000).alias("eval_year"), F.col("id").alias("handler_id"))
    scores = ids.withColumn("score", -F.col("handler_id").cast("double"))
    labels = ids.select("eval_year", "handler_id", (F.col("handler_id") % 2).cast("int").alias("formal"))
    groups = ids.select("handler_id", F.concat(F.lit("g"), F.col("handler_id")).alias("area"))
    got = {r.group_name: r.num_labeled_k for r in disparity_at_k(scores, labels, groups, 0.5, "area", "g1").collect()}
    assert len(got) == n - 1 and sum(got.values()) == n // 2 - 1 and got["g1499_vs_g1"] == 0


def test_depth_and_flags_are_checked(spark):
    with pytest.raises(ValueError):
        make_estimator("dt", {"max_depth": 40}, 10)
    with pytest.raises(ValueError):
        make_estimator("rf", {"bootstrap": "maybe"}, 10)
    assert make_estimator("rf", {"bootstrap": "False"}, 10).getBootstrap() is False
    assert make_estimator("lr", {"penalty": "elasticnet", "l1_ratio": 0.0}, 10).getElasticNetParam() == 0.0
    assert make_estimator("xgbClassifier", {}, 10).getMaxIter() == 10


def test_csv_header_must_match(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception):
        scan_csv(spark, str(tmp_path / "x.csv"), "a int, b int").collect()


def test_onehot_takes_any_number_of_categories(spark):
    n = 1500
    rows = spark.range(n).select("id", F.concat(F.lit("v"), F.col("id")).alias("land_type"))
    out, model = onehot_fit_transform(rows, ["land_type"])
    assert len(model.categories["land_type"]) == n and len(out.columns) == n + 1
    assert out.where("id = 7").first()["land_type_onehot_v7"] == 1


def test_parameters_without_counterpart_are_errors(spark):
    for family, params in [("dt", {"min_samples_split": 10}), ("rf", {"class_weight": "balanced"}),
                           ("xgboost", {"objective": "rank:pairwise"}), ("xgbClassifier", {"reg_alpha": 0.5}),
                           ("dt", {"max_depth": "3.5"})]:
        with pytest.raises(ValueError):
            make_estimator(family, params, 10)
    # text of a re-imported grid, and values that change nothing
    e = make_estimator("rf", {"min_samples_split": "2.0", "class_weight": "None", "max_depth": "5", "criterion": "entropy",
                              "min_impurity_decrease": "None", "min_weight_fraction_leaf": "0.1"}, 10)
    assert (e.getMaxDepth(), e.getImpurity(), e.getMinInfoGain(), e.getMinWeightFractionPerNode()) == (5, "entropy", 0.0, 0.1)
    g = make_estimator("xgboost", {"gamma": 0.5, "min_child_weight": "3", "colsample_bynode": 0.5}, 10)
    assert (g.getMinInfoGain(), g.getMinInstancesPerNode(), g.getFeatureSubsetStrategy()) == (0.5, 3, "0.5")


def test_loaded_model_scores_unprepared_rows(spark, tmp_path):
    rows = spark.range(80).select(
        F.col("id").alias("handler_id"), F.lit(2000).alias("label_year"), (F.col("id") % 3 == 0).cast("long").alias("formal"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 7).alias("inspection_num_total"),
        F.when(F.col("id") % 2 == 0, "it's").otherwise("b").alias("land_type"))
    train, val = rows.where("handler_id < 60"), rows.where("handler_id >= 60")
    for family in ("lr", "dt"):
        fold = MD.prepare_fold(train, val, ["inspection_num"], ["land_type"], family == "lr")
        model = MD.fit_model(family, {}, fold)
        path = MD.save_model(model, str(tmp_path), family, [2000], fold.preparation)
        loaded = MD.load_model(path)
        assert MD.model_feature_names(loaded) == fold.feature_names
        want = sorted(MD.score_model(model, fold.val, family).collect())
        assert sorted(MD.score_model(loaded, val, family).collect()) == want and len(want) == 20


def test_replies_are_read_by_their_own_header(spark):
    texts = ['[["NAME","state"],["a","1"]]', '[["state","NAME","population"],["2","b","7"]]', 'broken', None, '[]',
             '[["NAME","state"],["only one"]]', '[["NAME","NAME"],["x","y"]]', '[["NAME","state"]]']
    replies = spark.createDataFrame([(t,) for t in texts], "value string")
    got = ingest_array_json(replies, numeric=["population"])
    assert got.columns == ["NAME", "state", "population"]
    assert sorted(map(tuple, got.collect())) == [("a", "1", None), ("b", "2", 7.0)]
    assert {r.value for r in rejected_replies(replies).collect()} == {texts[i] for i in (2, 3, 4, 5, 6)}


def test_denominators_count_unscored_labels_and_unlabelled_scores(spark):
    scores = spark.createDataFrame([("m", 2000, i, float(-i)) for i in range(10)],
                                   "model_id string, eval_year int, handler_id long, score double")
    labels = spark.createDataFrame([(2000, i, 1 if i % 2 == 0 else None) for i in range(4)] + [(2000, 100 + i, 1) for i in range(3)],
                                   "eval_year int, handler_id long, formal long")
    r = precision_at_k(scores, labels, 0.3).first()
    assert (r.ranked, r.i, r.positives_at_k, r.all_positives, r.recall) == (10, 3, 2, 5, 0.4)
    curve = precision_recall_curve(rank_scores(scores, labels), sizes=group_sizes(scores), positives=year_positives(labels))
    assert [(c.k, c.recall) for c in curve.orderBy("rn").collect()] == [(0.1, 0.2), (0.2, 0.2), (0.3, 0.4), (0.4, 0.4)]


def test_one_value_holds_for_every_model_of_its_group(spark):
    lists = spark.createDataFrame([("a", "depth", ["1", "2", "3"]), ("a", "seed", ["7"]), ("b", "depth", ["1", "2"]),
                                   ("b", "seed", ["7", "8", "9"]), ("c", "depth", ["4"]), ("d", "depth", ["1"]), ("d", "seed", [])],
                                  "g string, param string, values array<string>")
    got = {(r.g, r.model_index): (r.params, r.length_ok) for r in grid_zip(lists, ["g"]).collect()}
    assert [got["a", i] for i in range(3)] == [({"depth": str(i + 1), "seed": "7"}, True) for i in range(3)]
    assert got["c", 0] == ({"depth": "4"}, True) and not any(ok for (g, _), (_, ok) in got.items() if g in "bd")
    assert len(got) == 3 + 3 + 1 + 1


def test_quantiles_sort_values_not_rows(spark, monkeypatch):
    rows = spark.range(3001).select(F.when(F.col("id") % 3 == 0, 40.0).when(F.col("id") > 2990, None).otherwise(F.col("id") % 97).alias("x"))
    values = np.array([r.x for r in rows.collect() if r.x is not None])
    sorted_rows, ranged = [], type(rows).repartitionByRange
    monkeypatch.setattr(type(rows), "repartitionByRange", lambda self, *a: (sorted_rows.append(self.count()), ranged(self, *a))[1])
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)
    assert list(exact_quantiles(rows, "x", probs).first()) == pytest.approx(list(np.quantile(values, probs)))
    assert sorted_rows == [len(set(values))]
    assert list(exact_quantiles(rows.limit(0), "x", (0.5,)).first()) == [None]
    assert list(exact_quantiles(rows.where("id = 3"), "x", (0.25, 1.0)).first()) == [40.0, 40.0]
