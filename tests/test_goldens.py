"""Hand goldens: each value worked out by hand from the risk model's
definitions (labels, unit conversion, ratio ladder, windows, scaling,
one-hot, waste codes, ranking curve)."""

import math
import os
import sys

sys.path.insert(0, os.path.dirname(__file__))

import pytest
from pyspark.sql import functions as F

from conftest import FakeTables
from hazrank.config import Timeline
from hazrank.functions.columns import to_pounds
from hazrank.operators import ranking as R
from hazrank.operators import transform as X
from hazrank.plans import labels as L

SCORES = {0: .63, 1: .24, 2: .36, 3: .85, 4: .47, 5: .71, 6: .90, 7: .16}
LABELS = {0: 1, 1: 0, 2: 1, 3: 0, 4: 0, 5: 1, 6: 1, 7: 0}


def _frames(spark, labels):
    s = spark.createDataFrame([("m", 2000, k, v) for k, v in SCORES.items()],
                              "model_id string, eval_year int, handler_id long, score double")
    lab = spark.createDataFrame([(2000, k, v) for k, v in labels.items()],
                                "eval_year int, handler_id long, formal long")
    return s, lab


def test_curve_example(spark):
    s, lab = _frames(spark, LABELS)
    cur = R.precision_recall_curve(R.rank_scores(s, lab)).orderBy("rn").collect()
    assert [r.rn for r in cur] == list(range(1, 9))
    prec = [1, 1 / 2, 2 / 3, 3 / 4, 3 / 5, 4 / 6, 4 / 7, 4 / 8]
    rec = [.25, .25, .5, .75, .75, 1, 1, 1]
    assert [round(r.precision, 9) for r in cur] == [round(p, 9) for p in prec]
    assert [round(r.recall, 9) for r in cur] == rec
    assert [r.k for r in cur] == [i / 8 for i in range(1, 9)]


def test_metrics_at_half(spark):
    s, lab = _frames(spark, LABELS)
    r = R.precision_at_k(s, lab, 0.5).first()
    assert (r.i, r.precision, r.support, r.recall, r.fdr) == (4, .75, 1.0, .75, .25)


def test_metrics_with_missing_label(spark):
    labels = dict(LABELS)
    labels[3] = None
    s, lab = _frames(spark, labels)
    r = R.precision_at_k(s, lab, 0.5).first()
    assert (r.labelled_at_k, r.precision, r.support, r.recall) == (3, 1.0, .75, .75)


def test_curve_matches_metrics_at_every_prefix(spark):
    s, lab = _frames(spark, LABELS)
    cur = {r.rn: r for r in R.precision_recall_curve(R.rank_scores(s, lab)).collect()}
    for i in range(1, 9):
        k = i / 8
        m = R.precision_at_k(s, lab, k).first()
        assert math.isclose(cur[m.i].precision, m.precision)


def test_label_truth_table(spark):
    insp = spark.createDataFrame(
        [(2, "2000-03-01", None), (2, "2000-04-01", None),
         (3, "2000-03-01", "310"), (3, "2000-05-01", None),
         (4, "2000-03-01", "100"),
         (5, "1999-03-01", "310")],
        "handler_id long, d string, enforcement_type string").withColumn("evaluation_start_date", F.to_date("d"))
    lt = FakeTables(inspections=insp, inspections_core=insp)
    cohort = spark.createDataFrame([(h, 2000) for h in (1, 2, 3, 4, 5)], "handler_id long, label_year int")
    spine = spark.createDataFrame([(2000,)], "label_year int")
    lit = {r.handler_id: r.formal for r in L.label_formal(lt, cohort, spine).collect()}
    lst = {r.handler_id: r.formal for r in L.label_formal_listed(lt, cohort, spine).collect()}
    assert lit == {1: None, 2: 0, 3: 1, 4: 1, 5: None}
    assert lst == {1: None, 2: 0, 3: 1, 4: 0, 5: None}


@pytest.mark.parametrize("unit,density,dunit,expected", [
    ("1", 1.0, "0", 10), ("2", 1.0, "0", 20000), ("3", 1.0, "0", 22.05), ("4", 1.0, "0", 22050),
    ("5", .9, "2", 75.105), ("6", .9, "2", 19.840638), ("7", .9, "2", 15169.25727),
    ("5", .9, "1", 9), ("6", .9, "1", 2.377548), ("7", .9, "1", 1817.766),
    ("5", 1.0, "2", None), ("6", .9, "0", None), ("9", .9, "1", None),
])
def test_to_pounds(spark, unit, density, dunit, expected):
    df = spark.createDataFrame([(unit, 10.0, density, dunit)], "u string, q double, d double, du string")
    v = df.select(to_pounds(F.col("u"), F.col("q"), F.col("d"), F.col("du")).alias("p")).first().p
    if expected is None:
        assert v is None
    else:
        assert round(v, 6) == round(expected, 6)


def test_ratio_ladder(spark):
    df = spark.createDataFrame([(0.0, 0.0), (.2, 0.0), (.2, .4), (0.0, .4), (None, .4)], "v double, r double")
    out = [r.x for r in df.select(R.ratio_ladder(F.col("v"), F.col("r")).alias("x")).collect()]
    assert out == [1.0, float("inf"), .5, 0.0, None]


def test_windows():
    tl = Timeline(lookback=4)
    assert tl.window_start("total", 2013) == 2009
    assert tl.window_start("five_year", 2013) == 2009
    assert tl.window_start("three_year", 2013) == 2011
    assert tl.window_start("most_recent", 2013) == 2013
    with pytest.raises(ValueError):
        tl.window_start("decade", 2013)


def test_minmax(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0), (3, None, 5.0)], "id int, a double, b double")
    out = {r.id: (r.a, r.b) for r in X.minmax_normalize(df, ["a", "b"]).collect()}
    assert out == {1: (0.0, 0.0), 2: (1.0, 0.0), 3: (None, 0.0)}


def test_onehot_train_test(spark):
    tr = spark.createDataFrame([(1, " b"), (2, "a"), (3, "a"), (4, None)], "id int, c string")
    te = spark.createDataFrame([(1, "z"), (2, "a"), (3, None), (4, "b")], "id int, c string")
    m = X.onehot_fit(tr, ["c"])
    out = m.transform(te)
    assert [c for c in out.columns if c.startswith("c_")] == ["c_onehot_a", "c_onehot_b"]
    rows = {r.id: (r.c_onehot_a, r.c_onehot_b) for r in out.collect()}
    assert rows == {1: (0, 0), 2: (1, 0), 3: (0, 0), 4: (0, 1)}


def test_flag_missing_only_when_null(spark):
    df = spark.createDataFrame([(1, 2.0, 1.0), (2, None, 2.0)], "id int, x_total double, y_total double")
    out = X.flag_missing(df, ["x", "y"])
    assert "x_total_missing_flag" in out.columns and "y_total_missing_flag" not in out.columns
    assert {r.id: (r.x_total, r.x_total_missing_flag) for r in out.collect()} == {1: (2.0, 0), 2: (0.0, 1)}


def test_waste_code_toxic_range():
    from hazrank.config import TOXIC_CODE_HIGH_EXCLUSIVE as HI, TOXIC_CODE_LOW_EXCLUSIVE as LO
    toxic = [c for c in ("D004", "D005", "D042", "D043") if LO < c < HI]
    assert toxic == ["D005", "D042"]


def test_discount_weights(spark):
    from hazrank.operators.selection import rank_models_discounted
    years = list(range(2009, 2015))
    row = {f"precision_{y}": 0.0 for y in years}
    row["precision_2014"] = 1.0
    df = spark.createDataFrame([dict(row, model_name="m")])
    v = rank_models_discounted(df, years).first().discounted_precision
    assert math.isclose(v, 32 / 63)
