"""Plans that hold at scale: no sorts for cutoffs, no range joins, no moved
matrix, hot keys spread, and the values they give."""

import math
import os
import random
import sys

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from conftest import SF001, FakeTables
from hazrank.config import Timeline
from hazrank.operators import fairness as FA
from hazrank.operators import models as MD
from hazrank.operators import ranking as R
from hazrank.operators import selection as S
from hazrank.operators import topk
from hazrank.operators import transform as X
from hazrank.plans import cohorts as C
from hazrank.plans import features as FT
from hazrank.plans import labels as L
from hazrank.plans import matrix as M
from hazrank.plans import timeline as T
from hazrank.queries import Ctx


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- rank selection --------------------------------------------------------------
def by_window(rows, k, entity="handler_id"):
    w = Window.partitionBy("g").orderBy(F.col("score").desc_nulls_last(), F.col(entity))
    n = Window.partitionBy("g")
    return {(r["g"], r[entity]) for r in rows.withColumn("rn", F.row_number().over(w)).withColumn("n", F.count(F.lit(1)).over(n))
            .where(F.col("rn") <= F.floor(F.lit(float(k)) * F.col("n"))).collect()}


def by_cutoff(rows, k, cells, entity="handler_id"):
    cut = topk.top_cutoffs(rows, ["g"], topk.share_of(k), entity_col=entity, cells=cells)
    return {(r["g"], r[entity]) for r in topk.with_top(rows, cut, ["g"], entity_col=entity).where("top").collect()}


SCORES = {
    "few values": lambda r: float(r.randint(0, 5)), "uniform": lambda r: r.random(), "half one value": lambda r: 0.25 if r.random() < 0.5 else r.random(),
    "exponents": lambda r: math.ldexp(r.random(), r.randint(-1000, 1000)), "one value": lambda r: 3.0,
    "odd": lambda r: r.choice([None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 1.7e308, -1.7e308, 5e-324]),
}


@pytest.mark.parametrize("name", sorted(SCORES))
def test_cutoffs_are_the_sorted_top(spark, name):
    rnd = random.Random(name)
    rows = [(0 if i < 600 else rnd.randint(1, 4), i * 7919 % 100003, SCORES[name](rnd)) for i in range(1200)]
    rows += [(9, 1, 0.5)]
    df = R.stored(spark.createDataFrame(rows, "g int, handler_id long, score double"))
    for k, cells in ((0.21, 4096), (0.5, 5), (1.0, 64) if name == "odd" else (0.003, 64)):
        assert by_cutoff(df, k, cells) == by_window(df, k), (k, cells)


@pytest.mark.parametrize("kind", ["string", "int", "long"])
def test_ties_are_resolved_by_any_kind_of_entity(spark, kind):
    rnd = random.Random(kind)
    names = {"string": lambda i: rnd.choice(["", "a", "ab", "é", "aé", "zz"]) + str(i), "int": lambda i: i * (-1) ** i, "long": lambda i: (i - 250) * 2 ** 54}[kind]
    df = R.stored(spark.createDataFrame([(i % 2, names(i), 1.0) for i in range(500)], f"g int, e {kind}, score double"))
    for k, cells in ((0.21, 4096), (0.5, 7)):
        assert by_cutoff(df, k, cells, "e") == by_window(df, k, "e")


def test_an_entity_twice_in_a_group_is_an_error(spark):
    df = spark.createDataFrame([(0, 1, 1.0)] * 4, "g int, handler_id long, score double")
    with pytest.raises(ValueError, match="more than once"):
        by_cutoff(df, 0.5, 16)


def test_metrics_sort_nothing(spark, monkeypatch):
    rnd = random.Random(3)
    n = 4000
    rows = [("m", 2000, i, 0.5 if i % 2 else rnd.random()) for i in range(n)]  # one score holds half the rows
    labels = [(2000, i, rnd.choice([0, 1, None])) for i in range(n) if i % 5]
    scores = spark.createDataFrame(rows, "model_id string, eval_year int, handler_id long, score double")
    labels = spark.createDataFrame(labels, "eval_year int, handler_id long, formal long")
    ranged = []
    monkeypatch.setattr(type(scores), "repartitionByRange", lambda self, *a: ranged.append(a) or self)
    out = R.precision_at_k(scores, labels, 0.21)
    assert "rangepartitioning" not in plan_of(out) and not ranged
    assert not any("Sort [" in line and "score" in line for line in plan_of(out).splitlines())
    got = out.first()
    ranked = sorted((x for x in scores.join(labels, ["eval_year", "handler_id"]).collect()), key=lambda x: (-x.score, x.handler_id))
    top = [x.formal for x in ranked[:got.i] if x.formal is not None]
    assert (got.ranked, got.i, got.labelled_at_k, got.positives_at_k) == (n, 840, len(top), sum(top))


def test_audit_marks_one_set_of_rows_twice(spark, monkeypatch):
    rnd = random.Random(5)
    n = 900
    scores = spark.createDataFrame([(m, 2000, i, float(rnd.randint(0, 20))) for m in "ab" for i in range(n)], "model_id string, eval_year int, handler_id long, score double")
    labels = spark.createDataFrame([(2000, i, rnd.choice([0, 1, None])) for i in range(n) if i % 7], "eval_year int, handler_id long, formal long")
    groups = spark.createDataFrame([(i, i % 3) for i in range(n) if i % 4], "handler_id long, area int")
    ranged = []
    monkeypatch.setattr(type(scores), "repartitionByRange", lambda self, *a: ranged.append(a) or self)
    got = {(r.model_id, r.group_name): r for r in FA.audit_at_k(scores, labels, groups, 0.3, "area", 1).collect()}
    apart = {(r.model_id, r.group_name): r for r in FA.disparity_at_k(scores, labels, groups, 0.3, "area", 1).collect()}
    precision = {r.model_id: r.precision for r in R.precision_at_k(scores, labels, 0.3).collect()}
    assert len(got) == 4 and not ranged
    for key, r in got.items():
        a = apart[key]
        assert r.precision_k == precision[key[0]]
        assert (r.recall_disparity, r.fdr_ratio, r.num_labeled_k, r.num_labeled_ref_k) == (a.recall_disparity, a.fdr_ratio, a.num_labeled_k, a.num_labeled_ref_k)


def test_income_halves_need_no_sort(spark):
    got = Ctx(spark, SF001).lt_all.bias_data
    assert "rangepartitioning" not in plan_of(got) and "Window" not in plan_of(got)
    rows = got.collect()
    order = sorted(rows, key=lambda r: (r.est_total_income, r.handler_id))
    assert [r.income_category for r in order] == [1] * -(-len(rows) // 2) + [2] * (len(rows) // 2)


# --- cohorts, as-of joins, hot owner ------------------------------------------------
def test_cohort_route_reads_each_source_once(spark):
    c = Ctx(spark, SF001)
    route = C.cohort_route(c.lt, c.spine)
    assert plan_of(route).count("FileScan parquet") <= 4
    tr, va = c.spine.where("is_train"), c.val_spine
    parts = {("train", True): C.cohort_train_with_history(c.lt, tr), ("train", False): C.cohort_train(c.lt, tr),
             ("val", True): C.cohort_val_with_history(c.lt, va), ("val", False): C.cohort_val_without_history(c.lt, va)}
    rows = route.collect()
    for (split, history), frame in parts.items():
        want = sorted(map(tuple, frame.collect()))
        assert sorted((r.handler_id, r.label_year) for r in rows if (r.split, r.history) == (split, history)) == want and want


@pytest.mark.parametrize("key", ["feat_parent_company_peers", "feat_zip_peers", "commonsense_rank"])
def test_as_of_plans_have_no_range_join_and_push_the_date(spark, key, monkeypatch):
    import __spark_entry__ as E
    from hazrank.operators import eda
    # the ranking checkpoints its input; its plan is what counts here
    monkeypatch.setattr(eda, "ordered_index", lambda df, *a, **k: df)
    plan = plan_of(E.queries()[key](spark, SF001))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "o_orderdate" in line]
    assert scans and all("LessThan(o_orderdate" in s for s in scans)


@pytest.mark.parametrize("latest", [False, True])
def test_as_of_groups_are_those_of_the_range_join(spark, latest):
    rnd = random.Random(1)
    rows = spark.createDataFrame([(rnd.randint(1, 40), rnd.randint(1990, 2001), rnd.choice(["a", "b", "c"])) for _ in range(300)], "handler_id long, report_year int, o string")
    spine = T.config_spine(spark, Timeline())
    got = sorted(map(tuple, FT.first_group(rows, "o", spine, latest).collect()))
    want, held = [], rows.collect()
    for y in Timeline().label_years():
        for h in range(1, 41):
            mine = sorted((r.report_year, r.o) for r in held if r.handler_id == h and r.report_year < y)
            if mine:
                want.append((h, y, mine[-1][1] if latest else mine[0][1]))
    assert got == sorted(want)


def test_a_company_with_a_third_of_all_rows_is_spread(spark):
    n = 6000
    owner = spark.range(n).select((F.col("id") % 2500).alias("handler_id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id") % 900)).alias("owner_operator_name"),
                                  (F.lit(1995) + F.col("id") % 4).cast("int").alias("report_year"), F.lit("CO").alias("owner_operator_indicator"))
    spine = T.config_spine(spark, Timeline())
    links = FT.owner_links(FakeTables(owner=owner))
    sizes = FT.company_sizes(links, spine, ("most_recent", "three_year"))
    plan = plan_of(sizes)
    rows = [(r.handler_id, r.owner_operator_name, r.report_year) for r in owner.collect()]
    got = {(r.owner_operator_name, r.label_year): (r.nh__most_recent, r.nh__three_year) for r in sizes.collect()}
    for y in Timeline().label_years():
        assert got["hot", y] == (len({h for h, o, t in rows if o == "hot" and t == y - 1}), len({h for h, o, t in rows if o == "hot" and y - 3 <= t < y}))
    # only counts, added up by each task, are dealt out by company alone
    exchanges = [line for line in plan.splitlines() if "hashpartitioning(owner_operator_name" in line]
    assert len(exchanges) == 2 and "handler_id" not in exchanges[0] and "handler_id" in exchanges[1] and "partial_count" in plan
    # and the tasks that hold entities share the hot company's rows
    entity = links.join(F.broadcast(T.window_year_spine(spine, ("three_year",))), "year").select("owner_operator_name", "label_year", "handler_id").distinct()
    held = entity.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in held) < 2 * sum(r["count"] for r in held) / max(len(held), 1)


# --- matrix ------------------------------------------------------------------------------
def test_the_growing_matrix_is_never_moved(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    c = Ctx(spark, SF001)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        p = c.partials()  # the session that they are opened in has these settings
        m = M.build_matrix(p, p.cohort_active(c.spine), c.spine)
        node = m._jdf.queryExecution().executedPlan()
        joins = 0
        while True:  # down the cohort's side of the joins
            name = node.nodeName()
            assert "Exchange" not in name, name
            joins += "Join" in name
            if node.children().isEmpty():
                break
            node = node.children().head()
        assert joins >= 10
        plan = plan_of(m)
        assert "NestedLoop" not in plan
        # families of an entity's own rows lie in place; those that go through a company or a zip code move
        moved = [line.split("hashpartitioning(")[1].split("#")[0] for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
        assert moved.count("handler_id") == 3 and set(moved) == {"handler_id", "owner_operator_name", "location_zip"}
        own = FT.inspection_family(p.inspections, c.spine)
        assert "Exchange hashpartitioning" not in plan_of(own)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    M.drop_partials(spark)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(M.TABLE_PREFIX)]


def test_families_are_computed_for_the_cohort_alone(spark):
    p = Ctx(spark, SF001).partials()
    spine = Ctx(spark, SF001).spine
    entity = F.col("handler_id") % 7 == 0
    cohort = p.cohort_active(spine).where(entity)
    # rows of the cohort may repeat; a family has a key once
    keys = cohort.unionByName(cohort).distinct()
    wanted = {tuple(r) for r in keys.collect()}
    # cohort years that an entity lacks a partial for are no rows either way
    for every, some in zip(M.family_frames(p, spine), M.family_frames(p, spine, keys)):
        key = lambda r: (r["handler_id"], r["label_year"])
        want = {key(r): r for r in every.collect() if key(r) in wanted}
        rows = some.collect()
        assert len(rows) == len(want) and every.columns == some.columns
        for r in rows:
            for x, y in zip(r, want[key(r)]):
                assert x == y or (isinstance(x, float) and math.isclose(x, y, rel_tol=1e-12)), (r, want[key(r)])
    # the matrix asks for no more: only rates and company sizes are of all entities
    plan = plan_of(M.build_matrix(p, cohort, spine))
    assert plan.count("ShuffledHashJoin [handler_id") >= 6, plan
    M.drop_partials(spark)


def test_uniqueness_is_checked_on_keys_alone(spark):
    import __spark_entry__ as E
    plan = plan_of(E.queries()["assert_one_row_per_entity"](spark, SF001))
    assert not any(c in plan for c in ("l_quantity", "l_returnflag", "p_size", "s_name", "o_orderpriority"))
    spine = T.config_spine(spark, Timeline()).where("label_year = 1999")
    cohort = spark.createDataFrame([(1, 1999), (2, 1999), (3, 1999)], "handler_id long, label_year int")
    reports = spark.createDataFrame([(1, 1998), (1, 1998), (2, 1998), (3, 1997), (3, 1997)], "handler_id long, report_year int")
    codes = spark.createDataFrame([(1, 1998), (2, 1998), (2, 1998), (2, 1998)], "handler_id long, report_year int")
    assert sorted(map(tuple, M.matrix_key_violations(reports, codes, cohort, spine).collect())) == [(1, 1999, 2), (2, 1999, 3)]


def test_a_reversed_range_fails(spark):
    with pytest.raises(ValueError):
        Timeline(train_label_range=(1999, 1997))
    spine = T.config_spine(spark, Timeline(lookback=-1))
    with pytest.raises(Exception, match="starts after its end"):
        T.ordered_windows(spine).select("label_year").collect()
    assert T.ordered_windows(T.config_spine(spark, Timeline())).count() == 4


def test_pounds_are_exact_and_summed_in_any_order(spark):
    from hazrank.functions.columns import pounds_exact, to_pounds
    rows = [("7", 0.1, 1.05, "2"), ("6", 12.5, 1.01, "1"), ("4", 3.0, None, None), ("1", 7.25, None, "2"), ("5", 2.0, 1.0, "2"), ("5", 2.0, 1.0, "1"), ("9", 1.0, 1.0, "1"), ("2", None, 1.0, "1")]
    df = spark.createDataFrame(rows, "u string, q double, d double, du string")
    got = [r.p for r in df.select(to_pounds(F.col("u"), F.col("q"), F.col("d"), F.col("du")).alias("p")).collect()]
    want = [0.1 * 201.974 * 1.05 * 8.345, 12.5 * 0.264172 * 1.01, 6615.0, 7.25, None, 2.0, None, None]
    assert all((g is None) == (w is None) and (w is None or g == pytest.approx(w, rel=1e-12)) for g, w in zip(got, want))
    many = spark.range(3000).select(F.lit("7").alias("u"), (F.col("id") * 0.0001 + 0.1).alias("q"), F.lit(1.05).alias("d"), F.lit("2").alias("du"))
    total = F.sum(pounds_exact(F.col("u"), F.col("q"), F.col("d"), F.col("du"))).cast("string")
    assert len({many.repartition(n).agg(total).first()[0] for n in (1, 3, 7)}) == 1


# --- transforms and models ------------------------------------------------------------------
def test_one_hot_of_100000_values_is_sparse(spark):
    n = 100_000
    rows = spark.range(n).select(F.col("id").alias("handler_id"), F.lit(2000).alias("label_year"), (F.col("id") % 2).alias("formal"),
                                 F.concat(F.lit(" v"), F.col("id"), F.lit(" ")).alias("land_type"), (F.col("id") % 7).alias("inspection_num"))
    val = spark.createDataFrame([(1, 2000, 1, "v7", 3), (2, 2000, None, "never seen", 4), (3, 2000, 0, None, None)], "handler_id long, label_year int, formal long, land_type string, inspection_num long")
    fold = MD.prepare_fold(rows, val, ["inspection_num"], ["land_type"], False)
    assert len(fold.feature_names) == n + 2 and fold.feature_names[2:4] == ["land_type_onehot_v0", "land_type_onehot_v1"]
    plan = plan_of(fold.preparation.transform(rows))
    assert plan.count("CASE WHEN") < 5 and "collect_set" not in plan and len(plan) < 100_000
    got = {r.handler_id: r.features for r in fold.val.collect()}
    assert got[1].size == n + 2 and got[1].numNonzeros() == 2 and got[1][fold.feature_names.index("land_type_onehot_v7")] == 1.0
    assert got[2].numNonzeros() == 1 and got[3].toArray().sum() == 1.0  # the missing flag
    X_model = X.onehot_fit(rows.limit(50), ["land_type"])
    assert len(X_model.categories["land_type"]) == 50


@pytest.mark.parametrize("apply", [lambda d: X.flag_missing(d, ["inspection_num"]), lambda d: X.minmax_normalize(d, ["inspection_num"]),
                                   lambda d: X.onehot_fit_transform(d, ["land_type"])[0]])
def test_a_fitted_transform_runs_its_input_once(spark, apply):
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b
    rows = spark.range(40).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).alias("inspection_num"), F.lit("x").alias("land_type"))
    out = apply(rows.mapInArrow(count, rows.schema))
    assert out.count() == 40 and len(out.collect()) == 40 and runs.value == 40


def small_matrix(spark):
    base = spark.range(240).select(F.col("id").alias("handler_id"), (F.lit(1997) + F.col("id") % 4).cast("int").alias("label_year"),
                                   (F.col("id") % 3 == 0).cast("long").alias("formal"), (F.col("id") % 7).alias("inspection_num_total"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("land_type"))
    parts = [base.withColumn("split", F.lit(s)).withColumn("history", F.lit(h)) for s in ("train", "val") for h in (True, False)]
    return R.stored(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]))


FOLDS = [(0, [1997], 1998), (1, [1997, 1998], 1999)]
GRID = [("dt", "dt_0", {"max_depth": 3}), ("lr", "lr_0", {})]


def test_run_modes(spark):
    m = small_matrix(spark)
    run = lambda mode, flavours: [tuple(r) for r in MD.run_mode(mode, m, FOLDS, GRID, flavours, ["inspection_num"], ["land_type"])
                                  .select("with_history", "k", "model_id", "eval_year", "i").collect()]
    both = [(True, 0.2), (False, 0.5)]
    names = [g[1] for g in GRID]
    assert sorted(run("grid_search", both)) == sorted((h, k, n, y, int(k * 60)) for h, k in both for n in names for y in (1998, 1999))
    assert sorted(run("cv", both)) == [(True, 0.2, "dt_0", 1998, 12), (True, 0.2, "dt_0", 1999, 12)]
    assert run("train", both) == [(True, 0.2, "dt_0", 1999, 12)]
    with pytest.raises(ValueError):
        run("other", both)
    # nothing of it stays cached
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_fits_side_by_side_give_the_scores_of_one_by_one(spark):
    m = small_matrix(spark).where("history").drop("history")
    scores = [sorted(map(tuple, MD.cv_scores(m, FOLDS[:1], GRID, ["inspection_num"], ["land_type"], parallel=n).collect())) for n in (1, 3)]
    assert scores[0] == scores[1] and len(scores[0]) == 120


def test_a_fold_is_scored_in_one_pass(spark, monkeypatch):
    from hazrank.operators.ranking import stored
    m = small_matrix(spark).where("history").drop("history").withColumn("inspection_num_total", F.when(F.col("handler_id") % 5 > 0, F.col("inspection_num_total")))
    grid = [*GRID, ("xgboost", "xgboost_0", {"num_boost_round": 2, "max_depth": 2}), ("lr", "lr_1", {"penalty": "l1", "C": 0.1})]
    bases = (["inspection_num"], ["land_type"])
    kept = []
    monkeypatch.setattr(MD, "stored", lambda df: (kept.append(df.columns), stored(df))[1])
    got = MD.cv_scores(m, FOLDS, grid, *bases)
    # training rows without and with scaling of each fold, and the scores: no validation features
    assert sorted(c[2] for c in kept) == ["handler_id"] + ["label"] * 4
    want = []
    for _, train_years, val_year in FOLDS:
        tr = m.where((F.col("split") == "train") & F.col("label_year").isin(*train_years)).drop("split")
        va = m.where((F.col("split") == "val") & (F.col("label_year") == val_year)).drop("split")
        for model_type, name, params in grid:
            fold = MD.prepare_fold(tr, va, *bases, model_type == "lr")
            s = MD.score_model(MD.fit_model(model_type, params, fold), fold.val, model_type)
            want += [(name, r.label_year, r.handler_id, r.score, r.formal) for r in s.collect()]
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) == 480
    # both scalings of a fold's rows come from one scan
    fold = MD.prepare_scalings(tr, va, *bases, [False, True])
    assert plan_of(MD.val_features(fold)).split("== Initial Plan ==")[0].count("FileScan") == 1


def test_flavours_of_a_grid_run_side_by_side(spark, monkeypatch):
    import threading
    m = small_matrix(spark)
    met = threading.Barrier(2, timeout=60)  # breaks where one waits for the other's end
    monkeypatch.setattr(MD, "cv_scores", lambda *a, _f=MD.cv_scores: (met.wait(), _f(*a))[1])
    got = MD.run_mode("grid_search", m, FOLDS[:1], GRID[:1], [(True, 0.2), (False, 0.5)], ["inspection_num"], ["land_type"])
    assert [r.with_history for r in got.select("with_history").collect()] == [True, False]


def test_typed_re_import(spark):
    params = "'n_estimators=100;learning_rate=0.1;bootstrap=True;max_depth=None;criterion=gini;min_samples_leaf=3.0'"
    sel = spark.createDataFrame([("rf", "rf_1", params, True, 1), ("rf", "rf_2", "max_depth=4;fit_intercept=no;C=2", True, 2)],
                                "model_type string, model_name string, model_param string, with_history boolean, rank int")
    grid = S.grid_of(S.typed_grid(sel))
    assert grid == [("rf", "rf_1", {"n_estimators": 100, "learning_rate": 0.1, "bootstrap": True, "max_depth": None, "criterion": "gini", "min_samples_leaf": 3}),
                    ("rf", "rf_2", {"max_depth": 4, "fit_intercept": False, "C": 2.0})]
    assert all(type(v) is t for v, t in zip(grid[0][2].values(), (int, float, bool, type(None), str, int))) or sorted(map(str, map(type, grid[0][2].values())))
    MD.make_estimator("rf", grid[0][2], 10)
    bad = sel.withColumn("model_param", F.lit("n_estimators=many"))
    with pytest.raises(ValueError, match="many"):
        S.grid_of(S.typed_grid(bad))


def test_dropped_models_and_label_order(spark):
    models = spark.createDataFrame([("a", True, 0.5), ("b", True, 0.1), ("c", True, None), ("d", False, 0.9)], "model_name string, with_history boolean, avg_support double")
    got = S.filter_by_support(models, 0.2, ["with_history"])
    assert sorted((r.model_name, r.n_dropped) for r in got.collect()) == [("a", 2), ("d", 0)]
    assert sorted((r.model_name, r.n_dropped) for r in S.filter_by_support(models, 0.2).collect()) == [("a", 2), ("d", 2)]
    rows = spark.createDataFrame([("m", 2000, y, p) for y, p in [(1, 1), (1, 0), (1, 1), (None, 1)]], "model_id string, eval_year int, formal long, predicted int")
    got = R.confusion_matrix(rows, labels=(1, 0)).orderBy("place").collect()
    assert got[0].asDict() == {"model_id": "m", "eval_year": 2000, "place": 0, "actual": 1, "predicted_1": 2, "predicted_0": 1}
    assert (got[1].actual, got[1].predicted_1, got[1].predicted_0) == (0, 0, 0)
    assert [r.actual for r in R.confusion_matrix(rows).collect()] == [1]


def test_scalings_of_a_fold_share_what_does_not_depend_on_them(spark, monkeypatch):
    rows = small_matrix(spark).where("history").drop("history")
    train, val = rows.where("split = 'train' AND formal IS NOT NULL").drop("split"), rows.where("split = 'val'").drop("split")
    bases = (["inspection_num"], ["land_type"])
    alone = {s: MD.prepare_fold(train, val, *bases, s) for s in (False, True)}
    calls, kept = [], []
    for name in ("columns_with_nulls", "indexed"):
        monkeypatch.setattr(X, name, lambda *a, _f=getattr(X, name), _n=name: (calls.append(_n), _f(*a))[1])
    monkeypatch.setattr(MD, "stored", lambda df, _f=MD.stored: (kept.append(df.columns[2]), _f(df))[1])
    both = MD.prepare_scalings(train, val, *bases, [False, True])
    # one look at the rows for both, and no validation side before one asks
    assert sorted(calls) == ["columns_with_nulls", "indexed"] and kept == ["label", "label"]
    for s, one in alone.items():
        assert both[s].feature_names == one.feature_names and both[s].n_train == one.n_train
        for side in ("train", "val", "val_rows"):
            assert sorted(map(str, getattr(both[s], side).collect())) == sorted(map(str, getattr(one, side).collect()))
    assert both[True].val is both[True].val


def test_importances_of_all_families_come_from_one_preparation(spark, monkeypatch):
    from hazrank import registry_models as RM
    m = small_matrix(spark).withColumn("formal", (F.col("inspection_num_total") > 3).cast("long"))
    prepared = []
    monkeypatch.setattr(RM, "model_matrix", lambda c: m)
    monkeypatch.setattr(RM, "folds", lambda c: FOLDS[-1:])
    monkeypatch.setattr(MD, "stored", lambda df, _f=MD.stored: (prepared.append(1), _f(df))[1])
    got = RM.q_importance(spark, SF001).collect()
    assert [r.model_name for r in got] == [n for _, n, _ in RM.ONE_OF_EACH] and all(r.known_ok and r.nonzero_ok and r.order_ok for r in got)
    assert len(prepared) == 2  # the training rows, without and with scaling


def test_the_matrix_of_the_last_fold_has_its_rows_alone(spark):
    from hazrank import registry_models as RM
    c = Ctx(spark, SF001)
    last, every = RM.model_matrix(c), RM.model_matrix(c, last=False)
    keys = ["handler_id", "label_year", "split", "history", "formal"]
    rows = [tuple(r) for r in every.select(*keys).collect()]
    _, train_years, val_year = RM.folds(c)[-1]
    want = [r for r in rows if (r[1] in train_years if r[2] == "train" else r[1] == val_year)]
    assert sorted(map(str, map(tuple, last.select(*keys).collect()))) == sorted(map(str, want)) and 0 < len(want) < len(rows)
    assert not last.exceptAll(every).head(1)
    # a fold reads the files of its flavour and split
    plan = plan_of(last.where("history AND split = 'val'"))
    assert "history#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    # labels off the partials are those of the inspections
    labels = {(r.handler_id, r.label_year): r.formal for r in L.label_formal(c.lt, every.select("handler_id", "label_year").distinct(), c.spine).collect()}
    assert labels == {r[:2]: r[4] for r in rows}
    p = c.partials()
    assert max(r[0] for r in p.waste.select("year").distinct().collect()) < val_year


def test_labels_of_reduced_inspections(spark):
    spine = T.config_spine(spark, Timeline())
    rows = [(1, 1998, 2), (1, 1999, 0), (2, 2000, 1), (3, 1990, 5), (None, 1998, 1)]
    got = L.label_formal_of(spark.createDataFrame(rows, "handler_id long, year int, n_enforcement long"), spine).collect()
    assert {tuple(r) for r in got} == {(1, 1998, 1), (1, 1999, 0), (2, 2000, 1), (None, 1998, 1)}


def test_sources_of_order_lines_share_one_join(spark, monkeypatch):
    from pyspark.testing import assertDataFrameEqual
    monkeypatch.setattr(M, "store_partials", lambda p: p)
    c = Ctx(spark, SF001)
    shared, plain = c.partials(), M.partials(c.lt_windows, c.lt_all)
    for name in ("inspections", "waste", "waste_codes", "owners"):
        assert not any("lineitem" in f for f in getattr(shared, name).inputFiles()), name
        assertDataFrameEqual(getattr(shared, name), getattr(plain, name))


def test_lines_keep_null_and_repeated_keys(spark):
    from hazrank.sources.mapping import LogicalTables
    o = spark.createDataFrame([(1, 7, "1995-03-01", "1-URGENT"), (1, None, "1996-03-01", "5-LOW"), (None, 7, "1995-03-01", "1-URGENT"), (2, 7, None, None)],
                              "o_orderkey long, o_custkey long, d string, o_orderpriority string").selectExpr("o_orderkey", "o_custkey", "CAST(d AS timestamp) AS o_orderdate", "o_orderpriority")
    li = spark.createDataFrame([(1, 3, 4, 1, 5.0, 6.0, 0.08, 0.06, "R", "F"), (1, 3, 4, 1, 5.0, 6.0, None, 0.06, "R", "F"), (2, None, 4, 2, 5.0, 6.0, 0.0, 0.0, "N", "O")],
                               "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                               "l_discount double, l_tax double, l_returnflag string, l_linestatus string")
    lt = LogicalTables(FakeTables(spark=spark, orders=o, lineitem=li))
    over = lt.over(M.store_lines(lt.order_lines))
    for years in (None, (1995, 1995), (None, 1996)):
        a, b = (x if years is None else x.bounded(*years) for x in (over, lt))
        assert sorted(map(str, a.waste.collect())) == sorted(map(str, b.waste.collect()))
        assert sorted(map(str, a.inspections_core.collect())) == sorted(map(str, b.inspections_core.collect()))
    assert over.waste.count() == 5


def test_flavours_and_scalings_run_side_by_side(spark, monkeypatch):
    import threading
    from hazrank import registry_models as RM
    m = small_matrix(spark)
    monkeypatch.setattr(RM, "model_matrix", lambda c: m)
    monkeypatch.setattr(RM, "folds", lambda c: FOLDS[-1:])
    met = threading.Barrier(2, timeout=60)  # breaks where one waits for the other's end

    def scores(*args, parallel, **kw):
        met.wait()
        return spark.createDataFrame([("dt_0", 2000, parallel, 0.5, None)], "model_id string, eval_year int, handler_id long, score double, formal long")
    with monkeypatch.context() as patch:
        patch.setattr(MD, "cv_scores", scores)
        assert sorted(r.with_history for r in RM.q_score_model(spark, SF001).collect()) == [False, True]
    rows = m.where("history").drop("history")
    train, val = rows.where("split = 'train' AND formal IS NOT NULL").drop("split"), rows.where("split = 'val'").drop("split")
    monkeypatch.setattr(MD, "stored", lambda df, _f=MD.stored: (met.wait(), _f(df))[1])
    assert list(MD.prepare_scalings(train, val, ["inspection_num"], ["land_type"], [False, True])) == [False, True]


def test_sources_are_joined_by_measured_hashing(spark, monkeypatch):
    key, seen = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", []
    before = spark.conf.get(key)
    monkeypatch.setattr(M, "store_lines", lambda lines: (seen.append(lines), lines)[1])
    monkeypatch.setattr(M, "store_partials", lambda p: p)
    p = Ctx(spark, SF001).partials()
    lines, = seen
    lines.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # its own session
    rows = lines.collect()
    plan = lines._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert rows and "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert M._session_like(p.inspections.sparkSession).conf.get(key) == M.HASHED_PARTITION  # the matrix's joins too
    assert spark.conf.get(key) == before


def test_joins_of_the_matrix_are_compiled_and_later_steps_as_set(spark, monkeypatch):
    from hazrank import registry_models as RM
    key, seen = "spark.sql.codegen.maxFields", []
    monkeypatch.setattr(RM.SF, "materialize", lambda m, *a: (seen.append((m.sparkSession.conf.get(key), len(m.columns))), m)[1])
    m = RM.model_matrix(Ctx(spark, SF001))
    (limit, columns), = seen
    assert int(limit) >= columns > 100
    assert m.sparkSession.conf.get(key) == spark.conf.get(key) == "100"
    own = M._session_like(spark)
    own.conf.set(key, "120")  # a limit that the caller set stays
    with M.compiled_joins(own):
        assert own.conf.get(key) == "120"
