"""End-to-end: mapping row counts, the minimum-slice golden, entry()
smoke, and a set of registered queries against the DuckDB oracle."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from conftest import SF001, SF01
from hazrank.queries import Ctx


def test_mapping_counts_sf0001(spark):
    lt = Ctx(spark, SF001).lt_all
    assert lt.inspections.count() == 1147
    assert lt.site_report.count() == 798
    assert lt.owner.count() == 1605
    assert lt.waste.count() == 6000
    assert lt.waste_code.count() == 3930


def test_minimum_slice_golden(spark):
    import __spark_entry__ as E
    q = E.queries()["precision_support_recall_at_k"]
    r = {x.eval_year: x for x in q(spark, SF01).collect()}[2000]
    assert (r.ranked, r.i, r.labelled_at_k, r.positives_at_k, r.all_positives) == (932, 195, 42, 20, 111)
    assert (r.precision, r.support, r.recall) == (0.47619, 0.215385, 0.18018)
    r = {x.eval_year: x for x in q(spark, SF001).collect()}[2000]
    assert (r.ranked, r.i, r.labelled_at_k, r.positives_at_k, r.all_positives) == (101, 21, 0, 0, 8)
    assert r.precision is None and r.support == 0.0 and r.recall == 0.0


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "score" in df.columns


FAST_KEYS = ["timeline_spine", "cohort_sizes", "label_formal", "feat_violation_history", "feat_waste_info",
             "feat_parent_company_peers", "feat_zip_peers", "feat_waste_code", "flag_missing", "minmax_normalize",
             "precision_recall_curve", "grid_expand", "ingest_array_json", "final_list_by_history", "disparity_at_k", "proportional_top_n", "commonsense_rank",
             "describe_column", "joined_distribution", "grid_result_sink", "rank_models_avg", "bias_audit", "confusion_matrix",
             "cohort_route", "build_matrix", "feat_parent_company_size", "split_features_label", "to_pounds"]


@pytest.mark.parametrize("key", FAST_KEYS)
def test_against_oracle_sf0001(spark, key):
    import __spark_entry__ as E
    from oracle_compare import compare, duck
    ok, n, _, detail = compare(spark, duck(SF001), key, E.queries()[key], E.oracle_sql()[key], SF001)
    assert ok, detail


def test_every_query_has_an_oracle():
    import __spark_entry__ as E
    assert set(E._load()) <= set(E.oracle_sql())


def test_grid_records_are_read_back_from_csv(spark, monkeypatch):
    from hazrank import registry_sources as RS
    rows = [("baseline", f"baseline_{i}", f"window=total;feature=f{i}", h, y, 0.5 + y % 2 / 4, None if i else 0.25)
            for i in range(2) for h in (True, False) for y in (1998, 1999)]
    long = spark.createDataFrame(rows, "model_type string, model_name string, model_param string, with_history boolean, eval_year int, "
                                       "precision double, support double")
    c = Ctx(spark, SF001)
    for h in (True, False):
        c.__dict__["_grid_results", h] = long.where(long.with_history == h)
    monkeypatch.setattr(RS, "ctx", lambda *_: c)
    for query, flavours in ((RS.q_s2, [True]), (RS.q_s4, [False, True])):
        got = query(spark, SF001)
        assert got.columns == ["model_type", "model_name", "model_param", "precision_overtime", "support_overtime", "with_history"]
        assert sorted(map(tuple, got.collect())) == [("baseline", f"baseline_{i}", f"window=total;feature=f{i}", "0.500000;0.750000", s, h)
                                                     for i, s in ((0, "0.250000;0.250000"), (1, "nan;nan")) for h in flavours]
