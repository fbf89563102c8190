"""Registered queries: matrix assembly (M) and transformations (X)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazrank.operators import transform as X
from hazrank.plans import cohorts as C
from hazrank.plans import features as FT
from hazrank.plans import labels as L
from hazrank.plans import matrix as M
from hazrank.queries import ctx, register, rounded


@register("join_windows")
def q_join_windows(spark, sf_dir):
    c = ctx(spark, sf_dir)
    coh = C.cohort_active(c.lt, c.spine)
    frames = [FT.feat_violation_history(c.lt, coh, c.spine, (w,)) for w in FT.ALL_WINDOWS]
    return rounded(M.join_windows(frames))


@register("build_matrix")
def q_build_matrix(spark, sf_dir):
    c = ctx(spark, sf_dir)
    p = c.partials()
    return rounded(M.build_matrix(p, p.cohort_active(c.spine), c.spine))


@register("assert_one_row_per_entity")
def q_assert_one_row(spark, sf_dir):
    """From the keys of the cohort, the reports and the code table alone."""
    c = ctx(spark, sf_dir)
    return M.matrix_key_violations(c.lt.site_report, c.lt.naics, C.cohort_active(c.lt, c.spine), c.spine)


@register("stack_years")
def q_stack_years(spark, sf_dir):
    """Labels of the training years upon those of the later validation years,
    each stack one plan over its years."""
    c = ctx(spark, sf_dir)
    val = c.val_spine
    stacks = [val.where("is_train"), val.where("NOT is_train")]
    return M.stack_years([L.label_formal(c.lt, C.cohort_active(c.lt, sp), sp) for sp in stacks])


@register("join_labels")
def q_join_labels(spark, sf_dir):
    c = ctx(spark, sf_dir)
    coh = C.cohort_active(c.lt, c.val_spine)
    feats = FT.feat_inspection_history(c.lt, coh, c.val_spine)
    labels = L.label_formal(c.lt, coh, c.val_spine)
    return M.join_labels(feats, labels)


@register("drop_unlabelled_train")
def q_drop_unlabelled(spark, sf_dir):
    c = ctx(spark, sf_dir)
    sp = c.spine.where("is_train")
    coh = C.cohort_train(c.lt, sp)
    m = M.join_labels(FT.feat_inspection_history(c.lt, coh, sp), L.label_formal(c.lt, coh, sp))
    return M.drop_unlabelled(m)


@register("split_features_label")
def q_split_features_label(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array
    c = ctx(spark, sf_dir)
    coh = C.cohort_active(c.lt, c.val_spine)
    m = M.join_labels(FT.window_features_single_pass(c.lt, coh, c.val_spine),
                      L.label_formal(c.lt, coh, c.val_spine))
    v = M.split_features_label(X.flag_missing(m, ["inspection_num", "violation_per_inspection",
                                                  "complaint_per_inspection", "formal_enforcement_per_inspection",
                                                  "sum_penalty_amount"]))
    return v.select("handler_id", "label_year", "formal", F.size(vector_to_array("features")).alias("n_features"))


INSPECTION_BASES = ["inspection_num"]


@register("flag_missing")
def q_flag_missing(spark, sf_dir):
    c = ctx(spark, sf_dir)
    f = FT.feat_inspection_history(c.lt, C.cohort_active(c.lt, c.spine), c.spine)
    return X.flag_missing(f, INSPECTION_BASES)


GEO_BASES = ["land_type", "state_district"]


def _geo(c, spine):
    return FT.feat_geographic(c.lt_all, C.cohort_active(c.lt, spine), spine)


@register("onehot_fit")
def q_onehot_fit(spark, sf_dir):
    c = ctx(spark, sf_dir)
    out, _ = X.onehot_fit_transform(_geo(c, c.spine.where("is_train")), GEO_BASES)
    return out


@register("onehot_transform")
def q_onehot_transform(spark, sf_dir):
    c = ctx(spark, sf_dir)
    model = X.onehot_fit(_geo(c, c.spine.where("is_train")), GEO_BASES)
    return model.transform(_geo(c, c.val_spine))


@register("align_columns")
def q_align_columns(spark, sf_dir):
    c = ctx(spark, sf_dir)
    tr_sp, va_sp = c.spine.where("is_train"), c.val_spine
    bases = ["num_active_facilities_parent_company"]
    tr = X.flag_missing(FT.feat_parent_company_size(c.lt_all, C.cohort_train(c.lt, tr_sp), tr_sp), bases)
    va = X.flag_missing(FT.feat_parent_company_size(c.lt_all, C.cohort_active(c.lt, va_sp), va_sp), bases)
    _, va2 = X.align_columns(tr, va)
    return va2


@register("minmax_normalize")
def q_minmax(spark, sf_dir):
    c = ctx(spark, sf_dir)
    f = FT.window_features_single_pass(c.lt, C.cohort_active(c.lt, c.spine), c.spine)
    cols = [x for x in f.columns if x not in ("handler_id", "label_year")]
    return rounded(X.minmax_normalize(f, cols))


@register("impute_transform")
def q_impute_transform(spark, sf_dir):
    c = ctx(spark, sf_dir)
    tr_sp, va_sp = c.spine.where("is_train"), c.val_spine

    def frame(sp):
        coh = C.cohort_active(c.lt, sp)
        return FT.feat_geographic(c.lt_all, FT.feat_inspection_history(c.lt, coh, sp), sp)
    tr, va = frame(tr_sp), frame(va_sp)
    it = X.ImputeTransform(INSPECTION_BASES, GEO_BASES).fit(tr, va)
    return it.transform(va)
