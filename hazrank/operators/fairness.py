"""Group fairness at the top k share, and a proportional final list.

Audits count over the cutoffs of ``topk``, without ranks; the final list needs
places and takes them from the distributed ``ordered_index``.  Group tables are
joined as ordinary (AQE-sized) joins.  Per-category counts group all ranked
rows, with any number of categories: one that is absent from the top gets
zeros, and one that is absent from a model's year gets no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazrank.operators.ranking import ordered_index, ratio_ladder, score_order, scored_with_labels, stored
from hazrank.operators.topk import share_of, top_cutoffs, with_top


# --- E8 -----------------------------------------------------------------------
def scored_in_groups(scores: DataFrame, labels: DataFrame, groups: DataFrame, group_col: str,
                     label_keys: Sequence[str] = ("eval_year",), entity_col: str = "handler_id") -> DataFrame:
    """All scored rows, stored, with label, ``labelled_row``, ``category`` and
    ``grouped_row`` (has the entity a row among ``groups``, one each?)."""
    g = groups.select(entity_col, F.col(group_col).alias("category"), F.lit(True).alias("grouped_row"))
    return stored(scored_with_labels(scores, labels, label_keys, entity_col).join(g, entity_col, "left")
                  .withColumn("grouped_row", F.coalesce("grouped_row", F.lit(False))))


def _disparities(per: DataFrame, g: list[str], ref_group) -> DataFrame:
    """Of counts per (group, category) -- positives ``_relevant``, labelled
    ``n_top`` and negative ``fp_top`` rows of the top -- the ratios to the
    reference category."""
    total = per.groupBy(*g).agg(F.sum("_relevant").alias("total_relevant"))
    full = per.where(F.col("category").isNotNull()).join(total, g, "inner")
    full = full.select(*g, "category", "n_top",
                       F.when(F.col("n_top") > 0, F.col("fp_top") / F.col("n_top")).alias("fdr"),
                       F.when(F.col("total_relevant") > 0, F.col("n_top") / F.col("total_relevant")).alias("recall"))
    ref = full.where(F.col("category") == F.lit(ref_group)).select(
        *g, F.col("n_top").alias("num_labeled_ref_k"), F.col("fdr").alias("_rf"), F.col("recall").alias("_rr"))
    comp = full.where(F.col("category") != F.lit(ref_group))
    out = comp.join(ref, g, "inner")
    return out.select(
        *g,
        F.concat(F.col("category").cast("string"), F.lit("_vs_"), F.lit(str(ref_group))).alias("group_name"),
        ratio_ladder(F.col("recall"), F.col("_rr")).alias("recall_disparity"),
        ratio_ladder(F.col("fdr"), F.col("_rf")).alias("fdr_ratio"),
        F.col("n_top").alias("num_labeled_k"), "num_labeled_ref_k")


def audit_at_k(scores: DataFrame, labels: DataFrame, groups: DataFrame, k: float, group_col: str, ref_group,
               keys: Sequence[str] = ("model_id", "eval_year"), label_keys: Sequence[str] = ("eval_year",),
               entity_col: str = "handler_id") -> DataFrame:
    """Per non-reference category: labelled count in the top i of the
    group-joined ranking, its share of all positives ("recall") and the
    share of labelled-negative rows (FDR), each as a ratio to the
    reference category (0/0 -> 1, x/0 -> inf), beside ``precision_k`` of the
    whole group.

    Two cutoffs mark the same stored rows: one at k of all scored rows
    (precision), one at k of the rows that have a category (disparities).
    One aggregate per (group, category) counts under both marks."""
    g = list(keys)
    rows = scored_in_groups(scores, labels, groups, group_col, label_keys, entity_col)
    both = F.col("labelled_row") & F.col("grouped_row")
    all_rows = top_cutoffs(rows, g, share_of(k), entity_col=entity_col, member=F.col("labelled_row"))
    # where no scored row lacks a label row or a category, both cutoffs are one
    differ = rows.where(~both).limit(1).count()
    merged = top_cutoffs(rows.where(both), g, share_of(k), entity_col=entity_col) if differ else all_rows
    marked = with_top(rows.where("labelled_row"), all_rows, g, "in_all", entity_col=entity_col)
    marked = with_top(marked, merged, g, "in_merged", entity_col=entity_col, how="left")
    top = F.col("in_merged") & F.col("grouped_row") & F.col("formal").isNotNull()
    # all rows are counted, so a category outside the top has zeros
    per = marked.groupBy(*g, "category", "grouped_row").agg(
        F.count(F.when(F.col("in_all"), F.col("formal"))).alias("_labelled"),
        F.coalesce(F.sum(F.when(F.col("in_all"), F.col("formal"))), F.lit(0)).alias("_positive"),
        F.coalesce(F.sum("formal"), F.lit(0)).alias("_relevant"),
        F.count(F.when(top, 1)).alias("n_top"),
        F.count(F.when(top & (F.col("formal") == 0), 1)).alias("fp_top"))
    per = stored(per)  # one row per group and category
    lab = F.sum("_labelled")
    prec = per.groupBy(*g).agg(F.when(lab > 0, F.sum("_positive") / lab).alias("precision_k"))
    return _disparities(per.where("grouped_row"), g, ref_group).join(prec, g, "inner")


def disparity_at_k(scores: DataFrame, labels: DataFrame, groups: DataFrame, k: float, group_col: str,
                   ref_group, keys: Sequence[str] = ("model_id", "eval_year"),
                   label_keys: Sequence[str] = ("eval_year",), entity_col: str = "handler_id") -> DataFrame:
    """The ratios of ``audit_at_k`` alone.  i is taken from the size of the
    group-joined frame."""
    g = list(keys)
    rows = scored_in_groups(scores, labels, groups, group_col, label_keys, entity_col).where("labelled_row AND grouped_row")
    top = F.col("top") & F.col("formal").isNotNull()
    per = with_top(rows, top_cutoffs(rows, g, share_of(k), entity_col=entity_col), g, entity_col=entity_col)
    per = per.groupBy(*g, "category").agg(
        F.coalesce(F.sum("formal"), F.lit(0)).alias("_relevant"),
        F.count(F.when(top, 1)).alias("n_top"),
        F.count(F.when(top & (F.col("formal") == 0), 1)).alias("fp_top"))
    return _disparities(per, g, ref_group)


# --- E11 ----------------------------------------------------------------------
def proportional_top_n(scores: DataFrame, groups: DataFrame, n: int, group_col: str,
                       keys: Sequence[str] = ("model_id", "eval_year"),
                       entity_col: str = "handler_id", group_keys: Sequence[str] = ()) -> DataFrame:
    """Final list of n entities split over exclusive groups in proportion to
    their size: floor quotas plus largest remainders (ties by category),
    then the best-scored entities of each group up to its quota.

    ``group_keys``: further keys of ``groups`` beside the entity (the year,
    where an entity changes groups over time)."""
    g = list(keys)
    on = [entity_col, *group_keys]
    j = scores.join(groups.select(*on, F.col(group_col).alias("category")), on, "inner")
    sizes = j.groupBy(*g, "category").agg(F.count(F.lit(1)).alias("size"))
    wg = Window.partitionBy(*g)
    q = (sizes.withColumn("total", F.sum("size").over(wg))
              .withColumn("list_n", F.least(F.lit(n), F.col("total")))
              .withColumn("exact", F.col("list_n") * F.col("size") / F.col("total"))
              .withColumn("base", F.floor("exact").cast("long"))
              .withColumn("leftover", F.col("list_n") - F.sum("base").over(wg))
              .withColumn("rrank", F.row_number().over(
                  wg.orderBy((F.col("exact") - F.col("base")).desc(), F.col("category").asc())))
              .withColumn("quota", F.col("base") + F.when(F.col("rrank") <= F.col("leftover"), 1).otherwise(0)))
    ranked = ordered_index(j, [*g, "category"], score_order("score", entity_col), rn_col="group_rank")
    out = ranked.join(q.select(*g, "category", "quota"), [*g, "category"], "inner")
    return out.where(F.col("group_rank") <= F.col("quota")).select(
        *g, entity_col, F.col("category").alias(group_col), "score", "group_rank")
