"""Ranking and top-k evaluation under missing labels.

The central primitive is ``ordered_index``: an exact 1-based row number
within groups, in a total order, computed without a window that holds a
whole group in one task.  A ranking window partitioned by
(model, year) puts every scored entity of that year into one task; one
group may hold a third of all rows, so instead

1. range-partition on (group keys, order keys) -- a hot group is split
   over many partitions -- and sort within partitions;
2. tag each row with its partition id and position in the partition,
   and cut the lineage with a reliable ``checkpoint()``.  This is
   required, not an optimisation: the input usually comes out of a
   shuffle whose read order is not deterministic, so the range-bound
   sample -- and with it the partition ids -- would differ between the
   two reads of the tagged rows (and after a lost executor);
3. count rows per (partition, group): at most partitions + groups rows;
4. a running sum over that small table gives each (partition, group)
   its offset; join it back (broadcast is decided by AQE at run time
   from the measured size) and add the local position.

Rankings that give every row its place (lists, curves) use it.  Metrics and
audits at a cutoff need no place but the last one: they count over the cutoffs
of ``topk`` instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LOCAL_BITS = 33  # monotonically_increasing_id = partition << 33 | record number


def _num_partitions(df: DataFrame) -> int:
    spark = df.sparkSession
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ordered_index(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                  rn_col: str = "rn", with_group_size: bool = False,
                  num_partitions: int | None = None, materialize: bool = True) -> DataFrame:
    """Add ``rn``: row number within ``group_cols`` following ``order``.

    ``order`` must be a total order inside a group (end it with the
    entity key) so that the numbering is deterministic.  With
    ``with_group_size`` a ``group_size`` column is added as well.
    """
    from hazrank.session import checkpoint_dir

    n = num_partitions or _num_partitions(df)
    keys = [F.col(c).asc() for c in group_cols] + list(order)
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    pid = F.spark_partition_id()
    tagged = (ranged
              .withColumn("_pid", pid)
              .withColumn("_loc", F.monotonically_increasing_id()
                          - F.shiftleft(pid.cast("long"), _LOCAL_BITS)))
    if materialize:
        checkpoint_dir(df.sparkSession)
        tagged = tagged.checkpoint(eager=True)
    gkeys = ["_pid", *group_cols]
    stats = tagged.groupBy(*gkeys).agg(F.min("_loc").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*group_cols).orderBy("_pid")
    stats = stats.withColumn(
        "_off", F.coalesce(F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    if with_group_size:
        stats = stats.withColumn("group_size", F.sum("_cnt").over(Window.partitionBy(*group_cols)))
    keep = ["_pid", *group_cols, "_first", "_off"] + (["group_size"] if with_group_size else [])
    out = tagged.join(stats.select(*keep), on=gkeys, how="inner")
    out = out.withColumn(rn_col, F.col("_off") + F.col("_loc") - F.col("_first") + F.lit(1))
    return out.drop("_pid", "_loc", "_first", "_off")


def score_order(score_col: str = "score", entity_col: str = "handler_id") -> list[Column]:
    """Descending score, entity ascending as the deterministic tie-break."""
    return [F.col(score_col).desc_nulls_last(), F.col(entity_col).asc()]


# --- E1 ---------------------------------------------------------------------
def rank_scores(scores: DataFrame, labels: DataFrame, group_cols: Sequence[str] = ("model_id", "eval_year"),
                entity_col: str = "handler_id", score_col: str = "score",
                label_year_col: str = "eval_year") -> DataFrame:
    """Inner join of labels and scores, numbered by descending score.

    ``scores``: (group_cols..., entity, score); ``labels``: (eval_year,
    entity, formal) with NULL formal = not observed.
    """
    j = scores.join(labels, on=[label_year_col, entity_col], how="inner")
    return ordered_index(j, list(group_cols), score_order(score_col, entity_col))


def group_sizes(scores: DataFrame, group_cols: Sequence[str] = ("model_id", "eval_year")) -> DataFrame:
    return scores.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n_scored"))


# --- E2, E3, E4 -------------------------------------------------------------
def scored_with_labels(scores: DataFrame, labels: DataFrame, label_keys: Sequence[str] = ("eval_year",),
                       entity_col: str = "handler_id") -> DataFrame:
    """All scored rows with their label and ``labelled_row``: has the entity a
    row among the labels (whose value may be NULL)?"""
    return scores.join(labels.withColumn("labelled_row", F.lit(True)), [*label_keys, entity_col], "left") \
        .withColumn("labelled_row", F.coalesce("labelled_row", F.lit(False)))


def metrics_at_k(scored: DataFrame, k: float, group_cols: Sequence[str] = ("model_id", "eval_year"),
                 label_col: str = "formal", positives: DataFrame | None = None,
                 entity_col: str = "handler_id") -> DataFrame:
    """Precision, support, recall, FDR and labelled count at the top k share.

    ``scored`` (``scored_with_labels``, a stored frame) is counted, never
    sorted: the top i ends at the cutoff of ``topk.top_cutoffs``.
    ``positives`` (``year_positives``) counts the positives of the whole
    label table; without it those of the ranked rows are taken.

    precision = positives / labelled in the top i (NULL when none labelled)
    support   = labelled / i (NULL when i = 0)
    recall    = positives in the top i / all positives (NULL when none)
    fdr       = (labelled - positives) / labelled
    """
    from hazrank.operators.topk import share_of, top_cutoffs, with_top
    g = list(group_cols)
    cutoffs = top_cutoffs(scored, g, share_of(k), entity_col=entity_col, member=F.col("labelled_row"))
    y = F.col(label_col)
    agg = with_top(scored.where("labelled_row"), cutoffs, g, entity_col=entity_col).groupBy(*g).agg(
        F.count(F.when(F.col("top"), y)).alias("labelled_at_k"),
        F.coalesce(F.sum(F.when(F.col("top"), y)), F.lit(0)).alias("positives_at_k"),
        F.coalesce(F.sum(y), F.lit(0)).alias("all_positives"),
    ).join(F.broadcast(cutoffs.select(*g, F.col("n").alias("ranked"), "i")), g, "inner")
    if positives is not None:
        year = [c for c in positives.columns if c != "all_positives"]
        agg = agg.drop("all_positives").join(positives, year, "inner")
    lab, pos = F.col("labelled_at_k"), F.col("positives_at_k")
    return agg.select(
        *g, "ranked", "i", "labelled_at_k", "positives_at_k", "all_positives",
        F.try_divide(pos.cast("double"), F.when(lab > 0, lab)).alias("precision"),
        F.try_divide(lab.cast("double"), F.when(F.col("i") > 0, F.col("i"))).alias("support"),
        F.try_divide(pos.cast("double"), F.when(F.col("all_positives") > 0, F.col("all_positives"))).alias("recall"),
        F.try_divide((lab - pos).cast("double"), F.when(lab > 0, lab)).alias("fdr"),
    )


def year_positives(labels: DataFrame, label_keys: Sequence[str] = ("eval_year",), label_col: str = "formal") -> DataFrame:
    """Positives of each year over all its labels, scored or not."""
    return labels.groupBy(*label_keys).agg(F.coalesce(F.sum(label_col), F.lit(0)).cast("long")
                                           .alias("all_positives"))


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (cuts lineage;
    a lost executor re-reads files instead of recomputing)."""
    from hazrank.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """As ``materialize``, but as Parquet in the shared folder: for frames
    that are read several times, a few columns at a time."""
    from hazrank.sources.files import shared_path
    path = shared_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def precision_at_k(scores: DataFrame, labels: DataFrame, k: float,
                   group_cols: Sequence[str] = ("model_id", "eval_year"),
                   label_keys: Sequence[str] = ("eval_year",), materialize_labels: bool = False) -> DataFrame:
    """E2-E4 for every group.  Scores are read once and stored with their
    labels; labels are read twice (join, and positives of the year), so with
    ``materialize_labels`` they are stored first."""
    if materialize_labels:
        labels = stored(labels)
    scored = stored(scored_with_labels(scores, labels, label_keys))
    return metrics_at_k(scored, k, group_cols, positives=year_positives(labels, label_keys))


# --- E5 ---------------------------------------------------------------------
def precision_recall_curve(ranked: DataFrame, group_cols: Sequence[str] = ("model_id", "eval_year"),
                           label_col: str = "formal", block_rows: int = 1 << 20,
                           sizes: DataFrame | None = None, positives: DataFrame | None = None) -> DataFrame:
    """Precision and recall at every prefix i = 1..n of the ranking.

    ``sizes`` (``group_sizes``) and ``positives`` (``year_positives``) give
    the denominators over all scores and all labels; without them the ranked
    rows are taken.

    ``ranked`` carries the exact row number ``rn`` of ``ordered_index``.
    Rows are cut into blocks of ``block_rows`` consecutive ranks; running
    sums are windowed per block (a bounded task) and the sums of all
    preceding blocks come from a small per-block table.  Both values are
    NULL while no labelled row has been seen.
    """
    g = list(group_cols)
    y = F.col(label_col)
    b = (ranked
         .withColumn("_is_lab", F.when(y.isNotNull(), F.lit(1)).otherwise(F.lit(0)))
         .withColumn("_pos", F.coalesce(y, F.lit(0)).cast("long"))
         .withColumn("_blk", F.floor((F.col("rn") - 1) / F.lit(block_rows)).cast("long")))
    w_local = Window.partitionBy(*g, "_blk").orderBy("rn").rowsBetween(Window.unboundedPreceding, 0)
    local = (b.withColumn("_lab_run", F.sum("_is_lab").over(w_local))
              .withColumn("_pos_run", F.sum("_pos").over(w_local)))
    blk = b.groupBy(*g, "_blk").agg(F.sum("_is_lab").alias("_bl"), F.sum("_pos").alias("_bp"),
                                    F.count(F.lit(1)).alias("_bn"))
    wb = Window.partitionBy(*g).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    wg = Window.partitionBy(*g)
    blk = blk.select(*g, "_blk",
                     F.coalesce(F.sum("_bl").over(wb), F.lit(0)).alias("_ol"),
                     F.coalesce(F.sum("_bp").over(wb), F.lit(0)).alias("_op"),
                     F.sum("_bn").over(wg).alias("n_total"),
                     F.sum("_bp").over(wg).alias("pos_total"))
    if sizes is not None:
        blk = blk.join(sizes, g, "inner").withColumn("n_total", F.col("n_scored"))
    if positives is not None:
        year = [c for c in positives.columns if c != "all_positives"]
        blk = blk.join(positives, year, "inner").withColumn("pos_total", F.col("all_positives"))
    j = local.join(blk, on=[*g, "_blk"], how="inner")
    lab = F.col("_lab_run") + F.col("_ol")
    pos = F.col("_pos_run") + F.col("_op")
    return j.select(
        *g, "rn",
        (F.col("rn") / F.col("n_total")).alias("k"),
        F.when(lab > 0, pos / lab).alias("precision"),
        F.when(lab > 0, F.try_divide(pos.cast("double"),
                                     F.when(F.col("pos_total") > 0, F.col("pos_total")))).alias("recall"),
    )


# --- E6, E7 -----------------------------------------------------------------
def threshold_classify(scores: DataFrame, threshold: float = 0.5, score_col: str = "score") -> DataFrame:
    return scores.withColumn("predicted", F.when(F.col(score_col) > F.lit(threshold), 1).otherwise(0))


def confusion_matrix(classified: DataFrame, group_cols: Sequence[str] = ("model_id", "eval_year"),
                     label_col: str = "formal", pred_col: str = "predicted",
                     labels: Sequence[int] | None = None) -> DataFrame:
    """Counts of (true, predicted) on labelled rows, one row per true label.

    ``labels`` indexes the matrix: rows ``actual`` and columns ``predicted_*``
    in its order, zeros for a label that does not occur, other labels left
    out; ``place`` numbers the rows."""
    g = list(group_cols)
    lab = classified.where(F.col(label_col).isNotNull())
    cells = lambda values: [F.count(F.when(F.col(pred_col) == v, 1)).alias(f"predicted_{v}") for v in values]
    if labels is None:
        return lab.groupBy(*g, F.col(label_col).alias("actual")).agg(*cells((0, 1)))
    kind = classified.schema[label_col].dataType.simpleString()
    index = F.explode(F.array(*[F.struct(F.lit(n).alias("place"), F.lit(v).cast(kind).alias("actual")) for n, v in enumerate(labels)]))
    rows = lab.select(*g).distinct().select(*g, index.alias("_r")).select(*g, "_r.place", "_r.actual")
    counts = lab.groupBy(*g, F.col(label_col).alias("actual")).agg(*cells(labels))
    return rows.join(counts, [*g, "actual"], "left").na.fill(0, [f"predicted_{v}" for v in labels]).select(
        *g, "place", "actual", *[f"predicted_{v}" for v in labels])


# --- E8 ratio ladder ----------------------------------------------------------
def ratio_ladder(value: Column, reference: Column) -> Column:
    """Disparity ratio: 0/0 -> 1, x/0 -> inf, else value / reference.

    An undefined value (NULL) gives NULL.
    """
    return (F.when(value.isNull() | reference.isNull(), F.lit(None).cast("double"))
            .when((reference == 0) & (value == 0), F.lit(1.0))
            .when(reference == 0, F.lit(float("inf")))
            .otherwise(value / reference))
