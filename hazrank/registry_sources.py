"""Registered queries: sources and sinks (S1-S7).

The round-trip queries write under the session's shared checkpoint
folder and return what they read back.  The array-of-arrays replies are
derived from the tables (one reply per region: nations and their number
of entities), landed as text and ingested.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hazrank.plans import cohorts as C
from hazrank.queries import ctx, register
from hazrank.sources import files as SF

GRID_RECORD_SCHEMA = ("model_type string, model_name string, model_param string, precision_overtime string, "
                      "support_overtime string, with_history boolean")


@register("scan_table")
def q_s1(spark, sf_dir):
    return ctx(spark, sf_dir).lt_all.inspections


def _records(c, history):
    """The grid records in the column order of their files: readers check the
    header against the schema, column by column."""
    from hazrank.registry_eval import records
    return records(c, history).select(*StructType.fromDDL(GRID_RECORD_SCHEMA).names)


@register("scan_csv")
def q_s2(spark, sf_dir):
    c = ctx(spark, sf_dir)
    path = SF.shared_path(spark, "grid-csv")
    SF.sink(_records(c, True), path, "csv")
    return SF.scan_csv(spark, path, GRID_RECORD_SCHEMA)


@register("sink_parquet")
def q_s3(spark, sf_dir):
    c = ctx(spark, sf_dir)
    from hazrank.registry_eval import grid_results_long
    path = SF.shared_path(spark, "grid-long")
    SF.sink(grid_results_long(c, True), path, "parquet", ["eval_year"])
    return spark.read.parquet(path)


@register("sink_append")
def q_s4(spark, sf_dir):
    c = ctx(spark, sf_dir)
    path = SF.shared_path(spark, "selected")
    SF.sink(_records(c, True), path, "csv", mode="overwrite")
    SF.sink(_records(c, False), path, "csv", mode="append")
    return SF.scan_csv(spark, path, GRID_RECORD_SCHEMA)


@register("materialize_cohort")
def q_s5(spark, sf_dir):
    c = ctx(spark, sf_dir)
    path = SF.shared_path(spark, "cohorts")
    return SF.materialize(C.cohort_route(c.lt, c.spine), path, ["label_year", "split", "history"])


def census_replies(c):
    """One reply per region: header, then [nation name, 2-digit code,
    number of entities] per nation -- as JSON text."""
    n = c.wh.nation.select("n_nationkey", "n_name", "n_regionkey")
    r = c.wh.region.select("r_regionkey", "r_name")
    cust = c.wh.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("pop"))
    rows = (n.join(r, n.n_regionkey == r.r_regionkey).join(cust, n.n_nationkey == cust.c_nationkey)
             .select("r_regionkey",
                     F.array(F.concat_ws(", ", "n_name", "r_name"),
                             F.lpad(F.col("n_nationkey").cast("string"), 2, "0"),
                             F.col("pop").cast("string")).alias("row")))
    header = F.array(F.lit("NAME"), F.lit("state"), F.lit("population"))
    return rows.groupBy("r_regionkey").agg(
        F.to_json(F.concat(F.array(header), F.array_sort(F.collect_list("row")))).alias("value"))


def _landed(c, spark):
    path = SF.shared_path(spark, "census")
    census_replies(c).select("value").write.text(path)
    return spark.read.text(path)


@register("ingest_array_json")
def q_s6(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return SF.ingest_array_json(_landed(c, spark), numeric=("population",))


@register("geo_lookup")
def q_s7(spark, sf_dir):
    c = ctx(spark, sf_dir)
    return SF.geo_lookup(SF.ingest_array_json(_landed(c, spark), numeric=("population",)))


GRID_LONG_SCHEMA = ("model_name string, ranked long, i long, labelled_at_k long, positives_at_k long, "
                    "all_positives long, precision double, support double, recall double, fdr double, "
                    "model_type string, model_index int, model_param string, with_history boolean, eval_year int")


@register("sink_csv")
def q_s3_csv(spark, sf_dir):
    """Grid results written as CSV partitioned by evaluation year and read
    back with an explicit schema (partition column typed by the schema)."""
    c = ctx(spark, sf_dir)
    from hazrank.registry_eval import grid_results_long
    path = SF.shared_path(spark, "grid-long-csv")
    columns = [x.split()[0] for x in GRID_LONG_SCHEMA.split(", ")]
    SF.sink(grid_results_long(c, True).select(*columns), path, "csv", ["eval_year"])
    return SF.scan_csv(spark, path, GRID_LONG_SCHEMA)
