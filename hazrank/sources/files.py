"""File sources and sinks.

Sinks write under a caller-given folder (on a cluster: a shared path,
e.g. below ``spark.checkpoint.dir``), partitioned by the evaluation year
or cohort keys so later reads prune partitions.  Readers always take an
explicit schema: no inference pass over the data.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint directory."""
    from hazrank.session import checkpoint_dir
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/hazrank-out/{name}-{uuid.uuid4().hex[:12]}"


# --- S1 -----------------------------------------------------------------------
def scan_table(spark: SparkSession, location: str, name: str, fmt: str = "parquet") -> DataFrame:
    """A parquet/ORC folder, or a catalog table when ``fmt == 'catalog'``."""
    if fmt == "catalog":
        return spark.table(f"{location}.{name}")
    return spark.read.format(fmt).load(f"{location.rstrip('/')}/{name}.{fmt}")


def scan_jdbc(spark: SparkSession, url: str, table: str, props: dict, partition_col: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Relational source read in parallel ranges of a numeric column."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in props.items():
        r = r.option(k, v)
    if partition_col:
        r = (r.option("partitionColumn", partition_col).option("lowerBound", lower)
              .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


# --- S2 -----------------------------------------------------------------------
def scan_csv(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str,
             quote: str = "'") -> DataFrame:
    """CSV with header and an explicit schema (several files are stacked)."""
    return spark.read.csv(paths if isinstance(paths, str) else list(paths), header=True, schema=schema,
                          quote=quote, mode="FAILFAST", enforceSchema=False)


# --- S3 / S4 --------------------------------------------------------------------
def sink(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
         mode: str = "overwrite", quote: str = "'") -> str:
    """Write a frame (no index column), partitioned by the given keys.

    ``mode='append'`` adds files next to the existing ones (the append
    sink); overwrite replaces only the written partitions when dynamic
    partition overwrite is on.
    """
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True).option("quote", quote)
    w.format(fmt).save(path)
    return path


# --- S5 -----------------------------------------------------------------------
def materialize(df: DataFrame, path: str, partition_by: Sequence[str]) -> DataFrame:
    """Write and re-open a frame (e.g. cohorts by label_year/history).

    Existing partitions of the same keys are overwritten, never silently
    reused; the returned frame reads the written files, which also cuts
    the lineage."""
    spark = df.sparkSession
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    # the written schema types the partition columns (no inference)
    return spark.read.schema(df.schema).parquet(path)


# --- S6 -----------------------------------------------------------------------
def _reply(value_col: str) -> Column:
    return F.from_json(F.col(value_col), "array<array<string>>")


def _well_formed(a: Column) -> Column:
    """A header of distinct names, and rows as long as it."""
    h = F.element_at(F.when(F.size(a) > 0, a), 1)
    ok = ((F.size(F.array_distinct(h)) == F.size(h)) & ~F.exists(h, lambda x: x.isNull())
          & F.forall(a, lambda r: F.coalesce(F.size(r) == F.size(h), F.lit(False))))
    return F.coalesce(ok, F.lit(False))


def rejected_replies(replies: DataFrame, value_col: str = "value") -> DataFrame:
    """The replies that ``ingest_array_json`` cannot read, as they came."""
    return replies.where(~_well_formed(_reply(value_col)))


def ingest_array_json(replies: DataFrame, value_col: str = "value", numeric: Sequence[str] = ()) -> DataFrame:
    """Replies shaped ``[[h1, h2, ...], [v1, v2, ...], ...]`` (header first)
    -> one row per data row with the header as column names.

    Each reply is parsed on its own and read by its own header; the columns
    are the union of all headers (by first place, then name), NULL where a
    reply lacks one.  ``rejected_replies`` returns the replies that are not
    of this shape.  Numeric columns are ``try_cast`` to DOUBLE.
    """
    parsed = replies.select(_reply(value_col).alias("_a")).where(_well_formed(F.col("_a")))
    rows = parsed.select(F.element_at("_a", 1).alias("_h"),
                         F.explode(F.slice("_a", 2, F.size("_a") - 1)).alias("_r"))
    m = rows.select(F.map_from_arrays("_h", "_r").alias("_m"))
    # column names: as many as the result has columns
    heads = parsed.select(F.posexplode(F.element_at("_a", 1)).alias("p", "n"))
    names = [r["n"] for r in heads.groupBy("n").agg(F.min("p").alias("p")).orderBy("p", "n").collect()]
    return m.select(*[(F.col("_m")[n].try_cast("double") if n in numeric else F.col("_m")[n]).alias(n)
                      for n in names])


# --- S7 -----------------------------------------------------------------------
def geo_lookup(places: DataFrame, name_col: str = "NAME", id_cols: Sequence[str] = ("state",)) -> DataFrame:
    """name <-> id lookup: the area name is the text before the first comma,
    the id is the last code column."""
    return places.select(F.col(name_col).alias("name"),
                         F.trim(F.split(F.col(name_col), ",").getItem(0)).alias("area_name"),
                         F.col(id_cols[-1]).alias("area_id"))
