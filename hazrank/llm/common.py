"""Helpers shared by the corpus operators: tables, staged tables in the shared
folder, joins with hot keys, and connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ``hot_join`` broadcasts the keys that hold more than 1/HOT_PARTS of the
#: rows; there are fewer than HOT_PARTS of those, whatever the input.
HOT_PARTS = 1000

_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Only a ``local[...]`` session may go without that setting: driver and
    executors are one machine there, so a temporary folder serves.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="corpus-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def staged(df: DataFrame, codec: str = "snappy") -> DataFrame:
    """``df`` written once to the shared folder and read back: the lineage is
    cut, a lost executor costs no recomputation, and later column pruning
    reaches the files."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    top = os.path.dirname(root)
    path = os.path.join(tempfile.mkdtemp(prefix="corpus-code-"), f"code-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, top))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(text: Column) -> Column:
    """SHA-256 of a whole text; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def hot_join(left: DataFrame, right: DataFrame, key: str, n_rows: str, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` on ``key``, for a key that may hold a
    large share of ``left``.

    ``right`` has one row per key and the key's number of rows of ``left`` in
    column ``n_rows`` (dropped from the result).  Keys above 1/HOT_PARTS of
    all rows are fewer than HOT_PARTS, so their side is broadcast and their
    rows stay where they are; the rest meets in a shuffle join.
    """
    total = right.agg(F.sum(n_rows)).first()[0] or 0
    cut = max(total / HOT_PARTS, 1)
    hot = right.filter(F.col(n_rows) > cut).drop(n_rows)
    cold = right.filter(F.col(n_rows) <= cut).drop(n_rows)
    there = left.join(F.broadcast(hot), key, "inner")
    rest = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, how)
    return there.select(rest.columns).unionByName(rest)


def keep_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` named by ``keys`` (doc_id, text_key, n), with
    ``docs``' own columns.

    ``n`` counts the rows of ``docs`` with that id and text.  Repeated rows
    are the same document, of which one stays; null ids match null ids.
    """
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    marked = marked.select("row", F.col("row.doc_id").alias("_id"), text_key(F.col("row.text")).alias("_text_key"))
    k = keys.select(F.col("doc_id").alias("_kid"), F.col("text_key").alias("_kkey"))
    out = marked.join(k, F.col("_id").eqNullSafe(F.col("_kid")) & (F.col("_text_key") == F.col("_kkey")), "left_semi")
    if keys.filter(F.col("n") > 1).limit(1).count():
        out = out.dropDuplicates(["_id", "_text_key"])
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an edge list (``a``, ``b`` long): one row
    (``node``, ``root``) per node that is not its component's smallest.

    Alternating large-star and small-star rounds; every round's edges are
    staged in the shared folder, and the rounds end when the edge list stays
    as it is.  The work of a round is a few joins on the edge list; nothing of
    it reaches the driver but its count and checksum.
    """
    edge = lambda a, b: [F.greatest(a, b).alias("a"), F.least(a, b).alias("b")]
    e = staged(edges.filter("a <> b").select(*edge("a", "b")).distinct())
    seen = None
    while True:
        mark = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if mark["n"] == 0 or (mark["n"], mark["s"]) == seen:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = (mark["n"], mark["s"])
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        star = both.filter("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        low = star.groupBy("a").agg(F.min("b").alias("m"))
        down = star.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = staged(low.select("a", F.col("m").alias("b")).union(down).distinct())
