"""Mixing sources to target weights along a time-varying curriculum.

Training time runs from 0 to 1.  Every source has a weight schedule, linear
between knots.  Its integral is the source's weight in the whole mix; the
weights share a number of words, no source above ``most`` times its own size
(what exceeds that is shared again by weight until none is above).  Within a
source the documents follow one another in the order of a digest of their id,
pass after pass, until the source's words are used up: the last document is
taken in part, so that the target is met to the word.  A document's training
position is the time at which the source's cumulative demand -- the integral
of its schedule, scaled to the words taken -- reaches the document's middle.
Documents are then range-sorted by position.

DataFrame functions only.  A source may hold any share of the rows: the
running sums have two levels, one within slots of a source (slots follow a
digest, their number the row count), one over the slots' sums.

Defined cases: a null text has size 0; a null doc_id comes first in its source;
a null source is a source of its own, after all others; repeated rows count each
for themselves, and rows of one id follow one another by text and row number
(an id of very many rows last in its slot); a source without words has target 0;
a very long text is counted where it lies; columns beyond doc_id, text and
source are not read (``mixed_documents`` carries them along in one struct, so
their names cannot clash); an empty table gives an empty mix.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazrank.llm.common import staged, text_key

#: (time, weight) knots; the k-th source in code point order takes schedule
#: k modulo 3.  Their integrals are 3, 1 and 2: level, rising and falling.
SCHEDULES = (((0.0, 3.0), (1.0, 3.0)), ((0.0, 0.5), (1.0, 1.5)), ((0.0, 3.0), (0.5, 2.0), (1.0, 1.0)))
SHARE = 1.5
MOST = 2.0
#: Rows that share a slot of the running sum, about; the square root of all
#: rows, if that is more, so that neither level of the sum grows beyond it.
SLOT_ROWS = 1000
WORD = r"[^\x20\x09-\x0D]+"


def integral(knots: tuple) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:]))


def source_targets(sizes: DataFrame, schedules=SCHEDULES, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Per source: ``skey``, ``source_size``, ``schedule`` (its number) and
    ``target``, by filling up to a common level: sources in the order in which
    they reach their cap, and the first level that the rest stays below.

    One row per source goes through the windows, not one per document.
    """
    weights = F.array(*[F.lit(integral(s)) for s in schedules])
    per = sizes.groupBy("skey").agg(F.sum("size").alias("source_size"), F.first("is_null").alias("is_null"))
    rank = Window.orderBy("is_null", "skey")
    per = per.withColumn("schedule", (F.row_number().over(rank) - 1) % len(schedules))
    per = per.withColumn("weight", weights[F.col("schedule")]).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    by = Window.orderBy(F.col("cap") / F.col("weight"), "is_null", "skey")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    total = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = (per.withColumn("words", F.lit(float(share)) * F.sum("source_size").over(total))
           .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("open", F.sum("weight").over(total) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    per = per.withColumn("level", (F.col("words") - F.col("capped")) / F.col("open"))
    per = per.withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
    level = F.min(F.when(F.col("fits"), F.struct(F.col("cap") / F.col("weight"), F.col("level").alias("level")))).over(total)
    per = per.withColumn("final", level.getField("level"))
    return per.select("skey", "source_size", "schedule",
                      F.coalesce(F.least("cap", F.col("final") * F.col("weight")), F.col("cap")).alias("target"))


def time_of(share, knots: tuple):
    """The time at which the schedule's integral is ``share`` of the whole."""
    whole, parts, done = integral(knots), [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        slope, area = (w1 - w0) / (t1 - t0), (t1 - t0) * (w0 + w1) / 2
        rest = share * F.lit(whole) - F.lit(done)
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * rest, F.lit(0.0)))
        at = F.lit(t0) + (2 * rest) / (F.lit(w0) + root)
        parts.append((done + area, F.least(at, F.lit(t1))))
        done += area
    out = parts[-1][1]
    for upto, at in reversed(parts[:-1]):
        out = F.when(share * F.lit(whole) <= F.lit(upto), at).otherwise(out)
    return F.greatest(out, F.lit(0.0))


def mix(docs: DataFrame, schedules=SCHEDULES, share: float = SHARE, most: float = MOST, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """One row per document: ``doc_id, text_key, size, source_size, target,
    taken`` and ``passes``, an array of (position, words) with one entry for
    each time that the mix takes words of it."""
    spark = docs.sparkSession
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))
    order = F.coalesce(F.md5(F.col("doc_id").cast("string")), F.lit(""))
    sizes = staged(docs.select(
        "doc_id", key.alias("skey"), F.col("source").isNull().alias("is_null"), text_key(F.col("text")).alias("text_key"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), order.alias("ord"),
        F.monotonically_increasing_id().alias("row_number")))
    rows = sizes.count()
    slot_rows = max(slot_rows, math.isqrt(rows))
    slots = max(1, rows // slot_rows)
    place = F.conv(F.substring("ord", 1, 8), 16, 10).cast("long")
    sizes = sizes.withColumn("slot", F.floor(F.coalesce(place, F.lit(0)) * slots / F.lit(1 << 32)))
    # rows of one id, or of none, share a slot: where that makes it too full,
    # such an id's rows come last in their slot, in parts of their own
    full = sizes.groupBy("slot").count().filter(F.col("count") > 4 * slot_rows).select("slot")
    many = sizes.join(full, "slot", "left_semi").groupBy("skey", "ord").count().filter(F.col("count") > slot_rows)
    many = many.select("skey", "ord", F.concat(F.lit("i"), F.col("ord")).alias("own"), (F.floor(F.col("count") / slot_rows) + 1).alias("parts"))
    sizes = sizes.join(many, ["skey", "ord"], "left").withColumn("own", F.coalesce("own", F.lit("")))
    sizes = sizes.withColumn("part", F.coalesce(F.pmod(F.xxhash64("text_key", "row_number"), "parts"), F.lit(0)))

    per = source_targets(sizes, schedules, share, most)
    group = ["skey", "slot", "own", "part"]
    base = sizes.groupBy(*group).agg(F.sum("size").alias("slot_size"))
    upto = Window.partitionBy("skey").orderBy("slot", "own", "part")
    base = base.withColumn("base", F.sum("slot_size").over(upto) - F.col("slot_size"))
    base = base.select(*group, "base").join(per, "skey")

    inner = Window.partitionBy(*group).orderBy("ord", "doc_id", "text_key", "row_number").rowsBetween(Window.unboundedPreceding, 0)
    d = sizes.join(base, group).withColumn("start", F.col("base") + F.sum("size").over(inner) - F.col("size"))
    words = F.round("target").cast("long")
    d = d.withColumn("words", words).withColumn("whole", F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(F.lit(0)))
    passes = int(-(-most // 1)) + 1

    def one(k: int):
        begin = F.lit(k) * F.col("source_size") + F.col("start")
        got = F.greatest(F.least(F.col("words") - begin, F.col("size")), F.lit(0)).cast("long")
        share_at = F.when(F.col("words") > 0, (begin + got / 2) / F.col("words")).otherwise(F.lit(0.0))
        at = F.lit(None).cast("double")
        for i, knots in enumerate(schedules):
            at = F.when(F.col("schedule") == i, time_of(share_at, knots)).otherwise(at)
        return F.struct(at.alias("position"), got.alias("words"))

    d = d.withColumn("passes", F.filter(F.array(*[one(k) for k in range(passes)]), lambda p: p["words"] > 0))
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda s, p: s + p["words"])
    return d.select("doc_id", "text_key", "size", "source_size", "target", taken.alias("taken"), "passes")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: ``docs``' rows in training order, each as often as it
    is taken.  A pass that takes less than half of a document leaves it out,
    one that takes half or more has it whole, so no text is cut.  A document
    without words belongs to every mix and stays once, at its turn."""
    plan = mix(docs, **options)
    whole = F.filter("passes", lambda p: p["words"] * 2 >= F.col("size"))
    plan = staged(plan.groupBy("doc_id", "text_key").agg(F.count("*").alias("n"), F.flatten(F.collect_list(F.when(
        F.col("size") > 0, F.transform(whole, lambda p: p["position"])).otherwise(F.array(F.lit(0.0))))).alias("at")))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    d = docs.select(row).select("row", F.col("row.doc_id").alias("_id"), text_key(F.col("row.text")).alias("_key"))
    if plan.filter("n > 1").limit(1).count():  # repeated rows: the plan has all their turns
        d = d.dropDuplicates(["_id", "_key"])
    p = plan.filter(F.size("at") > 0).select(F.col("doc_id").alias("_pid"), F.col("text_key").alias("_pkey"), "at")
    d = d.join(p, F.col("_id").eqNullSafe(F.col("_pid")) & (F.col("_key") == F.col("_pkey")))
    d = d.select("row", "_id", F.explode("at").alias("_at")).orderBy("_at", "_id")
    return d.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    """Contract query: every document with what the mix takes of it, in the
    order of the first training position (untaken documents last)."""
    from hazrank.llm.common import documents
    d = mix(documents(spark, sf_dir))
    d = d.select("doc_id", "size", "source_size", "target", "taken", F.round(F.get("passes", F.lit(0))["position"], 9).alias("position"))
    return d.orderBy(F.col("position").asc_nulls_last(), "doc_id").drop("position")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS ord,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (
  SELECT source, source_size, [3.0, 1.0, 2.0][CAST((row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") - 1) % 3 AS INT) + 1]::DOUBLE AS w,
         2.0::DOUBLE * source_size AS cap, (SELECT 1.5::DOUBLE * sum(size) FROM d) AS words
  FROM s),
lv AS (
  SELECT a.source, a.cap / a.w AS ratio, a.cap, a.w,
         (a.words - coalesce((SELECT sum(b.cap) FROM r b WHERE b.cap / b.w < a.cap / a.w), 0))
         / (SELECT sum(b.w) FROM r b WHERE b.cap / b.w >= a.cap / a.w) AS level
  FROM r a),
f AS (SELECT level FROM lv WHERE level * w <= cap ORDER BY ratio LIMIT 1),
t AS (SELECT r.source, r.source_size, coalesce(least(r.cap, (SELECT level FROM f) * r.w), r.cap) AS target FROM r),
c AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS q,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.ord, d.doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(greatest(least(q - start, size), 0) + greatest(least(q - source_size - start, size), 0) AS BIGINT) AS taken
FROM c
"""
