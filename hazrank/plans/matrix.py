"""Feature matrix assembly: families joined onto the cohort, labels
joined by key, uniqueness checks.

Sources are first reduced to yearly partials per entity, stored bucketed by
entity; cohort, families and the chain of left joins then work on rows that
already lie together.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass, fields
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazrank.plans import cohorts as C
from hazrank.plans import features as FT
from hazrank.sources.files import shared_path

ENTITY = "handler_id"
KEYS = [ENTITY, "label_year"]


# --- M1 -----------------------------------------------------------------------
def join_windows(frames: Sequence[DataFrame]) -> DataFrame:
    """Inner merge of one family computed per window, on (entity, year)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, KEYS, "inner")
    return out


# --- M2 -----------------------------------------------------------------------
@dataclass
class Partials:
    """What the families need of each source, reduced to (entity, year) rows:
    additive measures, distinct owner links, yearly report attributes."""
    inspections: DataFrame
    waste: DataFrame
    waste_codes: DataFrame
    owners: DataFrame
    reports: DataFrame
    naics: DataFrame
    buckets: int | None = None    # of each frame, by entity, once stored

    @property
    def report_keys(self) -> DataFrame:
        return self.reports.select(ENTITY, "report_year")

    def cohort_active(self, spine: DataFrame) -> DataFrame:
        return C.cohort_active(self, spine)

    def cohort_route(self, spine: DataFrame) -> DataFrame:
        return C.route_of(self.report_keys, self.inspections.select(ENTITY, "year", "ny"), spine)


def partials(lt, lt_all) -> Partials:
    """The partials as plans.  ``lt`` is bounded to the windows; land type and
    district take all years of ``lt_all``, so inspections and reports are
    reduced over all, and labels can be read off the inspections too."""
    i = lt_all.inspections
    _, measures = FT._violation_partials()
    ins = i.groupBy(ENTITY, F.year("evaluation_start_date").alias("year")).agg(
        *measures, F.count("enforcement_type").alias("n_enforcement"), F.max("land_type").alias("land_type"), F.coalesce(F.max(F.col("state") == "NY"), F.lit(False)).alias("ny"))
    return Partials(ins, FT.waste_partials(lt), FT.waste_code_partials(lt), FT.owner_links(lt_all), lt_all.site_report, FT.primary_naics(lt))


def store_lines(lines: DataFrame) -> DataFrame:
    """Order lines written once as Parquet in the shared folder for the sources
    that start from them, which then share one join.

    They lie as the join left them, by order, so a source's map-side aggregates
    take an order's lines together, and an entity with very many stays spread."""
    path = shared_path(lines.sparkSession, "lines")
    lines.write.parquet(path)
    return lines.sparkSession.read.schema(lines.schema).parquet(path)


def store_partials(p: Partials, buckets: int | None = None) -> Partials:
    """Each frame written once as Parquet in the shared folder, bucketed and
    sorted by entity, and opened as a bucketed table: whatever groups or joins
    by entity afterwards finds its rows in place and moves none.

    A source's events are read by one job and only its yearly sums are
    stored.  The jobs are independent, so a few run side by side.  Table names
    are new for each call; the tables are external, and ``drop_partials``
    forgets those of the session.

    Frames are opened in a session of their own, with the caller's settings
    and one more: rows that lie together by entity may be joined by entity and
    year in place.  The caller's session stays as it is."""
    spark = p.inspections.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    in_place = _session_like(spark)
    in_place.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")

    def store(df: DataFrame) -> DataFrame:
        name = f"{TABLE_PREFIX}{uuid.uuid4().hex}"
        (df.repartition(n, ENTITY).write.bucketBy(n, ENTITY).sortBy(ENTITY).format("parquet")
           .option("path", shared_path(spark, "partials")).saveAsTable(name))
        return in_place.table(name)

    frames = [getattr(p, f.name) for f in fields(p) if f.name != "buckets"]
    with ThreadPool(len(frames)) as pool:
        return Partials(*pool.map(inheritable_thread_target(spark)(store), frames), buckets=n)


def _session_like(spark):
    """A new session of the same application, catalog and settings."""
    new = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if new.conf.isModifiable(key) and new.conf.get(key, None) != value:
            new.conf.set(key, value)
    return new


#: Largest measured partition that a join may hold as a hash map.
HASHED_PARTITION = "64MB"


def hashing_session(spark):
    """A session with the caller's settings in which a join of two shuffled
    sides is hashed, not sorted, where each partition of one side was measured
    to be small (adaptive execution); otherwise it sorts and spills as ever.
    A threshold that the caller set stays."""
    new, key = _session_like(spark), "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    if spark.conf.get(key, None) in (None, "0", "0b"):
        new.conf.set(key, HASHED_PARTITION)
    return new


#: Columns up to which the joins of the matrix are compiled; it has more than
#: the 100 that Spark compiles by default.
COMPILED_COLUMNS = "1000"


@contextmanager
def compiled_joins(spark):
    """Meanwhile, steps over rows as wide as the matrix are compiled in this
    session, unless the caller set a limit.  For the chain of joins alone:
    hundreds of aggregates in one compiled step run slower than interpreted."""
    key = "spark.sql.codegen.maxFields"
    before = spark.conf.get(key)
    spark.conf.set(key, COMPILED_COLUMNS if before == "100" else before)
    try:
        yield
    finally:
        spark.conf.set(key, before)


TABLE_PREFIX = "hazrank_partials_"


def drop_partials(spark) -> None:
    """Forget the tables of ``store_partials``; frames on them cannot run
    afterwards.  Their files go with the shared folder."""
    for t in spark.catalog.listTables(pattern=f"{TABLE_PREFIX}*"):
        spark.sql(f"DROP TABLE IF EXISTS {t.name}")


def family_frames(p: Partials, spine: DataFrame, keys: DataFrame | None = None) -> list[DataFrame]:
    """All families as (handler_id, label_year, features...) frames, of all
    entities and label years or of ``keys`` (each once).

    What is counted over other entities (companies, the rates behind both peer
    averages) is counted over all of them either way."""
    rates = FT.rates_from(FT.inspection_family(p.inspections, spine))
    return [
        FT.inspection_family(p.inspections, spine, keys=keys).selectExpr(ENTITY, "label_year", *FT.f1_f2_columns()),
        FT.waste_info_family(None, spine, pre=p.waste, keys=keys),
        FT.parent_company_size_family(None, spine, links=p.owners, by_entity=p.buckets, keys=keys),
        FT.waste_code_family(None, spine, pre=p.waste_codes, keys=keys),
        FT.parent_company_peers_family(None, spine, rates=rates, links=p.owners, by_entity=p.buckets, keys=keys),
        FT.zip_peers_family(None, spine, rates=rates, reports=p.reports, by_entity=p.buckets, keys=keys),
    ]


def build_matrix(p: Partials, cohort: DataFrame, spine: DataFrame) -> DataFrame:
    """Cohort left-joined with every family (one row per cohort row).

    On stored partials every entity-keyed family is in place by entity, and so
    is the chain of joins: the growing matrix is never moved.  Only the
    families that go through a company or a zip code are, before their join.
    Families are computed for the cohort's entities and years alone; its keys
    are hashed, a few per entity, so no partial is sorted for it."""
    m = cohort
    for fam in family_frames(p, spine, cohort.select(*KEYS).distinct()):
        m = m.join(fam, KEYS, "left")
    m = m.join(FT.facility_info_family(p.reports, spine), KEYS, "left")
    m = m.join(FT.naics_family(p.naics, spine), KEYS, "left")
    return FT.onto_geographic(m, p.inspections, p.reports)


# --- M3 -----------------------------------------------------------------------
def assert_one_row_per_entity(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Violations of one-row-per-key: (keys..., n_rows) with n_rows > 1.
    An empty result means the check passed."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def matrix_key_violations(report_keys: DataFrame, naics_keys: DataFrame, cohort: DataFrame, spine: DataFrame) -> DataFrame:
    """``assert_one_row_per_entity`` of the matrix, from keys alone.

    All families but two are grouped by entity and label year and so have a
    key once.  A cohort key has as many rows in the matrix as it has itself,
    times its rows in the yearly report (at least one) and in the yearly code
    table: only these keys are read and counted."""
    ends = F.broadcast(spine.select("label_year", F.col("feature_end").alias("report_year")))
    rows = cohort.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_rows"))
    for keys in (report_keys, naics_keys):
        of_year = keys.select(ENTITY, "report_year").join(ends, "report_year").groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_n"))
        rows = rows.join(of_year, KEYS, "left").withColumn("n_rows", F.col("n_rows") * F.coalesce("_n", F.lit(1))).drop("_n")
    return rows.where(F.col("n_rows") > 1)


# --- M4 -----------------------------------------------------------------------
def stack_years(frames: Sequence[DataFrame]) -> DataFrame:
    """Frames of single years, one upon the other.  Where the years come from
    one source, one plan over a spine of several years does the same in one
    pass (every plan here takes such a spine)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# --- M5 -----------------------------------------------------------------------
def join_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features and labels paired by key, never by position."""
    return features.join(labels.select(*KEYS, "formal"), KEYS, "inner")


# --- M6 -----------------------------------------------------------------------
def split_features_label(df: DataFrame, feature_cols: Sequence[str] | None = None,
                         label_col: str = "formal", id_cols: Sequence[str] = KEYS,
                         output_col: str = "features") -> DataFrame:
    """(ids..., label, features vector) via ``VectorAssembler``."""
    from pyspark.ml.feature import VectorAssembler
    if feature_cols is None:
        skip = set(id_cols) | {label_col, "split", "history"}
        feature_cols = [f.name for f in df.schema.fields
                        if f.name not in skip and f.dataType.typeName() in ("double", "long", "integer")]
    va = VectorAssembler(inputCols=list(feature_cols), outputCol=output_col, handleInvalid="keep")
    return va.transform(df).select(*id_cols, label_col, output_col)


# --- M7 -----------------------------------------------------------------------
def drop_unlabelled(df: DataFrame, label_col: str = "formal") -> DataFrame:
    return df.where(F.col(label_col).isNotNull())
