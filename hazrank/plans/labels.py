"""Three-valued labels: 1 formal enforcement, 0 inspected without one,
NULL not inspected in the label year (unknown, never filled with 0)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazrank.config import FORMAL_ENFORCEMENT_CODES

ENTITY = "handler_id"


def label_year_flags(lt, spine: DataFrame) -> DataFrame:
    """(handler_id, label_year, n_rows, n_enforcement, n_listed) per entity
    and label year, aggregated before joining the cohort."""
    i = lt.inspections_core.withColumn("label_year", F.year("evaluation_start_date"))
    # keep label years only, before aggregating
    i = i.join(F.broadcast(spine.select("label_year")), "label_year", "left_semi")
    return (i.groupBy(ENTITY, "label_year")
             .agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count("enforcement_type").alias("n_enforcement"),
                  F.count(F.when(F.col("enforcement_type").isin(*FORMAL_ENFORCEMENT_CODES), 1)).alias("n_listed")))


# --- L1 / L2 ------------------------------------------------------------------
def label_formal(lt, cohort: DataFrame, spine: DataFrame, mode: str = "literal") -> DataFrame:
    """cohort (handler_id, label_year, ...) + ``formal``.

    ``literal``: any non-NULL enforcement type in the label year counts
    (the original counting of a boolean expression counts every non-NULL
    result); ``listed``: only the formal enforcement codes count.
    """
    flags = label_year_flags(lt, spine)
    n = F.col("n_enforcement") if mode == "literal" else F.col("n_listed")
    if mode not in ("literal", "listed"):
        raise ValueError(mode)
    lab = flags.select(ENTITY, "label_year",
                       F.when(n > 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("formal"))
    return cohort.join(lab, [ENTITY, "label_year"], "left")


def label_formal_of(inspections: DataFrame, spine: DataFrame) -> DataFrame:
    """(handler_id, label_year, formal) of the entities inspected in a label
    year, as ``label_formal`` in literal mode has them, from inspections that
    are reduced to (entity, year) already (``matrix.Partials``)."""
    years = F.broadcast(spine.select("label_year"))
    return inspections.join(years, inspections["year"] == years["label_year"]).select(
        ENTITY, "label_year", F.when(F.col("n_enforcement") > 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("formal"))


def label_formal_listed(lt, cohort: DataFrame, spine: DataFrame) -> DataFrame:
    return label_formal(lt, cohort, spine, mode="listed")
