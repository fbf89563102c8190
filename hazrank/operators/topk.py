"""The top i of every group by counting, without sorting.

A top-k metric needs no ranks, only the place where the top ends: the score
and, among the rows of that score, the last entity that belongs to it.  Both
are found by rank selection.  The rows of a group are counted in at most
``CELLS`` ranges of the score (map-side partial counts, so a range that holds
half of all rows is one row per task), the counts are cumulated from the top on
the driver, and the range in which the i-th row lies is counted again in finer ranges
between its own least and greatest score, until one score is left.  The rows of
that score are narrowed in the same way by entity.  A usual distribution takes
two or three rounds, any distribution a few more.

Only counts pass through the driver: at most ``COUNTS`` a round over all
groups, which are models x years.  The cutoffs, one row per group, are then
joined by broadcast, and any count over the top is an ordinary grouped
aggregate.

Order: descending score, entity ascending; NaN above all numbers and NULL
below, as in Spark's ``ORDER BY score DESC NULLS LAST``.  An entity stands in a
group once.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegralType, StringType

#: Ranges in which a round counts the scores or entities of a group.
CELLS = 4096
#: Counts that a round returns to the driver, over all groups: with more groups
#: there are fewer ranges.
COUNTS = 1 << 20

# classes of scores from the top: NaN, infinite, finite, minus infinite, NULL
_NAN, _INF, _FINITE, _MINUS_INF, _NULL = range(5)
_NONE, _ALL = -1, 5


def _class(score: Column) -> Column:
    return (F.when(score.isNull(), _NULL).when(F.isnan(score), _NAN).when(score == float("inf"), _INF)
            .when(score == float("-inf"), _MINUS_INF).otherwise(_FINITE))


# how a round divides the scores between a group's bounds
_LINEAR, _SIGN, _LOG = range(3)


def _way(lo: float, hi: float, turn: int) -> int:
    """Ranges of equal width at first; where two rounds of those have not done
    (scores over many powers of ten), by sign and then by logarithm, so that
    any distribution is narrowed down within a few rounds."""
    if turn < 2:
        return _LINEAR
    if lo <= 0 <= hi:
        return _SIGN
    return _LOG if max(abs(lo), abs(hi)) / min(abs(lo), abs(hi)) > 2 else _LINEAR


def _cells_of_score(cells: int) -> Column:
    """Range number of a score between ``_lo`` and ``_hi``; never falls as the
    score grows, since every step of it is rounded monotonically."""
    s, lo, hi = F.col("_s"), F.col("_lo"), F.col("_hi")
    # halves where the whole width is beyond the largest number
    linear = F.when(hi - lo < float("inf"), (s - lo) / (hi - lo)).otherwise((s / 2 - lo / 2) / (hi / 2 - lo / 2))
    height = lambda x: F.when(x > 0, F.log(x)).otherwise(-F.log(-x))
    by_log = (height(s) - height(lo)) / (height(hi) - height(lo))
    part = F.when(F.col("_way") == _LOG, by_log).otherwise(linear)
    return F.when(F.col("_way") == _SIGN, F.signum(s).cast("long")).otherwise(F.least(F.floor(part * cells), F.lit(cells - 1)))


def _small(spark, columns: dict, rows: list[tuple]) -> DataFrame:
    """A frame of a few rows that the driver holds (``columns``: Arrow types)."""
    data = list(zip(*rows)) if rows else [[] for _ in columns]
    return spark.createDataFrame(pa.table({n: pa.array(v, t) for (n, t), v in zip(columns.items(), data)}))


def share_of(k: float) -> Callable[[int], int]:
    """i = int(k * n) with k a double, as the ranking evaluation does."""
    return lambda n: int(math.floor(float(k) * n))


def top_cutoffs(rows: DataFrame, group_cols: Sequence[str], i_of: Callable[[int], int], score_col: str = "score",
                entity_col: str = "handler_id", member: Column | None = None, cells: int = CELLS) -> DataFrame:
    """Where the top ends: (group_cols, n, i, _cls, _cut, _last).

    ``n`` counts the rows of a group and ``i_of`` gives its i.  The top is
    taken of the rows for which ``member`` holds (all, by default).  ``rows`` is
    read once for each round, so it should be a stored frame.  ``_last`` is NULL
    when all rows of the cut score belong to the top.
    """
    spark, g = rows.sparkSession, list(group_cols)
    entity_type = rows.schema[entity_col].dataType
    if not isinstance(entity_type, (IntegralType, StringType)):
        raise TypeError(f"{entity_col}: entities are whole numbers or strings, not {entity_type.simpleString()}")
    gtypes = {c: to_arrow_type(rows.schema[c].dataType) for c in g}
    etype = to_arrow_type(entity_type)
    # -0.0 and 0.0 are one score
    base = rows.select(*g, F.col(entity_col).alias("_e"), (F.col(score_col).cast("double") + F.lit(0.0)).alias("_s"),
                       (F.lit(True) if member is None else F.coalesce(member, F.lit(False))).alias("_in"))
    base = base.withColumn("_c", _class(F.col("_s")))
    inside = F.col("_in")
    measures = [F.count_if(inside).alias("_n"), *(f(F.when(inside, F.col(c))).alias(n) for n, f, c in (
        ("_lo", F.min, "_s"), ("_hi", F.max, "_s"), ("_elo", F.min, "_e"), ("_ehi", F.max, "_e")))]
    key = lambda r: tuple(r[c] for c in g)

    n_all: dict = {}
    first: dict = {}
    for r in base.groupBy(*g, "_c").agg(F.count(F.lit(1)).alias("_rows"), *measures).collect():
        n_all[key(r)] = n_all.get(key(r), 0) + r["_rows"]
        if r["_n"]:
            first.setdefault(key(r), []).append((r["_c"], r.asDict()))
    i = {k: int(i_of(n)) for k, n in n_all.items()}
    cut = {k: (n_all[k], i[k], _ALL if i[k] > 0 else _NONE, None, None) for k in n_all}
    cells = max(2, min(cells, COUNTS // max(len(n_all), 1)))

    def narrowed(counts: dict, need: dict, sign: int) -> list[dict]:
        """Of each group's (cell, row) pairs the row that holds the needed
        place, with what is needed of it."""
        out = []
        for k, held in counts.items():
            left = need[k]
            for _, r in sorted(held, key=lambda x: x[0], reverse=sign < 0):
                if 0 < left <= r["_n"]:
                    out.append(r | {"_need": left})
                    break
                left -= r["_n"]
        return out

    def again(states: list[dict], bounds: dict, where: Column, cell: Column, sign: int, values) -> list[dict]:
        """Count the open groups' rows between their bounds in finer ranges."""
        columns = gtypes | {"_cls": pa.int32()} | bounds
        open_ = F.broadcast(_small(spark, columns, [(*key(r), r["_c"], *values(r)) for r in states]))
        rest = base.where("_in").join(open_, g).where((F.col("_c") == F.col("_cls")) & where).withColumn("_cell", cell)
        counts: dict = {}
        for r in rest.select(*g, "_c", "_cell", "_in", "_s", "_e").groupBy(*g, "_c", "_cell").agg(*measures).collect():
            counts.setdefault(key(r), []).append((r["_cell"], r.asDict()))
        return narrowed(counts, {key(r): r["_need"] for r in states}, sign)

    double = pa.float64()
    found, ties, turn = narrowed(first, i, 1), [], 0
    while found:
        further = []
        for r in found:
            if r["_need"] == r["_n"]:  # all of them
                cut[key(r)] = (n_all[key(r)], i[key(r)], r["_c"], r["_lo"], None)
            elif r["_c"] != _FINITE or r["_lo"] == r["_hi"]:
                ties.append(r)
            else:
                further.append(r)
        if not further:
            break
        found = again(further, {"_lo": double, "_hi": double, "_way": pa.int32()}, F.col("_s").between(F.col("_lo"), F.col("_hi")),
                      _cells_of_score(cells), -1, lambda r: (r["_lo"], r["_hi"], _way(r["_lo"], r["_hi"], turn)))
        turn += 1

    tied = (F.col("_c") != _FINITE) | (F.col("_s") == F.col("_lo"))
    near = tied & F.col("_e").between(F.col("_elo0"), F.col("_ehi0"))
    while ties:
        bounds = {"_lo": double, "_elo0": etype, "_ehi0": etype, "_by": pa.int32()}
        if isinstance(entity_type, StringType):
            found = again(ties, bounds, near, F.hex(F.expr("substring(CAST(_e AS BINARY), _by, 2)")), 1,
                          lambda r: (r["_lo"], r["_elo"], r["_ehi"], _common(r["_elo"], r["_ehi"]) + 1))
        else:
            found = again(ties, bounds, near, F.expr("shiftright(_e, _by) - shiftright(_elo0, _by)"), 1,
                          lambda r: (r["_lo"], r["_elo"], r["_ehi"], _shift(r["_elo"], r["_ehi"], cells)))
        ties = []
        for r in found:
            if r["_need"] == r["_n"]:
                cut[key(r)] = (n_all[key(r)], i[key(r)], r["_c"], r["_lo"], r["_ehi"])
            elif r["_elo"] == r["_ehi"]:
                raise ValueError(f"{entity_col} {r['_elo']!r} stands more than once in group {key(r)}")
            else:
                ties.append(r)
    return _small(spark, gtypes | {"n": pa.int64(), "i": pa.int64(), "_cls": pa.int32(), "_cut": double, "_last": etype}, [(*k, *v) for k, v in cut.items()])


def _common(a: str, b: str) -> int:
    """Bytes that two strings begin with alike."""
    x, y = a.encode(), b.encode()
    return next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


def _shift(lo: int, hi: int, cells: int) -> int:
    """Bits to drop so that the range has at most ``cells`` values."""
    s = 0
    while (hi >> s) - (lo >> s) >= cells:
        s += 1
    return s


def with_top(rows: DataFrame, cutoffs: DataFrame, group_cols: Sequence[str], name: str = "top",
             score_col: str = "score", entity_col: str = "handler_id", how: str = "inner") -> DataFrame:
    """``rows`` with a flag: is the row in its group's top?  Groups without a
    cutoff have no row in the result, or with ``how="left"`` no top."""
    s = F.col(score_col).cast("double")
    cls = _class(s)
    tie = (F.col("_cls") != _FINITE) | (s == F.col("_cut"))
    at_cut = F.when(F.col("_cls") == _FINITE, s > F.col("_cut")).otherwise(F.lit(False)) | (
        tie & (F.col("_last").isNull() | (F.col(entity_col) <= F.col("_last"))))
    flag = (cls < F.col("_cls")) | ((cls == F.col("_cls")) & at_cut)
    c = cutoffs.select(*group_cols, "_cls", "_cut", "_last")
    return rows.join(F.broadcast(c), list(group_cols), how).withColumn(name, F.coalesce(flag, F.lit(False))).drop("_cls", "_cut", "_last")
