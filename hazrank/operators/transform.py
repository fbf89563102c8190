"""Feature preparation: missing flags, one-hot encoding, column
alignment, min-max scaling.

Schema decisions (which flag / dummy columns exist) come from one small
aggregate each -- a single row of NULL counts, or the distinct values of
a categorical column -- and every transformation is then one ``select``
over the whole frame (no ``withColumn`` chains over hundreds of columns).

What is fitted and applied in one call stores its input first (Parquet in the
shared folder), so the input's own plan runs once, and the statistics read only
the columns they need.

Wide dummy columns are for results that name them.  Models take ``indexed``
instead: string indices and sparse one-hot vectors, whatever the number of
values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazrank.operators.ranking import stored

# suffixes of a configured base feature name (fixed values)
YEAR_EXTENSIONS = ("", "_three_year", "_five_year", "_most_recent", "_total")


def q(c: str) -> str:
    """Back-quoted identifier for SQL expression strings."""
    return "`" + c.replace("`", "``") + "`"


def _expand(df: DataFrame, bases: Sequence[str]) -> list[str]:
    cols = set(df.columns)
    return [b.lower() + ext for b in bases for ext in YEAR_EXTENSIONS if b.lower() + ext in cols]


# --- X1 -----------------------------------------------------------------------
def columns_with_nulls(df: DataFrame, cols: Sequence[str]) -> list[str]:
    if not cols:
        return []
    row = df.selectExpr(*[f"count_if({q(c)} IS NULL) AS {q(c)}" for c in cols]).first()
    return [c for c in cols if row[c] > 0]


def flag_missing(df: DataFrame, bases: Sequence[str], flagged: Sequence[str] | None = None) -> DataFrame:
    """Add ``<c>_missing_flag`` (1 = NULL) and fill the NULLs with 0 for each
    configured feature that has a NULL (or the given ``flagged`` list)."""
    if flagged is None:
        df = stored(df)
        flagged = columns_with_nulls(df, _expand(df, bases))
    # one selectExpr: wide frames would otherwise cost one driver call per
    # column expression
    return df.selectExpr(*flag_missing_exprs(df.columns, flagged))


def flag_missing_exprs(columns: Sequence[str], flagged: Sequence[str]) -> list[str]:
    """The select list of ``flag_missing``."""
    fset = set(flagged)
    out = [f"coalesce({q(c)}, 0) AS {q(c)}" if c in fset else q(c) for c in columns]
    return out + [f"CAST({q(c)} IS NULL AS INT) AS {q(c + '_missing_flag')}" for c in flagged]


# --- X2 / X3 ------------------------------------------------------------------
@dataclass
class OneHotModel:
    """Categories seen in training, per column (trimmed, sorted)."""
    categories: dict[str, list[str]] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.selectExpr(*self.exprs(df.columns))

    def exprs(self, columns: Sequence[str]) -> list[str]:
        """The select list of ``transform``."""
        keep = [q(c) for c in columns if c not in self.categories]
        dummies = []
        for c, cats in self.categories.items():
            for cat in sorted(cats):
                lit = cat.replace("\\", "\\\\").replace("'", "\\'")
                dummies.append(f"CASE WHEN trim({q(c)}) = '{lit}' THEN 1 ELSE 0 END AS {q(f'{c}_onehot_{cat}')}")
        return keep + dummies


def categories(df: DataFrame, col: str) -> list[str]:
    """The trimmed values of a column, sorted: counted by value over all
    tasks, and one name for each output column returned."""
    v = df.selectExpr(f"trim({q(col)}) AS v").where("v IS NOT NULL")
    return sorted(r["v"] for r in v.groupBy("v").agg(F.count(F.lit(1))).collect())


def onehot_fit(df: DataFrame, bases: Sequence[str]) -> OneHotModel:
    """The values of each categorical column.  Every value becomes an output
    column, so their number is that of the result's own columns; there is no
    other limit."""
    return OneHotModel({c: categories(df, c) for c in _expand(df, bases)})


def onehot_fit_transform(df: DataFrame, bases: Sequence[str]) -> tuple[DataFrame, OneHotModel]:
    df = stored(df)
    m = onehot_fit(df, bases)
    return m.transform(df), m


def indexed(df: DataFrame, cols: Sequence[str]) -> tuple[list, list[str], list[str]]:
    """Fitted stages that turn string columns into sparse one-hot vectors:
    (stages, vector columns, names of the vectors' entries in order).

    A value that training lacks, or none, is a vector of zeros: the indexer
    keeps such values under one more index, the last, which the encoder drops."""
    cols = [c for c, n in zip(cols, df.selectExpr(*[f"count({q(c)})" for c in cols]).first()) if n] if cols else []
    if not cols:
        return [], [], []
    index, vec = [f"{c}_index" for c in cols], [f"{c}_onehot" for c in cols]
    indexer = StringIndexer(inputCols=cols, outputCols=index, handleInvalid="keep", stringOrderType="alphabetAsc").fit(df)
    encoder = OneHotEncoder(inputCols=index, outputCols=vec, dropLast=True).fit(indexer.transform(df))
    return [indexer, encoder], vec, onehot_names([indexer, encoder])


def onehot_names(stages: Sequence) -> list[str]:
    """Names of all one-hot entries of fitted stages, in vector order."""
    labels = {o: (c, ls) for s in stages if isinstance(s, StringIndexerModel)
              for c, o, ls in zip(s.getInputCols(), s.getOutputCols(), s.labelsArray)}
    return [f"{c}_onehot_{v}" for s in stages if isinstance(s, OneHotEncoderModel)
            for c, ls in (labels[i] for i in s.getInputCols()) for v in ls]


# --- X4 -----------------------------------------------------------------------
def align_columns(a: DataFrame, b: DataFrame, fill=0) -> tuple[DataFrame, DataFrame]:
    """Give both frames the same columns (missing ones filled with 0),
    sorted by name."""
    cols = sorted(set(a.columns) | set(b.columns))

    def fix(df):
        have = set(df.columns)
        return df.selectExpr(*[q(c) if c in have else f"{fill!r} AS {q(c)}" for c in cols])
    return fix(a), fix(b)


# --- X5 -----------------------------------------------------------------------
def minmax_normalize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - min) / (max - min), NULL-skipping; a constant column gives 0.

    min and max come from one aggregate row (two numbers per column, a
    proven bound) and are applied as literals -- no join at all."""
    df = stored(df)
    stats = minmax_fit(df, cols)
    return minmax_apply(df, stats, cols)


def minmax_fit(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple]:
    """Per-column (min, max), NULL-skipping: one aggregate row."""
    row = df.selectExpr(*[f"CAST(min({q(c)}) AS DOUBLE) AS {q('_mn_' + c)}" for c in cols],
                        *[f"CAST(max({q(c)}) AS DOUBLE) AS {q('_mx_' + c)}" for c in cols]).first()
    return {c: (row["_mn_" + c], row["_mx_" + c]) for c in cols}


def _lit(v) -> str:
    import math
    if v is None or math.isnan(v):
        return "CAST(NULL AS DOUBLE)"
    if math.isinf(v):
        return "double('Infinity')" if v > 0 else "double('-Infinity')"
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def minmax_apply(df: DataFrame, stats: dict[str, tuple], cols: Sequence[str]) -> DataFrame:
    """Scale with fitted (min, max) literals."""
    return df.selectExpr(*minmax_exprs(df.columns, stats, cols))


def minmax_exprs(columns: Sequence[str], stats: dict[str, tuple], cols: Sequence[str]) -> list[str]:
    """The select list of ``minmax_apply``."""
    cset = set(cols)
    out = []
    for c in columns:
        if c in cset:
            mn, mx = stats[c]
            rng = None if mn is None else mx - mn
            den = "1.0D" if rng in (None, 0) else _lit(rng)
            out.append(f"({q(c)} - {_lit(mn)}) / {den} AS {q(c)}")
        else:
            out.append(q(c))
    return out


# --- X6 -----------------------------------------------------------------------
@dataclass
class ImputeTransform:
    """Missing flags then one-hot; fitted on training rows, applied to both."""
    flag_bases: Sequence[str]
    onehot_bases: Sequence[str]
    flagged: list[str] = field(default_factory=list)
    onehot: OneHotModel | None = None

    def fit(self, train: DataFrame, test: DataFrame | None = None) -> "ImputeTransform":
        # flag presence over train and test together so both sides agree
        cand = _expand(train, self.flag_bases)
        both = train.select(*cand) if test is None else train.select(*cand).unionByName(test.select(*cand))
        self.flagged = columns_with_nulls(both, cand)
        self.onehot = onehot_fit(train, self.onehot_bases)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return self.onehot.transform(flag_missing(df, self.flag_bases, self.flagged))
