"""Categorical and numeric encoders as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_LEVELS = 256       # columns that an encoder may make


def levels_of(df: DataFrame, col: str, most: int = MOST_LEVELS) -> list[str]:
    """Sorted levels of a categorical column, at most ``most``: the commonest, by name if equally common.

    They are counted by Spark; only the levels that become columns reach the
    driver.  Rows of a level beyond the bound count as another level.
    """
    found = (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), col).limit(most).select(col).collect())
    return sorted(r[0] for r in found)


def encoder_stage(col: str, levels: Sequence[str], prefix: str | None = None) -> SQLTransformer:
    """A pipeline stage that makes the dummy columns of ``levels`` from the text in ``col``.

    A NULL or a level that was not fitted is 0 in all of them, and 1 in
    ``<prefix>_other`` unless it is NULL.  The stage is saved with its pipeline.
    """
    prefix = prefix or col
    name = lambda v: "`" + f"{prefix}_{v}".replace("`", "``") + "`"
    text = lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    lv = sorted(levels)
    dummies = [f"coalesce(cast(`{col}` = {text(v)} AS double), 0.0D) AS {name(v)}" for v in lv]
    known = f"`{col}` IN ({', '.join(map(text, lv))})" if lv else "false"
    other = f"coalesce(cast(NOT ({known}) AS double), 0.0D) AS {name('other')}" if "other" not in lv else None
    return SQLTransformer(statement=f"SELECT *, {', '.join([*dummies, *([other] if other else [])])} FROM __THIS__")


def one_hot_cols(col: str, levels: Sequence[str], prefix: str | None = None,
                 drop_first: bool = False, dtype: str = "int") -> list[Column]:
    """pandas ``get_dummies``: one 0/1 column per level (alphabetical), the first
    dropped when ``drop_first``.  A NULL category is 0 in every column."""
    prefix = prefix or col
    lv = sorted(levels)
    if drop_first:
        lv = lv[1:]
    return [F.coalesce((F.col(col) == F.lit(v)).cast(dtype), F.lit(0).cast(dtype)).alias(f"{prefix}_{v}")
            for v in lv]


def standard_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame, digits: int | None = 6,
                   suffix: str = "_scaled") -> DataFrame:
    """(x - mean) / population std, both fitted on ``fit_on`` (train fold only).

    The fit is one aggregate row used as a scalar subquery.  (ML's
    StandardScaler divides by the sample std, which is not the reference's.)
    """
    stats = fit_on.agg(F.struct(*[F.struct(
        (F.sum(F.col(c).cast("decimal(28,6)")).cast("double") / F.count(c).cast("double")).alias("m"),
        F.stddev_pop(F.col(c).cast("double")).alias("s")).alias(c) for c in cols])).scalar()
    out = df
    for c in cols:
        z = F.try_divide(F.col(c).cast("double") - stats[c]["m"], stats[c]["s"])
        out = out.withColumn(c + suffix, F.round(z, digits) if digits is not None else z)
    return out
