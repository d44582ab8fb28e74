"""Scalar column expressions (all JVM-side built-ins, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import PROB_DECIMALS, TIER_HIGH, TIER_MEDIUM

# Scores of the stand-in that some keys get: both cuts, just under them, two rounding ties.
EDGE_SCORES = (TIER_HIGH, TIER_MEDIUM, 0.199999999999, 0.099999999999, 0.59375, 0.00015)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- dates -----------------------------------------------------------------

def parse_yymmdd(c, century: str = "19") -> Column:
    """Two-digit-year date text/int -> DATE in the given century.

    Spark's ``yyMMdd`` pivots 93 to 2093; the century is prefixed instead, and
    ``try_to_date`` yields NULL for dates impossible in that century.
    """
    return F.try_to_date(F.concat(F.lit(century), F.lpad(_c(c).cast("string"), 6, "0")), "yyyyMMdd")


def parse_yymmdd_time(c, century: str = "19") -> Column:
    """``yyMMdd HH:mm:ss`` text -> TIMESTAMP_NTZ in the given century."""
    return F.try_to_timestamp(F.concat(F.lit(century), _c(c)), F.lit("yyyyMMdd HH:mm:ss")).cast("timestamp_ntz")


def tenure_days(open_date, as_of: str) -> Column:
    return F.datediff(F.lit(as_of).cast("date"), _c(open_date))


def in_range(d, lo_exclusive: str | None, hi_inclusive: str | None) -> Column:
    cond = F.lit(True)
    if lo_exclusive is not None:
        cond = cond & (_c(d) > F.lit(lo_exclusive).cast("date"))
    if hi_inclusive is not None:
        cond = cond & (_c(d) <= F.lit(hi_inclusive).cast("date"))
    return cond


def between_dates(d, lo_inclusive: str, hi_inclusive: str) -> Column:
    return (_c(d) >= F.lit(lo_inclusive).cast("date")) & (_c(d) <= F.lit(hi_inclusive).cast("date"))


# --- numeric ---------------------------------------------------------------

def coerce_numeric(c) -> Column:
    """pandas ``to_numeric(errors='coerce')``: junk text -> NULL, never an error."""
    return F.expr(f"try_cast({_sql(c)} AS DOUBLE)") if isinstance(c, str) else c.try_cast("double")


def _sql(name: str) -> str:
    return f"`{name}`"


def annual_rate(count, days) -> Column:
    return F.try_divide(_c(count).cast("double"), _c(days).cast("double") / F.lit(365.25))


def flag_le(x, threshold) -> Column:
    """(x <= t) as 0/1 where a missing x gives 0 (pandas NaN compare is False)."""
    return F.coalesce((_c(x) <= _c(threshold)).cast("int"), F.lit(0))


def flag_lt(x, threshold) -> Column:
    return F.coalesce((_c(x) < _c(threshold)).cast("int"), F.lit(0))


# --- scoring ---------------------------------------------------------------

def risk_tier(p, high: float = TIER_HIGH, medium: float = TIER_MEDIUM) -> Column:
    """High / Medium / Low on the unrounded probability.  NULL and NaN are
    rejected (NULL tier): NaN >= x is true in Spark, false in Python."""
    p = _c(p)
    bad = p.isNull() | F.isnan(p)
    return (F.when(bad, F.lit(None).cast("string"))
             .when(p >= F.lit(high), F.lit("High"))
             .when(p >= F.lit(medium), F.lit("Medium"))
             .otherwise(F.lit("Low")))


def py_round(x, d: int) -> Column:
    """Python ``round(x, d)`` for doubles, as JVM-side expressions.

    Python rounds the exact binary value, half-even only on an exact binary tie
    (0.59375 = 19/32).  Spark's ``round`` / ``bround`` round the
    shortest decimal text instead; they differ only when that text is itself
    a tie (0.00015 -> text tie, binary value 0.000149999...).  In that case
    the side of the tie is decided exactly: p = x*M plus the error of that
    product (Dekker split, exact in IEEE doubles) compared with 2k+1.
    """
    x = _c(x).cast("double")
    a = F.abs(x)
    scale = 10 ** d
    dec = a.cast("decimal(38,18)")                      # the shortest text, exactly
    t = dec * F.lit(scale * 10)
    is_tie = (t == F.floor(t)) & (F.floor(t) % 10 == 5)
    m = float(2 * scale)                                # tie T = N / M with N odd
    n = (F.floor(t) / 5).cast("double")                 # N = 2k + 1
    split = F.lit(134217729.0) * a                      # 2^27 + 1
    a_hi = split - (split - a)
    a_lo = a - a_hi
    prod = a * F.lit(m)
    err = (a_hi * F.lit(m) - prod) + a_lo * F.lit(m)
    diff = (prod - n) + err
    k = F.floor(dec * F.lit(scale))
    up = F.when(diff > 0, 1).when((diff == 0) & (k % 2 == 1), 1).otherwise(0)
    tie_val = ((k + up) / F.lit(scale)).cast("double")
    mag = F.when(is_tie, tie_val).otherwise(F.round(a, d))
    return F.when(x.isNull() | F.isnan(x), x).otherwise(F.when(x < 0, -mag).otherwise(mag))


def round_prob(p, decimals: int = PROB_DECIMALS) -> Column:
    """Python ``round(prob, 4)`` of the scorer."""
    return py_round(p, decimals)


def spread_score(ratio, key) -> Column:
    """Stand-in score over 0-1 at full precision from a ratio over 0.2; some keys get a
    missing score, the tier cuts themselves, the values just under them, or rounding ties
    (multiplications only: every engine gives the same double)."""
    x = (_c(ratio) - F.lit(0.2)) / F.lit(0.8)
    fixed = F.lit(None).cast("double")
    score = F.when(_c(key) % 101 == 0, fixed)
    for k, v in enumerate(EDGE_SCORES, 1):
        score = score.when(_c(key) % 101 == k, F.lit(v))
    return score.otherwise(x * x * x)


def is_score(p) -> Column:
    """True for a number; NULL and NaN take no part in any metric."""
    return _c(p).isNotNull() & ~F.isnan(_c(p))


# --- client birth number ---------------------------------------------------

def birth_gender(bn) -> Column:
    s = F.lpad(_c(bn).cast("string"), 6, "0")
    return F.when(F.substring(s, 3, 2).cast("int") > 50, F.lit("F")).otherwise(F.lit("M"))


def birth_date(bn, century: int = 1900) -> Column:
    s = F.lpad(_c(bn).cast("string"), 6, "0")
    mm = F.substring(s, 3, 2).cast("int")
    month = F.when(mm > 50, mm - 50).otherwise(mm)
    year = F.lit(century) + F.substring(s, 1, 2).cast("int")
    text = F.concat(year.cast("string"), F.lpad(month.cast("string"), 2, "0"), F.substring(s, 5, 2))
    return F.try_to_date(text, "yyyyMMdd")
