"""birth_edges / tier_edges / date and numeric traps."""

import datetime as dt

from pyspark.sql import functions as F

from lapse.functions.columns import (birth_date, birth_gender, coerce_numeric, flag_le, parse_yymmdd,
                                     parse_yymmdd_time, risk_tier, round_prob)
from lapse.functions.encode import one_hot_cols, standard_scale


def test_birth_edges(spark):
    df = spark.createDataFrame([(706213,), (450204,), (16101,)], "bn int")
    got = [(r.g, r.d) for r in df.select(birth_gender("bn").alias("g"), birth_date("bn").alias("d")).collect()]
    assert got == [("F", dt.date(1970, 12, 13)), ("M", dt.date(1945, 2, 4)), ("F", dt.date(1901, 11, 1))]


def test_two_digit_year_century(spark):
    df = spark.createDataFrame([("930101",), ("000229",), ("981208",), ("971231 23:59:01",)], "s string")
    r = df.select(parse_yymmdd("s").alias("d")).collect()
    assert r[0].d == dt.date(1993, 1, 1)
    assert r[1].d is None              # 1900 is not a leap year
    assert r[2].d == dt.date(1998, 12, 8)
    t = df.select(parse_yymmdd_time("s").alias("t")).collect()[3].t
    assert t == dt.datetime(1997, 12, 31, 23, 59, 1)


def test_tier_edges(spark):
    df = spark.createDataFrame([(0.2,), (0.19996,), (0.1,), (0.09996,), (None,), (float("nan"),)], "p double")
    r = df.select(risk_tier("p").alias("t"), round_prob("p").alias("r")).collect()
    assert [x.t for x in r] == ["High", "Medium", "Medium", "Low", None, None]
    assert r[1].r == 0.2               # shown rounded, tiered unrounded


def test_round_like_python(spark):
    import random
    rnd = random.Random(5)
    vals = [0.00005, 0.00015, 0.00025, 0.12345, 0.99995, 0.5, 0.0, 1.0, 0.19996, 0.09996, -0.00015]
    vals += [k / 100000 for k in range(1, 100000, 7)] + [rnd.random() for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in vals], "p double")
    got = [r.r for r in df.select(round_prob("p").alias("r")).collect()]
    assert got == [round(v, 4) for v in vals]


def test_coerce_and_missing_compare(spark):
    df = spark.createDataFrame([("12.5",), ("?",), ("",), (None,)], "s string")
    r = df.select(coerce_numeric(F.col("s")).alias("v"), flag_le(coerce_numeric(F.col("s")), F.lit(20.0)).alias("f")).collect()
    assert [x.v for x in r] == [12.5, None, None, None]
    assert [x.f for x in r] == [1, 0, 0, 0]


def test_one_hot_all_and_drop_first(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "f string")
    all_ = df.select(*one_hot_cols("f", ["a", "b"])).collect()
    assert [tuple(r) for r in all_] == [(0, 1), (1, 0), (0, 0)]
    first = df.select(*one_hot_cols("f", ["a", "b"], drop_first=True))
    assert first.columns == ["f_b"]


def test_standard_scale_population_std(spark):
    df = spark.createDataFrame([(1, 1.0, "train"), (2, 3.0, "train"), (3, 5.0, "test")], "k int, x double, fold string")
    out = {r.k: r.x_scaled for r in standard_scale(df, ["x"], df.where("fold = 'train'")).collect()}
    assert out == {1: -1.0, 2: 1.0, 3: 3.0}
