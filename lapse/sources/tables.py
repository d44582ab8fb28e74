"""Readers for the driver's Parquet tables and the stand-in relations built on them.

Every table is read with an explicit schema (never inferred).  The stand-in
relations are plain projections / filters so Catalyst prunes columns and pushes
predicates into the Parquet scan.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import STAND_IN, StandIn

L, I, D, S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
TS = T.TimestampNTZType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCHEMAS: dict[str, T.StructType] = {
    "region": _st(("r_regionkey", I), ("r_name", S)),
    "nation": _st(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _st(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D),
                    ("c_mktsegment", S)),
    "supplier": _st(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "part": _st(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", I),
                ("p_retailprice", D)),
    "orders": _st(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D),
                  ("o_orderdate", TS), ("o_orderpriority", S)),
    "lineitem": _st(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
                    ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
                    ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", TS)),
    "events": _st(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S), ("value", D),
                  ("props", S)),
}

STAR_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

MONEY = T.DecimalType(18, 2)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(table_path(sf_dir, name))


# ---------------------------------------------------------------------------
# Stand-in relations
# ---------------------------------------------------------------------------

def cents(c: Column) -> Column:
    """The DECIMAL(18,2) amount as integer cents (LONG): sums stay exact and on
    Spark's fast long path instead of wide-DECIMAL arithmetic.  What is no amount
    (NULL, NaN, infinite, too large) is NULL."""
    return (c.try_cast(MONEY) * 100).cast("long")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """trans -> orders: (trans_id, account_id, d, amount, balance) with money as
    DECIMAL(18,2) plus the same values as integer cents (Catalyst keeps only
    the columns a consumer reads)."""
    o = read_table(spark, sf_dir, "orders")
    amt = F.col("o_totalprice").try_cast(MONEY)
    return o.select(
        F.col("o_orderkey").alias("trans_id"),
        F.col("o_custkey").alias("account_id"),
        F.col("o_orderdate").cast("date").alias("d"),
        amt.alias("amount"),
        amt.alias("balance"),
        cents(F.col("o_totalprice")).alias("amount_cents"),
        cents(F.col("o_totalprice")).alias("balance_cents"),
        (F.col("o_orderpriority") == STAND_IN.urgent_priority).alias("is_loan"),
        (F.col("o_orderstatus") == STAND_IN.standing_status).alias("is_standing"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """account -> customer: (account_id, district_id, frequency)."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("account_id"),
        F.col("c_nationkey").alias("district_id"),
        F.col("c_mktsegment").alias("frequency"),
    )


def loans(spark: SparkSession, sf_dir: str, si: StandIn = STAND_IN) -> DataFrame:
    """loan -> urgent orders: (loan_id, account_id, d)."""
    o = read_table(spark, sf_dir, "orders")
    return (o.where(F.col("o_orderpriority") == si.urgent_priority)
             .select(F.col("o_orderkey").alias("loan_id"), F.col("o_custkey").alias("account_id"),
                     F.col("o_orderdate").cast("date").alias("d")))


def standing_orders_src(spark: SparkSession, sf_dir: str, si: StandIn = STAND_IN) -> DataFrame:
    """order -> open orders: (order_id, account_id, amount)."""
    o = read_table(spark, sf_dir, "orders")
    return (o.where(F.col("o_orderstatus") == si.standing_status)
             .select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("account_id"),
                     F.col("o_totalprice").cast(MONEY).alias("amount")))


def cards(spark: SparkSession, sf_dir: str, si: StandIn = STAND_IN) -> DataFrame:
    """card -> qualifying lineitems: (card_id, disp_id) with disp_id = l_orderkey."""
    li = read_table(spark, sf_dir, "lineitem")
    return (li.where((F.col("l_returnflag") == si.bridge_returnflag)
                     & (F.col("l_quantity") >= si.bridge_min_quantity))
              .select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("card_id"),
                      F.col("l_orderkey").alias("disp_id"),
                      F.col("l_shipdate").cast("date").alias("issued")))


def dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """disp -> orders as the account bridge: (disp_id, account_id, d)."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("disp_id"), F.col("o_custkey").alias("account_id"),
                    F.col("o_orderdate").cast("date").alias("d"))


def districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """district -> nation + region + per-nation supplier aggregates.

    One row per nation; Spark broadcasts it while it is small.
    """
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    s = read_table(spark, sf_dir, "supplier")
    supp = s.groupBy(F.col("s_nationkey").alias("district_id")).agg(
        F.count(F.lit(1)).alias("n_suppliers"),
        (F.sum(F.col("s_acctbal").cast(MONEY)).cast("double")
         / F.count("s_acctbal")).alias("supp_acctbal_mean"),
        F.min("s_acctbal").alias("supp_acctbal_min"),
        F.max("s_acctbal").alias("supp_acctbal_max"),
    )
    dim = (n.join(r, n.n_regionkey == r.r_regionkey, "left")
            .select(F.col("n_nationkey").alias("district_id"), F.col("n_name").alias("district_name"),
                    F.col("r_name").alias("region"), F.col("n_regionkey").alias("region_id")))
    return dim.join(supp, "district_id", "left")


def sentinel_text(key: Column, value: Column, every: int = STAND_IN.sentinel_every) -> Column:
    """Text column carrying the reference's '?' sentinel in every ``every``-th key."""
    return F.when(key % every == 0, F.lit("?")).otherwise(value.cast("string"))


def customers_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer with the balance as raw text containing '?' sentinels (S3/F-M1/A15)."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("account_id"),
                    F.col("c_mktsegment").alias("frequency"),
                    sentinel_text(F.col("c_custkey"), F.col("c_acctbal")).alias("acctbal_text"))


def birth_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """client -> 6-digit birth-number text derived from the customer key.

    yy = key*7 mod 100, mm = 1 + key mod 12 (+50 for odd keys = female),
    dd = 1 + key mod 28.  Stored as an integer, so leading zeros are lost, the
    way the reference's CSV reader loses them.
    """
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    yy = (k * 7) % 100
    mm = F.lit(1) + k % 12 + F.when(k % 2 == 1, F.lit(50)).otherwise(F.lit(0))
    dd = F.lit(1) + k % 28
    return c.select(k.alias("client_id"), (yy * 10000 + mm * 100 + dd).cast("int").alias("birth_number"))
