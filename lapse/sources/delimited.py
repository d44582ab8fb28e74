"""Delimited-text scans with explicit schemas.

``;``-separated files with quoted strings, read with a declared schema (never
``inferSchema``).  A headerless file whose first line is a header is read as
text and the header line is rejected because its id does not cast.
"""

from __future__ import annotations

import re

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import parse_yymmdd

# Column layouts of the reference's raw bank tables (fixed values).
CARD_SCHEMA = T.StructType([
    T.StructField("card_id", T.LongType()), T.StructField("disp_id", T.LongType()),
    T.StructField("type", T.StringType()), T.StructField("issued", T.StringType())])
LOAN_SCHEMA = T.StructType([
    T.StructField("loan_id", T.LongType()), T.StructField("account_id", T.LongType()),
    T.StructField("date", T.StringType()), T.StructField("amount", T.LongType()),
    T.StructField("duration", T.IntegerType()), T.StructField("payments", T.DecimalType(10, 2)),
    T.StructField("status", T.StringType())])
TRANS_SCHEMA = T.StructType([
    T.StructField("trans_id", T.LongType()), T.StructField("account_id", T.LongType()),
    T.StructField("date", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("operation", T.StringType()), T.StructField("amount", T.DecimalType(18, 2)),
    T.StructField("balance", T.DecimalType(18, 2))])
DISTRICT_COLUMNS = (
    "district_id", "district_name", "region", "n_inhabitants", "n_muni_lt499", "n_muni_500_1999",
    "n_muni_2000_9999", "n_muni_gt10000", "n_cities", "urban_ratio", "avg_salary", "unemp_95",
    "unemp_96", "n_entrepreneurs_per1000", "crimes_95", "crimes_96")


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";",
                   header: bool = True, mode: str = "PERMISSIVE") -> DataFrame:
    """Header + separator + quotes, typed by the declared schema."""
    return (spark.read.schema(schema).option("sep", sep).option("header", header)
                 .option("quote", '"').option("escape", '"').option("mode", mode).csv(path))


def read_headerless_text(spark: SparkSession, path: str, names: Sequence[str], sep: str = ";") -> DataFrame:
    """Every column as text, renamed by position."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).option("sep", sep).option("header", False).option("quote", '"').csv(path)


def reject_non_numeric_ids(raw: DataFrame, names: Sequence[str], id_col: str,
                           int_cols: Sequence[str] = (), double_cols: Sequence[str] = ()) -> DataFrame:
    """Rename by position, keep rows whose id casts, cast ids / numerics tolerantly."""
    df = raw.toDF(*names)
    idv = F.col(id_col).try_cast("int")
    out = df.where(idv.isNotNull()).withColumn(id_col, idv)
    for c in int_cols:
        out = out.withColumn(c, F.col(c).try_cast("int"))
    for c in double_cols:
        out = out.withColumn(c, F.col(c).try_cast("double"))
    return out


def read_district(spark: SparkSession, path: str) -> DataFrame:
    """The district file: headerless, header line rejected, '?' -> NULL numerics."""
    raw = read_headerless_text(spark, path, DISTRICT_COLUMNS)
    numeric = [c for c in DISTRICT_COLUMNS[3:]]
    return reject_non_numeric_ids(raw, DISTRICT_COLUMNS, "district_id", double_cols=numeric)


def with_parsed_dates(df: DataFrame, col: str = "date", out: str = "date_parsed") -> DataFrame:
    return df.withColumn(out, parse_yymmdd(col))


def rewrite_partitioned(df: DataFrame, path: str, date_col: str = "date_parsed") -> None:
    """S2 at scale: a large delimited table is rewritten once to Parquet
    partitioned by year, so window filters prune whole directories.  The
    rebalance gathers small years and splits large ones over several tasks."""
    (df.withColumn("year", F.year(date_col)).hint("rebalance", "year")
       .write.mode("overwrite").partitionBy("year").parquet(path))


def rewrite_bucketed(df: DataFrame, path: str, key: str, buckets: int, sort: list[str] | None = None) -> DataFrame:
    """S2 by account: a table bucketed and sorted by ``key`` under ``path``, and its reader.

    Tables written with the same number of buckets are grouped by the key and
    joined on it without an exchange.  Rows go to their bucket's task first, so
    a bucket is one file.  The table is named after its path; a key that holds
    most rows still fills one bucket, for which the layout by year is the better.
    """
    name = "lapse_" + re.sub(r"\W", "_", path.rstrip("/").rsplit("/", 1)[-1])
    (df.repartition(buckets, key).write.mode("overwrite").option("path", path)
       .bucketBy(buckets, key).sortBy(*(sort or [key])).saveAsTable(name))
    return df.sparkSession.table(name)
