"""Source cleaning and audit queries (S3, S5, S7, P12, F-D1, F-S3, A9, A12-A15)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import STAND_IN, WINDOWS, Windows
from ..functions.columns import birth_date, birth_gender, parse_yymmdd
from ..operators.profile import date_range_audit as _date_audit
from ..operators.profile import null_census as _null_census
from ..operators.profile import numeric_profile as _profile
from ..operators.profile import sentinel_census as _sentinel
from ..operators.profile import table_shapes as _shapes
from ..sources.delimited import reject_non_numeric_ids
from ..sources.tables import STAR_TABLES, birth_numbers, read_table, sentinel_text, table_path, transactions
from .features import FEATURE_ORDER, feature_table
from .labels import churn_label

NATION_COLS = ("n_nationkey", "n_name", "n_regionkey")


def scan_reject_nonnumeric(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """S3: a headerless text scan whose header line arrives as a data row.

    The nation table is turned into all-text rows, a literal header row is
    unioned in (what ``header=False`` yields on such a file), then rows whose
    id does not cast are rejected and the ids are cast.
    """
    n = read_table(spark, sf_dir, "nation")
    text = n.select(*[F.col(c).cast("string").alias(f"_c{i}") for i, c in enumerate(NATION_COLS)])
    header = spark.createDataFrame([tuple(NATION_COLS)], [f"_c{i}" for i in range(3)])
    raw = header.unionByName(text)
    return reject_non_numeric_ids(raw, list(NATION_COLS), "n_nationkey", int_cols=("n_regionkey",))


PROPS_SCHEMA = T.StructType([T.StructField("k", T.IntegerType(), True)])


def json_record_parse(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """Flat JSON records parsed with a fixed schema (``from_json``)."""
    e = read_table(spark, sf_dir, "events")
    return e.select("event_id", F.from_json("props", PROPS_SCHEMA)["k"].alias("k"))


def json_sample_row(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """The first record by key as a flat row (the JSON text is written by
    ``sources.sinks.write_json_sample``)."""
    c = read_table(spark, sf_dir, "customer")
    return c.orderBy("c_custkey").limit(1)


REQUIRED_FIELDS = ("district_id", "acctbal", "frequency")


def reject_incomplete(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """Records missing a required field are rejected with the names of the fields.

    The balance is missing in every ``incomplete_every``-th record (stand-in
    for a request body without that field).
    """
    c = read_table(spark, sf_dir, "customer")
    rec = c.select(F.col("c_custkey").alias("account_id"), F.col("c_nationkey").alias("district_id"),
                   F.when(F.col("c_custkey") % STAND_IN.incomplete_every != 0, F.col("c_acctbal")).alias("acctbal"),
                   F.col("c_mktsegment").alias("frequency"))
    missing = F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in REQUIRED_FIELDS]))
    return (rec.select("account_id", F.size(missing).alias("n_missing"), F.array_join(missing, ",").alias("missing"))
               .where(F.col("n_missing") > 0))


def parse_yymmdd_q(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """F-D1: dates before 2000 written as yyMMdd text, parsed back in century 19."""
    tx = transactions(spark, sf_dir).where(F.col("d") < F.lit("2000-01-01").cast("date"))
    t = tx.select("trans_id", F.date_format("d", "yyMMdd").alias("yymmdd"))
    return t.select("trans_id", "yymmdd", parse_yymmdd("yymmdd").alias("d_parsed"))


def decode_birth_number(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """F-S1..F-S3: gender from month > 50, birth date with month - 50, zero-padded."""
    b = birth_numbers(spark, sf_dir)
    return b.select("client_id", "birth_number", birth_gender("birth_number").alias("gender"),
                    birth_date("birth_number").alias("birth_date"))


def numeric_profile(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """describe() of the label inputs."""
    return _profile(churn_label(spark, sf_dir, w), ["avg_balance_obs", "balance_ratio"])


def null_census(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """NULLs per feature column before any fill."""
    ft = feature_table(spark, sf_dir, w, fill=False)
    return _null_census(ft, FEATURE_ORDER)


def sentinel_census(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """A15: '?' left per text column of the raw customer record."""
    c = read_table(spark, sf_dir, "customer")
    text = c.select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
                    sentinel_text(F.col("c_custkey"), F.col("c_acctbal")).alias("acctbal_text"),
                    sentinel_text(F.col("c_custkey") + 3, F.col("c_nationkey")).alias("nation_text"))
    return _sentinel(text, ["name", "segment", "acctbal_text", "nation_text"])


def table_shapes(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """Rows and columns of the eight star tables, as their files have them."""
    return _shapes({t: spark.read.parquet(table_path(sf_dir, t)) for t in STAR_TABLES})


def date_range_audit(spark: SparkSession, sf_dir: str, w: Windows = WINDOWS) -> DataFrame:
    """Min / max date and counts outside [history_start, label_end]."""
    o = read_table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    li = read_table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("d"))
    return _date_audit({"orders.o_orderdate": o, "lineitem.l_shipdate": li},
                       w.history_start.isoformat(), w.label_end_lit)
