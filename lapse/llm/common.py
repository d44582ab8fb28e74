"""Helpers that several training-data operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapse.session import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors, once per application.

    Functions that run in Python workers are found by module name there.
    """
    sc = spark.sparkContext
    name = f"lapse-{sc.applicationId}.zip"
    if any(str(f).endswith(name) for f in sc.listFiles):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="lapse-ship-"), name)      # the driver serves this copy
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(package):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` would also change other letters; ASCII texts have none)."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def number_within(df: DataFrame, group: list[str], out: str, buckets: int) -> DataFrame:
    """Add ``out``: numbers from 0 without gaps inside each group, in any order.

    Each group is cut into ``buckets`` salted parts, so a group that holds most
    rows is still numbered by many tasks: counts per part give each part its
    first number, a window per part does the rest.  The salted rows are written
    once because both passes must see the same salt.  Repeated rows get numbers
    of their own; an empty table stays empty.
    """
    salted = materialize(
        df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(buckets))), "numbered")
    keys = [*group, "_salt"]
    before = (Window.partitionBy(*group).orderBy("_salt")
              .rowsBetween(Window.unboundedPreceding, -1))
    first = (salted.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
             .select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")))
    part = Window.partitionBy(*keys).orderBy("_salt")
    return (salted.withColumn("_at", F.row_number().over(part))
            .join(first, keys)
            .withColumn(out, (F.col("_first") + F.col("_at") - 1).cast("long"))
            .drop("_salt", "_first", "_at"))
