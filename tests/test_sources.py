"""district_edges / delimited scans / sinks / JSON records."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from lapse.sources.delimited import (CARD_SCHEMA, LOAN_SCHEMA, read_delimited, read_district,
                                     with_parsed_dates)
from lapse.sources.sinks import json_record, read_runs, write_table


def _write(text):
    d = tempfile.mkdtemp(prefix="lapse-src-")
    p = os.path.join(d, "t.csv")
    with open(p, "w") as f:
        f.write(text)
    return p


def test_semicolon_scan_with_quotes_and_schema(spark):
    p = _write('"card_id";"disp_id";"type";"issued"\n71;803;"blue";"970228 00:00:00"\n72;804;"green";"960229 00:00:00"\n')
    df = read_delimited(spark, p, CARD_SCHEMA)
    assert df.schema == CARD_SCHEMA
    assert [tuple(r) for r in df.collect()] == [(71, 803, "blue", "970228 00:00:00"),
                                                 (72, 804, "green", "960229 00:00:00")]
    p2 = _write('"loan_id";"account_id";"date";"amount";"duration";"payments";"status"\n9001;42;"950630";1200;10;"120.50";"Z"\n')
    loan = with_parsed_dates(read_delimited(spark, p2, LOAN_SCHEMA)).first()
    assert str(loan.payments) == "120.50" and loan.date_parsed.isoformat() == "1995-06-30"


def test_district_edges(spark):
    header = ";".join(f"A{i}" for i in range(1, 17))
    rows = ['1;"Upper; Town";"centre";1000;1;2;3;4;5;50.5;9000;1.25;1.5;100;10;20',
            '8;"Far Hills";"edge";2000;5;4;3;2;1;25.0;8000;?;2.5;200;?;30']
    p = _write("\n".join([header] + rows) + "\n")
    d = {r.district_id: r for r in read_district(spark, p).collect()}
    assert set(d) == {1, 8}                                   # header row rejected
    assert d[8].unemp_95 is None and d[8].crimes_95 is None    # '?' -> NULL
    assert d[1].avg_salary == 9000.0
    acct = spark.createDataFrame([(10, 8), (11, 99)], "account_id long, district_id int")
    joined = {r.account_id: r.region for r in acct.join(read_district(spark, p), "district_id", "left").collect()}
    assert joined == {10: "edge", 11: None}          # unknown district: NULL dimension


def test_table_sink_round_trip(spark):
    df = spark.createDataFrame([(1, "a", 2.5), (2, "b", None)], "k long, s string, v double")
    for fmt in ("parquet", "csv"):
        path = tempfile.mkdtemp(prefix="lapse-sink-") + "/out"
        write_table(df, path, fmt)
        back = (spark.read.parquet(path) if fmt == "parquet"
                else spark.read.schema(df.schema).option("header", True).csv(path))
        assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_json_sample_record(spark):
    df = spark.createDataFrame([(2, 1.5, True), (1, 0.25, False)], "k long, x double, flag boolean")
    rec = json.loads(json_record(df, "k").first().json)
    assert rec == {"k": 1, "x": 0.25, "flag": False}


def test_runs_table(spark):
    from lapse.sources.sinks import log_runs
    m = spark.createDataFrame([("a", 0.7, 0.2), ("b", 0.6, 0.1)], "model string, roc_auc double, brier double")
    path = tempfile.mkdtemp(prefix="lapse-runs-") + "/runs"
    log_runs(m, path, ("roc_auc", "brier"), {"seed": 42})
    log_runs(m, path, ("roc_auc",), {"seed": 43})
    runs = read_runs(spark, path)
    assert runs.count() == 6
    best = runs.where("metric = 'test_roc_auc'").agg(F.max_by("run_name", "value")).first()[0]
    assert best == "a"


def test_rewrite_partitioned_prunes_years(spark):
    from lapse.sources.delimited import TRANS_SCHEMA, rewrite_partitioned
    text = ('"trans_id";"account_id";"date";"type";"operation";"amount";"balance"\n'
            '1;10;"961231";"in";"cash";100.00;100.00\n'
            '2;10;"970105";"out";"cash";-20.50;79.50\n'
            '3;11;"980301";"in";"cash";5.25;5.25\n')
    src = with_parsed_dates(read_delimited(spark, _write(text), TRANS_SCHEMA))
    out = tempfile.mkdtemp(prefix="lapse-part-") + "/trans"
    rewrite_partitioned(src, out)
    back = spark.read.parquet(out).where(F.col("year") == 1997)
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        back.explain()
    plan = buf.getvalue()
    assert "PartitionFilters: [isnotnull(year" in plan and "= 1997" in plan
    assert [r.trans_id for r in back.collect()] == [2]
    assert str(back.first().balance) == "79.50"


def test_rewrite_partitioned_splits_a_large_year(spark, tmp_path):
    from lapse.sources.delimited import rewrite_partitioned
    df = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("pad"),
                                    F.when(F.col("id") % 100 == 0, F.lit("1996-05-05")).otherwise(F.lit("1997-05-05"))
                                    .cast("date").alias("date_parsed")).repartition(8)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        rewrite_partitioned(df, str(tmp_path / "y"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert spark.read.parquet(str(tmp_path / "y")).count() == 60_000
    assert len(list((tmp_path / "y" / "year=1997").glob("*.parquet"))) > 1


def test_cents_are_the_decimal(spark):
    from lapse.sources.tables import MONEY, cents
    v = [(1.005,), (2.675,), (0.1,), (-1.005,), (float("nan"),), (None,), (float("inf"),), (1e30,)]
    rows = spark.createDataFrame(v, "x double").select(
        cents(F.col("x")).alias("c"), (F.col("x").try_cast(MONEY) * 100).cast("long").alias("d")).collect()
    assert [r.c for r in rows] == [r.d for r in rows]
    assert [r.c for r in rows][:1] == [101] and [r.c for r in rows][4:] == [None] * 4


def test_table_shapes_come_from_the_file(spark, sf_dir):
    import __spark_entry__ as E
    got = {r.table: r.n_cols for r in E.queries()["table_shapes"](spark, sf_dir).collect()}
    assert got["orders"] == len(spark.read.parquet(f"{sf_dir}/orders.parquet").columns)


def test_cluster_without_shared_folder_fails_clearly():
    import pytest

    from lapse.session import checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *_):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
