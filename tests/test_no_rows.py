"""Queries that write and read back, on positions of which none is left by the box or the time; their SQL has empty results."""

import os
from datetime import datetime

import duckdb
import pytest

import __spark_entry__ as contract
from fleetspan.schemas import schema
from fleetspan.sources import sinks
from fleetspan.streaming import positions as st

KEPT = {"outside": "* replace (latitude + 90 as latitude)", "no time": "* replace (null::timestamp as timestamp)", "no rows": "*"}


@pytest.fixture(scope="module", params=KEPT)
def folder(request, tmp_path_factory):
    d = tmp_path_factory.mktemp("tables")
    for f in os.listdir(contract.SMOKE_DIR):
        if f != "vehicle_positions.parquet":
            os.symlink(f"{contract.SMOKE_DIR}/{f}", d / f)
    rows = f"select {KEPT[request.param]} from '{contract.SMOKE_DIR}/vehicle_positions.parquet'" + " limit 0" * (request.param == "no rows")
    duckdb.execute(f"copy ({rows}) to '{d}/vehicle_positions.parquet' (format parquet)")
    return str(d)


def same_as_sql(spark, folder, name):
    db = duckdb.connect()
    db.execute(f"create view vehicle_positions as select * from '{folder}/vehicle_positions.parquet'")
    df, r = contract.queries()[name](spark, folder), db.sql(contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(r.columns)
    assert [tuple(x) for x in df.select(*r.columns).collect()] == r.fetchall()
    assert df.dtypes == contract.queries()[name](spark, contract.SMOKE_DIR).dtypes


def test_silver_append(spark, folder):
    same_as_sql(spark, folder, "b3_silver_append")


def test_merge_daily(spark, folder):
    same_as_sql(spark, folder, "b9_merge_daily")


def test_rows_are_merged_into_a_table_without_rows(spark, tmp_path):
    df, path = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), str(tmp_path / "t")
    for rows in (df.limit(0), df.limit(0), df, df.limit(0)):
        sinks.upsert(rows, path, ["k"], "v")
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 2)]


def test_last_positions(spark, folder):
    same_as_sql(spark, folder, "l6_last_positions")


def test_a_first_batch_without_rows(spark, tmp_path):
    src, last, cp = str(tmp_path / "in"), str(tmp_path / "last"), str(tmp_path / "cp")
    for place in (0.0, -23.5):
        spark.createDataFrame([("a", datetime(2018, 1, 1, 8), place, -46.6, None, "r", 1, True)], schema("stream", "positions")).write.mode("append").parquet(src)
        st.keep_latest(st.transformed(st.file_stream(spark, src)), last, str(tmp_path / "speeds"), cp).awaitTermination()
    assert [(r["vehicle_id"], r["latitude"]) for r in spark.read.parquet(last).collect()] == [("a", -23.5)]


def test_gold_append(spark, folder):
    same_as_sql(spark, folder, "b4_gold_append")


def test_stream_to_files(spark, folder):
    same_as_sql(spark, folder, "l4_stream_to_files")


def test_jobs(spark, folder):
    same_as_sql(spark, folder, "n15_jobs")
