"""Every query on the smallest tables against its SQL."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract

DIR = contract.SMOKE_DIR
NAMES = sorted(contract.queries())


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for f in glob.glob(f"{DIR}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def plain(x):
    if x is None or x != x:
        return None
    return round(float(x), 5) if isinstance(x, int | float) and not isinstance(x, bool) else str(x)


def same(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and abs(a - b) <= 2e-5 * max(1.0, abs(a)))


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, db, name):
    df = contract.queries()[name](spark, DIR)
    rows = df.collect()
    sql = contract.oracle_sql().get(name)
    if not sql:
        assert len({tuple(map(str, r)) for r in rows}) > 0
        return
    r = db.sql(sql)
    assert sorted(df.columns) == sorted(r.columns)
    at = [r.columns.index(c) for c in sorted(df.columns)]
    key = lambda t: tuple((v is None, str(v)) for v in t)
    got = sorted((tuple(plain(x[c]) for c in sorted(df.columns)) for x in rows), key=key)
    want = sorted((tuple(plain(x[i]) for i in at) for x in r.fetchall()), key=key)
    assert len(got) == len(want) and all(same(a, b) for x, y in zip(got, want, strict=True) for a, b in zip(x, y, strict=True))


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["segment", "vehicle_id", "started_at", "ended_at"] and df.count() > 0


def test_found_columns(spark):
    want = {
        "p1_found": [("pair_type", "string"), ("key_a", "string"), ("key_b", "string")], "p2_found": [("source_name", "string"), ("series_key", "string"), ("period_start", "string")],
        "p3_found": [("vehicle_id", "string"), ("slot_start", "string")], "p4_found": [("source_name", "string"), ("row_key", "bigint")], "p5_found": [("row_id", "bigint")],
        "p6_found": [("segment", "string"), ("vehicle_id", "string"), ("started_at", "string"), ("ended_at", "string")],
        "p7_found": [("request_id", "bigint"), ("line_pos", "int"), ("vehicle_pos", "int"), ("line_code", "string"), ("vehicle_prefix", "string")],
    }
    for name, kinds in want.items():
        assert contract.queries()[name](spark, DIR).dtypes == kinds


def test_workers_need_no_search_path(tmp_path):
    import subprocess
    import sys
    from pathlib import Path

    root = str(Path(contract.__file__).parent)
    code = f"import sys; sys.path.insert(0, {root!r}); import __spark_entry__ as e; from pyspark.sql import SparkSession; s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate(); print('ROWS', e.queries()['p5_found'](s, {DIR!r}).count())"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
