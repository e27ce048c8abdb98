from datetime import datetime, timedelta

from fleetspan.operators.kpi import windowed
from fleetspan.streaming import positions as st

T0 = datetime(2018, 1, 1, 8)
DDL = "vehicle_id string, timestamp timestamp, latitude double, longitude double, speed double, route_code string, direction int, accessibility boolean"


def rows(n, start=0):
    return [(f"v{i % 7}", T0 + timedelta(seconds=30 * (start + i)), -23.6 + 0.0001 * i, -46.6, float(i % 40), f"r{i % 3}", 1, True) for i in range(n)]


def test_stream_equals_batch(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.createDataFrame([*rows(200), ("far", T0, 0.0, 0.0, 1.0, "r0", 1, True)], DDL)
    df.repartition(3).write.parquet(src)
    q = st.to_files(st.transformed(st.file_stream(spark, src)), out, str(tmp_path / "cp"), every=None)
    q.awaitTermination()
    got = spark.read.parquet(out)
    batch = st.transformed(df)
    assert got.count() == batch.count() == 200
    assert got.groupBy("is_moving").count().exceptAll(batch.groupBy("is_moving").count()).count() == 0
    # a second run on the same checkpoint takes only what is new
    spark.createDataFrame(rows(5, 1000), DDL).write.mode("append").parquet(src)
    st.to_files(st.transformed(st.file_stream(spark, src)), out, str(tmp_path / "cp"), every=None).awaitTermination()
    assert spark.read.parquet(out).count() == 205


def test_windows_on_a_stream_equal_the_batch_for_closed_windows(spark, tmp_path):
    src = str(tmp_path / "in")
    df = spark.createDataFrame(rows(200), DDL)
    df.coalesce(1).write.parquet(src)
    spark.createDataFrame(rows(1, 500), DDL).coalesce(1).write.mode("append").parquet(src)
    q = st.window_figures(st.file_stream(spark, src)).writeStream.format("memory").queryName("w").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    got, want = spark.table("w"), windowed(df, "route_code")
    assert got.count() > 0 and got.exceptAll(want).count() == 0


def test_copies_within_the_watermark(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame(rows(20) + rows(20), DDL).write.parquet(src)
    q = st.once_each(st.file_stream(spark, src)).writeStream.format("memory").queryName("o").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("o").count() == 20


def test_messages(spark):
    m = spark.createDataFrame([('{"vehicle_id":"a","timestamp":"2018-01-01T08:00:00Z","latitude":-23.5,"longitude":-46.6}',), ("{broken",), ('{"vehicle_id":"b"}',), (None,)], "value string")
    out = st.parsed(m).collect()
    assert len(out) == 1 and out[0]["vehicle_id"] == "a" and out[0]["timestamp"] == T0


def test_last_positions_across_batches(spark, tmp_path):
    src, table, out = str(tmp_path / "in"), str(tmp_path / "last"), str(tmp_path / "speeds")
    for k in range(2):
        spark.createDataFrame([("a", T0 + timedelta(seconds=60 * k), -23.5 + 0.001 * k, -46.6, None, "r", 1, True)], DDL).write.mode("append").parquet(src)
        st.keep_latest(st.file_stream(spark, src), table, out, str(tmp_path / "cp")).awaitTermination()
    speeds = sorted(r["computed_speed"] for r in spark.read.parquet(out).collect())
    assert speeds[0] == 0 and 6 < speeds[1] < 7
    last = spark.read.parquet(table).collect()
    assert len(last) == 1 and last[0]["ts"] == T0 + timedelta(seconds=60)
