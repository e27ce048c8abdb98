import random
from datetime import datetime, timedelta

import numpy as np

from fleetspan.operators.delivery import BucketBlooms, DeliveryLog, filter_bits, surplus_rows

T0 = datetime(2018, 1, 1, 5)
DDL = "row_id bigint, vehicle_id string, timestamp timestamp, arrival string, bucket string, surplus int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], DDL)


def found(df):
    return sorted(r[0] for r in surplus_rows(df).collect())


def brute(rows):
    first, out = {}, []
    for i, v, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        name = (v or "").strip().lstrip("0") if v is not None and v.strip() else None
        if name is None or t is None:
            continue
        if (name.zfill(8), t) in first:
            out.append(i)
        first.setdefault((name.zfill(8), t), i)
    return sorted(out)


def test_spellings_nulls_ties_and_clashing_columns(spark):
    rows = [(1, "10000001", T0), (2, " 0010000001\t", T0), (3, "10000001", None), (4, None, T0), (5, None, T0), (6, "  ", T0), (7, "", T0), (8, "10000002", T0), (9, "10000001", T0), (10, "10000001", T0 + timedelta(microseconds=1))]
    assert found(frame(spark, rows)) == [2, 9]


def test_empty(spark):
    assert found(frame(spark, [])) == []


def test_random_against_brute_force(spark):
    r = random.Random(5)
    rows = [(i, r.choice([None, "7", "007", " 7", "8", "abc", "10000009"]), r.choice([None, *(T0 + timedelta(minutes=41 * k) for k in range(30))])) for i in range(3000)]
    r.shuffle(rows)
    assert found(frame(spark, rows)) == brute(rows)


def test_a_group_of_copies_holds_most_rows(spark):
    rows = [(i, "1", T0) for i in range(5000)] + [(5000 + i, str(i), T0) for i in range(2, 2000)]
    assert len(found(frame(spark, rows))) == 4999


def test_filters_never_miss_and_are_seldom_wrong():
    r = np.random.default_rng(0)
    key = r.integers(-(2**62), 2**62, 30_000)
    group = np.abs(key) % 7
    blooms = BucketBlooms(filter_bits(np.bincount(group[:20_000])))
    blooms.add(group[:20_000], key[:20_000])
    assert blooms.seen(group[:20_000], key[:20_000]).all()
    assert blooms.seen(group[20_000:], key[20_000:]).mean() < 0.02
    again = BucketBlooms(blooms.size, np.frombuffer(b"".join(blooms.of(g) for g in range(7)), dtype=np.uint8))
    assert (again.bits == blooms.bits).all()


def test_generations_through_the_log(spark, tmp_path):
    r = random.Random(8)
    rows = [(i, r.choice([None, "7", " 7", "8", "10000009"]), r.choice([None, *(T0 + timedelta(minutes=41 * k) for k in range(60))])) for i in range(900)]
    log, kept, gone = DeliveryLog(str(tmp_path / "log")), [], []
    for n in range(3):
        got = log.ingest(frame(spark, rows[n * 300 : (n + 1) * 300]), n).collect()
        kept += [x["arrival"] for x in got if x["kind"] == "new"]
        gone += [x["arrival"] for x in got if x["kind"] == "surplus"]
    again = sorted(x["arrival"] for x in log.ingest(frame(spark, rows[600:]), 2).where("kind = 'new'").collect())
    surplus = set(brute(rows))
    want = sorted(i for i, v, t in rows if i not in surplus and t is not None and v is not None)
    assert sorted(kept) == want and again == [i for i in want if i >= 600] and sorted(gone) == sorted(surplus)
    assert log.ingest(frame(spark, rows[:300]), 3).where("kind = 'new'").count() == 0
    assert log.ingest(frame(spark, []), 4).count() == 0


def test_what_no_filter_knows_is_not_compared(spark, tmp_path):
    rows = [(i, str(i), T0 + timedelta(seconds=i)) for i in range(4000)]
    log = DeliveryLog(str(tmp_path / "log"))
    log.ingest(frame(spark, rows[:2000]), 0)
    log.ingest(frame(spark, [*rows[2000:], (9000, "5", rows[5][2])]), 1)
    kinds = {r["kind"]: r["count"] for r in log.stored(spark, 2).where("gen = 1").groupBy("kind").count().collect()}
    assert 1 <= kinds["maybe"] < 100 and kinds["new"] > 1900
