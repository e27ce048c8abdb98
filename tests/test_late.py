import random

from pyspark.sql import functions as F

from fleetspan.operators.late import Lateness, PeriodStore, corrected_periods, current, merge_partials, partials

RULE = Lateness(600, 120, 1800)
DDL = "series_key string, event_us bigint, arrival_us bigint, version bigint, member string, figure double, batch_us string"
M = 60_000_000


def events(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], DDL)


def changed(store):
    return {(r["series_key"], r["period_us"]) for r in corrected_periods(store, RULE).where("changed").collect()}


def brute(rows):
    out, keys = set(), {(s, e - e % (10 * M)) for s, e, a, v, m, f in rows if None not in (s, e, a, m)}
    for s, p in keys:
        def at(moment):
            state = {}
            for r in sorted((r for r in rows if r[0] == s and None not in (r[1], r[2], r[4]) and r[1] - r[1] % (10 * M) == p and r[2] <= moment), key=lambda r: (r[2], r[3] is not None, r[3] or 0, r[5] is not None, r[5] or 0)):
                state[r[4]] = r[5]
            return {m: f for m, f in state.items() if f is not None}
        if at(p + 12 * M) != at(p + 40 * M):
            out.add((s, p))
    return out


def test_random_against_brute_force_and_merging_in_any_order(spark):
    r = random.Random(1)
    rows = [(r.choice(["a", "b", None]), r.choice([None, r.randrange(0, 60 * M)]), r.randrange(0, 110 * M), r.randrange(3), r.choice("xyz"), r.choice([None, 1.0, 2.0])) for _ in range(600)]
    rows += [("edge", 0, 12 * M, 0, "x", 1.0), ("edge2", 0, 12 * M + 1, 0, "x", 1.0), ("edge3", 0, 40 * M, 0, "x", 1.0), ("edge4", 0, 40 * M + 1, 0, "x", 1.0)]
    whole = partials(events(spark, rows), RULE)
    assert changed(whole) == brute(rows)
    a, b = partials(events(spark, rows[::2]), RULE), partials(events(spark, rows[1::2]), RULE)
    merged = merge_partials(merge_partials(b, a), b)
    assert changed(merged) == brute(rows)
    assert {"edge2", "edge3"} <= {s for s, _ in changed(whole)} and not {"edge", "edge4"} & {s for s, _ in changed(whole)}


def test_closed_periods_are_refused_and_open_ones_known(spark):
    rows = [("a", 0, 5 * M, 0, "x", 1.0), ("a", 0, 50 * M, 0, "y", 1.0)]
    store = partials(events(spark, rows), RULE)
    assert store.count() == 1
    now = current(store, 39 * M, RULE).collect()[0]
    assert now["n"] == 1 and now["open"]
    assert not current(store, 41 * M, RULE).select(F.col("open")).first()[0]
    assert partials(events(spark, []), RULE).count() == 0


def test_the_store_merges_deliveries_and_reads_only_open_periods(spark, tmp_path):
    r = random.Random(2)
    rows = [(r.choice(["a", "b", None]), r.choice([None, r.randrange(0, 60 * M)]), r.randrange(0, 110 * M), r.randrange(3), r.choice("xyz"), r.choice([None, 1.0, 2.0])) for _ in range(500)]
    store, edges = PeriodStore(str(tmp_path / "s"), RULE), [None, 30 * M, 55 * M, 110 * M]
    for _ in range(2):  # again under the same numbers: nothing changes
        for n, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            store.ingest(events(spark, [x for x in rows if (a is None or x[2] > a) and x[2] <= b]), n, b, a)
    got = store.periods(spark, 2)
    assert {(x["series_key"], x["period_us"]) for x in got.where("changed").collect()} == brute(rows)
    whole = corrected_periods(partials(events(spark, rows), RULE), RULE)
    cols = ("series_key", "period_us", "n_published", "n_corrected", "mean_published", "mean_corrected", "changed")
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, whole.select(*cols).collect()))
    assert {x["period_us"] for x in store._read(spark, 2, False).collect()} & {0, 10 * M} == set()  # closed before, not written again
    assert not got.where("open").count()


def test_presence_keeps_the_first_arrival(spark, tmp_path):
    rows = [("a", 0, 5 * M, 0, "x", None), ("a", 0, 13 * M, 0, "x", None), ("a", 0, 13 * M, 0, "y", None), ("b", 0, 5 * M, 0, "x", None), ("b", 0, 41 * M, 0, "y", None), ("c", 0, 39 * M, 0, "y", None)]
    store = PeriodStore(str(tmp_path / "s"), RULE, presence=True)
    store.ingest(events(spark, rows[:1]), 0, 10 * M)
    store.ingest(events(spark, rows[1:]), 1, 41 * M, 10 * M)
    got = {x["series_key"]: (x["n_published"], x["n_corrected"], x["changed"]) for x in store.periods(spark, 1).collect()}
    assert got == {"a": (1, 2, True), "b": (1, 1, False), "c": (0, 1, True)}
    store.ingest(events(spark, [("a", 0, 20 * M, 0, "late", None)]), 2, 50 * M, 41 * M)  # delivered after the period was closed
    assert {x["series_key"]: x["n_corrected"] for x in store.periods(spark, 2).collect()}["a"] == 2
    assert PeriodStore(str(tmp_path / "none"), RULE).periods(spark, 0) is None
