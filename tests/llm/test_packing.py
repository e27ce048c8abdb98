import random
from collections import defaultdict

import pytest

from fleetspan.llm.packing import mixture, pack_shelf, packed
from fleetspan.sources.lineage import materialised


def check(rows, capacity, sizes):
    space, pieces = defaultdict(int), defaultdict(list)
    for n, piece, first, tokens, container, _ in rows:
        space[container] += tokens
        pieces[n].append((piece, first, tokens))
    assert max(space.values(), default=0) <= capacity
    for n, size in enumerate(sizes):
        p = sorted(pieces[n])
        assert sum(x[2] for x in p) == size and [x[0] for x in p] == list(range(len(p)))
        assert all(x[1] == sum(y[2] for y in p[:i]) for i, x in enumerate(p))
        assert len(p) == 1 or size > capacity
    return space


def test_whole_items_and_little_waste():
    r = random.Random(1)
    items = [(r.choice("aab"), r.choice([0, r.randrange(1, 100), r.randrange(1, 3000), 100, 200])) for _ in range(3000)]
    share = {"a": 0.66, "b": 0.34}
    out = pack_shelf(items, share, {"a": 0.0, "b": 0.0}, 100, 20)
    space = check(out, 100, [t for _, t in items])
    total = sum(t for _, t in items)
    assert total / (100 * len(space)) > 0.97


def test_windows_follow_the_mixture():
    items = [("a", 10)] * 4000 + [("b", 10)] * 4000
    out = pack_shelf(items, {"a": 0.8, "b": 0.2}, {"a": 0.0, "b": 0.0}, 100, 20)
    by = defaultdict(lambda: defaultdict(int))
    for n, _, _, t, _, w in out:
        by[w][items[n][0]] += t
    full = [v["a"] / (v["a"] + v["b"]) for w, v in sorted(by.items())[:18]]
    assert all(abs(x - 0.8) < 0.02 for x in full)


def test_a_deficit_is_carried():
    items = [("a", 60)] * 20 + [("b", 60)] * 20
    out = pack_shelf(items, {"a": 0.5, "b": 0.5}, {"a": -100.0, "b": 100.0}, 100, 2)
    first = [items[n][0] for n, *_, w in out if w == min(o[5] for o in out)]
    assert first.count("b") > first.count("a")


def test_odd_queues():
    assert pack_shelf([], {}, {}, 100) == []
    check(pack_shelf([("a", 0), ("a", 0)], {"a": 0.0}, {"a": 0.0}, 100), 100, [0, 0])
    check(pack_shelf([("a", 1000), ("b", 1)], {"a": 1.0, "b": 0.0}, {"a": 0.0, "b": 0.0}, 100), 100, [1000, 1])
    check(pack_shelf([("a", 99)] * 10, {"a": 1e-6}, {"a": -500.0}, 100, 1), 100, [99] * 10)


@pytest.mark.parametrize("shelf_items", [50, 100_000])
def test_frames(spark, shelf_items):
    r = random.Random(2)
    rows = [(i, r.choice(["x", "y", None]), r.choice([None, 0, -1, *range(1, 700, 13), 5000])) for i in range(400)] + [(None, "x", 5), (None, None, 5), (7, "x", 5)]
    df = materialised(spark.createDataFrame([(*x, "c") for x in rows], "doc_id bigint, source string, tokens bigint, shelf string"))
    out = packed(df, shelf_items=shelf_items).collect()
    space = defaultdict(int)
    for x in out:
        space[x["container_id"]] += x["tokens"]
    assert max(space.values()) <= 2048
    assert sum(x["tokens"] for x in out) == sum(max(t or 0, 0) for _, _, t in rows)
    assert sorted((x["doc_id"] is None, x["doc_id"]) for x in out if x["piece"] == 0) == sorted((k is None, k) for k, _, _ in rows)
    assert {x["source"] for x in out} == {"x", "y", ""}
    assert packed(df.limit(0)).count() == 0


def test_a_target_mixture(spark):
    df = materialised(spark.createDataFrame([(i, "ab"[i % 2], 100) for i in range(3000)], "doc_id bigint, source string, tokens bigint"))
    out = packed(df, target={"a": 0.7, "b": 0.3}).toPandas()
    w = out[out.window_id == out.window_id.min()]
    assert abs(w[w.source == "a"].tokens.sum() / w.tokens.sum() - 0.7) < 0.02 and out.tokens.sum() == 300_000


def test_credits_equal_those_of_all_shelves_before(spark):
    r = random.Random(4)
    rows = [(i, r.choice("aaab") if i % 3 else "c", r.randrange(1, 900)) for i in range(3000)]
    df = materialised(spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint"))
    out = packed(df, shelf_items=300)
    total = sum(t for *_, t in rows)
    want = {s: sum(t for _, x, t in rows if x == s) / total for s in "abc"}
    m = mixture(out).toPandas()
    whole = m.groupby("source").tokens.sum() / m.tokens.sum()
    assert all(abs(whole[s] - want[s]) < 1e-9 for s in want)
    big = m[m.groupby("window_id").tokens.transform("sum") > 64 * 2048 * 0.8]
    assert (big.share - big.source.map(want)).abs().max() < 0.1
    assert (m.groupby("window_id").share.sum() - 1).abs().max() < 1e-9


def test_a_source_that_runs_out_shows_in_the_mixture(spark):
    df = materialised(spark.createDataFrame([(i, "a" if i % 10 else "b", 100) for i in range(9000)], "doc_id bigint, source string, tokens bigint"))
    m = mixture(packed(df, target={"a": 0.5, "b": 0.5})).toPandas().sort_values("window_id")
    first, last = m[m.window_id == m.window_id.min()], m[m.window_id == m.window_id.max()]
    assert abs(first[first.source == "b"].share.sum() - 0.5) < 0.05 and set(last.source) == {"a"}
