"""Two histories in force, runs with restart and bitmap counts, against day-by-day Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from braidlake.functions.dates import add_months, month_of, month_start
from braidlake.operators import bitmaps, intervals, periods
from tests.conftest import d, rows

DAY = dt.timedelta(days=1)
ORIGIN = d("2020-01-01")


def random_history(rng, keys, values, n):
    out = []
    for _ in range(n):
        start = ORIGIN + DAY * rng.randrange(60)
        end = None if rng.random() < 0.3 else start + DAY * rng.randrange(-2, 25)
        out.append((rng.choice(keys), None if rng.random() < 0.05 else start, end, rng.choice(values)))
    return out


def in_force(history, key, day):
    """The newest start that counts; of those on one day the later end, then the larger value."""
    begun = [h for h in history if h[0] == key and h[1] and h[1] <= day and (h[2] is None or h[2] > h[1])]
    if not begun:
        return None
    best = max(begun, key=lambda h: (h[1], h[2] or d("9999-01-01"), h[3]))
    return best[3] if best[2] is None or day < best[2] else None


def by_day(left, right, keys, how):
    last, out = ORIGIN + DAY * 120, []
    for key in keys:
        at, state = None, (None, None)
        for i in range(121):
            day = ORIGIN + DAY * i
            now = (in_force(left, key, day), in_force(right, key, day))
            if now != state:
                out.append((key, at, day, *state))
                at, state = day, now
        out.append((key, at, None, *state))
        assert day == last
    wanted = {
        "inner": lambda a, b: a is not None and b is not None,
        "left": lambda a, b: a is not None,
        "full": lambda a, b: a is not None or b is not None,
    }[how]
    return sorted((r for r in out if wanted(*r[3:])), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("how", ["inner", "left", "full"])
@pytest.mark.parametrize("slice_by", ["year", "week"])
def test_histories_equal_a_walk_over_days(spark, how, slice_by):
    for seed in range(3):
        rng = random.Random(seed)
        keys = ["a", "b", None, "only left", "only right"]
        left = random_history(rng, keys[:4], ["x", "y", "z"], 40)
        right = random_history(rng, [*keys[:3], keys[4]], ["1", "2"], 40)
        frames = [
            spark.createDataFrame(h, f"k string, valid_from date, valid_to date, {v} string") for h, v in ((left, "l"), (right, "r"))
        ]
        out = intervals.intersect_histories(*frames, ["k"], how=how, slice_by=slice_by)
        assert out.columns == ["k", "valid_from", "valid_to", "l", "r"]
        assert rows(out) == by_day(left, right, keys, how), (seed, how)


def test_histories_are_not_joined_by_range(spark):
    one = spark.createDataFrame([("a", d("2020-01-01"), None, "x")], "k string, valid_from date, valid_to date, l string")
    two = spark.createDataFrame([("a", d("2020-02-01"), None, "y")], "k string, valid_from date, valid_to date, r string")
    text = intervals.intersect_histories(one, two, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert intervals.intersect_histories(one.limit(0), two, ["k"], how="full").count() == 1


def test_months_in_force_take_the_last_day(spark):
    spans = spark.createDataFrame(
        [("a", d("2020-01-31"), d("2020-02-29"), 1), ("a", d("2020-02-29"), None, 2), ("b", d("2020-01-05"), d("2020-01-31"), 3)],
        "k string, valid_from date, valid_to date, v int",
    )
    out = intervals.months_in_force(spans, "2020-04-01", "2020-02-01")
    assert rows(out, "k", "month", "v") == [("a", d(f"2020-0{m}-01"), 2) for m in (2, 3, 4)]
    assert rows(intervals.months_in_force(spans, "2020-01-15"), "k", "v") == [("a", 1)]


def apart(later, earlier):
    """Whole months between the first of a month and a date, as the engine truncates them."""
    n = (later.year - earlier.year) * 12 + later.month - earlier.month
    return n - (1 if earlier.day > 1 and n > 0 else 0)


def runs_by_hand(events, run, limit):
    out = []
    for key in {k for k, _ in events}:
        dates = sorted(x for k, x in events if k == key and x < add_months(run, 1))
        if not dates:
            continue
        month, start, last = month_of(dates[0]), None, None
        while month <= run:
            here = [x for x in dates if month_of(x) == month]
            if here:
                if last is None or apart(month, last) >= limit:
                    start = month
                last = here[-1]
            idle = apart(month, last)
            out.append((key, month, 0 if idle >= limit else apart(month, start) + 1))
            month = add_months(month, 1)
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_runs_restart_over_the_whole_history(spark):
    rng = random.Random(4)
    run = d("2025-06-01")
    events = [(rng.choice(["a", "b", "c", None]), d("2018-01-01") + DAY * rng.randrange(2700)) for _ in range(60)]
    events += [("late", d("2025-07-02")), ("edge", d("2020-01-01")), ("edge", d("2021-01-01")), ("day", d("2020-01-02")), ("day", d("2021-01-01"))]
    df = spark.createDataFrame(events, "k string, on date")
    for limit in (12, 3):
        out = intervals.activity_runs(df, ["k"], "on", run, limit)
        assert rows(out) == runs_by_hand(events, run, limit)
    some = intervals.activity_runs(df, ["k"], "on", run, 12, first_month="2024-01-01")
    assert rows(some) == [r for r in runs_by_hand(events, run, 12) if r[1] >= d("2024-01-01")]


def test_runs_equal_the_seeded_counter_where_both_apply(spark):
    """With the run counter of a snapshot as its seed, the seeded form gives the same next months."""
    rng = random.Random(6)
    run, seed_month = d("2024-06-01"), d("2024-04-01")
    events = [(f"k{rng.randrange(40)}", d("2021-01-01") + DAY * rng.randrange(1270)) for _ in range(400)]
    df = spark.createDataFrame(events, "k string, on date").filter(F.col("on") < "2024-07-01")
    counted = intervals.activity_runs(df, ["k"], "on", run, first_month=seed_month).cache()
    anchors = [add_months(run, -2), add_months(run, -1), run]
    known = {m: F.max(F.when(F.col("on") < F.lit(add_months(m, 1)), F.col("on"))) for m in anchors}
    state = df.groupBy("k").agg(F.min("on").alias("first"), *[v.alias(f"l{m:%m}") for m, v in known.items()])
    seeds = counted.filter(F.col("month") == F.lit(seed_month)).select("k", F.col("months_active").alias("seed"), F.col("month").alias("seed_month"))
    wide = state.join(seeds, "k", "inner").select(
        "k", "first", "seed", "seed_month",
        F.inline(F.array(*[F.struct(F.lit(m).alias("month"), F.col(f"l{m:%m}").alias("last")) for m in anchors])),
    )
    seeded = periods.months_active(wide, ["k"], "month", "first", "first", "last", "seed_month", "seed", floor="2000-01-01")
    both = seeded.join(counted.withColumnRenamed("months_active", "own"), ["k", "month"])
    pairs = rows(both, "k", "month", "months_active", "own")
    assert len(pairs) > 60 and all(a == b for _, _, a, b in pairs)
    assert {b for *_, b in pairs} >= {0, 1}


def test_bitmap_counts_are_exact(spark):
    rng = random.Random(2)
    data = [
        (rng.choice(["a", "b", None]), add_months("2024-01-01", rng.randrange(14)), rng.choice([None, rng.randrange(-5, 100_000), 7]))
        for _ in range(3000)
    ]
    df = spark.createDataFrame(data, "k string, month date, id long")
    parts = bitmaps.partials(df, ["k", "month"], "id")
    anchors = [d("2025-02-01"), d("2024-12-01")]
    out = bitmaps.windows(parts, ["k"], "month", anchors, {"n_3": 3, "n_all": None})
    want = []
    for a in anchors:
        for k in ("a", "b", None):
            seen = [(m, i) for kk, m, i in data if kk == k and i is not None and m <= a]
            want.append((a, k, len({i for m, i in seen if m >= add_months(a, -2)}), len({i for _, i in seen})))
    assert rows(out, "anchor_month", "k", "n_3", "n_all") == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))
    assert rows(bitmaps.merged(parts, ["k"], "n")) == rows(df.groupBy("k").agg(F.count_distinct("id").alias("n")))
    even = F.col("id") % 2 == 0
    mine = bitmaps.grouped(df, ["k"], "id", {"n": F.lit(True), "n_even": even}, {"rows": ("count", F.lit(1)), "top": ("max", F.col("id"))})
    plain = df.groupBy("k").agg(F.count_distinct("id").alias("n"), F.count_distinct(F.when(even, F.col("id"))).alias("n_even"), F.count(F.lit(1)).alias("rows"), F.max("id").alias("top"))
    assert rows(mine) == rows(plain)
    text = mine._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in text


def test_dense_ids_number_any_column(spark):
    df = spark.createDataFrame([("x",), ("y",), ("x",), (None,)], "who string")
    ids = bitmaps.dense_ids(df, "who")
    assert ids.count() == 2 and ids.select("entity_no").distinct().count() == 2
    counted = bitmaps.merged(bitmaps.partials(df.join(ids, "who"), [F.lit(1).alias("g")], "entity_no"), ["g"], "n")
    assert rows(counted) == [(1, 2)]


def test_month_start_is_shared(spark):
    assert spark.range(1).select(month_start(F.lit(d("2020-02-29"))).alias("m")).first()["m"] == d("2020-02-01")
