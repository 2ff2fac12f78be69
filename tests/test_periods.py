import random

import pytest
from pyspark.sql import functions as F

from braidlake.functions.dates import add_months, cohort_age, month_range
from braidlake.operators import periods
from tests.conftest import d, rows


def test_month_arithmetic():
    assert add_months("2024-01-31", -1) == d("2023-12-01")
    assert [m.isoformat() for m in month_range("2023-11-05", "2024-01-01")] == [
        "2023-11-01", "2023-12-01", "2024-01-01",
    ]


def test_day_window_ends_on_the_fifth():
    (anchor, low, stop), = periods.day_windows([d("2024-02-01")])
    assert anchor == d("2024-02-01") and stop == d("2024-03-06") and (stop - low).days == 40


@pytest.fixture()
def events(spark):
    rng = random.Random(2)
    data = [
        (rng.choice(["g1", "g1", "g2"]), rng.choice([None, *range(12)]),
         d("2023-01-01").replace(month=rng.randrange(1, 13), day=rng.randrange(1, 28)),
         rng.randrange(100))
        for _ in range(400)
    ]
    return data, spark.createDataFrame(data, "g string, e int, day date, v int")


def test_trailing_metrics_equal_brute_force(events):
    data, df = events
    anchors = [d("2023-09-01"), d("2023-08-01")]
    out = periods.trailing_metrics(
        df, ["g"], "day", anchors, 3,
        measures={"total": ("sum", F.col("v")), "n": ("count", F.col("v"))},
        entity="e", entity_flags={"big": F.col("v") > 50, "now": F.col("in_month")},
    )
    want = []
    for a in anchors:
        for g in ("g1", "g2"):
            win = [r for r in data if r[0] == g and add_months(a, -2) <= r[2] < add_months(a, 1)]
            month = [r for r in win if r[2] >= a]
            want.append((
                a, g, len({r[1] for r in win if r[3] > 50} - {None}),
                len({r[1] for r in month} - {None}), sum(r[3] for r in win), len(win),
            ))
    assert rows(out, "anchor_month", "g", "big", "now", "total", "n") == sorted(want, key=str)


def test_dormant_first_and_cumulative_equal_brute_force(events):
    data, df = events
    anchors = [d("2023-10-01"), d("2023-06-01")]
    last, first = {}, {}
    for a in anchors:
        for g, e, day, _ in data:
            if e is not None and day < add_months(a, 1):
                last[a, g, e] = max(last.get((a, g, e), day), day)
                first[a, g, e] = min(first.get((a, g, e), day), day)

    def count(pairs):
        out = {}
        for a, g, _ in pairs:
            out[a, g] = out.get((a, g), 0) + 1
        return sorted([(*k, n) for k, n in out.items()], key=lambda r: tuple(map(str, r)))

    gone = periods.dormant_count(df.dropna(), ["g"], "e", "day", anchors)
    assert rows(gone) == count(
        k for k, v in last.items() if v.replace(day=1) == add_months(k[0], -3)
    )
    fresh = periods.first_event_cohort(df.dropna(), ["g"], "e", "day", anchors)
    assert rows(fresh) == count(k for k, v in first.items() if v.replace(day=1) == k[0])
    ever = periods.cumulative_distinct(df, ["g"], "e", "day", anchors)
    assert rows(ever) == count(first)


def test_trailing_max_takes_the_latest_peak(spark):
    df = spark.createDataFrame(
        [("a", d("2023-01-01"), 5), ("a", d("2023-02-01"), 9), ("a", d("2023-03-01"), 9),
         ("a", d("2022-01-01"), 99), ("b", d("2023-03-01"), None)],
        "k string, m date, v int",
    )
    out = periods.trailing_max(df, ["k"], "m", ["2023-03-01"], 12, ["v"], peaks=True)
    assert rows(out, "k", "max_v", "peak_v") == [("a", 9, d("2023-03-01")), ("b", None, None)]


def test_running_high(spark):
    df = spark.createDataFrame(
        [("a", d("2023-01-01"), 9), ("a", d("2023-03-01"), 4), ("a", d("2023-05-01"), 50)],
        "k string, m date, v int",
    )
    out = periods.running_high(df, ["k"], "m", ["2023-03-01", "2023-02-01"], "v")
    assert rows(out, "anchor_month", "high", "v") == [
        (d("2023-02-01"), 9, None), (d("2023-03-01"), 9, 4),
    ]


def test_cohort_age(spark):
    df = spark.createDataFrame(
        [(d("2024-03-01"), d("2024-03-20")), (d("2024-05-01"), d("2024-03-20")),
         (d("2024-02-01"), d("2024-03-20")), (d("2024-02-01"), None)],
        "m date, f date",
    )
    assert [r[0] for r in df.select(cohort_age("m", "f")).collect()] == [1, 3, 0, 0]


def test_stock_flow_balances(spark):
    df = spark.createDataFrame(
        [("a", d("2024-01-01"), 5, 2), ("a", d("2024-02-01"), 8, 1), ("a", d("2024-03-01"), None, 0)],
        "k string, m date, n int, new int",
    )
    out = periods.stock_flow(df, ["k"], "m", ["n"], new={"n": "new"})
    assert rows(out, "bop_n", "gain_n", "churn_n", "involuntary_n", "net_churn_n") == [
        (0, 5, 0, 3, 3), (5, 3, 0, 2, 2), (8, 0, -8, 0, -8),
    ]
    moved = out.select((F.col("gain_n") + F.col("churn_n")
                        - (F.coalesce("n", F.lit(0)) - F.col("bop_n"))).alias("x"))
    assert {r.x for r in moved.collect()} == {0}


def test_months_active_restarts_after_a_year(spark):
    cols = "k string, m date, fa date, f date, l date, sm date, s int"
    seed = d("2024-01-01")
    data = [
        ("steady", seed, d("2022-01-05"), d("2022-01-05"), d("2024-01-09"), seed, 7),
        ("steady", d("2024-02-01"), d("2022-01-05"), d("2022-01-05"), d("2024-02-09"), seed, 7),
        ("idle", seed, d("2020-01-05"), d("2020-01-05"), d("2022-12-09"), seed, 9),
        ("new", d("2024-02-01"), d("2024-02-03"), d("2024-02-03"), d("2024-02-03"), None, None),
        ("none", seed, None, None, None, None, None),
        ("back", seed, d("2020-01-05"), d("2020-01-05"), d("2023-03-01"), seed, 0),
        ("back", d("2024-02-01"), d("2020-01-05"), d("2020-01-05"), d("2024-02-02"), seed, 0),
    ]
    out = periods.months_active(
        spark.createDataFrame(data, cols), ["k"], "m", "fa", "f", "l", "sm", "s"
    )
    assert rows(out, "k", "m", "months_active") == [
        ("back", d("2024-01-01"), 0), ("back", d("2024-02-01"), 1), ("idle", d("2024-01-01"), 0),
        ("new", d("2024-02-01"), 1), ("none", d("2024-01-01"), 0), ("steady", d("2024-01-01"), 7),
        ("steady", d("2024-02-01"), 8),
    ]


def test_suppression_is_half_open_and_does_not_multiply(spark):
    months = [d(f"2024-0{i}-01") for i in range(1, 6)]
    df = spark.createDataFrame([("a", m, 10) for m in months], "k string, m date, v int")
    per = spark.createDataFrame(
        [("a", "x", d("2024-02-15"), d("2024-04-20")), ("a", "x", d("2024-03-01"), d("2024-04-01")),
         ("a", "y", d("2024-05-01"), d("2024-05-30"))],
        "k string, kind string, start_date date, end_date date",
    )
    out = periods.suppress_in_periods(df, per, "k", "m", ["x", "y"], ["v"])
    assert rows(out, "m", "v", "in_x", "in_y") == [
        (months[0], 10, 0, 0), (months[1], 0, 1, 0), (months[2], 0, 1, 0), (months[3], 10, 0, 0),
        (months[4], 10, 0, 0),
    ]


def test_first_snapshot_is_dated_a_month_back(spark):
    df = spark.createDataFrame(
        [("a", d("2024-03-05")), ("b", d("2024-03-05")), ("a", d("2024-03-09")), ("a", d("2024-04-02"))],
        "k string, day date",
    )
    out = periods.first_snapshot_of_month(df, "day")
    assert rows(out, "k", "ref_month") == [
        ("a", d("2024-02-01")), ("a", d("2024-03-01")), ("b", d("2024-02-01")),
    ]


def test_expand_effective(spark):
    df = spark.createDataFrame(
        [("a", d("2024-01-10"), "v1"), ("a", d("2024-03-03"), "v2"), ("a", d("2024-03-20"), "v3"),
         ("a", d("2024-09-01"), "late"), ("b", d("2024-04-30"), "w"), ("b", d("2024-04-30"), "w2")],
        "k string, start date, v string",
    )
    out = periods.expand_effective(df, ["k"], "start", "2024-04-15", first_month="2024-02-01")
    assert rows(out, "k", "month", "v") == [
        ("a", d("2024-02-01"), "v1"), ("a", d("2024-03-01"), "v3"), ("a", d("2024-04-01"), "v3"),
        ("b", d("2024-04-01"), "w"), ("b", d("2024-04-01"), "w2"),
    ]
