import datetime as dt
import random

from pyspark.sql import functions as F

from braidlake.operators import asof
from tests.conftest import d, rows

BASE = dt.datetime(2024, 1, 1)


def random_sides(n_left=250, n_right=250, seed=11):
    rng = random.Random(seed)

    def key():
        return None if rng.random() < 0.05 else ("hot" if rng.random() < 0.4 else rng.choice("abc"))

    def ts():
        return None if rng.random() < 0.05 else BASE + dt.timedelta(hours=rng.randrange(0, 24 * 9))

    left = [(i, key(), ts()) for i in range(n_left)]
    right = [(key(), ts(), i, f"p{i}") for i in range(n_right)]
    return left, right


def brute(left, right, strict):
    out = []
    for i, k, t in left:
        fits = [
            r for r in right
            if k is not None and t is not None and r[0] == k and r[1] is not None
            and (r[1] < t if strict else r[1] <= t)
        ]
        out.append((i, max(fits, key=lambda r: (r[1], r[2]))[3] if fits else None))
    return sorted(out, key=lambda r: str(r[0]))


def test_asof_equals_brute_force(spark):
    left, right = random_sides()
    l_df = spark.createDataFrame(left, "id int, k string, ts timestamp_ntz")
    r_df = spark.createDataFrame(right, "k string, ts timestamp_ntz, seq int, p string")
    for strict in (False, True):
        out = asof.asof_latest(l_df, r_df, ["k"], "ts", "ts", ["p"], ["seq"], strict=strict)
        assert rows(out, "id", "p") == brute(left, right, strict)


def test_one_key_on_one_day_is_spread_over_tasks(spark):
    left = spark.range(4000).selectExpr(
        "id", "'hot' AS k", "timestamp_seconds(1704067200 + (id * 7919) % 86400) AS ts"
    )
    right = left.selectExpr("k", "ts", "id AS p").filter("p % 3 = 0")
    conf = {
        "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "24",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = asof.asof_latest(left, right, ["k"], "ts", "ts", ["p"])
        per_task = out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("count"), F.max("p")).collect()
        assert sum(r["count"] for r in per_task) == 4000
        assert len(per_task) > 8 and max(r["count"] for r in per_task) < 1000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_rows_without_key_or_time_bypass_the_lookup(spark):
    left = spark.createDataFrame([(1, None, BASE), (2, "a", None), (3, "a", BASE)], "id int, k string, ts timestamp_ntz")
    right = spark.createDataFrame([("a", BASE, "p"), (None, BASE, "q")], "k string, ts timestamp_ntz, p string")
    out = asof.asof_latest(left, right, ["k"], "ts", "ts", ["p"])
    assert rows(out, "id", "p") == [(1, None), (2, None), (3, "p")]


def test_status_at_equals_brute_force(spark):
    rng = random.Random(5)
    data = [
        (i, rng.choice(["o1", "o2", "hot", "hot"]), BASE + dt.timedelta(hours=rng.randrange(200)),
         None if rng.random() < 0.1 else BASE + dt.timedelta(hours=rng.randrange(200)))
        for i in range(150)
    ]
    df = spark.createDataFrame(data, "id int, k string, created timestamp_ntz, closing timestamp_ntz")
    versions = df.selectExpr("k", "created", "created AS version")
    out = asof.status_at(df, versions, ["k"], "created", "closing", ["version"])
    want = []
    for i, k, c, e in data:
        fits = [x[2] for x in data if e is not None and x[1] == k and c <= x[2] <= e]
        want.append((i, max(fits) if fits else None))
    assert rows(out, "id", "version") == sorted(want, key=lambda r: str(r[0]))


def test_freeze_is_strict_and_drops_undated(spark):
    data = [
        ("o", d("2024-01-01"), d("2024-01-10"), 1), ("o", d("2024-01-09"), d("2024-01-10"), 2),
        ("o", d("2024-01-10"), d("2024-01-10"), 3), ("o", d("2024-01-12"), None, 4),
        ("p", d("2024-01-20"), d("2024-01-10"), 5),
    ]
    df = spark.createDataFrame(data, "k string, created date, freeze date, id int")
    assert rows(asof.freeze_snapshot(df, ["k"], "created", "freeze"), "id") == [(2,)]


def test_rollout_split_includes_the_day_and_does_not_multiply(spark):
    df = spark.createDataFrame(
        [(1, 7, d("2024-05-01"), "old"), (2, 7, d("2024-04-30"), "old"), (3, 7, d("2024-05-01"), "new"),
         (4, 8, d("2024-05-01"), "old"), (5, 8, d("2024-05-01"), "new"), (6, None, d("2024-05-01"), "old")],
        "id int, unit int, start date, origin string",
    )
    rollout = spark.createDataFrame(
        [(7, d("2024-05-01")), (7, d("2024-01-01").replace(month=5, day=1)), (7, d("2024-09-01"))],
        "unit int, day date",
    )
    out = asof.rollout_split(df, rollout, "unit", "start", "day", "origin", "old", "new")
    assert rows(out, "id") == [(2,), (3,), (4,), (6,)]


def test_append_history(spark):
    main = spark.createDataFrame([(1, "x")], "id int, a string")
    old = spark.createDataFrame([(1, "p"), (2, "q")], "id int, b string")
    assert rows(asof.append_history(main, old, ["id"])) == [(1, "x", None), (2, None, "q")]
    assert asof.append_history(main, old, ["id"], keep_repeats=True).count() == 3
