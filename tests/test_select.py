import random

import pytest
from pyspark.sql import functions as F

from braidlake.operators import select
from tests.conftest import d, rows

VERSIONS = [
    ("a", d("2024-01-02"), 1), ("a", d("2024-01-02"), 2), ("a", d("2024-01-01"), 3),
    ("b", None, 4), ("b", d("2023-05-05"), 5), (None, d("2024-02-01"), 6), ("c", None, 7),
]


@pytest.fixture()
def versions(spark):
    return spark.createDataFrame(VERSIONS, "k string, day date, id int")


def test_latest_one_survivor(versions):
    out = select.latest_by(versions, ["k"], [F.col("day").desc_nulls_last(), F.desc("id")])
    assert rows(out, "k", "id") == [("a", 2), ("b", 5), ("c", 7), (None, 6)]


def test_latest_keeps_ties(versions):
    out = select.latest_by(versions, ["k"], "day", ties="all")
    assert rows(out, "k", "id") == [("a", 1), ("a", 2), ("b", 5), ("c", 7), (None, 6)]


def test_latest_rejects_bad_ties(versions):
    with pytest.raises(ValueError):
        select.latest_by(versions, ["k"], [F.desc("day")], ties="all")


def test_best_then_latest(spark):
    df = spark.createDataFrame(
        [
            ("a", "1", d("2024-01-01"), 1), ("a", "1", d("2024-01-05"), 2),
            ("a", "0", None, 3), ("a", "0", None, 4), ("b", None, d("2024-01-01"), 5),
            (None, "0", d("2024-01-01"), 6), ("c", "2", None, 7), ("c", "2", d("2020-01-01"), 8),
        ],
        "k string, status string, ts date, id int",
    )
    assert rows(select.best_then_latest(df, ["k"], "status", "ts"), "id") == [(3,), (4,), (8,)]


def test_sliced_rank_equals_plain_rank(spark):
    rng = random.Random(3)
    data = [
        ("hot" if rng.random() < 0.5 else rng.choice("xyz"), rng.choice([None, *range(50)]), i)
        for i in range(600)
    ]
    df = spark.createDataFrame(data, "k string, v int, id int")
    order = [F.col("v").desc_nulls_last(), F.desc("id")]
    plain = select.rank_within(df, ["k"], order)
    cut = select.rank_within(df, ["k"], order, slices=[("s", F.floor(F.col("v") / 10), True)])
    assert rows(plain, "id", "row_number") == rows(cut, "id", "row_number")


def test_synthetic_key(spark):
    df = spark.createDataFrame(
        [(1, "A", "x"), (5, None, "y"), (3, None, "y"), (9, None, None)], "id int, k string, n string"
    )
    out = select.synthetic_key(df, "id", "k", ["n"], "S-")
    assert rows(out, "id", "k") == [(1, "A"), (3, "S-3"), (5, "S-3")]
    short = select.synthetic_key(df, "id", "k", ["n"], "S-", collapse=True)
    assert rows(short, "k", "n") == [("A", "x"), ("S-3", "y"), ("S-9", None)]


def test_prefer_direct(spark):
    direct = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2)], "k string, v int")
    indirect = spark.createDataFrame([("a", 9, 1), ("b", 8, 2), ("b", 7, 1)], "k string, v int, o int")
    out = select.prefer_direct(direct, indirect, ["k"], [F.asc("o")])
    assert rows(out) == [("a", 1), ("a", 2), ("b", 7)]


def test_unique(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    assert rows(select.duplicate_keys(df, ["k"])) == [("a", 2)]
    assert select.assert_unique(df, ["k", "v"]) is df
    with pytest.raises(ValueError, match="duplicate keys"):
        select.assert_unique(df, ["k"])
