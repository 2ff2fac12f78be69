import datetime as dt

import pytest
from pyspark.sql import functions as F

from braidlake.functions.keys import fingerprint
from braidlake.operators import upsert
from tests.conftest import rows

OLD, NOW = dt.datetime(2024, 1, 1), dt.datetime(2024, 3, 1)
EDGE = dt.datetime(2024, 2, 29)


def hashed(df):
    return df.withColumn("row_hash", fingerprint(["k", "seg", "note"]))


@pytest.fixture()
def source(spark):
    return hashed(
        spark.createDataFrame(
            [("same", "A", "n"), ("moved", "B", "n"), ("noted", "A", "new"), ("fresh", "A", "n"),
             ("nulled", None, "n")],
            "k string, seg string, note string",
        )
    )


@pytest.fixture()
def target(spark):
    df = spark.createDataFrame(
        [
            (1, "same", "A", "n", 1), (2, "moved", "A", "n", 1), (2, "moved", "Z", "n", 0),
            (3, "noted", "A", "n", 1), (4, "gone", "A", "n", 1), (5, "nulled", "A", "n", 1),
        ],
        "sk long, k string, seg string, note string, is_active int",
    )
    stamp = F.lit(OLD).cast("timestamp_ntz")
    return hashed(df).withColumns(
        {"valid_from": stamp, "valid_to": F.lit(None).cast("timestamp_ntz"), "inserted_at": stamp,
         "changed_at": stamp}
    )


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def test_scd1_updates_inserts_and_is_idempotent(source, target):
    stored = target.filter("is_active = 1").drop("sk", "is_active", "valid_from", "valid_to")
    once = upsert.upsert_scd1(stored, source, ["k"], "row_hash", now())
    assert rows(once, "k", "seg", "note", "inserted_at", "changed_at") == [
        ("fresh", "A", "n", NOW, NOW), ("gone", "A", "n", OLD, OLD), ("moved", "B", "n", OLD, NOW),
        ("noted", "A", "new", OLD, NOW), ("nulled", None, "n", OLD, NOW),
        ("same", "A", "n", OLD, OLD),
    ]
    later = F.lit(dt.datetime(2025, 1, 1)).cast("timestamp_ntz")
    assert rows(upsert.upsert_scd1(once, source, ["k"], "row_hash", later)) == rows(once)


def test_scd1_scope_leaves_other_rows_alone(source, target):
    stored = target.filter("is_active = 1").drop("sk", "is_active", "valid_from", "valid_to")
    out = upsert.upsert_scd1(
        stored, source.filter("k = 'moved'"), ["k"], "row_hash", now(), scope=F.col("k") == "moved"
    )
    assert dict(rows(out, "k", "seg"))["moved"] == "B" and out.count() == 5


def test_classify_and_expand(source, target):
    changes = upsert.classify_changes(
        source, target.filter("is_active = 1"), ["k"], ["seg"], "row_hash"
    )
    assert rows(changes, "k", "action") == [
        ("fresh", "insert"), ("moved", "version"), ("noted", "update"), ("nulled", "version"),
    ]
    assert rows(upsert.expand_actions(changes).filter("action = 'close'"), "k") == [
        ("moved",), ("nulled",)
    ]


def test_scd2(source, target):
    out = upsert.upsert_scd2(target, source, ["k"], ["seg"], "row_hash", now())
    got = rows(out, "k", "seg", "note", "is_active", "valid_from", "valid_to")
    assert got == [
        ("fresh", "A", "n", 1, EDGE, None), ("gone", "A", "n", 1, OLD, None),
        ("moved", "A", "n", 0, OLD, EDGE), ("moved", "B", "n", 1, EDGE, None),
        ("moved", "Z", "n", 0, OLD, None), ("noted", "A", "new", 1, OLD, None),
        ("nulled", "A", "n", 0, OLD, EDGE), ("nulled", None, "n", 1, EDGE, None),
        ("same", "A", "n", 1, OLD, None),
    ]
    keys = {(r.k, r.sk) for r in out.collect()}
    assert {("moved", 2), ("nulled", 5), ("same", 1)} <= keys
    fresh = [sk for k, sk in keys if k == "fresh"]
    assert len(fresh) == 1 and fresh[0] > 5


def test_scd2_twice_changes_nothing_and_one_active_row_per_key(source, target):
    once = upsert.upsert_scd2(target, source, ["k"], ["seg"], "row_hash", now())
    later = F.lit(dt.datetime(2025, 1, 1)).cast("timestamp_ntz")
    twice = upsert.upsert_scd2(once, source, ["k"], ["seg"], "row_hash", later)
    assert rows(twice) == rows(once)
    assert once.filter("is_active = 1").groupBy("k").count().filter("count > 1").count() == 0


def test_allocated_keys_are_unique(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    out = upsert.allocate_keys(df, ["k"], F.lit(100), "sk", buckets=16)
    agg = out.agg(F.count_distinct("sk"), F.min("sk")).first()
    assert agg[0] == 5000 and agg[1] > 100


def test_reload_window(spark):
    cols = "k string, day date"
    old = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("b", dt.date(2024, 2, 1)), ("n", None)], cols)
    new = spark.createDataFrame([("c", dt.date(2024, 2, 2)), ("x", dt.date(2024, 1, 9))], cols)
    out = upsert.reload_window(old, new, "day", dt.date(2024, 2, 1))
    assert rows(out, "k") == [("a",), ("c",), ("n",)]


def test_reconcile_matches_null_keys(spark):
    s = spark.createDataFrame([("a", None, 1), ("b", "x", 2)], "k string, j string, v int")
    t = spark.createDataFrame([("a", None, 9), ("c", None, 3)], "k string, j string, v int")
    assert rows(upsert.reconcile(s, t, ["k", "j"])) == [
        ("a", None, 1, "active"), ("b", "x", 2, "new"), ("c", None, 3, "inactive"),
    ]
