"""The partition-scoped merge: results, untouched files, and every point at which it can be cut off."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from braidlake.sources import lake, merge



def now():
    return F.lit("2000-06-15 12:00:00").cast("timestamp_ntz")


COLUMNS = "id int, name string, month string, amount int, row_hash string"


def frame(spark, data):
    return spark.createDataFrame(data, COLUMNS)


def table(spark, path, data):
    stamped = frame(spark, data).withColumns(
        {c: F.lit("2000-01-01 00:00:00").cast("timestamp_ntz") for c in ("inserted_at", "changed_at")}
    )
    lake.write(stamped, lake.Sink(path, partition_by=["month"]))


def state(spark, path, source):
    rows = merge.read_as(spark, path, source.schema, ["month"]).select(
        "id", "name", "month", "amount", "row_hash", F.month("inserted_at").alias("i"), F.month("changed_at").alias("c")
    )
    return sorted(tuple(r) for r in rows.collect())


def files(path):
    return {
        os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")
    }


def row(i, month, amount, name="n"):
    return (i, name, month, amount, f"h{amount}{month}{name}")


STORED = [row(i, f"2000-0{1 + i % 4}", i) for i in range(40)] + [row(90, "2000-05", 1), row(91, "a b/c:d%=é", 2)]
SOURCE = [
    row(1, "2000-02", 1),  # the same
    row(2, "2000-03", 200),  # changed
    row(3, "2000-03", 3),  # moves to another partition
    row(90, "2000-03", 1),  # the only row of its partition leaves
    row(91, "a b/c:d%=é", 20),
    row(100, "2000-03", 5),  # new
    row(101, "2000-09", 6),  # new, in a new partition
]


def expected(stored, source):
    out = {r[0]: (*r, 1, 1) for r in stored}
    for r in source:
        if r[0] not in out:
            out[r[0]] = (*r, 6, 6)
        elif out[r[0]][4] != r[4]:
            out[r[0]] = (*r, 1, 6)
    return sorted(out.values())


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, path, STORED)
    before = files(path)
    source = frame(spark, SOURCE)
    done = merge.merge_partitions(source, path, ["id"], ["month"], "row_hash", now())
    assert (done.inserted, done.updated) == (2, 4)
    assert state(spark, path, source) == expected(STORED, SOURCE)
    after = files(path)
    untouched = {f for f in before if f.startswith(("month=2000-01", "month=2000-02"))}
    assert untouched and untouched <= after
    assert not {f for f in before - untouched} & after
    assert sorted(f for f in os.listdir(path) if "=" not in f and not f.startswith((".", "_SUCCESS"))) == []
    assert not os.path.exists(f"{path}/month=2000-05")
    # the same source again changes nothing and writes nothing
    assert merge.merge_partitions(source, path, ["id"], ["month"], "row_hash", now()) == merge.Merged(0, 0, ())
    assert files(path) == after


def test_partition_key_prunes_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, path, STORED)
    source = frame(spark, [row(2, "2000-03", 7), row(3, "2000-03", 3)])
    # with the month in the key, document 3 of April is another row
    merge.merge_partitions(source, path, ["id", "month"], ["month"], "row_hash", now())
    got = state(spark, path, source)
    assert [r[:4] for r in got if r[0] == 3] == [(3, "n", "2000-03", 3), (3, "n", "2000-04", 3)]
    text = (
        merge.read_as(spark, path, source.schema, ["month"]).filter(merge._among(["month"], [("2000-03",)]))
        ._jdf.queryExecution().executedPlan().toString()
    )
    assert re.search(r"PartitionFilters: \[[^]]*month", text)


def test_rows_outside_the_scope_are_not_matched(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, path, STORED)
    source = frame(spark, [row(0, "2000-04", 70), row(7, "2000-04", 70)])
    merge.merge_partitions(source, path, ["id"], ["month"], "row_hash", now(), scope=F.col("month") >= "2000-03")
    got = state(spark, path, source)
    assert [r[2:4] for r in got if r[0] == 0] == [("2000-01", 0), ("2000-04", 70)]  # added beside the old one
    assert [r[2:] for r in got if r[0] == 7] == [("2000-04", 70, "h702000-04n", 1, 6)]


def test_first_load_and_null_values(spark, tmp_path):
    path = str(tmp_path / "t")
    source = frame(spark, [(1, None, None, 1, "a"), (None, "x", "2000-01", 2, None)])
    assert merge.merge_partitions(source, path, ["id"], ["month"], "row_hash", now()).inserted == 2
    again = frame(spark, [(1, None, "2000-02", 3, "b"), (None, "x", "2000-01", 9, "")])  # '' and NULL are the same
    assert merge.merge_partitions(again, path, ["id"], ["month"], "row_hash", now()).updated == 1
    rows = merge.read_as(spark, path, source.schema, ["month"]).select("id", "month", "amount").collect()
    assert {tuple(r) for r in rows} == {(1, "2000-02", 3), (None, "2000-01", 2)}


@pytest.mark.parametrize("two", [False, True])
def test_a_merge_cut_off_anywhere_leaves_old_or_new(spark, tmp_path, monkeypatch, two):
    source = frame(spark, SOURCE)
    old, new = expected(STORED, []), expected(STORED, SOURCE)
    seen, real = set(), merge._rename
    for stop in (1, 4, 6) if two else range(12):
        path = str(tmp_path / f"t{stop}")
        table(spark, path, STORED)
        calls = []

        def rename(fs, a, b, calls=calls, stop=stop):
            if len(calls) == stop:
                raise OSError("cut off")
            calls.append(b)
            real(fs, a, b)

        monkeypatch.setattr(merge, "_rename", rename)
        try:
            merge.merge_partitions(source, path, ["id"], ["month"], "row_hash", now())
            cut = False
        except OSError:
            cut = True
        if two and cut:  # the recovery is cut off as well
            left = [None]

            def once(fs, a, b, left=left):
                if not left:
                    raise OSError("cut off again")
                left.pop()
                real(fs, a, b)

            monkeypatch.setattr(merge, "_rename", once)
            try:
                merge.recover(spark, path)
            except OSError:
                pass
        monkeypatch.setattr(merge, "_rename", real)
        found = merge.recover(spark, path)
        assert state(spark, path, source) == (old if stop == 0 else new), stop
        if not two:
            assert found == ("nothing" if not cut else "undone" if stop == 0 else "finished")
        assert not [n for n in os.listdir(path) if n.startswith("_merge")]
        seen.add(cut)
        if not cut:
            break
    assert seen == ({True} if two else {True, False})


def test_random_merges_equal_a_plain_upsert(spark, tmp_path):
    rng = random.Random(3)
    path, held = str(tmp_path / "t"), {}
    for step in range(4):
        data = {i: row(i, f"2000-0{rng.randint(1, 4)}", rng.randint(0, 3)) for i in rng.sample(range(40), 15)}
        source = frame(spark, list(data.values()))
        merge.merge_partitions(source, path, ["id"], ["month"], "row_hash", now(), inserted=None, changed=None)
        held |= {i: r for i, r in data.items()}
        got = merge.read_as(spark, path, source.schema, ["month"]).select(*COLUMNS.replace(",", "").split()[::2])
        assert sorted(tuple(r) for r in got.collect()) == sorted(held.values()), step


def test_replacing_a_window_of_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, path, STORED)
    stored = merge.read_as(spark, path, frame(spark, []).schema, ["month"])
    before = files(path)
    fresh = stored.filter("id < 6").withColumns({"month": F.lit("2000-03"), "amount": F.lit(0)})
    done = merge.replace_partitions(fresh, path, ["month"], F.col("month") >= "2000-03")
    assert done == ("month=2000-03", "month=2000-04", "month=2000-05", "month=a b%2Fc%3Ad%25%3Dé")
    rows = merge.read_as(spark, path, stored.schema, ["month"]).groupBy("month").count().collect()
    assert {r["month"]: r["count"] for r in rows} == {"2000-01": 10, "2000-02": 10, "2000-03": 6}
    assert {f for f in before if f.startswith(("month=2000-01", "month=2000-02"))} <= files(path)
    with pytest.raises(ValueError, match="outside the scope"):
        merge.replace_partitions(merge.read_as(spark, path, stored.schema, ["month"]), path, ["month"], F.col("month") >= "2000-03")
    assert merge.recover(spark, path) == "nothing"


def test_a_merge_shuffles_and_stages_no_row_that_it_need_not(spark, tmp_path, monkeypatch):
    sinks, paths = [], []
    put, commit = lake.write, merge._commit
    monkeypatch.setattr(lake, "write", lambda df, sink: (sinks.append(sink), put(df, sink)))
    monkeypatch.setattr(merge, "_commit", lambda spark, path, work, *a: (paths.extend(os.listdir(work)), commit(spark, path, work, *a))[1])
    path = str(tmp_path / "t")
    columns = "id int, part int, row_hash string"
    for data in ([(1, 1, "a"), (2, 1, "b"), (3, 2, "c")], [(1, 2, "x"), (2, 1, "b"), (4, 3, "n")]):
        merge.merge_partitions(spark.createDataFrame(data, columns), path, ["id"], ["part"], "row_hash", F.lit("now"))
    # A key may lie in any partition, so the source is read once only and its changed rows alone are staged.
    assert "changes" in paths and "source" not in paths
    assert sinks[-1].path.endswith("/new") and not sinks[-1].spread  # three partitions
    stored = spark.read.parquet(path).select("id", "part", "row_hash")
    assert sorted(map(tuple, stored.collect())) == [(1, 2, "x"), (2, 1, "b"), (3, 2, "c"), (4, 3, "n")]
