import os

import pytest
from pyspark.sql import functions as F

from braidlake.sources import lake
from tests.conftest import d, rows


def test_paths_and_reads(spark, tmp_path):
    lk = lake.Lake(str(tmp_path), {"history": "historyzone"})
    assert lk.resolve("history", "/a/b/", "Brazil") == f"{tmp_path}/historyzone/Brazil/a/b"
    spark.range(3).write.parquet(lk.resolve("history", "ids"))
    assert lk.read(spark, "history", "ids").count() == 3
    spark.range(3).createOrReplaceTempView("ids")
    assert lake.read_table(spark, "ids").count() == 3
    assert lake.read_sql(spark, "SELECT * FROM ids WHERE id > :x", x=1).count() == 1
    assert rows(lake.constants(spark, [(1, None), (2, "b")], "a int, b string")) == [(1, None), (2, "b")]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "p string, v int")
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    lake.commit(df, [lake.Sink(one), lake.Sink(two, partition_by=["p"])])
    assert spark.read.parquet(one).count() == 3
    assert sorted(x for x in os.listdir(two) if x.startswith("p=")) == ["p=a", "p=b"]
    three = str(tmp_path / "three")
    lake.commit_all(df, [(lambda x: x.groupBy("p").count(), lake.Sink(three))])
    assert rows(spark.read.parquet(three)) == [("a", 1), ("b", 2)]
    lake.write(df, lake.Sink(table="t_saved", mode="error"))
    try:
        assert spark.table("t_saved").count() == 3
        with pytest.raises(Exception, match="already exists"):
            lake.write(df, lake.Sink(table="t_saved", mode="error"))
    finally:
        spark.sql("DROP TABLE t_saved")
    with pytest.raises(ValueError):
        lake.write(df, lake.Sink())


def test_window_overwrite_and_delete(spark, tmp_path):
    path = str(tmp_path / "w")
    old = spark.createDataFrame([(d("2024-01-01"), 1), (d("2024-02-01"), 2)], "m date, v int")
    lake.write(old, lake.Sink(path, partition_by=["m"]))
    lake.overwrite_window(spark.createDataFrame([(d("2024-02-01"), 9)], "m date, v int"), path, ["m"])
    assert rows(spark.read.parquet(path), "v") == [(1,), (9,)]
    assert rows(lake.delete_window(spark, path, "m", d("2024-02-01")), "v") == [(1,)]


def test_replace_a_table_it_reads_from(spark, tmp_path):
    path = str(tmp_path / "r")
    spark.range(4).write.parquet(path)
    lake.replace_table(spark.read.parquet(path).filter("id > 1"), path)
    assert spark.read.parquet(path).count() == 2
    assert [x for x in os.listdir(tmp_path) if not x.startswith(".")] == ["r"]  # neither state is left beside it


def test_replace_keeps_the_table_when_the_new_state_fails(spark, tmp_path):
    path = str(tmp_path / "r")
    spark.range(4).write.parquet(path)
    broken = spark.read.parquet(path).withColumn("x", F.raise_error(F.lit("no")))
    with pytest.raises(Exception, match="no"):
        lake.replace_table(broken, path)
    assert spark.read.parquet(path).count() == 4


def test_a_staging_block_leaves_nothing(spark, tmp_path):
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root))
    with lake.staging():
        assert lake.stage(spark.range(5), "block").count() == 5
        assert set(os.listdir(root)) > before
    assert set(os.listdir(root)) == before
    lake.commit(spark.range(3), [lake.Sink(str(tmp_path / "a")), lake.Sink(str(tmp_path / "b"))])
    assert set(os.listdir(root)) == before


def test_stage_uses_the_shared_folder_and_is_dropped(spark):
    staged = lake.stage(spark.range(5), "five")
    root = spark.conf.get("spark.checkpoint.dir")
    assert staged.count() == 5 and any(x.startswith("five-") for x in os.listdir(root))
    assert lake.drop_staged(spark, "five") == 1


def test_catalog(spark):
    assert lake.use_catalog(spark, "spark_catalog") == "spark_catalog"
    with lake.cached(spark.range(3).withColumn("x", F.lit(1))) as kept:
        assert kept.is_cached and kept.count() == 3


def test_a_spine_broadcasts_none_of_its_inputs(spark):
    spine = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, name string")
    inputs = {n: spark.createDataFrame([(1, n), (None, n)], f"k int, {n} string") for n in ("x", "y", "z")}
    out = lake.join_spine(spine, inputs, ["k"], buckets=2)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in text and "Exchange" not in text and text.count("SortMergeJoin") == 3
    assert rows(out) == [(1, "a", "x", "y", "z"), (2, "b", None, None, None), (None, "c", None, None, None)]
