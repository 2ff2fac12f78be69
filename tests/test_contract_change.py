"""Comparison and migration of contracts, control totals, buckets and rule attribution."""

import os
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from braidlake.operators import contract, kpi
from braidlake.operators.contract import Change, Contract, Field
from braidlake.plans import contracts
from braidlake.sources import lake
from tests.conftest import rows


def one(fields, **more):
    return Contract("change_test.t", fields, **more)


BASE = [Field("id", "int", True, "Number"), Field("v", "decimal(10,2)"), Field("day", "date")]


@pytest.mark.parametrize(
    ("a", "b", "wide"),
    [
        ("int", "bigint", True), ("bigint", "int", False), ("int", "double", True), ("bigint", "double", False),
        ("decimal(10,2)", "decimal(12,4)", True), ("decimal(10,2)", "decimal(10,4)", False), ("int", "decimal(10,0)", True),
        ("int", "decimal(9,0)", False), ("date", "timestamp_ntz", True), ("timestamp_ntz", "date", False),
        ("float", "double", True), ("double", "float", False), ("date", "string", True), ("string", "int", False),
        ("smallint", "float", True), ("int", "float", False),
    ],
)
def test_types_that_hold_every_value_are_wider(spark, a, b, wide):
    assert contract.widens(a, b) is wide


def test_differences_of_two_contracts(spark):
    new = one(
        [Field("id", "bigint", True, "Key"), Field("v", "decimal(8,2)"), Field("extra", "string"), Field("must", "int", True)],
        comment="T", partition_by=["id"], properties={"k": "1"},
    )
    found = contract.compare(one(BASE), new)
    assert set(found) == {
        Change("drop", "day", "date"), Change("widen", "id", "int", "bigint"), Change("comment", "id", "Number", "Key"),
        Change("narrow", "v", "decimal(10,2)", "decimal(8,2)"), Change("add", "extra", "", "string"), Change("add", "must", "", "int"),
        Change("tighten", "must", "absent", "required"), Change("partition", "", "", "id"), Change("comment", "", "", "T"),
        Change("property", "k", "", "1"),
    }
    assert {c.kind for c in found if c.breaks} == {"drop", "narrow", "tighten", "partition"}
    assert contract.compare(one(BASE), one(BASE)) == []


@pytest.fixture
def table(spark):
    before = one(BASE, comment="Old", properties={"tier": "silver"})
    contract.create(spark, before)
    spark.createDataFrame([(1, "1.50", "2024-01-01"), (2, None, "2024-01-02")], "id int, v string, day string").select(
        "id", F.col("v").cast("decimal(10,2)"), F.col("day").cast("date")
    ).write.insertInto(before.name)
    yield before
    spark.sql("DROP SCHEMA change_test CASCADE")


def described(spark):
    return {r["col_name"]: (r["data_type"], r["comment"]) for r in spark.sql("DESCRIBE TABLE change_test.t").collect()}


def test_migration_keeps_rows_and_tells_the_catalog(spark, table):
    assert described(spark)["id"] == ("int", "Number")
    v2 = one([*BASE[:1], Field("v", "decimal(10,2)", comment="It's money"), BASE[2], Field("w", "string", comment="New")], comment="New", properties={"tier": "gold"})
    done = contract.migrate(spark, table, v2)
    assert {c.kind for c in done} == {"add", "comment", "property"}
    assert described(spark)["v"] == ("decimal(10,2)", "It's money") and described(spark)["w"] == ("string", "New")
    told = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES change_test.t").collect()}
    assert told["tier"] == "gold"
    v3 = one([Field("id", "bigint", True, "Number"), Field("v", "decimal(14,4)", comment="It's money"), *v2.fields[2:]], comment="New", properties={"tier": "gold"}, partition_by=["day"])
    with pytest.raises(contract.Refused, match="partition"):
        contract.migrate(spark, v2, v3)
    contract.migrate(spark, v2, v3, allow=["partition"])
    assert described(spark)["v"][0] == "decimal(14,4)" and described(spark)["id"] == ("bigint", "Number")
    assert rows(spark.table("change_test.t"), "id", "v", "w") == [(1, D("1.5000"), None), (2, None, None)]
    assert [r["tableName"] for r in spark.sql("SHOW TABLES IN change_test").collect() if not r["isTemporary"]] == ["t"]


def test_what_would_lose_data_is_refused(spark, table):
    for fields, kinds in (
        (BASE[:2], ["drop"]),
        ([BASE[0], Field("v", "decimal(3,2)"), BASE[2]], ["narrow"]),
        ([BASE[0], Field("v", "decimal(10,2)", True), BASE[2]], ["tighten"]),
    ):
        new = one(fields, comment="Old", properties={"tier": "silver"})
        with pytest.raises(contract.Refused):
            contract.migrate(spark, table, new)
        if kinds == ["tighten"]:  # allowed, but a stored row has no value
            with pytest.raises(contract.Refused, match="1 rows break required of v"):
                contract.migrate(spark, table, new, allow=kinds)
    assert rows(spark.table(table.name), "id") == [(1,), (2,)]
    contract.migrate(spark, table, one(BASE[:2], comment="Old", properties={"tier": "silver"}), allow=["drop"])
    assert spark.table(table.name).columns == ["id", "v"]


def test_governed_tables_carry_comments(spark):
    for c in (contracts.CUSTOMERS, contracts.TRANSACTIONS, contracts.DAILY_REVENUE):
        assert c.comment and all(f.comment for f in c.fields)
        contract.create(spark, c)
        told = {r["col_name"]: r["comment"] for r in spark.sql(f"DESCRIBE TABLE {c.name}").collect()}
        assert all(told[f.name] == f.comment for f in c.fields)
    for schema in ("silver_generic", "gold_generic"):
        spark.sql(f"DROP SCHEMA {schema} CASCADE")


# ---- control totals --------------------------------------------------------------------------
def test_totals_taken_while_writing(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).selectExpr("id", "id % 7 AS part", "CAST(id AS decimal(18,2)) AS v").repartition(4)
    totals = {"n": F.count(F.lit(1)), "v": F.sum("v"), "ids": F.bit_xor(F.xxhash64("id"))}
    taken = lake.write_checked(df, lake.Sink(path, partition_by=["part"]), totals)
    assert taken["n"] == 1000 and taken["v"] == D("499500.00")
    lake.verify(spark, lake.Sink(path), totals, taken)
    folder = os.path.join(path, "part=3")
    lost = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
    os.rename(os.path.join(folder, lost), str(tmp_path / "gone"))
    spark.catalog.refreshByPath(path)
    with pytest.raises(lake.TotalsDiffer, match="n: wrote 1000, read 857"):
        lake.verify(spark, lake.Sink(path), totals, taken)


# ---- buckets ---------------------------------------------------------------------------------
def test_chain_on_a_spine_has_no_exchange(spark):
    spine = spark.range(50).withColumnRenamed("id", "k")
    inputs = {f"i{n}": spark.range(200).selectExpr("id % 40 AS k", "id AS v").groupBy("k").agg(F.sum("v").alias(f"v{n}")) for n in range(5)}
    conf = "spark.sql.autoBroadcastJoinThreshold"
    held = spark.conf.get(conf)
    spark.conf.set(conf, "-1")
    try:
        out = lake.join_spine(spine, inputs, ["k"], 3)
        text = out._jdf.queryExecution().executedPlan().toString()
        assert text.count("SortMergeJoin") == 5 and "Exchange" not in text
        assert out.count() == 50 and out.filter("v4 IS NULL").count() == 10
    finally:
        spark.conf.set(conf, held)


# ---- rule attribution ------------------------------------------------------------------------
def test_steps_add_up_to_the_whole_difference(spark):
    rng = random.Random(5)
    data = [(rng.choice("xy"), rng.choice(["OK", "RE", None]), rng.randrange(300), rng.choice([1, None]), i) for i in range(300)]
    df = spark.createDataFrame(data, "k string, status string, amount int, ref int, net int")
    status, amount = F.col("status"), F.col("amount")
    before = {"status": status == "OK", "amount": amount > 100, "dated": F.col("ref").isNotNull()}
    after = {"status": status.isin("OK", "RE"), "amount": amount >= 0, "odd": amount % 2 == 1}
    out = kpi.attribute_change(df, ["k"], before, after, {"total": (amount, F.col("net")), "n": F.lit(1)})
    assert {r.rule for r in out.collect()} == {"status", "amount", "dated", "odd", "measure"}

    def kpi_of(rules, value, key):
        return sum(
            (r[4] if value == "net" else r[2]) if value != "n" else 1
            for r in data if r[0] == key and all(f(r) for f in rules)
        )

    old = [lambda r: r[1] == "OK", lambda r: r[2] > 100, lambda r: r[3] is not None]
    new = [lambda r: r[1] in ("OK", "RE"), lambda r: r[2] >= 0, lambda r: r[2] % 2 == 1]
    for key in "xy":
        mine = [r for r in out.collect() if r.k == key]
        assert sum(r.total_step for r in mine) == kpi_of(new, "net", key) - kpi_of(old, "amount", key)
        assert sum(r.n_step for r in mine) == kpi_of(new, "n", key) - kpi_of(old, "n", key)
        assert sum(r.n_gained - r.n_lost for r in mine) == sum(r.n_step for r in mine)
        alone = {r.rule: r.n_alone for r in mine}
        assert alone["status"] == kpi_of([new[0], *old[1:]], "n", key) - kpi_of(old, "n", key)
        assert alone["dated"] == kpi_of(old[:2], "n", key) - kpi_of(old, "n", key)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text
