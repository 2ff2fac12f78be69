from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from braidlake.operators import contract, golden, kpi, protect, union
from tests.conftest import d, rows


def test_golden_record_policies(spark):
    a = spark.createDataFrame([(1, "A1", None, d("2024-01-05"))], "k int, name string, farmer string, c date")
    b = spark.createDataFrame(
        [(1, "B1", "f", d("2023-01-05")), (2, "B2", "g", None)], "k int, name string, farmer string, c date"
    )
    out = golden.golden_record(
        {"a": a, "b": b}, ["k"],
        {"name": ("first", ["a", "b"]), "farmer": ("owner", ["a", "b"]), "c": ("least", ["a", "b"])},
        present=True,
    )
    assert rows(out) == [(1, "A1", None, d("2023-01-05"), 1, 1), (2, "B2", "g", None, 0, 1)]
    flags = golden.source_flags({"b": b, "a": a}, ["k"])
    assert rows(flags, "k", "sources") == [(1, "a, b"), (2, "b")]


def test_exclusions_are_lifted_for_payers(spark):
    df = spark.createDataFrame([(1, "test x"), (2, "test y"), (3, None), (4, "internal")], "id int, n string")
    payers = spark.createDataFrame([(2,), (4,)], "id int")
    out = golden.exclude_internal(
        df, [F.col("n") == "internal"], [F.col("n").ilike("%TEST%")], payers, ["id"]
    )
    assert rows(out, "id") == [(2,), (3,)]


def test_classify_defaults(spark):
    df = spark.createDataFrame([("a",), ("z",)], "k string")
    table = spark.createDataFrame([("a", "X", 1)], "code string, fam string, n int")
    out = golden.classify(df, table, {"k": "code"}, {"fam": "OTHER", "n": None})
    assert rows(out) == [("a", "X", 1), ("z", "OTHER", None)]


def test_kpi_gold_rounds_half_up_and_survives_zero(spark):
    df = spark.createDataFrame(
        [("a", 1, D("10.01")), ("a", 2, D("0.00")), ("b", 3, D("0.00"))], "g string, o int, v decimal(18,2)"
    )
    spec = kpi.KpiSpec(
        dims=["g"], sums={"total": "v"}, distincts={"n": "o"}, means={"m": "v"},
        ratios={"ticket": ("total", "n", 1), "odd": ("n", "total", 100)},
        alerts={"alert": ("ticket", 5, "LOW", "OK")}, rank=("pos", [], "total"),
    )
    got = {r.g: r for r in kpi.kpi_gold(df, spec).collect()}
    assert str(got["a"].ticket) == "5.01" and got["b"].odd is None
    assert (got["a"].alert, got["b"].alert, got["a"].pos, got["b"].pos) == ("OK", "LOW", 1, 2)
    assert str(got["a"].m) == "5.005000"


def test_compare_variants(spark):
    cols = "k string, j string, v int"
    a = spark.createDataFrame([("same", None, 1), ("gone", "x", 2), ("moved", "x", 3), ("nul", "x", None)], cols)
    b = spark.createDataFrame([("same", None, 1), ("born", "x", 2), ("moved", "x", 5), ("nul", "x", None)], cols)
    out = kpi.compare_variants(a, b, ["k", "j"], ["v"])
    assert rows(out, "k", "status", "v_delta") == [
        ("born", "added", 2), ("gone", "removed", -2), ("moved", "changed", 2), ("nul", "equal", 0),
        ("same", "equal", 0),
    ]


CONTRACT = contract.Contract(
    "t_contract",
    [contract.Field("id", "bigint", True, "It's the key"), contract.Field("day", "date", True),
     contract.Field("v", "decimal(10,2)"), contract.Field("extra", "string")],
    partition_by=["day"], comment="A table", properties={"tier": "gold"},
)


def test_contract(spark):
    raw = spark.createDataFrame(
        [("1", "2024-01-01", "1.5"), ("x", "2024-01-01", "2"), (None, "nope", "z")],
        "id string, day string, v string",
    )
    good = contract.conform(raw, CONTRACT)
    assert rows(good) == [(1, d("2024-01-01"), D("1.50"), None)]
    assert [f.dataType for f in good.schema] == [f.dataType for f in CONTRACT.schema()]
    assert rows(contract.violations(raw, CONTRACT)) == [
        ("day", "type", 1), ("id", "required", 1), ("id", "type", 1), ("v", "type", 1),
    ]
    assert rows(contract.violating_rows(raw, CONTRACT), "violations") == [
        ("required:id,type:day,type:v",), ("type:id",),
    ]
    assert CONTRACT.schema()["id"].metadata["comment"] == "It's the key"
    assert not CONTRACT.schema()["id"].nullable


def test_contract_ddl(spark, tmp_path):
    spark.sql(CONTRACT.create_table(str(tmp_path / "t")))
    try:
        assert spark.table("t_contract").columns == ["id", "v", "extra", "day"]
    finally:
        spark.sql("DROP TABLE t_contract")


def test_protect(spark):
    df = spark.createDataFrame([("12345678901", "Ana 1")], "doc string, name string")
    key = F.lit("0123456789abcdef")
    safe = protect.protect(df, {"h": ("doc", 256)}, ["doc"], encrypt={"doc": key}, masks=["name"])
    row = safe.first()
    assert row.name == "Xxx n" and row.doc != "12345678901"
    want = df.select(F.sha2(F.lit("123.456.789-01"), 256)).first()[0]
    assert row.h == want
    assert protect.decrypt(safe, {"doc": key}).first().doc == "12345678901"
    assert protect.decrypt(safe, {"doc": F.lit("fedcba9876543210")}).first().doc is None
    protect.secure_view(df, "v_safe", ["doc"])
    assert spark.table("v_safe").columns == ["name"]


def test_align_union_and_medallion(spark):
    a = spark.createDataFrame([(1, "x")], "id int, n string")
    b = spark.createDataFrame([(2.5, 7)], "w double, id int")
    out = union.align_union({"a": a, "b": b}, columns={"id": "bigint", "n": "string", "w": "double"})
    assert rows(out) == [(1, "x", None, "a"), (7, None, 2.5, "b")]
    assert union.align_union({"a": a, "b": b}).columns == ["id", "n", "origin", "w"]
    silver, gold = union.medallion(a, "id > 0", ["id"], ["id"], {"s": F.sum("id")})
    assert rows(silver) == [(1,)] and rows(gold) == [(1, 1)]
    with pytest.raises(ValueError):
        golden.golden_record({"a": a}, ["id"], {"n": ("odd", ["a"])}).collect()
