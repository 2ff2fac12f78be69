import random
import re
from decimal import Decimal as D

from pyspark.sql import functions as F

from braidlake.operators import money
from tests.conftest import d, rows


def test_shares_sum_to_one_and_edge_cases(spark):
    docs = spark.createDataFrame(
        [(1, D("100.00"), D("80.00"), None), (2, D("0.00"), D("9.00"), None),
         (3, D("50.00"), D("7.00"), D("-5.00"))],
        "doc int, gross decimal(18,2), net decimal(18,2), rev decimal(18,2)",
    )
    txns = spark.createDataFrame(
        [(1, "a", D("33.33")), (1, "b", D("66.67")), (2, "c", D("1.00")), (3, "d", D("-5.00")),
         (9, "x", D("1.00"))],
        "doc int, t string, amount decimal(18,2)",
    )
    out = money.allocate(docs, txns, ["doc"], "amount", {"share": ("gross", ["net"])}, reversal="rev")
    got = {r.t: (r.share, r.alloc_net) for r in out.collect()}
    assert got["a"][0] + got["b"][0] == 1 and got["a"][1] + got["b"][1] == 80
    assert got["c"] == (None, None) and got["d"][0] == 0 and "x" not in got


def test_stack_signed(spark):
    df = spark.createDataFrame([("p", 5)], "who string, v int")
    out = money.stack_signed([(df, 1, {"kind": "sale"}), (df, -1, {"kind": "back", "who": "-99"})], ["v"])
    assert rows(out, "who", "v", "kind") == [("-99", -5, "back"), ("p", 5, "sale")]


def test_roll_forward_step_and_series_agree(spark):
    moves = spark.createDataFrame(
        [("a", d("2024-01-01"), D("10.00")), ("a", d("2024-03-01"), D("-4.00")),
         ("b", d("2024-02-01"), D("1.00"))],
        "k string, month date, movement decimal(18,2)",
    )
    series = money.roll_forward_series(moves, ["k"], "2024-04-01")
    by_month = {}
    for r in series.collect():
        by_month[r.k, r.month] = (r.opening, r.closing)
    assert by_month["a", d("2024-02-01")] == (10, 10) and by_month["a", d("2024-04-01")] == (6, 6)
    for (k, m), (opening, _) in by_month.items():
        before = by_month.get((k, m.replace(month=m.month - 1) if m.month > 1 else m))
        if m.month > 1 and before:
            assert opening == before[1]
    prev = series.filter(F.col("month") == "2024-02-01").select("k", "month", "closing")
    step = money.roll_forward(prev, moves.filter(F.col("month") == "2024-03-01"), ["k"])
    assert rows(step, "k", "opening", "closing") == [("a", 10, 6), ("b", 1, 1)]


def test_statement_covers_every_key(spark):
    a = spark.createDataFrame([("x", D("5.00")), ("x", D("1.00"))], "k string, v decimal(18,2)")
    b = spark.createDataFrame([("y", D("2.00"))], "k string, v decimal(18,2)")
    out = money.movement_statement({"in": (a, "v", 1), "out": (b, "v", -1)}, ["k"])
    assert rows(out) == [("x", 6, 0, 6), ("y", 0, 2, -2)]


def test_blend_manual_takes_the_larger(spark):
    c = spark.createDataFrame([(1, "g", 5), (2, "g", 7)], "doc int, g string, v int")
    m = spark.createDataFrame([(1, "g", 9), (3, "h", 1)], "doc int, g string, v int")
    assert rows(money.blend_manual(c, m, ["doc"], ["g"], "v")) == [("g", 16), ("h", 1)]


def test_unexplained_adjustments(spark):
    a = spark.createDataFrame(
        [(1, "g", 5, 9), (1, "g", 5, 9), (2, "g", 7, 7), (3, "g", 4, 1), (4, "g", 8, 1)],
        "doc int, g string, v int, billed int",
    )
    by_value = spark.createDataFrame([(3, 4), (4, 99)], "doc int, x int")
    out = money.unexplained_adjustments(
        a, [(by_value, {"doc": "doc", "v": "x"})], ["doc"], "v", "billed", ["g"]
    )
    assert rows(out) == [("g", 13)]


def test_revenue_breakdown_keeps_documents_without_lines(spark):
    base = spark.createDataFrame([(1,), (2,)], "doc int")
    lines = spark.createDataFrame([(1, 3), (1, 4)], "doc int, v int")
    out = money.revenue_breakdown(base, {"fee": (lines, F.col("v"))}, ["doc"])
    assert rows(out) == [(1, 7, 7), (2, 0, 0)]


def test_router_reads_the_fact_once(spark, tmp_path):
    spark.createDataFrame(
        [(1, "a", "N", D("10.00"), 7), (1, "a", "N", D("10.00"), 7), (1, "a", "R", D("4.00"), 7), (2, "b", None, D("1.00"), 8),
         (2, "b", "A", D("5.00"), 8), (2, "b", "A", D("5.00"), 8), (2, "b", "A", D("3.00"), 8)],
        "doc int, who string, code string, v decimal(18,2), note int",
    ).write.parquet(str(tmp_path / "f"))
    fact = spark.read.parquet(str(tmp_path / "f"))
    code, v = F.col("code"), F.col("v")
    parts = [
        money.Part("gross", code != "R", v),
        money.Part("back", code == "R", v, -1, {"who": F.lit("sentinel")}),
        money.Part("paid", code == "N", v, -1, unit=F.concat_ws("|", "doc", "v"), per_unit="max"),
        money.Part("billed", code == "A", v, -1, unit=F.col("note"), per_unit="max"),
        money.Part("debit", code == "A", v, -1, unit=F.concat_ws("|", "doc", "v"), unless=v > 4),
        money.Part("memo", F.lit(True), F.lit(1)),
    ]
    out = money.routed_statement([(fact, parts, {"who": F.col("who")})], ["who"], memo=["memo"])
    text = out._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Expand" not in text
    assert rows(out) == [
        ("a", 20, 0, 10, 0, 0, 3, 10), ("b", 13, 0, 0, 5, 3, 4, 5), ("sentinel", 0, 4, 0, 0, 0, 0, -4),
    ]
    both = money.routed_statement(
        [(fact, parts[:2], {"who": F.col("who")}), (fact, parts[3:4], {"who": F.lit("all")})], ["who"]
    )
    assert rows(both) == [("a", 20, 0, 0, 20), ("all", 0, 0, 5, -5), ("b", 13, 0, 0, 13), ("sentinel", 0, 4, 0, -4)]


def test_units_within_a_document_need_no_shuffle_of_their_own(spark, tmp_path):
    spark.createDataFrame(
        [(1, "a", "N", D("10.00")), (1, "a", "N", D("10.00")), (2, "a", "N", D("10.00")), (2, "b", "A", D("5.00")),
         (2, "b", "N", D("5.00")), (3, "b", "A", D("5.00")), (None, "b", "A", D("7.00")), (None, "b", "A", D("7.00"))],
        "doc int, who string, code string, v decimal(18,2)",
    ).write.parquet(str(tmp_path / "f"))
    fact = spark.read.parquet(str(tmp_path / "f")).repartition(3, "doc")
    code, v, unit = F.col("code"), F.col("v"), F.col("v")
    parts = [
        money.Part("gross", F.lit(True), v),
        money.Part("paid", code == "N", v, -1, unit=unit, per_unit="max"),
        money.Part("debit", code == "A", v, -1, unit=unit, unless=code == "N"),
    ]
    out = money.routed_statement([(fact, parts, {"who": F.col("who")})], ["who"], within=["doc"])
    exchanges = re.findall(r"Exchange hashpartitioning\((.*?)\)", out._jdf.queryExecution().executedPlan().toString())
    assert len(exchanges) == 2 and not any("_unit" in e for e in exchanges)  # the fact by document, the sums by key
    # By hand: documents 1 and 2 pay 10 each; in 2 the debit of 5 is void; amounts of no document are one unit's sum.
    assert rows(out) == [("a", 30, 20, 0, 10), ("b", 29, 5, 19, 5)]
    whole = [money.Part(**{**vars(p), "unit": F.concat_ws("|", "doc", "v")}) if p.unit is not None else p for p in parts]
    assert rows(money.routed_statement([(fact, whole, {"who": F.col("who")})], ["who"])) == rows(out)


def test_fan_out_keeps_lines_and_signs(spark):
    df = spark.createDataFrame([("p", 5, True), ("q", 7, None)], "who string, v int, ok boolean")
    out = money.fan_out(
        df, [money.Part("sale", F.col("ok"), F.col("v")), money.Part("back", F.lit(True), F.col("v"), -1, {"who": F.lit("-99")})],
        {"who": F.col("who")}, "kind",
    )
    assert sorted((r.who, r.kind, int(r.value)) for r in out.collect()) == [("-99", "back", -7), ("-99", "back", -5), ("p", "sale", 5)]


def test_late_movements_equal_a_full_recomputation(spark):
    rng = random.Random(8)
    move = lambda: (rng.choice("abcd"), d(f"2024-{rng.randint(1, 9):02d}-01"), D(rng.choice([-5, 5, 3, 0])))
    schema = "k string, month date, movement decimal(18,2)"
    for _ in range(4):
        old, late = [move() for _ in range(12)], [move() for _ in range(5)]
        stored = money.roll_forward_series(spark.createDataFrame(old, schema), ["k"], "2024-08-01")
        whole = money.roll_forward_series(spark.createDataFrame(old + late, schema), ["k"], "2024-08-01")
        changed = money.late_movements(stored, spark.createDataFrame(late, schema), ["k"], "2024-08-01")
        state = {(r.k, r.month): tuple(r)[2:] for r in stored.collect()}
        before = dict(state)
        for r in changed.collect():
            assert before.get((r.k, r.month)) != tuple(r)[2:]  # only what changes comes out
            state[r.k, r.month] = tuple(r)[2:]
        assert state == {(r.k, r.month): tuple(r)[2:] for r in whole.collect()}
