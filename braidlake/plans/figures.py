"""KPI facts, medallion flows, allocation, statements and balances on the sample tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidlake.functions.dates import month_start
from braidlake.operators import kpi, money as mo, union
from braidlake.plans.registry import (
    RUN, Tables, money, now, query, sql_money, sql_month, sql_ratio,
)
from braidlake.sources import lake, merge

TOTAL = sql_money("o_totalprice")
PRICE = sql_money("l_extendedprice")
SHIP = sql_month("l_shipdate")


def sales(t: Tables) -> DataFrame:
    """Orders with customer, nation and region: the curated rows under the KPI fact."""
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("region")
    )
    people = t.customer.join(geo, "c_nationkey").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"), "region"
    )
    return (
        t.orders.filter(F.col("o_orderstatus").isin("F", "O") & F.col("o_totalprice").isNotNull())
        .join(people, "o_custkey")
        .select(
            "o_orderkey", "o_custkey", "region", "segment", "o_orderstatus",
            F.date_format("o_orderdate", "yyyy-MM").alias("month"),
            money("o_totalprice").alias("total"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1).otherwise(0)
            .alias("fast"),
        )
    )


SQL_SALES = f"""
    s AS (SELECT o_orderkey, o_custkey, r_name AS region, c_mktsegment AS segment, o_orderstatus,
                 strftime(o_orderdate, '%Y-%m') AS month, {TOTAL} AS total,
                 CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS fast
          FROM orders JOIN customer ON c_custkey = o_custkey
          JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
          WHERE o_orderstatus IN ('F', 'O') AND o_totalprice IS NOT NULL)
"""

GOLD = kpi.KpiSpec(
    dims=["month", "region", "segment"],
    sums={"total_sales": "total", "n_fast": "fast"},
    distincts={"n_orders": "o_orderkey", "n_customers": "o_custkey"},
    ratios={
        "ticket": ("total_sales", "n_orders", 1),
        "fast_pct": ("n_fast", "n_orders", 100),
    },
    alerts={
        "ticket_alert": ("ticket", 200000, "ATTENTION", "OK"),
        "fast_alert": ("fast_pct", 40, "RISK", "OK"),
    },
    rank=("rank_in_region", ["month", "region"], "total_sales"),
)


@query(
    "kpi_gold",
    f"""
    WITH {SQL_SALES},
    g AS (SELECT month, region, segment, sum(total) AS v, sum(fast) AS f,
                 count(DISTINCT o_orderkey) AS n, count(DISTINCT o_custkey) AS c
          FROM s GROUP BY 1, 2, 3),
    r AS (SELECT *, {sql_ratio('v * 100', 'n * 100')} AS ticket, {sql_ratio('f', 'n', 100)} AS pct
          FROM g)
    SELECT month, region, segment, CAST(v AS DOUBLE) AS total_sales, f::BIGINT AS n_fast,
           n AS n_orders, c AS n_customers, ticket, pct AS fast_pct,
           row_number() OVER (PARTITION BY month, region ORDER BY v DESC, segment)
               AS rank_in_region,
           CASE WHEN ticket < 200000 THEN 'ATTENTION' ELSE 'OK' END AS ticket_alert,
           CASE WHEN pct < 40 THEN 'RISK' ELSE 'OK' END AS fast_alert
    FROM r
    """,
)
def kpi_gold(t: Tables):
    return kpi.kpi_gold(sales(t), GOLD)


@query(
    "kpi_audit",
    f"""
    WITH {SQL_SALES}
    SELECT month, region, o_orderstatus, count(DISTINCT o_orderkey) AS n_orders,
           CAST(sum(total) AS DOUBLE) AS total FROM s GROUP BY 1, 2, 3
    """,
)
def kpi_audit(t: Tables):
    return kpi.audit(
        sales(t), ["month", "region", "o_orderstatus"], {"n_orders": "o_orderkey"},
        {"total": "total"},
    )


@query(
    "kpi_mean",
    """
    SELECT l_suppkey, CAST((2 * sum(CAST(round(l_discount * 100) AS HUGEINT)) * 10000 + count(*))
                           // (2 * count(*)) AS DOUBLE) / 1000000 AS mean_discount
    FROM lineitem GROUP BY 1
    """,
)
def kpi_mean(t: Tables):
    lines = t.lineitem.select("l_suppkey", F.col("l_discount").cast("decimal(4,2)").alias("d"))
    return kpi.kpi_gold(lines, kpi.KpiSpec(dims=["l_suppkey"], means={"mean_discount": "d"}))


@query(
    "medallion_sum",
    f"""
    SELECT l_suppkey, CAST(sum({PRICE}) AS DOUBLE) AS total FROM lineitem
    WHERE l_extendedprice > 0 GROUP BY 1
    """,
)
def medallion_sum(t: Tables):
    _, gold = union.medallion(
        t.lineitem, "l_extendedprice > 0", ["l_suppkey", "l_extendedprice"], ["l_suppkey"],
        {"total": F.sum(money("l_extendedprice"))},
    )
    return gold


@query(
    "allocate",
    f"""
    WITH d AS (SELECT l_orderkey AS k, sum({PRICE}) AS gross,
                      max(CASE WHEN l_returnflag = 'R' THEN {PRICE} END) AS reversal
               FROM lineitem GROUP BY 1),
    x AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {PRICE} AS amount, {TOTAL} AS total,
                 gross, reversal,
                 CAST({PRICE} * 100 AS HUGEINT) AS ac, CAST(gross * 100 AS HUGEINT) AS gc
          FROM lineitem JOIN d ON k = l_orderkey JOIN orders ON o_orderkey = l_orderkey),
    y AS (SELECT *, CASE WHEN reversal = amount THEN CAST(0 AS HUGEINT)
                         ELSE (2 * ac * 1000000000000 + gc) // (2 * gc) END AS sh FROM x)
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           CAST(sh AS DOUBLE) / 1000000000000 AS share,
           CAST((2 * sh * CAST(total * 100 AS HUGEINT) + 1000000000) // 2000000000 AS DOUBLE)
               / 100000 AS alloc_total
    FROM y
    """,
)
def allocate(t: Tables):
    price = money("l_extendedprice")
    docs = (
        t.lineitem.groupBy("l_orderkey")
        .agg(F.sum(price).alias("gross"),
             F.max(F.when(F.col("l_returnflag") == "R", price)).alias("reversal"))
        .join(
            t.orders.select(
                F.col("o_orderkey").alias("l_orderkey"), money("o_totalprice").alias("total")
            ),
            "l_orderkey",
        )
    )
    lines = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", price.alias("amount")
    )
    return mo.allocate(
        docs, lines, ["l_orderkey"], "amount", {"share": ("gross", ["total"])}, reversal="reversal"
    ).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "share", "alloc_total")


@query(
    "stack_signed",
    f"""
    SELECT l_suppkey, 'sale' AS kind, CAST(sum({PRICE}) AS DOUBLE) AS amount FROM lineitem
    WHERE l_returnflag <> 'R' GROUP BY 1
    UNION ALL
    SELECT l_suppkey, 'reversal', CAST(sum(-1 * {PRICE}) AS DOUBLE) FROM lineitem
    WHERE l_returnflag = 'R' AND l_linestatus = 'F' GROUP BY 1
    UNION ALL
    SELECT -99, 'reversal', CAST(sum(-1 * {PRICE}) AS DOUBLE) FROM lineitem
    WHERE l_returnflag = 'R' AND l_linestatus = 'O'
    """,
)
def stack_signed(t: Tables):
    returned = F.col("l_returnflag") == "R"
    own = F.col("l_linestatus") == "F"
    price = money("l_extendedprice")
    stacked = mo.fan_out(
        t.lineitem,
        [
            mo.Part("sale", ~returned, price),
            mo.Part("reversal", returned & own, price, -1),
            mo.Part("reversal", returned & (F.col("l_linestatus") == "O"), price, -1, {"l_suppkey": F.lit(-99).cast("bigint")}),
        ],
        {"l_suppkey": F.col("l_suppkey")}, "kind", "amount", "decimal(18,2)",
    )
    return stacked.groupBy("l_suppkey", "kind").agg(F.sum("amount").alias("amount"))


def movements(t: Tables) -> DataFrame:
    sign = F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    return t.lineitem.groupBy("l_suppkey", month_start("l_shipdate").alias("month")).agg(
        F.sum(money("l_extendedprice") * sign).alias("movement")
    )


SQL_MOVES = f"""v AS (SELECT l_suppkey, {SHIP} AS month,
                 sum({PRICE} * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END) AS movement
                 FROM lineitem GROUP BY 1, 2)"""


@query(
    "roll_forward",
    f"""
    WITH {SQL_MOVES},
    p AS (SELECT l_suppkey, sum(movement) AS closing FROM v WHERE month < DATE '2000-06-01'
          GROUP BY 1 HAVING sum(movement) > 0),
    n AS (SELECT * FROM v WHERE month = DATE '2000-06-01')
    SELECT coalesce(p.l_suppkey, n.l_suppkey) AS l_suppkey, '2000-06-01' AS month,
           CAST(coalesce(closing, 0) AS DOUBLE) AS opening,
           CAST(coalesce(movement, 0) AS DOUBLE) AS movement,
           CAST(coalesce(closing, 0) + coalesce(movement, 0) AS DOUBLE) AS closing
    FROM p FULL OUTER JOIN n ON p.l_suppkey = n.l_suppkey
    """,
)
def roll_forward(t: Tables):
    moves = movements(t)
    before = (
        moves.filter(F.col("month") < F.lit(RUN)).groupBy("l_suppkey")
        .agg(F.sum("movement").alias("closing")).filter("closing > 0")
        .withColumn("month", F.lit(dt.date(2000, 5, 1)))
    )
    return mo.roll_forward(before, moves.filter(F.col("month") == F.lit(RUN)), ["l_suppkey"])


@query(
    "roll_forward_series",
    f"""
    WITH v AS (SELECT l_partkey, {SHIP} AS month,
               sum({PRICE} * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END) AS movement
               FROM lineitem WHERE l_shipdate < DATE '2000-07-01' GROUP BY 1, 2),
    s AS (SELECT l_partkey, min(month) AS lo FROM v GROUP BY 1),
    g AS (SELECT l_partkey, CAST(unnest(generate_series(lo, DATE '2000-06-01', INTERVAL 1 MONTH))
                 AS DATE) AS month FROM s),
    b AS (SELECT g.l_partkey, g.month, coalesce(movement, 0) AS movement,
                 sum(coalesce(movement, 0)) OVER (PARTITION BY g.l_partkey ORDER BY g.month) AS c
          FROM g LEFT JOIN v ON v.l_partkey = g.l_partkey AND v.month = g.month)
    SELECT l_partkey, month::VARCHAR AS month, CAST(c - movement AS DOUBLE) AS opening,
           CAST(movement AS DOUBLE) AS movement, CAST(c AS DOUBLE) AS closing FROM b
    """,
)
def roll_forward_series(t: Tables):
    sign = F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    moves = t.lineitem.select(
        "l_partkey", month_start("l_shipdate").alias("month"),
        (money("l_extendedprice") * sign).alias("movement"),
    )
    return mo.roll_forward_series(moves, ["l_partkey"], RUN)


@query(
    "movement_statement",
    f"""
    SELECT l_suppkey, {SHIP}::VARCHAR AS month,
           CAST(coalesce(sum({PRICE}) FILTER (WHERE l_returnflag = 'N'), 0) AS DOUBLE) AS kept,
           CAST(coalesce(sum({PRICE}) FILTER (WHERE l_returnflag = 'R'), 0) AS DOUBLE) AS returned,
           CAST(coalesce(sum({PRICE}) FILTER (WHERE l_returnflag = 'A' AND l_linestatus = 'O'), 0)
                AS DOUBLE) AS advance,
           CAST(coalesce(sum(CASE WHEN l_returnflag = 'N' THEN {PRICE}
                    WHEN l_returnflag = 'R' THEN -1 * {PRICE}
                    WHEN l_linestatus = 'O' THEN -1 * {PRICE} END), 0) AS DOUBLE) AS movement
    FROM lineitem WHERE l_returnflag <> 'A' OR l_linestatus = 'O' GROUP BY 1, 2
    """,
)
def movement_statement(t: Tables):
    flag, price = F.col("l_returnflag"), money("l_extendedprice")
    parts = [
        mo.Part("kept", flag == "N", price),
        mo.Part("returned", flag == "R", price, -1),
        mo.Part("advance", (flag == "A") & (F.col("l_linestatus") == "O"), price, -1),
    ]
    keys = {"l_suppkey": F.col("l_suppkey"), "month": month_start("l_shipdate")}
    return mo.routed_statement([(t.lineitem, parts, keys)], list(keys))


@query(
    "late_movements",
    f"""
    WITH v AS (SELECT l_partkey, {SHIP} AS month, l_returnflag = 'A' AND l_linenumber > 4 AS late,
               {PRICE} * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS x
               FROM lineitem WHERE l_shipdate < DATE '2000-07-01'),
    b AS (SELECT l_partkey, min(month) AS lo, min(month) FILTER (WHERE NOT late) AS lo_stored FROM v GROUP BY 1),
    g AS (SELECT b.*, CAST(unnest(generate_series(lo, DATE '2000-06-01', INTERVAL 1 MONTH)) AS DATE) AS month FROM b),
    m AS (SELECT l_partkey, month, sum(x) FILTER (WHERE NOT late) AS own, sum(x) FILTER (WHERE late) AS more
          FROM v GROUP BY 1, 2),
    s AS (SELECT g.l_partkey, g.month, lo_stored, coalesce(own, 0) AS own, coalesce(more, 0) AS more,
                 sum(coalesce(own, 0)) OVER w AS c, sum(coalesce(more, 0)) OVER w AS d
          FROM g LEFT JOIN m ON m.l_partkey = g.l_partkey AND m.month = g.month
          WINDOW w AS (PARTITION BY g.l_partkey ORDER BY g.month))
    SELECT l_partkey, month::VARCHAR AS month, CAST(c + d - own - more AS DOUBLE) AS opening,
           CAST(own + more AS DOUBLE) AS movement, CAST(c + d AS DOUBLE) AS closing,
           CAST(month < lo_stored OR lo_stored IS NULL OR more <> 0 OR d <> 0 OR d - more <> 0 AS BIGINT) AS changed
    FROM s
    """,
)
def late_movements(t: Tables):
    # The series is stored by year; then the late lines come and only what they change is merged in.
    sign = F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    moves = t.lineitem.select(
        "l_partkey", month_start("l_shipdate").alias("month"),
        (money("l_extendedprice") * sign).alias("movement"),
        ((F.col("l_returnflag") == "A") & (F.col("l_linenumber") > 4)).alias("late"),
    )
    path = lake.scratch(t.spark, "balances")
    series = mo.roll_forward_series(moves.filter("NOT late"), ["l_partkey"], RUN)
    series = series.withColumns({"year": F.year("month"), "row_hash": F.lit("stored"), "changed": F.lit(False)})
    lake.write(series, lake.Sink(path, partition_by=["year"], spread=False))
    stored = lake.read(t.spark, path).drop("year", "row_hash", "changed")
    delta = mo.late_movements(stored, moves.filter("late AND month <= '2000-06-01'"), ["l_partkey"], RUN)
    merge.merge_partitions(
        delta.withColumns({"year": F.year("month"), "row_hash": F.lit("late"), "changed": F.lit(True)}), path,
        ["l_partkey", "month", "year"], ["year"], "row_hash", now(), inserted=None, changed=None,
    )
    return lake.read(t.spark, path).drop("year", "row_hash")


@query(
    "blend_manual",
    f"""
    WITH u AS (
      SELECT l_orderkey, l_suppkey, sum({PRICE}) AS v FROM lineitem WHERE l_returnflag <> 'A'
      GROUP BY 1, 2
      UNION ALL
      SELECT l_orderkey, l_suppkey, max({PRICE}) * 2 FROM lineitem WHERE l_linestatus = 'O'
      GROUP BY 1, 2),
    d AS (SELECT l_orderkey, l_suppkey, max(v) AS v FROM u GROUP BY 1, 2)
    SELECT l_suppkey, CAST(sum(v) AS DOUBLE) AS total FROM d GROUP BY 1
    """,
)
def blend_manual(t: Tables):
    price = money("l_extendedprice")
    wide = "decimal(30,2)"
    computed = t.lineitem.filter("l_returnflag <> 'A'").groupBy("l_orderkey", "l_suppkey").agg(
        F.sum(price).cast(wide).alias("v")
    )
    manual = t.lineitem.filter("l_linestatus = 'O'").groupBy("l_orderkey", "l_suppkey").agg(
        (F.max(price) * 2).cast(wide).alias("v")
    )
    return mo.blend_manual(computed, manual, ["l_orderkey"], ["l_suppkey"], "v")


@query(
    "unexplained",
    f"""
    WITH a AS (SELECT DISTINCT l_orderkey AS k, l_suppkey AS s, {PRICE} AS amount,
                      CAST(CASE WHEN l_quantity = 10 THEN {PRICE} ELSE 1 END AS DECIMAL(18,2))
                          AS billed, l_partkey AS p
               FROM lineitem WHERE l_returnflag = 'R'),
    e AS (SELECT l_orderkey AS k, {PRICE} AS v, l_partkey AS p FROM lineitem
          WHERE l_returnflag = 'A')
    SELECT s AS l_suppkey, CAST(sum(CASE WHEN amount = billed THEN 0 ELSE amount END) AS DOUBLE)
           AS adjustment
    FROM a WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.k = a.k AND (e.v = a.amount OR e.p = a.p))
    GROUP BY 1
    """,
)
def unexplained(t: Tables):
    price = money("l_extendedprice")
    adjustments = t.lineitem.filter("l_returnflag = 'R'").select(
        "l_orderkey", "l_suppkey", "l_partkey", price.alias("amount"),
        F.when(F.col("l_quantity") == 10, price).otherwise(F.lit(1)).cast("decimal(18,2)")
        .alias("billed"),
    )
    explained = t.lineitem.filter("l_returnflag = 'A'").select(
        "l_orderkey", "l_partkey", price.alias("v")
    )
    return mo.unexplained_adjustments(
        adjustments,
        [
            (explained, {"l_orderkey": "l_orderkey", "amount": "v"}),
            (explained, {"l_orderkey": "l_orderkey", "l_partkey": "l_partkey"}),
        ],
        ["l_orderkey", "l_partkey"], "amount", "billed", ["l_suppkey"],
    )


@query(
    "revenue_breakdown",
    f"""
    SELECT o_orderkey,
      CAST(coalesce((SELECT sum({PRICE}) FROM lineitem WHERE l_orderkey = o_orderkey
                     AND l_linestatus = 'F'), 0) AS DOUBLE) AS billed,
      CAST(coalesce((SELECT sum({PRICE} * CAST(l_tax AS DECIMAL(4,2))) FROM lineitem
                     WHERE l_orderkey = o_orderkey), 0) AS DOUBLE) AS tax,
      CAST(coalesce((SELECT sum({PRICE}) FROM lineitem WHERE l_orderkey = o_orderkey
                     AND l_linestatus = 'F'), 0) +
           coalesce((SELECT sum({PRICE} * CAST(l_tax AS DECIMAL(4,2))) FROM lineitem
                     WHERE l_orderkey = o_orderkey), 0) AS DOUBLE) AS revenue
    FROM orders
    """,
)
def revenue_breakdown(t: Tables):
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    price = money("l_extendedprice")
    return mo.revenue_breakdown(
        t.orders.select("o_orderkey"),
        {
            "billed": (lines.filter("l_linestatus = 'F'"), price),
            "tax": (lines, price * F.col("l_tax").cast("decimal(4,2)")),
        },
        ["o_orderkey"],
    )
