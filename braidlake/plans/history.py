"""Month windows, cohorts, stock and flow, effective dating, as-of and snapshot queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidlake.functions.dates import add_months, cohort_age, month_range, month_start
from braidlake.operators import asof, bitmaps, intervals, periods
from braidlake.plans.registry import (
    ANCHORS, RUN, Tables, day, money, query, sql_money, sql_month,
)
from braidlake.sources import lake

TOTAL = sql_money("o_totalprice")
MONTH = sql_month("o_orderdate")
PLAIN = "o_orderpriority <> '5-LOW'"  # stands for the product list some measures leave out
SQL_ANCHORS = "(VALUES (DATE '2000-06-01'), (DATE '2000-05-01'), (DATE '2000-04-01')) v(a)"


def orders(t: Tables) -> DataFrame:
    return t.orders.join(
        t.customer.select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment")
        ),
        "o_custkey",
    )


SQL_ORDERS = "(SELECT *, c_mktsegment AS segment FROM orders JOIN customer ON c_custkey = o_custkey)"


@query(
    "trailing_3m",
    f"""
    SELECT a::VARCHAR AS anchor_month, segment,
           count(DISTINCT o_custkey) FILTER (WHERE {MONTH} = a) AS n_now,
           count(DISTINCT o_custkey) FILTER (WHERE {MONTH} = a AND {PLAIN}) AS n_now_plain,
           count(DISTINCT o_custkey) AS n_3m,
           count(DISTINCT o_custkey) FILTER (WHERE {PLAIN}) AS n_plain_3m,
           count(o_orderkey) AS n_orders_3m,
           CAST(sum({TOTAL}) FILTER (WHERE {PLAIN}) AS DOUBLE) AS total_plain_3m
    FROM {SQL_ORDERS} JOIN {SQL_ANCHORS}
      ON o_orderdate >= a - INTERVAL 2 MONTH AND o_orderdate < a + INTERVAL 1 MONTH
    GROUP BY 1, 2
    """,
)
def trailing_3m(t: Tables):
    plain, in_month = F.expr(PLAIN), F.col("in_month")
    return periods.trailing_metrics(
        orders(t), ["segment"], "o_orderdate", ANCHORS, 3,
        measures={
            "n_orders_3m": ("count", F.col("o_orderkey")),
            "total_plain_3m": ("sum", F.when(plain, money("o_totalprice"))),
        },
        entity="o_custkey",
        entity_flags={
            "n_now": in_month, "n_now_plain": in_month & plain, "n_3m": F.lit(True),
            "n_plain_3m": plain,
        },
    )


def monthly(t: Tables, key: str = "o_custkey") -> DataFrame:
    return t.orders.groupBy(key, month_start("o_orderdate").alias("month")).agg(
        F.sum(money("o_totalprice")).alias("total"), F.count(F.lit(1)).alias("n")
    )


SQL_MONTHLY = f"""m AS (SELECT o_custkey, {MONTH} AS month, sum({TOTAL}) total, count(*) n
                        FROM orders GROUP BY 1, 2)"""


@query(
    "trailing_max_3m",
    f"""
    WITH {SQL_MONTHLY}
    SELECT a::VARCHAR AS anchor_month, o_custkey, CAST(max(total) AS DOUBLE) AS max_total,
           max(n) AS max_n
    FROM m JOIN {SQL_ANCHORS} ON month <= a AND month >= a - INTERVAL 2 MONTH GROUP BY 1, 2
    """,
)
def trailing_max_3m(t: Tables):
    return periods.trailing_max(monthly(t), ["o_custkey"], "month", ANCHORS, 3, ["total", "n"])


@query(
    "trailing_max_12m",
    f"""
    WITH {SQL_MONTHLY},
    b AS (SELECT a, o_custkey, max(total) mt, max(n) mn FROM m JOIN {SQL_ANCHORS}
          ON month <= a AND month >= a - INTERVAL 11 MONTH GROUP BY 1, 2)
    SELECT a::VARCHAR AS anchor_month, b.o_custkey, CAST(max(mt) AS DOUBLE) AS max_total,
           max(mn) AS max_n, max(month) FILTER (WHERE total = mt)::VARCHAR AS peak_total,
           max(month) FILTER (WHERE n = mn)::VARCHAR AS peak_n
    FROM b JOIN m ON m.o_custkey = b.o_custkey AND month <= a AND month >= a - INTERVAL 11 MONTH
    GROUP BY 1, 2
    """,
)
def trailing_max_12m(t: Tables):
    return periods.trailing_max(
        monthly(t), ["o_custkey"], "month", ANCHORS, 12, ["total", "n"], peaks=True
    )


@query(
    "trailing_40d",
    f"""
    SELECT a::VARCHAR AS anchor_month, segment, count(DISTINCT o_custkey) AS n_40d,
           CAST(sum({TOTAL}) AS DOUBLE) AS total_40d,
           CAST(max(o_orderdate) AS DATE)::VARCHAR AS last_order_40d
    FROM {SQL_ORDERS} JOIN {SQL_ANCHORS}
      ON CAST(o_orderdate AS DATE) <= CAST(a + INTERVAL 1 MONTH AS DATE) + 4
     AND CAST(o_orderdate AS DATE) >= CAST(a + INTERVAL 1 MONTH AS DATE) + 4 - 39
    GROUP BY 1, 2
    """,
)
def trailing_40d(t: Tables):
    out = periods.trailing_days_metrics(
        orders(t), ["segment"], "o_orderdate", ANCHORS,
        measures={
            "total_40d": ("sum", money("o_totalprice")),
            "last_order_40d": ("max", F.col("o_orderdate")),
        },
        entity="o_custkey", entity_flags={"n_40d": F.lit(True)},
    )
    return out.withColumn("last_order_40d", day("last_order_40d"))


@query(
    "having_dormant",
    f"""
    WITH l AS (SELECT a, segment, o_custkey, max(o_orderdate) AS last
               FROM {SQL_ORDERS} JOIN {SQL_ANCHORS} ON o_orderdate < a + INTERVAL 1 MONTH
               GROUP BY 1, 2, 3
               HAVING {sql_month('max(o_orderdate)')} = CAST(a - INTERVAL 3 MONTH AS DATE))
    SELECT a::VARCHAR AS anchor_month, segment, count(DISTINCT o_custkey) AS n_dormant
    FROM l GROUP BY 1, 2
    """,
)
def having_dormant(t: Tables):
    return periods.dormant_count(orders(t), ["segment"], "o_custkey", "o_orderdate", ANCHORS)


FIRST_ANCHORS = month_range("1995-01-01", "1996-12-01")


@query(
    "first_cohort",
    f"""
    WITH f AS (SELECT segment, o_custkey, {sql_month('min(o_orderdate)')} AS a FROM {SQL_ORDERS}
               WHERE o_orderdate >= DATE '1995-02-01' GROUP BY 1, 2)
    SELECT a::VARCHAR AS anchor_month, segment, count(DISTINCT o_custkey) AS n_first
    FROM f WHERE a <= DATE '1996-12-01' GROUP BY 1, 2
    """,
)
def first_cohort(t: Tables):
    return periods.first_event_cohort(
        orders(t), ["segment"], "o_custkey", "o_orderdate", FIRST_ANCHORS, floor="1995-02-01"
    )


@query(
    "young_cohorts",
    f"""
    WITH f AS (SELECT o_custkey k, min(o_orderdate) f FROM orders GROUP BY 1),
    c AS (SELECT o_custkey, {MONTH} m, count(*) n FROM orders GROUP BY 1, 2)
    SELECT o_custkey, m::VARCHAR AS month,
           CASE WHEN datediff('month', {sql_month('f')}, m) + 1 IN (1, 2, 3) THEN n ELSE 0 END AS n
    FROM c JOIN f ON k = o_custkey
    """,
)
def young_cohorts(t: Tables):
    first = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"))
    counts = monthly(t).join(first, "o_custkey")
    return periods.restrict_to_young(counts, "month", "first", [1, 2, 3], ["n"]).select(
        "o_custkey", "month", "n"
    )


@query(
    "cumulative_distinct",
    f"""
    SELECT a::VARCHAR AS anchor_month, segment, count(DISTINCT o_custkey) AS n_ever
    FROM {SQL_ORDERS} JOIN {SQL_ANCHORS} ON o_orderdate < a + INTERVAL 1 MONTH GROUP BY 1, 2
    """,
)
def cumulative_distinct(t: Tables):
    return periods.cumulative_distinct(
        orders(t), ["segment"], "o_custkey", "o_orderdate", ANCHORS
    )


@query(
    "cohort_age",
    f"""
    WITH f AS (SELECT o_custkey k, min(o_orderdate) FILTER (WHERE o_orderstatus = 'F') f
               FROM orders GROUP BY 1)
    SELECT o_orderkey, CASE WHEN f IS NULL OR {MONTH} < {sql_month('f')} THEN 0
           ELSE datediff('month', {sql_month('f')}, {MONTH}) + 1 END AS age
    FROM orders JOIN f ON k = o_custkey
    """,
)
def cohort_age_query(t: Tables):
    first = t.orders.groupBy("o_custkey").agg(
        F.min(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))).alias("first")
    )
    return t.orders.join(first, "o_custkey").select(
        "o_orderkey", cohort_age(month_start("o_orderdate"), "first").alias("age")
    )


# Customer state as known in each anchor month, with the counter of the month before the first.
SEED = add_months(RUN, -2)
SQL_STATE = f"""
    st AS (SELECT a AS month, o_custkey, min(o_orderdate) AS first_any,
                  min(o_orderdate) FILTER (WHERE {PLAIN}) AS first_plain,
                  max(o_orderdate) FILTER (WHERE {PLAIN}) AS last_plain
           FROM orders JOIN {SQL_ANCHORS} ON o_orderdate < a + INTERVAL 1 MONTH GROUP BY 1, 2),
    seed AS (SELECT o_custkey, DATE '2000-04-01' AS seed_month,
                    count(DISTINCT {MONTH}) AS seed
             FROM orders WHERE o_orderdate >= DATE '1999-05-01' AND o_orderdate < DATE '2000-05-01'
             GROUP BY 1)
"""


@query(
    "months_active",
    f"""
    WITH {SQL_STATE},
    w AS (SELECT st.*, seed, seed_month, {sql_month('last_plain')} AS lm,
                 lag({sql_month('last_plain')}) OVER p AS pl, lag(month) OVER p AS pm,
                 lag(seed, 1, 0) OVER p AS ps
          FROM st LEFT JOIN seed USING (o_custkey)
          WINDOW p AS (PARTITION BY o_custkey ORDER BY month))
    SELECT o_custkey, month::VARCHAR AS month, CASE
        WHEN first_plain IS NULL THEN 0
        WHEN datediff('month', lm, month) - CASE WHEN day(last_plain) > 1 THEN 1 ELSE 0 END >= 12
          THEN 0
        WHEN {sql_month('first_plain')} > month THEN 0
        WHEN first_plain < month AND month < DATE '1995-06-01' THEN 0
        WHEN month = {sql_month('first_any')} THEN 1
        WHEN lm = month AND seed = 0 AND pl <> pm THEN 1
        WHEN seed IS NOT NULL AND month = seed_month THEN seed
        WHEN seed IS NULL AND lm = month AND pl IS NULL THEN 1
        WHEN seed IS NULL AND lm = month AND pl IS NOT NULL THEN 2
        ELSE coalesce(ps, 0) + datediff('month', seed_month, month) END AS months_active
    FROM w
    """,
)
def months_active(t: Tables):
    def known(measure, col):
        return lambda m: measure(F.when(F.col("o_orderdate") < F.lit(add_months(m, 1)), col))

    day_, plain = F.col("o_orderdate"), F.when(F.expr(PLAIN), F.col("o_orderdate"))
    state = periods.per_anchor(
        t.orders, ["o_custkey"], ANCHORS,
        {
            "first_any": known(F.min, day_), "first_plain": known(F.min, plain),
            "last_plain": known(F.max, plain),
        },
        "month",
    ).filter("first_any IS NOT NULL")
    seed = (
        t.orders.filter(
            (F.col("o_orderdate") >= F.lit(add_months(SEED, -11)))
            & (F.col("o_orderdate") < F.lit(add_months(SEED, 1)))
        )
        .groupBy("o_custkey")
        .agg(F.count_distinct(month_start("o_orderdate")).alias("seed"))
        .withColumn("seed_month", F.lit(SEED))
    )
    return periods.months_active(
        state.join(seed, "o_custkey", "left"), ["o_custkey"], "month", "first_any", "first_plain",
        "last_plain", "seed_month", "seed", floor="1995-06-01",
    ).select("o_custkey", "month", "months_active")


@query(
    "stock_flow",
    f"""
    WITH e AS (SELECT segment, {MONTH} AS month, count(DISTINCT o_custkey) AS active,
                      count(DISTINCT o_custkey) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent
               FROM {SQL_ORDERS} GROUP BY 1, 2),
    b AS (SELECT *, lag(active, 1, 0) OVER (PARTITION BY segment ORDER BY month) AS bop FROM e)
    SELECT segment, month::VARCHAR AS month, active, urgent, bop AS bop_active,
           greatest(active - bop, 0) AS gain_active, least(active - bop, 0) AS churn_active,
           greatest(active - bop, 0) - urgent AS involuntary_active,
           greatest(active - bop, 0) - urgent + least(active - bop, 0) AS net_churn_active
    FROM b
    """,
)
def stock_flow(t: Tables):
    per_customer = orders(t).groupBy(
        "segment", month_start("o_orderdate").alias("month"), "o_custkey"
    ).agg(F.max(F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)).alias("urgent"))
    stocks = per_customer.groupBy("segment", "month").agg(
        F.count(F.lit(1)).alias("active"), F.sum("urgent").alias("urgent")
    )
    return periods.stock_flow(stocks, ["segment"], "month", ["active"], new={"active": "urgent"})


@query(
    "running_high",
    f"""
    WITH {SQL_MONTHLY}
    SELECT a::VARCHAR AS anchor_month, o_custkey, CAST(max(total) AS DOUBLE) AS high,
           CAST(max(total) FILTER (WHERE month = a) AS DOUBLE) AS total
    FROM m JOIN {SQL_ANCHORS} ON month <= a GROUP BY 1, 2
    """,
)
def running_high(t: Tables):
    return periods.running_high(monthly(t), ["o_custkey"], "month", ANCHORS, "total")


PERIODS = [
    ("BUILDING", "outlier", dt.date(1996, 3, 10), dt.date(1997, 3, 20)),
    ("BUILDING", "outlier", dt.date(1996, 11, 1), dt.date(1997, 6, 1)),
    ("MACHINERY", "project", dt.date(1998, 1, 1), dt.date(1998, 1, 31)),
    ("MACHINERY", "project", dt.date(1999, 5, 5), dt.date(2000, 2, 2)),
    ("AUTOMOBILE", "outlier", dt.date(2000, 1, 1), dt.date(2000, 7, 1)),
]
SQL_PERIODS = ", ".join(f"('{k}', '{n}', DATE '{a}', DATE '{b}')" for k, n, a, b in PERIODS)


@query(
    "suppress_periods",
    f"""
    WITH p(seg, kind, lo, hi) AS (VALUES {SQL_PERIODS}),
    m AS (SELECT segment, {MONTH} AS month, count(*) AS n, sum({TOTAL}) AS total
          FROM {SQL_ORDERS} GROUP BY 1, 2),
    f AS (SELECT m.*, coalesce(max(CASE WHEN kind = 'outlier' THEN 1 END), 0) AS o,
                 coalesce(max(CASE WHEN kind = 'project' THEN 1 END), 0) AS j
          FROM m LEFT JOIN p ON seg = segment AND month >= {sql_month('lo')}
               AND month < {sql_month('hi')} GROUP BY ALL)
    SELECT segment, month::VARCHAR AS month, o AS in_outlier, j AS in_project,
           CASE WHEN o + j > 0 THEN 0 ELSE n END AS n,
           CASE WHEN o + j > 0 THEN 0 ELSE CAST(total AS DOUBLE) END AS total
    FROM f
    """,
)
def suppress_periods(t: Tables):
    table = lake.constants(
        t.spark, PERIODS, "segment string, kind string, start_date date, end_date date"
    )
    stocks = orders(t).groupBy("segment", month_start("o_orderdate").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).alias("total")
    )
    return periods.suppress_in_periods(
        stocks, table, "segment", "month", ["outlier", "project"], ["n", "total"]
    )


@query(
    "first_snapshot",
    f"""
    WITH f AS (SELECT {MONTH} m, min(o_orderdate) d FROM orders GROUP BY 1)
    SELECT CAST(m - INTERVAL 1 MONTH AS DATE)::VARCHAR AS ref_month, o_orderpriority,
           count(*) AS n, CAST(sum({TOTAL}) AS DOUBLE) AS total
    FROM orders JOIN f ON d = o_orderdate GROUP BY 1, 2
    """,
)
def first_snapshot(t: Tables):
    rows = periods.first_snapshot_of_month(t.orders, "o_orderdate")
    return rows.groupBy("ref_month", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).alias("total")
    )


@query(
    "first_snapshot_per_key",
    """
    WITH e AS (SELECT user_id, CAST(ts AS DATE) AS d, event_id FROM events),
    f AS (SELECT user_id u, min(d) AS d FROM e GROUP BY user_id, date_trunc('month', d))
    SELECT event_id, e.user_id, '2023-12-01' AS ref_month FROM e
    JOIN f ON u = user_id AND f.d = e.d
    """,
)
def first_snapshot_per_key(t: Tables):
    dated = t.events.select("event_id", "user_id", day("ts").alias("d"))
    return periods.first_snapshot_of_month(dated, "d", keys=["user_id"]).drop("d")


@query(
    "expand_effective",
    """
    WITH s AS (SELECT o_custkey, o_orderpriority, CAST(min(o_orderdate) AS DATE) AS start
               FROM orders GROUP BY 1, 2),
    m AS (SELECT CAST(unnest(generate_series(DATE '1999-10-01', DATE '2000-06-01',
                 INTERVAL 1 MONTH)) AS DATE) AS month),
    x AS (SELECT s.*, month FROM s JOIN m ON month >= CAST(date_trunc('month', start) AS DATE)),
    w AS (SELECT o_custkey, month, max(start) AS start FROM x GROUP BY 1, 2)
    SELECT x.o_custkey, x.month::VARCHAR AS month, x.o_orderpriority, x.start::VARCHAR AS start
    FROM x JOIN w ON w.o_custkey = x.o_custkey AND w.month = x.month AND w.start = x.start
    """,
)
def expand_effective(t: Tables):
    starts = t.orders.groupBy("o_custkey", "o_orderpriority").agg(
        day(F.min("o_orderdate")).alias("start")
    )
    return periods.expand_effective(
        starts, ["o_custkey"], "start", RUN, first_month=add_months(RUN, -8)
    )


# Two histories of a customer: what was ordered last, and where the order stood 45 days later. Some
# entries end by themselves, many are cut off by the next one.
SQL_HISTORIES = """
    l0 AS (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS f, o_orderpriority AS v,
             CASE WHEN o_orderkey % 4 = 0 THEN CAST(CAST(o_orderdate AS DATE) + 300 AS DATE) END AS t FROM orders),
    r0 AS (SELECT o_custkey AS k, CAST(CAST(o_orderdate AS DATE) + 45 AS DATE) AS f, o_orderstatus AS v,
             CASE WHEN o_orderkey % 3 = 0 THEN CAST(CAST(o_orderdate AS DATE) + 245 AS DATE) END AS t FROM orders),
    l AS (SELECT * FROM l0 QUALIFY row_number() OVER (PARTITION BY k, f ORDER BY t DESC NULLS FIRST, v DESC) = 1),
    r AS (SELECT * FROM r0 QUALIFY row_number() OVER (PARTITION BY k, f ORDER BY t DESC NULLS FIRST, v DESC) = 1),
    b AS (SELECT k, f AS p FROM l UNION SELECT k, t FROM l WHERE t IS NOT NULL
          UNION SELECT k, f FROM r UNION SELECT k, t FROM r WHERE t IS NOT NULL),
    s AS (SELECT b.k, b.p, CASE WHEN l.t IS NULL OR l.t > b.p THEN l.v END AS lv,
                 CASE WHEN r.t IS NULL OR r.t > b.p THEN r.v END AS rv
          FROM b ASOF LEFT JOIN l ON l.k = b.k AND b.p >= l.f ASOF LEFT JOIN r ON r.k = b.k AND b.p >= r.f),
    c AS (SELECT *, lag(lv) OVER w AS pl, lag(rv) OVER w AS pr FROM s WINDOW w AS (PARTITION BY k ORDER BY p)),
    d AS (SELECT * FROM c WHERE lv IS DISTINCT FROM pl OR rv IS DISTINCT FROM pr),
    e AS (SELECT *, lead(p) OVER (PARTITION BY k ORDER BY p) AS until FROM d)
"""


def histories(t: Tables) -> tuple[DataFrame, DataFrame]:
    ordered, no = day("o_orderdate"), F.col("o_orderkey")
    later = F.date_add(ordered, 45)
    return (
        t.orders.select(
            F.col("o_custkey").alias("custkey"), ordered.alias("valid_from"),
            F.when(no % 4 == 0, F.date_add(ordered, 300)).alias("valid_to"), F.col("o_orderpriority").alias("priority"),
        ),
        t.orders.select(
            F.col("o_custkey").alias("custkey"), later.alias("valid_from"),
            F.when(no % 3 == 0, F.date_add(ordered, 245)).alias("valid_to"), F.col("o_orderstatus").alias("status"),
        ),
    )


@query(
    "histories_in_force",
    f"""
    WITH {SQL_HISTORIES}
    SELECT k AS custkey, p::VARCHAR AS valid_from, until::VARCHAR AS valid_to, lv AS priority, rv AS status
    FROM e WHERE lv IS NOT NULL AND rv IS NOT NULL
    """,
)
def histories_in_force(t: Tables):
    return intervals.intersect_histories(*histories(t), ["custkey"])


@query(
    "months_in_force",
    f"""
    WITH {SQL_HISTORIES},
    m AS (SELECT e.*, CAST(unnest(generate_series(
            greatest(CAST(date_trunc('month', p) AS DATE), DATE '1999-10-01'),
            CAST(least(coalesce(date_trunc('month', until) - INTERVAL 1 MONTH, DATE '2000-06-01'), DATE '2000-06-01')
                 AS DATE), INTERVAL 1 MONTH)) AS DATE) AS month FROM e WHERE lv IS NOT NULL)
    SELECT k AS custkey, month::VARCHAR AS month, lv AS priority, rv AS status FROM m
    """,
)
def months_in_force(t: Tables):
    spans = intervals.intersect_histories(*histories(t), ["custkey"], how="left")
    return intervals.months_in_force(spans, RUN, add_months(RUN, -8)).drop("valid_from", "valid_to")


@query(
    "activity_runs",
    f"""
    WITH m AS (SELECT o_custkey AS k, {MONTH} AS m, CAST(max(o_orderdate) AS DATE) AS last FROM orders
               WHERE {PLAIN} AND o_orderdate < DATE '2000-07-01' GROUP BY 1, 2),
    s AS (SELECT *, lag(last) OVER w AS before, lead(m) OVER w AS next FROM m WINDOW w AS (PARTITION BY k ORDER BY m)),
    g AS (SELECT *, before IS NULL OR datediff('month', before, m) - CASE WHEN day(before) > 1 THEN 1 ELSE 0 END >= 12
                 AS begins FROM s),
    r AS (SELECT *, max(CASE WHEN begins THEN m END) OVER (PARTITION BY k ORDER BY m) AS start FROM g),
    x AS (SELECT k, start, last, CAST(unnest(generate_series(m, CAST(coalesce(next - INTERVAL 1 MONTH, DATE '2000-06-01')
                 AS DATE), INTERVAL 1 MONTH)) AS DATE) AS month FROM r)
    SELECT k AS o_custkey, month::VARCHAR AS month,
           CASE WHEN datediff('month', last, month) - CASE WHEN day(last) > 1 THEN 1 ELSE 0 END >= 12 THEN 0
                ELSE datediff('month', start, month) + 1 END AS months_active
    FROM x
    """,
)
def activity_runs(t: Tables):
    return intervals.activity_runs(t.orders.filter(PLAIN), ["o_custkey"], "o_orderdate", RUN)


@query(
    "bitmap_windows",
    f"""
    SELECT a::VARCHAR AS anchor_month, segment,
           count(DISTINCT o_custkey) FILTER (WHERE {MONTH} = a) AS n_1m,
           count(DISTINCT o_custkey) FILTER (WHERE {MONTH} >= a - INTERVAL 2 MONTH) AS n_3m,
           count(DISTINCT o_custkey) FILTER (WHERE {MONTH} >= a - INTERVAL 11 MONTH) AS n_12m,
           count(DISTINCT o_custkey) AS n_ever
    FROM {SQL_ORDERS} JOIN {SQL_ANCHORS} ON o_orderdate < a + INTERVAL 1 MONTH GROUP BY 1, 2
    """,
)
def bitmap_windows(t: Tables):
    # Five segments, many customers: monthly bitmaps serve every window of every anchor.
    monthly_bits = bitmaps.partials(orders(t), ["segment", month_start("o_orderdate").alias("month")], "o_custkey")
    return bitmaps.windows(
        monthly_bits, ["segment"], "month", ANCHORS, {"n_1m": 1, "n_3m": 3, "n_12m": 12, "n_ever": None}
    )


# ---- as-of and snapshots --------------------------------------------------------------------


@query(
    "asof_latest",
    """
    SELECT p.event_id, p.user_id, c.event_id AS click_id, c.value AS click_value
    FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c
      ON p.user_id = c.user_id AND p.ts >= c.ts
    """,
)
def asof_latest(t: Tables):
    purchases = t.events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    clicks = t.events.filter("event_type = 'click'").select(
        "user_id", "ts", F.col("event_id").alias("click_id"), F.col("value").alias("click_value")
    )
    return asof.asof_latest(
        purchases, clicks, ["user_id"], "ts", "ts", ["click_id", "click_value"], ["click_id"]
    ).drop("ts")


@query(
    "status_at_close",
    """
    WITH v AS (SELECT event_id, user_id, ts, event_type,
                      ts + CASE WHEN value > 100 THEN INTERVAL 3 DAY ELSE INTERVAL 6 HOUR END - 
                      CASE WHEN event_type = 'error' THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END
                      AS closing FROM events)
    SELECT a.event_id, arg_max(b.event_type, b.ts) AS closing_type, max(b.event_id) AS closing_id
    FROM v a LEFT JOIN v b ON b.user_id = a.user_id AND b.ts <= a.closing AND b.ts >= a.ts
    GROUP BY 1
    """,
)
def status_at_close(t: Tables):
    wait = F.when(F.col("value") > 100, F.expr("INTERVAL '3' DAY")).otherwise(
        F.expr("INTERVAL '6' HOUR").cast("interval day to second")
    )
    cut = F.when(F.col("event_type") == "error", F.expr("INTERVAL '1' DAY")).otherwise(
        F.expr("INTERVAL '0' DAY")
    )
    rows = t.events.select("event_id", "user_id", "ts", (F.col("ts") + wait - cut).alias("closing"))
    versions = t.events.select(
        "user_id", "ts", F.col("event_type").alias("closing_type"),
        F.col("event_id").alias("closing_id"),
    )
    return asof.status_at(
        rows, versions, ["user_id"], "ts", "closing", ["closing_type", "closing_id"]
    ).select("event_id", "closing_type", "closing_id")


@query(
    "freeze_snapshot",
    """
    WITH v AS (SELECT event_id, user_id, event_type, ts,
                 CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN TIMESTAMP '2024-01-10'
                   WHEN 'view' THEN TIMESTAMP '2024-01-20' ELSE TIMESTAMP '2024-02-01' END AS freeze
               FROM events),
    f AS (SELECT a.user_id, a.freeze, max(b.ts) AS ts FROM v a JOIN v b
          ON b.user_id = a.user_id AND b.ts < a.freeze GROUP BY 1, 2)
    SELECT event_id, v.user_id, event_type FROM v JOIN f
      ON f.user_id = v.user_id AND f.freeze = v.freeze AND f.ts = v.ts
    """,
)
def freeze_snapshot(t: Tables):
    kind = F.col("event_type")

    def at(text: str):
        return F.lit(text).cast("timestamp_ntz")

    freeze = (
        F.when(kind == "error", None).when(kind == "click", at("2024-01-10"))
        .when(kind == "view", at("2024-01-20")).otherwise(at("2024-02-01"))
    )
    versions = t.events.select("event_id", "user_id", "event_type", "ts", freeze.alias("freeze"))
    return asof.freeze_snapshot(versions, ["user_id"], "ts", "freeze").select(
        "event_id", "user_id", "event_type"
    )


@query(
    "rollout_split",
    """
    WITH o AS (SELECT o_orderkey, c_nationkey AS unit, CAST(o_orderdate AS DATE) AS start,
                      CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'new' ELSE 'old' END
                      AS origin FROM orders JOIN customer ON c_custkey = o_custkey),
    r AS (SELECT n_nationkey AS unit, DATE '1996-01-01' + CAST(n_nationkey * 30 AS INTEGER) AS d
          FROM nation WHERE n_regionkey <> 4)
    SELECT o_orderkey, origin FROM o WHERE (origin = 'old' AND NOT EXISTS
      (SELECT 1 FROM r WHERE r.unit = o.unit AND start >= d))
      OR (origin = 'new' AND EXISTS (SELECT 1 FROM r WHERE r.unit = o.unit AND start >= d))
    """,
)
def rollout_split(t: Tables):
    placed = t.orders.join(
        t.customer.select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("unit")
        ),
        "o_custkey",
    ).select(
        "o_orderkey", "unit", day("o_orderdate").alias("start"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "new").otherwise("old")
        .alias("origin"),
    )
    rollout = t.nation.filter("n_regionkey <> 4").select(
        F.col("n_nationkey").alias("unit"),
        F.date_add(F.lit(dt.date(1996, 1, 1)), F.col("n_nationkey") * 30).alias("d"),
    )
    return asof.rollout_split(
        placed, rollout, "unit", "start", "d", "origin", "old", "new"
    ).select("o_orderkey", "origin")
