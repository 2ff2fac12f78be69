"""Monthly credit fact per company and issuer: activity windows, cohorts, flows and exceptions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidlake.functions import keys as key_functions
from braidlake.functions.dates import add_months, cohort_age, month_of, month_start
from braidlake.operators import periods
from braidlake.plans.history import SQL_ANCHORS
from braidlake.plans.registry import (
    RUN, Tables, day, money, query, sql_fingerprint, sql_money, sql_month,
)
from braidlake.sources import lake

KEYS = ["company", "issuer"]
ANCHOR = "anchor_month"


def monthly_base(credits: DataFrame, since: dt.date, run: dt.date) -> DataFrame:
    """Credits of a window, one row per key, month and worker.

    Every month-based measure reads this table instead of the transactions.
    """
    plain = F.col("is_plain")
    return (
        credits.filter(
            (F.col("credit_date") >= F.lit(since)) & (F.col("credit_date") < F.lit(add_months(run, 1)))
        )
        .groupBy(*KEYS, month_start("credit_date").alias("month"), "worker")
        .agg(
            F.sum("amount").alias("amount"),
            F.sum(F.when(plain, F.col("amount"))).alias("amount_plain"),
            F.count("txn").alias("n_txn"),
            F.max(F.when(plain, 1).otherwise(0)).alias("plain"),
        )
    )


def worker_history(credits: DataFrame, anchors: Sequence[dt.date]) -> DataFrame:
    """First and last credit of every worker, as known in each anchor month.

    The one pass over the whole history; everything that has no lower bound is read from here.
    """
    filtered = F.when(F.col("is_plain"), F.col("credit_date"))

    def until(value, month: dt.date):
        return F.max(F.when(F.col("credit_date") < F.lit(add_months(month, 1)), value))

    return (
        credits.filter(F.col("credit_date") < F.lit(add_months(max(anchors), 1)))
        .groupBy(*KEYS, "worker")
        .agg(
            F.min("credit_date").alias("first_any"),
            F.min(filtered).alias("first_plain"),
            *[until(F.col("credit_date"), m).alias(f"last_any_{m:%Y%m}") for m in anchors],
            *[until(filtered, m).alias(f"last_plain_{m:%Y%m}") for m in anchors],
        )
    )


def standing(history: DataFrame, anchors: Sequence[dt.date], idle_months: int = 3) -> DataFrame:
    """Per key and anchor: first and last credits, workers ever seen, new and gone dormant."""

    def by(month: dt.date, col: str):
        return F.when(F.col(col) < F.lit(add_months(month, 1)), F.col(col))

    def in_month(col: str, month: dt.date):
        return (F.col(col) >= F.lit(month)) & (F.col(col) < F.lit(add_months(month, 1)))

    out = periods.per_anchor(
        history, KEYS, anchors,
        {
            "first_any": lambda m: F.min(by(m, "first_any")),
            "first_plain": lambda m: F.min(by(m, "first_plain")),
            "last_plain": lambda m: F.max(f"last_plain_{m:%Y%m}"),
            "n_ever": lambda m: F.count(by(m, "first_any")),
            "n_first": lambda m: F.count(F.when(in_month("first_plain", m), 1)),
            "n_dormant": lambda m: F.count(
                F.when(in_month(f"last_any_{m:%Y%m}", add_months(m, -idle_months)), 1)
            ),
        },
        ANCHOR,
    )
    return out.filter(F.col("first_any").isNotNull())


def credit_fact(
    credits: DataFrame,
    seeds: DataFrame,
    delinquency: DataFrame,
    exceptions: DataFrame,
    run_month: dt.date | str,
    months: int = 3,
    kinds: Sequence[str] = ("outlier", "project"),
    exception_issuer: str | None = None,
    counting_from: str = "2020-01-01",
    staged: bool = False,
) -> DataFrame:
    """Rows of the run month and the month before, one per company and issuer.

    ``credits``: company, issuer, worker, txn, credit_date, amount, is_plain (product counts in the
    filtered measures and the worker has a document). ``seeds``: counter of months active of the
    previous snapshot (company, issuer, seed_month, seed). ``delinquency``: company, snapshot
    date ``d`` and amount. ``exceptions``: company, kind, start_date, end_date.

    The credits are read three times: the whole history grouped per worker, the months of the
    windows, and the days of the 40-day windows. All inputs of the joins are grouped by the join
    key, so the joins add no shuffle. With ``staged`` the monthly base is written to the shared
    folder once; otherwise each measure that uses it groups the credits again.
    """
    run = month_of(run_month)
    anchors = [add_months(run, -i) for i in range(months)]
    first_month = add_months(run, -(months - 1) - 11)
    base = monthly_base(credits, first_month, run)
    if staged:
        base = lake.stage(base, "credit_base")
    plain, in_month = F.col("plain") == 1, F.col("in_month")
    monthly = base.groupBy(*KEYS, "month").agg(
        F.sum("plain").alias("n_workers"), F.sum("amount_plain").alias("amount_plain")
    )
    recent = periods.trailing_metrics(
        base, KEYS, "month", anchors, 3,
        measures={"n_txn_3m": ("sum", F.col("n_txn"))},
        entity="worker",
        entity_flags={"n_now": in_month & plain, "n_3m": plain},
    )
    best_3m = periods.trailing_max(monthly, KEYS, "month", anchors, 3, ["n_workers", "amount_plain"])
    best_12m = periods.trailing_max(
        monthly, KEYS, "month", anchors, 12, ["n_workers"], peaks=True
    ).withColumnsRenamed({"max_n_workers": "size_12m", "peak_n_workers": "size_month"})
    days_40 = periods.trailing_days_metrics(
        credits, KEYS, "credit_date", anchors,
        measures={"last_credit_40d": ("max", F.col("credit_date"))},
        entity="worker", entity_flags={"n_40d": F.col("is_plain")},
    )
    spine = standing(worker_history(credits, anchors), anchors)
    wide = reduce(
        lambda left, right: left.join(right, [ANCHOR, *KEYS], "left"),
        [recent, best_3m, best_12m, days_40],
        spine,
    ).join(seeds, KEYS, "left")
    counted = periods.months_active(
        wide, KEYS, ANCHOR, "first_any", "first_plain", "last_plain", "seed_month", "seed",
        floor=counting_from,
    ).withColumn("age", cohort_age(ANCHOR, "first_any"))
    young = F.col("age").isin(1, 2, 3)
    flows = periods.stock_flow(
        counted.withColumn("n_new", F.when(young, F.col("n_first")).otherwise(0)),
        KEYS, ANCHOR, ["max_n_workers"], new={"max_n_workers": "n_new"},
    )
    late = (
        periods.first_snapshot_of_month(delinquency, "d", ANCHOR)
        .groupBy(ANCHOR, "company").agg(F.sum("amount").alias("late_amount"))
    )
    owed = flows.join(late, [ANCHOR, "company"], "left").withColumn(
        "is_late", F.when(F.coalesce("late_amount", F.lit(0)) > 0, 1).otherwise(0)
    )
    excepted = exceptions if exception_issuer is None else exceptions.withColumn(
        "_issuer", F.lit(exception_issuer)
    )
    owed = owed.withColumn(
        "_subject",
        F.col("company") if exception_issuer is None
        else F.when(F.col("issuer") == exception_issuer, F.col("company")),
    )
    calm = periods.suppress_in_periods(
        owed, excepted.withColumnRenamed("company", "_subject"), "_subject", ANCHOR, kinds,
        ["n_new", "gain_max_n_workers", "churn_max_n_workers", "bop_max_n_workers"],
    )
    out = calm.filter(F.col(ANCHOR).isin(anchors[:2])).select(
        ANCHOR, *KEYS, "age", "months_active", "n_ever", "n_first", "n_dormant", "n_now", "n_3m",
        "n_txn_3m", "max_n_workers", "max_amount_plain", "size_12m", "size_month", "n_40d",
        "last_credit_40d", "n_new", "bop_max_n_workers", "gain_max_n_workers",
        "churn_max_n_workers", "involuntary_max_n_workers", "net_churn_max_n_workers",
        "late_amount", "is_late", *[f"in_{k}" for k in kinds],
    )
    return out.withColumn("row_hash", key_functions.fingerprint(out.columns))


# ---- registered on the sample tables --------------------------------------------------------

TOTAL = sql_money("o_totalprice")
EXCEPTIONS = [
    (3, "outlier", dt.date(2000, 1, 15), dt.date(2000, 6, 10)),
    (3, "outlier", dt.date(2000, 5, 1), dt.date(2000, 8, 1)),
    (7, "project", dt.date(2000, 6, 1), dt.date(2001, 1, 1)),
]


def sample_inputs(t: Tables, orders: DataFrame):
    people = t.customer.select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("company"),
        F.col("c_mktsegment").alias("issuer"),
    )
    credits = orders.join(people, "o_custkey").select(
        "company", "issuer", F.col("o_custkey").alias("worker"), F.col("o_orderkey").alias("txn"),
        day("o_orderdate").alias("credit_date"), money("o_totalprice").alias("amount"),
        (F.col("o_orderpriority") != "5-LOW").alias("is_plain"), "o_orderstatus",
    )
    seed_month = add_months(RUN, -2)
    seeds = (
        credits.filter(
            F.col("is_plain")
            & (F.col("credit_date") >= F.lit(add_months(seed_month, -11)))
            & (F.col("credit_date") < F.lit(add_months(seed_month, 1)))
        )
        .groupBy(*KEYS).agg(F.count_distinct(month_start("credit_date")).alias("seed"))
        .withColumn("seed_month", F.lit(seed_month))
    )
    late = credits.filter("o_orderstatus = 'P'").groupBy(
        "company", F.col("credit_date").alias("d")
    ).agg(F.sum("amount").alias("amount"))
    exceptions = lake.constants(
        t.spark, EXCEPTIONS, "company int, kind string, start_date date, end_date date"
    )
    return credits.drop("o_orderstatus"), seeds, late, exceptions


MONTH = "CAST(date_trunc('month', d) AS DATE)"
SQL_EXCEPTIONS = ", ".join(f"({c}, '{k}', DATE '{a}', DATE '{b}')" for c, k, a, b in EXCEPTIONS)
WINDOW = "PARTITION BY company, issuer ORDER BY a"


def sql_credit(where: str = "TRUE") -> str:
    """The fact from the orders that ``where`` selects, with its columns in order and in their own types."""
    return f"""
    WITH c AS (SELECT c_nationkey AS company, c_mktsegment AS issuer, o_custkey AS worker,
                 o_orderkey AS txn, CAST(o_orderdate AS DATE) AS d, {TOTAL} AS amount,
                 o_orderpriority <> '5-LOW' AS pl, o_orderstatus AS st
               FROM orders JOIN customer ON c_custkey = o_custkey WHERE {where}),
    ca AS (SELECT * FROM c JOIN {SQL_ANCHORS} ON d < a + INTERVAL 1 MONTH),
    sp AS (SELECT a, company, issuer, min(d) AS fa, min(d) FILTER (WHERE pl) AS fp,
             max(d) FILTER (WHERE pl) AS lp, count(DISTINCT worker) AS n_ever FROM ca GROUP BY ALL),
    r3 AS (SELECT a, company, issuer, count(DISTINCT worker) FILTER (WHERE pl AND {MONTH} = a) AS n_now,
             count(DISTINCT worker) FILTER (WHERE pl) AS n_3m, count(txn) AS n_txn_3m
           FROM ca WHERE d >= a - INTERVAL 2 MONTH GROUP BY ALL),
    mo AS (SELECT company, issuer, {MONTH} AS m, count(DISTINCT worker) FILTER (WHERE pl) AS n,
             sum(amount) FILTER (WHERE pl) AS v FROM c GROUP BY ALL),
    b3 AS (SELECT a, company, issuer, max(n) AS mn, max(v) AS mv FROM mo JOIN {SQL_ANCHORS}
             ON m <= a AND m >= a - INTERVAL 2 MONTH GROUP BY ALL),
    b12 AS (SELECT a, company, issuer, max(n) AS sz, max(m) FILTER (WHERE n = top) AS sm FROM (
             SELECT a, mo.*, max(n) OVER (PARTITION BY a, company, issuer) AS top FROM mo
             JOIN {SQL_ANCHORS} ON m <= a AND m >= a - INTERVAL 11 MONTH) GROUP BY ALL),
    d40 AS (SELECT a, company, issuer, count(DISTINCT worker) FILTER (WHERE pl) AS n_40d,
              max(d) AS l40 FROM c JOIN {SQL_ANCHORS} ON d <= CAST(a + INTERVAL 1 MONTH AS DATE) + 4
              AND d >= CAST(a + INTERVAL 1 MONTH AS DATE) + 4 - 39 GROUP BY ALL),
    dm AS (SELECT a, company, issuer, count(*) AS n_dormant FROM (SELECT a, company, issuer, worker
             FROM ca GROUP BY ALL
             HAVING {sql_month('max(d)')} = CAST(a - INTERVAL 3 MONTH AS DATE)) GROUP BY ALL),
    fi AS (SELECT {sql_month('f')} AS a, company, issuer, count(*) AS n_first FROM (
             SELECT company, issuer, worker, min(d) AS f FROM c WHERE pl GROUP BY ALL) GROUP BY ALL),
    sd AS (SELECT company, issuer, count(DISTINCT {MONTH}) AS seed, DATE '2000-04-01' AS smo FROM c
           WHERE pl AND d >= DATE '1999-05-01' AND d < DATE '2000-05-01' GROUP BY ALL),
    lt AS (SELECT company, CAST(date_trunc('month', d) - INTERVAL 1 MONTH AS DATE) AS a,
             sum(amount) AS late FROM c WHERE st = 'P' AND d IN (SELECT min(d) FROM c WHERE st = 'P'
             GROUP BY date_trunc('month', d)) GROUP BY ALL),
    ex(company, kind, lo, hi) AS (VALUES {SQL_EXCEPTIONS}),
    fl AS (SELECT sp.a, sp.company,
             max(CASE WHEN kind = 'outlier' THEN 1 ELSE 0 END) AS eo,
             max(CASE WHEN kind = 'project' THEN 1 ELSE 0 END) AS ep
           FROM sp LEFT JOIN ex ON ex.company = sp.company AND sp.a >= {sql_month('lo')}
             AND sp.a < {sql_month('hi')} GROUP BY ALL),
    j AS (SELECT sp.*, n_now, n_3m, n_txn_3m, mn, mv, sz, sm, n_40d, l40, coalesce(n_dormant, 0) AS n_dormant,
            coalesce(n_first, 0) AS n_first, seed, smo, late, eo, ep, datediff('month', {sql_month('fa')}, sp.a) + 1 AS age,
            lag({sql_month('lp')}) OVER w AS pl, lag(sp.a) OVER w AS pa,
            lag(seed, 1, 0) OVER w AS ps, coalesce(lag(mn, 1, 0) OVER w, 0) AS bop
          FROM sp LEFT JOIN r3 USING (a, company, issuer) LEFT JOIN b3 USING (a, company, issuer)
          LEFT JOIN b12 USING (a, company, issuer) LEFT JOIN d40 USING (a, company, issuer)
          LEFT JOIN dm USING (a, company, issuer) LEFT JOIN fi USING (a, company, issuer)
          LEFT JOIN sd USING (company, issuer) LEFT JOIN lt USING (a, company)
          JOIN fl USING (a, company) WINDOW w AS (PARTITION BY sp.company, sp.issuer ORDER BY sp.a)),
    k AS (SELECT *, CASE WHEN age IN (1, 2, 3) THEN coalesce(n_first, 0) ELSE 0 END AS nw,
            greatest(coalesce(mn, 0) - bop, 0) AS gain, least(coalesce(mn, 0) - bop, 0) AS churn,
            CASE WHEN fp IS NULL THEN 0
              WHEN datediff('month', {sql_month('lp')}, a) - CASE WHEN day(lp) > 1 THEN 1 ELSE 0 END
                   >= 12 THEN 0
              WHEN {sql_month('fp')} > a THEN 0
              WHEN fp < a AND a < DATE '1995-06-01' THEN 0
              WHEN a = {sql_month('fa')} THEN 1
              WHEN {sql_month('lp')} = a AND seed = 0 AND pl <> pa THEN 1
              WHEN seed IS NOT NULL AND a = smo THEN seed
              WHEN seed IS NULL AND {sql_month('lp')} = a AND pl IS NULL THEN 1
              WHEN seed IS NULL AND {sql_month('lp')} = a THEN 2
              ELSE coalesce(ps, 0) + datediff('month', smo, a) END AS act FROM j)
    SELECT a AS anchor_month, company, issuer, age, act AS months_active, n_ever, n_first, n_dormant, n_now,
           n_3m, n_txn_3m, mn AS max_n_workers, mv AS max_amount_plain, sz AS size_12m, sm AS size_month,
           n_40d, l40 AS last_credit_40d, CASE WHEN eo + ep > 0 THEN 0 ELSE nw END AS n_new,
           CASE WHEN eo + ep > 0 THEN 0 ELSE bop END AS bop_max_n_workers,
           CASE WHEN eo + ep > 0 THEN 0 ELSE gain END AS gain_max_n_workers,
           CASE WHEN eo + ep > 0 THEN 0 ELSE churn END AS churn_max_n_workers,
           gain - nw AS involuntary_max_n_workers, gain - nw + churn AS net_churn_max_n_workers,
           late AS late_amount, CASE WHEN coalesce(late, 0) > 0 THEN 1 ELSE 0 END AS is_late,
           eo AS in_outlier, ep AS in_project
    FROM k WHERE a >= DATE '2000-05-01'"""


FACT_COLUMNS = [
    "anchor_month", "company", "issuer", "age", "months_active", "n_ever", "n_first", "n_dormant", "n_now", "n_3m",
    "n_txn_3m", "max_n_workers", "max_amount_plain", "size_12m", "size_month", "n_40d", "last_credit_40d", "n_new",
    "bop_max_n_workers", "gain_max_n_workers", "churn_max_n_workers", "involuntary_max_n_workers",
    "net_churn_max_n_workers", "late_amount", "is_late", "in_outlier", "in_project",
]
SQL_FACT_HASH = sql_fingerprint(FACT_COLUMNS)
SQL_SHOWN = """* REPLACE (anchor_month::VARCHAR AS anchor_month, CAST(max_amount_plain AS DOUBLE) AS max_amount_plain,
           size_month::VARCHAR AS size_month, last_credit_40d::VARCHAR AS last_credit_40d,
           CAST(late_amount AS DOUBLE) AS late_amount)"""


@query("credit_fact", f"SELECT {SQL_SHOWN}, {SQL_FACT_HASH} AS row_hash FROM ({sql_credit()})")
def credit_fact_query(t: Tables):
    return credit_fact(*sample_inputs(t, t.orders), RUN, counting_from="1995-06-01", staged=True)
