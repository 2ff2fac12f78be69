"""What the jobs do with their results: loads into stored tables, run after run.

Each function takes the result of a job and the table's folder. The queries run two loads in a row, the
second on more data, and read the state back, fingerprints and stamps included.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidlake.functions import keys as key_functions
from braidlake.functions.dates import add_months, month_of, month_start
from braidlake.operators import money as mo, upsert
from braidlake.plans import credit_job, party_jobs, settlement_jobs
from braidlake.plans.registry import (
    NOW_TEXT, RUN, Tables, day, money, now, query, sql_fingerprint, sql_money, sql_month,
)
from braidlake.sources import lake, merge

FIRST_TEXT = "2000-05-15 12:00:00"


def first() -> Column:
    """Load time of the first of two loads."""
    return F.lit(FIRST_TEXT).cast("timestamp_ntz")


# ---- loads -----------------------------------------------------------------------------------


def load_credits(fact: DataFrame, path: str, run_month: dt.date | str, stamp: Column) -> merge.Merged:
    """Monthly credit fact: merged by month, company and issuer; only its two months are looked at."""
    window = [month_of(run_month), add_months(run_month, -1)]
    return merge.merge_partitions(
        fact, path, [credit_job.ANCHOR, *credit_job.KEYS], [credit_job.ANCHOR], "row_hash", stamp,
        scope=F.col(credit_job.ANCHOR).isin(window),
    )


def load_statement(month: DataFrame, path: str, keys: Sequence[str], stamp: Column) -> merge.Merged:
    """Balances of a month: merged by month and keys."""
    return merge.merge_partitions(month, path, [*keys, "month"], ["month"], "row_hash", stamp)


def load_vouchers(fact: DataFrame, path: str, run_date: dt.date | str) -> tuple[str, ...]:
    """Vouchers from the month before the run on take the place of all stored ones of that window."""
    start = add_months(dt.date.fromisoformat(str(run_date)) - dt.timedelta(days=1), -1)
    return merge.replace_partitions(fact, path, ["ref_month"], F.col("ref_month") >= F.lit(start))


def load_documents(docs: DataFrame, path: str, keys: Sequence[str], month: str, stamp: Column) -> merge.Merged:
    """Reimbursement documents: merged by document; one whose month has changed moves to its partition."""
    return merge.merge_partitions(docs, path, keys, [month], "row_hash", stamp)


def load_contacts(ranked: DataFrame, path: str, stamp: Column) -> merge.Merged:
    """Contacts by person, origin and position; only those that differ from what was stored are merged."""
    changed = key_functions.differs_by_sentinel(F.col("row_hash"), F.col("stored_hash"))
    rows = ranked.filter(changed).drop("stored_hash").withColumn("is_active", F.lit(1))
    return merge.merge_partitions(rows, path, ["person", "origin", "position"], ["origin"], "row_hash", stamp)


def load_accounts(
    accounts: DataFrame, path: str, keys: Sequence[str], tracked: Sequence[str], described: Sequence[str], stamp: Column
) -> None:
    """Type-2 account dimension: the new state takes the old one's place at once.

    Key parts may be absent; absent and '' are the same account.
    """
    spark = accounts.sparkSession
    plain = accounts.withColumns({k: F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys})
    hashed = plain.withColumn("row_hash", key_functions.fingerprint([*keys, *described], upper=True))
    root, fs = lake._path(spark, path)
    if fs.exists(root):
        stored = lake.read(spark, path)
    else:
        empty = {
            "sk": "bigint", **dict.fromkeys(keys, "string"), **{f.name: f.dataType for f in plain.schema if f.name in described},
            "row_hash": "string", "is_active": "int",
            **dict.fromkeys(("valid_from", "valid_to", "inserted_at", "changed_at"), "timestamp_ntz"),
        }
        stored = spark.range(0).select(*[F.lit(None).cast(t).alias(c) for c, t in empty.items()])
    lake.replace_table(upsert.upsert_scd2(stored, hashed, keys, tracked, "row_hash", stamp), path)


# ---- two loads in a row on the sample tables -------------------------------------------------

SQL_STAMPS = """CASE WHEN e.row_hash IS NULL THEN '{now}' ELSE '{first}' END AS inserted_at,
    CASE WHEN e.row_hash IS NULL OR e.row_hash <> f.row_hash THEN '{now}' ELSE '{first}' END AS changed_at""".format(
    now=NOW_TEXT, first=FIRST_TEXT
)


@query(
    "merge_partitions",
    f"""
    WITH s AS (SELECT o_orderkey AS id, o_custkey AS custkey, {sql_money('o_totalprice')} AS amount,
                 {sql_month('o_orderdate')} AS m FROM orders WHERE o_orderdate < DATE '2000-07-01'),
    e AS (SELECT *, {sql_fingerprint(['id', 'custkey', 'amount', 'm'])} AS row_hash FROM s WHERE m < DATE '2000-06-01'),
    f AS (SELECT id, custkey, n.amount, n.m, {sql_fingerprint(['id', 'custkey', 'n.amount', 'n.m'])} AS row_hash
          FROM (SELECT id, custkey, CAST(CASE WHEN id % 7 = 0 THEN amount + 1 ELSE amount END AS DECIMAL(18,2)) AS amount,
                  CAST(CASE WHEN id % 11 = 0 THEN m + INTERVAL 1 MONTH ELSE m END AS DATE) AS m
                FROM s WHERE m >= DATE '2000-04-01') n),
    u AS (SELECT f.id, f.custkey, f.amount, f.m, f.row_hash, {SQL_STAMPS} FROM f LEFT JOIN e ON e.id = f.id
          UNION ALL
          SELECT id, custkey, amount, m, row_hash, '{FIRST_TEXT}', '{FIRST_TEXT}' FROM e WHERE m < DATE '2000-04-01')
    SELECT id, custkey, CAST(amount AS DOUBLE) AS amount, m::VARCHAR AS month, row_hash, inserted_at, changed_at FROM u
    """,
)
def merge_partitions_query(t: Tables):
    # Orders by month; later some have another amount, some another month, and a month is added.
    described = ["id", "custkey", "amount", "month"]
    amount, month, no = money("o_totalprice"), month_start("o_orderdate"), F.col("o_orderkey")
    base = t.orders.filter("o_orderdate < '2000-07-01'").select(
        no.alias("id"), F.col("o_custkey").alias("custkey"), amount.alias("amount"), month.alias("month")
    )

    def hashed(df: DataFrame) -> DataFrame:
        return df.withColumn("row_hash", key_functions.fingerprint(described)).withColumn("year", F.year("month"))

    path = lake.scratch(t.spark, "orders_by_year")
    merge.merge_partitions(hashed(base.filter("month < '2000-06-01'")), path, ["id"], ["year"], "row_hash", first())
    later = base.filter("month >= '2000-04-01'").withColumns(
        {
            "amount": F.when(F.col("id") % 7 == 0, F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(18,2)"),
            "month": F.when(F.col("id") % 11 == 0, F.add_months("month", 1)).otherwise(F.col("month")),
        }
    )
    merge.merge_partitions(
        hashed(later), path, ["id"], ["year"], "row_hash", now(), scope=F.col("year") >= 2000
    )
    return lake.read(t.spark, path).drop("year")


@query(
    "credit_load",
    f"""
    WITH e AS (SELECT *, {credit_job.SQL_FACT_HASH} AS row_hash FROM ({credit_job.sql_credit('o_orderkey % 9 <> 0')})),
    f AS (SELECT *, {credit_job.SQL_FACT_HASH} AS row_hash FROM ({credit_job.sql_credit()}))
    SELECT f.{credit_job.SQL_SHOWN.replace('(', '(f.', 1)
              .replace('CAST(max', 'CAST(f.max').replace('size_month::', 'f.size_month::')
              .replace('last_credit_40d::', 'f.last_credit_40d::').replace('CAST(late', 'CAST(f.late')},
           {SQL_STAMPS}
    FROM f LEFT JOIN e ON e.anchor_month = f.anchor_month AND e.company = f.company AND e.issuer = f.issuer
    """,
)
def credit_load(t: Tables):
    path = lake.scratch(t.spark, "credits")
    for orders, stamp in ((t.orders.filter("o_orderkey % 9 <> 0"), first()), (t.orders, now())):
        fact = credit_job.credit_fact(
            *credit_job.sample_inputs(t, orders), RUN, counting_from="1995-06-01", staged=True
        )
        load_credits(fact, path, RUN, stamp)
    return lake.read(t.spark, path)


STATEMENT_KEYS = ["company", "product"]
SQL_BALANCE = sql_fingerprint(["opening", *settlement_jobs.COMPONENTS, "closing"])


def _sql_balance(moved: str, before: str, month: str) -> str:
    """Rows of a month: the balance before and the month's movement."""
    zero = ", ".join(f"CAST(coalesce({c}, 0) AS DECIMAL(38,2)) AS {c}" for c in (*settlement_jobs.COMPONENTS, "movement"))
    return f"""SELECT *, {SQL_BALANCE} AS row_hash FROM (SELECT company, product, DATE '{month}' AS month,
        CAST(coalesce(b.closing, 0) AS DECIMAL(38,2)) AS opening, {zero},
        CAST(coalesce(b.closing, 0) + coalesce(movement, 0) AS DECIMAL(38,2)) AS closing
        FROM (SELECT company, product, closing FROM {before}) b FULL OUTER JOIN (SELECT * FROM {moved} WHERE month = DATE '{month}') v USING (company, product))"""


@query(
    "statement_load",
    f"""
    WITH {settlement_jobs.sql_statement()}, {settlement_jobs.sql_statement('l_linenumber <= 4', '_e')},
    apr AS (SELECT company, product, sum(movement) AS closing FROM moved WHERE month < DATE '2000-05-01' GROUP BY 1, 2),
    e AS ({_sql_balance('moved_e', 'apr', '2000-05-01')}),
    may AS ({_sql_balance('moved', 'apr', '2000-05-01')}),
    june AS ({_sql_balance('moved', 'may', '2000-06-01')}),
    f AS (SELECT * FROM may UNION ALL SELECT * FROM june)
    SELECT f.company, f.product, f.month::VARCHAR AS month, f.row_hash,
           {', '.join(f'CAST(f.{c} AS DOUBLE) AS {c}' for c in ('opening', *settlement_jobs.COMPONENTS, 'movement', 'closing'))},
           {SQL_STAMPS}
    FROM f LEFT JOIN e ON e.company = f.company AND e.product = f.product AND e.month = f.month
    """,
)
def statement_load(t: Tables):
    # May is loaded while lines are missing, then again with all of them, then June on top of it.
    lines = settlement_jobs.settlement_lines(t)
    parts = settlement_jobs.statement_parts()
    keys = [*STATEMENT_KEYS, "month"]

    def moved(df: DataFrame) -> DataFrame:
        return mo.routed_statement([(df, parts, {k: F.col(k) for k in keys})], keys, within=["doc"])

    with_all = lake.stage(moved(lines), "moved")
    may, june = add_months(RUN, -1), month_of(RUN)
    before = (
        with_all.filter(F.col("month") < F.lit(may)).groupBy(*STATEMENT_KEYS)
        .agg(F.sum("movement").cast("decimal(38,2)").alias("closing"))
        .withColumn("month", F.lit(add_months(may, -1)))
    )
    before = lake.stage(before, "before")
    path = lake.scratch(t.spark, "statement")

    def load(previous: DataFrame, movement: DataFrame, month: dt.date, stamp: Column) -> None:
        own = movement.filter(F.col("month") == F.lit(month)).drop("month")
        rows = settlement_jobs.statement_month(previous, own, settlement_jobs.COMPONENTS, STATEMENT_KEYS, month)
        load_statement(rows, path, STATEMENT_KEYS, stamp)

    load(before, moved(lines.filter("line <= 4")), may, first())
    load(before, with_all, may, now())
    stored = lake.read(t.spark, path).filter(F.col("month") == F.lit(may)).select(*STATEMENT_KEYS, "month", "closing")
    load(stored, with_all, june, now())
    return lake.read(t.spark, path)


VOUCHER_COLUMNS = ["voucher", "trans_id", "first_paid", "amount", "advance_voucher", "purchase_voucher", "ref_month"]


def _sql_vouchers(start: str, billed: str) -> str:
    return f"""SELECT *, {sql_fingerprint(VOUCHER_COLUMNS, upper=True)} AS row_hash FROM (
        SELECT o_orderkey AS voucher, lpad(o_orderkey::VARCHAR, 10, '0') AS trans_id, CAST(o_orderdate AS DATE) AS first_paid,
               {sql_money('o_totalprice')} AS amount, ant AS advance_voucher,
               CASE WHEN ant IS NOT NULL THEN cmp END AS purchase_voucher, {sql_month('o_orderdate')} AS ref_month
        FROM orders LEFT JOIN links ON k = o_orderkey
        WHERE o_orderdate >= DATE '{start}' AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE {billed}))"""


@query(
    "voucher_load",
    f"""
    WITH links AS (SELECT l_orderkey AS k, max(l_partkey) FILTER (WHERE l_returnflag = 'R') AS ant,
                     max(l_partkey) FILTER (WHERE l_returnflag = 'A') AS cmp FROM lineitem GROUP BY 1),
    e AS ({_sql_vouchers('2000-03-01', "l_linestatus = 'O' AND l_linenumber = 1")}),
    f AS ({_sql_vouchers('2000-04-01', "l_linestatus = 'O'")}),
    u AS (SELECT * FROM e WHERE ref_month < DATE '2000-04-01' UNION ALL SELECT * FROM f)
    SELECT * REPLACE (first_paid::VARCHAR AS first_paid, CAST(amount AS DOUBLE) AS amount, ref_month::VARCHAR AS ref_month)
    FROM u
    """,
)
def voucher_load(t: Tables):
    path = lake.scratch(t.spark, "vouchers")
    early = F.col("l_linenumber") == 1
    for run_date, billed in ((add_months(RUN, -1), early), (RUN, F.lit(True))):
        vouchers, billing, links = settlement_jobs.voucher_inputs(t, billed)
        load_vouchers(settlement_jobs.voucher_fact(vouchers, billing, links, run_date), path, run_date)
    return lake.read(t.spark, path)


DOCUMENT_COLUMNS = ["doc", "account", "paid", "mdr", "advance", "revenue", "operator", "requester"]


def _sql_documents(where: str, paid: str) -> str:
    money_ = "CAST({0} AS DECIMAL(38,4))"
    return f"""SELECT *, {sql_fingerprint(DOCUMENT_COLUMNS)} AS row_hash, CAST(date_trunc('month', paid) AS DATE) AS month FROM (
      SELECT d.doc, d.account, paid, {money_.format('coalesce(mdr, 0)')} AS mdr, {money_.format('coalesce(advance, 0)')} AS advance,
             {money_.format('coalesce(mdr, 0) + coalesce(advance, 0)')} AS revenue, c.operator, coalesce(di.r, ind.r) AS requester
      FROM (SELECT o_orderkey AS doc, o_custkey AS account, {paid} AS paid FROM orders) d
      LEFT JOIN (SELECT l_orderkey AS doc, sum({sql_money('l_extendedprice')}) FILTER (WHERE l_linestatus = 'F') AS mdr,
            sum({sql_money('l_extendedprice')}) FILTER (WHERE l_returnflag = 'A') AS advance FROM lineitem WHERE {where} GROUP BY 1) p
        ON p.doc = d.doc
      ASOF LEFT JOIN (SELECT o_custkey AS account, CAST(o_orderdate AS DATE) AS effective, max(o_orderkey) AS operator
            FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2) c
        ON c.account = d.account AND d.paid >= c.effective
      LEFT JOIN (SELECT l_orderkey AS doc, max(l_suppkey) AS r FROM lineitem
                 WHERE l_returnflag = 'R' AND l_linenumber = 1 AND {where} GROUP BY 1) di ON di.doc = d.doc
      LEFT JOIN (SELECT l_orderkey AS doc, arg_min(l_suppkey, (l_shipdate, l_suppkey)) AS r FROM lineitem
                 WHERE l_returnflag = 'N' AND {where} GROUP BY 1) ind ON ind.doc = d.doc)"""


@query(
    "reimbursement_load",
    f"""
    WITH e AS ({_sql_documents('l_linenumber <= 3', "CAST(CASE WHEN o_orderkey % 13 = 0 THEN CAST(o_orderdate AS DATE) - 40 ELSE o_orderdate END AS DATE)")}),
    f AS ({_sql_documents('TRUE', 'CAST(o_orderdate AS DATE)')})
    SELECT f.doc, f.account, f.paid::VARCHAR AS paid, CAST(f.mdr AS DOUBLE) AS mdr, CAST(f.advance AS DOUBLE) AS advance,
           CAST(f.revenue AS DOUBLE) AS revenue, f.operator, f.requester, f.row_hash, f.month::VARCHAR AS month, {SQL_STAMPS}
    FROM f LEFT JOIN e ON e.doc = f.doc
    """,
)
def reimbursement_load(t: Tables):
    # First the documents with three lines at most and some payment dates still to be moved.
    path = lake.scratch(t.spark, "documents")
    ordered = day("o_orderdate")
    planned = F.when(F.col("o_orderkey") % 13 == 0, F.date_sub(ordered, 40)).otherwise(ordered)
    for lines, paid, stamp in ((t.lineitem.filter("l_linenumber <= 3"), planned, first()), (t.lineitem, ordered, now())):
        docs = settlement_jobs.documents(t, lines, paid).select(*DOCUMENT_COLUMNS)
        hashed = docs.withColumns(
            {"row_hash": key_functions.fingerprint(DOCUMENT_COLUMNS), "month": month_start("paid"), "year": F.year("paid")}
        )
        load_documents(hashed, path, ["doc"], "year", stamp)
    return lake.read(t.spark, path).drop("year")


CONTACT_TEXT = [
    "person", "document", "name", "email", "land_area", "land_number", "mobile_area", "mobile_number", "created",
    "origin", "position", "is_current",
]


def _sql_contacts(name: str, rows: str) -> str:
    return f"""{name} AS (SELECT *, {sql_fingerprint(CONTACT_TEXT, upper=True)} AS row_hash FROM (
        SELECT person, lpad(person::VARCHAR, 11, '0') AS document, name, email, '' AS land_area, '' AS land_number,
               area AS mobile_area, number AS mobile_number, created, origin, is_current,
               row_number() OVER (PARTITION BY person, origin ORDER BY created DESC, is_current DESC, name DESC,
                   email DESC, area, number) AS position FROM ({rows})))"""


@query(
    "contact_load",
    f"""
    WITH web AS (SELECT user_id AS person, 'USER ' || user_id AS name, event_type || '@web.test' AS email,
                   max(ts) AS created FROM events GROUP BY user_id, event_type),
    k AS (SELECT c_custkey AS person, upper(c_name) AS name, lower(c_name) || '@mail.test' AS email,
                 (11 + c_nationkey)::VARCHAR AS area, lpad(c_custkey::VARCHAR, 9, '9') AS number,
                 TIMESTAMP '2000-01-01' AS created, 'registry' AS origin FROM customer WHERE c_acctbal > 0
          UNION ALL SELECT person, name, email, '', '', created, 'web' FROM web JOIN customer ON c_custkey = person),
    old AS (SELECT * FROM k WHERE email <> 'view@web.test' AND person % 5 <> 0),
    cur AS (SELECT * FROM k WHERE email <> 'click@web.test'),
    {_sql_contacts('e', 'SELECT *, 1 AS is_current FROM old')},
    {_sql_contacts('f', '''SELECT *, 1 AS is_current FROM cur UNION ALL SELECT old.*, 0 FROM old ANTI JOIN cur
        ON cur.person = old.person AND cur.email = old.email AND cur.origin = old.origin''')}
    SELECT f.person, f.document, f.name, f.email, f.land_area, f.land_number, f.mobile_area, f.mobile_number,
           CAST(f.created AS VARCHAR) AS created, f.origin, f.position, f.is_current, f.row_hash, 1 AS is_active, {SQL_STAMPS}
    FROM f LEFT JOIN e ON e.person = f.person AND e.origin = f.origin AND e.position = f.position
    """,
)
def contact_load(t: Tables):
    # In the second load the contacts of clicks are gone, those of views and of some people are new.
    sources, people, _ = party_jobs.contact_inputs(t)
    path = lake.scratch(t.spark, "contacts")
    email, who = F.col("email"), F.col("document").cast("long")
    old = {n: df.filter((email != "view@web.test") & (who % 5 != 0)) for n, df in sources.items()}
    new = {n: df.filter(email != "click@web.test") for n, df in sources.items()}
    flags = {"registry": "in_registry", "web": None}
    blank = {c: "string" for c in ["document", "name", *party_jobs.CONTACT_KEYS[1:], "row_hash"]}
    nothing = t.spark.range(0).select(
        F.col("id").alias("person"), *[F.lit(None).cast(v).alias(c) for c, v in blank.items()],
        F.lit(None).cast("timestamp_ntz").alias("created"),
    )
    load_contacts(party_jobs.contact_dimension(old, people, nothing, flags), path, first())
    load_contacts(party_jobs.contact_dimension(new, people, lake.read(t.spark, path), flags), path, now())
    return lake.read(t.spark, path)


ACCOUNT_KEYS = ["account", "origin"]
ACCOUNT_DESCRIBED = ["holder", "segment", "first_credit", "first_amount"]
SQL_ACCOUNT_HASH = sql_fingerprint([*ACCOUNT_KEYS, *ACCOUNT_DESCRIBED], upper=True)


def _sql_accounts(name: str, orders: str, segment: str, suppliers: str) -> str:
    return f"""{name} AS (WITH fc AS (SELECT o_custkey AS k, CAST(min(o_orderdate) AS DATE) AS d FROM orders WHERE {orders} GROUP BY 1),
      am AS (SELECT k, d, max(CAST(o_totalprice AS DECIMAL(11,2))) AS a FROM fc JOIN orders
             ON o_custkey = k AND CAST(o_orderdate AS DATE) = d WHERE {orders} GROUP BY 1, 2)
      SELECT *, {SQL_ACCOUNT_HASH} AS row_hash FROM (
        SELECT c_custkey::VARCHAR AS account, 'customer' AS origin, c_name AS holder, {segment} AS segment,
               d AS first_credit, a AS first_amount FROM customer LEFT JOIN am ON k = c_custkey
        UNION ALL SELECT CASE WHEN s_suppkey = 1 THEN '' ELSE s_suppkey::VARCHAR END, 'supplier', s_name, NULL, d, a FROM supplier
        LEFT JOIN am ON k = CASE WHEN s_suppkey = 1 THEN NULL ELSE s_suppkey END WHERE {suppliers}))"""


def _sql_numbers(name: str, rows: str, start: str) -> str:
    return f"""{name} AS (SELECT account, origin, ({start}) + b + 1 + 4096 * (row_number() OVER (PARTITION BY b ORDER BY account, origin) - 1) AS sk
        FROM (SELECT account, origin, ('0x' || substr(md5(account || '|' || origin), 1, 8))::BIGINT % 4096 AS b FROM {rows}))"""


@query(
    "account_load",
    f"""
    WITH {_sql_accounts('e', "o_orderdate < DATE '1998-01-01'", "CASE WHEN c_custkey % 17 = 0 THEN 'OLD' ELSE c_mktsegment END", 's_suppkey % 5 <> 0')},
    {_sql_accounts('f', 'TRUE', 'c_mktsegment', 'TRUE')},
    {_sql_numbers('n1', 'e', '0')},
    {_sql_numbers('n2', '(SELECT * FROM f ANTI JOIN e USING (account, origin))', 'SELECT max(sk) FROM n1')},
    c AS (SELECT f.*, CASE WHEN e.account IS NULL THEN 'insert' WHEN e.row_hash = f.row_hash THEN 'keep'
                 WHEN e.segment IS DISTINCT FROM f.segment THEN 'version' ELSE 'update' END AS step
          FROM f LEFT JOIN e USING (account, origin)),
    u AS (
      SELECT sk, account, origin, CASE WHEN step = 'update' THEN c.holder ELSE e.holder END AS holder,
             CASE WHEN step = 'update' THEN c.segment ELSE e.segment END AS segment,
             CASE WHEN step = 'update' THEN c.first_credit ELSE e.first_credit END AS first_credit,
             CASE WHEN step = 'update' THEN c.first_amount ELSE e.first_amount END AS first_amount,
             CASE WHEN step = 'update' THEN c.row_hash ELSE e.row_hash END AS row_hash,
             CASE WHEN step = 'version' THEN 0 ELSE 1 END AS is_active, '2000-05-14 12:00:00' AS valid_from,
             CASE WHEN step = 'version' THEN '2000-06-14 12:00:00' END AS valid_to, '{FIRST_TEXT}' AS inserted_at,
             CASE WHEN step = 'keep' THEN '{FIRST_TEXT}' ELSE '{NOW_TEXT}' END AS changed_at
      FROM e JOIN n1 USING (account, origin) JOIN c USING (account, origin)
      UNION ALL
      SELECT coalesce(n1.sk, n2.sk), account, origin, holder, segment, first_credit, first_amount, row_hash, 1,
             '2000-06-14 12:00:00', NULL, '{NOW_TEXT}', '{NOW_TEXT}'
      FROM c LEFT JOIN n1 USING (account, origin) LEFT JOIN n2 USING (account, origin) WHERE step IN ('insert', 'version'))
    SELECT * REPLACE (first_credit::VARCHAR AS first_credit, CAST(first_amount AS DOUBLE) AS first_amount) FROM u
    """,
)
def account_load(t: Tables):
    # First with the credits up to 1998, some old segments and most suppliers; one account has no number.
    path = lake.scratch(t.spark, "accounts")
    segment = F.when(F.col("c_custkey") % 17 == 0, "OLD").otherwise(F.col("c_mktsegment"))
    runs = (
        (t.orders.filter("o_orderdate < '1998-01-01'"), segment, F.col("s_suppkey") % 5 != 0, first()),
        (t.orders, F.col("c_mktsegment"), F.lit(True), now()),
    )
    for orders, own, some, stamp in runs:
        customers = t.customer.select(F.col("c_custkey").alias("account"), F.col("c_name").alias("holder"), own.alias("segment"))
        suppliers = t.supplier.filter(some).select(
            F.when(F.col("s_suppkey") != 1, F.col("s_suppkey")).alias("account"), F.col("s_name").alias("holder")
        )
        credits = orders.select(
            F.col("o_custkey").alias("account"), day("o_orderdate").alias("d"),
            F.col("o_totalprice").cast("decimal(11,2)").alias("amount"),
        )
        accounts = party_jobs.account_dimension({"customer": customers, "supplier": suppliers}, credits, "account", "d", "amount")
        load_accounts(accounts, path, ACCOUNT_KEYS, ["segment"], ACCOUNT_DESCRIBED, stamp)
    return lake.read(t.spark, path)
