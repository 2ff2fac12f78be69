"""Reimbursement documents and transactions, vouchers and the monthly balance statement."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidlake.functions import keys as key_functions
from braidlake.functions.dates import add_months, month_start
from braidlake.functions.text import pad_concat
from braidlake.operators import asof, money as mo, select, upsert
from braidlake.plans.registry import RUN, Tables, day, money, query, sql_money, sql_month

# ---- transactions of reimbursement documents ------------------------------------------------


def reimbursement_transactions(
    docs: DataFrame,
    lines: DataFrame,
    parts: Sequence[mo.Part],
    columns: Sequence[str],
    addresses: DataFrame,
    keys: Sequence[str],
    party: str,
    shares: Mapping[str, tuple[str, Sequence[str]]],
    revenue: Sequence[str],
) -> DataFrame:
    """Consumption and reversal rows with their part of the document totals and their revenue.

    ``parts`` say which lines feed which kind, with the columns of sentinel issuers; lines are read
    once and keep the given columns. ``addresses`` hold any number of
    addresses per party, with ``is_primary`` and ``position``; the primary one is used. The
    reversal amount of a document is stored positive and compared with its negative.
    """
    primary = select.latest_by(
        addresses, [party], [F.desc("is_primary"), F.asc("position")]
    ).drop("is_primary", "position")
    stacked = mo.fan_out(lines, parts, {c: F.col(c) for c in columns}, "kind", "amount", "decimal(18,2)")
    signed = docs.withColumn("_reversal", -F.col("reversal"))
    shared = mo.allocate(signed, stacked, keys, "amount", shares, reversal="_reversal")
    total = reduce(lambda a, b: a + b, [F.coalesce(f"alloc_{m}", F.lit(0)) for m in revenue])
    return shared.withColumn("revenue", total).drop("_reversal").join(primary, party, "left")


# ---- reimbursement documents ----------------------------------------------------------------


def reimbursement_documents(
    docs: DataFrame,
    parts: Mapping[str, tuple[DataFrame, Column]],
    configs: DataFrame,
    direct: DataFrame,
    indirect: DataFrame,
    indirect_order: Sequence[Column],
    keys: Sequence[str] = ("doc",),
) -> DataFrame:
    """Documents with their revenue parts, the operator in force and who asked for an advance.

    ``configs`` (account, effective, seq, operator) are looked up as of each document's own paid
    date. ``direct`` and ``indirect`` (keys, requester) are requests for the document and for one
    of its vouchers; direct ones win.
    """
    valued = mo.revenue_breakdown(docs, parts, keys)
    operated = asof.asof_latest(
        valued, configs, ["account"], "paid", "effective", ["operator"], ["seq"]
    )
    asked = select.prefer_direct(direct, indirect, keys, indirect_order)
    # Several direct requests for one document collapse to one value.
    asked = asked.groupBy(*keys).agg(F.max("requester").alias("requester"))
    return operated.join(asked, list(keys), "left")


# ---- vouchers -------------------------------------------------------------------------------


def voucher_fact(
    vouchers: DataFrame, billing: DataFrame, links: DataFrame, run_date: dt.date | str
) -> DataFrame:
    """Billed vouchers from the month before the run on, with their advance and purchase links.

    ``links`` (voucher, kind, other) hold one advance (ANT) and one purchase (CMP) voucher per
    voucher; both come from one grouping. The day before ``run_date`` decides the window.
    """
    start = add_months(dt.date.fromisoformat(str(run_date)) - dt.timedelta(days=1), -1)
    linked = links.groupBy("voucher").agg(
        F.max(F.when(F.col("kind") == "ANT", F.col("other"))).alias("advance_voucher"),
        F.max(F.when(F.col("kind") == "CMP", F.col("other"))).alias("purchase_voucher"),
    )
    # A purchase is only looked up through an advance.
    linked = linked.filter(F.col("advance_voucher").isNotNull())
    billed = billing.select("trans_id").distinct()
    recent = vouchers.filter(F.col("first_paid") >= F.lit(start))
    out = (
        recent.join(billed, "trans_id", "left_semi")
        .join(linked, "voucher", "left")
        .withColumn("ref_month", month_start("first_paid"))
    )
    return out.withColumn("row_hash", key_functions.fingerprint(out.columns, upper=True))


def load_vouchers(stored: DataFrame, fact: DataFrame, run_date: dt.date | str) -> DataFrame:
    """Stored vouchers with the window reloaded."""
    start = add_months(dt.date.fromisoformat(str(run_date)) - dt.timedelta(days=1), -1)
    return upsert.reload_window(stored, fact, "ref_month", start)


# ---- monthly statement ----------------------------------------------------------------------


def statement_month(
    previous: DataFrame,
    moved: DataFrame,
    components: Sequence[str],
    keys: Sequence[str],
    run_month: dt.date,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Balances of the run month: movement by component, opening, closing and fingerprint.

    ``moved`` is the month's statement (keys, components, movement), ``previous`` holds the balances of the
    month before (keys, month, closing). With ``stored`` (keys, month, row_hash) only rows that differ
    from it are returned, ready for a merge.
    """
    moved = moved.withColumn("month", F.lit(run_month))
    prev = previous.select(*keys, F.add_months("month", 1).alias("month"), "closing")
    both = prev.join(moved, [*keys, "month"], "full")
    zero = F.lit(0).cast("decimal(38,2)")
    out = both.select(
        *keys, "month",
        F.coalesce("closing", zero).alias("opening"),
        *[F.coalesce(c, zero).alias(c) for c in [*components, "movement"]],
        (F.coalesce("closing", zero) + F.coalesce("movement", zero)).alias("closing"),
    )
    figures = ["opening", *components, "closing"]
    out = out.withColumn("row_hash", key_functions.fingerprint(figures))
    if stored is None:
        return out
    return out.join(stored.select(*keys, "month", "row_hash"), [*keys, "month", "row_hash"], "left_anti")


COMPONENTS = (
    "gross", "reversed", "confirmed", "debit", "credit", "billed", "operating_fee", "sva",
    "purchases", "passed_on", "advance_fee", "urgent",
)


def statement_parts() -> list[mo.Part]:
    """Which settlement lines feed which component, in which month and with which sign.

    Lines hold a document's party, product and months of creation and payment beside their own code,
    payment, note and amounts. Payments and debit adjustments count once per document; a debit
    adjustment that another line of the document bills with the same amount does not count at all;
    of a note the largest amount counts; what is passed on belongs to the cut-off month. Units are those of
    a document: settle them within it.
    """
    code, own = F.col("code"), F.col("is_own")
    paid, cut = {"month": F.col("paid_month")}, {"month": F.add_months("paid_month", 1), "product": F.lit("PASSED")}
    return [
        mo.Part("gross", code != "R", F.col("amount")),
        mo.Part("reversed", (code == "R") & own, -F.col("amount")),
        mo.Part(
            "confirmed", (code == "N") & (F.col("line") <= 2), F.col("amount"), -1, paid,
            F.concat_ws("|", "paid", "amount"), "max",
        ),
        mo.Part(
            "debit", code == "A", F.col("adjustment"), -1, unit=F.concat_ws("|", "adjustment"),
            per_unit="max", unless=code == "N",
        ),
        mo.Part("credit", F.col("discount") >= F.lit("0.08").cast("decimal(4,2)"), -F.col("rebate"), -1),
        mo.Part("billed", ~own, F.col("fee"), -1, unit=F.concat_ws("|", "note"), per_unit="max"),
        mo.Part("operating_fee", F.col("line") == 1, F.col("fee"), 1, paid),
        mo.Part("sva", F.col("item") % 7 == 0, F.col("rebate"), -1, paid),
        mo.Part("purchases", (F.col("item") % 5 == 0) & own, F.col("amount"), -1, paid),
        mo.Part("passed_on", F.col("shop") % 9 == 0, F.col("amount"), 1, cut),
        mo.Part("advance_fee", (code == "A") & own, F.col("fee"), -1, paid),
        mo.Part("urgent", F.col("adjustment") > 45, F.col("amount"), -1, paid),
    ]


# ---- registered on the sample tables --------------------------------------------------------

PRICE = sql_money("l_extendedprice")
TOTAL = sql_money("o_totalprice")


@query(
    "reimbursement_transactions",
    f"""
    WITH d AS (SELECT o_orderkey AS doc, o_custkey AS party, {TOTAL} AS net,
                 CAST(((CAST({TOTAL} * 100 AS BIGINT) + 50) // 100) AS DOUBLE) / 100 AS fee, gross, own, reversal
               FROM orders JOIN (SELECT l_orderkey k, sum({PRICE}) AS gross,
                   sum({PRICE}) FILTER (WHERE l_linestatus = 'O') AS own,
                   max({PRICE}) FILTER (WHERE l_returnflag = 'R') AS reversal
                 FROM lineitem GROUP BY 1) ON k = o_orderkey),
    t AS (SELECT l_orderkey AS doc, l_linenumber AS line, l_partkey AS part, l_suppkey AS shop,
            'Consumo' AS kind, {PRICE} AS amount FROM lineitem
            WHERE l_returnflag <> 'R' AND l_linestatus = 'O'
          UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, -99, 'Consumo', {PRICE}
            FROM lineitem WHERE l_returnflag <> 'R' AND l_linestatus <> 'O'
          UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'Estorno', -1 * {PRICE}
            FROM lineitem WHERE l_returnflag = 'R'),
    x AS (SELECT *, CAST(amount * 100 AS HUGEINT) AS ac, CAST(gross * 100 AS HUGEINT) AS gc,
            CAST(own * 100 AS HUGEINT) AS oc FROM t JOIN d USING (doc)),
    y AS (SELECT *, CASE WHEN -reversal = amount THEN 0::HUGEINT ELSE
              sign(ac) * ((2 * abs(ac) * 1000000000000 + gc) // (2 * gc)) END AS sh,
            CASE WHEN -reversal = amount THEN 0::HUGEINT ELSE
              sign(ac) * ((2 * abs(ac) * 1000000000000 + oc) // (2 * nullif(oc, 0))) END AS so FROM x),
    z AS (SELECT *, CAST(sign(sh) * ((2 * abs(sh) * CAST(net * 100 AS HUGEINT) + 1000000000)
              // 2000000000) AS HUGEINT) AS an,
            CAST(sign(so) * ((2 * abs(so) * CAST(round(fee * 100) AS HUGEINT) + 1000000000) // 2000000000)
              AS HUGEINT) AS af FROM y)
    SELECT doc, line, part, shop, kind, CAST(amount AS DOUBLE) AS amount,
           CAST(sh AS DOUBLE) / 1000000000000 AS share, CAST(so AS DOUBLE) / 1000000000000
           AS share_own, CAST(an AS DOUBLE) / 100000 AS alloc_net,
           CAST(af AS DOUBLE) / 100000 AS alloc_fee,
           CAST(coalesce(an, 0) + coalesce(af, 0) AS DOUBLE) / 100000 AS revenue, city
    FROM z LEFT JOIN (SELECT o_custkey AS who, arg_min('city-' || (o_orderkey % 97)::VARCHAR,
               (CASE WHEN {TOTAL} > 100000 THEN 0 ELSE 1 END, o_orderkey)) AS city
        FROM orders GROUP BY 1) ON who = party
    """,
)
def reimbursement_transactions_query(t: Tables):
    price = money("l_extendedprice")
    sums = t.lineitem.groupBy(F.col("l_orderkey").alias("doc")).agg(
        F.sum(price).alias("gross"),
        F.sum(F.when(F.col("l_linestatus") == "O", price)).alias("own"),
        F.max(F.when(F.col("l_returnflag") == "R", price)).alias("reversal"),
    )
    docs = t.orders.select(
        F.col("o_orderkey").alias("doc"), F.col("o_custkey").alias("party"),
        money("o_totalprice").alias("net"),
        F.round(money("o_totalprice") / 100, 2).cast("decimal(18,2)").alias("fee"),
    ).join(sums, "doc")
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("shop"), price.alias("amount"),
        "l_returnflag", "l_linestatus",
    )

    returned = F.col("l_returnflag") == "R"
    own = F.col("l_linestatus") == "O"
    foreign = {"shop": F.lit(-99).cast("bigint")}
    parts = [
        mo.Part("Consumo", ~returned & own, F.col("amount")),
        mo.Part("Consumo", ~returned & ~own, F.col("amount"), columns=foreign),
        mo.Part("Estorno", returned, F.col("amount"), -1),
    ]
    # One address per order of a customer; those of large orders count as main ones.
    addresses = t.orders.select(
        F.col("o_custkey").alias("party"),
        F.concat(F.lit("city-"), F.col("o_orderkey") % 97).alias("city"),
        F.when(money("o_totalprice") > 100000, 1).otherwise(0).alias("is_primary"),
        F.col("o_orderkey").alias("position"),
    )
    return reimbursement_transactions(
        docs, lines, parts, ["doc", "line", "part", "shop"], addresses, ["doc"], "party",
        {"share": ("gross", ["net"]), "share_own": ("own", ["fee"])}, ["net", "fee"],
    ).select(
        "doc", "line", "part", "shop", "kind", "amount", "share", "share_own", "alloc_net",
        "alloc_fee", "revenue", "city",
    )


@query(
    "reimbursement_documents",
    f"""
    WITH d AS (SELECT o_orderkey AS doc, o_custkey AS account, CAST(o_orderdate AS DATE) AS paid
               FROM orders),
    p AS (SELECT l_orderkey AS doc, sum({PRICE}) FILTER (WHERE l_linestatus = 'F') AS mdr,
            sum({PRICE}) FILTER (WHERE l_returnflag = 'A') AS advance FROM lineitem GROUP BY 1),
    c AS (SELECT o_custkey AS account, CAST(o_orderdate AS DATE) AS effective,
            max(o_orderkey) AS operator FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2),
    di AS (SELECT l_orderkey AS doc, max(l_suppkey) AS r FROM lineitem
           WHERE l_returnflag = 'R' AND l_linenumber = 1 GROUP BY 1),
    ind AS (SELECT l_orderkey AS doc, arg_min(l_suppkey, (l_shipdate, l_suppkey)) AS r FROM lineitem
            WHERE l_returnflag = 'N' GROUP BY 1)
    SELECT d.doc, d.account, paid::VARCHAR AS paid, CAST(coalesce(mdr, 0) AS DOUBLE) AS mdr,
           CAST(coalesce(advance, 0) AS DOUBLE) AS advance,
           CAST(coalesce(mdr, 0) + coalesce(advance, 0) AS DOUBLE) AS revenue,
           c.operator, coalesce(di.r, ind.r) AS requester
    FROM d LEFT JOIN p ON p.doc = d.doc
    ASOF LEFT JOIN c ON c.account = d.account AND d.paid >= c.effective
    LEFT JOIN di ON di.doc = d.doc LEFT JOIN ind ON ind.doc = d.doc
    """,
)
def reimbursement_documents_query(t: Tables):
    return documents(t, t.lineitem)


def documents(t: Tables, lineitem: DataFrame, paid: Column | None = None) -> DataFrame:
    """Orders as documents, paid when they were ordered unless another day is given."""
    docs = t.orders.select(
        F.col("o_orderkey").alias("doc"), F.col("o_custkey").alias("account"),
        (day("o_orderdate") if paid is None else paid).alias("paid"),
    )
    lines = lineitem.withColumnRenamed("l_orderkey", "doc")
    price = money("l_extendedprice")
    configs = t.orders.filter("o_orderpriority = '1-URGENT'").select(
        F.col("o_custkey").alias("account"), day("o_orderdate").alias("effective"),
        F.col("o_orderkey").alias("seq"), F.col("o_orderkey").alias("operator"),
    )
    direct = lines.filter("l_returnflag = 'R' AND l_linenumber = 1").select(
        "doc", F.col("l_suppkey").alias("requester")
    )
    indirect = lines.filter("l_returnflag = 'N'").select(
        "doc", F.col("l_suppkey").alias("requester"), "l_shipdate"
    )
    return reimbursement_documents(
        docs,
        {
            "mdr": (lines.filter("l_linestatus = 'F'"), price),
            "advance": (lines.filter("l_returnflag = 'A'"), price),
        },
        configs, direct, indirect, [F.asc("l_shipdate"), F.asc("requester")],
    )


@query(
    "voucher_fact",
    f"""
    WITH b AS (SELECT DISTINCT lpad(l_orderkey::VARCHAR, 10, '0') AS trans_id FROM lineitem
               WHERE l_linestatus = 'O'),
    l AS (SELECT l_orderkey AS voucher, max(l_partkey) FILTER (WHERE l_returnflag = 'R') AS ant,
            max(l_partkey) FILTER (WHERE l_returnflag = 'A') AS cmp FROM lineitem GROUP BY 1)
    SELECT 'loaded' AS origin, o_orderkey AS voucher, {sql_month('o_orderdate')}::VARCHAR
           AS ref_month, ant AS advance_voucher, CASE WHEN ant IS NOT NULL THEN cmp END
           AS purchase_voucher, CAST({TOTAL} AS DOUBLE) AS amount
    FROM orders JOIN b ON trans_id = lpad(o_orderkey::VARCHAR, 10, '0')
    LEFT JOIN l ON voucher = o_orderkey WHERE o_orderdate >= DATE '2000-04-01'
    UNION ALL
    SELECT 'stored', o_orderkey, {sql_month('o_orderdate')}::VARCHAR, NULL, NULL,
           CAST({TOTAL} AS DOUBLE) FROM orders WHERE o_orderdate < DATE '2000-04-01'
    """,
)
def voucher_fact_query(t: Tables):
    vouchers, billing, links = voucher_inputs(t)
    fact = voucher_fact(vouchers, billing, links, RUN).withColumn("origin", F.lit("loaded"))
    stored = vouchers.withColumns(
        {"ref_month": month_start("first_paid"), "origin": F.lit("stored")}
    )
    return load_vouchers(stored, fact, RUN).select(
        "origin", "voucher", "ref_month", "advance_voucher", "purchase_voucher", "amount"
    )


def voucher_inputs(t: Tables, billed: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders as vouchers, open lines as billing (those that ``billed`` selects), lines as links."""
    vouchers = t.orders.select(
        F.col("o_orderkey").alias("voucher"), pad_concat(["o_orderkey"], [10]).alias("trans_id"),
        day("o_orderdate").alias("first_paid"), money("o_totalprice").alias("amount"),
    )
    open_lines = t.lineitem.filter("l_linestatus = 'O'")
    billing = (open_lines if billed is None else open_lines.filter(billed)).select(
        pad_concat(["l_orderkey"], [10]).alias("trans_id")
    )
    links = t.lineitem.select(
        F.col("l_orderkey").alias("voucher"),
        F.when(F.col("l_returnflag") == "R", "ANT").when(F.col("l_returnflag") == "A", "CMP")
        .alias("kind"),
        F.col("l_partkey").alias("other"),
    )
    return vouchers, billing, links


@query(
    "statement_month",
    f"""
    WITH v AS (SELECT l_suppkey AS company, l_shipmonth AS m, l_linestatus AS product,
                 sum({PRICE}) FILTER (WHERE l_returnflag = 'N') AS gross,
                 sum({PRICE}) FILTER (WHERE l_returnflag = 'R') AS paid,
                 sum(CAST(round({PRICE} * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)))
                   FILTER (WHERE l_returnflag = 'A') AS fee
               FROM (SELECT *, {sql_month('l_shipdate')} AS l_shipmonth FROM lineitem) GROUP BY ALL),
    n AS (SELECT company, m, product, coalesce(gross, 0) AS gross, coalesce(paid, 0) AS paid,
                 coalesce(fee, 0) AS fee FROM v),
    p AS (SELECT company, product, sum(gross - paid - fee) AS closing FROM n
          WHERE m < DATE '2000-06-01' GROUP BY ALL),
    r AS (SELECT * FROM n WHERE m = DATE '2000-06-01'),
    b AS (SELECT company, product, coalesce(closing, 0) AS opening, coalesce(gross, 0) AS gross,
                 coalesce(paid, 0) AS paid, coalesce(fee, 0) AS fee
          FROM p FULL OUTER JOIN r USING (company, product))
    SELECT company, product, '2000-06-01' AS month, CAST(opening AS DOUBLE) AS opening,
           CAST(gross AS DOUBLE) AS gross, CAST(paid AS DOUBLE) AS paid, CAST(fee AS DOUBLE) AS fee,
           CAST(gross - paid - fee AS DOUBLE) AS movement,
           CAST(opening + gross - paid - fee AS DOUBLE) AS closing,
           md5(CAST(opening AS DECIMAL(38,2))::VARCHAR || CAST(gross AS DECIMAL(38,2))::VARCHAR ||
               CAST(paid AS DECIMAL(38,2))::VARCHAR || CAST(fee AS DECIMAL(38,2))::VARCHAR ||
               CAST(opening + gross - paid - fee AS DECIMAL(38,2))::VARCHAR) AS row_hash
    FROM b
    """,
)
def statement_month_query(t: Tables):
    keys = ["company", "product"]
    lines = t.lineitem.select(
        F.col("l_suppkey").alias("company"), F.col("l_linestatus").alias("product"),
        month_start("l_shipdate").alias("month"), "l_returnflag",
        money("l_extendedprice").alias("amount"),
        F.round(money("l_extendedprice") * F.col("l_tax").cast("decimal(4,2)"), 2).alias("tax"),
    )
    now_lines = lines.filter(F.col("month") == F.lit(RUN))
    flag = F.col("l_returnflag")
    moved = (
        F.when(flag == "N", F.col("amount")).when(flag == "R", -F.col("amount"))
        .otherwise(-F.col("tax"))
    )
    previous = (
        lines.filter(F.col("month") < F.lit(RUN)).groupBy(*keys)
        .agg(F.sum(moved).cast("decimal(37,2)").alias("closing"))
        .withColumn("month", F.lit(add_months(RUN, -1)))
    )
    parts = [
        mo.Part("gross", flag == "N", F.col("amount")),
        mo.Part("paid", flag == "R", F.col("amount"), -1),
        mo.Part("fee", flag == "A", F.col("tax"), -1),
    ]
    moved_now = mo.routed_statement([(now_lines, parts, {k: F.col(k) for k in keys})], keys)
    return statement_month(previous, moved_now, [p.name for p in parts], keys, RUN)


def settlement_lines(t: Tables) -> DataFrame:
    """Lines of documents as the statement reads them; the documents stand for their parties."""
    docs = t.orders.select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("company"),
        F.col("o_orderpriority").alias("product"), month_start("o_orderdate").alias("month"),
    )
    price = money("l_extendedprice")
    # Dealt out by document, so that its lines lie together when its units are settled. Parts stay as they are
    # dealt, since a line becomes several rows of a grouping: joined up to a size they would need much memory.
    deals = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    return t.lineitem.repartition(deals, "l_orderkey").join(docs.hint("merge"), "l_orderkey").select(
        F.col("l_orderkey").alias("doc"), "company", "product", "month", F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("item"), F.col("l_suppkey").alias("shop"), F.col("l_returnflag").alias("code"),
        (F.col("l_linestatus") == "F").alias("is_own"), day("l_shipdate").alias("paid"),
        month_start("l_shipdate").alias("paid_month"), (F.col("l_partkey") % 2).alias("note"), price.alias("amount"),
        money("l_quantity").alias("adjustment"), F.col("l_discount").cast("decimal(4,2)").alias("discount"),
        F.round(price * F.col("l_discount").cast("decimal(4,2)"), 2).cast("decimal(18,2)").alias("rebate"),
        F.round(price * F.col("l_tax").cast("decimal(4,2)"), 2).cast("decimal(18,2)").alias("fee"),
    )


def sql_statement(where: str = "TRUE", tag: str = "") -> str:
    """Every component as a query of its own over the lines, then their union by key: ``moved``."""
    cents = "CAST(round({0} * CAST({1} AS DECIMAL(4,2)), 2) AS DECIMAL(18,2))"
    rebate, fee = cents.format(PRICE, "l_discount"), cents.format(PRICE, "l_tax")
    simple = {
        "gross": ("code <> 'R'", "amount", "month", "product"),
        "reversed": ("code = 'R' AND own", "-amount", "month", "product"),
        "credit": ("discount >= 0.08", "-rebate", "month", "product"),
        "operating_fee": ("line = 1", "fee", "paid_month", "product"),
        "sva": ("item % 7 = 0", "rebate", "paid_month", "product"),
        "purchases": ("item % 5 = 0 AND own", "amount", "paid_month", "product"),
        "passed_on": ("shop % 9 = 0", "amount", "CAST(paid_month + INTERVAL 1 MONTH AS DATE)", "'PASSED'"),
        "advance_fee": ("code = 'A' AND own", "fee", "paid_month", "product"),
        "urgent": ("adjustment > 45", "amount", "paid_month", "product"),
    }
    selects = [
        f"SELECT company, {product} AS product, {month} AS month, '{name}' AS part, {value} AS v FROM l{tag} WHERE {which}"
        for name, (which, value, month, product) in simple.items()
    ]
    selects += [
        f"""SELECT company, product, paid_month, 'confirmed', amount FROM (SELECT DISTINCT company, product, paid_month,
               paid, doc, amount FROM l{tag} WHERE code = 'N' AND line <= 2)""",
        f"""SELECT company, product, month, 'debit', adjustment FROM (SELECT DISTINCT company, product, month, doc,
               adjustment FROM l{tag} WHERE code = 'A') a WHERE NOT EXISTS (SELECT 1 FROM l{tag} l
               WHERE l.doc = a.doc AND l.adjustment = a.adjustment AND l.code = 'N')""",
        f"""SELECT company, product, month, 'billed', max(fee) FROM l{tag} WHERE NOT own
               GROUP BY company, product, month, doc, note""",
    ]
    signs = {p: 1 if p in ("gross", "reversed", "operating_fee", "passed_on") else -1 for p in COMPONENTS}
    sums = ", ".join(f"coalesce(sum(v) FILTER (WHERE part = '{c}'), 0) AS {c}" for c in COMPONENTS)
    total = " + ".join(f"{sign} * {c}" for c, sign in signs.items())
    return f"""
    l{tag} AS (SELECT l_orderkey AS doc, o_custkey AS company, o_orderpriority AS product,
                 {sql_month('o_orderdate')} AS month, l_linenumber AS line, l_partkey AS item, l_suppkey AS shop,
                 l_returnflag AS code, l_linestatus = 'F' AS own, CAST(l_shipdate AS DATE) AS paid,
                 {sql_month('l_shipdate')} AS paid_month, l_partkey % 2 AS note, {PRICE} AS amount,
                 {sql_money('l_quantity')} AS adjustment, CAST(l_discount AS DECIMAL(4,2)) AS discount,
                 {rebate} AS rebate, {fee} AS fee FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE {where}),
    parts{tag} AS ({' UNION ALL '.join(selects)}),
    wide{tag} AS (SELECT company, product, month, {sums} FROM parts{tag} GROUP BY 1, 2, 3),
    moved{tag} AS (SELECT *, {total} AS movement FROM wide{tag})"""


SQL_FIGURES = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in (*COMPONENTS, "movement"))


@query("statement_full", f"WITH {sql_statement()} SELECT company, product, month::VARCHAR AS month, {SQL_FIGURES} FROM moved")
def statement_full(t: Tables):
    keys = ["company", "product", "month"]
    return mo.routed_statement(
        [(settlement_lines(t), statement_parts(), {k: F.col(k) for k in keys})], keys, within=["doc"]
    )
