"""Selection, upserts, golden records, contracts, protection and text rules on sample tables."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidlake.functions import casts, dates, keys, text
from braidlake.operators import asof, contract, golden, kpi, protect, select, union, upsert
from braidlake.plans.registry import (
    NOW_TEXT, RUN, Tables, day, money, now, query, sql_money, sql_month,
)
from braidlake.sources import lake

TOTAL = sql_money("o_totalprice")
PRICE = sql_money("l_extendedprice")

# ---- selection ------------------------------------------------------------------------------


@query(
    "latest_order",
    """
    SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE)::VARCHAR AS order_date FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey
             ORDER BY o_orderdate DESC, o_orderkey DESC) rn FROM orders) WHERE rn = 1
    """,
)
def latest_order(t: Tables):
    orders = t.orders.select("o_custkey", "o_orderkey", day("o_orderdate").alias("order_date"))
    return select.latest_by(orders, ["o_custkey"], [F.desc("order_date"), F.desc("o_orderkey")])


@query(
    "latest_order_ties",
    """
    SELECT o_custkey, o_orderkey FROM orders JOIN
      (SELECT o_custkey k, max(o_orderdate) d FROM orders GROUP BY 1) ON k = o_custkey
       AND d = o_orderdate
    """,
)
def latest_order_ties(t: Tables):
    return select.latest_by(t.orders, ["o_custkey"], "o_orderdate", ties="all").select(
        "o_custkey", "o_orderkey"
    )


@query(
    "best_then_latest",
    """
    SELECT o_custkey, o_orderkey, o_orderpriority FROM (
      SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority,
        CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END DESC NULLS LAST) r
      FROM orders WHERE o_custkey IS NOT NULL AND o_orderpriority IS NOT NULL) WHERE r = 1
    """,
)
def best_then_latest(t: Tables):
    dated = t.orders.select(
        "o_custkey", "o_orderkey", "o_orderpriority",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("changed"),
    )
    return select.best_then_latest(dated, ["o_custkey"], "o_orderpriority", "changed").drop(
        "changed"
    )


@query(
    "rank_contacts",
    """
    SELECT conv_id, role, turn, row_number() OVER (PARTITION BY conv_id, role
           ORDER BY turn DESC, length(text) DESC) AS position FROM conversations
    """,
)
def rank_contacts(t: Tables):
    return select.rank_within(
        t.conversations.select("conv_id", "role", "turn", F.length("text").alias("size")),
        ["conv_id", "role"],
        [F.desc("turn"), F.desc("size")],
        "position",
        slices=[("block", F.floor(F.col("turn") / 64), True)],
    ).drop("size")


@query(
    "synthetic_key",
    """
    WITH p AS (SELECT p_partkey, p_name,
                      CASE WHEN p_type <> 'PROMO' THEN 'P-' || p_partkey END AS code FROM part)
    SELECT p_partkey, p_name, coalesce(code, 'SYN-' || min(CASE WHEN code IS NULL THEN p_partkey
           END) OVER (PARTITION BY p_name)) AS code FROM p
    """,
)
def synthetic_key(t: Tables):
    parts = t.part.select(
        "p_partkey", "p_name",
        F.when(F.col("p_type") != "PROMO", F.concat(F.lit("P-"), "p_partkey")).alias("code"),
    )
    return select.synthetic_key(parts, "p_partkey", "code", ["p_name"], "SYN-")


@query(
    "synthetic_key_collapsed",
    """
    SELECT DISTINCT 'P-' || p_partkey AS code, p_name, p_size FROM part WHERE p_type <> 'PROMO'
    UNION SELECT 'SYN-' || min(p_partkey), p_name, p_size FROM part WHERE p_type = 'PROMO'
    GROUP BY p_name, p_size
    """,
)
def synthetic_key_collapsed(t: Tables):
    parts = t.part.select(
        "p_partkey", "p_name", "p_size",
        F.when(F.col("p_type") != "PROMO", F.concat(F.lit("P-"), "p_partkey")).alias("code"),
    )
    return select.synthetic_key(
        parts, "p_partkey", "code", ["p_name", "p_size"], "SYN-", collapse=True
    )


@query(
    "prefer_direct",
    """
    WITH u AS (
      SELECT o_custkey, o_orderkey, 1 AS r FROM orders
       WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'
      UNION
      SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey
             ORDER BY o_orderdate, o_orderkey) + 1 FROM orders WHERE o_orderpriority = '2-HIGH'),
      m AS (SELECT o_custkey k, min(r) mr FROM u GROUP BY ALL)
    SELECT o_custkey, o_orderkey FROM u JOIN m ON k = o_custkey AND r = mr
    """,
)
def prefer_direct(t: Tables):
    direct = t.orders.filter("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'").select(
        "o_custkey", "o_orderkey"
    )
    indirect = t.orders.filter("o_orderpriority = '2-HIGH'")
    return select.prefer_direct(
        direct, indirect, ["o_custkey"], [F.asc("o_orderdate"), F.asc("o_orderkey")]
    )


@query(
    "unique_check",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2
    HAVING count(*) > 1
    """,
)
def unique_check(t: Tables):
    return select.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


# ---- upserts --------------------------------------------------------------------------------

# Customer profiles as known on a date stand in for dimension states: the earlier profile is the
# stored table, the one over all orders the new load. The source no longer sends customers whose
# last order has the lowest priority.
SQL_PROFILE = """
    SELECT custkey, last_priority, n_orders,
           md5(upper(custkey::VARCHAR || last_priority || n_orders::VARCHAR)) AS row_hash
    FROM (SELECT o_custkey AS custkey, count(*) AS n_orders,
                 arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS last_priority
          FROM orders WHERE {seen} GROUP BY 1)
    WHERE {sent}
"""
STORED = {"seen": "o_orderdate < DATE '1995-07-01'", "sent": "true"}
OLDER = {"seen": "o_orderdate < DATE '1995-04-01'", "sent": "true"}
LOADED = {"seen": "true", "sent": "last_priority <> '5-LOW'"}


def profile(t: Tables, seen: str, sent: str) -> DataFrame:
    newest = F.struct("o_orderdate", "o_orderkey")
    grouped = (
        t.orders.filter(seen)
        .groupBy(F.col("o_custkey").alias("custkey"))
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.max_by("o_orderpriority", newest).alias("last_priority"),
        )
        .filter(sent)
    )
    return grouped.select(
        "custkey", "last_priority", "n_orders",
        keys.fingerprint(["custkey", "last_priority", "n_orders"], upper=True).alias("row_hash"),
    )


@query(
    "fingerprint",
    """
    SELECT c_custkey, md5(upper(coalesce(c_name, '') || coalesce(c_mktsegment, '') ||
           coalesce(c_nationkey::VARCHAR, ''))) AS row_hash FROM customer
    """,
)
def fingerprint(t: Tables):
    return t.customer.select(
        "c_custkey",
        keys.fingerprint(["c_name", "c_mktsegment", "c_nationkey"], upper=True).alias("row_hash"),
    )


def stamped(df: DataFrame, stamp: str) -> DataFrame:
    return df.withColumns(
        {c: F.lit(stamp).cast("timestamp_ntz") for c in ("inserted_at", "changed_at")}
    )


SQL_SCD1 = f"""
    WITH t AS ({SQL_PROFILE.format(**STORED)}), s AS ({SQL_PROFILE.format(**LOADED)}),
    j AS (SELECT t.custkey IS NULL AS fresh,
                 t.custkey IS NOT NULL AND s.custkey IS NOT NULL AND s.row_hash <> t.row_hash AS stale,
                 s.custkey sk, t.custkey tk, s.last_priority sp, t.last_priority tp,
                 s.n_orders sn, t.n_orders tn, s.row_hash sh, t.row_hash th
          FROM t FULL OUTER JOIN s ON s.custkey = t.custkey)
    SELECT coalesce(sk, tk) AS custkey,
           CASE WHEN fresh OR stale THEN sp ELSE tp END AS last_priority,
           CASE WHEN fresh OR stale THEN sn ELSE tn END AS n_orders,
           CASE WHEN fresh OR stale THEN sh ELSE th END AS row_hash,
           CASE WHEN fresh THEN '{NOW_TEXT}' ELSE '1995-07-01 00:00:00' END AS inserted_at,
           CASE WHEN fresh OR stale THEN '{NOW_TEXT}' ELSE '1995-07-01 00:00:00' END AS changed_at
    FROM j
"""


@query("upsert_scd1", SQL_SCD1)
def upsert_scd1(t: Tables):
    return upsert.upsert_scd1(
        stamped(profile(t, **STORED), "1995-07-01"), profile(t, **LOADED), ["custkey"], "row_hash",
        now(),
    )


SQL_CHANGES = f"""
    t AS ({SQL_PROFILE.format(**STORED)}), s AS ({SQL_PROFILE.format(**LOADED)}),
    c AS (SELECT s.*, CASE WHEN t.custkey IS NULL THEN 'insert'
                           WHEN s.last_priority IS DISTINCT FROM t.last_priority THEN 'version'
                           ELSE 'update' END AS action
          FROM s LEFT JOIN t ON s.custkey = t.custkey
          WHERE coalesce(t.row_hash, '') <> coalesce(s.row_hash, ''))
"""


@query(
    "classify_changes",
    f"""
    WITH {SQL_CHANGES}
    SELECT custkey, last_priority, n_orders, row_hash, action FROM c
    UNION ALL SELECT custkey, last_priority, n_orders, row_hash, 'close' FROM c
    WHERE action = 'version'
    """,
)
def classify_changes(t: Tables):
    changes = upsert.classify_changes(
        profile(t, **LOADED), profile(t, **STORED), ["custkey"], ["last_priority"], "row_hash"
    )
    return upsert.expand_actions(changes)


def dimension(t: Tables) -> DataFrame:
    def rows(df: DataFrame, active: int, start: str, end: str | None) -> DataFrame:
        return stamped(df, start).select(
            (F.col("custkey") + 1).alias("sk"), *df.columns, F.lit(active).alias("is_active"),
            F.lit(start).cast("timestamp_ntz").alias("valid_from"),
            F.lit(end).cast("timestamp_ntz").alias("valid_to"), "inserted_at", "changed_at",
        )

    return rows(profile(t, **STORED), 1, "1995-07-01", None).unionByName(
        rows(profile(t, **OLDER), 0, "1995-04-01", "1995-06-30")
    )


@query(
    "upsert_scd2",
    f"""
    WITH {SQL_CHANGES},
    old AS ({SQL_PROFILE.format(**OLDER)}),
    top AS (SELECT max(custkey + 1) m FROM (SELECT custkey FROM t UNION ALL
                                            SELECT custkey FROM old)),
    num AS (SELECT custkey, b, row_number() OVER (PARTITION BY b ORDER BY custkey) - 1 AS rn FROM
            (SELECT custkey, ('0x' || substr(md5(custkey::VARCHAR), 1, 8))::BIGINT % 4096 AS b
             FROM c WHERE action = 'insert'))
    SELECT custkey + 1 AS sk, custkey, last_priority, n_orders, row_hash, 0 AS is_active,
           '1995-04-01 00:00:00' AS valid_from, '1995-06-30 00:00:00' AS valid_to,
           '1995-04-01 00:00:00' AS inserted_at, '1995-04-01 00:00:00' AS changed_at FROM old
    UNION ALL
    SELECT t.custkey + 1, t.custkey,
           CASE WHEN c.action = 'update' THEN c.last_priority ELSE t.last_priority END,
           CASE WHEN c.action = 'update' THEN c.n_orders ELSE t.n_orders END,
           CASE WHEN c.action = 'update' THEN c.row_hash ELSE t.row_hash END,
           CASE WHEN c.action = 'version' THEN 0 ELSE 1 END, '1995-07-01 00:00:00',
           CASE WHEN c.action = 'version' THEN '2000-06-14 12:00:00' END, '1995-07-01 00:00:00',
           CASE WHEN c.action IS NOT NULL THEN '{NOW_TEXT}' ELSE '1995-07-01 00:00:00' END
    FROM t LEFT JOIN c ON c.custkey = t.custkey
    UNION ALL
    SELECT custkey + 1, custkey, last_priority, n_orders, row_hash, 1, '2000-06-14 12:00:00', NULL,
           '{NOW_TEXT}', '{NOW_TEXT}' FROM c WHERE action = 'version'
    UNION ALL
    SELECT m + b + 1 + rn * 4096, custkey, last_priority, n_orders, row_hash, 1,
           '2000-06-14 12:00:00', NULL, '{NOW_TEXT}', '{NOW_TEXT}'
    FROM c JOIN num USING (custkey), top WHERE action = 'insert'
    """,
)
def upsert_scd2(t: Tables):
    return upsert.upsert_scd2(
        dimension(t), profile(t, **LOADED), ["custkey"], ["last_priority"], "row_hash", now()
    )


@query(
    "reload_window",
    f"""
    SELECT o_orderkey, {sql_month('o_orderdate')}::VARCHAR AS month, 'stored' AS origin FROM orders
     WHERE o_orderstatus <> 'P' AND o_orderdate < DATE '2000-05-01'
    UNION ALL
    SELECT o_orderkey, {sql_month('o_orderdate')}::VARCHAR, 'loaded' FROM orders
     WHERE o_orderdate >= DATE '2000-05-01'
    """,
)
def reload_window(t: Tables):
    rows = t.orders.select(
        "o_orderkey", "o_orderstatus", dates.month_start("o_orderdate").alias("month")
    )
    return upsert.reload_window(
        rows.filter("o_orderstatus <> 'P'").withColumn("origin", F.lit("stored")),
        rows.withColumn("origin", F.lit("loaded")),
        "month",
        dates.add_months(RUN, -1),
    ).drop("o_orderstatus")


@query(
    "reconcile",
    f"""
    WITH t AS ({SQL_PROFILE.format(**STORED)}), s AS ({SQL_PROFILE.format(**LOADED)})
    SELECT coalesce(s.custkey, t.custkey) AS custkey,
           CASE WHEN s.custkey IS NOT NULL THEN s.last_priority ELSE t.last_priority END
               AS last_priority,
           CASE WHEN t.custkey IS NULL THEN 'new' WHEN s.custkey IS NULL THEN 'inactive'
                ELSE 'active' END AS status
    FROM s FULL OUTER JOIN t ON s.custkey = t.custkey
    """,
)
def reconcile(t: Tables):
    cols = ["custkey", "last_priority"]
    return upsert.reconcile(
        profile(t, **LOADED).select(cols), profile(t, **STORED).select(cols), ["custkey"]
    )


# ---- golden records -------------------------------------------------------------------------


def sources(t: Tables) -> dict[str, DataFrame]:
    """Three overlapping sources: the registry of solvent customers, buyers and web users."""
    registry = t.customer.filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    buyers = t.orders.groupBy(F.col("o_custkey").alias("key")).agg(
        day(F.min("o_orderdate")).alias("created"), day(F.max("o_orderdate")).alias("changed"),
        F.max(F.when(F.col("o_orderpriority") == "1-URGENT", "urgent")).alias("segment"),
    )
    users = t.events.groupBy(F.col("user_id").alias("key")).agg(
        day(F.min("ts")).alias("created"), day(F.max("ts")).alias("changed"),
        F.max(F.when(F.col("value") > 450, "big")).alias("segment"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("name"),
    )
    return {"registry": registry, "buyers": buyers, "users": users}


SQL_SOURCES = """
    registry AS (SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer
                 WHERE c_acctbal > 0),
    buyers AS (SELECT o_custkey AS key, CAST(min(o_orderdate) AS DATE) AS created,
                      CAST(max(o_orderdate) AS DATE) AS changed,
                      max(CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent' END) AS segment
               FROM orders GROUP BY 1),
    users AS (SELECT user_id AS key, CAST(min(ts) AS DATE) AS created,
                     CAST(max(ts) AS DATE) AS changed,
                     max(CASE WHEN value > 450 THEN 'big' END) AS segment,
                     'user ' || user_id AS name FROM events GROUP BY user_id),
    spine AS (SELECT key FROM registry UNION SELECT key FROM buyers UNION SELECT key FROM users)
"""


@query(
    "golden_record",
    f"""
    WITH {SQL_SOURCES}
    SELECT spine.key, coalesce(r.name, u.name) AS name,
           CASE WHEN u.key IS NOT NULL THEN u.segment WHEN r.key IS NOT NULL THEN r.segment
                ELSE b.segment END AS segment,
           least(b.created, u.created)::VARCHAR AS created,
           greatest(b.changed, u.changed)::VARCHAR AS changed
    FROM spine LEFT JOIN registry r ON r.key = spine.key LEFT JOIN buyers b ON b.key = spine.key
    LEFT JOIN users u ON u.key = spine.key
    """,
)
def golden_record(t: Tables):
    return golden.golden_record(
        sources(t),
        ["key"],
        {
            "name": ("first", ["registry", "users"]),
            "segment": ("owner", ["users", "registry", "buyers"]),
            "created": ("least", ["buyers", "users"]),
            "changed": ("greatest", ["buyers", "users"]),
        },
    )


@query(
    "source_flags",
    f"""
    WITH {SQL_SOURCES}, u AS (SELECT key, 'registry' s FROM registry UNION
        SELECT key, 'buyers' FROM buyers UNION SELECT key, 'users' FROM users)
    SELECT key, string_agg(s, ', ' ORDER BY s) AS sources,
           max(CASE WHEN s = 'registry' THEN 1 ELSE 0 END) AS flag_registry,
           max(CASE WHEN s = 'buyers' THEN 1 ELSE 0 END) AS flag_buyers,
           max(CASE WHEN s = 'users' THEN 1 ELSE 0 END) AS flag_users FROM u GROUP BY 1
    """,
)
def source_flags(t: Tables):
    return golden.source_flags(sources(t), ["key"])


@query(
    "exclude_internal",
    """
    SELECT c_custkey FROM customer c
    WHERE NOT (c_mktsegment = 'MACHINERY' AND c_acctbal < 0)
      AND NOT ((c_name ILIKE '%99%' OR c_name IN ('Customer#000000011', 'Customer#000000012'))
           AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
                           AND o_totalprice > 400000))
    """,
)
def exclude_internal(t: Tables):
    payers = t.orders.filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return golden.exclude_internal(
        t.customer,
        always=[(F.col("c_mktsegment") == "MACHINERY") & (F.col("c_acctbal") < 0)],
        unless_kept=[
            F.col("c_name").ilike("%99%"),
            F.col("c_name").isin("Customer#000000011", "Customer#000000012"),
        ],
        kept=payers,
        on=["c_custkey"],
    ).select("c_custkey")


@query(
    "classify",
    """
    SELECT p_partkey, coalesce(family, 'OTHER') AS family, rank AS family_rank FROM part
    LEFT JOIN (VALUES ('PROMO', 'SALE', 1), ('ECONOMY', 'BASE', 2), ('STANDARD', 'BASE', 3))
         r(kind, family, rank) ON kind = p_type
    """,
)
def classify(t: Tables):
    table = lake.constants(
        t.spark,
        [("PROMO", "SALE", 1), ("ECONOMY", "BASE", 2), ("STANDARD", "BASE", 3)],
        "kind string, family string, family_rank int",
    )
    return golden.classify(
        t.part.select("p_partkey", "p_type"), table, {"p_type": "kind"},
        {"family": "OTHER", "family_rank": None},
    ).drop("p_type")


# ---- unions, variants, contracts, protection ------------------------------------------------


@query(
    "align_union",
    """
    SELECT c_custkey AS id, c_name AS name, c_nationkey::BIGINT AS nation, c_mktsegment AS segment,
           'customer' AS origin FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL, 'supplier' FROM supplier
    """,
)
def align_union(t: Tables):
    customers = union.rename_map(
        t.customer,
        {"c_custkey": "id", "c_name": "name", "c_nationkey": "nation", "c_mktsegment": "segment"},
    )
    suppliers = union.rename_map(
        t.supplier, {"s_nationkey": "nation", "s_name": "name", "s_suppkey": "id"}
    )
    return union.align_union(
        {"customer": customers, "supplier": suppliers},
        columns={"id": "bigint", "name": "string", "nation": "bigint", "segment": "string"},
    )


@query(
    "append_history",
    """
    SELECT o_orderkey, o_orderpriority AS priority, NULL AS old_status FROM orders
    WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT o_orderkey, NULL, o_orderstatus FROM orders
    WHERE o_orderdate < DATE '1996-01-01' AND o_orderstatus <> 'F'
    """,
)
def append_history(t: Tables):
    main = t.orders.filter("o_orderstatus = 'F'").select(
        "o_orderkey", F.col("o_orderpriority").alias("priority")
    )
    old = t.orders.filter(F.col("o_orderdate") < F.lit(dt.date(1996, 1, 1))).select(
        "o_orderkey", F.col("o_orderstatus").alias("old_status")
    )
    return asof.append_history(main, old, ["o_orderkey"])


def _variant_sql(where: str) -> str:
    return f"""SELECT l_suppkey, l_returnflag, sum({sql_money('l_extendedprice')}) total,
               count(*) n FROM lineitem WHERE {where} GROUP BY 1, 2"""


@query(
    "variant_diff",
    f"""
    WITH a AS ({_variant_sql("l_returnflag = 'R' AND l_quantity > 45")}),
         b AS ({_variant_sql("l_returnflag IN ('R', 'A') AND l_quantity >= 46")})
    SELECT coalesce(a.l_suppkey, b.l_suppkey) AS l_suppkey,
           coalesce(a.l_returnflag, b.l_returnflag) AS l_returnflag,
           CASE WHEN a.l_suppkey IS NULL THEN 'added' WHEN b.l_suppkey IS NULL THEN 'removed'
                WHEN a.total <> b.total OR a.n <> b.n THEN 'changed' ELSE 'equal' END AS status,
           CAST(a.total AS DOUBLE) AS total_a, CAST(b.total AS DOUBLE) AS total_b,
           CAST(coalesce(b.total, 0) - coalesce(a.total, 0) AS DOUBLE) AS total_delta,
           a.n AS n_a, b.n AS n_b, coalesce(b.n, 0) - coalesce(a.n, 0) AS n_delta
    FROM a FULL OUTER JOIN b ON a.l_suppkey = b.l_suppkey AND a.l_returnflag = b.l_returnflag
    """,
)
def variant_diff(t: Tables):
    def variant(where: str) -> DataFrame:
        return t.lineitem.filter(where).groupBy("l_suppkey", "l_returnflag").agg(
            F.sum(money("l_extendedprice")).alias("total"), F.count(F.lit(1)).alias("n")
        )

    return kpi.compare_variants(
        variant("l_returnflag = 'R' AND l_quantity > 45"),
        variant("l_returnflag IN ('R', 'A') AND l_quantity >= 46"),
        ["l_suppkey", "l_returnflag"],
        ["total", "n"],
    )


SQL_RULES = {
    "flag": ("l_returnflag = 'R'", "l_returnflag IN ('R', 'A')"),
    "quantity": ("l_quantity > 45", "l_quantity >= 40"),
    "closed": ("TRUE", "l_linestatus = 'F'"),
}


def _sql_attribution() -> str:
    """Every state of the rule sets on its own, as a scan of the lines each."""
    names, net = list(SQL_RULES), "CAST(round({0} * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(18,2))".format(PRICE)

    def total(new, value):
        where = " AND ".join(SQL_RULES[n][1 if n in new else 0] for n in names)
        sums = f"coalesce(sum({value}) FILTER (WHERE {where}), 0)"
        return sums, f"count(*) FILTER (WHERE {where})"

    def moved(i):
        old, new = (" AND ".join(SQL_RULES[n][1 if k < j else 0] for k, n in enumerate(names)) for j in (i, i + 1))
        return f"count(*) FILTER (WHERE ({new}) AND NOT ({old})) AS n_gained, count(*) FILTER (WHERE ({old}) AND NOT ({new})) AS n_lost"

    selects = []
    for i, n in enumerate(names):
        (a, x), (b, y) = total(names[:i], PRICE), total(names[: i + 1], PRICE)
        (c, z), (d, w) = total([], PRICE), total([n], PRICE)
        selects.append(
            f"""SELECT l_suppkey, '{n}' AS rule, CAST({b} - {a} AS DOUBLE) AS total_step, CAST({d} - {c} AS DOUBLE) AS total_alone,
                {y} - {x} AS n_step, {w} - {z} AS n_alone, {moved(i)} FROM lineitem GROUP BY 1"""
        )
    (a, _), (b, _) = total(names, PRICE), total(names, net)
    (c, _), (d, _) = total([], PRICE), total([], net)
    selects.append(
        f"""SELECT l_suppkey, 'measure', CAST({b} - {a} AS DOUBLE), CAST({d} - {c} AS DOUBLE), 0, 0, 0, 0 FROM lineitem GROUP BY 1"""
    )
    return " UNION ALL ".join(selects)


@query("rule_attribution", _sql_attribution())
def rule_attribution(t: Tables):
    # Two rules change, one is new, and the amount becomes net of the discount.
    price = money("l_extendedprice")
    net = F.round(price * (1 - F.col("l_discount").cast("decimal(4,2)")), 2).cast("decimal(18,2)")
    before = {n: F.expr(a) for n, (a, _) in SQL_RULES.items() if a != "TRUE"}
    return kpi.attribute_change(
        t.lineitem, ["l_suppkey"], before, {n: F.expr(b) for n, (_, b) in SQL_RULES.items()},
        {"total": (price, net), "n": F.lit(1).cast("long")},
    )


ORDER_CONTRACT = contract.Contract(
    "orders_curated",
    [
        contract.Field("order_id", "bigint", required=True, comment="Order number"),
        contract.Field("priority_code", "int", required=True, comment="Digit of the priority"),
        contract.Field("ref_date", "date", required=True, comment="Order day"),
        contract.Field("total", "decimal(18,2)", comment="Order amount"),
        contract.Field("closed_by", "string", comment="Not filled by this source"),
    ],
    partition_by=["ref_date"],
)


def raw_orders(t: Tables) -> DataFrame:
    """Orders as untyped text, with an unreadable code on the '5-LOW' ones and gaps on the open."""
    low = F.col("o_orderpriority") == "5-LOW"
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(low, F.lit("low")).otherwise(F.substring("o_orderpriority", 1, 1))
        .alias("priority_code"),
        F.when(F.col("o_orderstatus") != "O", day("o_orderdate").cast("string")).alias("ref_date"),
        F.col("o_totalprice").cast("string").alias("total"),
    )


@query(
    "conform_contract",
    f"""
    SELECT o_orderkey AS order_id, CAST(left(o_orderpriority, 1) AS BIGINT) AS priority_code,
           CAST(o_orderdate AS DATE)::VARCHAR AS ref_date, CAST({TOTAL} AS DOUBLE) AS total,
           CAST(NULL AS VARCHAR) AS closed_by
    FROM orders WHERE o_orderstatus <> 'O' AND o_orderpriority <> '5-LOW'
    """,
)
def conform_contract(t: Tables):
    return contract.conform(raw_orders(t), ORDER_CONTRACT)


@query(
    "contract_migration",
    f"""
    SELECT o_orderkey AS order_id, CAST(left(o_orderpriority, 1) AS BIGINT) AS priority_code,
           CAST(o_orderdate AS DATE)::VARCHAR AS ref_date, CAST({TOTAL} AS DOUBLE) AS total,
           CAST(NULL AS VARCHAR) AS closed_by, CAST(NULL AS VARCHAR) AS channel, 'decimal(20,4)' AS total_type,
           'Amount before tax' AS total_comment
    FROM orders WHERE o_orderstatus <> 'O' AND o_orderpriority <> '5-LOW'
    """,
)
def contract_migration(t: Tables):
    # The table gets a column and a comment, then a wider amount; rows and comments come from the catalog.
    name = "braidlake_contracts.orders_" + uuid.uuid4().hex
    fields = [f for f in ORDER_CONTRACT.fields if f.name != "total"]
    total = contract.Field("total", "decimal(18,2)", comment="Amount")
    v1 = contract.Contract(name, [*fields, total])
    v2 = contract.Contract(name, [*fields, replace(total, comment="Amount before tax"), contract.Field("channel", "string")])
    v3 = contract.Contract(name, [*fields, replace(v2.fields[-2], type="decimal(20,4)"), v2.fields[-1]])
    contract.create(t.spark, v1)
    contract.conform(raw_orders(t), v1).write.insertInto(name)
    contract.migrate(t.spark, v1, v2)
    contract.migrate(t.spark, v2, v3)
    kept = lake.stage(lake.read_table(t.spark, name), "migrated")
    told = {r["col_name"]: r for r in t.spark.sql(f"DESCRIBE TABLE {name}").collect()}["total"]
    t.spark.sql(f"DROP TABLE {name}")
    return kept.withColumns({"total_type": F.lit(told["data_type"]), "total_comment": F.lit(told["comment"])})


@query(
    "contract_violations",
    """
    SELECT 'priority_code' AS "column", 'type' AS rule, count(*) AS n_rows FROM orders
    WHERE o_orderpriority = '5-LOW'
    UNION ALL SELECT 'ref_date', 'required', count(*) FROM orders WHERE o_orderstatus = 'O'
    """,
)
def contract_violations(t: Tables):
    return contract.violations(raw_orders(t), ORDER_CONTRACT)


@query(
    "contract_violating_rows",
    """
    SELECT o_orderkey::VARCHAR AS order_id,
           concat_ws(',', CASE WHEN o_orderpriority = '5-LOW' THEN 'type:priority_code' END,
                     CASE WHEN o_orderstatus = 'O' THEN 'required:ref_date' END) AS violations
    FROM orders WHERE o_orderpriority = '5-LOW' OR o_orderstatus = 'O'
    """,
)
def contract_violating_rows(t: Tables):
    return contract.violating_rows(raw_orders(t), ORDER_CONTRACT).select("order_id", "violations")


@query(
    "protect",
    """
    SELECT c_custkey,
           sha256(regexp_replace(lpad(c_custkey::VARCHAR, 11, '0'),
                  '(\\d{3})(\\d{3})(\\d{3})(\\d{2})', '\\1.\\2.\\3-\\4')) AS document_hash,
           sha256(c_name) AS name_hash,
           regexp_replace(regexp_replace(regexp_replace(c_mktsegment, '[A-Z]', 'X', 'g'),
                  '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS c_mktsegment
    FROM customer
    """,
)
def protect_customers(t: Tables):
    people = t.customer.select(
        "c_custkey", "c_name", "c_mktsegment",
        F.lpad(F.col("c_custkey").cast("string"), 11, "0").alias("document"),
    )
    return protect.protect(
        people,
        hashes={"document_hash": ("document", 256), "name_hash": ("c_name", 256)},
        written_form=["document"],
        masks=["c_mktsegment"],
        drop=["c_name", "document"],
    )


@query(
    "encrypt_round_trip",
    "SELECT c_custkey, c_name, 1 AS was_hidden FROM customer",
)
def encrypt_round_trip(t: Tables):
    key = F.lit("0123456789abcdef")
    hidden = protect.protect(t.customer.select("c_custkey", "c_name"), encrypt={"c_name": key})
    kept = hidden.withColumn("stored", F.col("c_name").cast("string"))
    shown = protect.decrypt(kept, {"c_name": key})
    return shown.withColumn("was_hidden", ~F.col("stored").contains(F.col("c_name"))).drop("stored")


@query(
    "secure_view",
    """
    SELECT c_custkey, regexp_replace(regexp_replace(regexp_replace(c_name, '[A-Z]', 'X', 'g'),
           '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS c_name, c_mktsegment FROM customer
    """,
)
def secure_view(t: Tables):
    protect.secure_view(
        t.customer.select("c_custkey", "c_name", "c_mktsegment"), "braidlake_safe_customer",
        ["c_name"], masked=True,
    )
    return lake.read_table(t.spark, "braidlake_safe_customer")


@query(
    "unknown_member",
    """
    SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, -98) AS toxic,
           CASE WHEN quality = 1 THEN lang ELSE 'Não Informado' END AS kind
    FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def unknown_member(t: Tables):
    joined = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    marked = joined.withColumn("kind", F.when(F.col("quality") == 1, F.col("lang"))).drop("lang")
    return keys.unknown_member(
        marked, {"quality": -1, "toxic": -98, "kind": "Não Informado"}
    )


def sql_wrap(x: str) -> str:
    return f"(({x}) % 4294967296)"


def sql_turn(x: str, by: int) -> str:
    """Rotation of a 32-bit number to the left."""
    return f"(({x}) * {2**by} % 4294967296 + ({x}) // {2 ** (32 - by)})"


# The 32-bit hash of a 64-bit key, written out: two rounds (low and high half) and the final mixing.
SQL_HASHED = f"""
    a AS (SELECT c_custkey, c_custkey::HUGEINT % 4294967296 AS lo, c_custkey::HUGEINT // 4294967296 AS hi
          FROM customer),
    b AS (SELECT *, {sql_wrap("lo * 3432918353")} AS lo1, {sql_wrap("hi * 3432918353")} AS hi1 FROM a),
    c AS (SELECT *, {sql_wrap(sql_turn("lo1", 15) + " * 461845907")} AS lo2,
                 {sql_wrap(sql_turn("hi1", 15) + " * 461845907")} AS hi2 FROM b),
    d AS (SELECT *, xor(42::HUGEINT, lo2) AS h1 FROM c),
    e AS (SELECT *, xor({sql_wrap(sql_turn("h1", 13) + " * 5 + 3864292196")}, hi2) AS h2 FROM d),
    f AS (SELECT *, xor({sql_wrap(sql_turn("h2", 13) + " * 5 + 3864292196")}, 8::HUGEINT) AS h3 FROM e),
    g AS (SELECT *, {sql_wrap("xor(h3, h3 // 65536) * 2246822507")} AS h4 FROM f),
    h AS (SELECT *, {sql_wrap("xor(h4, h4 // 8192) * 3266489909")} AS h5 FROM g),
    i AS (SELECT c_custkey, xor(h5, h5 // 65536) AS h6 FROM h)
"""


@query(
    "hash_key",
    f"""
    WITH {SQL_HASHED}
    SELECT c_custkey, abs(CASE WHEN h6 >= 2147483648 THEN h6 - 4294967296 ELSE h6 END)::BIGINT AS key,
           -1 AS empty_key FROM i
    """,
)
def hash_key(t: Tables):
    return t.customer.select(
        "c_custkey", keys.hash_key([F.col("c_custkey").cast("bigint")]).alias("key"),
        keys.hash_key([F.lit(None).cast("string")]).alias("empty_key"),
    )


# ---- text rules -----------------------------------------------------------------------------


@query(
    "scalar_text",
    """
    SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low, trim('  ' || p_name || ' ') AS tr,
           substr(p_name, 1, 3) AS head, substr(p_name, -4, 4) AS tail, left(p_brand, 5) AS l5,
           lpad(p_size::VARCHAR, 4, '0') AS padded, rpad(p_type, 10, '.') AS r_padded,
           length(p_name) AS n, p_brand || '/' || p_type AS joined,
           concat_ws('-', p_brand, NULL, p_type) AS joined_ws, replace(p_brand, '#', '') AS repl,
           translate(p_type, 'AEIOU', 'aeiou') AS transl, split_part(p_name, ' ', 2) AS word2,
           instr(p_name, ' ') AS at_blank, nullif(regexp_extract(p_brand, '([0-9]+)', 1), '') AS num,
           regexp_replace(p_brand, '[^0-9]', '', 'g') AS digits,
           array_to_string(list_transform(string_split(p_name, ' '),
                           lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ') AS capped,
           rtrim(p_name || '  ') AS rtr, len(string_split(p_name, ' ')) AS n_words
    FROM part
    """,
)
def scalar_text(t: Tables):
    name, brand, kind = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    return t.part.select(
        "p_partkey",
        F.upper(name).alias("up"), F.lower(brand).alias("low"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("tr"),
        F.substring(name, 1, 3).alias("head"), F.substring(name, -4, 4).alias("tail"),
        F.left(brand, F.lit(5)).alias("l5"),
        F.lpad(F.col("p_size").cast("string"), 4, "0").alias("padded"),
        F.rpad(kind, 10, ".").alias("r_padded"), F.length(name).alias("n"),
        F.concat(brand, F.lit("/"), kind).alias("joined"),
        F.concat_ws("-", brand, F.lit(None).cast("string"), kind).alias("joined_ws"),
        F.replace(brand, F.lit("#"), F.lit("")).alias("repl"),
        F.translate(kind, "AEIOU", "aeiou").alias("transl"),
        F.get(F.split(name, " "), 1).alias("word2"),
        F.instr(name, F.lit(" ")).alias("at_blank"),
        F.nullif(F.regexp_extract(brand, "([0-9]+)", 1), F.lit("")).alias("num"),
        text.digits_only(brand).alias("digits"),
        F.initcap(name).alias("capped"), F.rtrim(F.concat(name, F.lit("  "))).alias("rtr"),
        F.size(F.split(name, " ")).alias("n_words"),
    )


@query(
    "scalar_dates",
    f"""
    SELECT o_orderkey, {sql_month('o_orderdate')}::VARCHAR AS month,
           CAST({sql_month('o_orderdate')} - INTERVAL 2 MONTH AS DATE)::VARCHAR AS two_back,
           CAST(o_orderdate + INTERVAL 5 DAY AS DATE)::VARCHAR AS plus5,
           CAST(o_orderdate - INTERVAL 1 DAY AS DATE)::VARCHAR AS minus1,
           datediff('day', o_orderdate, DATE '2000-06-01') AS days_to_run,
           datediff('month', {sql_month('o_orderdate')}, DATE '2000-06-01') AS months_to_run,
           strftime(o_orderdate, '%Y%m%d') AS code,
           strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d')::DATE::VARCHAR AS parsed
    FROM orders
    """,
)
def scalar_dates(t: Tables):
    d, run = F.col("o_orderdate"), F.lit(RUN)
    code = F.date_format(d, "yyyyMMdd")
    return t.orders.select(
        "o_orderkey", dates.month_start(d).alias("month"),
        F.add_months(dates.month_start(d), -2).alias("two_back"),
        F.date_add(day(d), 5).alias("plus5"), F.date_sub(day(d), 1).alias("minus1"),
        F.datediff(run, day(d)).alias("days_to_run"),
        dates.months_apart(run, dates.month_start(d)).alias("months_to_run"),
        code.alias("code"), F.try_to_date(code, "yyyyMMdd").alias("parsed"),
    )


@query(
    "scalar_numbers",
    f"""
    SELECT l_orderkey, l_linenumber,
           CAST(round({sql_money('l_extendedprice')} * CAST(l_discount AS DECIMAL(4,2)), 2)
                AS DOUBLE) AS discount,
           CAST(least({sql_money('l_extendedprice')}, 50000) AS DOUBLE) AS capped,
           CAST(greatest(l_quantity, NULL, 10) AS DOUBLE) AS floored,
           CAST(abs({sql_money('l_extendedprice')} * -1) AS DOUBLE) AS positive,
           CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity / 4 END AS quarter,
           TRY_CAST(l_returnflag AS BIGINT) AS bad_int, CAST(l_quantity AS BIGINT) AS qty
    FROM lineitem
    """,
)
def scalar_numbers(t: Tables):
    price, disc = money("l_extendedprice"), F.col("l_discount").cast("decimal(4,2)")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.round(price * disc, 2).alias("discount"),
        F.least(price, F.lit(50000)).alias("capped"),
        F.greatest("l_quantity", F.lit(None).cast("double"), F.lit(10.0)).alias("floored"),
        F.abs(price * -1).alias("positive"),
        F.when(disc != 0, F.try_divide("l_quantity", F.lit(4))).alias("quarter"),
        casts.safe_int("l_returnflag").alias("bad_int"),
        F.col("l_quantity").cast("int").alias("qty"),
    )


@query(
    "implied_decimal",
    """
    SELECT l_orderkey, l_linenumber,
           CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS DOUBLE) / 100 AS amount,
           CAST(l_linenumber AS DOUBLE) / 100 AS small_amount
    FROM lineitem
    """,
)
def implied_decimal(t: Tables):
    cents = (money("l_extendedprice") * 100).cast("bigint")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", text.implied_decimal(cents).alias("amount"),
        text.implied_decimal_text(F.col("l_linenumber").cast("string")).alias("small_amount"),
    )


@query(
    "pad_id",
    """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
           lpad(l_linenumber::VARCHAR, 2, '0') || lpad(l_orderkey::VARCHAR, 10, '0') ||
           lpad(l_suppkey::VARCHAR, greatest(3, length(l_suppkey::VARCHAR))::INT, '0') AS trans_id
    FROM lineitem
    """,
)
def pad_id(t: Tables):
    parts = ["l_linenumber", "l_orderkey", "l_suppkey"]
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
        text.pad_concat(parts, [2, 10, 3]).alias("trans_id"),
    )


@query(
    "normalize_id",
    """
    WITH d AS (SELECT c_custkey, CASE WHEN c_custkey < 100 THEN '00000000' || c_custkey || '-00'
                      ELSE replace(c_name, 'Customer#', 'doc.') || '-' || c_nationkey END AS raw
               FROM customer)
    SELECT c_custkey, regexp_replace(raw, '[^0-9]', '', 'g') AS digits,
           regexp_replace(upper(raw), '[^0-9A-Z]', '', 'g') AS alnum,
           CASE WHEN substr(regexp_replace(raw, '[^0-9]', '', 'g'), 1, 8) = '00000000' THEN '-1'
                ELSE regexp_replace(raw, '[^0-9]', '', 'g') END AS document,
           lpad(regexp_replace(upper(raw), '[^0-9A-Z]', '', 'g'), 16, '0') AS padded,
           CASE WHEN ltrim(raw, '0') = '' THEN '0'
                ELSE regexp_replace(ltrim(raw, '0'), '[^0-9a-zA-Z]', '', 'g') END AS stripped
    FROM d
    """,
)
def normalize_id(t: Tables):
    raw = F.when(
        F.col("c_custkey") < 100, F.concat(F.lit("00000000"), "c_custkey", F.lit("-00"))
    ).otherwise(
        F.concat(F.replace("c_name", F.lit("Customer#"), F.lit("doc.")), F.lit("-"), "c_nationkey")
    )
    ids = t.customer.select("c_custkey", raw.alias("raw"))
    return ids.select(
        "c_custkey", text.digits_only("raw").alias("digits"), text.alnum_upper("raw").alias("alnum"),
        text.normalize_id("raw").alias("document"), text.pad_id("raw", 16).alias("padded"),
        text.strip_leading_zeros("raw").alias("stripped"),
    )


@query(
    "split_phone",
    """
    WITH d AS (SELECT c_custkey, substr('0' || (11 + c_nationkey) || lpad(c_custkey::VARCHAR, 9, '9')
                      || '55', 1 + (c_custkey % 3)::INT, (8 + c_custkey % 6)::INT) AS p FROM customer)
    SELECT c_custkey, p,
           CASE length(p) WHEN 10 THEN substr(p, 1, 2) WHEN 12 THEN substr(p, 2, 2) END AS land_area,
           CASE length(p) WHEN 8 THEN p WHEN 10 THEN substr(p, 3) WHEN 12 THEN substr(p, 5) END
               AS land_number,
           CASE length(p) WHEN 11 THEN substr(p, 1, 2) WHEN 13 THEN substr(p, 2, 2) END
               AS mobile_area,
           CASE length(p) WHEN 9 THEN p WHEN 11 THEN substr(p, 3) WHEN 13 THEN substr(p, 5) END
               AS mobile_number
    FROM d
    """,
)
def split_phone(t: Tables):
    base = F.concat(
        F.lit("0"), (F.col("c_nationkey") + 11).cast("string"),
        F.lpad(F.col("c_custkey").cast("string"), 9, "9"), F.lit("55"),
    )
    phone = F.substring(
        base, (F.col("c_custkey") % 3 + 1).cast("int"), (F.col("c_custkey") % 6 + 8).cast("int")
    )
    phones = t.customer.select("c_custkey", phone.alias("p"))
    return phones.withColumns(text.split_phone("p"))


@query(
    "fold_accents",
    """
    SELECT doc_id, upper(translate(ltrim(replace(text, 'ß', 'ss')),
      'ŠŽšžŸÁÇÉÍÓÚÀÈÌÒÙÂÊÎÔÛÃÕËÜÏÖÑÝåáçéíóúàèìòùâêîôûãõëüïöñýÿ',
      'SZszYACEIOUAEIOUAEIOUAOEUIONYaaceiouaeiouaeiouaoeuionyy')) AS folded
    FROM documents
    """,
)
def fold_accents(t: Tables):
    return t.documents.select("doc_id", text.fold_accents("text").alias("folded"))


@query(
    "blank_unless",
    """
    SELECT doc_id, CASE WHEN regexp_matches(text, '\\b(the|of)\\b') THEN lang END AS lang,
           CASE WHEN regexp_matches(text, '\\b(the|of)\\b') THEN source END AS source FROM documents
    """,
)
def blank_unless(t: Tables):
    docs = t.documents.select("doc_id", "lang", "source", "text")
    keep = text.contains_any_word("text", ["the", "of"], whole=True)
    return keys.blank_unless(docs, ["lang", "source"], keep).drop("text")


@query(
    "clean_dates",
    """
    WITH r AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y%m%d')
                      WHEN 'O' THEN '00000000' ELSE '0' END AS d,
                      CASE o_orderstatus WHEN 'F' THEN '1' || (o_orderkey % 10) || '3045'
                      ELSE '000000' END AS h FROM orders)
    SELECT o_orderkey,
           CASE WHEN d NOT IN ('00000000', '0') THEN strptime(d, '%Y%m%d')::DATE::VARCHAR END
               AS clean_day,
           CASE WHEN d NOT IN ('00000000', '0') THEN d::BIGINT ELSE -1 END AS day_key,
           CASE WHEN h <> '000000' THEN substr(h, 1, 2) || ':' || substr(h, 3, 2) || ':' ||
                substr(h, 5, 2) END AS clean_hour,
           CASE WHEN h <> '000000' THEN substr(h, 1, 4)::BIGINT ELSE -1 END AS hour_key
    FROM r
    """,
)
def clean_dates(t: Tables):
    status = F.col("o_orderstatus")
    raw = t.orders.select(
        "o_orderkey",
        F.when(status == "F", F.date_format("o_orderdate", "yyyyMMdd"))
        .when(status == "O", "00000000").otherwise("0").alias("d"),
        F.when(status == "F", F.concat(F.lit("1"), F.col("o_orderkey") % 10, F.lit("3045")))
        .otherwise("000000").alias("h"),
    )
    return raw.select(
        "o_orderkey", dates.clean_date("d").alias("clean_day"), dates.date_key("d").alias("day_key"),
        dates.clean_time("h").alias("clean_hour"), dates.time_key("h").alias("hour_key"),
    )


@query(
    "extract_code",
    """
    WITH d AS (SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'BL-' WHEN 'SMALL' THEN 'QA-'
                      WHEN 'MEDIUM' THEN 'ZZ-' ELSE 'EV-' END || (p_size % 10) || '-' ||
                      lpad(p_size::VARCHAR, 2, '0') || ' ' || p_name AS descr FROM part)
    SELECT p_partkey, CASE WHEN regexp_matches(descr, '(BL|QA|SF|EV)-[0-9]-[0-9]{2}')
                           THEN substr(descr, 1, 2) ELSE 'XX' END AS code,
           CASE WHEN regexp_matches(descr, '(BL|QA|SF|EV)-[0-9]-[0-9]{2}')
                THEN substr(descr, 4, 1) ELSE '-1' END AS impact FROM d
    """,
)
def extract_code(t: Tables):
    kind = F.col("p_type")
    descr = F.concat(
        F.when(kind == "PROMO", "BL-").when(kind == "SMALL", "QA-").when(kind == "MEDIUM", "ZZ-")
        .otherwise("EV-"),
        F.col("p_size") % 10, F.lit("-"), F.lpad(F.col("p_size").cast("string"), 2, "0"),
        F.lit(" "), "p_name",
    )
    coded = t.part.select("p_partkey", descr.alias("descr")).withColumns(
        text.extract_code("descr")
    )
    return coded.drop("descr").fillna({"code": "XX", "impact": "-1"})


@query(
    "parse_location",
    """
    WITH d AS (
      SELECT p_partkey, CASE WHEN p_size > 25 THEN 'BR' ELSE 'AC' END || p_size AS plant,
             CASE p_type WHEN 'PROMO' THEN 'X-' || p_partkey || '-LIN' || p_size
               WHEN 'SMALL' THEN 'X-1-A' || p_size || '-L-' || p_partkey
               WHEN 'MEDIUM' THEN 'X-2-B-L' || p_size WHEN 'LARGE' THEN 'AB- -C' || p_size
               WHEN 'ECONOMY' THEN 'ABC-' || p_size || '-Q' ELSE NULL END AS loc FROM part),
    g AS (SELECT *, string_split(loc, '-') AS a FROM d),
    h AS (SELECT *, a[1] AS g1, a[2] AS g2, a[3] AS g3, a[len(a)] AS gl,
                 substr(loc, length(a[1]) + length(a[2]) + 3) AS rest,
                 substr(rpad(trim(a[2]), 5, '0'), 1, 5) AS pad5 FROM g)
    SELECT p_partkey, loc,
      CASE WHEN plant LIKE 'BR%' THEN CASE WHEN pad5 = '00000' AND loc <> '-' THEN g2 || rest
                                           ELSE trim(pad5) END
           WHEN length(g1) = 1 THEN g3 WHEN loc IS NULL OR length(g1) > 1 THEN trim(pad5) END
        AS area,
      CASE WHEN plant LIKE 'BR%' THEN CASE WHEN pad5 = '00000' AND loc <> '-' THEN g2 || rest
                                           ELSE trim(pad5) END
           WHEN length(g1) = 1 THEN
             CASE WHEN contains(gl, 'LIN') THEN gl
                  WHEN contains(loc, '-L-')
                    THEN replace(regexp_extract(loc, '-L-\\w+'), '-', '')
                  ELSE nullif(regexp_extract(gl, '^L[0-9]\\w+'), '') END
           WHEN loc IS NULL OR length(g1) > 1 THEN trim(pad5) END AS subarea
    FROM h
    """,
)
def parse_location(t: Tables):
    kind, size = F.col("p_type"), F.col("p_size").cast("string")
    loc = (
        F.when(kind == "PROMO", F.concat(F.lit("X-"), "p_partkey", F.lit("-LIN"), size))
        .when(kind == "SMALL", F.concat(F.lit("X-1-A"), size, F.lit("-L-"), "p_partkey"))
        .when(kind == "MEDIUM", F.concat(F.lit("X-2-B-L"), size))
        .when(kind == "LARGE", F.concat(F.lit("AB- -C"), size))
        .when(kind == "ECONOMY", F.concat(F.lit("ABC-"), size, F.lit("-Q")))
    )
    plant = F.concat(F.when(F.col("p_size") > 25, "BR").otherwise("AC"), size)
    places = t.part.select("p_partkey", loc.alias("loc"), plant.alias("plant"))
    return places.withColumns(text.parse_location("loc", "plant")).drop("plant")


@query(
    "flag_any",
    """
    SELECT o_orderkey,
           CASE WHEN regexp_matches(upper(o_orderpriority), '(URGENT|HIGH)') THEN 1 ELSE 0 END
               AS is_urgent,
           CASE WHEN o_orderpriority LIKE '%SPEC%' OR o_orderpriority LIKE '%LOW%' THEN 1 ELSE 0
           END AS is_slow
    FROM orders
    """,
)
def flag_any(t: Tables):
    priority = F.upper("o_orderpriority")
    return t.orders.select(
        "o_orderkey",
        text.contains_any_word(priority, ["URGENT", "HIGH"]).cast("int").alias("is_urgent"),
        F.when(priority.like("%SPEC%") | priority.like("%LOW%"), 1).otherwise(0).alias("is_slow"),
    )


