"""Projections, predicates, joins, aggregates, windows and set operations on the sample tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from braidlake.functions.dates import month_start
from braidlake.functions.keys import differs_by_sentinel
from braidlake.operators import bitmaps
from braidlake.operators.select import latest_by, rank_within
from braidlake.operators.union import rename_map
from braidlake.plans.registry import Tables, day, money, query, sql_money, sql_month
from braidlake.sources import lake

PRICE = sql_money("l_extendedprice")
TOTAL = sql_money("o_totalprice")


# ---- projections, filters, predicates -------------------------------------------------------


@query(
    "project_derive",
    f"""
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE)::VARCHAR
               AS order_date,
           strftime(o_orderdate, '%Y-%m') AS ref_month,
           CAST({TOTAL} * 2 AS DOUBLE) AS doubled,
           CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS is_priority,
           CASE WHEN o_totalprice > 0 THEN 1 ELSE 0 END AS is_active,
           CAST(NULL AS VARCHAR) AS closed_by
    FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100
    """,
)
def project_derive(t: Tables):
    kept = t.orders.filter(F.col("o_orderstatus") == "F").filter(F.col("o_totalprice") > 100)
    renamed = rename_map(
        kept,
        {
            "o_orderkey": "order_id", "o_custkey": "customer_id", "o_orderdate": "placed",
            "o_totalprice": "total", "o_orderpriority": "priority",
        },
    )
    return renamed.withColumns(
        {
            "order_date": F.to_date("placed"),
            "ref_month": F.date_format("placed", "yyyy-MM"),
            "doubled": money("total") * 2,
            "is_priority": F.when(F.col("priority").isin("1-URGENT", "2-HIGH"), 1).otherwise(0),
            "is_active": F.when(F.col("total") > 0, 1).otherwise(0),
            "closed_by": F.lit(None).cast("string"),
        }
    ).drop("placed", "total", "priority", "not_there")


@query(
    "select_expr_hash",
    """SELECT sha256(c_name) AS name_hash, c_mktsegment AS segment FROM customer
       WHERE c_acctbal > 0""",
)
def select_expr_hash(t: Tables):
    return t.customer.where("c_acctbal > 0").selectExpr(
        "sha2(c_name, 256) AS name_hash", "c_mktsegment AS segment"
    )


@query(
    "legacy_sql",
    "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0",
)
def legacy_sql(t: Tables):
    t.customer.createOrReplaceTempView("braidlake_customer")
    return lake.read_sql(
        t.spark,
        "SELECT c_custkey, c_acctbal FROM braidlake_customer WHERE c_acctbal > :floor",
        floor=0,
    )


@query(
    "predicates",
    """
    SELECT p_partkey,
           CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 1 ELSE 0 END AS in_list,
           CASE WHEN p_type NOT IN ('PROMO', 'SMALL') THEN 1 ELSE 0 END AS not_in_list,
           CASE WHEN p_name LIKE '%ring%' THEN 1 ELSE 0 END AS is_ring,
           CASE WHEN p_name NOT LIKE 'red%' THEN 1 ELSE 0 END AS not_red,
           CASE WHEN p_name ILIKE '%BOLT' THEN 1 ELSE 0 END AS is_bolt,
           CASE WHEN regexp_matches(p_name, '\\b(red|blue)\\b') THEN 1 ELSE 0 END AS coloured,
           CASE WHEN p_size IS NULL THEN 1 ELSE 0 END AS no_size,
           CASE WHEN p_brand || '-' || p_type <> 'Brand#1-PROMO'
                 AND (p_size BETWEEN 5 AND 20 OR (p_type = 'PROMO' AND p_size > 40))
                THEN 1 ELSE 0 END AS in_scope
    FROM part WHERE p_retailprice IS NOT NULL AND p_retailprice <> 0
    """,
)
def predicates(t: Tables):
    name, kind, size = F.col("p_name"), F.col("p_type"), F.col("p_size")
    scope = (F.concat("p_brand", F.lit("-"), "p_type") != "Brand#1-PROMO") & (
        size.between(5, 20) | ((kind == "PROMO") & (size > 40))
    )
    tests = {
        "in_list": kind.isin("PROMO", "SMALL"),
        "not_in_list": ~kind.isin("PROMO", "SMALL"),
        "is_ring": name.contains("ring"),
        "not_red": ~name.like("red%"),
        "is_bolt": name.ilike("%BOLT"),
        "coloured": name.rlike(r"\b(red|blue)\b"),
        "no_size": size.isNull(),
        "in_scope": scope,
    }
    return t.part.filter(
        F.col("p_retailprice").isNotNull() & (F.col("p_retailprice") != 0)
    ).select("p_partkey", *[F.when(c, 1).otherwise(0).alias(n) for n, c in tests.items()])


@query(
    "case_forms",
    """
    SELECT o_orderkey,
           CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE 'other' END AS state,
           CASE WHEN o_totalprice >= 300000 THEN 'high' WHEN o_totalprice >= 100000 THEN 'mid'
                ELSE 'low' END AS band,
           CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3
                ELSE 9 END AS priority_code
    FROM orders
    """,
)
def case_forms(t: Tables):
    status = F.col("o_orderstatus")
    return t.orders.select(
        "o_orderkey",
        F.when(status == "F", "final").when(status == "O", "open").otherwise("other")
        .alias("state"),
        F.when(F.col("o_totalprice") >= 300000, "high")
        .when(F.col("o_totalprice") >= 100000, "mid")
        .otherwise("low")
        .alias("band"),
        F.expr("decode(o_orderpriority, '1-URGENT', 1, '2-HIGH', 2, '3-MEDIUM', 3, 9)")
        .alias("priority_code"),
    )


@query(
    "boolean_and_sentinel",
    """
    WITH d AS (
        SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))
    SELECT doc_id, CASE WHEN quality = 1 AND NOT (toxic = 1) THEN 1 ELSE 0 END AS good,
           CASE WHEN coalesce(quality::VARCHAR, '') <> coalesce(toxic::VARCHAR, '')
                THEN 1 ELSE 0 END AS differs
    FROM d
    """,
)
def boolean_and_sentinel(t: Tables):
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left").withColumns(
        {"is_quality": F.col("quality") == 1, "is_toxic": F.col("toxic") == 1}
    )
    return joined.select(
        "doc_id",
        F.when(F.expr("is_quality is true") & (F.col("is_toxic") == F.lit(False)), 1)
        .otherwise(0).alias("good"),
        F.when(differs_by_sentinel(F.col("quality"), F.col("toxic")), 1).otherwise(0)
        .alias("differs"),
    )


@query(
    "date_window",
    f"""
    SELECT {sql_month('o_orderdate')}::VARCHAR AS month, count(*) AS n_orders,
           CAST(sum({TOTAL}) AS DOUBLE) AS total
    FROM orders
    WHERE o_orderdate >= DATE '2000-04-01' AND o_orderdate < DATE '2000-07-01' GROUP BY 1
    """,
)
def date_window(t: Tables):
    recent = t.orders.filter(
        (F.col("o_orderdate") >= F.lit(dt.date(2000, 4, 1)))
        & (F.col("o_orderdate") < F.lit(dt.date(2000, 7, 1)))
    )
    return recent.groupBy(month_start("o_orderdate").alias("month")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(money("o_totalprice")).alias("total")
    )


# ---- joins ----------------------------------------------------------------------------------


@query(
    "join_inner_name",
    f"""
    SELECT o_custkey AS custkey, CAST(sum({TOTAL}) AS DOUBLE) AS total
    FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'F' GROUP BY 1
    """,
)
def join_inner_name(t: Tables):
    customers = t.customer.select(F.col("c_custkey").alias("custkey"))
    finals = t.orders.filter(F.col("o_orderstatus") == "F").withColumnRenamed(
        "o_custkey", "custkey"
    )
    return finals.join(customers, "custkey").groupBy("custkey").agg(
        F.sum(money("o_totalprice")).alias("total")
    )


@query(
    "join_left_chain",
    """
    SELECT c_custkey, c_name, n_name AS nation, r_name AS region, count(o_orderkey) AS n_orders
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey
    LEFT JOIN orders ON o_custkey = c_custkey
    GROUP BY 1, 2, 3, 4
    """,
)
def join_left_chain(t: Tables):
    # The order side is grouped before it meets the spine, so the spine keeps its grain.
    counts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("o_orderkey").alias("n_orders")
    )
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.col("n_nationkey").alias("c_nationkey"),
        F.col("n_name").alias("nation"),
        F.col("r_name").alias("region"),
    )
    return (
        t.customer.join(geo, "c_nationkey", "left")
        .join(counts, "c_custkey", "left")
        .select("c_custkey", "c_name", "nation", "region",
                F.coalesce("n_orders", F.lit(0)).alias("n_orders"))
    )


@query(
    "join_constants_in_on",
    """
    SELECT l_orderkey, l_linenumber, l_quantity, o_orderpriority
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = 'O'
         AND l_returnflag = 'R' AND l_linestatus = 'O'
    """,
)
def join_constants_in_on(t: Tables):
    li, o = t.lineitem, t.orders
    on = (
        (o.o_orderkey == li.l_orderkey) & (o.o_orderstatus == "O")
        & (li.l_returnflag == "R") & (li.l_linestatus == "O")
    )
    return li.join(o, on).select("l_orderkey", "l_linenumber", "l_quantity", "o_orderpriority")


@query(
    "left_right_filter",
    """
    SELECT c_custkey, count(o_orderkey) AS n_urgent
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT'
    GROUP BY 1
    """,
)
def left_right_filter(t: Tables):
    # Counted before the join: the right side of an outer join cannot be split when it is skewed.
    urgent = (
        t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count("o_orderkey").alias("n_urgent"))
    )
    return t.customer.join(urgent, "c_custkey", "left").select(
        "c_custkey", F.coalesce("n_urgent", F.lit(0)).alias("n_urgent")
    )


@query(
    "left_on_filter",
    """
    SELECT c_custkey, c_mktsegment, count(o_orderkey) AS n_orders
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND c_mktsegment = 'BUILDING'
    GROUP BY 1, 2
    """,
)
def left_on_filter(t: Tables):
    # The condition is on the left side: every customer stays, only BUILDING ones find orders.
    counts = t.orders.groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"))
    on = (F.col("c_custkey") == F.col("o_custkey")) & (F.col("c_mktsegment") == "BUILDING")
    return t.customer.join(counts, on, "left").select(
        "c_custkey", "c_mktsegment", F.coalesce("n", F.lit(0)).alias("n_orders")
    )


@query(
    "full_outer_merge",
    """
    WITH c AS (SELECT c_nationkey k, count(*) n FROM customer WHERE c_acctbal > 5000 GROUP BY 1),
         s AS (SELECT s_nationkey k, count(*) n FROM supplier GROUP BY 1)
    SELECT coalesce(c.k, s.k) AS nationkey, coalesce(c.n, 0) AS n_customers,
           coalesce(s.n, 0) AS n_suppliers
    FROM c FULL OUTER JOIN s ON c.k = s.k
    """,
)
def full_outer_merge(t: Tables):
    c = t.customer.filter("c_acctbal > 5000").groupBy(F.col("c_nationkey").alias("nationkey")).agg(
        F.count(F.lit(1)).alias("n_customers")
    )
    s = t.supplier.groupBy(F.col("s_nationkey").alias("nationkey")).agg(
        F.count(F.lit(1)).alias("n_suppliers")
    )
    return c.join(s, "nationkey", "full").fillna(0, ["n_customers", "n_suppliers"])


@query(
    "full_outer_month_offset",
    f"""
    WITH m AS (SELECT o_orderpriority p, {sql_month('o_orderdate')} m, count(*) n
               FROM orders GROUP BY 1, 2)
    SELECT coalesce(cur.p, prev.p) AS priority,
           coalesce(cur.m, CAST(prev.m + INTERVAL 1 MONTH AS DATE))::VARCHAR AS month,
           coalesce(cur.n, 0) AS n_now, coalesce(prev.n, 0) AS n_before
    FROM m cur FULL OUTER JOIN m prev
      ON prev.p = cur.p AND CAST(prev.m + INTERVAL 1 MONTH AS DATE) = cur.m
    """,
)
def full_outer_month_offset(t: Tables):
    now = t.orders.groupBy(
        F.col("o_orderpriority").alias("priority"), month_start("o_orderdate").alias("month")
    ).agg(F.count(F.lit(1)).alias("n_now"))
    before = now.select(
        "priority", F.add_months("month", 1).alias("month"), F.col("n_now").alias("n_before")
    )
    return now.join(before, ["priority", "month"], "full").fillna(0, ["n_now", "n_before"])


@query(
    "semi_exists",
    """
    SELECT c_custkey, c_name FROM customer
    WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)
    """,
)
def semi_exists(t: Tables):
    # Distinct keys first: a customer with very many orders is one row on the right side.
    big = (
        t.orders.filter(F.col("o_totalprice") > 400000)
        .select(F.col("o_custkey").alias("c_custkey")).distinct()
    )
    return t.customer.join(big, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query(
    "semi_in_or_flag",
    """
    SELECT c_custkey FROM customer
    WHERE c_mktsegment = 'BUILDING'
       OR c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
    """,
)
def semi_in_or_flag(t: Tables):
    # IN joined by OR with another condition: a flag column, then one filter.
    urgent = (
        t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
        .select(F.col("o_custkey").alias("c_custkey"), F.lit(True).alias("has_urgent")).distinct()
    )
    return (
        t.customer.join(urgent, "c_custkey", "left")
        .filter((F.col("c_mktsegment") == "BUILDING") | F.col("has_urgent").isNotNull())
        .select("c_custkey")
    )


@query(
    "anti_not_exists",
    """
    SELECT c_custkey FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
                      AND (o_totalprice > 450000 OR o_orderdate >= DATE '2001-07-01'))
    """,
)
def anti_not_exists(t: Tables):
    # Both alternatives are about the inner rows only, so they are a filter of that side.
    hit = (F.col("o_totalprice") > 450000) | (F.col("o_orderdate") >= F.lit(dt.date(2001, 7, 1)))
    found = t.orders.filter(hit).select(F.col("o_custkey").alias("c_custkey")).distinct()
    return t.customer.join(found, "c_custkey", "left_anti").select("c_custkey")


@query(
    "anti_null_test",
    """
    SELECT o_orderkey FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
    WHERE l_orderkey IS NULL
    """,
)
def anti_null_test(t: Tables):
    with_lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return t.orders.join(with_lines, "o_orderkey", "left_anti").select("o_orderkey")


@query(
    "anti_and_inner_range",
    f"""
    WITH r AS (SELECT o_custkey, {sql_month('min(o_orderdate)')} AS started FROM orders
               WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
    SELECT o_orderkey, 'before' AS side FROM orders o
    WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.o_custkey = o.o_custkey
                      AND o.o_orderdate >= r.started)
    UNION ALL
    SELECT o_orderkey, 'after' FROM orders o JOIN r
      ON r.o_custkey = o.o_custkey AND o.o_orderdate >= r.started
    """,
)
def anti_and_inner_range(t: Tables):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    r = (
        t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
        .groupBy(F.col("o_custkey").alias("r_custkey"))
        .agg(month_start(F.min("o_orderdate")).alias("started"))
    )
    on = (o.o_custkey == r.r_custkey) & (o.o_orderdate >= r.started)
    before = o.join(r, on, "left_anti").select("o_orderkey", F.lit("before").alias("side"))
    after = o.join(r, on, "inner").select("o_orderkey", F.lit("after").alias("side"))
    return before.unionAll(after)


@query(
    "group_max_join",
    f"""
    SELECT o_custkey, CAST(max({TOTAL}) AS DOUBLE) AS first_total,
           CAST(min(o_orderdate) AS DATE)::VARCHAR AS first_date
    FROM orders JOIN (SELECT o_custkey k, min(o_orderdate) d FROM orders GROUP BY 1) m
      ON m.k = o_custkey AND m.d = o_orderdate
    GROUP BY 1
    """,
)
def group_max_join(t: Tables):
    # First order of a customer and the largest amount on that day: grouped by day first, so the
    # table is read and shuffled once instead of being joined to its own minimum.
    per_day = t.orders.groupBy("o_custkey", "o_orderdate").agg(
        F.max(money("o_totalprice")).alias("total")
    )
    return per_day.groupBy("o_custkey").agg(
        F.min_by("total", "o_orderdate").alias("first_total"),
        F.min("o_orderdate").cast("date").alias("first_date"),
    )


@query(
    "equi_interval_join",
    f"""
    WITH span AS (SELECT o_custkey k, {sql_month('min(o_orderdate)')} lo,
                         {sql_month('max(o_orderdate)')} hi
                  FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
    SELECT o_orderkey, CASE WHEN k IS NULL THEN 0 ELSE 1 END AS inside
    FROM orders LEFT JOIN span ON k = o_custkey AND o_orderdate >= lo AND o_orderdate < hi
    """,
)
def equi_interval_join(t: Tables):
    span = (
        t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
        .groupBy(F.col("o_custkey").alias("k"))
        .agg(month_start(F.min("o_orderdate")).alias("lo"),
             month_start(F.max("o_orderdate")).alias("hi"))
    )
    o = t.orders
    on = (span.k == o.o_custkey) & (o.o_orderdate >= span.lo) & (o.o_orderdate < span.hi)
    return o.join(span, on, "left").select(
        "o_orderkey", F.when(F.col("k").isNull(), 0).otherwise(1).alias("inside")
    )


@query(
    "self_parent",
    """
    SELECT c.n_nationkey AS nationkey, c.n_name AS name, p.n_name AS parent_name
    FROM nation c LEFT JOIN nation p ON c.n_regionkey = p.n_nationkey
    """,
)
def self_parent(t: Tables):
    child, parent = t.nation.alias("c"), t.nation.alias("p")
    return child.join(parent, F.col("c.n_regionkey") == F.col("p.n_nationkey"), "left").select(
        F.col("c.n_nationkey").alias("nationkey"),
        F.col("c.n_name").alias("name"),
        F.col("p.n_name").alias("parent_name"),
    )


@query(
    "computed_key_join",
    """
    SELECT c_custkey, s_suppkey FROM customer
    JOIN supplier ON lpad(CAST(s_suppkey AS VARCHAR), 9, '0') = right(c_name, 9)
    """,
)
def computed_key_join(t: Tables):
    c = t.customer.withColumn("code", F.substring("c_name", -9, 9))
    s = t.supplier.withColumn("code", F.lpad(F.col("s_suppkey").cast("string"), 9, "0"))
    return c.join(s, "code").select("c_custkey", "s_suppkey")


@query(
    "null_safe_key_join",
    """
    WITH a AS (SELECT quality, toxic, count(*) n FROM documents LEFT JOIN labels USING (doc_id)
               WHERE lang = 'en' GROUP BY 1, 2),
         b AS (SELECT quality, toxic, count(*) n FROM documents LEFT JOIN labels USING (doc_id)
               WHERE lang <> 'en' GROUP BY 1, 2)
    SELECT a.quality, a.toxic, a.n AS n_en, b.n AS n_other FROM a JOIN b
      ON a.quality IS NOT DISTINCT FROM b.quality AND a.toxic IS NOT DISTINCT FROM b.toxic
    """,
)
def null_safe_key_join(t: Tables):
    labelled = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    a = labelled.filter("lang = 'en'").groupBy("quality", "toxic").agg(
        F.count(F.lit(1)).alias("n_en")
    ).alias("a")
    b = labelled.filter("lang <> 'en'").groupBy("quality", "toxic").agg(
        F.count(F.lit(1)).alias("n_other")
    ).alias("b")
    on = F.col("a.quality").eqNullSafe(F.col("b.quality")) & F.col("a.toxic").eqNullSafe(
        F.col("b.toxic")
    )
    return a.join(b, on).select("a.quality", "a.toxic", "n_en", "n_other")


@query(
    "distinct_subquery_join",
    """
    SELECT p_brand, count(*) AS n_lines FROM lineitem
    JOIN (SELECT DISTINCT p_partkey, p_brand FROM part) ON p_partkey = l_partkey GROUP BY 1
    """,
)
def distinct_subquery_join(t: Tables):
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand").distinct()
    # Lines are counted per part before the join, so the join sees one row per part.
    counts = t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(parts, "l_partkey").groupBy("p_brand").agg(F.sum("n").alias("n_lines"))


@query(
    "scalar_correlated",
    f"""
    SELECT o_orderkey,
           coalesce(CAST((SELECT sum({PRICE}) FROM lineitem WHERE l_orderkey = o_orderkey)
                    AS DOUBLE), 0) AS line_total,
           coalesce(CAST((SELECT sum({PRICE}) FROM lineitem
                          WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AS DOUBLE), 0)
               AS returned_total
    FROM orders
    """,
)
def scalar_correlated(t: Tables):
    price = money("l_extendedprice")
    sums = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(price).alias("line_total"),
        F.sum(F.when(F.col("l_returnflag") == "R", price)).alias("returned_total"),
    )
    return t.orders.select("o_orderkey").join(sums, "o_orderkey", "left").select(
        "o_orderkey",
        F.coalesce("line_total", F.lit(0)).alias("line_total"),
        F.coalesce("returned_total", F.lit(0)).alias("returned_total"),
    )


@query(
    "correlated_where",
    """
    SELECT o_orderkey, o_custkey FROM orders o
    WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders i WHERE i.o_custkey = o.o_custkey
                        AND i.o_orderstatus = o.o_orderstatus)
    """,
)
def correlated_where(t: Tables):
    # The row that holds the maximum of its group is the maximum itself.
    return t.orders.groupBy("o_custkey", "o_orderstatus").agg(
        F.max("o_orderkey").alias("o_orderkey")
    ).select("o_orderkey", "o_custkey")


@query(
    "date_lookup",
    f"""
    WITH cal AS (SELECT CAST(strftime(d, '%Y%m%d') AS VARCHAR) code, {sql_month('d')} m,
                        CASE WHEN isodow(d) <= 5 THEN 1 ELSE 0 END workday
                 FROM (SELECT unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE),
                       INTERVAL 1 DAY)) d FROM orders))
    SELECT m::VARCHAR AS month, sum(workday)::BIGINT AS n_on_workdays, count(*) AS n_orders
    FROM orders LEFT JOIN cal ON code = strftime(o_orderdate, '%Y%m%d') GROUP BY 1
    """,
)
def date_lookup(t: Tables):
    # One row per day between the first and the last order: bounded by the years they cover, so
    # broadcasting is safe.
    span = t.orders.agg(F.min(day("o_orderdate")).alias("first"), F.max(day("o_orderdate")).alias("last"))
    days = span.select(F.explode(F.sequence("first", "last")).alias("d")).select(
        F.date_format("d", "yyyyMMdd").alias("code"),
        month_start("d").alias("month"),
        F.when(F.weekday("d") < 5, 1).otherwise(0).alias("workday"),
    )
    orders = t.orders.select(F.date_format("o_orderdate", "yyyyMMdd").alias("code"))
    per_day = orders.groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    return per_day.join(F.broadcast(days), "code", "left").groupBy("month").agg(
        F.sum(F.col("n") * F.col("workday")).alias("n_on_workdays"), F.sum("n").alias("n_orders")
    )


@query(
    "trailing_interval_join",
    f"""
    WITH m AS (SELECT o_custkey k, {sql_month('o_orderdate')} m, count(*) n FROM orders
               GROUP BY 1, 2)
    SELECT a.k AS custkey, a.m::VARCHAR AS month, sum(b.n)::BIGINT AS n_12m
    FROM m a JOIN m b ON b.k = a.k AND b.m <= a.m AND b.m >= a.m - INTERVAL 11 MONTH
    GROUP BY 1, 2
    """,
)
def trailing_interval_join(t: Tables):
    # Months become integers, so the trailing sum is a RANGE frame and no row meets another.
    number = F.year("month") * 12 + F.month("month")
    monthly = (
        t.orders.groupBy(
            F.col("o_custkey").alias("custkey"), month_start("o_orderdate").alias("month")
        )
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("_no", number)
    )
    window = Window.partitionBy("custkey").orderBy("_no").rangeBetween(-11, 0)
    return monthly.select("custkey", "month", F.sum("n").over(window).alias("n_12m"))


# ---- aggregates -----------------------------------------------------------------------------


@query(
    "group_aggregates",
    f"""
    SELECT l_suppkey, CAST(sum({PRICE}) AS DOUBLE) AS total, count(l_orderkey) AS n_lines,
           count(DISTINCT l_orderkey) AS n_orders, count(DISTINCT l_partkey) AS n_parts,
           CAST(min(l_shipdate) AS DATE)::VARCHAR AS first_ship,
           CAST(sum(coalesce(CASE WHEN l_returnflag = 'R' THEN {PRICE} END, 0)) AS DOUBLE)
               AS returned,
           max(CASE WHEN l_discount > 0.09 THEN 1 ELSE 0 END) AS had_big_discount
    FROM lineitem GROUP BY 1
    """,
)
def group_aggregates(t: Tables):
    # Two distinct counts in one agg would copy every line per count. The lines are grouped by
    # supplier and order for all but the parts, which are counted on their own two columns.
    price = money("l_extendedprice")
    per_order = t.lineitem.groupBy("l_suppkey", "l_orderkey").agg(
        F.sum(price).alias("total"),
        F.count("l_orderkey").alias("n_lines"),
        F.min("l_shipdate").alias("first_ship"),
        F.sum(F.coalesce(F.when(F.col("l_returnflag") == "R", price), F.lit(0))).alias("returned"),
        F.max(F.when(F.col("l_discount") > 0.09, 1).otherwise(0)).alias("had_big_discount"),
    )
    sums = per_order.groupBy("l_suppkey").agg(
        F.sum("total").alias("total"),
        F.sum("n_lines").alias("n_lines"),
        F.count("l_orderkey").alias("n_orders"),
        F.min("first_ship").cast("date").alias("first_ship"),
        F.sum("returned").alias("returned"),
        F.max("had_big_discount").alias("had_big_discount"),
    )
    pairs = t.lineitem.select("l_suppkey", "l_partkey").distinct()
    parts = pairs.groupBy(F.col("l_suppkey").alias("_s")).agg(F.count("l_partkey").alias("n_parts"))
    return sums.join(parts, F.col("l_suppkey").eqNullSafe(F.col("_s"))).drop("_s")


@query(
    "pick_any",
    """
    SELECT source, max(lang) AS lang, max(n_chars) AS n_chars, min(doc_id) AS first_doc
    FROM documents GROUP BY 1
    """,
)
def pick_any(t: Tables):
    # One deterministic value per attribute collapses a key to one row. A largest text cannot be kept
    # in a hash table's fixed slots and would have all rows sorted: as a key it can be hashed.
    per_text = t.documents.groupBy("source", "lang").agg(
        F.max("n_chars").alias("n_chars"), F.min("doc_id").alias("first_doc")
    )
    return per_text.groupBy("source").agg(
        F.max("lang").alias("lang"), F.max("n_chars").alias("n_chars"), F.min("first_doc").alias("first_doc")
    )


@query(
    "filtered_aggs",
    f"""
    SELECT {sql_month('l_shipdate')}::VARCHAR AS month,
           CAST(sum({PRICE}) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) AS returned,
           count(*) FILTER (WHERE l_linestatus = 'O') AS n_open,
           count(DISTINCT l_suppkey) FILTER (WHERE l_returnflag NOT IN ('A')) AS n_suppliers,
           count(DISTINCT l_suppkey) FILTER (WHERE l_quantity > 25) AS n_bulk_suppliers,
           CAST(max(l_quantity) FILTER (WHERE l_returnflag = 'N') AS DOUBLE) AS max_kept_qty
    FROM lineitem GROUP BY 1
    """,
)
def filtered_aggs(t: Tables):
    # Both distinct counts are over suppliers: a bitmap each, in the one grouping of the lines.
    flag = F.col("l_returnflag")
    return bitmaps.grouped(
        t.lineitem.withColumn("month", month_start("l_shipdate")), ["month"], "l_suppkey",
        {"n_suppliers": ~flag.isin("A"), "n_bulk_suppliers": F.col("l_quantity") > 25},
        {
            "returned": ("sum", F.when(flag == "R", money("l_extendedprice"))),
            "n_open": ("count", F.when(F.col("l_linestatus") == "O", 1)),
            "max_kept_qty": ("max", F.when(flag == "N", F.col("l_quantity"))),
        },
    )


@query(
    "filtered_aggs_sql",
    f"""
    SELECT o_orderpriority, {sql_month('o_orderdate')}::VARCHAR AS month,
           CAST(sum({TOTAL}) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS final_total,
           count(DISTINCT o_custkey) FILTER (WHERE o_totalprice > 100000) AS n_large_customers
    FROM orders GROUP BY ALL
    """,
)
def filtered_aggs_sql(t: Tables):
    t.orders.createOrReplaceTempView("braidlake_orders")
    return lake.read_sql(
        t.spark,
        """
        SELECT o_orderpriority, trunc(o_orderdate, 'MM') AS month,
               sum(cast(o_totalprice AS decimal(18,2))) FILTER (WHERE o_orderstatus = 'F')
                   AS final_total,
               count(DISTINCT o_custkey) FILTER (WHERE o_totalprice > 100000) AS n_large_customers
        FROM braidlake_orders GROUP BY ALL
        """,
    )


@query(
    "having_max",
    """
    SELECT o_custkey, CAST(max(o_orderdate) AS DATE)::VARCHAR AS last_order FROM orders
    GROUP BY 1 HAVING max(o_orderdate) < DATE '2001-04-01'
    """,
)
def having_max(t: Tables):
    last = t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_order"))
    return last.filter(F.col("last_order") < F.lit(dt.date(2001, 4, 1))).withColumn(
        "last_order", day("last_order")
    )


@query(
    "two_level_agg",
    f"""
    WITH m AS (SELECT o_custkey, {sql_month('o_orderdate')} m, sum({TOTAL}) v FROM orders
               GROUP BY 1, 2)
    SELECT o_custkey, CAST(max(v) AS DOUBLE) AS best_month, count(*) AS n_months FROM m GROUP BY 1
    """,
)
def two_level_agg(t: Tables):
    monthly = t.orders.groupBy("o_custkey", month_start("o_orderdate").alias("m")).agg(
        F.sum(money("o_totalprice")).alias("v")
    )
    return monthly.groupBy("o_custkey").agg(
        F.max("v").alias("best_month"), F.count(F.lit(1)).alias("n_months")
    )


@query(
    "global_bounds",
    f"""
    SELECT CAST(min(o_orderdate) AS DATE)::VARCHAR AS first_day,
           CAST(max(o_orderdate) AS DATE)::VARCHAR AS last_day, count(*) AS n_orders,
           CAST(abs(sum({TOTAL})) AS DOUBLE) AS total FROM orders
    """,
)
def global_bounds(t: Tables):
    return t.orders.agg(
        F.min("o_orderdate").cast("date").alias("first_day"),
        F.max("o_orderdate").cast("date").alias("last_day"),
        F.count(F.lit(1)).alias("n_orders"),
        F.abs(F.sum(money("o_totalprice"))).alias("total"),
    )


@query(
    "distinct_then_sum",
    """
    SELECT l_suppkey, CAST(sum(q) AS DOUBLE) AS qty FROM
      (SELECT DISTINCT l_suppkey, l_partkey, l_quantity AS q FROM lineitem) GROUP BY 1
    """,
)
def distinct_then_sum(t: Tables):
    lines = t.lineitem.select("l_suppkey", "l_partkey", "l_quantity").distinct()
    return lines.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("qty"))


@query(
    "drop_duplicates",
    """
    SELECT o_custkey, o_orderpriority, max(o_orderkey) AS o_orderkey FROM orders GROUP BY 1, 2
    """,
)
def drop_duplicates(t: Tables):
    # One survivor per key; the largest order key makes the choice the same on every run.
    window = Window.partitionBy("o_custkey", "o_orderpriority").orderBy(F.desc("o_orderkey"))
    return (
        t.orders.select("o_custkey", "o_orderpriority", "o_orderkey")
        .withColumn("rn", F.row_number().over(window)).filter("rn = 1").drop("rn")
    )


@query(
    "string_agg",
    """
    SELECT p_brand, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS types FROM part GROUP BY 1
    """,
)
def string_agg(t: Tables):
    return t.part.select("p_brand", "p_type").distinct().groupBy("p_brand").agg(
        F.concat_ws(", ", F.sort_array(F.collect_set("p_type"))).alias("types")
    )


# ---- windows, sorts, sets -------------------------------------------------------------------


@query(
    "rank_keep_ties",
    """
    SELECT o_custkey, o_orderkey FROM (
        SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY
               coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END,
                        TIMESTAMP '2099-01-01') DESC) AS r FROM orders) WHERE r = 1
    """,
)
def rank_keep_ties(t: Tables):
    # Open-ended rows win, and all of them are kept.
    ends = F.coalesce(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")),
        F.lit("2099-01-01").cast("timestamp_ntz"),
    )
    dated = t.orders.select("o_custkey", "o_orderkey", ends.alias("ends"))
    return latest_by(dated, ["o_custkey"], "ends", ties="all").drop("ends")


@query(
    "row_number_kept",
    """
    SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey
           ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders
    """,
)
def row_number_kept(t: Tables):
    return rank_within(
        t.orders.select("o_orderkey", "o_custkey", "o_orderdate"),
        ["o_custkey"],
        [F.desc("o_orderdate"), F.desc("o_orderkey")],
        "rn",
        slices=[("month", month_start("o_orderdate"), True)],
    ).drop("o_orderdate")


@query(
    "lag_previous",
    f"""
    WITH m AS (SELECT o_orderpriority p, {sql_month('o_orderdate')} m, sum({TOTAL}) v FROM orders
               GROUP BY 1, 2)
    SELECT p AS priority, m::VARCHAR AS month, CAST(v AS DOUBLE) AS total,
           CAST(lag(v, 1, 0) OVER (PARTITION BY p ORDER BY m) AS DOUBLE) AS previous FROM m
    """,
)
def lag_previous(t: Tables):
    monthly = t.orders.groupBy(
        F.col("o_orderpriority").alias("priority"), month_start("o_orderdate").alias("month")
    ).agg(F.sum(money("o_totalprice")).alias("total"))
    window = Window.partitionBy("priority").orderBy("month")
    return monthly.withColumn("previous", F.lag("total", 1, 0).over(window))


@query(
    "set_ops",
    """
    SELECT 'distinct' AS how, k AS nationkey, count(*) AS n FROM
      (SELECT c_nationkey k FROM customer UNION SELECT s_nationkey FROM supplier) GROUP BY ALL
    UNION ALL
    SELECT 'all', k, count(*) FROM
      (SELECT c_nationkey k FROM customer UNION ALL SELECT s_nationkey FROM supplier) GROUP BY ALL
    """,
)
def set_ops(t: Tables):
    c = t.customer.select(F.col("c_nationkey").alias("nationkey"))
    s = t.supplier.select(F.col("s_nationkey").alias("nationkey"))
    both = c.unionAll(s)

    def counted(df, how):
        return df.groupBy("nationkey").agg(F.count(F.lit(1)).alias("n")).withColumn(
            "how", F.lit(how)
        )

    return counted(both.distinct(), "distinct").unionByName(counted(both, "all"))


@query(
    "inline_constants",
    """
    SELECT code, label, count(o_orderkey) AS n_orders
    FROM (VALUES ('F', 'final'), ('O', 'open'), ('X', 'unused')) v(code, label)
    LEFT JOIN orders ON o_orderstatus = code GROUP BY 1, 2
    """,
)
def inline_constants(t: Tables):
    labels = lake.constants(
        t.spark, [("F", "final"), ("O", "open"), ("X", "unused")], "code string, label string"
    )
    counts = t.orders.groupBy(F.col("o_orderstatus").alias("code")).agg(
        F.count("o_orderkey").alias("n_orders")
    )
    return labels.join(counts, "code", "left").fillna(0, ["n_orders"])


@query(
    "staged_partitions",
    f"""
    SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority AS priority,
           count(*) AS n_orders, CAST(sum({TOTAL}) AS DOUBLE) AS total
    FROM orders GROUP BY 1, 2
    """,
)
def staged_partitions(t: Tables):
    # A partitioned intermediate is written to the shared folder and read back from there.
    monthly = (
        t.orders.groupBy(
            F.date_format("o_orderdate", "yyyy-MM").alias("month"),
            F.col("o_orderpriority").alias("priority"),
        )
        .agg(F.count(F.lit(1)).alias("n_orders"), F.sum(money("o_totalprice")).alias("total"))
    )
    staged = lake.stage(monthly, "monthly_orders", ["month"], spread=False)
    return staged.withColumn("month", F.col("month").cast("string"))


# ---- sinks: written in the shared folder and read back from there ----------------------------


def _monthly(t: Tables):
    return t.orders.groupBy(
        F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_orderstatus").alias("status")
    ).agg(F.count(F.lit(1)).alias("n_orders"))


SQL_MONTHLY = """
    SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus AS status, count(*) AS n_orders
    FROM orders GROUP BY 1, 2
"""


@query("sink_overwrite", SQL_MONTHLY)
def sink_overwrite(t: Tables):
    path = lake.scratch(t.spark, "overwrite")
    lake.write(_monthly(t).limit(0), lake.Sink(path))
    lake.write(_monthly(t), lake.Sink(path))
    return lake.read(t.spark, path)


@query(
    "sink_multi",
    f"""
    SELECT 'plain' AS sink, * FROM ({SQL_MONTHLY}) UNION ALL
    SELECT 'by_status', * FROM ({SQL_MONTHLY})
    """,
)
def sink_multi(t: Tables):
    plain, split = lake.scratch(t.spark, "plain"), lake.scratch(t.spark, "by_status")
    lake.commit(_monthly(t), [lake.Sink(plain), lake.Sink(split, partition_by=["status"])])
    return lake.read(t.spark, plain).select(F.lit("plain").alias("sink"), "*").unionByName(
        lake.read(t.spark, split).select(F.lit("by_status").alias("sink"), "*")
    )


@query(
    "sink_window",
    f"""
    SELECT month, status, CASE WHEN month >= '2000-01' THEN n_orders ELSE -n_orders END AS n_orders
    FROM ({SQL_MONTHLY})
    """,
)
def sink_window(t: Tables):
    # The stored table holds negative counts; the months of the window are then written anew.
    path = lake.scratch(t.spark, "window")
    stored = _monthly(t).withColumn("n_orders", -F.col("n_orders"))
    lake.write(stored, lake.Sink(path, partition_by=["month"]))
    lake.overwrite_window(_monthly(t).filter("month >= '2000-01'"), path, ["month"])
    return lake.read(t.spark, path).withColumn("month", F.col("month").cast("string"))


@query("sink_table", SQL_MONTHLY)
def sink_table(t: Tables):
    path = lake.scratch(t.spark, "table")
    name = "braidlake_" + path[-32:]
    lake.write(_monthly(t), lake.Sink(table=name))
    kept = lake.stage(lake.read_table(t.spark, name), "table_rows")
    t.spark.sql(f"DROP TABLE {name}")
    return kept


@query(
    "sink_replace",
    f"""
    SELECT month, status, n_orders * 2 AS n_orders FROM ({SQL_MONTHLY}) WHERE status <> 'P'
    """,
)
def sink_replace(t: Tables):
    path = lake.scratch(t.spark, "replace")
    lake.write(_monthly(t), lake.Sink(path))
    doubled = lake.read(t.spark, path).withColumn("n_orders", F.col("n_orders") * 2)
    lake.replace_table(doubled.filter("status <> 'P'"), path)
    return lake.read(t.spark, path)


@query(
    "control_totals",
    f"""
    SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus AS status, count(*) AS n_orders,
           (SELECT count(DISTINCT (strftime(o_orderdate, '%Y-%m'), o_orderstatus)) FROM orders) AS rows_written,
           (SELECT count(*) FROM orders) AS orders_written
    FROM orders GROUP BY 1, 2
    """,
)
def control_totals(t: Tables):
    # Taken by the tasks that write, compared with what the sink holds, and carried along.
    path = lake.scratch(t.spark, "checked")
    totals = {"rows_written": F.count(F.lit(1)), "orders_written": F.sum("n_orders")}
    taken = lake.write_checked(_monthly(t), lake.Sink(path, partition_by=["status"]), totals)
    return lake.read(t.spark, path).withColumns({n: F.lit(v) for n, v in taken.items()})


@query("zone_read", SQL_MONTHLY)
def zone_read(t: Tables):
    base = lake.Lake(lake.scratch(t.spark, "zones"), {"gold": "consumezone"})
    lake.write(_monthly(t), lake.Sink(base.resolve("gold", "monthly", "br")))
    return base.read(t.spark, "gold", "monthly", "br")


@query(
    "cached_twice",
    f"""
    WITH m AS ({SQL_MONTHLY})
    SELECT month, status, n_orders, (SELECT max(n_orders) FROM m) AS most FROM m
    """,
)
def cached_twice(t: Tables):
    # Counted once for the largest group and once for the rows, from the same kept blocks.
    with lake.cached(_monthly(t)) as kept:
        most = kept.agg(F.max("n_orders")).first()[0]
        return lake.stage(kept.withColumn("most", F.lit(most)), "kept")


@query("dropped_copies", f"SELECT *, 2 AS n_dropped FROM ({SQL_MONTHLY})")
def dropped_copies(t: Tables):
    name = "copy" + uuid.uuid4().hex[:8]
    for _ in range(2):
        lake.stage(_monthly(t), name)
    kept = lake.stage(_monthly(t), "kept")
    return kept.withColumn("n_dropped", F.lit(lake.drop_staged(t.spark, name)))


@query("catalog_read", f"SELECT *, 'spark_catalog' AS catalog FROM ({SQL_MONTHLY})")
def catalog_read(t: Tables):
    name = "braidlake_" + uuid.uuid4().hex
    current = lake.use_catalog(t.spark, "spark_catalog")
    lake.write(_monthly(t), lake.Sink(table=name))
    kept = lake.stage(lake.read_table(t.spark, f"{current}.default.{name}"), "catalog_rows")
    t.spark.sql(f"DROP TABLE {name}")
    return kept.withColumn("catalog", F.lit(current))


# ---- a spine with many inputs ----------------------------------------------------------------

SPINE_INPUTS = (
    {f"year_{y}": f"year(o_orderdate) = {y}" for y in range(1995, 2002)}
    | {f"status_{s.lower()}": f"o_orderstatus = '{s}'" for s in "FOP"}
    | {f"priority_{p[0]}": f"o_orderpriority = '{p}'" for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")}
    | {"large": "o_totalprice > 200000", "small": "o_totalprice < 50000", "first_quarter": "month(o_orderdate) <= 3", "seventh": "o_orderkey % 7 = 0"}
)


@query(
    "spine_join",
    "SELECT c_custkey AS custkey, c_mktsegment AS segment, "
    + ", ".join(
        f"CAST(sum({TOTAL}) FILTER (WHERE {w}) AS DOUBLE) AS {n}, nullif(count(o_orderkey) FILTER (WHERE {w}), 0) AS n_{n}"
        for n, w in SPINE_INPUTS.items()
    )
    + " FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2",
)
def spine_join(t: Tables):
    # Nineteen inputs, each grouped by customer as a job of its own would leave it.
    spine = t.customer.select(F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("segment"))
    inputs = {
        n: t.orders.filter(w).groupBy(F.col("o_custkey").alias("custkey")).agg(
            F.sum(money("o_totalprice")).alias(n), F.count(F.lit(1)).alias(f"n_{n}")
        )
        for n, w in SPINE_INPUTS.items()
    }
    return lake.join_spine(spine, inputs, ["custkey"], buckets=8)
