"""Dimension jobs: contacts, companies, accounts and products."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidlake.functions import keys, text
from braidlake.operators import golden, select, union, upsert
from braidlake.plans.registry import NOW_TEXT, Tables, day, now, query

# ---- contacts -------------------------------------------------------------------------------

CONTACT_COLS = {
    "document": "string", "name": "string", "email": "string", "land_area": "string",
    "land_number": "string", "mobile_area": "string", "mobile_number": "string",
    "created": "timestamp_ntz", "person_hash": "string",
}
CONTACT_KEYS = [
    "person", "email", "land_area", "land_number", "mobile_area", "mobile_number", "origin",
]


def person_hash(document: Column | str, bits: int = 512) -> Column:
    """sha2 of the written form of a document, the key people are matched by across systems."""
    return F.sha2(text.document_mask(document), bits)


def contact_dimension(
    sources: Mapping[str, DataFrame],
    people: DataFrame,
    stored: DataFrame,
    source_flag: Mapping[str, str | None],
) -> DataFrame:
    """Contacts of every person and source, ranked from the newest, with change fingerprints.

    ``sources`` map an origin to rows with the columns of ``CONTACT_COLS`` (any may be absent).
    ``people`` is the active person dimension: ``person``, ``person_hash`` and one 0/1 column per
    system; ``source_flag`` names the column an origin requires (None: no requirement).
    ``stored`` holds the active contacts as loaded before. Contacts gone from an enabled source
    come out with ``is_current`` 0; sources that are switched off are left alone.
    """
    stacked = union.align_union(sources, "origin", CONTACT_COLS)
    same = F.coalesce
    blank = F.lit("")
    unique = select.latest_by(
        stacked.withColumns(
            {f"_{c}": same(F.col(c), blank) for c in CONTACT_KEYS if c not in ("person", "origin")}
        ),
        ["person_hash", "document", *[f"_{c}" for c in CONTACT_KEYS[1:-1]], "origin"],
        [F.desc("created"), F.desc("name")],
    )
    flags = F.lit(0)
    for origin, column in source_flag.items():
        value = F.col(f"p.{column}") if column else F.lit(1)
        flags = F.when(F.col("c.origin") == origin, value).otherwise(flags)
    known = (
        unique.alias("c")
        .join(people.alias("p"), F.col("c.person_hash") == F.col("p.person_hash"))
        .filter(flags == 1)
        .select(
            "p.person", "c.document", F.upper("c.name").alias("name"),
            same("c.email", F.lit("-1")).alias("email"),
            *[same(f"c.{c}", blank).alias(c) for c in CONTACT_KEYS[2:-1]],
            "c.created", "c.origin",
        )
    )
    before = stored.filter(F.col("origin").isin(list(sources))).select(
        "person", "document", "name", same("email", F.lit("-1")).alias("email"),
        *[same(c, blank).alias(c) for c in CONTACT_KEYS[2:-1]], "created", "origin",
        F.col("row_hash").alias("stored_hash"),
    )
    both = upsert.reconcile(known, before, CONTACT_KEYS).withColumn(
        "is_current", F.when(F.col("status") == "inactive", 0).otherwise(1)
    )
    ranked = select.rank_within(
        both, ["person", "origin"],
        [
            F.desc("created"), F.desc("is_current"), F.desc("name"), F.desc("email"),
            *[F.asc(c) for c in CONTACT_KEYS[2:-1]],
        ],
        "position",
        # One shared account may own a third of the contacts: number it hour by hour.
        slices=[("hour", F.date_trunc("HOUR", F.col("created")), True)],
    )
    described = [
        "person", "document", "name", "email", *CONTACT_KEYS[2:-1], "created", "origin", "position",
        "is_current",
    ]
    return ranked.withColumn("row_hash", keys.fingerprint(described, upper=True)).drop("status")


# ---- companies ------------------------------------------------------------------------------


def company_dimension(
    sources: Mapping[str, DataFrame],
    rules: Mapping[str, tuple[str, Sequence[str]]],
    names: Sequence[str],
    key: str = "company",
) -> DataFrame:
    """Golden record per company with its source list and flags, folded names and root document.

    Sources hold one row per company. One stacked grouping gives the values and the flags.
    """
    record = golden.golden_record(sources, [key], rules, present=True)
    listed = F.concat_ws(
        ", ", *[F.when(F.col(f"in_{s}") == 1, F.lit(s)) for s in sorted(sources)]
    )
    return record.withColumns(
        {n: text.fold_accents(n) for n in names}
        | {"sources": listed, "root": F.substring(text.alnum_upper(F.col(key).cast("string")), 1, 8)}
    )


def load_versions(
    stored: DataFrame,
    record: DataFrame,
    key: str,
    tracked: Sequence[str],
    described: Sequence[str],
    stamp: Column,
) -> DataFrame:
    """New state of a type-2 dimension after loading a record set.

    ``described`` columns make the fingerprint; a change in a ``tracked`` one opens a version.
    """
    hashed = record.withColumn("row_hash", keys.fingerprint([key, *described], upper=True))
    return upsert.upsert_scd2(stored, hashed, [key], tracked, "row_hash", stamp)


# ---- accounts -------------------------------------------------------------------------------


def account_dimension(
    sources: Mapping[str, DataFrame], credits: DataFrame, account: str, day_col: str, amount: str
) -> DataFrame:
    """Accounts of all systems, aligned and stacked, with the date and amount of the first credit.

    The first credit is found per (account, day) and then per account, so an account with a third
    of all credits is reduced before it meets in one group.
    """
    per_day = credits.groupBy(account, day_col).agg(F.max(amount).alias("_a"))
    first = per_day.groupBy(account).agg(
        F.min(day_col).alias("first_credit"), F.min_by("_a", day_col).alias("first_amount")
    )
    return union.align_union(sources).join(first, account, "left")


# ---- products -------------------------------------------------------------------------------


def product_dimension(
    legacy: DataFrame, current: DataFrame, constants: DataFrame, key: str, prefer_current: Sequence[str]
) -> DataFrame:
    """Products of two systems joined on their shared code, plus fixed ones, with fingerprints.

    The legacy value wins, except for the columns in ``prefer_current``. Both sides hold one row
    per code; products without a code in common survive on their own.
    """
    cols = [c for c in legacy.columns if c != key]
    old, new = legacy.alias("o"), current.alias("n")
    merged = old.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), "full").select(
        F.coalesce(f"o.{key}", f"n.{key}").alias(key),
        *[
            (
                F.coalesce(f"n.{c}", f"o.{c}") if c in prefer_current
                else F.coalesce(f"o.{c}", f"n.{c}")
            ).alias(c)
            for c in cols
        ],
    )
    everything = merged.distinct().unionByName(constants, allowMissingColumns=True)
    return everything.withColumn("row_hash", keys.fingerprint([key, *cols], upper=True))


# ---- registered on the sample tables --------------------------------------------------------


def contact_inputs(t: Tables):
    """Customers and web users as contact sources, customers as people, older contacts as stored."""
    document = F.lpad(F.col("c_custkey").cast("string"), 11, "0")
    phone = F.concat(
        (F.col("c_nationkey") + 11).cast("string"), F.lpad(F.col("c_custkey").cast("string"), 9, "9")
    )
    registry = t.customer.select(
        document.alias("document"), F.col("c_name").alias("name"),
        F.concat(F.lower("c_name"), F.lit("@mail.test")).alias("email"),
        *[c.alias(n) for n, c in text.split_phone(phone).items()],
        F.lit("2000-01-01 00:00:00").cast("timestamp_ntz").alias("created"),
        person_hash(document, 256).alias("person_hash"),
    )
    user = F.lpad(F.col("user_id").cast("string"), 11, "0")
    web = t.events.select(
        user.alias("document"), F.concat(F.lit("user "), "user_id").alias("name"),
        F.concat("event_type", F.lit("@web.test")).alias("email"),
        F.col("ts").alias("created"), person_hash(user, 256).alias("person_hash"),
    )
    people = t.customer.select(
        F.col("c_custkey").alias("person"), person_hash(document, 256).alias("person_hash"),
        F.when(F.col("c_acctbal") > 0, 1).otherwise(0).alias("in_registry"),
    )
    stored = t.customer.filter("c_acctbal < 2000").select(
        F.col("c_custkey").alias("person"), document.alias("document"),
        F.upper("c_name").alias("name"), F.lit(None).cast("string").alias("email"),
        *[F.lit("").alias(c) for c in CONTACT_KEYS[2:-1]],
        F.lit("1999-01-01 00:00:00").cast("timestamp_ntz").alias("created"),
        F.when(F.col("c_acctbal") > 1000, "web").otherwise("registry").alias("origin"),
        F.md5("c_name").alias("row_hash"),
    )
    return {"registry": registry, "web": web}, people, stored


@query(
    "contact_dimension",
    """
    WITH p AS (SELECT c_custkey AS person, CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS in_reg,
                      lpad(c_custkey::VARCHAR, 11, '0') AS document, * FROM customer),
    web AS (SELECT user_id AS person, 'USER ' || user_id AS name, event_type || '@web.test' AS email,
                   max(ts) AS created FROM events GROUP BY user_id, event_type),
    k AS (SELECT person, upper(c_name) AS name, lower(c_name) || '@mail.test' AS email,
                 (11 + c_nationkey)::VARCHAR AS area, lpad(c_custkey::VARCHAR, 9, '9') AS number,
                 TIMESTAMP '2000-01-01' AS created, 'registry' AS origin FROM p WHERE in_reg = 1
          UNION ALL
          SELECT web.person, web.name, web.email, '', '', web.created, 'web' FROM web
          JOIN p ON p.person = web.person),
    s AS (SELECT person, upper(c_name) AS name, '-1' AS email, TIMESTAMP '1999-01-01' AS created,
                 CASE WHEN c_acctbal > 1000 THEN 'web' ELSE 'registry' END AS origin,
                 md5(c_name) AS stored_hash FROM p WHERE c_acctbal < 2000),
    b AS (SELECT person, name, email, area, number, created, origin, NULL AS stored_hash,
                 1 AS is_current FROM k
          UNION ALL SELECT person, name, email, '', '', created, origin, stored_hash, 0 FROM s)
    SELECT person, lpad(person::VARCHAR, 11, '0') AS document, name, email, '' AS land_area,
           '' AS land_number, area AS mobile_area, number AS mobile_number,
           CAST(created AS VARCHAR) AS created, origin, stored_hash, is_current,
           row_number() OVER (PARTITION BY person, origin ORDER BY created DESC, is_current DESC,
               name DESC, email DESC, area, number) AS position
    FROM b
    """,
)
def contact_dimension_query(t: Tables):
    sources, people, stored = contact_inputs(t)
    out = contact_dimension(
        sources, people, stored, {"registry": "in_registry", "web": None}
    )
    return out.drop("row_hash")


SQL_COMPANY = """
    r AS (SELECT c_custkey AS company, c_name AS name, c_mktsegment AS segment FROM customer
          WHERE c_acctbal > 0),
    b AS (SELECT o_custkey AS company, CAST(min(o_orderdate) AS DATE) AS created FROM orders
          GROUP BY 1),
    d AS (SELECT doc_id AS company, max(source || ' ação') AS name,
                 max(lang) AS segment FROM documents GROUP BY 1),
    k AS (SELECT company FROM r UNION SELECT company FROM b UNION SELECT company FROM d),
    n AS (SELECT k.company, upper(coalesce(r.name, replace(d.name, 'çã', 'ca'))) AS name,
           CASE WHEN d.company IS NOT NULL THEN d.segment ELSE r.segment END AS segment,
           b.created::VARCHAR AS created, substr(k.company::VARCHAR, 1, 8) AS root,
           concat_ws(', ', CASE WHEN b.company IS NOT NULL THEN 'buyers' END,
             CASE WHEN d.company IS NOT NULL THEN 'documents' END,
             CASE WHEN r.company IS NOT NULL THEN 'registry' END) AS sources,
           CASE WHEN b.company IS NOT NULL THEN 1 ELSE 0 END AS in_buyers,
           CASE WHEN d.company IS NOT NULL THEN 1 ELSE 0 END AS in_documents,
           CASE WHEN r.company IS NOT NULL THEN 1 ELSE 0 END AS in_registry
    FROM k LEFT JOIN r USING (company) LEFT JOIN b USING (company) LEFT JOIN d USING (company))
"""


@query("company_dimension", f"WITH {SQL_COMPANY} SELECT * FROM n")
def company_dimension_query(t: Tables):
    return company_record(t)


def company_sources(t: Tables) -> dict[str, DataFrame]:
    registry = t.customer.filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("company"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    buyers = t.orders.groupBy(F.col("o_custkey").alias("company")).agg(
        day(F.min("o_orderdate")).alias("created")
    )
    docs = t.documents.select(
        F.col("doc_id").alias("company"), F.concat("source", F.lit(" ação")).alias("name"),
        F.col("lang").alias("segment"),
    )
    return {"registry": registry, "buyers": buyers, "documents": docs}


def company_record(t: Tables) -> DataFrame:
    return company_dimension(
        company_sources(t),
        {
            "name": ("first", ["registry", "documents"]),
            "segment": ("owner", ["documents", "registry"]),
            "created": ("least", ["buyers"]),
        },
        ["name"],
    )


@query(
    "company_load",
    f"""
    WITH {SQL_COMPANY},
    s AS (SELECT company, name, segment, sources, md5(upper(company::VARCHAR || coalesce(name, '') ||
            coalesce(segment, '') || sources)) AS h FROM n),
    o AS (SELECT company, upper(name) AS name, segment, 'registry' AS sources,
            md5(upper(company::VARCHAR || name || segment || 'registry')) AS h FROM r),
    c AS (SELECT s.*, CASE WHEN o.company IS NULL THEN 'insert'
             WHEN s.segment IS DISTINCT FROM o.segment THEN 'version' ELSE 'update' END AS act
          FROM s LEFT JOIN o USING (company) WHERE coalesce(o.h, '') <> s.h),
    num AS (SELECT company, b, row_number() OVER (PARTITION BY b ORDER BY company) - 1 AS rn FROM
             (SELECT company, ('0x' || substr(md5(company::VARCHAR), 1, 8))::BIGINT % 4096 AS b
              FROM c WHERE act = 'insert'))
    SELECT o.company + 1 AS sk, o.company, CASE WHEN act = 'update' THEN c.name ELSE o.name END
             AS name, CASE WHEN act = 'update' THEN c.segment ELSE o.segment END AS segment,
           CASE WHEN act = 'update' THEN c.sources ELSE o.sources END AS sources,
           CASE WHEN act = 'version' THEN 0 ELSE 1 END AS is_active,
           CASE WHEN act = 'version' THEN '2000-06-14 12:00:00' END AS valid_to,
           CASE WHEN act IS NOT NULL THEN '{NOW_TEXT}' ELSE '2000-01-01 00:00:00' END AS changed_at
    FROM o LEFT JOIN c USING (company)
    UNION ALL
    SELECT company + 1, company, name, segment, sources, 1, NULL, '{NOW_TEXT}' FROM c
    WHERE act = 'version'
    UNION ALL
    SELECT (SELECT max(company + 1) FROM o) + b + 1 + rn * 4096, company, name, segment, sources, 1,
           NULL, '{NOW_TEXT}' FROM c JOIN num USING (company) WHERE act = 'insert'
    """,
)
def company_load(t: Tables):
    described = ["name", "segment", "sources"]
    stamp = F.lit("2000-01-01").cast("timestamp_ntz")
    before = company_dimension(
        {"registry": company_sources(t)["registry"]},
        {"name": ("first", ["registry"]), "segment": ("owner", ["registry"])},
        ["name"],
    ).select("company", *described)
    stored = before.select(
        (F.col("company") + 1).alias("sk"), "company", *described,
        keys.fingerprint(["company", *described], upper=True).alias("row_hash"),
        F.lit(1).alias("is_active"), stamp.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"), stamp.alias("inserted_at"),
        stamp.alias("changed_at"),
    )
    record = company_record(t).select("company", *described)
    return load_versions(stored, record, "company", ["segment"], described, now()).drop(
        "row_hash", "valid_from", "inserted_at"
    )


@query(
    "account_dimension",
    """
    WITH f AS (SELECT o_custkey AS k, min(o_orderdate) AS d FROM orders GROUP BY 1),
    a AS (SELECT k, CAST(d AS DATE)::VARCHAR AS first_credit,
                 CAST(max(CAST(o_totalprice AS DECIMAL(11,2))) AS DOUBLE) AS first_amount
          FROM f JOIN orders ON o_custkey = k AND o_orderdate = d GROUP BY 1, 2)
    SELECT c_custkey AS account, c_name AS holder, c_mktsegment AS segment, NULL AS nation,
           'customer' AS origin, first_credit, first_amount FROM customer
    LEFT JOIN a ON k = c_custkey
    UNION ALL
    SELECT s_suppkey, s_name, NULL, s_nationkey, 'supplier', first_credit, first_amount
    FROM supplier LEFT JOIN a ON k = s_suppkey
    """,
)
def account_dimension_query(t: Tables):
    customers = t.customer.select(
        F.col("c_custkey").alias("account"), F.col("c_name").alias("holder"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = t.supplier.select(
        F.col("s_suppkey").alias("account"), F.col("s_name").alias("holder"),
        F.col("s_nationkey").alias("nation"),
    )
    credits = t.orders.select(
        F.col("o_custkey").alias("account"), day("o_orderdate").alias("d"),
        F.col("o_totalprice").cast("decimal(11,2)").alias("amount"),
    )
    return account_dimension(
        {"customer": customers, "supplier": suppliers}, credits, "account", "d", "amount"
    )


@query(
    "product_dimension",
    """
    WITH o AS (SELECT p_partkey AS code, p_name AS name, p_brand AS brand,
                      CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 'PAT' ELSE 'AUXILIO' END AS benefit
               FROM part WHERE p_size <= 30),
    n AS (SELECT p_partkey AS code, upper(p_name) AS name, p_type AS brand,
                 CAST(NULL AS VARCHAR) AS benefit FROM part WHERE p_size >= 20),
    m AS (SELECT coalesce(o.code, n.code) AS code, coalesce(n.name, o.name) AS name,
                 coalesce(o.brand, n.brand) AS brand, coalesce(o.benefit, n.benefit) AS benefit
          FROM o FULL OUTER JOIN n ON o.code = n.code
          UNION ALL VALUES (-1, 'Fixed one', 'NONE', NULL), (-2, 'Fixed two', 'NONE', NULL))
    SELECT *, md5(upper(coalesce(code::VARCHAR, '') || coalesce(name, '') || coalesce(brand, '') ||
                        coalesce(benefit, ''))) AS row_hash FROM m
    """,
)
def product_dimension_query(t: Tables):
    legacy = t.part.filter("p_size <= 30").select(
        F.col("p_partkey").alias("code"), F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.when(F.col("p_type").isin("PROMO", "SMALL"), "PAT").otherwise("AUXILIO").alias("benefit"),
    )
    current = t.part.filter("p_size >= 20").select(
        F.col("p_partkey").alias("code"), F.upper("p_name").alias("name"),
        F.col("p_type").alias("brand"), F.lit(None).cast("string").alias("benefit"),
    )
    fixed_ones = t.spark.sql(
        "SELECT * FROM VALUES (-1L, 'Fixed one', 'NONE'), (-2L, 'Fixed two', 'NONE')"
        " AS v(code, name, brand)"
    )
    return product_dimension(legacy, current, fixed_ones, "code", ["name"])


@query(
    "product_upsert",
    f"""
    WITH s AS (SELECT p_partkey AS code, p_name AS name, md5(upper(p_partkey::VARCHAR || p_name))
                      AS row_hash FROM part WHERE p_size > 10),
    t AS (SELECT p_partkey AS code, CASE WHEN p_type = 'PROMO' THEN 'old ' || p_name ELSE p_name END
                 AS name, md5(upper(p_partkey::VARCHAR || CASE WHEN p_type = 'PROMO' THEN 'old '
                 || p_name ELSE p_name END)) AS row_hash FROM part WHERE p_size <= 30)
    SELECT coalesce(s.code, t.code) AS code, coalesce(s.name, t.name) AS name,
           coalesce(s.row_hash, t.row_hash) AS row_hash,
           CASE WHEN t.code IS NULL THEN '{NOW_TEXT}' ELSE '2000-01-01 00:00:00' END AS inserted_at,
           CASE WHEN t.code IS NULL OR (s.code IS NOT NULL AND s.row_hash <> t.row_hash)
                THEN '{NOW_TEXT}' ELSE '2000-01-01 00:00:00' END AS changed_at
    FROM s FULL OUTER JOIN t ON s.code = t.code
    """,
)
def product_upsert(t: Tables):
    def hashed(df: DataFrame) -> DataFrame:
        return df.withColumn("row_hash", keys.fingerprint(["code", "name"], upper=True))

    name = F.col("p_name")
    old_name = F.when(F.col("p_type") == "PROMO", F.concat(F.lit("old "), name)).otherwise(name)
    stamp = F.lit("2000-01-01").cast("timestamp_ntz")
    stored = hashed(
        t.part.filter("p_size <= 30").select(
            F.col("p_partkey").alias("code"), old_name.alias("name"), stamp.alias("inserted_at"),
            stamp.alias("changed_at"),
        )
    )
    load = hashed(
        t.part.filter("p_size > 10").select(F.col("p_partkey").alias("code"), name.alias("name"))
    )
    return upsert.upsert_scd1(
        stored.select("code", "name", "row_hash", "inserted_at", "changed_at"), load, ["code"],
        "row_hash", now(),
    )
