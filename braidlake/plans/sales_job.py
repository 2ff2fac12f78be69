"""Sales facts: the short KPI scripts with their rule variants, and the order-item KPI job.

Column names and rule values default to those of the business tables; every one is a parameter.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidlake.functions import fixed
from braidlake.operators import kpi, select
from braidlake.plans.registry import Tables, money, query, sql_money, sql_ratio
from braidlake.sources import lake


@dataclass(frozen=True)
class SalesRules:
    """One variant of the short sales KPI: what is kept, how it is grouped, what is summed."""

    statuses: Sequence[str]
    threshold: float
    inclusive: bool
    keys: Sequence[str]
    status: str = "status"
    amount: str = "amount"
    order: str = "order_id"
    total: str = "amount"
    kind: str | None = None
    kinds: Sequence[str] = ()
    required: Sequence[str] = ()
    equals: Mapping[str, object] = field(default_factory=dict)
    customer: str | None = None
    margin: str | None = None


SIMPLE = SalesRules(["OK"], 100, False, ["sk_unidade", "sk_anomes"])
SIMPLE_WIDE = SalesRules(["OK", "APROVADO"], 0, True, ["sk_unidade", "sk_anomes"])
VALIDATED = SalesRules(
    ["OK"], 100, False, ["dt_ref", "regional", "canal"], kind="tipo_pedido",
    kinds=["VENDA", "RENOVACAO"], required=["data_referencia"], customer="customer_id",
    margin="gross_margin",
)
VALIDATED_CHANGED = SalesRules(
    ["ATIVO"], 200, True, ["dt_ref", "regional"], total="net_amount", kind="tipo_pedido",
    kinds=["VENDA"], required=["data_referencia"], customer="customer_id", margin="gross_margin",
)


def sales_kpi(df: DataFrame, rules: SalesRules) -> DataFrame:
    """TOTAL_VENDAS and QTD_PEDIDOS per key; with a customer column also the validated KPIs."""
    amount = F.col(rules.amount)
    floor = F.lit(rules.threshold)
    kept = df.filter(F.col(rules.status).isin(list(rules.statuses))).filter(
        amount >= floor if rules.inclusive else amount > floor
    )
    if rules.kind:
        kept = kept.filter(F.col(rules.kind).isin(list(rules.kinds)))
    for c in rules.required:
        kept = kept.filter(F.col(c).isNotNull())
    for c, value in rules.equals.items():
        kept = kept.filter(F.col(c) == F.lit(value))
    if rules.customer is None:
        return kept.groupBy(*rules.keys).agg(
            F.sum(rules.total).alias("TOTAL_VENDAS"), F.count(rules.order).alias("QTD_PEDIDOS")
        )
    spec = kpi.KpiSpec(
        dims=rules.keys,
        sums={"TOTAL_VENDAS": rules.total, "MARGEM_BRUTA": rules.margin},
        distincts={"QTD_PEDIDOS": rules.order, "CLIENTES_ATIVOS": rules.customer},
        ratios={"TICKET_MEDIO": ("TOTAL_VENDAS", "QTD_PEDIDOS", 1)},
    )
    return kpi.kpi_gold(kept, spec)


# ---- order-item job -------------------------------------------------------------------------

# The column names of the job's tables.
CUSTOMER_COLS = [
    "cliente_id", "segmento_cliente", "canal_preferencial", "cidade", "estado", "data_cadastro",
    "cluster_valor", "tier_relacionamento",
]
PRODUCT_COLS = [
    "produto_id", "categoria", "subcategoria", "marca", "familia_receita",
    "flag_produto_estrategico",
]
CAMPAIGN_COLS = ["campaign_id", "tipo_campanha", "origem_midia", "objetivo_comercial"]
CURATED_COLS = [
    "pedido_id", "item_id", "cliente_id", "produto_id", "campaign_id", "data_pedido",
    "data_competencia", "mes_referencia", "regional", "canal_venda", "segmento_cliente",
    "cluster_valor", "tier_relacionamento", "categoria", "subcategoria", "marca",
    "familia_receita", "flag_produto_estrategico", "status_pedido", "tipo_movimento", "quantidade",
    "valor_bruto", "desconto_valor", "valor_total", "custo_total", "margem_bruta_item",
    "desconto_percentual", "tempo_entrega_horas", "pedido_24h", "pedido_digital",
    "cliente_ativo_flag", "tipo_campanha", "origem_midia", "objetivo_comercial",
]
ITEM_GOLD = kpi.KpiSpec(
    dims=[
        "mes_referencia", "regional", "canal_venda", "segmento_cliente", "cluster_valor",
        "categoria", "familia_receita",
    ],
    sums={
        "TOTAL_VENDAS": "valor_total", "QTD_ITENS": "quantidade",
        "MARGEM_BRUTA": "margem_bruta_item", "PEDIDOS_NO_SLA_24H": "pedido_24h",
        "PEDIDOS_DIGITAIS": "pedido_digital",
    },
    distincts={"QTD_PEDIDOS": "pedido_id", "CLIENTES_ATIVOS": "cliente_id"},
    means={"DESCONTO_MEDIO_PERC": "desconto_percentual"},
    ratios={
        "TICKET_MEDIO": ("TOTAL_VENDAS", "QTD_PEDIDOS", 1),
        "ITENS_POR_PEDIDO": ("QTD_ITENS", "QTD_PEDIDOS", 1),
        "MARGEM_PERC": ("MARGEM_BRUTA", "TOTAL_VENDAS", 100),
        "SLA_ENTREGA_24H_PERC": ("PEDIDOS_NO_SLA_24H", "QTD_PEDIDOS", 100),
        "DIGITAL_SHARE_PERC": ("PEDIDOS_DIGITAIS", "QTD_PEDIDOS", 100),
    },
    alerts={
        "KPI_ALERTA_MARGEM": ("MARGEM_PERC", fixed.MARGIN_ALERT_BELOW, "RISCO", "OK"),
        "KPI_ALERTA_SLA": ("SLA_ENTREGA_24H_PERC", fixed.SLA_ALERT_BELOW, "RISCO", "OK"),
        "KPI_ALERTA_TICKET": ("TICKET_MEDIO", fixed.TICKET_ALERT_BELOW, "ATENCAO", "OK"),
    },
    rank=("RANK_CATEGORIA_REGIONAL", ["mes_referencia", "regional"], "TOTAL_VENDAS"),
)


def one_per_key(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """One row per key; the other columns order the candidates, so the choice is repeatable."""
    return select.latest_by(
        df.select(*cols), [key], [F.col(c).desc_nulls_last() for c in cols if c != key]
    )


@dataclass(frozen=True)
class ItemRules:
    """What makes an order item count, and what its flags mean."""

    accepted: Mapping[str, Sequence[object]] = field(
        default_factory=lambda: {
            "empresa_origem": fixed.SALE_COMPANIES,
            "tipo_movimento": fixed.SALE_MOVEMENTS,
            "status_pedido": fixed.SALE_STATUSES,
            "flag_cancelado": [False],
        }
    )
    present: Sequence[str] = ("quantidade", "valor_total", "data_competencia")
    running_campaigns: Mapping[str, object] = field(default_factory=lambda: {"status_campanha": "ATIVA"})
    fast_hours: float = 24
    digital: Sequence[str] = tuple(fixed.DIGITAL_CHANNELS)

    def counts(self, df: DataFrame) -> DataFrame:
        for name, values in self.accepted.items():
            df = df.filter(F.col(name).isin(list(values)))
        return df.dropna(subset=list(self.present))

    def flags(self) -> dict[str, Column]:
        true = {
            "cliente_ativo_flag": F.col("valor_total") > 0,
            "pedido_24h": F.col("tempo_entrega_horas") <= self.fast_hours,
            "pedido_digital": F.col("canal_venda").isin(list(self.digital)),
        }
        return {name: F.coalesce(test.cast("int"), F.lit(0)) for name, test in true.items()}


def curated_items(
    items: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    campaigns: DataFrame,
    rules: ItemRules = ItemRules(),
) -> DataFrame:
    """Order items that count under the rules, described by customer, product and campaign.

    Dimensions are reduced to one row per key, so the grain stays that of the items. Amount
    columns should be decimals.
    """
    running = campaigns
    for name, value in rules.running_campaigns.items():
        running = running.filter(F.col(name) == F.lit(value))
    described = rules.counts(items)
    for side, columns in ((running, CAMPAIGN_COLS), (products, PRODUCT_COLS), (customers, CUSTOMER_COLS)):
        described = described.join(one_per_key(side, columns[0], columns), columns[0], "left")
    amounts = {
        "margem_bruta_item": F.col("valor_total") - F.col("custo_total"),
        "desconto_percentual": kpi.ratio(F.col("desconto_valor"), F.col("valor_bruto"), 100),
    }
    days = {
        "data_pedido": F.to_date("data_pedido"),
        "mes_referencia": F.date_format("data_competencia", "yyyy-MM"),
    }
    return described.withColumns(amounts | days | rules.flags()).select(*CURATED_COLS)


def item_gold(curated: DataFrame) -> DataFrame:
    return kpi.kpi_gold(curated, ITEM_GOLD)


def item_audit(curated: DataFrame) -> DataFrame:
    return kpi.audit(
        curated, ["mes_referencia", "regional", "status_pedido", "tipo_movimento"],
        {"pedidos": "pedido_id"}, {"valor_total": "valor_total", "margem_bruta": "margem_bruta_item"},
    )


def run(
    items: DataFrame, customers: DataFrame, products: DataFrame, campaigns: DataFrame,
    curated_path: str, gold_path: str, audit_path: str, format: str = "parquet",
) -> None:
    """Write the curated rows once, and derive gold and audit from what was written.

    The joins run a single time, and a lost executor costs a re-read instead of a re-join.
    """
    spark = items.sparkSession
    lake.write(
        curated_items(items, customers, products, campaigns),
        lake.Sink(curated_path, format=format, partition_by=["mes_referencia"]),
    )
    curated = lake.read(spark, curated_path, format)
    stamp = F.current_timestamp()
    lake.write(
        item_gold(curated).withColumn("gerado_em", stamp),
        lake.Sink(gold_path, format=format, partition_by=["mes_referencia", "regional"]),
    )
    lake.write(
        item_audit(curated).withColumn("gerado_em", stamp),
        lake.Sink(audit_path, format=format, partition_by=["mes_referencia"]),
    )


# ---- registered on the sample tables --------------------------------------------------------

PRICE = sql_money("l_extendedprice")


def sample_inputs(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Order lines, customers, parts and suppliers in the shape of the job's inputs."""
    price = money("l_extendedprice")
    off = F.round(price * F.col("l_discount").cast("decimal(4,2)"), 2).cast("decimal(18,2)")
    status, flag = F.col("o_orderstatus"), F.col("l_returnflag")
    # Dealt out by order and left as dealt: distinct counts keep a row per order several times in memory, so
    # parts that are joined up to a size would need much of it.
    deals = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    items = t.lineitem.repartition(deals, "l_orderkey").join(
        t.orders.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey")
    ).select(
        F.col("l_orderkey").alias("pedido_id"), F.col("l_linenumber").alias("item_id"),
        F.col("o_custkey").alias("cliente_id"), F.col("l_partkey").alias("produto_id"),
        F.col("l_suppkey").alias("campaign_id"), F.col("o_orderdate").alias("data_pedido"),
        F.col("l_shipdate").alias("data_competencia"),
        F.col("l_linestatus").alias("regional"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "APP")
        .when(F.col("o_orderpriority") == "2-HIGH", "E-COMMERCE").otherwise("LOJA")
        .alias("canal_venda"),
        F.when(status == "F", "FATURADO").when(status == "O", "PARCIALMENTE_FATURADO")
        .otherwise("PENDENTE").alias("status_pedido"),
        F.when(flag == "N", "VENDA").when(flag == "A", "UPSELL").otherwise("DEVOLUCAO")
        .alias("tipo_movimento"),
        F.when(F.col("l_tax") > 0.02, "B2B").otherwise("B2C").alias("empresa_origem"),
        (F.col("l_quantity") < 3).alias("flag_cancelado"),
        F.col("l_quantity").cast("decimal(18,2)").alias("quantidade"),
        price.alias("valor_bruto"), off.alias("desconto_valor"),
        (price - off).cast("decimal(18,2)").alias("valor_total"),
        F.round(price * F.lit("0.75").cast("decimal(3,2)"), 2).cast("decimal(18,2)")
        .alias("custo_total"),
        (F.datediff("l_shipdate", "o_orderdate") * 8).alias("tempo_entrega_horas"),
    )
    blank = F.lit(None).cast("string")
    customers = t.customer.select(
        F.col("c_custkey").alias("cliente_id"), F.col("c_mktsegment").alias("segmento_cliente"),
        blank.alias("canal_preferencial"), blank.alias("cidade"),
        F.col("c_nationkey").alias("estado"), blank.alias("data_cadastro"),
        F.when(F.col("c_acctbal") > 5000, "A").otherwise("B").alias("cluster_valor"),
        blank.alias("tier_relacionamento"),
    )
    products = t.part.select(
        F.col("p_partkey").alias("produto_id"), F.col("p_type").alias("categoria"),
        blank.alias("subcategoria"), F.col("p_brand").alias("marca"),
        F.when(F.col("p_size") > 25, "BIG").otherwise("SMALL").alias("familia_receita"),
        F.lit(0).alias("flag_produto_estrategico"),
    )
    campaigns = t.supplier.select(
        F.col("s_suppkey").alias("campaign_id"),
        F.when(F.col("s_acctbal") > 0, "ATIVA").otherwise("FIM").alias("status_campanha"),
        F.col("s_name").alias("tipo_campanha"), blank.alias("origem_midia"),
        blank.alias("objetivo_comercial"),
    )
    return items, customers, products, campaigns


SQL_ITEMS = f"""
    i AS (SELECT l_orderkey AS pedido_id, l_linenumber AS item_id, o_custkey AS cliente_id,
            l_partkey AS produto_id, l_suppkey AS campaign_id, l_linestatus AS regional,
            CASE o_orderpriority WHEN '1-URGENT' THEN 'APP' WHEN '2-HIGH' THEN 'E-COMMERCE'
                 ELSE 'LOJA' END AS canal_venda,
            CASE o_orderstatus WHEN 'F' THEN 'FATURADO' WHEN 'O' THEN 'PARCIALMENTE_FATURADO'
                 ELSE 'PENDENTE' END AS status_pedido,
            CASE l_returnflag WHEN 'N' THEN 'VENDA' WHEN 'A' THEN 'UPSELL' ELSE 'DEVOLUCAO' END
                AS tipo_movimento,
            strftime(l_shipdate, '%Y-%m') AS mes_referencia, l_quantity AS q, {PRICE} AS bruto,
            CAST(round({PRICE} * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS off,
            CAST(round({PRICE} * CAST(0.75 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2)) AS custo,
            datediff('day', o_orderdate, l_shipdate) * 8 AS horas, l_tax,
            CAST(o_orderdate AS DATE) AS pedido_dia, l_shipdate AS competencia
          FROM lineitem JOIN orders ON o_orderkey = l_orderkey
          WHERE o_orderstatus IN ('F', 'O') AND l_returnflag IN ('N', 'A') AND l_quantity >= 3
            AND l_tax > 0.02),
    cur AS (SELECT i.*, bruto - off AS total, (bruto - off) - custo AS margem,
              {sql_ratio('off * 100', 'bruto * 100', 100)} AS perc,
              CASE WHEN horas <= 24 THEN 1 ELSE 0 END AS p24,
              CASE WHEN canal_venda IN ('E-COMMERCE', 'APP') THEN 1 ELSE 0 END AS dig,
              c_mktsegment AS segmento_cliente, p_type AS categoria, s_name AS tipo_campanha,
              CASE WHEN c_acctbal > 5000 THEN 'A' ELSE 'B' END AS cluster_valor,
              CASE WHEN p_size > 25 THEN 'BIG' ELSE 'SMALL' END AS familia_receita,
              p_brand AS marca, CASE WHEN p_partkey IS NOT NULL THEN 0 END AS estrategico
            FROM i LEFT JOIN customer ON c_custkey = cliente_id
            LEFT JOIN part ON p_partkey = produto_id
            LEFT JOIN supplier ON s_suppkey = campaign_id AND s_acctbal > 0)
"""


@query(
    "sales_curated",
    f"""
    WITH {SQL_ITEMS}
    SELECT pedido_id, item_id, cliente_id, produto_id, campaign_id, CAST(pedido_dia AS VARCHAR) AS data_pedido,
           CAST(competencia AS VARCHAR) AS data_competencia, mes_referencia, regional, canal_venda,
           segmento_cliente, cluster_valor, NULL AS tier_relacionamento,
           categoria, NULL AS subcategoria, marca, familia_receita, estrategico AS flag_produto_estrategico,
           status_pedido, tipo_movimento, CAST(q AS DOUBLE) AS quantidade, CAST(bruto AS DOUBLE) AS valor_bruto,
           CAST(off AS DOUBLE) AS desconto_valor, CAST(total AS DOUBLE) AS valor_total, CAST(custo AS DOUBLE) AS custo_total,
           CAST(margem AS DOUBLE) AS margem_bruta_item, perc AS desconto_percentual, horas AS tempo_entrega_horas,
           p24 AS pedido_24h, dig AS pedido_digital, CASE WHEN total > 0 THEN 1 ELSE 0 END AS cliente_ativo_flag,
           tipo_campanha, NULL AS origem_midia, NULL AS objetivo_comercial
    FROM cur
    """,
)
def sales_curated(t: Tables):
    return curated_items(*sample_inputs(t))


@query(
    "sales_gold",
    f"""
    WITH {SQL_ITEMS},
    g AS (SELECT mes_referencia, regional, canal_venda, segmento_cliente, cluster_valor, categoria,
            familia_receita, sum(total) AS v, sum(CAST(q AS DECIMAL(18,2))) AS q,
            count(DISTINCT pedido_id) AS n,
            count(DISTINCT cliente_id) AS c, sum(margem) AS m,
            sum(CAST(round(perc * 100) AS HUGEINT)) AS ps, count(*) AS k, sum(p24) AS p24,
            sum(dig) AS dig FROM cur GROUP BY ALL),
    r AS (SELECT *, {sql_ratio('v * 100', 'n * 100')} AS ticket,
            {sql_ratio('q * 100', 'n * 100')} AS ipp, {sql_ratio('m * 100', 'v * 100', 100)} AS mp,
            {sql_ratio('p24', 'n', 100)} AS sla, {sql_ratio('dig', 'n', 100)} AS ds FROM g)
    SELECT mes_referencia, regional, canal_venda, segmento_cliente, cluster_valor, categoria,
           familia_receita, CAST(v AS DOUBLE) AS "TOTAL_VENDAS", CAST(q AS DOUBLE) AS "QTD_ITENS",
           n AS "QTD_PEDIDOS", c AS "CLIENTES_ATIVOS", CAST(m AS DOUBLE) AS "MARGEM_BRUTA",
           CAST((2 * ps * 10000 + k) // (2 * k) AS DOUBLE) / 1000000 AS "DESCONTO_MEDIO_PERC",
           p24::BIGINT AS "PEDIDOS_NO_SLA_24H", dig::BIGINT AS "PEDIDOS_DIGITAIS",
           ticket AS "TICKET_MEDIO", ipp AS "ITENS_POR_PEDIDO", mp AS "MARGEM_PERC",
           sla AS "SLA_ENTREGA_24H_PERC", ds AS "DIGITAL_SHARE_PERC",
           row_number() OVER (PARTITION BY mes_referencia, regional ORDER BY v DESC, canal_venda,
             segmento_cliente, cluster_valor, categoria, familia_receita)
             AS "RANK_CATEGORIA_REGIONAL",
           CASE WHEN mp < 18 THEN 'RISCO' ELSE 'OK' END AS "KPI_ALERTA_MARGEM",
           CASE WHEN sla < 92 THEN 'RISCO' ELSE 'OK' END AS "KPI_ALERTA_SLA",
           CASE WHEN ticket < 350 THEN 'ATENCAO' ELSE 'OK' END AS "KPI_ALERTA_TICKET"
    FROM r
    """,
)
def sales_gold(t: Tables):
    return item_gold(curated_items(*sample_inputs(t)))


@query(
    "sales_audit",
    f"""
    WITH {SQL_ITEMS}
    SELECT mes_referencia, regional, status_pedido, tipo_movimento,
           count(DISTINCT pedido_id) AS pedidos, CAST(sum(total) AS DOUBLE) AS valor_total,
           CAST(sum(margem) AS DOUBLE) AS margem_bruta FROM cur GROUP BY 1, 2, 3, 4
    """,
)
def sales_audit(t: Tables):
    return item_audit(curated_items(*sample_inputs(t)))


def short_sales(t: Tables) -> DataFrame:
    """Orders in the shape of the short scripts' input."""
    status, total = F.col("o_orderstatus"), money("o_totalprice")
    return t.orders.select(
        F.when(status == "F", "OK").when(status == "O", "ATIVO").otherwise("APROVADO")
        .alias("status"),
        total.alias("amount"), total.alias("net_amount"),
        (total / 10).cast("decimal(18,2)").alias("gross_margin"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "RENOVACAO")
        .otherwise("VENDA").alias("tipo_pedido"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate").cast("date"))
        .alias("data_referencia"),
        F.date_format("o_orderdate", "yyyy-MM").alias("dt_ref"),
        F.date_format("o_orderdate", "yyyyMM").alias("sk_anomes"),
        F.col("o_orderpriority").alias("sk_unidade"), F.col("o_orderpriority").alias("regional"),
        status.alias("canal"), F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
    )


TOTAL = sql_money("o_totalprice")


@query(
    "sales_short",
    f"""
    SELECT 'narrow' AS variant, o_orderpriority AS sk_unidade,
           strftime(o_orderdate, '%Y%m') AS sk_anomes, CAST(sum({TOTAL}) AS DOUBLE) AS "TOTAL_VENDAS",
           count(o_orderkey) AS "QTD_PEDIDOS" FROM orders
    WHERE o_orderstatus = 'F' AND o_totalprice > 100 GROUP BY 2, 3
    UNION ALL
    SELECT 'wide', o_orderpriority, strftime(o_orderdate, '%Y%m'), CAST(sum({TOTAL}) AS DOUBLE),
           count(o_orderkey) FROM orders
    WHERE o_orderstatus IN ('F', 'P') AND o_totalprice >= 0 GROUP BY 2, 3
    """,
)
def sales_short(t: Tables):
    rows = short_sales(t)
    return (
        sales_kpi(rows, SIMPLE).withColumn("variant", F.lit("narrow"))
        .unionByName(sales_kpi(rows, SIMPLE_WIDE).withColumn("variant", F.lit("wide")))
    )


def _validated_sql(where: str, keys: str) -> str:
    return f"""SELECT {keys}, sum({TOTAL}) AS v,
        sum((CAST({TOTAL} * 100 AS BIGINT) + 5) // 10) AS m,
        count(DISTINCT o_orderkey) AS n, count(DISTINCT o_custkey) AS c
        FROM orders WHERE o_orderpriority <> '5-LOW' AND {where} GROUP BY ALL"""


@query(
    "sales_validated",
    f"""
    WITH a AS ({_validated_sql("o_orderstatus = 'F' AND o_totalprice > 100",
                               "strftime(o_orderdate, '%Y-%m') AS dt_ref, o_orderpriority AS regional, o_orderstatus AS canal")})
    SELECT dt_ref, regional, canal, CAST(v AS DOUBLE) AS "TOTAL_VENDAS",
           CAST(m AS DOUBLE) / 100 AS "MARGEM_BRUTA", n AS "QTD_PEDIDOS", c AS "CLIENTES_ATIVOS",
           {sql_ratio('v * 100', 'n * 100')} AS "TICKET_MEDIO" FROM a
    """,
)
def sales_validated(t: Tables):
    return sales_kpi(short_sales(t), VALIDATED)


@query(
    "sales_drift",
    f"""
    WITH a0 AS ({_validated_sql("o_orderstatus = 'F' AND o_totalprice > 100",
                                "strftime(o_orderdate, '%Y-%m') AS dt_ref, o_orderpriority AS regional")}),
    b AS ({_validated_sql("o_orderstatus = 'O' AND o_totalprice >= 200 AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH')",
                          "strftime(o_orderdate, '%Y-%m') AS dt_ref, o_orderpriority AS regional")})
    SELECT coalesce(a.dt_ref, b.dt_ref) AS dt_ref, coalesce(a.regional, b.regional) AS regional,
           CASE WHEN a.dt_ref IS NULL THEN 'added' WHEN b.dt_ref IS NULL THEN 'removed'
                WHEN a.v <> b.v OR a.n <> b.n THEN 'changed' ELSE 'equal' END AS status,
           CAST(a.v AS DOUBLE) AS "TOTAL_VENDAS_a", CAST(b.v AS DOUBLE) AS "TOTAL_VENDAS_b",
           CAST(coalesce(b.v, 0) - coalesce(a.v, 0) AS DOUBLE) AS "TOTAL_VENDAS_delta",
           a.n AS "QTD_PEDIDOS_a", b.n AS "QTD_PEDIDOS_b",
           coalesce(b.n, 0) - coalesce(a.n, 0) AS "QTD_PEDIDOS_delta"
    FROM a0 a FULL OUTER JOIN b ON a.dt_ref = b.dt_ref AND a.regional = b.regional
    """,
)
def sales_drift(t: Tables):
    # Two rule sets of the same KPI, compared at the keys they share.
    rows = short_sales(t)
    keys = ["dt_ref", "regional"]
    first = sales_kpi(rows, VALIDATED).groupBy(*keys).agg(
        F.sum("TOTAL_VENDAS").alias("TOTAL_VENDAS"), F.sum("QTD_PEDIDOS").alias("QTD_PEDIDOS")
    )
    second = sales_kpi(rows, VALIDATED_CHANGED)
    return kpi.compare_variants(first, second, keys, ["TOTAL_VENDAS", "QTD_PEDIDOS"])
