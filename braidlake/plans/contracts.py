"""The three governed tables: curated customers, curated transactions and the daily revenue KPI."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidlake.operators.contract import Contract, Field, conform
from braidlake.operators.kpi import ratio
from braidlake.plans.registry import Tables, day, money, query, sql_money, sql_ratio

# Columns, types and required fields of the contracts.
CUSTOMERS = Contract(
    "silver_generic.clientes_curados",
    [
        Field("cliente_id", "string", True, comment="Customer number"),
        Field("documento_hash", "string", comment="One-way hash of the customer's document"),
        Field("nome_fantasia", "string", comment="Trade name as shown in reports"),
        Field("segmento", "string", comment="Main commercial segment"),
        Field("canal_origem", "string", comment="Channel the customer came through"),
        Field("data_cadastro", "date", comment="Day of registration"),
        Field("status_cliente", "string", comment="State of the customer in the business"),
        Field("score_relacionamento", "decimal(10,2)", comment="Internal score of the relationship"),
        Field("cidade", "string", comment="Main city"),
        Field("estado", "string", comment="Main state"),
        Field("data_ref", "date", True, comment="Reference day, one partition each"),
    ],
    partition_by=["data_ref"],
    comment="Curated customers",
    properties={
        "quality_tier": "silver", "owner_domain": "comercial", "data_classification": "internal",
    },
)
TRANSACTIONS = Contract(
    "silver_generic.transacoes_curadas",
    [
        Field("transacao_id", "string", True, comment="Transaction number"),
        Field("cliente_id", "string", True, comment="Customer number"),
        Field("data_transacao", "timestamp", True, comment="When the transaction took place"),
        Field("categoria_produto", "string", comment="Product category"),
        Field("canal_venda", "string", comment="Sales channel"),
        Field("status_transacao", "string", comment="Operational state of the transaction"),
        Field("valor_bruto", "decimal(18,2)", comment="Amount before deductions"),
        Field("valor_liquido", "decimal(18,2)", comment="Amount after deductions"),
        Field("custo_total", "decimal(18,2)", comment="Cost of the transaction"),
        Field("margem_bruta", "decimal(18,2)", comment="Net amount less cost"),
        Field("data_ref", "date", True, comment="Reference day, one partition each"),
    ],
    partition_by=["data_ref"],
    comment="Curated transactions",
    properties={"quality_tier": "silver", "owner_domain": "receita", "retention_policy": "365d"},
)
DAILY_REVENUE = Contract(
    "gold_generic.kpi_receita_diaria",
    [
        Field("data_ref", "date", True, comment="Reference day, one partition each"),
        Field("regional", "string", True, comment="Region of the figures"),
        Field("canal_venda", "string", True, comment="Sales channel"),
        Field("receita_liquida_total", "decimal(18,2)", comment="Net revenue of the day"),
        Field("quantidade_transacoes", "bigint", comment="Transactions of the day"),
        Field("clientes_ativos", "bigint", comment="Customers with a transaction"),
        Field("margem_bruta_total", "decimal(18,2)", comment="Gross margin of the day"),
        Field("ticket_medio", "decimal(18,2)", comment="Net revenue per transaction"),
        Field("taxa_conversao", "decimal(10,4)", comment="Conversion rate; no formula published"),
        Field("nivel_confianca", "string", comment="Confidence in the figures; no formula published"),
    ],
    partition_by=["data_ref"],
    comment="Revenue figures per day, region and channel",
    properties={
        "gold_contract": "true", "owner_domain": "executivo", "sla_refresh": "D+1",
        "criticality": "high",
    },
)


def daily_revenue(transactions: DataFrame, regions: DataFrame) -> DataFrame:
    """Daily KPI of curated transactions; ``regions`` gives ``regional`` per ``cliente_id``.

    The conversion rate and the confidence level have no published formula and stay NULL.
    """
    per_day = (
        transactions.join(regions.select("cliente_id", "regional"), "cliente_id")
        .groupBy("data_ref", "regional", "canal_venda")
        .agg(
            F.sum("valor_liquido").alias("receita_liquida_total"),
            F.count("transacao_id").alias("quantidade_transacoes"),
            F.count_distinct("cliente_id").alias("clientes_ativos"),
            F.sum("margem_bruta").alias("margem_bruta_total"),
        )
    )
    ticket = ratio(F.col("receita_liquida_total"), F.col("quantidade_transacoes"))
    return conform(per_day.withColumn("ticket_medio", ticket), DAILY_REVENUE)


# ---- registered on the sample tables --------------------------------------------------------

TOTAL = sql_money("o_totalprice")


@query(
    "contract_customers",
    """
    SELECT c_custkey::VARCHAR AS cliente_id, sha256(c_name) AS documento_hash,
           c_name AS nome_fantasia, c_mktsegment AS segmento, NULL AS canal_origem,
           NULL AS data_cadastro, CASE WHEN c_acctbal > 0 THEN 'ATIVO' ELSE 'DEVEDOR' END
           AS status_cliente, CAST(CAST(c_acctbal AS DECIMAL(10,2)) AS DOUBLE)
           AS score_relacionamento, NULL AS cidade, c_nationkey::VARCHAR AS estado,
           '2000-06-01' AS data_ref FROM customer
    """,
)
def contract_customers(t: Tables):
    raw = t.customer.select(
        F.col("c_custkey").alias("cliente_id"), F.sha2("c_name", 256).alias("documento_hash"),
        F.col("c_name").alias("nome_fantasia"), F.col("c_mktsegment").alias("segmento"),
        F.when(F.col("c_acctbal") > 0, "ATIVO").otherwise("DEVEDOR").alias("status_cliente"),
        F.col("c_acctbal").alias("score_relacionamento"), F.col("c_nationkey").alias("estado"),
        F.lit("2000-06-01").alias("data_ref"),
    )
    return conform(raw, CUSTOMERS)


def curated_transactions(t: Tables) -> DataFrame:
    total = money("o_totalprice")
    cost = (total * F.lit("0.75").cast("decimal(3,2)")).cast("decimal(18,2)")
    raw = t.orders.select(
        F.col("o_orderkey").alias("transacao_id"), F.col("o_custkey").alias("cliente_id"),
        F.col("o_orderdate").cast("string").alias("data_transacao"),
        F.col("o_orderpriority").alias("canal_venda"),
        F.col("o_orderstatus").alias("status_transacao"), total.alias("valor_bruto"),
        total.alias("valor_liquido"), cost.alias("custo_total"), (total - cost).alias("margem_bruta"),
        # Open orders have no reference day yet, so the contract turns them away.
        F.when(F.col("o_orderstatus") != "O", day("o_orderdate").cast("string")).alias("data_ref"),
    )
    return conform(raw, TRANSACTIONS)


COST = f"((CAST({TOTAL} * 100 AS BIGINT) * 75 + 50) // 100)"


@query(
    "contract_transactions",
    f"""
    SELECT o_orderkey::VARCHAR AS transacao_id, o_custkey::VARCHAR AS cliente_id,
           CAST(o_orderdate AS VARCHAR) AS data_transacao, NULL AS categoria_produto,
           o_orderpriority AS canal_venda, o_orderstatus AS status_transacao,
           CAST({TOTAL} AS DOUBLE) AS valor_bruto, CAST({TOTAL} AS DOUBLE) AS valor_liquido,
           CAST({COST} AS DOUBLE) / 100 AS custo_total,
           CAST(CAST({TOTAL} * 100 AS BIGINT) - {COST} AS DOUBLE) / 100 AS margem_bruta,
           CAST(o_orderdate AS DATE)::VARCHAR AS data_ref
    FROM orders WHERE o_orderstatus <> 'O'
    """,
)
def contract_transactions(t: Tables):
    return curated_transactions(t)


@query(
    "contract_daily_revenue",
    f"""
    WITH g AS (SELECT CAST(o_orderdate AS DATE) AS d, r_name AS r, o_orderpriority AS c,
                 sum({TOTAL}) AS v, count(*) AS n, count(DISTINCT o_custkey) AS k,
                 sum(CAST({TOTAL} * 100 AS BIGINT) - {COST}) AS m
               FROM orders JOIN customer ON c_custkey = o_custkey
               JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
               WHERE o_orderstatus <> 'O' GROUP BY 1, 2, 3)
    SELECT d::VARCHAR AS data_ref, r AS regional, c AS canal_venda,
           CAST(v AS DOUBLE) AS receita_liquida_total, n AS quantidade_transacoes,
           k AS clientes_ativos, CAST(m AS DOUBLE) / 100 AS margem_bruta_total,
           {sql_ratio('v * 100', 'n * 100')} AS ticket_medio, NULL AS taxa_conversao,
           NULL AS nivel_confianca FROM g
    """,
)
def contract_daily_revenue(t: Tables):
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("regional")
    )
    regions = t.customer.join(geo, "c_nationkey").select(
        F.col("c_custkey").cast("string").alias("cliente_id"), "regional"
    )
    return daily_revenue(curated_transactions(t), regions)
