"""Maintenance-order fact: two source systems, frozen and closed snapshots per planning month."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidlake.functions import dates, fixed, keys, text
from braidlake.functions.casts import safe_cast, safe_int
from braidlake.operators import asof, select, union
from braidlake.plans.registry import Tables, query
from braidlake.sources import lake

# The column names of the source tables.
DATE_COLS = [
    "Primeiro_data_inicio", "Data_Entrada", "Data_Modificacao", "Data_fim_real",
    "Primeiro_data_fim", "Data_referencia", "Data_pedido", "Inicio_Base", "Confirmado_em",
    "Data_lancamento", "Data_planejada",
]
TIME_COLS = ["Primeiro_hora_inicio", "Primeiro_hora_fim", "Hora_inicio", "Fim_real_hora"]
CONFIRMATION_COLS = [
    "Texto_Confirmacao", "Num_Pessoal", "Nome_empregado", "Data_lancamento", "Confirmado_em",
    "Confirmado_por",
]
TEXT_COLS = [
    "Ordem", "Operacao", "Sub_Operacao", "Chave_Controle", "Tipo_ativ_manutencao",
    "Centro_planejamento", "Local_Instalacao", "Status_Operacao", "Status_sistema",
    "Item_Manutencao", "Plano_manutencao", "Num_Pessoal_Planejado", "Tipo_Ordem",
    "Txt_breve_operacao", "Texto_Breve", "Centro_trab_respons", "Centro_trab_operacao",
    "Propriedade",
]
COLUMNS = dict.fromkeys([*TEXT_COLS, *CONFIRMATION_COLS, *DATE_COLS, *TIME_COLS], "string")
VERSION = ["Ordem", "Operacao", "Sub_Operacao", "CREATED_DATE_HZ"]


@dataclass(frozen=True)
class MaintenanceInputs:
    """Source frames. ``legacy`` and ``current`` hold operation versions under the columns of
    ``COLUMNS`` (absent ones count as NULL) plus CREATED_DATE_HZ; ``current_names`` renames those of
    the current system first."""

    legacy: DataFrame
    current: DataFrame
    units: DataFrame  # SAP_CODIGO, HANA_CODIGO, COD_UNIDADE_LAKE, CREATED_DATE_HZ
    areas: DataFrame  # AREA_SAP, COD_AREA_LAKE, CREATED_DATE_HZ
    subareas: DataFrame  # SUBAREA_SAP, COD_SUBAREA_LAKE, CREATED_DATE_HZ
    items_legacy: DataFrame  # Item_manutencao, Descricao_item_manutencao, CREATED_DATE_HZ
    items_current: DataFrame
    calendar: DataFrame  # Data, CodigoData, AnoP3m, MesP3m
    freezes: DataFrame  # ANO_MES_CONGELAMENTO, DATA_CONGELAMENTO_BASE, DATA_FECHAMENTO_P3M
    rollout: DataFrame  # SK_UNIDADE, DATA_ROLLOUT
    excluded: DataFrame  # NUM_ORDEM
    current_names: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class MaintenanceRules:
    legacy_planned: Sequence[str] = tuple(fixed.LEGACY_PLANNED)
    legacy_corrective: Sequence[str] = tuple(fixed.LEGACY_CORRECTIVE)
    current_planned: Sequence[str] = tuple(fixed.CURRENT_PLANNED)
    current_corrective: Sequence[str] = tuple(fixed.CURRENT_CORRECTIVE)
    history_until: dt.date = dt.date(2024, 6, 2)

    def unpadded(self) -> "MaintenanceRules":
        """Variant in which legacy codes are stored without leading zeros."""
        return MaintenanceRules(
            tuple(c.lstrip("0") for c in self.legacy_planned),
            tuple(c.lstrip("0") for c in self.legacy_corrective),
            self.current_planned, self.current_corrective, self.history_until,
        )


def _operations(
    df: DataFrame, planned: Sequence[str], corrective: Sequence[str], letter: str, since: str
) -> DataFrame:
    """Versions in scope, one per order, operation and extraction date."""
    kind = F.col("Tipo_ativ_manutencao")
    scoped = df.filter(
        (F.col("Chave_Controle") == "PM01")
        & kind.isin([*planned, *corrective])
        # Days are stored as yyyyMMdd text, so the bound can be compared, and pushed, as text.
        & (F.col("Inicio_Base") >= since)
    ).select(
        *[
            (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
            for c, t in COLUMNS.items()
        ],
        "CREATED_DATE_HZ",
    )
    order = [F.col(c).desc_nulls_last() for c in COLUMNS if c not in VERSION]
    return select.latest_by(scoped, VERSION, order).withColumns(
        {
            "SK_TIPO_ATIVIDADE_MANUTENCAO": F.concat(F.lit(letter), safe_int(kind).cast("string")),
            "DSC_TIPO_ATIVIDADE": F.when(kind.isin(list(planned)), "Plano Manutenção").when(
                kind.isin(list(corrective)), "Corretiva"
            ),
        }
    )


def _items(df: DataFrame, origin: str) -> DataFrame:
    newest = select.latest_by(df, ["Item_manutencao"], "CREATED_DATE_HZ")
    codes = text.extract_code("Descricao_item_manutencao")
    return newest.select(
        safe_int(F.col("Item_manutencao").cast("string")).alias("_item"),
        F.lit(origin).alias("_origin"),
        codes["code"].alias("SK_RISCO"), codes["impact"].alias("SK_IMPACTO_RISCO"),
    )


def order_operations(inputs: MaintenanceInputs, rules: MaintenanceRules, run_date: dt.date) -> DataFrame:
    """Operation versions of both systems with their keys, flags and planning month.

    Plants, areas, sub-areas and days are reference tables that do not grow with the orders. They are broadcast,
    as the wide versions would otherwise be shuffled once for each before their sizes are known.
    """
    since, _ = planning_bounds(inputs.calendar, run_date)
    low = since.strftime("%Y%m%d")
    units = select.latest_by(inputs.units, ["SAP_CODIGO"], "CREATED_DATE_HZ").select(
        F.col("COD_UNIDADE_LAKE").cast("int").alias("COD_UNIDADE_LAKE"), "SAP_CODIGO", "HANA_CODIGO"
    )
    legacy = _operations(
        inputs.legacy, rules.legacy_planned, rules.legacy_corrective, "E", low
    ).join(
        F.broadcast(units.select(F.col("SAP_CODIGO").alias("Centro_planejamento"), "COD_UNIDADE_LAKE")),
        "Centro_planejamento", "left",
    )
    names = dict(inputs.current_names)
    renamed = inputs.current.withColumnsRenamed(names) if names else inputs.current
    current = _operations(
        renamed, rules.current_planned, rules.current_corrective, "H", low
    ).join(
        F.broadcast(
            units.filter(F.col("HANA_CODIGO").isNotNull()).select(
                F.col("HANA_CODIGO").alias("Centro_planejamento"), "COD_UNIDADE_LAKE"
            )
        ),
        "Centro_planejamento", "left",
    )
    both = union.align_union({"ECC": legacy, "HANA": current}, "ORIGEM")

    items = _items(inputs.items_legacy, "ECC").unionByName(_items(inputs.items_current, "HANA"))
    risky = both.withColumn("_key", safe_int("Item_Manutencao")).join(
        items, (F.col("_key") == F.col("_item")) & (F.col("ORIGEM") == F.col("_origin")), "left"
    ).drop("_key", "_item", "_origin").fillna({"SK_RISCO": "XX", "SK_IMPACTO_RISCO": "-1"})

    place, loc = F.col("Centro_planejamento"), F.col("Local_Instalacao")
    # Locations that start with a dash follow no convention and are left out, as are blank plants.
    known = place.isNotNull() & (place.like("BR%") | loc.isNull() | ~loc.like("-%") & (loc != ""))
    parts = text.parse_location("Local_Instalacao", "Centro_planejamento")
    placed = risky.filter(known).withColumns({"AREA": parts["area"], "SUBAREA": parts["subarea"]})
    confirmed = text.contains_any_word("Status_Operacao", ["CONF", "CNPA"], whole=True)
    placed = keys.blank_unless(placed, CONFIRMATION_COLS, confirmed)

    areas = select.latest_by(inputs.areas, ["AREA_SAP"], "CREATED_DATE_HZ").select(
        F.col("AREA_SAP").alias("AREA"), F.col("COD_AREA_LAKE").cast("int").alias("COD_AREA_LAKE")
    )
    subareas = select.latest_by(inputs.subareas, ["SUBAREA_SAP"], "CREATED_DATE_HZ").select(
        F.col("SUBAREA_SAP").alias("SUBAREA"),
        F.col("COD_SUBAREA_LAKE").cast("int").alias("COD_SUBAREA_LAKE"),
    )
    flagged = (
        placed.join(F.broadcast(areas), "AREA", "left").join(F.broadcast(subareas), "SUBAREA", "left")
        .join(
            inputs.excluded.select(
                F.col("NUM_ORDEM").alias("Ordem"), F.lit(1).alias("FLAG_EXPURGO")
            ).distinct(),
            "Ordem", "left",
        )
    )
    months = inputs.calendar.select(
        F.col("CodigoData").cast("string").alias("Inicio_Base"),
        F.concat(F.col("AnoP3m").cast("string"), F.lpad(F.col("MesP3m").cast("string"), 2, "0"))
        .alias("MES_P3M"),
    )
    dated = flagged.join(F.broadcast(months), "Inicio_Base", "left")
    minus = F.lit(-1)

    def key(col: str, to: str = "int"):
        return safe_cast(F.col(col), to).alias(col.upper())

    def hashed(*cols: str):
        return keys.hash_key(list(cols))

    return dated.select(
        key("Ordem", "bigint"), dates.clean_date("Inicio_Base").alias("DATA_INICIO_BASE"),
        key("Operacao"), "Chave_Controle", "Tipo_Ordem", "Status_Operacao", "Status_sistema",
        key("Item_Manutencao", "bigint"), key("Sub_Operacao"),
        F.col("Plano_manutencao").alias("SK_PLANO_MANUTENCAO"),
        safe_int("Tipo_ativ_manutencao").alias("TIPO_ATIVIDADE_MANUTENCAO"),
        "Num_Pessoal_Planejado", "SK_TIPO_ATIVIDADE_MANUTENCAO",
        dates.date_key("Data_fim_real").alias("SK_DATA_FIM_REAL"),
        dates.time_key("Fim_real_hora").alias("SK_HORA_FIM_REAL"),
        dates.date_key("Data_Entrada").alias("SK_DATA_ENTRADA"),
        dates.date_key("Inicio_Base").alias("SK_DATA_INICIO_BASE"),
        dates.date_key("Confirmado_em").alias("SK_DATA_CONFIRMADO_EM"),
        dates.date_key("Data_planejada").alias("SK_DATA_PLANEJADA"),
        "CREATED_DATE_HZ",
        text.contains_any_word(F.upper("Status_sistema"), fixed.CLOSED_STATUS_WORDS)
        .cast("int").alias("MREL_FLAG"),
        "MES_P3M", F.coalesce("FLAG_EXPURGO", F.lit(0)).alias("FLAG_EXPURGO"),
        "DSC_TIPO_ATIVIDADE", "SK_RISCO", safe_int("SK_IMPACTO_RISCO").alias("SK_IMPACTO_RISCO"),
        F.coalesce("Local_Instalacao", F.lit("-1")).alias("SK_LOCAL_INSTALACAO"),
        F.coalesce("Txt_breve_operacao", F.lit("Não Informado")).alias("TEXTO_BREVE_OPERACAO"),
        hashed("Centro_trab_respons").alias("SK_CENTRO_TRABALHO_RESPONSAVEL"),
        hashed("Centro_trab_operacao").alias("SK_CENTRO_TRABALHO_OPERACAO"),
        F.abs(F.hash(F.lit("PM"), F.col("Propriedade")).cast("bigint")).alias("SK_PRIORIDADE"),
        F.coalesce("Texto_Breve", F.lit("Não Informado")).alias("TEXTO_BREVE"),
        F.coalesce("COD_UNIDADE_LAKE", minus).alias("SK_UNIDADE"),
        F.coalesce("COD_SUBAREA_LAKE", minus).alias("SK_SUBAREA"),
        F.coalesce("COD_AREA_LAKE", minus).alias("SK_AREA"),
        F.coalesce(dates.clean_date("Data_Modificacao"), dates.clean_date("Data_Entrada"))
        .alias("INCREMENTAL_DATE"),
        F.concat("Ordem", "Operacao", F.coalesce("Sub_Operacao", F.lit(""))).alias(
            "ID_ORDEM_OPERACAO"
        ),
        "ORIGEM",
    )


def planning_bounds(calendar: DataFrame, run_date: dt.date) -> tuple[dt.date, dt.date]:
    """First and last day of the planning months from January of last year to two months ahead.

    One row of two dates comes back to the driver, so that later filters carry literals.
    """
    month = F.concat(F.col("AnoP3m").cast("string"), F.lpad(F.col("MesP3m").cast("string"), 2, "0"))
    first = f"{run_date.year - 1}01"
    last = dates.add_months(run_date, 2).strftime("%Y%m")
    row = calendar.filter((month >= first) & (month <= last)).agg(F.min("Data"), F.max("Data")).first()
    if row[0] is None:
        raise ValueError("the calendar has no day in the planning window")
    return row[0], row[1]


def maintenance_fact(
    inputs: MaintenanceInputs,
    run_date: dt.date,
    rules: MaintenanceRules = MaintenanceRules(),
    staged: bool = False,
) -> DataFrame:
    """Frozen operations with their status at closing, one row per operation and planning month.

    The version table feeds the snapshot, the frozen rows and the closing status, and the frozen
    rows are read twice by the closing lookup; with ``staged`` both are written to the shared
    folder once instead of being computed for each use.
    """
    _, until = planning_bounds(inputs.calendar, run_date)
    versions = order_operations(inputs, rules, run_date)
    if staged:
        versions = lake.stage(versions, "order_operations")
    freezes = inputs.freezes.select(
        F.col("ANO_MES_CONGELAMENTO").alias("MES_P3M"),
        F.try_to_date("DATA_CONGELAMENTO_BASE", "yyyy-MM-dd").alias("DATA_CONGELAMENTO_BASE"),
        F.try_to_date("DATA_FECHAMENTO_P3M", "yyyy-MM-dd").alias("DATA_FECHAMENTO_BASE"),
    )
    dated = versions.join(F.broadcast(freezes), "MES_P3M", "left")
    frozen = asof.freeze_snapshot(
        dated, ["ORDEM"], "CREATED_DATE_HZ", "DATA_CONGELAMENTO_BASE"
    )
    split = asof.rollout_split(
        frozen, inputs.rollout, "SK_UNIDADE", "DATA_INICIO_BASE", "DATA_ROLLOUT", "ORIGEM", "ECC",
        "HANA",
    )
    if staged:
        split = lake.stage(split, "frozen_operations")
    status = F.upper("Status_Operacao")
    closing = versions.select(
        "ID_ORDEM_OPERACAO", "CREATED_DATE_HZ",
        F.col("Status_Operacao").alias("STATUS_FECHAMENTO"),
        F.when(status.like("%CONF%") | status.like("%CNF%"), 1).otherwise(0).alias(
            "STATUS_FECHAMENTO_FLAG"
        ),
        F.col("CREATED_DATE_HZ").alias("CREATED_DATE_HZ_FECHAMENTO"),
    )
    closed = asof.status_at(
        split, closing, ["ID_ORDEM_OPERACAO"], "CREATED_DATE_HZ", "DATA_FECHAMENTO_BASE",
        ["STATUS_FECHAMENTO", "STATUS_FECHAMENTO_FLAG", "CREATED_DATE_HZ_FECHAMENTO"],
    )
    final = select.latest_by(
        closed, ["ID_ORDEM_OPERACAO", "MES_P3M"],
        [
            F.col("CREATED_DATE_HZ_FECHAMENTO").desc_nulls_last(), F.desc("CREATED_DATE_HZ"),
            F.desc("ORIGEM"), F.col("SK_LOCAL_INSTALACAO").desc_nulls_last(),
        ],
    )
    freeze_key = F.date_format("DATA_CONGELAMENTO_BASE", "yyyyMMdd").cast("int")
    late = final.filter(
        (F.col("DATA_INICIO_BASE") < F.lit(rules.history_until))
        & (F.col("ORIGEM") == "HANA")
        & (F.col("SK_DATA_FIM_REAL") > freeze_key)
    )
    kept = final.filter(
        (F.col("DATA_INICIO_BASE") <= F.lit(until))
        & (F.col("MREL_FLAG") == 0)
        & ~F.col("SK_TIPO_ATIVIDADE_MANUTENCAO").isin(fixed.EXCLUDED_ACTIVITIES)
    ).drop("DATA_INICIO_BASE", "CREATED_DATE_HZ")
    return asof.append_history(kept, late, ["ID_ORDEM_OPERACAO", "MES_P3M"])


# ---- registered on the sample tables --------------------------------------------------------

SAMPLE_RUN = dt.date(1999, 3, 10)


def sample_inputs(t: Tables) -> MaintenanceInputs:
    """Order lines as operation versions of two systems; parts as items and places."""
    flag, qty = F.col("l_returnflag"), F.col("l_quantity")
    size = F.col("p_size").cast("string")
    kind = F.col("p_type")
    lines = (
        t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(t.part, F.col("p_partkey") == F.col("l_partkey"))
        .join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey"))
    )
    current = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    place = F.when(current, F.concat(F.lit("H"), "s_nationkey")).otherwise(
        F.concat(F.when(F.col("s_nationkey") < 12, "BR").otherwise("AC"), "s_nationkey")
    )
    rows = lines.select(
        F.col("l_orderkey").cast("string").alias("Ordem"),
        F.col("l_linenumber").cast("string").alias("Operacao"),
        F.when(F.col("l_linestatus") == "O", "PM01").otherwise("PM02").alias("Chave_Controle"),
        F.when(qty > 40, "300").when(qty > 20, "200").when(qty > 10, "210").otherwise("999")
        .alias("Tipo_ativ_manutencao"),
        place.alias("Centro_planejamento"),
        F.when(kind == "PROMO", F.concat(F.lit("X-"), "p_partkey", F.lit("-LIN"), size))
        .when(kind == "SMALL", F.concat(F.lit("X-1-A"), size, F.lit("-L-"), "p_partkey"))
        .when(kind == "LARGE", F.concat(F.lit("AB-"), size, F.lit("-C")))
        .when(kind == "MEDIUM", "-Q-1").alias("Local_Instalacao"),
        F.when(flag == "R", "REL CONF").when(flag == "A", "CNF ABER").otherwise("LIB")
        .alias("Status_Operacao"),
        F.when(F.col("l_discount") > 0.08, "ABER MREL").otherwise("ABER").alias("Status_sistema"),
        F.col("l_partkey").cast("string").alias("Item_Manutencao"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("Inicio_Base"),
        F.when(flag == "N", "00000000").otherwise(F.date_format("l_shipdate", "yyyyMMdd"))
        .alias("Data_fim_real"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("Confirmado_em"),
        F.col("l_shipdate").cast("date").alias("CREATED_DATE_HZ"), current.alias("_current"),
    )
    stamp = F.lit("2000-01-01").alias("CREATED_DATE_HZ")
    units = t.nation.select(
        F.concat(F.when(F.col("n_nationkey") < 12, "BR").otherwise("AC"), "n_nationkey")
        .alias("SAP_CODIGO"),
        F.concat(F.lit("H"), "n_nationkey").alias("HANA_CODIGO"),
        F.col("n_nationkey").alias("COD_UNIDADE_LAKE"), stamp,
    )
    sizes = t.part.groupBy(F.rpad(size, 5, "0").alias("c")).agg(F.max("p_size").alias("p_size"))
    items = t.part.select(
        F.col("p_partkey").cast("string").alias("Item_manutencao"),
        F.concat(F.lit("SF-"), F.col("p_size") % 10, F.lit("-"), F.lpad(size, 2, "0"))
        .alias("Descricao_item_manutencao"), stamp,
    )
    # Planning months run from the 26th to the 25th.
    days = t.spark.sql(
        "SELECT explode(sequence(DATE'1995-01-01', DATE'2001-12-31', INTERVAL 1 DAY)) AS Data"
    ).withColumn("_m", F.when(F.day("Data") > 25, F.add_months(F.trunc("Data", "MM"), 1))
                 .otherwise(F.trunc("Data", "MM")))
    calendar = days.select(
        "Data", F.date_format("Data", "yyyyMMdd").alias("CodigoData"), F.year("_m").alias("AnoP3m"),
        F.month("_m").alias("MesP3m"),
    )
    freezes = days.select("_m").distinct().select(
        F.date_format("_m", "yyyyMM").alias("ANO_MES_CONGELAMENTO"),
        F.date_add("_m", 20).cast("string").alias("DATA_CONGELAMENTO_BASE"),
        F.date_add("_m", 60).cast("string").alias("DATA_FECHAMENTO_P3M"),
    )
    rollout = t.nation.filter("n_regionkey <> 4").select(
        F.col("n_nationkey").alias("SK_UNIDADE"),
        F.date_add(F.lit(dt.date(1998, 1, 1)), F.col("n_nationkey") * 20).alias("DATA_ROLLOUT"),
    )
    return MaintenanceInputs(
        legacy=rows.filter("NOT _current"), current=rows.filter("_current"), units=units,
        areas=sizes.select(F.col("c").alias("AREA_SAP"), F.col("p_size").alias("COD_AREA_LAKE"), stamp),
        subareas=sizes.select(
            F.col("c").alias("SUBAREA_SAP"), F.col("p_size").alias("COD_SUBAREA_LAKE"), stamp
        ),
        items_legacy=items, items_current=items, calendar=calendar, freezes=freezes,
        rollout=rollout,
        excluded=t.orders.filter("o_totalprice > 400000").select(
            F.col("o_orderkey").cast("string").alias("NUM_ORDEM")
        ),
    )


SQL_VERSIONS = """
    raw AS (SELECT l_orderkey AS ordem, l_linenumber AS op, o_orderpriority IN ('1-URGENT', '2-HIGH')
          AS cur, CASE WHEN l_quantity > 40 THEN 300 WHEN l_quantity > 20 THEN 200 ELSE 210 END AS kind,
          s_nationkey AS unit, CASE p_type WHEN 'PROMO' THEN 'X-' || p_partkey || '-LIN' || p_size
            WHEN 'SMALL' THEN 'X-1-A' || p_size || '-L-' || p_partkey
            WHEN 'LARGE' THEN 'AB-' || p_size || '-C' WHEN 'MEDIUM' THEN '-Q-1' END AS loc,
          CASE l_returnflag WHEN 'R' THEN 'REL CONF' WHEN 'A' THEN 'CNF ABER' ELSE 'LIB' END AS st,
          CASE WHEN l_discount > 0.08 THEN 1 ELSE 0 END AS mrel, l_partkey AS item, p_size,
          CAST(o_orderdate AS DATE) AS start, CAST(l_shipdate AS DATE) AS created,
          CASE WHEN l_returnflag = 'N' THEN -1 ELSE CAST(strftime(l_shipdate, '%Y%m%d') AS INT) END
            AS fim, CASE WHEN l_returnflag = 'N' THEN '00000000' ELSE strftime(l_shipdate, '%Y%m%d')
            END AS fim_text, CAST(CASE WHEN day(o_orderdate) > 25 THEN date_trunc('month', o_orderdate)
            + INTERVAL 1 MONTH ELSE date_trunc('month', o_orderdate) END AS DATE) AS pm, o_totalprice
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
        JOIN supplier ON s_suppkey = l_suppkey
        WHERE l_linestatus = 'O' AND l_quantity > 10 AND o_orderdate >= DATE '1997-12-26'),
    one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ordem, op, created, cur
              ORDER BY kind DESC, place DESC, loc DESC NULLS LAST, st DESC,
              CASE WHEN mrel = 1 THEN 'ABER MREL' ELSE 'ABER' END DESC, item::VARCHAR DESC,
              fim_text DESC) AS rn
            FROM (SELECT *, CASE WHEN cur THEN 'H' WHEN unit < 12 THEN 'BR' ELSE 'AC' END || unit
                  AS place FROM raw)) WHERE rn = 1),
    v AS (SELECT ordem, op, ordem::VARCHAR || op AS id, cur, unit, start, created, mrel, st, fim, pm, kind, item,
            p_size, CASE WHEN cur THEN 'H' ELSE 'E' END || kind AS sk_kind,
            CASE WHEN o_totalprice > 400000 THEN 1 ELSE 0 END AS exc, coalesce(loc, '-1') AS loc,
            CASE WHEN place LIKE 'BR%' THEN CASE WHEN loc IS NULL THEN NULL
                   ELSE substr(rpad(trim(string_split(loc, '-')[2]), 5, '0'), 1, 5) END
                 WHEN length(string_split(loc, '-')[1]) = 1 THEN string_split(loc, '-')[3]
                 ELSE substr(rpad(trim(string_split(loc, '-')[2]), 5, '0'), 1, 5) END AS area,
            CAST(pm AS DATE) + 20 AS fz, CAST(pm AS DATE) + 60 AS closing
          FROM one WHERE place LIKE 'BR%' OR loc IS NULL OR loc NOT LIKE '-%')
"""


@query(
    "maintenance_fact",
    f"""
    WITH {SQL_VERSIONS},
    nw AS (SELECT a.ordem, a.fz, max(b.created) AS created FROM (SELECT DISTINCT ordem, fz
             FROM v) a JOIN v b ON b.ordem = a.ordem AND b.created < a.fz GROUP BY ALL),
    f AS (SELECT v.* FROM v JOIN nw USING (ordem, fz, created)),
    ro AS (SELECT n_nationkey AS unit, DATE '1998-01-01' + n_nationkey * 20 AS ro FROM nation
           WHERE n_regionkey <> 4),
    s AS (SELECT f.* FROM f LEFT JOIN ro USING (unit)
          WHERE (NOT cur AND NOT coalesce(start >= ro, false)) OR (cur AND start >= ro)),
    cl AS (SELECT s.id, s.pm, s.created, s.cur, s.loc, max(b.created) AS closed
           FROM s LEFT JOIN v b ON b.id = s.id AND b.created >= s.created AND b.created <= s.closing
           GROUP BY ALL),
    fi AS (SELECT * FROM (SELECT s.*, closed, row_number() OVER (PARTITION BY s.id, s.pm
             ORDER BY closed DESC NULLS LAST, s.created DESC,
             CASE WHEN s.cur THEN 'HANA' ELSE 'ECC' END DESC, s.loc DESC) AS r
           FROM s JOIN cl ON cl.id = s.id AND cl.pm = s.pm AND cl.created = s.created
            AND cl.cur = s.cur AND cl.loc = s.loc) WHERE r = 1),
    k AS (SELECT *, mrel = 0 AND sk_kind NOT IN ('E210') AS keep,
            cur AND fim > CAST(strftime(fz, '%Y%m%d') AS INT) AS late FROM fi)
    SELECT k.id AS "ID_ORDEM_OPERACAO", strftime(k.pm, '%Y%m') AS "MES_P3M", k.unit AS "SK_UNIDADE",
           sk_kind AS "SK_TIPO_ATIVIDADE_MANUTENCAO", CASE WHEN cur THEN 'HANA' ELSE 'ECC' END
           AS "ORIGEM", exc AS "FLAG_EXPURGO", fz::VARCHAR AS "DATA_CONGELAMENTO_BASE",
           closed::VARCHAR AS "CREATED_DATE_HZ_FECHAMENTO", p_size % 10 AS "SK_IMPACTO_RISCO",
           CASE WHEN keep THEN NULL ELSE start::VARCHAR END AS "DATA_INICIO_BASE",
           CASE WHEN keep THEN NULL ELSE k.created::VARCHAR END AS "CREATED_DATE_HZ",
           coalesce((SELECT max(p_size) FROM part WHERE rpad(p_size::VARCHAR, 5, '0') = area), -1)
           AS "SK_AREA",
           ordem AS "ORDEM", op AS "OPERACAO", 'PM01' AS "Chave_Controle", NULL AS "Tipo_Ordem",
           k.st AS "Status_Operacao", CASE WHEN mrel = 1 THEN 'ABER MREL' ELSE 'ABER' END AS "Status_sistema",
           item AS "ITEM_MANUTENCAO", NULL AS "SUB_OPERACAO", NULL AS "SK_PLANO_MANUTENCAO",
           kind AS "TIPO_ATIVIDADE_MANUTENCAO", NULL AS "Num_Pessoal_Planejado", fim AS "SK_DATA_FIM_REAL",
           -1 AS "SK_HORA_FIM_REAL", -1 AS "SK_DATA_ENTRADA",
           CAST(strftime(start, '%Y%m%d') AS INT) AS "SK_DATA_INICIO_BASE",
           CASE WHEN k.st = 'REL CONF' THEN CAST(strftime(k.created, '%Y%m%d') AS INT) ELSE -1 END AS "SK_DATA_CONFIRMADO_EM",
           -1 AS "SK_DATA_PLANEJADA", mrel AS "MREL_FLAG",
           CASE WHEN kind = 300 THEN 'Plano Manutenção' ELSE 'Corretiva' END AS "DSC_TIPO_ATIVIDADE",
           'SF' AS "SK_RISCO", loc AS "SK_LOCAL_INSTALACAO", 'Não Informado' AS "TEXTO_BREVE_OPERACAO",
           -1 AS "SK_CENTRO_TRABALHO_RESPONSAVEL", -1 AS "SK_CENTRO_TRABALHO_OPERACAO",
           'Não Informado' AS "TEXTO_BREVE", NULL AS "INCREMENTAL_DATE", k.closing::VARCHAR AS "DATA_FECHAMENTO_BASE",
           c.st AS "STATUS_FECHAMENTO",
           CASE WHEN c.st IS NULL THEN NULL WHEN c.st LIKE '%CONF%' OR c.st LIKE '%CNF%' THEN 1 ELSE 0 END
           AS "STATUS_FECHAMENTO_FLAG"
    FROM k LEFT JOIN (SELECT id, created, max(st) AS st FROM v GROUP BY 1, 2) c ON c.id = k.id AND c.created = k.closed
    WHERE (keep AND start <= DATE '1999-05-25') OR (late AND NOT
         (keep AND start <= DATE '1999-05-25'))
    """,
)
def maintenance_fact_query(t: Tables):
    # The priority is a hash that SQL does not have; the sub-area follows the rules of the area.
    return maintenance_fact(sample_inputs(t), SAMPLE_RUN, staged=True).drop("SK_PRIORIDADE", "SK_SUBAREA")
