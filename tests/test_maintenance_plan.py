from __future__ import annotations

import datetime as dt
import re

from braidlake.plans import maintenance_job as job


def inputs(spark):
    def frame(names, *rows):
        return spark.createDataFrame(list(rows), ", ".join(f"{n} string" for n in names.split()))

    version = ("1", "10", "PM01", "200", "BR1", "X-1-A", "LIB", "ABER", "7", "19990105", "1999-01-06")
    names = "Ordem Operacao Chave_Controle Tipo_ativ_manutencao Centro_planejamento Local_Instalacao Status_Operacao Status_sistema Item_Manutencao Inicio_Base CREATED_DATE_HZ"
    item = frame("Item_manutencao Descricao_item_manutencao CREATED_DATE_HZ", ("7", "SF-1-02", "2000-01-01"))
    days = [(dt.date(1998, 1, 1) + dt.timedelta(i),) for i in range(600)]
    calendar = spark.createDataFrame(days, "Data date").selectExpr(
        "Data", "date_format(Data, 'yyyyMMdd') AS CodigoData", "year(Data) AS AnoP3m", "month(Data) AS MesP3m"
    )
    return job.MaintenanceInputs(
        legacy=frame(names, version), current=frame(names, version),
        units=frame("SAP_CODIGO HANA_CODIGO COD_UNIDADE_LAKE CREATED_DATE_HZ", ("BR1", "H1", "5", "2000-01-01")),
        areas=frame("AREA_SAP COD_AREA_LAKE CREATED_DATE_HZ", ("10000", "3", "2000-01-01")),
        subareas=frame("SUBAREA_SAP COD_SUBAREA_LAKE CREATED_DATE_HZ", ("A", "4", "2000-01-01")),
        items_legacy=item, items_current=item, calendar=calendar,
        freezes=frame("ANO_MES_CONGELAMENTO DATA_CONGELAMENTO_BASE DATA_FECHAMENTO_P3M", ("199901", "1999-01-21", "1999-03-01")),
        rollout=spark.createDataFrame([(5, dt.date(1999, 6, 1))], "SK_UNIDADE int, DATA_ROLLOUT date"),
        excluded=frame("NUM_ORDEM", ("2",)),
    )


def test_reference_tables_do_not_make_the_versions_move(spark):
    """With sizes that Spark would not broadcast by itself: shuffles are left for versions, items and excluded orders."""
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = job.order_operations(inputs(spark), job.MaintenanceRules(), dt.date(1999, 3, 10))
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert [r["SK_UNIDADE"] for r in rows if r["ORIGEM"] == "ECC"] == [5]
    assert {r["MES_P3M"] for r in rows} == {"199901"}
    keys = set(re.findall(r"SortMergeJoin(?:\(skew=true\))? \[(\w+)#", plan.split("Initial Plan")[0]))
    assert keys == {"_key", "Ordem"}
