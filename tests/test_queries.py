"""Every registered query against its SQL twin, and the shape of the plans."""

import check_oracle
import plan_report
import pytest

import __spark_entry__ as entry
from braidlake.plans import sales_job
from braidlake.plans.registry import ORACLE, QUERIES, Tables

ROOT = "/root/testdata/sf0.001"
GLOBAL = {"date_lookup", "global_bounds", "contract_violations", "upsert_scd2", "company_load"}  # one-row aggregates


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(ROOT)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, con, name):
    text, ok = check_oracle.compare(spark, con, ROOT, name)
    assert ok, text


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan_has_no_cross_join_or_python(spark, name):
    _, bad = plan_report.summary(entry.queries()[name](spark, ROOT))
    assert set(bad) <= ({"Exchange SinglePartition"} if name in GLOBAL else set())


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_filters_reach_the_scan(spark):
    text = entry.queries()["date_window"](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in text


def test_activity_states_need_one_wide_scan(spark):
    counts, _ = plan_report.summary(entry.queries()["months_active"](spark, ROOT))
    assert counts["FileScan parquet"] == 2  # the other one counts the twelve months of the seed


def test_only_reduced_rows_are_copied_for_distinct_counts(spark):
    text = entry.queries()["kpi_gold"](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
    below = text[text.index("Expand") :]
    assert below.index("HashAggregate") < below.index("FileScan")


def test_one_scan_for_all_anchors(spark):
    for name in ("trailing_max_3m", "trailing_max_12m", "running_high"):
        counts, _ = plan_report.summary(entry.queries()[name](spark, ROOT))
        assert counts["FileScan parquet"] == 1


def test_one_scan_for_all_parts_of_a_statement(spark):
    for name, scans in (("statement_full", 2), ("movement_statement", 1), ("stack_signed", 1)):  # lines and documents
        counts, _ = plan_report.summary(entry.queries()[name](spark, ROOT))
        assert counts["FileScan parquet"] == scans, name


def test_distinct_counts_copy_no_rows(spark):
    for name in ("group_aggregates", "filtered_aggs", "bitmap_windows"):
        text = entry.queries()[name](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in text, name


def test_sales_job_writes_three_tables(spark, tmp_path):
    paths = [str(tmp_path / p) for p in ("curated", "gold", "audit")]
    sales_job.run(*sales_job.sample_inputs(Tables(spark, ROOT)), *paths)
    curated, gold, audit = (spark.read.parquet(p) for p in paths)
    assert set(curated.columns) == set(sales_job.CURATED_COLS)
    assert gold.count() and "gerado_em" in gold.columns
    assert audit.agg({"pedidos": "sum"}).first()[0] > 0


def test_survivors_are_limited_before_the_shuffle(spark):
    for name in ("latest_order", "drop_duplicates", "prefer_direct"):
        text = entry.queries()[name](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
        assert text.count("WindowGroupLimit") >= 2, name


def test_sliced_ranks_shuffle_the_rows_once(spark):
    counts, _ = plan_report.summary(entry.queries()["row_number_kept"](spark, ROOT))
    assert counts["Exchange hashpartitioning"] <= 4


def test_lines_of_sales_and_settlements_stay_as_they_are_dealt(spark):
    from braidlake.plans import catalog

    for name in ("sales_gold", "statement_full"):
        df = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
        assert "REPARTITION_BY_NUM" in df._jdf.queryExecution().executedPlan().toString(), name
