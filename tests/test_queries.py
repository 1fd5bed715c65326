"""Registered queries against DuckDB on the same tables, and invariants."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from screenmart import queries as workload
from screenmart.functions.steps import STEPS
from screenmart.operators.scope import TenantCatalog, tenant_from_setting
from screenmart.queries import EVENT_CARDS, GLOBAL, SAMPLE_OPTIONS
from screenmart.sources.sample import RAW_TABLES, sample_catalog, stored_sample_catalog
from tests.conftest import SF_DIR

QUERIES = entry_point.queries()
ORACLE = entry_point.oracle_sql()

COMPARED = """
P02_stg_eligibility P07_stg_latest_eligibility_snapshot P10_stg_program_eligibility P13_int_complete_screener_data
P18_mart_current_benefits P22_mart_qualified_benefits G04_stg_ga_screener_form_funnel
G06_stg_ga_screener_program_interactions G15_int_ga4_sessions M01_mart_ga_clicked_links M02_mart_ga_kpi_summary
M08_mart_screener_footer_engagement M10_mart_screener_form_funnel M23_mart_screener_results_outcomes
M26_mart_screener_screening_funnel V1_data QP01_common_expenses QP02_income_streams QP03_current_benefits_filtered
QP07_income_distribution QP13_immediate_needs QP19_median_annual_benefits QP22_median_household_assets
QP23_partner_values QP28_value_distribution QE01_conversion_funnel QE03_step_funnel QE09_eligible_share
QE19_most_shown_by_state QE21_resource_engagement QE24_help_by_topic QE30_nps_distribution QE32_disclaimer_links
K1_tenant_scope D5_orphan_programs QP01_common_expenses_tenant QP14_disabled_share_tenant
QP17_completed_screeners_filtered QE35_more_help_resources QE19_detail_rate_by_state_any D0_rule_report K1_session_view
S5_changed_days_screenings S6_refreshed_tables S7_backfilled_days QE21_resource_engagement_bitmaps_tenant QP22_medians_places
QP16_monthly_active_users_bitmaps M02_window_visitors_bitmaps P17_bucketed QP02_income_streams_places QP29_monthly_tenant
""".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in RAW_TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def test_every_query_has_a_check():
    assert set(workload.queries()) <= set(QUERIES) & set(ORACLE)


def test_checks_are_not_empty():
    """On the smaller sample of the driver every query but these has rows to compare."""
    con = duckdb.connect()
    for name in RAW_TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR.replace('sf0.001', 'sf0.01')}/{name}.parquet'")
    empty = {n for n in workload.queries() if not con.execute(f"select 1 from ({ORACLE[n]}) limit 1").fetchall()}
    # No tenant sees nothing; no program is shown twenty times in one state of the sample (the "_any" rows ask for one).
    assert empty == {"K1_no_tenant", "QE19_detail_rate_by_state", "QE19_conversion_by_state"}


def test_a_tenant_sees_its_own_partitions_only(spark):
    c = TenantCatalog(stored_sample_catalog(spark, SF_DIR, SAMPLE_OPTIONS), 3)
    marts = ["mart_screener_data", "mart_householdmembers", "mart_income"]
    for name in marts:
        plan = c[name]._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(white_label_id" in plan, name
    nobody = TenantCatalog(c.catalog, tenant_from_setting("  "))
    assert nobody["mart_screener_data"].count() == 0


@pytest.mark.parametrize("name", COMPARED)
def test_same_rows_as_duckdb(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    ours = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    theirs = sorted((tuple(r) for r in result.fetchall()), key=repr)
    assert ours == theirs


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() > 0


def test_ladders(spark):
    c = sample_catalog(spark, SF_DIR, SAMPLE_OPTIONS)
    shared = c["mart_screener_step_ladder"]
    assert shared.count() == len(STEPS) and shared.where("funnel_rank is not null").count() == 12
    assert [r["funnel_rank"] for r in c["mart_screener_cesn_combined_ladder"].orderBy("funnel_rank").collect()] == list(
        range(12)
    )


@pytest.fixture(scope="module")
def cards(spark):
    c = stored_sample_catalog(spark, SF_DIR, SAMPLE_OPTIONS)
    return lambda name: [r.asDict() for r in EVENT_CARDS[name](c, GLOBAL).collect()]


@pytest.mark.parametrize("name, column", [("QE01_conversion_funnel", "screenings"), ("QE03_step_funnel", "sessions"),
                                          ("QE04_energy_step_funnel", "sessions")])
def test_funnels_never_widen(cards, name, column):
    values = [r[column] for r in cards(name)]
    assert values and values == sorted(values, reverse=True)


def test_shares_sum_to_the_whole(cards):
    assert sum(r["pct_of_screeners"] for r in cards("QE02_sessions_per_screener")) == pytest.approx(100, abs=0.3)
    tabs = {}
    for r in cards("QE23_scroll_depth"):
        tabs.setdefault(r["tab"], []).append(r["pct_of_tab_scrollers"])
    assert all(sum(v) == pytest.approx(100, abs=0.3) for v in tabs.values())


@pytest.mark.parametrize("name", ["QE24_help_by_topic", "QE31_chrome_navigation", "QE32_disclaimer_links",
                                  "QE34_document_downloads", "QE36_back_to_screener"])
def test_clamped_rates_stay_in_range(cards, name):
    for row in cards(name):
        for column, value in row.items():
            if column.startswith("pct_") or column.endswith("_rate"):
                assert value is None or 0 <= value <= 100
