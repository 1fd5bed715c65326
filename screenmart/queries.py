"""Every dataset and card as a named query over the sample tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screenmart.catalog import Catalog, Options
from screenmart.operators import checks
from screenmart.operators.rules import rule_report
from screenmart.operators.scope import EventScope, ScreenFilters, TenantCatalog, scope_to_tenant, tenant_from_setting
from screenmart.operators.session_tenant import declare_tenant, register_tenant_views, set_tenant
from screenmart.plans import build, distinct_marts, event_cards, firstgen, screen_cards
from screenmart.plans.rules import INCOME_FREQUENCIES, RULES, CatalogTables
from screenmart.session import tune
from screenmart.sources.backfill import copy_days
from screenmart.sources.buckets import BucketedCatalog
from screenmart.sources.incremental import DayTables
from screenmart.sources.sample import sample_catalog, scratch_folder, stored_sample_catalog
from screenmart.sources.sinks import refresh

Query = Callable[[SparkSession, str], DataFrame]

SAMPLE_OPTIONS = Options(
    analytics_epoch="20240108",
    wide_programs=tuple((f"prog{i}", i % 4 == 0) for i in range(25)),
    benefit_labels=(*((f"Program {i}", f"prog{i}") for i in range(24)), (None, "prog24")),
)

# Query id -> dataset.
DATASETS = {
    "P01": "stg_current_benefits",
    "P02": "stg_eligibility",
    "P03": "stg_expenses",
    "P04": "stg_household_demographics",
    "P05": "stg_householdmembers",
    "P06": "stg_income",
    "P07": "stg_latest_eligibility_snapshot",
    "P08": "stg_monthly_expenses",
    "P09": "stg_monthly_income",
    "P10": "stg_program_eligibility",
    "P11": "stg_referrer_codes",
    "P12": "stg_white_label",
    "P13": "int_complete_screener_data",
    "P14": "int_householdmembers",
    "P15": "int_immediate_needs",
    "P16": "int_immediate_needs_unpivoted",
    "P17": "int_income",
    "P18": "mart_current_benefits",
    "P19": "mart_householdmembers",
    "P20": "mart_immediate_needs",
    "P21": "mart_income",
    "P22": "mart_qualified_benefits",
    "P23": "mart_referrer_codes",
    "P24": "mart_screener_data",
    "P25": "mart_screener_expense",
    "G01": "stg_ga_link_clicks",
    "G02": "stg_ga_page_views",
    "G03": "stg_ga_sessions",
    "G04": "stg_ga_screener_form_funnel",
    "G05": "stg_ga_screener_help",
    "G06": "stg_ga_screener_program_interactions",
    "G07": "stg_ga_screener_resource_engagement",
    "G08": "stg_ga_screener_results_outcomes",
    "G09": "stg_ga_screener_scroll_depth",
    "G10": "stg_ga_screener_section_engagement",
    "G11": "stg_ga_screener_shares",
    "G12": "stg_ga_screener_step_interactions",
    "G13": "stg_ga_screener_ui_events",
    "G14": "int_ga4_page_views",
    "G15": "int_ga4_sessions",
    "G16": "int_screener_furthest_step",
    "G17": "int_screener_program_names",
    "M01": "mart_ga_clicked_links",
    "M02": "mart_ga_kpi_summary",
    "M03": "mart_ga_traffic_mediums",
    "M05": "mart_screener_cesn_funnel",
    "M06": "mart_screener_confirmation_edits",
    "M07": "mart_screener_filter_usage",
    "M08": "mart_screener_footer_engagement",
    "M09": "mart_screener_form_errors",
    "M10": "mart_screener_form_funnel",
    "M11": "mart_screener_furthest_step",
    "M12": "mart_screener_help",
    "M13": "mart_screener_language",
    "M14": "mart_screener_link_clicks",
    "M15": "mart_screener_member_income",
    "M16": "mart_screener_navigator_engagement",
    "M17": "mart_screener_nps",
    "M18": "mart_screener_program_interactions",
    "M19": "mart_screener_program_interactions_by_screening",
    "M20": "mart_screener_resource_engagement",
    "M21": "mart_screener_resource_engagement_by_screening",
    "M22": "mart_screener_results_back",
    "M23": "mart_screener_results_outcomes",
    "M24": "mart_screener_results_revisits",
    "M25": "mart_screener_saves",
    "M26": "mart_screener_screening_funnel",
    "M27": "mart_screener_scroll_depth",
    "M28": "mart_screener_section_engagement",
    "M29": "mart_screener_shares",
    "M30": "mart_screener_signup_consent",
    "M31": "mart_screener_step_facts",
    "M33": "mart_screener_step_views_by_screening",
    "V1": "data",
    "V2": "data_currentbenefits",
    "V3": "data_immediate_needs",
    "V4a": "data_expenses",
    "V4b": "data_income",
    "V4c": "data_householdmembers",
    "V5": "data_programs",
    "V6": "data_referrer_codes",
}

# Constant tables M04 and M32 hold no data of their own; the funnels QE03 and QE04
# read them beside the data, and the tests compare their rows.

FILTERED = ScreenFilters(
    submitted_from=date(1996, 1, 1),
    submitted_to=date(1999, 12, 31),
    partner=("No Partner", "Other", "NATION_3", "NATION_7"),
    utm_source=("BUILDING", "MACHINERY"),
)
PLACES = ScreenFilters(
    county=("Unspecified", "NATION_3", "NATION_7"), utm_campaign=("NATION_3", "NATION_7", "NATION_11"),
    utm_medium=("1-URGENT", "2-HIGH", "5-LOW"),
)
PARTNER_A = ScreenFilters(partner=("NATION_3",))
PARTNER_B = ScreenFilters(referrer_code=("ref5",))
ALL = ScreenFilters()
AS_OF = date(2001, 6, 15)

STUDENTS = "has_student"

sc, ec = screen_cards, event_cards

SCREEN_CARDS: dict[str, Callable[[Catalog], DataFrame]] = {
    "QP01_common_expenses": lambda c: sc.common_expenses(c).drop("screeners"),
    "QP01_common_expenses_filtered": lambda c: sc.common_expenses(c, FILTERED).drop("screeners"),
    "QP02_income_streams": lambda c: sc.income_streams(c).drop("screeners"),
    "QP03_current_benefits": lambda c: sc.current_benefits(c),
    "QP03_current_benefits_filtered": lambda c: sc.current_benefits(c, FILTERED),
    "QP04_qualified_benefits": lambda c: sc.qualified_benefits(c),
    "QP05_top_counties": lambda c: sc.top_counties(c),
    "QP06_top_partners": lambda c: sc.top_partners(c),
    "QP07_income_distribution": lambda c: sc.income_distribution(c),
    "QP07_income_distribution_filtered": lambda c: sc.income_distribution(c, FILTERED),
    "QP08_assets_distribution": lambda c: sc.assets_distribution(c),
    "QP09_head_ages": lambda c: sc.head_ages(c),
    "QP09_head_ages_filtered": lambda c: sc.head_ages(c, FILTERED),
    "QP10_member_ages": lambda c: sc.member_ages(c),
    "QP10_member_ages_filtered": lambda c: sc.member_ages(c, PLACES),
    "QP11_household_sizes": lambda c: sc.household_sizes(c),
    "QP12_household_languages": lambda c: sc.household_languages(c).drop("n"),
    "QP13_immediate_needs": lambda c: sc.immediate_needs(c),
    "QP14_disabled_share": lambda c: sc.disabled_share(c),
    "QP15_young_adult_share": lambda c: sc.young_adult_share(c),
    "QP16_monthly_active_users": lambda c: sc.monthly_active_users(c, ["co", "nc", "tx"]),
    "QP17_completed_screeners": lambda c: sc.completed_screeners(c),
    "QP17_completed_screeners_filtered": lambda c: sc.completed_screeners(c, PLACES),
    "QP18_already_had_benefits": lambda c: sc.already_had_benefits(c),
    "QP18_qualified_share": lambda c: sc.qualified_share(c),
    "QP18_qualified_tax_share": lambda c: sc.qualified_tax_share(c),
    "QP19_median_annual_benefits": lambda c: sc.median_annual_benefits(c),
    "QP19_median_monthly_benefits": lambda c: sc.median_monthly_benefits(c),
    "QP19_median_annual_tax_credits": lambda c: sc.median_annual_tax_credits(c),
    "QP20_total_individuals": lambda c: sc.total_individuals(c),
    "QP20_total_all_benefits": lambda c: sc.total_all_benefits(c),
    "QP20_total_benefits": lambda c: sc.total_benefits(c),
    "QP20_total_tax_credits": lambda c: sc.total_tax_credits(c),
    "QP21_daily_screeners": lambda c: sc.daily_screeners(c),
    "QP21_last_week_screeners": lambda c: sc.daily_screeners(c, as_of=AS_OF),
    "QP22_median_household_size": lambda c: sc.median_household_size(c),
    "QP22_median_household_assets": lambda c: sc.median_household_assets(c),
    "QP22_median_annual_income": lambda c: sc.median_annual_income(c),
    "QP22_median_monthly_income": lambda c: sc.median_monthly_income(c),
    "QP22_median_monthly_expenses": lambda c: sc.median_monthly_expenses(c),
    "QP22_medians": lambda c: sc.median_numbers(c),
    "QP23_partner_values": lambda c: sc.partner_values(c),
    **{
        f"QP23_{col}_values": lambda c, col=col: sc.column_values(c, col)
        for col in ("county", "utm_campaign", "utm_medium", "utm_source")
    },
    "QP24_homeowners": lambda c: sc.completed_screeners(c, where=sc.OWNERS),
    "QP24_homeowners_qualified": lambda c: sc.qualified_share(c, where=sc.OWNERS),
    "QP24_renters": lambda c: sc.completed_screeners(c, where=sc.RENTERS),
    "QP24_renters_qualified": lambda c: sc.qualified_share(c, where=sc.RENTERS),
    "QP25_homeowner_daily": lambda c: sc.daily_screeners(c, where=sc.OWNERS),
    "QP25_renter_daily": lambda c: sc.daily_screeners(c, where=sc.RENTERS),
    **{
        f"QP26_{name}_{kind}": lambda c, who=who, kind=kind: sc.top_providers(c, ALL, who, kind)
        for name, who in (("homeowner", sc.OWNERS), ("renter", sc.RENTERS))
        for kind in ("electric_provider", "gas_heat_provider")
    },
    **{
        f"QP27_{name}_{flag}": lambda c, who=who, flag=flag: sc.yes_no(c, ALL, who, flag)
        for name, who, flags in (
            (
                "homeowner",
                sc.OWNERS,
                "electricity_is_disconnected has_past_due_energy_bills has_old_car needs_stove needs_water_heater "
                "needs_hvac",
            ),
            ("renter", sc.RENTERS, "electricity_is_disconnected has_past_due_energy_bills has_old_car"),
        )
        for flag in flags.split()
    },
    "QP28_respondents": lambda c: sc.completed_screeners(c, PARTNER_A),
    "QP28_total_benefits": lambda c: sc.total_benefits(c, PARTNER_A),
    "QP28_total_tax_credits": lambda c: sc.total_tax_credits(c, PARTNER_A),
    "QP28_total_value": lambda c: sc.total_all_benefits(c, PARTNER_A),
    "QP28_highest_value": lambda c: sc.highest_household_value(c, PARTNER_A),
    "QP28_lowest_value": lambda c: sc.lowest_household_value(c, PARTNER_A),
    "QP28_median_value": lambda c: sc.median_household_value(c, PARTNER_A),
    "QP28_value_distribution": lambda c: sc.household_value_distribution(c, PARTNER_A),
    "QP28_monthly": lambda c: sc.monthly_screeners(c, PARTNER_A),
    "QP28_qualified_benefits": lambda c: sc.qualified_benefits(c, PARTNER_A),
    "QP29_completed": lambda c: sc.completed_screeners(c, PARTNER_B),
    "QP29_total_value": lambda c: sc.total_all_benefits(c, PARTNER_B),
    "QP29_median_annual": lambda c: sc.median_household_value(c, PARTNER_B),
    "QP29_median_monthly": lambda c: sc.median_monthly_household_value(c, PARTNER_B),
    "QP29_average_programs": lambda c: sc.average_programs(c, PARTNER_B),
    "QP29_students": lambda c: sc.completed_screeners(c, PARTNER_B, STUDENTS),
    "QP29_students_total_value": lambda c: sc.total_all_benefits(c, PARTNER_B, STUDENTS),
    "QP29_students_median_annual": lambda c: sc.median_household_value(c, PARTNER_B, STUDENTS),
    "QP29_students_average_programs": lambda c: sc.average_programs(c, PARTNER_B, STUDENTS),
    "QP29_monthly": lambda c: sc.monthly_screeners(c, PARTNER_B),
    "QP29_qualified_benefits": lambda c: sc.qualified_benefits(c, PARTNER_B),
    "QP29_immediate_needs": lambda c: sc.immediate_needs(c, PARTNER_B),
}

# The cards that take filters, over the screens of some counties, campaigns and media.
PLACES_CARDS: dict[str, Callable[[Catalog, ScreenFilters], DataFrame]] = {
    "QP01_common_expenses": lambda c, f: sc.common_expenses(c, f).drop("screeners"),
    "QP02_income_streams": lambda c, f: sc.income_streams(c, f).drop("screeners"),
    "QP03_current_benefits": sc.current_benefits,
    "QP04_qualified_benefits": sc.qualified_benefits,
    "QP05_top_counties": sc.top_counties,
    "QP06_top_partners": sc.top_partners,
    "QP07_income_distribution": sc.income_distribution,
    "QP08_assets_distribution": sc.assets_distribution,
    "QP09_head_ages": sc.head_ages,
    "QP11_household_sizes": sc.household_sizes,
    "QP12_household_languages": lambda c, f: sc.household_languages(c, f).drop("n"),
    "QP13_immediate_needs": sc.immediate_needs,
    "QP14_disabled_share": sc.disabled_share,
    "QP15_young_adult_share": sc.young_adult_share,
    "QP18_already_had_benefits": sc.already_had_benefits,
    "QP18_qualified_share": sc.qualified_share,
    "QP18_qualified_tax_share": sc.qualified_tax_share,
    "QP19_median_annual_benefits": sc.median_annual_benefits,
    "QP19_median_annual_tax_credits": sc.median_annual_tax_credits,
    "QP20_total_individuals": sc.total_individuals,
    "QP20_total_all_benefits": sc.total_all_benefits,
    "QP20_total_benefits": sc.total_benefits,
    "QP20_total_tax_credits": sc.total_tax_credits,
    "QP21_daily_screeners": sc.daily_screeners,
    "QP22_medians": sc.median_numbers,
    "QP24_homeowners": lambda c, f: sc.completed_screeners(c, f, sc.OWNERS),
    "QP24_renters_qualified": lambda c, f: sc.qualified_share(c, f, sc.RENTERS),
    "QP25_homeowner_daily": lambda c, f: sc.daily_screeners(c, f, sc.OWNERS),
}

# Every card of the relational dashboards as one tenant sees it; visitors (QP16) belong to no tenant.
TENANT_SCREEN_CARDS = [name for name in SCREEN_CARDS if not name.startswith("QP16")]
TENANT_ID = 3
# The partners of QP28 and QP29 belong to these tenants.
PARTNER_TENANTS = {"QP28": 4, "QP29": 1}


def card_tenant(name: str) -> int:
    return PARTNER_TENANTS.get(name[:4], TENANT_ID)


GLOBAL = EventScope(epoch=date(2024, 1, 8))
TENANT = EventScope(epoch=date(2024, 1, 8), tenant_states=("co",), start=date(2024, 1, 10), end=date(2024, 1, 25))

# Card -> query id; each runs under the scopes named below.
EVENT_CARDS: dict[str, Callable[..., DataFrame]] = {
    "QE01_conversion_funnel": ec.conversion_funnel,
    "QE02_sessions_per_screener": ec.sessions_per_screener,
    "QE03_step_funnel": ec.step_funnel,
    "QE04_energy_step_funnel": ec.energy_step_funnel,
    "QE05_errors_by_step": ec.errors_by_step,
    "QE06_back_navigation": ec.back_navigation_by_step,
    "QE07_results_revisits": ec.results_revisits,
    "QE08_results_viewed": ec.results_viewed,
    "QE09_eligible_share": ec.eligible_share,
    "QE10_results_error_rate": ec.results_error_rate,
    "QE11_share_funnel_popup": ec.share_funnel_popup,
    "QE12_share_funnel_footer": ec.share_funnel_footer,
    "QE13_shares_by_channel": ec.shares_by_channel,
    "QE14_save_funnel": ec.save_funnel,
    "QE15_saves_by_channel": ec.saves_by_channel,
    "QE19_most_shown_by_state": lambda c, s: ec.most_shown_programs(c, s, by_state=True),
    "QE19_detail_rate_by_state": lambda c, s: ec.program_detail_rate(c, s, by_state=True),
    "QE19_conversion_by_state": lambda c, s: ec.program_conversion(c, s, by_state=True),
    "QE19_detail_rate_by_state_any": lambda c, s: ec.program_detail_rate(c, s, by_state=True, least=1),
    "QE19_conversion_by_state_any": lambda c, s: ec.program_conversion(c, s, by_state=True, least=1),
    "QE20_navigators_by_state": lambda c, s: ec.navigator_engagement(c, s, by_state=True),
    "QE21_resource_engagement": ec.resource_engagement,
    "QE22_resources_tab": ec.resources_tab_engagement,
    "QE23_scroll_depth": ec.scroll_depth,
    "QE24_help_by_topic": ec.help_by_topic,
    "QE25_household_member_actions": ec.household_member_actions,
    "QE26_income_source_actions": ec.income_source_actions,
    "QE27_confirmation_edits": ec.confirmation_edits,
    "QE28_signup_consent": ec.signup_consent,
    "QE29_filter_usage": ec.filter_usage,
    "QE30_nps_distribution": lambda c, s: ec.nps_distribution(c, s).drop("category"),
    "QE31_chrome_navigation": ec.chrome_navigation,
    "QE31_social_clicks": ec.social_clicks,
    "QE31_footer_feedback_share": ec.footer_feedback_share,
    "QE32_disclaimer_links": ec.disclaimer_link_rates,
    "QE33_additional_resources_edits": ec.additional_resources_edits,
    "QE34_document_downloads": ec.document_downloads,
    "QE35_more_help_resources": ec.more_help_resources,
    "QE36_back_to_screener": ec.back_to_screener,
    "QE37_nps_engagement": ec.nps_engagement,
    "QE38_get_help_clicks": ec.get_help_clicks,
    "QE39_average_help_clicks": ec.average_help_clicks,
    "QE39_average_tab_opens": ec.average_tab_opens,
    "QE39_average_edits": ec.average_edits,
    "QE39_average_filter_uses": ec.average_filter_uses,
    "QE40_errors_detail": ec.errors_detail,
    "QE41_language_switches": ec.language_switches,
}

TENANT_CARDS: dict[str, Callable[..., DataFrame]] = {
    # Without those of which the sample has no rows for one state.
    **{n: fn for n, fn in EVENT_CARDS.items() if n not in ("QE19_detail_rate_by_state", "QE19_conversion_by_state", "QE26_income_source_actions")},
    "QE16_most_shown": ec.most_shown_programs,
    "QE17_detail_rate": ec.program_detail_rate,
    "QE18_conversion": ec.program_conversion,
    "QE20_navigators": ec.navigator_engagement,
}

OTHER: dict[str, Callable[[Catalog], DataFrame]] = {
    "V7_data_tenant": lambda c: firstgen.data_tenant(c, "wl_nc_5_ro"),
    "K1_tenant_scope": lambda c: scope_to_tenant(c["mart_householdmembers"], tenant_from_setting(" 3 ")),
    "K1_no_tenant": lambda c: scope_to_tenant(c["mart_householdmembers"], tenant_from_setting("")),
    "D1_null_counts": lambda c: checks.null_counts(
        c["mart_householdmembers"], ["id", "screener_id", "age", "disabled", "visually_impaired"]
    ),
    "D2_duplicate_ids": lambda c: checks.duplicate_keys(
        c.source("screener_programeligibilitysnapshot"), ["eligibility_snapshot_id"]
    ),
    "D3_duplicate_combinations": lambda c: checks.duplicate_keys(
        c.source("screener_programeligibilitysnapshot"), ["eligibility_snapshot_id", "name_abbreviated"]
    ),
    "D4_unaccepted_frequencies": lambda c: checks.unaccepted_values(
        c["mart_income"], "frequency", INCOME_FREQUENCIES
    ),
    "D5_orphan_programs": lambda c: checks.orphan_keys(
        c.source("screener_programeligibilitysnapshot"), "name_abbreviated", c.source("programs_program"),
        "name_abbreviated",
    ),
    "D0_rule_report": lambda c: rule_report(CatalogTables(c), RULES),
    "QE21_resource_engagement_bitmaps": lambda c: distinct_marts.resource_engagement(c, GLOBAL),
    "QE21_resource_engagement_bitmaps_tenant": lambda c: distinct_marts.resource_engagement(c, TENANT),
    "QP16_monthly_active_users_bitmaps": lambda c: distinct_marts.monthly_active_users(c, ["co", "nc", "tx"]),
    "M02_window_visitors_bitmaps": lambda c: distinct_marts.window_visitors(c, date(2024, 1, 10), date(2024, 1, 25)),
    "S3_pruned_event_days": lambda c: c.source("events")
    .where(F.col("event_date") >= c.options.analytics_epoch)
    .groupBy("event_date", "event_name")
    .agg(F.count(F.lit(1)).alias("n_events")),
}


def plain_types(df: DataFrame) -> DataFrame:
    """Decimals as double (whole ones as bigint), the types results are compared in."""
    out = []
    for f in df.schema:
        name = f"`{f.name}`"
        if isinstance(f.dataType, T.DecimalType):
            name = f"cast({name} as {'bigint' if f.dataType.scale == 0 else 'double'}) as {name}"
        out.append(name)
    return df.selectExpr(*out)


def _dataset(name: str) -> Query:
    """A dataset computed from the raw tables; only event rows that its plan reads twice are stored between."""
    return lambda spark, sf_dir: plain_types(
        stored_sample_catalog(tune(spark), sf_dir, SAMPLE_OPTIONS, ("rows",))[name]
    )


def _card(fn: Callable[[Catalog], DataFrame]) -> Query:
    """A card over stored marts."""
    return lambda spark, sf_dir: plain_types(fn(stored_sample_catalog(tune(spark), sf_dir, SAMPLE_OPTIONS)))


def session_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One view as three sessions see it: with a tenant, with a blank one, and with none set."""
    declare_tenant(tune(spark))
    register_tenant_views(stored_sample_catalog(spark, sf_dir, SAMPLE_OPTIONS), ["mart_householdmembers", "mart_screener_data"])
    seen = []
    for setting, value in (("set", f" {TENANT_ID} "), ("blank", "  "), ("unset", None)):
        set_tenant(spark, value)
        rows = spark.sql("SELECT * FROM mart_householdmembers WHERE screener_id IN (SELECT id FROM mart_screener_data)")
        seen.append(rows.select(F.lit(setting).alias("setting"), "*"))
    return plain_types(seen[0].unionByName(seen[1]).unionByName(seen[2]))


#: A day whose events come late, within sessions that have events on other days.
LATE_DAY = "20240117"
DAY_TABLES = ("ga_form_rows", "ga_screening_days", "stg_ga_screener_form_funnel", "mart_screener_form_funnel")


def changed_days(spark: SparkSession, sf_dir: str, late: str = LATE_DAY) -> DayTables:
    """Day tables that were built without a day and refreshed when its events came."""
    whole = sample_catalog(tune(spark), sf_dir, SAMPLE_OPTIONS)
    events = whole.source("events")
    days = [r[0] for r in events.select("event_date").distinct().toLocalIterator()]  # one row per day
    early = {**whole.sources, "events": lambda: events.where(F.col("event_date") != late)}
    tables = DayTables(spark, early, SAMPLE_OPTIONS, store=scratch_folder(spark, sf_dir, "days"), kept=DAY_TABLES)
    tables.refresh_days([day for day in days if day != late])
    tables.sources = whole.sources
    tables.refresh_days([late])
    return tables


def refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(table_name, n_rows) of some marts after a refresh, several at once, each held against its rules."""
    names = ["mart_screener_data", "mart_householdmembers", "mart_qualified_benefits", "mart_referrer_codes"]
    c = sample_catalog(tune(spark), sf_dir, SAMPLE_OPTIONS)
    refresh(c, names, scratch_folder(spark, sf_dir, "refresh"), workers=4, audit=build.published_by_rules(c))
    counts = [c[name].agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for name in names]
    return counts[0].union(counts[1]).union(counts[2]).union(counts[3])


def backfilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_date, n_events) of a store that was filled in two runs, the second with days that the first one had."""
    events = sample_catalog(tune(spark), sf_dir, SAMPLE_OPTIONS).source("events").where("event_date < '20240110'")
    folder = scratch_folder(spark, sf_dir, "backfill")
    for last in ("20240106", "20240110"):
        copy_days(spark, events.where(F.col("event_date") < last), f"{folder}/events", f"{folder}/manifest")
    stored = spark.read.schema(events.schema).parquet(f"{folder}/events")
    return stored.groupBy("event_date").agg(F.count(F.lit(1)).alias("n_events"))


#: Bytes of orders and lines, as given, that make one bucket.
BUCKET_BYTES = 2_500_000


def bucket_count(n_bytes: int) -> int:
    """Buckets that stay small enough to sort in memory; from 200 on joins to wider exchanges leave them where they are."""
    return max(8, -(-n_bytes // BUCKET_BYTES))


def bucketed(spark: SparkSession, sf_dir: str) -> BucketedCatalog:
    """The sample's screens and what hangs on them, stored in buckets by screen."""
    whole = sample_catalog(tune(spark), sf_dir, SAMPLE_OPTIONS)
    folder = scratch_folder(spark, sf_dir, "buckets")
    given = [spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet") for name in ("orders", "lineitem")]
    n_bytes = sum(p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength() for p in given)
    return BucketedCatalog(spark, whole.sources, SAMPLE_OPTIONS, store=folder, names=f"b{abs(hash(folder)) % 10**9}", buckets=bucket_count(n_bytes))


STORED: dict[str, Query] = {
    "K1_session_view": session_view,
    "S5_changed_days": lambda spark, sf_dir: plain_types(changed_days(spark, sf_dir)["mart_screener_form_funnel"]),
    "S5_changed_days_screenings": lambda spark, sf_dir: plain_types(changed_days(spark, sf_dir)["mart_screener_screening_funnel"]),
    "S6_refreshed_tables": refreshed,
    "S7_backfilled_days": backfilled,
    **{
        f"{key}_bucketed": lambda spark, sf_dir, name=DATASETS[key]: plain_types(bucketed(spark, sf_dir)[name])
        for key in ("P14", "P17", "P25")
    },
}


def queries() -> dict[str, Query]:
    assert build.MODULES  # the modules register the datasets
    out = {f"{key}_{name}": _dataset(name) for key, name in DATASETS.items()}
    out.update({name: _card(fn) for name, fn in SCREEN_CARDS.items()})
    for name in TENANT_SCREEN_CARDS:
        out[f"{name}_tenant"] = _card(lambda c, name=name: SCREEN_CARDS[name](TenantCatalog(c, card_tenant(name))))
    out.update({f"{name}_places": _card(lambda c, fn=fn: fn(c, PLACES)) for name, fn in PLACES_CARDS.items()})
    out.update({name: _card(lambda c, fn=fn: fn(c, GLOBAL)) for name, fn in EVENT_CARDS.items()})
    out.update({f"{name}_tenant": _card(lambda c, fn=fn: fn(c, TENANT)) for name, fn in TENANT_CARDS.items()})
    out.update({name: _card(fn) for name, fn in OTHER.items()})
    out.update(STORED)
    return out
