"""One check query per registered query."""

from __future__ import annotations

import re

import oracle.events  # noqa: F401  (defines the event SELECTs)
import oracle.relational  # noqa: F401  (defines the relational SELECTs)
from oracle.base import EPOCH_DATE, case_map, compose, median, pct, ratio, share
from oracle.relational import NEEDS
from screenmart.sources.sample import REPEATED_EVENT

VIEW_NAMES = {"data": "wide_data"}

FILTER = (
    "submission_date >= DATE '1996-01-01' AND submission_date <= DATE '1999-12-31' "
    "AND partner IN ('No Partner', 'Other', 'NATION_3', 'NATION_7') AND utm_source IN ('BUILDING', 'MACHINERY')"
)
PLACES = (
    "county IN ('Unspecified', 'NATION_3', 'NATION_7') AND utm_campaign IN ('NATION_3', 'NATION_7', 'NATION_11') "
    "AND utm_medium IN ('1-URGENT', '2-HIGH', '5-LOW')"
)
A, B = "partner = 'NATION_3'", "referrer_code = 'ref5'"
DATA = "mart_screener_data"
OTHER, TAX = "non_tax_credit_benefits_annual", "tax_credits_annual"
VALUE = f"({OTHER} + {TAX})"


def screens(select: str, where: str = "TRUE", tail: str = "") -> str:
    return f"SELECT {select} FROM {DATA} WHERE {where} {tail}"


def total(where: str = "TRUE") -> str:
    return f"(SELECT count(*) FROM {DATA} WHERE {where})"


def passing(where: str) -> str:
    return f"(SELECT id FROM {DATA} WHERE {where})"


def streams(mart: str, labels: dict[str, str], hourly: bool, where: str = "TRUE") -> str:
    hours = "WHEN 'hourly' THEN a * CAST(coalesce(hours_worked, 0) AS DOUBLE) * CAST(4.35 AS DOUBLE)" if hourly else ""
    return f"""
SELECT {case_map("type", labels, "type")} AS type, {share("count(DISTINCT screener_id)", total(where))} AS
  share_of_screeners, {median("m")} AS median_amount
FROM (SELECT type, screener_id, CASE frequency WHEN 'monthly' THEN a WHEN 'weekly' THEN a * CAST(4.35 AS DOUBLE)
    WHEN 'biweekly' THEN a * CAST(2.175 AS DOUBLE) WHEN 'semimonthly' THEN a * 2
    WHEN 'yearly' THEN a / CAST(12 AS DOUBLE) {hours} ELSE a END AS m
  FROM (SELECT *, CAST(amount AS DOUBLE) AS a FROM {mart}) r
  WHERE amount > 0 AND screener_id IN {passing(where)}) x
GROUP BY type"""


def benefit_table(mart: str, where: str = "TRUE") -> str:
    return f"""
SELECT max(benefit_display_name) AS benefit, count(DISTINCT screen_id) AS screeners,
  {share("count(DISTINCT screen_id)", total(where))} AS share_of_screeners
FROM {mart} WHERE screen_id IN {passing(where)} GROUP BY benefit_name"""


def with_total(column: str, keep: str) -> str:
    return f"""
SELECT 0 AS sort_order, {column} AS name, count(*) AS screeners, {share("count(*)", total())} AS share_of_screeners
FROM {DATA} WHERE {keep} GROUP BY {column}
UNION ALL SELECT 1, 'Total', count(*), CASE WHEN count(*) <> 0 THEN CAST(1 AS DOUBLE) END FROM {DATA}"""


def distribution(source: str, band: str, order: str) -> str:
    return f"""
SELECT {band} AS band, {order} AS sort_order, {share("count(*)", f"(SELECT count(*) FROM {source})")} AS share_of_total
FROM {source} GROUP BY 1, 2"""


def bounds(column: str, bands: list[tuple[int, str]], last: str) -> tuple[str, str]:
    label = " ".join(f"WHEN {column} < {b} THEN '{name}'" for b, name in bands)
    order = " ".join(f"WHEN {column} < {b} THEN {i}" for i, (b, _) in enumerate(bands, start=1))
    return f"CASE {label} ELSE '{last}' END", f"CASE {order} ELSE {len(bands) + 1} END"


def ages(first: list[tuple[str, str]]) -> tuple[str, str]:
    bands = [*first, ("19-24", "age BETWEEN 19 AND 24"), ("25-44", "age BETWEEN 25 AND 44"),
             ("45-64", "age BETWEEN 45 AND 64"), ("65+", "age >= 65")]
    label = " ".join(f"WHEN {cond} THEN '{name}'" for name, cond in bands)
    order = " ".join(f"WHEN {cond} THEN {i}" for i, (_, cond) in enumerate(bands, start=1))
    return f"CASE {label} END", f"CASE {order} END"


def members(where: str = "TRUE", more: str = "TRUE") -> str:
    return f"(SELECT * FROM mart_householdmembers WHERE age IS NOT NULL AND {more} AND screener_id IN {passing(where)}) x"


EXPENSES = {"rent": "Rent", "mortgage": "Mortgage", "childCare": "Child Care", "medical": "Medical"}
INCOMES = {"wages": "Wages", "selfEmployment": "Self Employment", "SSI": "SSI", "pension": "Pension"}
INCOME_BANDS = [(15000, "$0-15K"), (30000, "$15-30K"), (45000, "$30-45K"), (60000, "$45-60K"), (75000, "$60-75K"),
                (100000, "$75-100K")]
ASSET_BANDS = [(1000, "$0-1K"), (2000, "$1-2K"), (5000, "$2-5K"), (10000, "$5-10K"), (50000, "$10-50K")]


def needs(where: str = "TRUE") -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{label}' AS need, count(*) FILTER (WHERE {n}) AS screeners FROM {DATA} WHERE {where}"
        for n, label in NEEDS
    )
    return f"SELECT need, screeners, {share('screeners', total(where))} AS share_of_screeners FROM ({parts}) x WHERE screeners > 0"


def pct_of(cond: str, where: str = "TRUE") -> str:
    return screens(f"{share(f'count(*) FILTER (WHERE {cond})', 'count(*)')} AS pct", where)


def med(value: str, where: str = "TRUE") -> str:
    return screens(f"{median(value)} AS median", where)


def summed(value: str, where: str = "TRUE") -> str:
    return screens(f"CAST(coalesce(sum({value}), 0) AS DOUBLE) AS total", where)


def by_day(where: str = "TRUE") -> str:
    return screens("submission_date, count(*) AS screeners", where, "GROUP BY 1")


def by_month(where: str) -> str:
    return screens("CAST(date_trunc('month', submission_date) AS DATE) AS month, count(*) AS screeners", where, "GROUP BY 1")


def providers(who: str, kind: str) -> str:
    return (
        f"SELECT coalesce({kind}_name, {kind}) AS provider, count(*) AS screeners FROM {DATA} "
        f"WHERE {who} AND {kind} IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"
    )


def yes_no(who: str, flag: str) -> str:
    return screens(
        f"CASE WHEN {flag} THEN 'Yes' ELSE 'No' END AS answer, count(*) AS screeners",
        f"{who} AND {flag} IS NOT NULL",
        "GROUP BY 1",
    )


def screen_cards() -> dict[str, str]:
    income = f"(SELECT * FROM {DATA} WHERE monthly_income IS NOT NULL) x"
    income_f = f"(SELECT * FROM {DATA} WHERE monthly_income IS NOT NULL AND {FILTER}) x"
    head = "relationship = 'headOfHousehold'"
    buckets = bounds("v", [(5000, "$1-$4,999"), (10000, "$5,000-$9,999"), (20000, "$10,000-$19,999"),
                           (40000, "$20,000-$39,999")], "$40,000+")[0].replace("CASE", "CASE WHEN v = 0 THEN '$0'", 1)
    out = {
        "QP01_common_expenses": streams("mart_screener_expense", EXPENSES, False),
        "QP01_common_expenses_filtered": streams("mart_screener_expense", EXPENSES, False, FILTER),
        "QP02_income_streams": streams("mart_income", INCOMES, True),
        "QP03_current_benefits": benefit_table("mart_current_benefits"),
        "QP03_current_benefits_filtered": benefit_table("mart_current_benefits", FILTER),
        "QP04_qualified_benefits": benefit_table("mart_qualified_benefits"),
        "QP05_top_counties": with_total("county", "county IS NOT NULL AND county <> ''"),
        "QP06_top_partners": with_total("partner", "TRUE"),
        "QP07_income_distribution": distribution(income, *bounds("monthly_income * 12", INCOME_BANDS, "$100K+")),
        "QP07_income_distribution_filtered": distribution(
            income_f, *bounds("monthly_income * 12", INCOME_BANDS, "$100K+")
        ),
        "QP08_assets_distribution": distribution(
            f"(SELECT * FROM {DATA} WHERE household_assets IS NOT NULL) x",
            *bounds("household_assets", ASSET_BANDS, "$50K+"),
        ),
        "QP09_head_ages": distribution(members("TRUE", head), *ages([("0-18", "age BETWEEN 0 AND 18")])),
        "QP09_head_ages_filtered": distribution(members(FILTER, head), *ages([("0-18", "age BETWEEN 0 AND 18")])),
        "QP10_member_ages_filtered": distribution(
            members(PLACES), *ages([("<5", "age < 5"), ("5-18", "age BETWEEN 5 AND 18")])
        ),
        "QP10_member_ages": distribution(members(), *ages([("<5", "age < 5"), ("5-18", "age BETWEEN 5 AND 18")])),
        "QP11_household_sizes": distribution(
            DATA,
            "CASE WHEN household_size >= 8 THEN '8+' ELSE CAST(household_size AS VARCHAR) END",
            "CASE WHEN household_size >= 8 THEN 8 ELSE household_size END",
        ),
        "QP12_household_languages": screens(
            f"request_language_code AS language, {share('count(*)', total())} AS share_of_total", tail="GROUP BY 1"
        ),
        "QP13_immediate_needs": needs(),
        "QP14_disabled_share": f"""
SELECT {share("count(*) FILTER (WHERE disabled IS TRUE OR visually_impaired IS TRUE OR long_term_disability IS TRUE)", "count(*)")} AS pct
FROM mart_householdmembers
WHERE disabled IS NOT NULL OR visually_impaired IS NOT NULL OR long_term_disability IS NOT NULL""",
        "QP15_young_adult_share": f"""
SELECT {share("count(*) FILTER (WHERE age BETWEEN 19 AND 24)", "count(*)")} AS pct
FROM mart_householdmembers WHERE age IS NOT NULL""",
        "QP16_monthly_active_users": """
SELECT CAST(date_trunc('month', event_date_parsed) AS DATE) AS month, count(DISTINCT user_pseudo_id) AS active_users
FROM int_ga4_page_views WHERE state_code IN ('co', 'nc', 'tx') GROUP BY 1""",
        "QP17_completed_screeners": screens("count(*) AS screeners"),
        "QP17_completed_screeners_filtered": screens("count(*) AS screeners", PLACES),
        "QP18_already_had_benefits": pct_of("has_benefits = 'true'"),
        "QP18_qualified_share": pct_of(f"{OTHER} > 0"),
        "QP18_qualified_tax_share": pct_of(f"{TAX} > 0"),
        "QP19_median_annual_benefits": med(OTHER, f"{OTHER} > 0"),
        "QP19_median_monthly_benefits": med(f"{OTHER} / CAST(12 AS DOUBLE)", f"{OTHER} > 0"),
        "QP19_median_annual_tax_credits": med(TAX, f"{TAX} > 0"),
        "QP20_total_individuals": screens("CAST(coalesce(sum(household_size), 0) AS BIGINT) AS total"),
        "QP20_total_all_benefits": summed(VALUE),
        "QP20_total_benefits": summed(OTHER),
        "QP20_total_tax_credits": summed(TAX),
        "QP21_daily_screeners": by_day(),
        "QP21_last_week_screeners": by_day("submission_date >= DATE '2001-06-15' - 6"),
        "QP22_median_household_size": med("household_size"),
        "QP22_median_household_assets": med("household_assets"),
        "QP22_median_annual_income": med("(monthly_income * 12)"),
        "QP22_median_monthly_income": med("monthly_income"),
        "QP22_median_monthly_expenses": med("monthly_expenses"),
        "QP22_medians": f"""SELECT {median("household_size")} AS household_size, {median("household_assets")} AS household_assets,
  {median("monthly_income * 12")} AS annual_income, {median("monthly_income")} AS monthly_income,
  {median("monthly_expenses")} AS monthly_expenses FROM {DATA}""",
        "QP23_partner_values": f"""
SELECT DISTINCT partner FROM {DATA} WHERE partner IS NOT NULL AND partner NOT IN
  (SELECT partner FROM mart_referrer_codes WHERE is_partner = FALSE AND partner IS NOT NULL)
UNION SELECT DISTINCT partner FROM mart_referrer_codes WHERE is_partner = TRUE AND partner IS NOT NULL""",
        "QP24_homeowners": screens("count(*) AS screeners", "is_home_owner"),
        "QP24_homeowners_qualified": pct_of(f"{OTHER} > 0", "is_home_owner"),
        "QP24_renters": screens("count(*) AS screeners", "is_renter"),
        "QP24_renters_qualified": pct_of(f"{OTHER} > 0", "is_renter"),
        "QP25_homeowner_daily": by_day("is_home_owner"),
        "QP25_renter_daily": by_day("is_renter"),
        "QP28_respondents": screens("count(*) AS screeners", A),
        "QP28_total_benefits": summed(OTHER, A),
        "QP28_total_tax_credits": summed(TAX, A),
        "QP28_total_value": summed(VALUE, A),
        "QP28_highest_value": screens(f"CAST(coalesce(max({VALUE}), 0) AS DOUBLE) AS highest", A),
        "QP28_lowest_value": screens(f"CAST(coalesce(min({VALUE}), 0) AS DOUBLE) AS lowest", f"{A} AND {VALUE} > 0"),
        "QP28_median_value": med(VALUE, f"{A} AND {VALUE} > 0"),
        "QP28_value_distribution": f"""
SELECT {buckets} AS bucket, count(*) AS households FROM (SELECT {VALUE} AS v FROM {DATA} WHERE {A}) x GROUP BY 1""",
        "QP28_monthly": by_month(A),
        "QP28_qualified_benefits": benefit_table("mart_qualified_benefits", A),
        "QP29_completed": screens("count(*) AS screeners", B),
        "QP29_total_value": summed(VALUE, B),
        "QP29_median_annual": med(VALUE, f"{B} AND {VALUE} > 0"),
        "QP29_median_monthly": med(f"({VALUE} / CAST(12 AS DOUBLE))", f"{B} AND {VALUE} > 0"),
        "QP29_average_programs": screens(
            f"{ratio('sum(programs_matched)', 'count(programs_matched)', 1)} AS avg_programs", B
        ),
        "QP29_students": screens("count(*) AS screeners", f"{B} AND has_student"),
        "QP29_students_total_value": summed(VALUE, f"{B} AND has_student"),
        "QP29_students_median_annual": med(VALUE, f"{B} AND has_student AND {VALUE} > 0"),
        "QP29_students_average_programs": screens(
            f"{ratio('sum(programs_matched)', 'count(programs_matched)', 1)} AS avg_programs", f"{B} AND has_student"
        ),
        "QP29_monthly": by_month(B),
        "QP29_qualified_benefits": benefit_table("mart_qualified_benefits", B),
        "QP29_immediate_needs": needs(B),
    }
    for column in ("county", "utm_campaign", "utm_medium", "utm_source"):
        out[f"QP23_{column}_values"] = screens(f"DISTINCT {column}", f"{column} IS NOT NULL AND {column} <> ''")
    for name, who in (("homeowner", "is_home_owner"), ("renter", "is_renter")):
        for kind in ("electric_provider", "gas_heat_provider"):
            out[f"QP26_{name}_{kind}"] = providers(who, kind)
        flags = ["electricity_is_disconnected", "has_past_due_energy_bills", "has_old_car"]
        if name == "homeowner":
            flags += ["needs_stove", "needs_water_heater", "needs_hvac"]
        for flag in flags:
            out[f"QP27_{name}_{flag}"] = yes_no(who, flag)
    return out


class Scope:
    """Predicates of one state scope and date window."""

    def __init__(self, tenant: str | None, window: str):
        known = f"screener_state IN ('{tenant}')" if tenant else "screener_state IN ('co','nc','tx','wa','il','ma')"
        or_null = known if tenant else f"({known} OR screener_state IS NULL)"
        self.window = window
        self.plain = f"{known} AND {window}"
        self.site = f"{or_null} AND {window}"
        self.flagged = self.site if tenant else f"NOT is_cesn AND {or_null} AND {window}"


WINDOW = f"event_date_parsed >= {EPOCH_DATE}"
GLOBAL = Scope(None, WINDOW)
TENANT = Scope(
    "co", f"{WINDOW} AND event_date_parsed >= DATE '2024-01-10' AND event_date_parsed <= DATE '2024-01-25'"
)

CHANNELS = {"email": "Email", "sms": "SMS", "whatsapp": "WhatsApp", "copy_link": "Copy Link"}
CAPS = (
    "replace(array_to_string(list_transform(string_split(replace({x}, '-', ' '), ' '), "
    "lambda w: upper(w[1]) || lower(w[2:])), ' '), '(u', '(U')"
)


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def zero(x: str) -> str:
    return f"coalesce({x}, 0)"


def cap(x: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN least({x}, CAST(100 AS DOUBLE)) END"


def funnel(ladder: str, sessions: str, entry: int) -> str:
    return f"""
SELECT screener_step_label, {pct("n", f"max(CASE WHEN funnel_rank = {entry} THEN n END) OVER ()")} AS pct_of_started,
  n AS sessions
FROM (SELECT r.funnel_rank, r.screener_step_label, count(DISTINCT s.session_key) AS n
  FROM (SELECT * FROM {ladder} WHERE funnel_rank IS NOT NULL) r
  LEFT JOIN ({sessions}) s ON s.furthest_step_rank >= r.funnel_rank GROUP BY 1, 2) x
QUALIFY n > 0"""


def step_rate(flag: str, where: str, more: str = "") -> str:
    n = f"count(*) FILTER (WHERE {flag})"
    return f"""
SELECT screener_step_label AS step, {pct(n, "count(*) FILTER (WHERE viewed)")} AS pct_of_viewers, {n} AS screenings{more}
FROM mart_screener_step_facts WHERE {where} GROUP BY 1 HAVING {n} > 0"""


def share_funnel(place: str, first: str, shown: str, s: Scope) -> str:
    def by(action: str) -> str:
        return (
            f"SELECT {big(f'''sum(CASE WHEN share_action = '{action}' THEN screenings_with_share ELSE 0 END)''')} "
            f"FROM mart_screener_shares WHERE {s.plain} AND share_location = '{place}'"
        )

    return (
        f"SELECT '{first}' AS funnel_step, {big(f'({shown})')} AS screenings UNION ALL SELECT 'Opened', ({by('open')}) "
        f"UNION ALL SELECT 'Sent', ({by('send')})"
    )


def event_cards(s: Scope) -> dict[str, str]:
    viewers = f"(SELECT count(*) FROM mart_screener_results_revisits WHERE {s.flagged})"
    revisits = f"mart_screener_results_revisits WHERE {s.flagged}"
    stages = "mart_screener_screening_funnel WHERE " + s.flagged
    tab = "metric = 'tab_open' AND dimension = 'additional_resources'"
    edit = "link_group = 'edit_nav' AND link_label = 'Additional Resources — Edit Step'"

    def kind(name: str) -> str:
        return big(f"sum(CASE WHEN interaction_type = '{name}' THEN screenings_with_interaction ELSE 0 END)")

    def programs(keys: str) -> str:
        return (
            f"(SELECT {keys}, max(program_name) AS program_name, {kind('shown')} AS shown, "
            f"{kind('more_info')} AS more_info, {kind('apply')} AS applied "
            f"FROM mart_screener_program_interactions WHERE {s.plain} GROUP BY {keys}) x"
        )

    suffix = "program_name || ' (' || upper(screener_state) || ')'"
    conversion = (
        f"shown, more_info, applied, {pct('more_info', 'shown')} AS shown_to_details, "
        f"{pct('applied', 'more_info')} AS details_to_applied, {pct('applied', 'shown')} AS shown_to_applied"
    )

    def navigators(keys: str, tenant: str) -> str:
        def contacts(m: str) -> str:
            return big(f"sum(CASE WHEN contact_method = '{m}' THEN total_engagements ELSE 0 END)") + f" AS {m}"

        shown = big("sum(CASE WHEN contact_method = '__shown__' THEN screenings_with_engagement ELSE 0 END)")
        return f"""
SELECT navigator, program, {tenant} shown, website, email, phone FROM (
  SELECT {keys}, max(navigator_name) AS navigator, max(program_name) AS program, {shown} AS shown,
    {contacts("website")}, {contacts("email")}, {contacts("phone")}
  FROM mart_screener_navigator_engagement WHERE {s.plain} GROUP BY {keys}) x
WHERE shown + website + email + phone > 0"""

    def seen(cond: str) -> str:
        return f"count(DISTINCT CASE WHEN {cond} THEN screener_uid END)"

    def chrome(group: str) -> str:
        n = f"(SELECT count(DISTINCT session_key) FROM mart_screener_step_facts WHERE {s.flagged})"
        return f"""
SELECT element, {cap(pct("count(DISTINCT session_key)", n))} AS pct_of_sessions,
  count(DISTINCT session_key) AS sessions
FROM mart_screener_footer_engagement WHERE {s.site} AND element_group = '{group}' GROUP BY 1"""

    def avg(mart: str, events: str, who: str, where: str, alias: str) -> str:
        return f"SELECT {ratio(f'sum({events})', f'sum({who})', 1)} AS {alias} FROM {mart} WHERE {where}"

    acted = f"mart_screener_section_engagement WHERE {s.plain} AND section = 'Household Members'"
    people = f"""(SELECT count(DISTINCT screener_uid) FROM (
  SELECT screener_uid FROM mart_screener_step_views_by_screening
  WHERE {s.plain} AND screener_step_name IN ('member-basics', 'household-members') AND viewed
  UNION SELECT screener_uid FROM {acted}) u)"""
    income = f"""(SELECT sum(member_pages_viewed) AS viewed, sum(member_pages_added_income) AS added,
  sum(member_pages_deleted_income) AS deleted FROM mart_screener_member_income WHERE {s.plain}
  HAVING sum(member_pages_viewed) > 0) x"""
    consent = f"""(SELECT sum(signups) AS signups, sum(sms_opt_ins) AS sms, sum(email_opt_ins) AS email
  FROM mart_screener_signup_consent WHERE {s.plain}) x"""
    disclaimer = f"""(SELECT count(DISTINCT session_key) FROM mart_screener_step_facts
  WHERE {s.plain} AND screener_step_name = 'disclaimer' AND viewed)"""
    confirm = f"""(SELECT count(DISTINCT session_key) FROM mart_screener_step_facts
  WHERE {s.flagged} AND screener_step_name = 'confirm-information' AND viewed)"""

    def one(n: str, name: str, capped: bool = True) -> str:
        rate = pct(f"({n})", viewers)
        return f"SELECT {cap(rate) if capped else rate} AS pct_of_results_viewers, {big(f'({n})')} AS {name}"

    def sum_of(column: str, mart: str, where: str) -> str:
        return f"SELECT coalesce(sum({column}), 0) FROM {mart} WHERE {where}"

    edits_n = sum_of("screenings", "mart_screener_link_clicks", f"{s.plain} AND {edit}")
    openers = f"(SELECT sum(distinct_screenings) FROM mart_screener_resource_engagement WHERE {s.flagged} AND {tab})"
    help_n = f"mart_screener_help WHERE {s.plain} AND metric = 'get_help_click'"
    return {
        "QE01_conversion_funnel": f"""
SELECT 'Screeners Created' AS funnel_step, count(*) AS screenings FROM {stages}
UNION ALL SELECT 'Saw Results', count(*) FILTER (WHERE saw_results) FROM {stages}
UNION ALL SELECT 'Viewed Details', count(*) FILTER (WHERE viewed_details) FROM {stages}
UNION ALL SELECT 'Clicked Apply', count(*) FILTER (WHERE applied) FROM {stages}""",
        "QE02_sessions_per_screener": f"""
SELECT CASE WHEN distinct_sessions >= 4 THEN '4+' ELSE CAST(distinct_sessions AS VARCHAR) END AS sessions,
  least(distinct_sessions, 4) AS sort_order,
  {pct("count(*)", f"(SELECT count(*) FROM {stages} AND distinct_sessions > 0)")} AS pct_of_screeners
FROM {stages} AND distinct_sessions > 0 GROUP BY 1, 2""",
        "QE03_step_funnel": funnel(
            "mart_screener_step_ladder", f"SELECT * FROM mart_screener_furthest_step WHERE {s.flagged}", 1
        ),
        "QE04_energy_step_funnel": funnel(
            "mart_screener_cesn_combined_ladder", f"SELECT * FROM mart_screener_cesn_funnel WHERE {s.window}", 0
        ),
        "QE05_errors_by_step": step_rate("errored", s.flagged, f", {big('sum(error_events)')} AS total_errors"),
        "QE06_back_navigation": step_rate("navigated_back", s.flagged),
        "QE07_results_revisits": f"""
SELECT CASE results_load_count WHEN 1 THEN '1 time' WHEN 2 THEN '2 times' ELSE '3+ times' END AS times_viewed,
  CAST(min(least(results_load_count, 3)) AS INT) AS sort_key, count(*) AS screenings FROM {revisits} GROUP BY 1""",
        "QE08_results_viewed": f"SELECT count(*) AS results_viewed FROM {revisits}",
        "QE09_eligible_share": "SELECT "
        + pct(
            f"greatest({viewers} - coalesce((SELECT sum(screenings_none_eligible) FROM "
            f"mart_screener_results_outcomes WHERE {s.flagged}), 0), 0)",
            viewers,
        )
        + " AS pct_eligible",
        "QE10_results_error_rate": f"""
SELECT {pct("coalesce(sum(screenings_results_error), 0)",
            "coalesce(sum(screenings_results_error), 0) + coalesce(sum(screenings_results_loaded), 0)")} AS error_rate
FROM mart_screener_results_outcomes WHERE {s.flagged}""",
        "QE11_share_funnel_popup": share_funnel("results_popup", "Shown (reached results)", f"SELECT {viewers}", s),
        "QE12_share_funnel_footer": share_funnel(
            "footer",
            "Shown (started screener)",
            f"SELECT sum(screenings_viewed_step) FROM mart_screener_form_funnel "
            f"WHERE {s.flagged} AND screener_step_name = '__form_start__'",
            s,
        ),
        "QE13_shares_by_channel": f"""
SELECT {case_map("share_channel", CHANNELS, "coalesce(share_channel, '(none)')")} AS channel,
  coalesce(share_provider, '(none)') AS provider, {big("sum(total_shares)")} AS total_shares
FROM mart_screener_shares WHERE {s.plain} AND share_action = 'send' GROUP BY 1, 2""",
        "QE14_save_funnel": f"""
SELECT 'Shown (reached results)' AS funnel_step, {big(viewers)} AS screenings
UNION ALL SELECT 'Opened Save Popup', {big("sum(screenings_shown_popup)")} FROM mart_screener_saves WHERE {s.plain}
UNION ALL SELECT 'Saved', {big("sum(screenings_with_save)")} FROM mart_screener_saves WHERE {s.plain}""",
        "QE15_saves_by_channel": f"""
SELECT {case_map("save_channel", CHANNELS, "coalesce(save_channel, '(none)')")} AS channel,
  {big("sum(total_saves)")} AS total_saves
FROM mart_screener_saves WHERE {s.plain} AND save_action = 'send' GROUP BY 1""",
        "QE16_most_shown": f"""
SELECT program, shown FROM (SELECT program_name AS program, shown, program_id FROM {programs("program_id")}
  WHERE shown > 0 ORDER BY shown DESC, program, program_id LIMIT 15) y""",
        "QE17_detail_rate": f"""
SELECT program, detail_rate FROM (SELECT program_name AS program, {pct("more_info", "shown")} AS detail_rate, program_id
  FROM {programs("program_id")} WHERE shown >= 5 ORDER BY detail_rate DESC, program, program_id LIMIT 15) y""",
        "QE18_conversion": f"SELECT program_name AS program, {conversion} FROM {programs('program_id')} WHERE shown >= 5",
        "QE19_most_shown_by_state": f"""
SELECT program, shown FROM (SELECT {suffix} AS program, shown, program_id FROM {programs("program_id, screener_state")}
  WHERE shown > 0 ORDER BY shown DESC, program, program_id LIMIT 15) y""",
        "QE19_detail_rate_by_state": f"""
SELECT program, detail_rate FROM (SELECT {suffix} AS program, {pct("more_info", "shown")} AS detail_rate, program_id
  FROM {programs("program_id, screener_state")} WHERE shown >= 20
  ORDER BY detail_rate DESC, program, program_id LIMIT 15) y""",
        "QE19_conversion_by_state": f"""
SELECT program_name AS program, upper(screener_state) AS white_label, {conversion}
FROM {programs("program_id, screener_state")} WHERE shown >= 20""",
        "QE20_navigators": navigators("program_id, navigator_id", ""),
        "QE20_navigators_by_state": navigators(
            "program_id, navigator_id, screener_state", "upper(screener_state) AS white_label,"
        ),
        "QE21_resource_engagement": f"""
SELECT * FROM (SELECT dimension AS resource, {seen("metric = 'resource_shown'")} AS shown,
    {seen("metric = 'resource_more_info'")} AS more_info,
    {seen("metric = 'resource_click' AND contact_method = 'website'")} AS website,
    {seen("metric = 'resource_click' AND contact_method = 'phone'")} AS phone
  FROM mart_screener_resource_engagement_by_screening
  WHERE {s.flagged} AND metric IN ('resource_shown', 'resource_more_info', 'resource_click') GROUP BY 1) x
WHERE shown + more_info + website + phone > 0 ORDER BY shown DESC, more_info DESC, resource LIMIT 20""",
        "QE22_resources_tab": f"""
SELECT {pct("count(DISTINCT screener_uid)", viewers)} AS pct_of_results_viewers,
  count(DISTINCT screener_uid) AS opened_additional_resources
FROM mart_screener_resource_engagement_by_screening WHERE {s.flagged} AND {tab}""",
        "QE23_scroll_depth": f"""
SELECT CASE d WHEN 25 THEN '1. Quarter Page' WHEN 50 THEN '2. Half Page' WHEN 75 THEN '3. Three-Quarter Page'
    WHEN 100 THEN '4. Full Page' ELSE CAST(d AS VARCHAR) || '%' END AS depth,
  CASE tab_name WHEN 'long_term_benefits' THEN 'Long-Term Benefits'
    WHEN 'additional_resources' THEN 'Additional Resources' ELSE tab_name END AS tab,
  {pct("n", "sum(n) OVER (PARTITION BY tab_name)")} AS pct_of_tab_scrollers, {big("n")} AS screenings
FROM (SELECT depth AS d, tab_name, sum(screenings_reached_depth) AS n FROM mart_screener_scroll_depth
  WHERE {s.plain} GROUP BY 1, 2) x""",
        "QE24_help_by_topic": f"""
SELECT c.help_topic, {cap(pct("c.clicked", "v.viewers"))} AS pct_of_step_viewers, {big("c.clicks")} AS clicks
FROM (SELECT screener_step_name, {CAPS.format(x="dimension")} AS help_topic, sum(distinct_screenings) AS clicked,
    sum(total_clicks) AS clicks FROM mart_screener_help
  WHERE {s.plain} AND metric = 'help_click' AND screener_step_name IS NOT NULL GROUP BY 1, 2) c
LEFT JOIN (SELECT screener_step_name, count(DISTINCT screener_uid) AS viewers
  FROM mart_screener_step_views_by_screening WHERE {s.plain} AND viewed GROUP BY 1) v
  ON c.screener_step_name = v.screener_step_name""",
        "QE25_household_member_actions": f"""
SELECT CASE action WHEN 'add' THEN 'Add' WHEN 'delete' THEN 'Delete' WHEN 'edit_from_summary'
    THEN 'Edit (from summary)' WHEN 'delete_from_summary' THEN 'Delete (from summary)'
    WHEN '(unknown)' THEN '(Unknown)' ELSE upper(action[1]) || lower(action[2:]) END AS action,
  {pct("count(DISTINCT screener_uid)", people)} AS pct_of_viewers, count(DISTINCT screener_uid) AS screenings,
  {big("sum(total_actions)")} AS total_actions
FROM {acted} GROUP BY action""",
        "QE26_income_source_actions": f"""
SELECT 'Add' AS action, {pct("added", "viewed")} AS pct_of_member_pages, {big("added")} AS pages FROM {income}
UNION ALL SELECT 'Delete', {pct("deleted", "viewed")}, {big("deleted")} FROM {income}""",
        "QE27_confirmation_edits": f"""
SELECT section_label AS section, {pct("sum(screenings)", confirm)} AS pct_of_viewers,
  {big("sum(screenings)")} AS screenings
FROM mart_screener_confirmation_edits WHERE {s.plain} GROUP BY 1""",
        "QE28_signup_consent": f"""
SELECT 'SMS' AS channel, {pct("sms", "signups")} AS pct_opted_in, {big("sms")} AS opt_ins FROM {consent}
UNION ALL SELECT 'Email', {pct("email", "signups")}, {big("email")} FROM {consent}""",
        "QE29_filter_usage": one(
            sum_of("screenings_engaged", "mart_screener_filter_usage", s.plain), "filtered_screenings", False
        ),
        "QE30_nps_distribution": f"""
SELECT CAST(a.score AS VARCHAR) AS score, {big("c.n")} AS responses FROM range(11) a(score)
LEFT JOIN (SELECT nps_score, sum(scores_submitted) AS n FROM mart_screener_nps
  WHERE {s.plain} AND nps_score IS NOT NULL GROUP BY 1) c ON c.nps_score = a.score""",
        "QE31_chrome_navigation": chrome("nav"),
        "QE31_social_clicks": chrome("social"),
        "QE31_footer_feedback_share": chrome("feedback_share"),
        "QE32_disclaimer_links": f"""
SELECT l.link, CASE WHEN c.n > 0 THEN {cap(pct("c.n", disclaimer))} END AS pct_of_disclaimer_viewers,
  {big("c.clicks")} AS clicks
FROM (VALUES ('Public Charge'), ('Privacy Policy'), ('Terms and Conditions')) l(link)
LEFT JOIN (SELECT link_label, sum(screenings) AS n, sum(total_clicks) AS clicks FROM mart_screener_link_clicks
  WHERE {s.plain} AND link_location = 'disclaimer_inline' GROUP BY 1) c ON c.link_label = l.link""",
        "QE33_additional_resources_edits": f"""
SELECT {cap(pct(f"({edits_n})", openers))} AS pct_of_tab_openers, {big(f"({edits_n})")} AS screenings_that_edited""",
        "QE34_document_downloads": f"""
SELECT document, program, shown, downloaded, {cap(pct("downloaded", "shown"))} AS download_rate
FROM (SELECT program_id, document_name AS document, max(program_name) AS program,
    {seen("interaction_type = 'document_shown'")} AS shown,
    {seen("interaction_type = 'document_download'")} AS downloaded
  FROM mart_screener_program_interactions_by_screening
  WHERE {s.plain} AND interaction_type IN ('document_shown', 'document_download') AND document_name IS NOT NULL
  GROUP BY 1, 2) x
WHERE shown + downloaded > 0""",
        "QE35_more_help_resources": f"""
SELECT dimension AS resource, {big("sum(distinct_screenings)")} AS distinct_screeners,
  {big("sum(total_clicks)")} AS total_clicks
FROM mart_screener_help WHERE {s.plain} AND metric = 'more_help_resource_click' GROUP BY 1""",
        "QE36_back_to_screener": one(
            sum_of("screenings_went_back", "mart_screener_results_back", s.plain), "went_back"
        ),
        "QE37_nps_engagement": one(
            sum_of("scores_submitted", "mart_screener_nps", s.plain), "scored_nps", False
        ),
        "QE38_get_help_clicks": f"""
SELECT {cap(pct(f"(SELECT coalesce(sum(distinct_screenings), 0) FROM {help_n})", viewers))} AS pct_of_results_viewers,
  {big(f"(SELECT coalesce(sum(total_clicks), 0) FROM {help_n})")} AS more_help_clicks""",
        "QE39_average_help_clicks": avg(
            "mart_screener_help", "total_clicks", "distinct_screenings",
            f"{s.plain} AND metric = 'get_help_click'", "avg_clicks_per_screening",
        ),
        "QE39_average_tab_opens": avg(
            "mart_screener_resource_engagement", "total_clicks", "distinct_screenings",
            f"{s.flagged} AND {tab}", "avg_opens_per_screening",
        ),
        "QE39_average_edits": avg(
            "mart_screener_link_clicks", "total_clicks", "screenings", f"{s.plain} AND {edit}",
            "avg_edits_per_screening",
        ),
        "QE39_average_filter_uses": avg(
            "mart_screener_filter_usage", "total_engagements", "screenings_engaged",
            f"{s.plain} AND filter_type = 'citizenship'", "avg_uses_per_screening",
        ),
        "QE40_errors_detail": f"""
SELECT screener_step_label AS step, error_field_label AS field, error_problem AS problem,
  {big("sum(total_errors)")} AS errors
FROM mart_screener_form_errors WHERE {s.flagged} GROUP BY 1, 2, 3""",
        "QE41_language_switches": f"""
SELECT language_name AS switched_to, {big("sum(distinct_screenings)")} AS sessions
FROM mart_screener_language WHERE {s.site} GROUP BY 1""",
    }


CHECKED = ["id", "screener_id", "age", "disabled", "visually_impaired"]

OTHERS = {
    "V7_data_tenant": "SELECT * FROM wide_data WHERE white_label_id = 5",
    "K1_tenant_scope": "SELECT * FROM mart_householdmembers WHERE white_label_id = 3",
    "K1_no_tenant": "SELECT * FROM mart_householdmembers WHERE FALSE",
    "D1_null_counts": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM mart_householdmembers"
        for c in CHECKED
    ),
    "D2_duplicate_ids": """
SELECT eligibility_snapshot_id, count(*) AS n_rows FROM screener_programeligibilitysnapshot
GROUP BY 1 HAVING count(*) > 1""",
    "D3_duplicate_combinations": """
SELECT eligibility_snapshot_id, name_abbreviated, count(*) AS n_rows FROM screener_programeligibilitysnapshot
GROUP BY 1, 2 HAVING count(*) > 1""",
    "D4_unaccepted_frequencies": """
SELECT frequency AS value, count(*) AS n_rows FROM mart_income
WHERE frequency NOT IN ('yearly', 'monthly', 'weekly', 'hourly', 'biweekly', 'semimonthly') GROUP BY 1""",
    "D5_orphan_programs": """
SELECT name_abbreviated AS key, count(*) AS n_rows FROM screener_programeligibilitysnapshot
WHERE name_abbreviated NOT IN (SELECT name_abbreviated FROM programs_program) GROUP BY 1""",
    "S3_pruned_event_days": f"""
SELECT event_date, event_name, count(*) + count(*) FILTER (WHERE {REPEATED_EVENT}) AS n_events
FROM flat_events WHERE event_date >= '20240108' GROUP BY 1, 2""",
}


def broken(rule) -> str:
    """Number of failures of one rule, each counted by a statement of its own."""
    table, column = rule.table, rule.columns[0]
    if rule.kind == "not_null":
        return f"SELECT count(*) FROM {table} WHERE {column} IS NULL"
    if rule.kind == "unique":
        return f"SELECT count(*) FROM (SELECT 1 FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1) x"
    if rule.kind == "unique_combination":
        return f"SELECT count(*) FROM (SELECT 1 FROM {table} GROUP BY {', '.join(rule.columns)} HAVING count(*) > 1) x"
    if rule.kind == "accepted_values":
        listed = ", ".join(f"'{v}'" for v in rule.accepted)
        return f"SELECT count(DISTINCT {column}) FROM {table} WHERE {column} NOT IN ({listed})"
    parent, key = rule.parent
    return f"SELECT count(*) FROM {table} t WHERE t.{column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = t.{column})"


def rule_rows() -> str:
    from screenmart.plans.rules import RULES

    rows = " UNION ALL ".join(
        f"SELECT '{r.name}' AS rule, '{r.table}' AS table_name, '{r.kind}' AS kind, ({broken(r)}) AS failures" for r in RULES
    )
    return f"SELECT rule, table_name, kind, CAST(failures AS BIGINT) AS failures, failures = 0 AS passed FROM ({rows}) x"


def stage(condition: str) -> str:
    return f"count(DISTINCT user_pseudo_id) FILTER (WHERE {condition})"


STORED_TABLES = ["mart_screener_data", "mart_householdmembers", "mart_qualified_benefits", "mart_referrer_codes"]
STARTED = "hit_screener_start = 1"
COMPLETED = f"{STARTED} AND hit_screener_results = 1"

STORED = {
    "K1_session_view": "SELECT 'set' AS setting, * FROM mart_householdmembers WHERE white_label_id = 3",
    "M02_window_visitors_bitmaps": f"""
SELECT state_code, {stage("TRUE")} AS visitors, {stage(STARTED)} AS visitors_started,
  {stage(COMPLETED)} AS visitors_completed, {stage(COMPLETED + " AND has_outbound_click = 1")} AS visitors_clicked
FROM int_ga4_sessions WHERE event_date BETWEEN '20240110' AND '20240125' GROUP BY 1""",
    "S5_changed_days": "SELECT * FROM mart_screener_form_funnel",
    "S5_changed_days_screenings": "SELECT * FROM mart_screener_screening_funnel",
    "S6_refreshed_tables": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in STORED_TABLES),
    "S7_backfilled_days": f"""
SELECT event_date, count(*) + count(*) FILTER (WHERE {REPEATED_EVENT}) AS n_events
FROM flat_events WHERE event_date < '20240110' GROUP BY 1""",
    "P14_bucketed": "SELECT * FROM int_householdmembers",
    "P17_bucketed": "SELECT * FROM int_income",
    "P25_bucketed": "SELECT * FROM mart_screener_expense",
}


SCOPED_MARTS = (
    "mart_screener_data", "mart_householdmembers", "mart_screener_expense", "mart_income", "mart_current_benefits",
    "mart_qualified_benefits", "mart_referrer_codes",
)


def as_tenant(sql: str, tenant_id: int) -> str:
    """The same statement over one tenant's rows of every mart."""
    marts = "|".join(SCOPED_MARTS)
    return re.sub(rf"\b({marts})\b", rf"(SELECT * FROM \1 WHERE white_label_id = {tenant_id})", sql)


def in_places(sql: str) -> str:
    """The same statement over the screens of some places and what hangs on them."""
    chosen = f"(SELECT * FROM {DATA} WHERE {PLACES})"
    for mart, key in {
        "mart_householdmembers": "screener_id", "mart_screener_expense": "screener_id", "mart_income": "screener_id",
        "mart_current_benefits": "screen_id", "mart_qualified_benefits": "screen_id",
    }.items():
        sql = re.sub(rf"\b{mart}\b", f"(SELECT * FROM {mart} WHERE {key} IN (SELECT id FROM {DATA}))", sql)
    return re.sub(rf"\b{DATA}\b", chosen, sql)


def oracle_sql() -> dict[str, str]:
    from screenmart.queries import DATASETS, EVENT_CARDS, PLACES_CARDS, TENANT_CARDS, TENANT_SCREEN_CARDS, card_tenant

    out = {f"{key}_{name}": f"SELECT * FROM {VIEW_NAMES.get(name, name)}" for key, name in DATASETS.items()}
    cards = screen_cards()
    out.update(cards)
    out.update({f"{name}_tenant": as_tenant(cards[name], card_tenant(name)) for name in TENANT_SCREEN_CARDS})
    out.update({f"{name}_places": in_places(cards[name]) for name in PLACES_CARDS})
    world, tenant = event_cards(GLOBAL), event_cards(TENANT)
    for cards in (world, tenant):
        for name in ("QE19_detail_rate_by_state", "QE19_conversion_by_state"):
            cards[f"{name}_any"] = cards[name].replace("shown >= 20", "shown >= 1")
    out.update({name: world[name] for name in EVENT_CARDS})
    out.update({f"{name}_tenant": tenant[name] for name in TENANT_CARDS})
    out.update(OTHERS)
    out.update(STORED)
    out["D0_rule_report"] = rule_rows()
    out["QE21_resource_engagement_bitmaps"] = world["QE21_resource_engagement"]
    out["QE21_resource_engagement_bitmaps_tenant"] = tenant["QE21_resource_engagement"]
    out["QP16_monthly_active_users_bitmaps"] = screen_cards()["QP16_monthly_active_users"]
    return {name: compose(sql) for name, sql in out.items()}
