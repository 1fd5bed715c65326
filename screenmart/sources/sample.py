"""Raw tables derived from the generic sample tables.

The texts below are plain SELECTs that mean the same to any SQL engine. ``{name}``
stands for a table; the few functions that engines spell differently are named
placeholders too. Every statement reads its whole tables.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenmart.catalog import Catalog, Options
from screenmart.functions.steps import STEPS
from screenmart.session import checkpoint_dir
from screenmart.sources.schemas import TABLES, struct_type
from screenmart.sources.sinks import StoringCatalog, write_table

RAW_TABLES = ["region", "nation", "customer", "part", "orders", "lineitem", "events"]

SPARK_DIALECT = {
    "json_k": "cast(get_json_object(props, '$.k') as int)",
    "micros_ts": "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)",
}


def _cases(subject: str, values: list[str | None]) -> str:
    """CASE over ``subject`` in 0..n-1."""
    branches = " ".join(
        f"when {i} then '{v}'" for i, v in enumerate(values) if v is not None
    )
    return f"case {subject} {branches} end"


ORDERS = """
select o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, c_nationkey, c_mktsegment,
       n_name, cast(n_regionkey + 1 as int) as wl
from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey
"""

LINES = """
select l_orderkey, l_linenumber, l_orderkey * 10 + l_linenumber as lid, min(l_partkey) as l_partkey,
       min(l_suppkey) as l_suppkey, max(l_shipdate) as l_shipdate, min(l_quantity) as l_quantity,
       min(l_extendedprice) as l_extendedprice, min(l_returnflag) as l_returnflag
from {lineitem} group by l_orderkey, l_linenumber
"""

_FREQUENCY = _cases(
    "lid % 7", ["yearly", "monthly", "weekly", "hourly", "biweekly", "semimonthly", "other"]
)

_NEED_NAMES = [
    "needs_baby_supplies", "needs_child_dev_help", "needs_food", "needs_funeral_help", "needs_housing_help",
    "needs_mental_health_help", "needs_family_planning_help", "needs_dental_care", "needs_job_resources",
    "needs_legal_services", "needs_college_savings", "needs_veteran_services",
]

_NEEDS = ", ".join(
    f"case when o_orderkey % {i + 19} = 0 then null else o_orderkey % {i + 2} = 0 end as {name}"
    for i, name in enumerate(_NEED_NAMES)
)

_MEMBER_FLAGS = ", ".join(
    f"lid % {m} = 0 as {name}"
    for name, m in [
        ("student", 4), ("student_full_time", 8), ("pregnant", 9), ("unemployed", 6), ("worked_in_last_18_mos", 3),
        ("veteran", 10), ("medicaid", 5), ("disability_medicaid", 11), ("has_income", 2), ("has_expenses", 3),
        ("is_care_worker", 13),
    ]
)

_DISABILITY = ", ".join(
    f"case when lid % 5 = 0 then null else lid % {m} = 0 end as {name}"
    for name, m in [("visually_impaired", 14), ("disabled", 7), ("long_term_disability", 12)]
)

_ENERGY_FLAGS = ", ".join(
    f"case when o_orderkey % 9 = 0 then null else o_orderkey % {m} = 0 end as {name}"
    for name, m in [
        ("electricity_is_disconnected", 5), ("has_past_due_energy_bills", 3), ("has_old_car", 7),
        ("needs_dryer", 4), ("needs_hvac", 5), ("needs_stove", 6), ("needs_water_heater", 11),
    ]
)

RELATIONAL_SQL = {
    "screener_whitelabel": """
select cast(r_regionkey + 1 as int) as id, r_name as name, lower(substr(r_name, 1, 2)) as code,
       substr(r_name, 1, 2) as state_code, 'none' as cms_method
from {region}
""",
    "programs_referrer": """
select cast(n_nationkey as bigint) as id, cast(n_regionkey + 1 as int) as white_label_id,
       'ref' || cast(n_nationkey as string) as referrer_code, n_name as name, true as show_in_dropdown,
       n_nationkey % 3 <> 0 as is_partner
from {nation}
""",
    "screener_screen": f"""
select o_orderkey as id, 'uuid-' || cast(o_orderkey as string) as uuid, o_orderkey % 1000 as user_id,
       cast(null as string) as external_id, wl as white_label_id, '/' || lower(n_name) as path,
       cast(null as string) as alternate_path,
       o_orderstatus <> 'P' as completed, o_orderkey % 50 = 0 as is_test,
       case when o_orderkey % 59 = 0 then null else o_orderkey % 53 = 0 end as is_test_data,
       o_orderkey % 2 = 0 as is_verified,
       cast(o_orderdate + (o_orderkey % 24) * interval '1' hour as timestamp) as start_date,
       case when o_orderstatus <> 'P'
            then cast(o_orderdate + (o_orderkey % 24 + 1) * interval '1' hour as timestamp) end as submission_date,
       true as agree_to_tos, true as is_13_or_older,
       case o_orderkey % 7 when 0 then null when 1 then '' when 2 then '  ' when 3 then 'zzz'
            else 'ref' || cast(c_nationkey as string) end as referrer_code,
       case when o_orderkey % 41 = 0 then 'stagingTest'
            when o_orderpriority = '2-HIGH' then 'ref' || cast(c_nationkey as string)
            when o_orderpriority = '3-MEDIUM' then null
            when o_orderpriority = '4-NOT SPECIFIED' then ''
            else 'friend' end as referral_source,
       cast(null as string) as utm_id, c_mktsegment as utm_source, o_orderpriority as utm_medium,
       case when o_orderkey % 6 = 0 then null else n_name end as utm_campaign,
       cast(null as string) as utm_content, cast(null as string) as utm_term,
       '2023' as last_tax_filing_year, cast(80000 + o_orderkey % 1000 as string) as zipcode,
       case when o_orderkey % 13 = 0 then null when o_orderkey % 11 = 0 then ' ' else n_name end as county,
       case when o_orderkey % 17 = 0 then null else cast(o_totalprice as decimal(18,2)) end as household_assets,
       'renting' as housing_situation, cast(o_orderkey % 9 + 1 as int) as household_size,
       {_cases("o_orderkey % 3", ["true", "false", "preferNotToAnswer"])} as has_benefits,
       {_cases("o_orderkey % 6", ["en-us", "es", "vi", "zh-hans", "xx", None])} as request_language_code,
       {_NEEDS}
from {{order_base}}
""",
    "screener_householdmember": f"""
select lid as id, l_orderkey as screen_id, 'm' || cast(lid as string) as frontend_id,
       case when l_linenumber = 1 then 'headOfHousehold' else 'child' end as relationship,
       case when lid % 23 = 0 then null else cast(l_quantity * 2 as int) end as age,
       cast(l_shipdate as date) as birth_year_month, {_MEMBER_FLAGS}, {_DISABILITY}
from {{line_base}}
""",
    "screener_incomestream": f"""
select lid as id, l_orderkey as screen_id, lid as household_member_id,
       {_cases("lid % 5", ["wages", "selfEmployment", "SSI", "pension", "unknownType"])} as type,
       'income' as category, cast(l_extendedprice as decimal(18,2)) as amount, {_FREQUENCY} as frequency,
       case when lid % 4 = 0 then null else cast(lid % 40 as int) end as hours_worked
from {{line_base}} where l_returnflag = 'R'
""",
    "screener_expense": f"""
select lid as id, l_orderkey as screen_id,
       {_cases("lid % 5", ["rent", "mortgage", "childCare", "medical", "misc"])} as type,
       cast(l_extendedprice as decimal(18,2)) as amount, {_FREQUENCY} as frequency
from {{line_base}} where l_returnflag = 'N'
""",
    "screener_eligibilitysnapshot": """
select lid as id, l_orderkey as screen_id,
       case when lid % 101 = 0 then null else cast(l_shipdate as timestamp) end as submission_date,
       l_linenumber = 6 as is_batch, l_linenumber = 7 as had_error
from {line_base}
""",
    "screener_programeligibilitysnapshot": """
select l_orderkey * 1000 + l_linenumber * 100 + l_partkey % 100 as id,
       l_orderkey * 10 + l_linenumber as eligibility_snapshot_id, false as new,
       'Program ' || cast(l_partkey % 25 as string) as name, 'prog' || cast(l_partkey % 25 as string) as name_abbreviated,
       cast(l_quantity - 5 as decimal(18,2)) as estimated_value, '2 weeks' as estimated_delivery_time,
       '10 minutes' as estimated_application_time,
       case when l_suppkey % 19 = 0 then null else l_suppkey % 3 <> 0 end as eligible,
       cast(null as string) as failed_tests, cast(null as string) as passed_tests
from {lineitem}
""",
    "programs_program": """
select cast((r_regionkey + 1) * 100 + b as bigint) as id, 'prog' || cast(b as string) as name_abbreviated,
       cast((r_regionkey + 1) * 100 + b as bigint) as name_id, cast(b % 4 as bigint) as category_id,
       cast(r_regionkey + 1 as int) as white_label_id
from (select distinct p_partkey % 25 as b from {part}) brands join {region} on b <> 24
""",
    "programs_programcategory": """
select distinct p_partkey % 4 as id, p_partkey % 4 = 0 as tax_category from {part}
""",
    "translations_translation": """
select name_id as id, 'program.' || cast(name_id as string) || '-name' as label from {programs_program}
union all
select name_id + 10000, 'Program.' || cast(name_id as string) || '-Apply_Button_Link' from {programs_program}
union all
select name_id + 20000, 'program.' || cast(name_id as string) || '-description' from {programs_program}
""",
    "translations_translation_translation": """
select name_id * 2 as id, name_id as master_id, 'en-us' as language_code,
       'Benefit ' || cast(name_id as string) as text
from {programs_program} where category_id <> 3
union all
select name_id * 2 + 1, name_id, 'es', 'Beneficio ' || cast(name_id as string) from {programs_program}
""",
    "screener_current_benefits": """
select o_orderkey as id, o_orderkey as screen_id,
       case when o_orderkey % 97 = 0 then (wl % 5 + 1) * 100 else wl * 100 end + o_orderkey % 24 as program_id
from {order_base}
""",
    "screener_energycalculatorscreen": f"""
select o_orderkey as id, o_orderkey as screen_id, o_orderkey % 8 < 4 as is_home_owner, o_orderkey % 8 >= 4 as is_renter,
       case when o_orderkey % 5 = 0 then null else 'e' || cast(o_orderkey % 6 as string) end as electric_provider,
       case when o_orderkey % 4 = 0 then null else 'Electric ' || cast(o_orderkey % 6 as string) end
           as electric_provider_name,
       case when o_orderkey % 5 = 1 then null else 'g' || cast(o_orderkey % 6 as string) end as gas_provider,
       case when o_orderkey % 4 = 1 then null else 'Gas ' || cast(o_orderkey % 6 as string) end as gas_provider_name,
       {_ENERGY_FLAGS}
from {{order_base}} where c_mktsegment = 'MACHINERY'
""",
}

# --- events -----------------------------------------------------------------

EVENT_BASE = """
select event_id, ts, user_id, event_type, {json_k} as k, {micros_ts} as event_timestamp,
       cast(floor((day(ts) - 1) / 3) as bigint) as session_no, cast(floor((day(ts) - 1) / 6) as bigint) as screening_no,
       cast(year(ts) * 10000 + month(ts) * 100 + day(ts) as string) as event_date,
       case user_id % 8 when 0 then 'co' when 1 then 'nc' when 2 then 'tx' when 3 then 'wa' when 4 then 'il'
            when 5 then 'ma' when 6 then 'cesn' else 'Colorado' end as state
from {events}
"""

# Per source type: (first k, last k, event name).
EVENT_NAMES = {
    "view": [
        (0, 69, "screener_form_step"), (70, 84, "page_view"), (85, 99, "screener_results_scroll_depth"),
    ],
    "signup": [
        (0, 24, "screener_form_start"), (25, 39, "screener_form_complete"), (40, 54, "session_start"),
        (55, 64, "screener_signup_completed"), (65, 74, "screener_household_member"),
        (75, 84, "screener_income_source"), (85, 92, "screener_language_changed"),
        (93, 99, "screener_confirmation_edit"),
    ],
    "purchase": [
        (0, 39, "screener_results_loaded"), (40, 49, "screener_results_none_eligible"),
        (50, 54, "screener_results_error"), (55, 59, "screener_results_error_recovery"),
        (60, 99, "view_item_list"),
    ],
    "click": [
        (0, 9, "screener_apply_click"), (10, 19, "screener_program_more_info"),
        (20, 24, "screener_program_visit_website"), (25, 29, "screener_program_phone_click"),
        (30, 34, "screener_program_document_download"), (35, 37, "screener_required_program_click"),
        (38, 44, "screener_navigator_engaged"), (45, 49, "screener_results_tab_click"),
        (50, 54, "screener_additional_resource_more_info"), (55, 59, "screener_additional_resource_click"),
        (60, 64, "screener_filter_engaged"), (65, 68, "screener_share"), (69, 69, "screener_share_popup_shown"),
        (70, 74, "screener_results_save"), (75, 79, "outbound_link"), (80, 83, "screener_link_click"),
        (84, 86, "screener_logo_click"), (87, 89, "screener_social_click"), (90, 92, "screener_feedback_click"),
        (93, 94, "screener_results_back_to_screener"), (95, 96, "screener_help_click"),
        (97, 97, "screener_get_help_click"), (98, 98, "screener_nps_score_submitted"),
        (99, 99, "screener_more_help_resource_click"),
    ],
    "error": [
        (0, 59, "screener_form_error"), (60, 79, "screener_form_back"), (80, 91, "screener_nps_score_submitted"),
        (92, 95, "screener_nps_reason_submitted"), (96, 99, "screener_nps_reason_skipped"),
    ],
}

_NAME_SQL = "case " + " ".join(
    f"when event_type = '{kind}' and k between {a} and {b} then '{name}'"
    for kind, ranges in EVENT_NAMES.items()
    for a, b, name in ranges
) + " end"

EVENT_NAMED = f"""
select event_id, event_date, event_timestamp, {_NAME_SQL} as event_name, 'u' || cast(user_id as string) as user_pseudo_id,
       cast(null as string) as user_id, cast(floor(event_id / 4) as bigint) as event_bundle_sequence_id,
       event_id % 4 as batch_event_index, user_id as visitor, k, session_no, screening_no, state
from {{event_base}}
"""


def _on(names: str, expr: str) -> str:
    listed = ", ".join(f"'{n}'" for n in names.split())
    return f"case when event_name in ({listed}) then {expr} end"


_SLUGS = [s for s, *_ in STEPS]
_SITE = "'https://screener.example.org'"
_STATE_SEGMENT = "lower(state)"
_PROGRAM_EVENTS = (
    "screener_apply_click screener_program_more_info screener_program_visit_website screener_program_phone_click "
    "screener_program_document_download screener_required_program_click screener_navigator_engaged"
)
_SITE_EVENTS = (
    "screener_share screener_share_popup_shown screener_results_save screener_language_changed screener_logo_click "
    "screener_social_click screener_feedback_click screener_link_click screener_confirmation_edit"
)
_PROGRAM = "100 + event_id % 7"
_CHANNELS = ["email", "sms", "whatsapp", "copy_link", None]

# parameter -> value kinds; kinds: s string, i int, d double.
EVENT_PARAMS: dict[str, dict[str, str]] = {
    "ga_session_id": {"i": "case when k % 33 <> 0 then session_no end"},
    "screener_state": {"s": "case when k % 7 <> 0 then state end"},
    "screener_uid": {
        "s": "case when k % 10 <> 0 then cast(visitor as string) || '-' || cast(screening_no as string) end"
    },
    "page_location": {
        "s": "case when event_name = 'page_view' then case k % 5 "
        f"when 0 then {_SITE} || '/' || {_STATE_SEGMENT} || '/step-1' "
        f"when 1 then {_SITE} || '/' || {_STATE_SEGMENT} || '/results?page=1' when 2 then {_SITE} || '/' "
        f"when 3 then {_SITE} || '/co-tax-calculator/step-1' end "
        f"when event_name = 'outbound_link' then {_SITE} || '/' || {_STATE_SEGMENT} || "
        "case when k % 2 = 0 then '/results' else '/step-3' end "
        + " ".join(
            f"when event_name = '{n}' then case when event_id % 3 = 0 then {_SITE} "
            f"else {_SITE} || '/' || {_STATE_SEGMENT} || '/results' end"
            for n in _SITE_EVENTS.split()
        )
        + " end"
    },
    "medium": {"s": _on("session_start", _cases("event_id % 4", [None, "organic", "cpc", "referral"]))},
    "source": {"s": _on("session_start", _cases("event_id % 3", [None, "google", "partner"]))},
    "campaign": {"s": _on("session_start", _cases("event_id % 2", ["spring", None]))},
    "link_url": {"s": _on("outbound_link", "'https://apply.example.com/p/' || cast(event_id as string)")},
    "link_domain": {"s": _on("outbound_link", _cases("event_id % 3", [None, "", "benefits.example.com"]))},
    "outbound": {"s": _on("outbound_link", "case when event_id % 4 = 0 then 'false' else 'true' end")},
    "screener_path": {"s": _on("screener_form_start", _cases("k % 4", [None, " HomeOwner", "renter", "other"]))},
    "screener_step_name": {
        "s": f"case when event_name = 'screener_form_step' then {_cases('k % 22', _SLUGS)} "
        f"when event_name in ('screener_form_error', 'screener_form_back') and k % 20 <> 19 then "
        f"{_cases('(k * 3) % 22', _SLUGS)} "
        f"when event_name = 'screener_help_click' then {_cases('event_id % 22', _SLUGS)} "
        "when event_name = 'screener_link_click' then 'disclaimer' end"
    },
    "screener_step_number": {"i": _on("screener_form_step screener_help_click", "cast(k % 22 + 1 as bigint)")},
    "step_action": {"s": _on("screener_form_step", "case when k % 4 = 3 then 'complete' else 'view' end")},
    "member_index": {
        "i": "case when event_name = 'screener_form_step' and k % 22 = 7 then event_id % 3 "
        "when event_name in ('screener_household_member', 'screener_income_source') and event_id % 5 <> 0 "
        "then event_id % 3 end"
    },
    "form_field_name": {
        "s": _on(
            "screener_form_error",
            _cases(
                "k % 8",
                ["zipcode", "needs.food", "members.birthMonth", "incomeStreams.bogus", "unmappedField", "  ", None,
                 " contactInfo.email"],
            ),
        )
    },
    "form_error_reason": {"s": _on("screener_form_error", _cases("k % 3", ["Required", "  ", None]))},
    "form_error_message": {"s": _on("screener_form_error", "'Check this field'")},
    "form_error_count": {"i": _on("screener_form_error", "cast(k % 3 + 1 as bigint)")},
    "help_topic": {"s": _on("screener_help_click", _cases("event_id % 3", ["household-size", "income help-text", None]))},
    "location": {
        "s": "case when event_name = 'screener_get_help_click' then "
        + _cases("event_id % 2", ["footer", None])
        + " when event_name = 'screener_logo_click' then "
        + _cases("event_id % 3", ["header", "footer", None])
        + " end"
    },
    "resource_name": {
        "s": "case when event_name in ('screener_additional_resource_more_info', 'screener_additional_resource_click') "
        "and event_id % 9 <> 0 then 'Resource ' || cast(event_id % 4 as string) "
        "when event_name = 'screener_more_help_resource_click' then "
        + _cases("event_id % 4", ["moreHelp.resource_name1", "Food Bank", None, None])
        + " end"
    },
    "resource_index": {
        "i": _on("screener_more_help_resource_click", "case when event_id % 8 <> 7 then event_id % 5 end")
    },
    "url": {
        "s": f"case when event_name = 'screener_more_help_resource_click' then "
        + _cases("event_id % 4", [None, None, "https://help.example.org", ""])
        + " when event_name = 'screener_program_visit_website' then 'https://program.example.org' end"
    },
    "program_id": {
        "i": _on(_PROGRAM_EVENTS, f"case when event_id % 11 <> 0 and event_id % 2 = 0 then {_PROGRAM} end"),
        "s": _on(
            _PROGRAM_EVENTS,
            "case when event_id % 13 = 0 then '(not set)' "
            f"when event_id % 11 <> 0 and event_id % 2 = 1 then cast({_PROGRAM} as string) end",
        ),
    },
    "program_name": {
        "s": _on(_PROGRAM_EVENTS, f"case when event_id % 3 = 0 then 'Program ' || cast({_PROGRAM} as string) end")
    },
    "document_name": {
        "s": _on("screener_program_document_download", "case when event_id % 5 <> 0 then 'Doc ' || cast(event_id % 3 as string) end")
    },
    "filter_type": {"s": _on("screener_filter_engaged", _cases("event_id % 2", ["citizenship", None]))},
    "tab_name": {
        "s": _on(
            "screener_results_tab_click screener_results_scroll_depth",
            _cases("event_id % 5", ["additional_resources", "long_term_benefits", "additional_resources", "near_term", None]),
        )
    },
    "navigator_id": {
        "i": _on("screener_navigator_engaged", "case when event_id % 2 = 0 then event_id % 5 + 1 end"),
        "s": _on("screener_navigator_engaged", "case when event_id % 2 = 1 then cast(event_id % 5 + 1 as string) end"),
    },
    "navigator_name": {
        "s": _on("screener_navigator_engaged", "'Navigator ' || cast(event_id % 5 + 1 as string)")
    },
    "contact_method": {
        "s": _on(
            "screener_navigator_engaged screener_additional_resource_click",
            _cases("event_id % 4", ["website", "email", "phone", None]),
        )
    },
    "program_count": {"i": _on("screener_results_loaded", "case when k % 15 <> 14 then cast(k % 15 as bigint) end")},
    "total_estimated_value": {
        "i": _on("screener_results_loaded", "case when k % 2 = 0 then cast(k * 38 as bigint) end"),
        "d": _on("screener_results_loaded", "case when k % 4 = 1 then cast(k * 37.5 as double) end"),
    },
    "reference_id": {"s": _on("screener_results_error", "'ref-' || cast(event_id as string)")},
    "depth": {
        "i": _on("screener_results_scroll_depth", "case when event_id % 2 = 0 then cast(25 * (1 + k % 4) as bigint) end"),
        "s": _on(
            "screener_results_scroll_depth",
            "case when event_id % 2 = 1 then case when event_id % 17 = 0 then 'abc' "
            "else cast(25 * (1 + k % 4) as string) end end",
        ),
    },
    "action": {
        "s": "case when event_name = 'screener_household_member' then "
        + _cases("event_id % 6", ["add", "delete", "edit_from_summary", "delete_from_summary", "reorder", None])
        + " when event_name = 'screener_income_source' then "
        + _cases("event_id % 3", ["add", "delete", None])
        + " end"
    },
    "language_name": {"s": _on("screener_language_changed", _cases("event_id % 4", ["Spanish", "Vietnamese", "Russian", None]))},
    "section": {
        "s": _on(
            "screener_confirmation_edit",
            _cases("event_id % 5", ["zipcode", "householdData", "hasBenefits", "customSection", None]),
        )
    },
    "share_location": {"s": _on("screener_share", _cases("event_id % 2", ["results_popup", "footer"]))},
    "share_channel": {"s": _on("screener_share", _cases("event_id % 5", _CHANNELS))},
    "share_provider": {"s": _on("screener_share", _cases("event_id % 3", ["gmail", "device", None]))},
    "share_action": {"s": _on("screener_share", _cases("event_id % 3", ["open", "send", "send"]))},
    "save_channel": {"s": _on("screener_results_save", _cases("event_id % 5", _CHANNELS))},
    "save_action": {"s": _on("screener_results_save", _cases("event_id % 3", ["open", "send", "close"]))},
    "sms_consent": {"s": _on("screener_signup_completed", _cases("event_id % 3", ["true", "false", None]))},
    "email_consent": {"s": _on("screener_signup_completed", _cases("event_id % 4", ["true", "true", "false", None]))},
    "score": {
        "i": _on("screener_nps_score_submitted", "case when event_id % 2 = 0 then event_id % 11 end"),
        "s": _on(
            "screener_nps_score_submitted",
            "case when event_id % 2 = 1 then case when event_id % 13 = 0 then 'abc' "
            "else cast(event_id % 11 as string) end end",
        ),
    },
    "channel": {"s": _on("screener_feedback_click", _cases("event_id % 3", ["survey", "email", "phone"]))},
    "link_name": {
        "s": _on(
            "screener_link_click",
            _cases(
                "event_id % 6",
                ["About Us", "Public Charge", "Privacy Policy", "Additional Resources — Edit Step", None,
                 "Terms and Conditions"],
            ),
        )
    },
    "link_location": {
        "s": _on("screener_link_click", _cases("event_id % 5", ["footer", "disclaimer_inline", None, "results_needs", "disclaimer_inline"]))
    },
    "network": {"s": _on("screener_social_click", _cases("event_id % 4", ["facebook", "linkedIn", "x", None]))},
}

ITEM_SLOTS = 3


def _item(slot: int) -> dict[str, str]:
    """Item fields of one slot by list kind ``k % 5``; absent slots are NULL lists."""
    program = f"cast(100 + (event_id + {slot}) % 7 as string)"
    # programs / navigators / documents / resources / single placeholder
    lists = {
        1: ["results_programs", "results_navigators", "results_documents", "results_resources", "results_programs"],
        2: ["results_programs", "results_navigators", "results_documents", "results_resources", None],
        3: ["results_resources", None, "results_programs", "results_resources", None],
    }[slot]
    list_name = _cases("k % 5", lists)
    return {
        "list_name": f"case when event_name = 'view_item_list' then {list_name} end",
        "id": f"case when k % 5 = 4 then '(not set)' when k % 5 = 1 then cast((event_id + {slot}) % 5 + 1 as string) "
        f"else {program} end",
        "name": "case when k % 5 = 4 then '(not set)' "
        f"when k % 5 = 1 then 'Navigator ' || cast((event_id + {slot}) % 5 + 1 as string) "
        f"when k % 5 = 2 and {slot} < 3 then 'Doc ' || cast((event_id + {slot}) % 3 as string) "
        f"when k % 5 = 3 or (k % 5 = 0 and {slot} = 3) then 'Resource ' || cast((event_id + {slot}) % 4 as string) "
        f"else 'Program ' || {program} end",
        "category": f"case when k % 5 in (1, 2) then {program} end",
    }


PARAM_COLUMNS = {f"{p}__{kind}": sql for p, kinds in EVENT_PARAMS.items() for kind, sql in kinds.items()}
ITEM_COLUMNS = {f"item{n}__{f}": sql for n in range(1, ITEM_SLOTS + 1) for f, sql in _item(n).items()}

EVENT_KEYS = [
    "event_date", "event_timestamp", "event_name", "user_pseudo_id", "user_id", "event_bundle_sequence_id",
    "batch_event_index",
]

FLAT_EVENTS = (
    "select "
    + ", ".join(EVENT_KEYS)
    + ", "
    + ", ".join(f"{sql} as {name}" for name, sql in {**PARAM_COLUMNS, **ITEM_COLUMNS}.items())
    + " from {event_named}"
)

# Evaluation order of the statements.
STATEMENTS = {
    "order_base": ORDERS,
    "line_base": LINES,
    **RELATIONAL_SQL,
    "event_base": EVENT_BASE,
    "event_named": EVENT_NAMED,
    "flat_events": FLAT_EVENTS,
}


#: Statements that several raw tables are cut out of. They are stored once; the tables are projections of what is stored.
BASES = ["order_base", "line_base"]
#: Raw tables with a row per row of a base or of a sample table: nothing is shuffled or written for them.
VIEWS = [
    "screener_screen", "screener_householdmember", "screener_incomestream", "screener_expense",
    "screener_eligibilitysnapshot", "screener_programeligibilitysnapshot", "screener_current_benefits",
    "screener_energycalculatorscreen",
]


def _placeholders(text: str) -> list[str]:
    names = [*RAW_TABLES, *STATEMENTS]
    return [n for n in names if "{" + n + "}" in text]


def _run(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in RAW_TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name in BASES:
        return _base(spark, sf_dir, name)
    return _select(spark, sf_dir, name)


def _select(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = STATEMENTS[name]
    for key, sql in SPARK_DIALECT.items():
        text = text.replace("{" + key + "}", sql)
    return spark.sql(text, **{n: _run(spark, sf_dir, n) for n in _placeholders(text)})


def _base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base as stored Parquet, written on first use in this application."""
    path = f"{_landing_folder(spark, sf_dir)}/{name}"
    rows = _select(spark, sf_dir, name)
    if path not in _landed:
        _landed[path] = write_table(rows, path)
    return spark.read.schema(rows.schema).parquet(_landed[path])


def _param_entry(name: str) -> str:
    kinds = EVENT_PARAMS[name]

    def value(kind: str, sql_type: str) -> str:
        return f"cast({f'{name}__{kind}' if kind in kinds else 'null'} as {sql_type})"

    present = " or ".join(f"{name}__{kind} is not null" for kind in kinds)
    record = (
        f"named_struct('string_value', {value('s', 'string')}, 'int_value', {value('i', 'bigint')}, "
        f"'double_value', {value('d', 'double')})"
    )
    return f"case when {present} then named_struct('key', '{name}', 'value', {record}) end"


def _item_entry(n: int) -> str:
    fields = {"item_id": "id", "item_name": "name", "item_category": "category", "item_list_name": "list_name"}
    record = ", ".join(f"'{field}', item{n}__{column}" for field, column in fields.items())
    return f"case when item{n}__list_name is not null then named_struct({record}) end"


#: Events that come twice, the second time with lower values, and events that state a parameter twice, the second time lower.
REPEATED_EVENT = "event_name like 'screener_%' and event_timestamp % 61 = 0"
REPEATED_PARAM = "event_name like 'screener_%' and event_timestamp % 53 = 0"
_LOWER = {"screener_step_name": "'string_value', ''", "screener_step_number": "'int_value', -1L", "location": "'string_value', ''"}


def _lower_entry(name: str) -> str:
    """A second value of a parameter, below the first: readers of the largest value do not see it."""
    fields = {"string_value": "cast(null as string)", "int_value": "cast(null as bigint)", "double_value": "cast(null as double)"}
    field, value = _LOWER[name].split(", ")
    fields[field.strip("'")] = value
    record = ", ".join(f"'{f}', {v}" for f, v in fields.items())
    present = " or ".join(f"{name}__{kind} is not null" for kind in EVENT_PARAMS[name])
    return f"case when {present} then named_struct('key', '{name}', 'value', named_struct({record})) end"


def pack_events(flat: DataFrame) -> DataFrame:
    """Flat columns back into parameter and item arrays without absent entries; some events and parameters repeat."""
    params = ", ".join(_param_entry(name) for name in EVENT_PARAMS)
    lower = ", ".join(_lower_entry(name) for name in _LOWER)
    items = ", ".join(_item_entry(n) for n in range(1, ITEM_SLOTS + 1))
    again = F.expr(f"explode(if({REPEATED_EVENT}, array(0, 1), array(0)))").alias("again")
    wide = flat.select("*", again).selectExpr(
        *EVENT_KEYS, "again", f"array_compact(array({params})) as given", f"array_compact(array({lower})) as lower",
        f"array_compact(array({items})) as items",
    )
    lowered = "filter(given, g -> not exists(lower, l -> l.key = g.key))"
    packed = f"case when again = 1 then concat({lowered}, lower) when {REPEATED_PARAM} then concat(given, lower) else given end"
    return wide.selectExpr(*EVENT_KEYS, f"{packed} as event_params", "items")


def _work_folder(spark: SparkSession) -> str:
    """Shared folder of the cluster; that of the warehouse where none is named."""
    return checkpoint_dir(spark) or spark.conf.get("spark.sql.warehouse.dir")


_folders: dict[tuple[str, str], str] = {}


def _landing_folder(spark: SparkSession, sf_dir: str) -> str:
    """One folder per application and input, so nothing stale is read."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _folders:
        digest = hashlib.sha1(sf_dir.encode()).hexdigest()[:12]
        _folders[key] = f"{_work_folder(spark)}/screenmart_sample/{key[0]}/{digest}"
    return _folders[key]


def scratch_folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A new folder beside the landed tables."""
    return f"{_landing_folder(spark, sf_dir)}/{name}-{uuid.uuid4().hex}"


_landed: dict[str, str] = {}


def _land(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The raw table: a view of a stored base, or stored Parquet written on first use in this application."""
    path = f"{_landing_folder(spark, sf_dir)}/{name}"
    declared = struct_type(name)
    if name == "events":
        if path not in _landed:
            # Split by name within the day, as the backfill stores them: a family reads its own folders.
            packed = pack_events(_run(spark, sf_dir, "flat_events"))
            _landed[path] = write_table(packed, path, ["event_date", "event_name"])
        return spark.read.schema(declared).parquet(_landed[path])
    if name in VIEWS or path not in _landed:
        casts = [f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in declared]
        rows = _run(spark, sf_dir, name).selectExpr(*casts)
        if name in VIEWS:
            return rows
        _landed[path] = write_table(rows, path)
    return spark.read.schema(declared).parquet(_landed[path])


def sample_catalog(spark: SparkSession, sf_dir: str, options: Options | None = None) -> Catalog:
    """Catalog over raw tables derived from the sample tables in ``sf_dir``."""

    return Catalog(spark, _readers(spark, sf_dir), options or Options(analytics_epoch="20240108"))


def _readers(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    return {name: partial(_land, spark, sf_dir, name) for name in TABLES}


_stored: dict[tuple[str, tuple[str, ...]], StoringCatalog] = {}


def stored_sample_catalog(
    spark: SparkSession, sf_dir: str, options: Options, layers: tuple[str, ...] = StoringCatalog.layers
) -> StoringCatalog:
    """Like ``sample_catalog``, with the datasets of some layers written once in this application."""
    folder = _landing_folder(spark, sf_dir)
    key = (folder, layers)
    if key not in _stored:
        store = f"{folder}/{'_'.join(layers)}"
        _stored[key] = StoringCatalog(spark, _readers(spark, sf_dir), options, store=store, layers=layers)
    return _stored[key]
