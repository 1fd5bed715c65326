"""Declared types of the raw tables; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = "decimal(18,2)"

_NEED_FLAGS = (
    "needs_baby_supplies boolean, needs_child_dev_help boolean, needs_food boolean, "
    "needs_funeral_help boolean, needs_housing_help boolean, needs_mental_health_help boolean, "
    "needs_family_planning_help boolean, needs_dental_care boolean, needs_job_resources boolean, "
    "needs_legal_services boolean, needs_college_savings boolean, needs_veteran_services boolean"
)

RELATIONAL = {
    "screener_screen": (
        "id bigint, uuid string, user_id bigint, external_id string, white_label_id int, path string, "
        "alternate_path string, completed boolean, is_test boolean, is_test_data boolean, "
        "is_verified boolean, start_date timestamp, submission_date timestamp, agree_to_tos boolean, "
        "is_13_or_older boolean, referrer_code string, referral_source string, utm_id string, "
        "utm_source string, utm_medium string, utm_campaign string, utm_content string, utm_term string, "
        "last_tax_filing_year string, zipcode string, county string, "
        f"household_assets {MONEY}, housing_situation string, household_size int, has_benefits string, "
        f"request_language_code string, {_NEED_FLAGS}"
    ),
    "screener_whitelabel": "id int, name string, code string, state_code string, cms_method string",
    "screener_eligibilitysnapshot": (
        "id bigint, screen_id bigint, submission_date timestamp, is_batch boolean, had_error boolean"
    ),
    "screener_programeligibilitysnapshot": (
        "id bigint, eligibility_snapshot_id bigint, new boolean, name string, name_abbreviated string, "
        f"estimated_value {MONEY}, estimated_delivery_time string, estimated_application_time string, "
        "eligible boolean, failed_tests string, passed_tests string"
    ),
    "translations_translation": "id bigint, label string",
    "translations_translation_translation": "id bigint, master_id bigint, language_code string, text string",
    "programs_program": (
        "id bigint, name_abbreviated string, name_id bigint, category_id bigint, white_label_id int"
    ),
    "programs_programcategory": "id bigint, tax_category boolean",
    "screener_current_benefits": "id bigint, screen_id bigint, program_id bigint",
    "screener_incomestream": (
        f"id bigint, screen_id bigint, household_member_id bigint, type string, category string, amount {MONEY}, "
        "frequency string, hours_worked int"
    ),
    "screener_expense": f"id bigint, screen_id bigint, type string, amount {MONEY}, frequency string",
    "screener_householdmember": (
        "id bigint, screen_id bigint, frontend_id string, relationship string, age int, "
        "birth_year_month date, student boolean, student_full_time boolean, pregnant boolean, "
        "unemployed boolean, worked_in_last_18_mos boolean, visually_impaired boolean, disabled boolean, "
        "veteran boolean, medicaid boolean, disability_medicaid boolean, has_income boolean, "
        "has_expenses boolean, long_term_disability boolean, is_care_worker boolean"
    ),
    "programs_referrer": (
        "id bigint, white_label_id int, referrer_code string, name string, show_in_dropdown boolean, "
        "is_partner boolean"
    ),
    "screener_energycalculatorscreen": (
        "id bigint, screen_id bigint, is_home_owner boolean, is_renter boolean, electric_provider string, "
        "electric_provider_name string, gas_provider string, gas_provider_name string, "
        "electricity_is_disconnected boolean, has_past_due_energy_bills boolean, has_old_car boolean, "
        "needs_dryer boolean, needs_hvac boolean, needs_stove boolean, needs_water_heater boolean"
    ),
}

EVENTS = (
    "event_date string, event_timestamp bigint, event_name string, user_pseudo_id string, user_id string, "
    "event_bundle_sequence_id bigint, batch_event_index bigint, "
    "event_params array<struct<key:string,"
    "value:struct<string_value:string,int_value:bigint,double_value:double>>>, "
    "items array<struct<item_id:string,item_name:string,item_category:string,item_list_name:string>>"
)

TABLES = {**RELATIONAL, "events": EVENTS}


def struct_type(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[name])
