"""Screens, households, money and eligibility."""

from oracle.base import define, language, ratio

AGE = [
    ("lt18", "age <= 17"), ("18_24", "age > 17 AND age <= 24"), ("25_34", "age > 24 AND age <= 34"),
    ("35_49", "age > 34 AND age <= 49"), ("50_64", "age > 49 AND age <= 64"), ("65_84", "age > 64 AND age <= 84"),
    ("gt84", "age > 84"),
]

_AGE_AGGS = ", ".join(
    f"count(*) FILTER (WHERE {cond}) AS age_{x}_n, "
    f"{ratio(f'count(*) FILTER (WHERE {cond})', 'count(*)', 2)} AS age_{x}_share"
    for x, cond in AGE
)
AGE_COLUMNS = ", ".join(f"age_{x}_n, age_{x}_share" for x, _ in AGE)

_PER_YEAR = (
    "CASE frequency WHEN 'yearly' THEN amount WHEN 'monthly' THEN amount * 12 WHEN 'weekly' THEN amount * 52 "
    "WHEN 'hourly' THEN amount * 2080 WHEN 'biweekly' THEN amount * 26 WHEN 'semimonthly' THEN amount * 24 END"
)


def _monthly(out: str, table: str) -> str:
    return f"SELECT screen_id, CAST(sum({_PER_YEAR}) AS DOUBLE) / CAST(12 AS DOUBLE) AS {out} FROM {table} GROUP BY 1"


NEEDS = [
    ("needs_baby_supplies", "Baby Supplies"), ("needs_child_dev_help", "Child Development"), ("needs_food", "Food"),
    ("needs_funeral_help", "Funeral"), ("needs_housing_help", "Housing"),
    ("needs_mental_health_help", "Mental Health"), ("needs_family_planning_help", "Family Planning"),
    ("needs_dental_care", "Dental Care"), ("needs_job_resources", "Job Resources"),
    ("needs_legal_services", "Legal Services"), ("needs_college_savings", "College Savings"),
    ("needs_veteran_services", "Veteran Services"),
]
_NEED_LIST = ", ".join(n for n, _ in NEEDS)

SCREEN_BASE = f"""
  id, user_id, external_id, uuid, white_label_id, path, alternate_path, is_test,
  is_test_data, is_verified, completed, start_date AS start_timestamp,
  CAST(start_date AS DATE) AS start_date, submission_date AS submission_timestamp,
  CAST(submission_date AS DATE) AS submission_date, agree_to_tos, referrer_code, referral_source,
  utm_id, utm_source, utm_medium, utm_campaign, utm_content, utm_term, is_13_or_older,
  last_tax_filing_year, zipcode, CAST(household_assets AS DOUBLE) AS household_assets,
  housing_situation, household_size, has_benefits, {_NEED_LIST},
  CAST(isodow(start_date) AS VARCHAR) AS start_day, strftime(start_date, '%H') AS start_hour,
  CAST(isodow(submission_date) AS VARCHAR) AS submission_day,
  strftime(submission_date, '%H') AS submission_hour,
  {language("request_language_code")} AS request_language_code
"""

TEST_SOURCE = "regexp_matches(referral_source, '^(testOrProspect|stagingTest|test)$', 'i')"
GENUINE = "completed AND NOT is_test AND NOT is_test_data AND partner IS DISTINCT FROM 'Test'"

define(
    stg_current_benefits="SELECT screen_id, program_id FROM screener_current_benefits",
    stg_eligibility="""
SELECT snapshot.*, offer.* EXCLUDE (eligibility_snapshot_id, estimated_value),
  CAST(offer.estimated_value AS DOUBLE) AS estimated_value,
  CAST(submission_date AS DATE) AS eligibility_date, CAST(date_part('year', submission_date) AS INT) AS eligibility_year,
  CAST(date_part('month', submission_date) AS INT) AS eligibility_month,
  CAST(date_part('day', submission_date) AS INT) AS eligibility_day
FROM (SELECT id AS eligibility_snapshot_id, screen_id, submission_date, is_batch, had_error
    FROM screener_eligibilitysnapshot WHERE NOT had_error AND screen_id IS NOT NULL) snapshot
  JOIN (SELECT id, eligibility_snapshot_id, new, name, name_abbreviated, estimated_value, estimated_delivery_time,
      estimated_application_time, eligible, failed_tests, passed_tests
    FROM screener_programeligibilitysnapshot WHERE eligible IS NOT NULL) offer USING (eligibility_snapshot_id)""",
    stg_expenses="SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM screener_expense",
    stg_household_demographics=f"SELECT screen_id, {_AGE_AGGS} FROM screener_householdmember GROUP BY screen_id",
    stg_householdmembers="SELECT * FROM screener_householdmember",
    stg_income="SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM screener_incomestream",
    stg_latest_eligibility_snapshot="""
SELECT screen_id, coalesce(max(id) FILTER (WHERE submission_date IS NULL),
    list_last(list_sort(list((submission_date, id)) FILTER (WHERE submission_date IS NOT NULL)))[2]) AS latest_snapshot_id,
  count(DISTINCT (id, submission_date)) AS snapshots
FROM screener_eligibilitysnapshot GROUP BY screen_id""",
    stg_monthly_expenses=_monthly("monthly_expenses", "screener_expense"),
    stg_monthly_income=_monthly("monthly_income", "screener_incomestream"),
    # Values meet the tenant and the tax flag as sums per snapshot and program.
    snapshot_tenants="""
SELECT id AS eligibility_snapshot_id, white_label_id FROM screener_eligibilitysnapshot
JOIN (SELECT id AS screen_id, white_label_id FROM screener_screen) USING (screen_id)""",
    offered_values="""
SELECT eligibility_snapshot_id, name_abbreviated, sum(estimated_value) AS annual_value
FROM screener_programeligibilitysnapshot WHERE eligible GROUP BY ALL""",
    credit_programs="""
SELECT DISTINCT name_abbreviated, white_label_id, TRUE AS tax_category FROM programs_program
WHERE category_id IN (SELECT id FROM programs_programcategory WHERE tax_category)""",
    stg_program_eligibility="""
SELECT eligibility_snapshot_id, name_abbreviated, coalesce(tax_category, FALSE) AS tax_category, white_label_id,
  CAST(annual_value AS DOUBLE) AS annual_value
FROM offered_values JOIN snapshot_tenants USING (eligibility_snapshot_id)
LEFT JOIN credit_programs USING (name_abbreviated, white_label_id)""",
    stg_referrer_codes="SELECT referrer_code, name AS partner, white_label_id, is_partner FROM programs_referrer",
    stg_white_label="""
SELECT id AS white_label_id, name AS white_label_name, code AS white_label_code FROM screener_whitelabel
WHERE (name IS NOT NULL AND name <> '') OR (code IS NOT NULL AND code <> '')""",
    # The partner of a screen: the first of test source, referrer code, referral source, none.
    screen_codes="""
SELECT id, white_label_id, 1 AS place, referrer_code FROM screener_screen WHERE trim(referrer_code) <> ''
UNION ALL SELECT id, white_label_id, 2, referral_source FROM screener_screen WHERE trim(referral_source) <> ''""",
    screen_partners=f"""
SELECT id, arg_min(partner, place) AS partner FROM (
  SELECT id, 0 AS place, 'Test' AS partner FROM screener_screen WHERE {TEST_SOURCE}
  UNION ALL SELECT id, place, coalesce(partner, 'Other')
    FROM screen_codes LEFT JOIN stg_referrer_codes USING (referrer_code, white_label_id)
  UNION ALL SELECT id, 3, 'No Partner' FROM screener_screen) GROUP BY id""",
    screen_money=f"""
SELECT screen_id AS id, CAST(sum(a_year) FILTER (WHERE flow = 'in') AS DOUBLE) / CAST(12 AS DOUBLE) AS monthly_income,
  CAST(sum(a_year) FILTER (WHERE flow = 'out') AS DOUBLE) / CAST(12 AS DOUBLE) AS monthly_expenses
FROM (SELECT screen_id, 'in' AS flow, {_PER_YEAR} AS a_year FROM screener_incomestream
  UNION ALL SELECT screen_id, 'out', {_PER_YEAR} FROM screener_expense) GROUP BY ALL""",
    screen_households=f"""
SELECT screen_id AS id, bool_or(coalesce(student, FALSE)) AS has_student, {_AGE_AGGS}
FROM screener_householdmember GROUP BY ALL""",
    screen_energy="""
SELECT screen_id AS id, is_home_owner, is_renter, electric_provider, electric_provider_name,
  gas_provider AS gas_heat_provider, gas_provider_name AS gas_heat_provider_name, electricity_is_disconnected,
  has_past_due_energy_bills, has_old_car, needs_dryer, needs_hvac, needs_stove, needs_water_heater
FROM screener_energycalculatorscreen""",
    screen_latest="SELECT screen_id AS id, latest_snapshot_id, snapshots FROM stg_latest_eligibility_snapshot",
    screen_benefits="""
SELECT id, count(DISTINCT name_abbreviated) AS programs_matched,
  coalesce(sum(annual_value) FILTER (WHERE tax_category), 0) AS tax_credits_annual,
  coalesce(sum(annual_value) FILTER (WHERE NOT tax_category), 0) AS non_tax_credit_benefits_annual
FROM stg_program_eligibility JOIN screen_latest ON eligibility_snapshot_id = latest_snapshot_id GROUP BY id""",
    genuine_screens=f"SELECT * FROM screener_screen JOIN screen_partners USING (id) WHERE {GENUINE}",
    int_complete_screener_data=f"""
SELECT {SCREEN_BASE}, partner, coalesce(nullif(trim(county), ''), 'Unspecified') AS county, latest_snapshot_id, snapshots,
  {AGE_COLUMNS}, coalesce(has_student, FALSE) AS has_student, monthly_income, monthly_expenses,
  screen_energy.* EXCLUDE (id), coalesce(programs_matched, 0) AS programs_matched,
  coalesce(non_tax_credit_benefits_annual, 0) AS non_tax_credit_benefits_annual,
  coalesce(tax_credits_annual, 0) AS tax_credits_annual,
  coalesce(non_tax_credit_benefits_annual, 0) / CAST(12 AS DOUBLE) AS non_tax_credit_benefits_monthly,
  coalesce(tax_credits_annual, 0) / CAST(12 AS DOUBLE) AS tax_credits_monthly
FROM genuine_screens LEFT JOIN screen_benefits USING (id) LEFT JOIN screen_latest USING (id)
  LEFT JOIN screen_money USING (id) LEFT JOIN screen_households USING (id) LEFT JOIN screen_energy USING (id)""",
    mart_screener_data="SELECT * FROM int_complete_screener_data",
    int_householdmembers="""
SELECT d.id AS screener_id, d.white_label_id, d.partner, d.county, d.submission_date, sh.*
FROM stg_householdmembers sh JOIN int_complete_screener_data d ON sh.screen_id = d.id""",
    int_immediate_needs="SELECT white_label_id, partner, county, utm_campaign, utm_medium, utm_source, "
    + ", ".join(f"count(*) FILTER (WHERE {n}) AS {n}" for n, _ in NEEDS)
    + " FROM int_complete_screener_data GROUP BY 1, 2, 3, 4, 5, 6",
    int_immediate_needs_unpivoted=" UNION ALL ".join(
        f"SELECT '{label}' AS benefit, {n} AS count, white_label_id, partner, county, utm_campaign, utm_medium, "
        "utm_source FROM int_immediate_needs"
        for n, label in NEEDS
    ),
    int_income="""
SELECT si.*, d.id AS screener_id, d.submission_date, d.white_label_id
FROM stg_income si JOIN int_complete_screener_data d ON si.screen_id = d.id""",
    program_names="""
SELECT id AS program_id, white_label_id, name_abbreviated AS benefit_name, coalesce(text, name_abbreviated) AS benefit_display_name
FROM programs_program LEFT JOIN (SELECT master_id AS name_id, text FROM translations_translation_translation
  WHERE language_code = 'en-us') USING (name_id)""",
    screen_marks="""
SELECT id AS screen_id, latest_snapshot_id AS eligibility_snapshot_id, white_label_id, partner, county, submission_date,
  utm_campaign, utm_medium, utm_source FROM mart_screener_data""",
    mart_current_benefits="""
SELECT screen_id, white_label_id, partner, county, submission_date, utm_campaign, utm_medium, utm_source, benefit_name,
  benefit_display_name
FROM program_names JOIN stg_current_benefits USING (program_id) JOIN screen_marks USING (screen_id, white_label_id)""",
    mart_householdmembers="SELECT * FROM int_householdmembers",
    mart_immediate_needs="SELECT * FROM int_immediate_needs_unpivoted",
    mart_income="SELECT * FROM int_income",
    mart_qualified_benefits="""
SELECT screen_marks.* EXCLUDE (eligibility_snapshot_id), benefit_name,
  coalesce(benefit_display_name, benefit_name) AS benefit_display_name
FROM screen_marks
  JOIN (SELECT eligibility_snapshot_id, white_label_id, name_abbreviated AS benefit_name FROM stg_program_eligibility
    WHERE annual_value > 0) USING (eligibility_snapshot_id, white_label_id)
  LEFT JOIN program_names USING (white_label_id, benefit_name)""",
    mart_referrer_codes="""
SELECT rc.referrer_code, rc.partner, rc.white_label_id, rc.is_partner, wl.white_label_code
FROM stg_referrer_codes rc JOIN stg_white_label wl ON rc.white_label_id = wl.white_label_id""",
    mart_screener_expense="""
SELECT d.id AS screener_id, d.submission_date, d.white_label_id, se.*
FROM stg_expenses se JOIN int_complete_screener_data d ON se.screen_id = d.id""",
)

# --- first generation ---------------------------------------------------------------

WIDE = [(f"prog{i}", i % 4 == 0) for i in range(25)]
BENEFIT_LABELS = [(f"Program {i}", f"prog{i}") for i in range(24)] + [(None, "prog24")]


def _wide_sum(tax: bool) -> str:
    return " + ".join(f"coalesce({p}_annual, 0)" for p, kind in WIDE if kind is tax)


_WIDE_COLUMNS = ", ".join(f"{p}_annual" for p, _ in WIDE)

define(
    used_codes="SELECT DISTINCT referrer_code AS code FROM screener_screen WHERE referrer_code IS NOT NULL AND referrer_code <> ''",
    screen_programs="SELECT id, "
    + ", ".join(
        f"CAST(coalesce(sum(estimated_value) FILTER (WHERE name_abbreviated = '{p}'), 0) AS DOUBLE) AS {p}_annual"
        for p, _ in WIDE
    )
    + " FROM screen_latest JOIN (SELECT eligibility_snapshot_id AS latest_snapshot_id, name_abbreviated, "
    "estimated_value FROM screener_programeligibilitysnapshot WHERE eligible) USING (latest_snapshot_id) GROUP BY id",
    # Which of the two names counts, as a table of cases over what is stated and what is in use.
    screen_cases=f"""
SELECT id, white_label_id, referrer_code, referral_source, CASE
    WHEN {TEST_SOURCE} THEN 'test'
    WHEN coded IS NULL AND named IS NULL THEN 'none'
    WHEN coded IS NULL AND referral_source IN (FROM used_codes) THEN 'source'
    WHEN coded IS NOT NULL AND named IS NULL THEN 'code'
    WHEN coded = named AND named IN (FROM used_codes) THEN 'code'
    WHEN coded <> named AND named IN (FROM used_codes) THEN 'both'
    WHEN coded <> named AND coded IN (FROM used_codes) THEN 'code'
    ELSE 'other' END AS kind
FROM (SELECT *, nullif(trim(referrer_code), '') AS coded, nullif(trim(referral_source), '') AS named FROM screener_screen)""",
    first_partners="""
SELECT id, CASE kind WHEN 'test' THEN 'Test' WHEN 'none' THEN 'No Partner' WHEN 'source' THEN source_name
    WHEN 'code' THEN code_name WHEN 'both' THEN concat(code_name, ', ', source_name) ELSE 'Other' END AS partner
FROM screen_cases
  LEFT JOIN (SELECT referrer_code, white_label_id, name AS code_name FROM programs_referrer)
    USING (referrer_code, white_label_id)
  LEFT JOIN (SELECT referrer_code AS referral_source, white_label_id, name AS source_name FROM programs_referrer)
    USING (referral_source, white_label_id)""",
    data_base=f"""
SELECT {SCREEN_BASE}, county, partner, latest_snapshot_id, snapshots, {AGE_COLUMNS}, monthly_income, monthly_expenses,
  screen_energy.* EXCLUDE (id, electric_provider_name, gas_heat_provider_name), {_WIDE_COLUMNS}
FROM first_partners JOIN screener_screen USING (id) LEFT JOIN screen_programs USING (id)
  LEFT JOIN screen_latest USING (id) LEFT JOIN screen_money USING (id) LEFT JOIN screen_households USING (id)
  LEFT JOIN screen_energy USING (id)""",
    wide_data=f"""
SELECT *, non_tax_credit_benefits_annual / CAST(12 AS DOUBLE) AS non_tax_credit_benefits_monthly,
  tax_credits_annual / CAST(12 AS DOUBLE) AS tax_credits_monthly
FROM (SELECT *, CAST({_wide_sum(False)} AS DOUBLE) AS non_tax_credit_benefits_annual,
    CAST({_wide_sum(True)} AS DOUBLE) AS tax_credits_annual FROM data_base) x
WHERE {GENUINE}""",
    data_currentbenefits=" UNION ALL ".join(
        f"SELECT white_label_id, partner, {'NULL' if label is None else repr(label)} AS benefit, "
        f"count(*) FILTER (WHERE {p}_annual > 0) AS count FROM wide_data GROUP BY 1, 2"
        for label, p in BENEFIT_LABELS
    ),
    data_immediate_needs=" UNION ALL ".join(
        f"SELECT white_label_id, partner, '{label}' AS benefit, count(*) FILTER (WHERE {n}) AS count "
        "FROM wide_data GROUP BY 1, 2"
        for n, label in NEEDS
    ),
    data_expenses="""
SELECT se.* REPLACE (CAST(amount AS DOUBLE) AS amount), d.id AS screener_id, d.submission_date, d.white_label_id
FROM screener_expense se JOIN wide_data d ON se.screen_id = d.id""",
    data_income="""
SELECT si.* REPLACE (CAST(amount AS DOUBLE) AS amount), d.id AS screener_id, d.submission_date, d.white_label_id
FROM screener_incomestream si JOIN wide_data d ON si.screen_id = d.id""",
    data_householdmembers="""
SELECT sh.*, d.id AS screener_id, d.white_label_id, d.partner, d.submission_date
FROM screener_householdmember sh JOIN wide_data d ON sh.screen_id = d.id""",
    data_programs="""
SELECT id, if(id IS NULL, NULL, master_id) AS master_id, label, language_code, text
FROM (SELECT id AS master_id, label FROM translations_translation
    WHERE regexp_matches(label, '^program[.].*(-name|-apply_button_link)$', 'is'))
  LEFT JOIN (FROM translations_translation_translation WHERE language_code = 'en-us') USING (master_id)""",
    data_referrer_codes="SELECT referrer_code, name AS partner, white_label_id FROM programs_referrer",
)
