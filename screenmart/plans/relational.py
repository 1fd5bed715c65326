"""Screens, households, money and eligibility: staging to marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenmart.catalog import Catalog, dataset
from screenmart.functions.numbers import annual_amount, round_ratio
from screenmart.functions.text import NEEDS, TEST_SOURCE_PATTERN, filled, language_name
from screenmart.operators.skew import lookup_join

MONEY = "decimal(18,2)"

# Age bands as (column suffix, lower bound exclusive, upper bound inclusive).
AGE_BANDS = [
    ("lt18", None, 17),
    ("18_24", 17, 24),
    ("25_34", 24, 34),
    ("35_49", 34, 49),
    ("50_64", 49, 64),
    ("65_84", 64, 84),
    ("gt84", 84, None),
]

MEMBER_COLUMNS = [
    "id", "age", "student", "student_full_time", "pregnant", "unemployed", "worked_in_last_18_mos",
    "visually_impaired", "disabled", "veteran", "medicaid", "disability_medicaid", "has_income",
    "has_expenses", "screen_id", "relationship", "long_term_disability", "birth_year_month", "frontend_id",
    "is_care_worker",
]

# --- staging ----------------------------------------------------------------


@dataset("staging")
def stg_current_benefits(c: Catalog) -> DataFrame:
    return c.source("screener_current_benefits").select("screen_id", "program_id")


@dataset("staging")
def stg_eligibility(c: Catalog) -> DataFrame:
    """Program results of error-free snapshots with their date parts."""
    snapshots = c.source("screener_eligibilitysnapshot").where(
        ~F.col("had_error") & F.col("screen_id").isNotNull()
    )
    snapshots = snapshots.select(
        F.col("id").alias("eligibility_snapshot_id"), "screen_id", "submission_date", "is_batch", "had_error"
    )
    programs = c.source("screener_programeligibilitysnapshot").where(F.col("eligible").isNotNull())
    return lookup_join(programs, snapshots, ["eligibility_snapshot_id"], "inner").withColumns(
        {
            "eligibility_date": F.to_date("submission_date"),
            "eligibility_year": F.year("submission_date"),
            "eligibility_month": F.month("submission_date"),
            "eligibility_day": F.dayofmonth("submission_date"),
        }
    )


@dataset("staging")
def stg_expenses(c: Catalog) -> DataFrame:
    return c.source("screener_expense")


def _in_band(low: int | None, high: int | None) -> Column:
    age, parts = F.col("age"), []
    if low is not None:
        parts.append(age > low)
    if high is not None:
        parts.append(age <= high)
    return reduce(lambda a, b: a & b, parts)


def _age_band_aggs() -> list[Column]:
    aggs = []
    for suffix, low, high in AGE_BANDS:
        n = F.count_if(_in_band(low, high))
        aggs.append(n.alias(f"age_{suffix}_n"))
        aggs.append(round_ratio(n, F.count(F.lit(1)), 2).alias(f"age_{suffix}_share"))
    return aggs


@dataset("staging", grain=["screen_id"])
def stg_household_demographics(c: Catalog) -> DataFrame:
    """Members per age band; a NULL age counts in the denominator only."""
    return c.source("screener_householdmember").groupBy("screen_id").agg(*_age_band_aggs())


@dataset("staging", grain=["id"])
def stg_householdmembers(c: Catalog) -> DataFrame:
    return c.source("screener_householdmember").select(*MEMBER_COLUMNS)


@dataset("staging")
def stg_income(c: Catalog) -> DataFrame:
    return c.source("screener_incomestream")


#: Sorts after every day that a snapshot can have.
_UNDATED = 2**63 - 1


@dataset("rows", grain=["screen_id"])
def stg_latest_eligibility_snapshot(c: Catalog) -> DataFrame:
    """Newest snapshot per screen; an undated one counts as newest, ties go to the larger id.

    The rows of a screen meet once, and repeated ids are folded where they lie. Snapshots without a screen are one
    group of any size, so they are folded per id first.
    """
    newest = F.coalesce(F.unix_micros("submission_date"), F.lit(_UNDATED)).alias("newest")
    snapshots = c.source("screener_eligibilitysnapshot").select("screen_id", "id", newest)

    def folded(rows: DataFrame) -> DataFrame:
        per_id = rows.groupBy("screen_id", "id").agg(F.max("newest").alias("newest"))
        last = F.max_by("id", F.struct("newest", "id")).alias("latest_snapshot_id")
        return per_id.groupBy("screen_id").agg(last, F.count("id").alias("snapshots"))

    known = snapshots.where(F.col("screen_id").isNotNull()).repartition("screen_id")
    return folded(known).unionByName(folded(snapshots.where(F.col("screen_id").isNull())))


def _per_month(df: DataFrame, out: str) -> DataFrame:
    # The yearly sum stays decimal, so the result does not depend on row order.
    yearly = F.sum(annual_amount(F.col("amount"), F.col("frequency")))
    return df.groupBy("screen_id").agg((yearly.cast("double") / F.lit(12.0)).alias(out))


@dataset("staging", grain=["screen_id"])
def stg_monthly_expenses(c: Catalog) -> DataFrame:
    return _per_month(c.source("screener_expense"), "monthly_expenses")


@dataset("staging", grain=["screen_id"])
def stg_monthly_income(c: Catalog) -> DataFrame:
    return _per_month(c.source("screener_incomestream"), "monthly_income")


def _eligible_values(c: Catalog, latest: DataFrame | None = None) -> DataFrame:
    """Value per snapshot and program, before any join multiplies the rows.

    With ``latest`` only those snapshots' rows are aggregated, and carry their screen.
    """
    eligible = c.source("screener_programeligibilitysnapshot").where("eligible")
    keys = ["eligibility_snapshot_id", "name_abbreviated"]
    if latest is not None:
        of = latest.select("screen_id", F.col("latest_snapshot_id").alias("eligibility_snapshot_id"))
        eligible, keys = eligible.join(of, "eligibility_snapshot_id"), ["screen_id", *keys]
    return eligible.groupBy(*keys).agg(F.sum("estimated_value").alias("annual_value"))


def _with_tax_flag(c: Catalog, df: DataFrame) -> DataFrame:
    """Tax-credit flag of (name_abbreviated, white_label_id); unknown programs are not credits.

    The program list is small but not bounded here, so there is no hint: the
    engine broadcasts it by its measured size or splits the popular programs.
    """
    categories = c.source("programs_programcategory").select(F.col("id").alias("category_id"), "tax_category")
    programs = c.source("programs_program").select("name_abbreviated", "white_label_id", "category_id")
    flags = programs.join(categories, "category_id", "left").drop("category_id")
    joined = df.join(flags, ["name_abbreviated", "white_label_id"], "left")
    return joined.withColumn("tax_category", F.coalesce("tax_category", F.lit(False)))


@dataset("staging", grain=["eligibility_snapshot_id", "name_abbreviated", "tax_category"])
def stg_program_eligibility(c: Catalog) -> DataFrame:
    snapshots = c.source("screener_eligibilitysnapshot").select(
        F.col("id").alias("eligibility_snapshot_id"), "screen_id"
    )
    screens = c.source("screener_screen").select(F.col("id").alias("screen_id"), "white_label_id")
    tenants = lookup_join(snapshots, screens, ["screen_id"], "inner").drop("screen_id")
    values = _with_tax_flag(c, _eligible_values(c).join(tenants, "eligibility_snapshot_id"))
    keys = ["eligibility_snapshot_id", "name_abbreviated", "tax_category", "white_label_id"]
    return values.groupBy(*keys).agg(F.sum("annual_value").cast(MONEY).alias("annual_value"))


@dataset("staging", grain=["referrer_code", "white_label_id"])
def stg_referrer_codes(c: Catalog) -> DataFrame:
    return c.source("programs_referrer").select(
        "referrer_code", F.col("name").alias("partner"), "white_label_id", "is_partner"
    )


@dataset("staging", grain=["white_label_id"])
def stg_white_label(c: Catalog) -> DataFrame:
    tenants = c.source("screener_whitelabel").where("name <> '' or code <> ''")
    return tenants.select(
        F.col("id").alias("white_label_id"),
        F.col("name").alias("white_label_name"),
        F.col("code").alias("white_label_code"),
    )


# --- completed screens ------------------------------------------------------

SCREEN_COLUMNS = [
    "id", "user_id", "external_id", "uuid", "white_label_id", "path", "alternate_path", "is_test", "is_test_data",
    "is_verified", "completed", "agree_to_tos", "referrer_code", "referral_source", "utm_id", "utm_source",
    "utm_medium", "utm_campaign", "utm_content", "utm_term", "is_13_or_older", "last_tax_filing_year", "zipcode",
    "county", "household_assets", "housing_situation", "household_size", "has_benefits", *NEEDS,
]

ENERGY_COLUMNS = {
    "is_home_owner": "is_home_owner",
    "is_renter": "is_renter",
    "electric_provider": "electric_provider",
    "electric_provider_name": "electric_provider_name",
    "gas_provider": "gas_heat_provider",
    "gas_provider_name": "gas_heat_provider_name",
    "electricity_is_disconnected": "electricity_is_disconnected",
    "has_past_due_energy_bills": "has_past_due_energy_bills",
    "has_old_car": "has_old_car",
    "needs_dryer": "needs_dryer",
    "needs_hvac": "needs_hvac",
    "needs_stove": "needs_stove",
    "needs_water_heater": "needs_water_heater",
}


def completed_screens(c: Catalog) -> DataFrame:
    """Finished, genuine screens with their derived time, place and language columns."""
    is_test_source = F.coalesce(F.col("referral_source").rlike(TEST_SOURCE_PATTERN), F.lit(False))
    screens = c.source("screener_screen").where(
        F.col("completed") & ~F.col("is_test") & ~F.col("is_test_data") & ~is_test_source
    )
    derived = {
        "start_timestamp": F.col("start_date"),
        "start_date": F.to_date("start_date"),
        "submission_timestamp": F.col("submission_date"),
        "submission_date": F.to_date("submission_date"),
        "start_day": (F.weekday("start_date") + 1).cast("string"),
        "start_hour": F.date_format("start_date", "HH"),
        "submission_day": (F.weekday("submission_date") + 1).cast("string"),
        "submission_hour": F.date_format("submission_date", "HH"),
        "request_language_code": language_name(F.col("request_language_code")),
    }
    return screens.select(*SCREEN_COLUMNS, *[value.alias(name) for name, value in derived.items()])


def with_partner(c: Catalog, screens: DataFrame) -> DataFrame:
    """Partner by referrer code, else by referral source, else none.

    Only one of the two codes decides for a screen, so one lookup serves both.
    Screens without a code share a NULL key, which the lookup spreads.
    """
    code, source = F.col("referrer_code"), F.col("referral_source")
    deciding = F.when(filled(code), code).when(filled(source), source)
    partners = c["stg_referrer_codes"].select(
        F.col("referrer_code").alias("_code"), "white_label_id", F.col("partner").alias("_partner")
    )
    keyed = screens.withColumn("_code", deciding)
    joined = lookup_join(keyed, partners, ["_code", "white_label_id"], "left")
    partner = F.when(F.col("_code").isNull(), F.lit("No Partner")).otherwise(F.coalesce("_partner", F.lit("Other")))
    return joined.withColumn("partner", partner).drop("_code", "_partner")


def household_facts(c: Catalog) -> DataFrame:
    """Age bands and the student flag from one pass over the members."""
    student = F.bool_or(F.coalesce("student", F.lit(False))).alias("has_student")
    return c["stg_householdmembers"].groupBy("screen_id").agg(*_age_band_aggs(), student)


def energy_facts(c: Catalog) -> DataFrame:
    return c.source("screener_energycalculatorscreen").select(
        "screen_id", *[F.col(name).alias(out) for name, out in ENERGY_COLUMNS.items()]
    )


@dataset("intermediate", grain=["id"])
def int_complete_screener_data(c: Catalog) -> DataFrame:
    """One row per finished screen with money, household, energy and benefit facts.

    Every joined side is reduced to the screen first and all joins share the
    screen id, so the screens are shuffled once for the whole chain.
    """
    latest = c["stg_latest_eligibility_snapshot"]
    values = _eligible_values(c, latest)
    tenants = c.source("screener_screen").select(F.col("id").alias("screen_id"), "white_label_id")
    values = _with_tax_flag(c, values.join(tenants, "screen_id"))
    tax = F.col("tax_category")
    per_program = values.groupBy("screen_id", "name_abbreviated").agg(
        F.sum(F.when(tax, F.col("annual_value")).otherwise(0)).alias("tax"),
        F.sum(F.when(~tax, F.col("annual_value")).otherwise(0)).alias("other"),
    )
    benefits = per_program.groupBy("screen_id").agg(
        F.count("name_abbreviated").alias("programs_matched"),
        F.sum("other").cast(MONEY).alias("non_tax_credit_benefits_annual"),
        F.sum("tax").cast(MONEY).alias("tax_credits_annual"),
    )
    screens = with_partner(c, completed_screens(c)).where(~F.col("partner").eqNullSafe(F.lit("Test")))
    screens = screens.withColumn("screen_id", F.col("id"))
    for side in (
        latest,
        c["stg_monthly_income"],
        c["stg_monthly_expenses"],
        household_facts(c),
        energy_facts(c),
        benefits,
    ):
        screens = screens.join(side, "screen_id", "left")
    zero = F.lit(0)
    out = screens.drop("screen_id").withColumns(
        {
            "county": F.coalesce(F.nullif(F.trim("county"), F.lit("")), F.lit("Unspecified")),
            "has_student": F.coalesce("has_student", F.lit(False)),
            "programs_matched": F.coalesce("programs_matched", zero),
            "non_tax_credit_benefits_annual": F.coalesce("non_tax_credit_benefits_annual", zero).cast(MONEY),
            "tax_credits_annual": F.coalesce("tax_credits_annual", zero).cast(MONEY),
        }
    )
    return out.withColumns(
        {
            "non_tax_credit_benefits_monthly": F.col("non_tax_credit_benefits_annual").cast("double") / F.lit(12.0),
            "tax_credits_monthly": F.col("tax_credits_annual").cast("double") / F.lit(12.0),
        }
    )


@dataset("mart", grain=["id"], partition_by=["white_label_id"], sort_by=["submission_date"])
def mart_screener_data(c: Catalog) -> DataFrame:
    return c["int_complete_screener_data"]


def _screens(c: Catalog, *columns: str) -> DataFrame:
    """Screens as the children of the screen mart see them."""
    return c["mart_screener_data"].select(F.col("id").alias("screen_id"), *columns)


# --- children of the screen mart ----------------------------------------------


@dataset("intermediate", grain=["id"])
def int_householdmembers(c: Catalog) -> DataFrame:
    screens = _screens(c, "white_label_id", "partner", "county", "submission_date")
    members = lookup_join(c["stg_householdmembers"], screens, ["screen_id"], "inner")
    return members.withColumn("screener_id", F.col("screen_id"))


@dataset("intermediate")
def int_immediate_needs(c: Catalog) -> DataFrame:
    keys = ["white_label_id", "partner", "county", "utm_campaign", "utm_medium", "utm_source"]
    return c["mart_screener_data"].groupBy(*keys).agg(*[F.count_if(need).alias(need) for need in NEEDS])


def unpivot_needs(df: DataFrame, keys: list[str]) -> DataFrame:
    named = df.select(*keys, *[F.col(need).alias(label) for need, label in NEEDS.items()])
    return named.unpivot(keys, list(NEEDS.values()), "benefit", "count")


@dataset("intermediate")
def int_immediate_needs_unpivoted(c: Catalog) -> DataFrame:
    keys = ["white_label_id", "partner", "county", "utm_campaign", "utm_medium", "utm_source"]
    return unpivot_needs(c["int_immediate_needs"], keys)


@dataset("intermediate", grain=["id"])
def int_income(c: Catalog) -> DataFrame:
    screens = _screens(c, "submission_date", "white_label_id")
    income = lookup_join(c["stg_income"], screens, ["screen_id"], "inner")
    return income.withColumn("screener_id", F.col("screen_id"))


def _english_names(c: Catalog) -> DataFrame:
    texts = c.source("translations_translation_translation").where(F.col("language_code") == "en-us")
    return texts.select(F.col("master_id").alias("name_id"), "text")


def named_programs(c: Catalog) -> DataFrame:
    """Programs with the name shown to people."""
    programs = c.source("programs_program").join(_english_names(c), "name_id", "left")
    return programs.select(
        F.col("id").alias("program_id"),
        "white_label_id",
        F.col("name_abbreviated").alias("benefit_name"),
        F.coalesce("text", "name_abbreviated").alias("benefit_display_name"),
    )


SCREEN_SLICE = ["partner", "county", "submission_date", "utm_campaign", "utm_medium", "utm_source"]


@dataset(
    "mart", grain=["screen_id", "benefit_name", "white_label_id"], partition_by=["white_label_id"], sort_by=["screen_id"]
)
def mart_current_benefits(c: Catalog) -> DataFrame:
    """Benefits a household already has; a program of another tenant does not count."""
    screens = _screens(c, "white_label_id", *SCREEN_SLICE)
    held = lookup_join(c["stg_current_benefits"], screens, ["screen_id"], "inner")
    return held.join(named_programs(c), ["program_id", "white_label_id"]).drop("program_id")


@dataset("mart", grain=["id"], partition_by=["white_label_id"], sort_by=["screener_id", "id"])
def mart_householdmembers(c: Catalog) -> DataFrame:
    return c["int_householdmembers"]


@dataset("mart")
def mart_immediate_needs(c: Catalog) -> DataFrame:
    return c["int_immediate_needs_unpivoted"]


@dataset("mart", grain=["id"], partition_by=["white_label_id"], sort_by=["screener_id", "id"])
def mart_income(c: Catalog) -> DataFrame:
    return c["int_income"]


@dataset(
    "mart", grain=["screen_id", "benefit_name", "white_label_id"], partition_by=["white_label_id"], sort_by=["screen_id"]
)
def mart_qualified_benefits(c: Catalog) -> DataFrame:
    """Programs with a positive value in a screen's latest snapshot."""
    screens = c["mart_screener_data"].select(
        F.col("id").alias("screen_id"),
        F.col("latest_snapshot_id").alias("eligibility_snapshot_id"),
        "white_label_id",
        *SCREEN_SLICE,
    )
    eligible = c["stg_program_eligibility"].where("annual_value > 0")
    eligible = eligible.select(
        "eligibility_snapshot_id", F.col("name_abbreviated").alias("benefit_name"), "white_label_id"
    )
    matched = screens.join(eligible, ["eligibility_snapshot_id", "white_label_id"]).drop("eligibility_snapshot_id")
    names = named_programs(c).drop("program_id")
    joined = matched.join(names, ["benefit_name", "white_label_id"], "left")
    return joined.withColumn("benefit_display_name", F.coalesce("benefit_display_name", "benefit_name"))


@dataset("mart", grain=["referrer_code", "white_label_id"])
def mart_referrer_codes(c: Catalog) -> DataFrame:
    tenants = c["stg_white_label"].select("white_label_id", "white_label_code")
    return c["stg_referrer_codes"].join(tenants, "white_label_id")


@dataset("mart", grain=["id"], partition_by=["white_label_id"], sort_by=["screener_id", "id"])
def mart_screener_expense(c: Catalog) -> DataFrame:
    screens = _screens(c, "submission_date", "white_label_id")
    expenses = lookup_join(c["stg_expenses"], screens, ["screen_id"], "inner")
    return expenses.withColumn("screener_id", F.col("screen_id"))


