"""Dashboard queries on the screen marts.

Each takes the catalog and the optional filters; tenant, partner and global
dashboards differ in the filters only.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenmart.catalog import Catalog
from screenmart.functions.numbers import banded, monthly_amount, round_ratio, share, upper_bounded
from screenmart.functions.steps import lookup
from screenmart.functions.text import NEEDS
from screenmart.operators.median import exact_median, medians_in_a_row
from screenmart.operators.scope import ScreenFilters

ALL = ScreenFilters()

MONEY = "decimal(18,2)"

# Display names of expense and income types.
EXPENSE_TYPES = {
    "rent": "Rent",
    "mortgage": "Mortgage",
    "childCare": "Child Care",
    "childSupport": "Child Support",
    "dependentCare": "Dependent Care",
    "medical": "Medical",
    "heating": "Heating",
    "telephone": "Telephone",
}
INCOME_TYPES = {
    "wages": "Wages",
    "selfEmployment": "Self Employment",
    "sSDisability": "SS Disability",
    "sSRetirement": "SS Retirement",
    "SSI": "SSI",
    "sSDependent": "SS Dependent",
    "sSSurvivor": "SS Survivor",
    "unemployment": "Unemployment",
    "pension": "Pension",
    "investmentIncome": "Investment Income",
    "rental": "Rental",
    "alimony": "Alimony",
    "childSupport": "Child Support",
    "DIVABenefits": "VA Disability",
    "workersComp": "Workers Comp",
    "giftedIncome": "Gifted Income",
    "boarder": "Boarder",
    "cOWorks": "CO Works",
}


def screens(c: Catalog, f: ScreenFilters) -> DataFrame:
    return f.apply(c["mart_screener_data"])


def n_screens(c: Catalog, f: ScreenFilters) -> Column:
    return screens(c, f).agg(F.count(F.lit(1)).alias("n")).scalar()


def restrict(c: Catalog, df: DataFrame, f: ScreenFilters, key: str = "screener_id") -> DataFrame:
    """Rows whose screen passes the filters.

    Every row of the child marts belongs to a screen, so without filters there is
    nothing to join.
    """
    if f.is_empty:
        return df
    return df.join(screens(c, f).select(F.col("id").alias(key)), key, "left_semi")


# --- money streams --------------------------------------------------------------


def _streams(c: Catalog, f: ScreenFilters, mart: str, labels: dict[str, str], hours: bool) -> DataFrame:
    rows = restrict(c, c[mart], f).where("amount > 0")
    worked = F.col("hours_worked") if hours else None
    rows = rows.select("type", "screener_id", monthly_amount(F.col("amount"), F.col("frequency"), worked).alias("m"))
    people = rows.groupBy("type", "screener_id").agg(F.lit(1).alias("one")).groupBy("type")
    people = people.agg(F.count("screener_id").alias("screeners"))
    medians = exact_median(rows, F.col("m"), ["type"], "median_amount").withColumnRenamed("type", "_type")
    joined = people.join(medians, F.col("type").eqNullSafe(F.col("_type")), "left")
    return joined.select(
        lookup(labels, F.col("type"), F.col("type")).alias("type"),
        share("screeners", n_screens(c, f)).alias("share_of_screeners"),
        "median_amount",
        "screeners",
    ).orderBy(F.desc("screeners"), "type")


def common_expenses(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    """Expense types with the share of screeners and the median month value."""
    return _streams(c, f, "mart_screener_expense", EXPENSE_TYPES, hours=False)


def income_streams(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    return _streams(c, f, "mart_income", INCOME_TYPES, hours=True)


# --- benefits -------------------------------------------------------------------


def _benefit_table(c: Catalog, f: ScreenFilters, mart: str) -> DataFrame:
    rows = restrict(c, c[mart], f, "screen_id")
    per = rows.groupBy("benefit_name", "screen_id").agg(F.max("benefit_display_name").alias("shown"))
    out = per.groupBy("benefit_name").agg(
        F.max("shown").alias("benefit"), F.count("screen_id").alias("screeners")
    )
    return (
        out.where("screeners > 0")
        .select("benefit", "screeners", share("screeners", n_screens(c, f)).alias("share_of_screeners"))
        .orderBy(F.desc("screeners"), "benefit")
    )


def current_benefits(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    return _benefit_table(c, f, "mart_current_benefits")


def qualified_benefits(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    return _benefit_table(c, f, "mart_qualified_benefits")


# --- shares and distributions -----------------------------------------------------


def _ranked_with_total(c: Catalog, f: ScreenFilters, column: str, keep: Column) -> DataFrame:
    rows = screens(c, f)
    counts = rows.where(keep).groupBy(F.col(column).alias("name")).agg(F.count(F.lit(1)).alias("screeners"))
    total = rows.agg(F.count(F.lit(1)).alias("screeners"))
    named = counts.select(
        F.lit(0).alias("sort_order"), "name", "screeners", share("screeners", total.scalar()).alias("share_of_screeners")
    )
    last = total.select(
        F.lit(1).alias("sort_order"),
        F.lit("Total").alias("name"),
        "screeners",
        F.when(F.col("screeners") != 0, F.lit(1.0)).alias("share_of_screeners"),
    )
    return named.unionByName(last).orderBy("sort_order", F.desc("screeners"), "name")


def top_counties(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    return _ranked_with_total(c, f, "county", F.col("county") != "")


def top_partners(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    return _ranked_with_total(c, f, "partner", F.lit(True))


def _distribution(rows: DataFrame, label: Column, order: Column) -> DataFrame:
    """Share of rows per band; the total is the sum over the few bands."""
    bands = rows.groupBy(label.alias("band"), order.alias("sort_order")).agg(F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.count(F.lit(1)).alias("n"))
    return bands.select("band", "sort_order", share("n", total.scalar()).alias("share_of_total")).orderBy("sort_order")


# Upper bounds (exclusive) and names of the bands.
INCOME_BANDS = [
    (15000, "$0-15K"),
    (30000, "$15-30K"),
    (45000, "$30-45K"),
    (60000, "$45-60K"),
    (75000, "$60-75K"),
    (100000, "$75-100K"),
]
ASSET_BANDS = [(1000, "$0-1K"), (2000, "$1-2K"), (5000, "$2-5K"), (10000, "$5-10K"), (50000, "$10-50K")]
HEAD_AGES = [("0-18", 0, 18), ("19-24", 19, 24), ("25-44", 25, 44), ("45-64", 45, 64)]
MEMBER_AGES = [("5-18", 5, 18), ("19-24", 19, 24), ("25-44", 25, 44), ("45-64", 45, 64)]


def income_distribution(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    rows = screens(c, f).where("monthly_income is not null")
    return _distribution(rows, *upper_bounded(F.col("monthly_income") * 12, INCOME_BANDS, "$100K+"))


def assets_distribution(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    rows = screens(c, f).where("household_assets is not null")
    return _distribution(rows, *upper_bounded(F.col("household_assets"), ASSET_BANDS, "$50K+"))


def _members(c: Catalog, f: ScreenFilters) -> DataFrame:
    return restrict(c, c["mart_householdmembers"], f)


def _age_bands(ages: list[tuple[str, int, int]], first: list[tuple[str, Column]]) -> tuple[Column, Column]:
    age = F.col("age")
    bands = [*first, *[(name, age.between(low, high)) for name, low, high in ages], ("65+", age >= 65)]
    return banded(age, bands)


def head_ages(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    heads = _members(c, f).where("relationship = 'headOfHousehold' and age is not null")
    return _distribution(heads, *_age_bands(HEAD_AGES, []))


def member_ages(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    members = _members(c, f).where("age is not null")
    return _distribution(members, *_age_bands(MEMBER_AGES, [("<5", F.col("age") < 5)]))


def household_sizes(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    size = F.col("household_size")
    label = F.when(size >= 8, "8+").otherwise(size.cast("string"))
    return _distribution(screens(c, f), label, F.when(size >= 8, 8).otherwise(size))


def household_languages(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    rows = screens(c, f)
    out = rows.groupBy(F.col("request_language_code").alias("language")).agg(F.count(F.lit(1)).alias("n"))
    return out.select("language", share("n", n_screens(c, f)).alias("share_of_total"), "n").orderBy(
        F.desc("n"), "language"
    )


def immediate_needs(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    """Needs somebody flagged; one pass over the screens for all of them."""
    counts = screens(c, f).agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(need).alias(name) for need, name in NEEDS.items()]
    )
    rows = counts.unpivot(["total"], list(NEEDS.values()), "need", "screeners").where("screeners > 0")
    return rows.select("need", "screeners", share("screeners", "total").alias("share_of_screeners")).orderBy(
        F.desc("screeners"), "need"
    )


def disabled_share(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    """Members with any disability flag among those who answered at least one."""
    flags = ["disabled", "visually_impaired", "long_term_disability"]
    answered = _members(c, f).where(F.coalesce(*flags).isNotNull())
    yes = F.greatest(*flags)
    return answered.agg(share(F.count_if(yes), F.count(F.lit(1))).alias("pct"))


def young_adult_share(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    members = _members(c, f).where("age is not null")
    return members.agg(share(F.count_if(F.col("age").between(19, 24)), F.count(F.lit(1))).alias("pct"))


def monthly_active_users(c: Catalog, state_codes: list[str]) -> DataFrame:
    """Distinct visitors per month of the pages of some states."""
    views = c["int_ga4_page_views"].where(F.col("state_code").isin(state_codes))
    month = F.trunc("event_date_parsed", "MM").alias("month")
    users = views.select(month, "user_pseudo_id").distinct()
    return users.groupBy("month").agg(F.count("user_pseudo_id").alias("active_users")).orderBy("month")


# --- single numbers -----------------------------------------------------------------

OTHER, TAX = "non_tax_credit_benefits_annual", "tax_credits_annual"


def household_value() -> Column:
    return F.col(OTHER) + F.col(TAX)


def completed_screeners(c: Catalog, f: ScreenFilters = ALL, where: str = "true") -> DataFrame:
    return screens(c, f).where(where).agg(F.count(F.lit(1)).alias("screeners"))


def share_of_screens(c: Catalog, f: ScreenFilters, cond: Column, where: str = "true") -> DataFrame:
    return screens(c, f).where(where).agg(share(F.count_if(cond), F.count(F.lit(1))).alias("pct"))


def already_had_benefits(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    return share_of_screens(c, f, F.col("has_benefits") == "true")


def qualified_share(c: Catalog, f: ScreenFilters = ALL, where: str = "true") -> DataFrame:
    return share_of_screens(c, f, F.col(OTHER) > 0, where)


def qualified_tax_share(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    return share_of_screens(c, f, F.col(TAX) > 0)


def median_of(c: Catalog, f: ScreenFilters, value: Column, where: str | Column = "true") -> DataFrame:
    return exact_median(screens(c, f).where(where), value)


def median_annual_benefits(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    return median_of(c, f, F.col(OTHER), F.col(OTHER) > 0)


def median_monthly_benefits(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    return median_of(c, f, F.col(OTHER).cast("double") / F.lit(12.0), F.col(OTHER) > 0)


def median_annual_tax_credits(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    return median_of(c, f, F.col(TAX), F.col(TAX) > 0)


def median_household_size(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    return median_of(c, f, F.col("household_size"))


def median_household_assets(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    return median_of(c, f, F.col("household_assets"))


def median_annual_income(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    return median_of(c, f, F.col("monthly_income") * 12)


def median_monthly_income(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    return median_of(c, f, F.col("monthly_income"))


def median_monthly_expenses(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    return median_of(c, f, F.col("monthly_expenses"))


def median_numbers(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    """The five medians of a household from one scan of the screens."""
    values = {
        "household_size": F.col("household_size"),
        "household_assets": F.col("household_assets"),
        "annual_income": F.col("monthly_income") * 12,
        "monthly_income": F.col("monthly_income"),
        "monthly_expenses": F.col("monthly_expenses"),
    }
    return medians_in_a_row(screens(c, f), values)


def total_of(c: Catalog, f: ScreenFilters, value: Column, kind: str, where: str = "true") -> DataFrame:
    total = F.coalesce(F.sum(value), F.lit(0)).cast(kind)
    return screens(c, f).where(where).agg(total.alias("total"))


def total_individuals(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    return total_of(c, f, F.col("household_size"), "bigint")


def total_all_benefits(c: Catalog, f: ScreenFilters = ALL, where: str = "true") -> DataFrame:
    return total_of(c, f, household_value(), "decimal(28,2)", where)


def total_benefits(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    return total_of(c, f, F.col(OTHER), "decimal(28,2)")


def total_tax_credits(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    return total_of(c, f, F.col(TAX), "decimal(28,2)")


# --- by day and month ----------------------------------------------------------------


def daily_screeners(c: Catalog, f: ScreenFilters = ALL, where: str = "true", as_of: date | None = None) -> DataFrame:
    """Screens per submission day; with ``as_of`` only the seven days up to it and later."""
    rows = screens(c, f).where(where)
    if as_of is not None:
        rows = rows.where(F.col("submission_date") >= F.date_sub(F.lit(as_of), 6))
    return rows.groupBy("submission_date").agg(F.count(F.lit(1)).alias("screeners")).orderBy("submission_date")


def monthly_screeners(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    month = F.trunc("submission_date", "MM").alias("month")
    return screens(c, f).groupBy(month).agg(F.count(F.lit(1)).alias("screeners")).orderBy("month")


# --- filter value lists ----------------------------------------------------------------


def partner_values(c: Catalog) -> DataFrame:
    """Partners to offer: those seen on screens, less known non-partners, plus all known partners."""
    codes = c["mart_referrer_codes"].where("partner is not null")
    hidden = codes.where("not is_partner").select("partner")
    seen = c["mart_screener_data"].where("partner is not null").select("partner").distinct()
    offered = seen.join(hidden, "partner", "left_anti").unionByName(codes.where("is_partner").select("partner"))
    return offered.distinct().orderBy("partner")


def column_values(c: Catalog, column: str) -> DataFrame:
    return c["mart_screener_data"].where(F.col(column) != "").select(column).distinct().orderBy(column)


# --- energy program: homeowners and renters -----------------------------------------------

OWNERS, RENTERS = "is_home_owner", "is_renter"


def top_providers(c: Catalog, f: ScreenFilters, who: str, kind: str, k: int = 20) -> DataFrame:
    """The ``k`` providers most screens name; ties by name."""
    provider = F.coalesce(f"{kind}_name", kind)
    rows = screens(c, f).where(who).where(F.col(kind).isNotNull())
    counts = rows.groupBy(provider.alias("provider")).agg(F.count(F.lit(1)).alias("screeners"))
    return counts.orderBy(F.desc("screeners"), "provider").limit(k)


def yes_no(c: Catalog, f: ScreenFilters, who: str, flag: str) -> DataFrame:
    rows = screens(c, f).where(who).where(F.col(flag).isNotNull())
    answer = F.when(F.col(flag), "Yes").otherwise("No")
    return rows.groupBy(answer.alias("answer")).agg(F.count(F.lit(1)).alias("screeners")).orderBy("answer")


# --- partner dashboards -------------------------------------------------------------------

# Band limits and labels.
HOUSEHOLD_VALUE_BANDS = [
    (5000, "$1-$4,999"),
    (10000, "$5,000-$9,999"),
    (20000, "$10,000-$19,999"),
    (40000, "$20,000-$39,999"),
]


def highest_household_value(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    return screens(c, f).agg(F.coalesce(F.max(household_value()), F.lit(0)).cast(MONEY).alias("highest"))


def lowest_household_value(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    """Lowest value among the households that matched anything."""
    matched = screens(c, f).where(household_value() > 0)
    return matched.agg(F.coalesce(F.min(household_value()), F.lit(0)).cast(MONEY).alias("lowest"))


def median_household_value(c: Catalog, f: ScreenFilters = ALL, where: str = "true") -> DataFrame:
    return exact_median(screens(c, f).where(where).where(household_value() > 0), household_value())


def median_monthly_household_value(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    matched = screens(c, f).where(household_value() > 0)
    return exact_median(matched, household_value().cast("double") / F.lit(12.0))


def household_value_distribution(c: Catalog, f: ScreenFilters = ALL) -> DataFrame:
    value = household_value()
    bands = [("$0", value == 0), *[(name, value < bound) for bound, name in HOUSEHOLD_VALUE_BANDS]]
    label, order = banded(value, bands, "$40,000+")
    rows = screens(c, f).groupBy(label.alias("bucket"), order.alias("sort_order"))
    return rows.agg(F.count(F.lit(1)).alias("households")).orderBy("sort_order").drop("sort_order")


def average_programs(c: Catalog, f: ScreenFilters = ALL, where: str = "true") -> DataFrame:
    rows = screens(c, f).where(where)
    return rows.agg(round_ratio(F.sum("programs_matched"), F.count("programs_matched"), 1).alias("avg_programs"))
