"""The rules that raw tables, staging views and marts keep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from screenmart.catalog import REGISTRY, Catalog
from screenmart.functions.text import NEEDS
from screenmart.operators.rules import Rule, accepted, combination, not_null, relation, unique

# How often an income is paid.
INCOME_FREQUENCIES = ["yearly", "monthly", "weekly", "hourly", "biweekly", "semimonthly"]


def _of_screens(table: str) -> list[Rule]:
    return [*unique(table, "id"), *not_null(table, "id", "screen_id"), *relation(table, "screen_id", "screener_screen")]


SOURCE_RULES = [
    *not_null("screener_screen", "completed"),
    *not_null("screener_current_benefits", "screen_id", "program_id"),
    *relation("screener_current_benefits", "screen_id", "screener_screen"),
    *relation("screener_current_benefits", "program_id", "programs_program"),
    *_of_screens("screener_incomestream"),
    *not_null("screener_incomestream", "amount"),
    *_of_screens("screener_expense"),
    *not_null("screener_expense", "amount"),
    *_of_screens("screener_householdmember"),
    *_of_screens("screener_energycalculatorscreen"),
]

STAGING_RULES = [
    *not_null("stg_current_benefits", "screen_id", "program_id"),
    *not_null("stg_referrer_codes", "partner", "white_label_id"),
    *relation("stg_referrer_codes", "white_label_id", "screener_whitelabel"),
    *combination("stg_referrer_codes", "referrer_code", "white_label_id"),
    *not_null("int_immediate_needs", "white_label_id", "partner", *NEEDS),
]

MART_RULES = [
    *not_null("mart_immediate_needs", "white_label_id", "partner", "benefit", "count", "county"),
    *combination("mart_qualified_benefits", "screen_id", "benefit_name"),
    *not_null("mart_qualified_benefits", "screen_id", "white_label_id", "benefit_display_name", "benefit_name", "county"),
    *combination("mart_current_benefits", "screen_id", "benefit_name"),
    *not_null("mart_current_benefits", "screen_id", "white_label_id", "benefit_name", "benefit_display_name"),
    *unique("mart_householdmembers", "id"),
    *not_null("mart_householdmembers", "id", "screener_id", "white_label_id", "partner", "county", "screen_id", "frontend_id"),
    *unique("mart_income", "id"),
    *not_null("mart_income", "id", "screen_id", "screener_id", "submission_date", "white_label_id", "type", "amount", "frequency"),
    *accepted("mart_income", "frequency", INCOME_FREQUENCIES),
]

RULES = [*SOURCE_RULES, *STAGING_RULES, *MART_RULES]


class CatalogTables:
    """Datasets and sources of a catalog under one roof."""

    def __init__(self, catalog: Catalog):
        self.catalog = catalog

    @property
    def spark(self) -> SparkSession:
        return self.catalog.spark

    def __getitem__(self, name: str) -> DataFrame:
        return self.catalog[name] if name in REGISTRY else self.catalog.source(name)


def rules_of(name: str) -> list[Rule]:
    return [rule for rule in RULES if rule.table == name]
