"""The screener step list: slug, label and position in each funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Slug, label, rank in the shared funnel, rank in the combined
# energy-program funnel (None keeps a step off that funnel).
STEPS = [
    ("language", "Language", 1, 1),
    ("disclaimer", "Disclaimer", 2, 2),
    ("select-state", "Select State", None, None),
    ("cesn-energy-expenses", "Energy Expenses", None, None),
    ("zip-code", "Zip Code", 3, 3),
    ("household-size", "Household Size", 4, 4),
    ("member-basics", "Member Basics", None, None),
    ("member-details", "Member Details", 5, 5),
    ("household-members", "Household & Member Details", None, None),
    ("household-basics", "Household Basics", None, None),
    ("cesn-electric-provider", "Electric Provider", None, 6),
    ("cesn-gas-provider", "Gas Provider", None, 7),
    ("cesn-utility-status", "Utility Status", None, 8),
    ("cesn-appliances", "Appliances", None, None),
    ("expenses", "Expenses", 6, None),
    ("assets", "Assets", 7, None),
    ("current-benefits", "Current Benefits", 8, 9),
    ("additional-resources", "Additional Resources", 9, None),
    ("referral-source", "Referral Source", None, None),
    ("sign-up", "Sign Up", 10, None),
    ("confirm-information", "Confirm Information", 11, 10),
    ("results", "Reached Results", 12, 11),
]

FORM_START = "__form_start__"
FORM_COMPLETE = "__form_complete__"
SYNTHETIC_LABELS = {FORM_START: "Started Screener", FORM_COMPLETE: "Reached Results"}
RESULTS_RANK = next(rank for slug, _, rank, _ in STEPS if slug == "results")

_LADDER_SCHEMA = "screener_step_name string, screener_step_label string, funnel_rank long"


def sql_literal(x: str | int) -> str:
    return str(x) if isinstance(x, int) else "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_map(pairs: dict) -> Column:
    """A constant map; lookups stay inside the projection."""
    return F.expr("map(" + ", ".join(sql_literal(x) for pair in pairs.items() for x in pair) + ")")


def lookup(pairs: dict, key: Column, default: Column | None = None) -> Column:
    found = F.element_at(literal_map(pairs), key)
    return found if default is None else F.coalesce(found, default)


def step_label(step: Column) -> Column:
    """Label of a step slug; unknown slugs label themselves."""
    return lookup({slug: label for slug, label, _, _ in STEPS}, step, step)


def funnel_step_label(step: Column) -> Column:
    return F.coalesce(lookup(SYNTHETIC_LABELS, step), step_label(step))


def shared_rank(step: Column) -> Column:
    return lookup({s: r for s, _, r, _ in STEPS if r is not None}, step)


def energy_rank(step: Column) -> Column:
    return lookup({s: r for s, _, _, r in STEPS if r is not None}, step)


def shared_ladder(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(s, label, r) for s, label, r, _ in STEPS], _LADDER_SCHEMA)


def energy_ladder(spark: SparkSession) -> DataFrame:
    rungs = [(FORM_START, SYNTHETIC_LABELS[FORM_START], 0)]
    rungs += [(s, label, r) for s, label, _, r in STEPS if r is not None]
    return spark.createDataFrame(rungs, _LADDER_SCHEMA)
