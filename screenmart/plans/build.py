"""The nightly build: every staged family, intermediate and mart as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from screenmart.catalog import REGISTRY, Catalog
from screenmart.operators.rules import Staged, enforce
from screenmart.plans import distinct_marts, event_marts, event_staging, firstgen, relational
from screenmart.plans.rules import CatalogTables, rules_of
from screenmart.sources.sinks import refresh

MODULES = (relational, event_staging, event_marts, distinct_marts, firstgen)

# Read by several marts, so written once before them.
SHARED = [
    "stg_latest_eligibility_snapshot",
    "stg_program_eligibility",
    "int_ga4_page_views",
    "int_ga4_sessions",
    "int_screener_program_names",
]


def _named(prefix: str, layer: str | None = None) -> list[str]:
    return [n for n, d in REGISTRY.items() if n.startswith(prefix) and layer in (None, d.layer)]


def relational_order() -> list[str]:
    """The screen mart comes first: its children read the written table."""
    marts = [n for n, d in REGISTRY.items() if d.fn.__module__ == relational.__name__ and d.layer == "mart"]
    marts.remove("mart_screener_data")
    return ["stg_latest_eligibility_snapshot", "stg_program_eligibility", "mart_screener_data", *marts]


def event_order() -> list[str]:
    """Each family is cut out of the raw events once, then the marts read it."""
    families = [*_named("ga_", "rows"), *_named("stg_ga_")]
    shared = [n for n in SHARED if n.startswith("int_")]
    homes = (event_marts.__name__, distinct_marts.__name__)
    marts = [n for n, d in REGISTRY.items() if d.fn.__module__ in homes and d.layer == "mart"]
    return [*families, *shared, *marts]


def first_generation_order() -> list[str]:
    views = [n for n, d in REGISTRY.items() if d.fn.__module__ == firstgen.__name__]
    views.remove("data")
    return ["data", *views]


def build_marts(
    catalog: Catalog, base: str, first_generation: bool = False, workers: int = 4, rules: bool = False
) -> dict[str, str]:
    """Full refresh of all tables under ``base``, several at once; returns their paths.

    With ``rules`` a mart that breaks one of its rules is not published, and the build ends there.
    """
    names = [*relational_order(), *event_order()]
    if first_generation:
        names += first_generation_order()
    return refresh(catalog, names, base, workers, published_by_rules(catalog) if rules else None)


def published_by_rules(catalog: Catalog):
    """The audit that holds a new version of a dataset against its rules before anybody reads it."""

    def audit(name: str, stored: DataFrame) -> None:
        own = rules_of(name)
        if own:
            enforce(Staged(CatalogTables(catalog), name, stored), own)

    return audit
