"""Who may see what, and which slice of it a card shows."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenmart.catalog import Catalog, Options
from screenmart.functions.text import STATE_SLUGS

# Fixed value: naming rule of tenant read-only roles.
TENANT_ROLE_PATTERN = r"^wl_[a-z_]+_([0-9]+)_ro$"

ENERGY_PROGRAM = "cesn"


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def tenant_from_setting(value: str | None) -> int | None:
    """Tenant id from a session setting; blank or unset means nobody."""
    text = (value or "").strip(" ")
    return int(text) if text else None


def tenant_from_role(role: str | None) -> int | None:
    """Tenant id from a role name; a name off the rule means nobody."""
    found = re.match(TENANT_ROLE_PATTERN, role or "")
    return int(found.group(1)) if found else None


def scope_to_tenant(df: DataFrame, tenant_id: int | None, column: str = "white_label_id") -> DataFrame:
    """Rows of one tenant; no tenant, no rows. Prunes tenant partitions."""
    if tenant_id is None:
        return df.where(F.lit(False))
    return df.where(F.col(column) == F.lit(tenant_id))


@dataclass(frozen=True)
class TenantCatalog:
    """A catalog as one tenant sees it: every table with a tenant column holds that tenant's rows alone.

    The condition meets the stored marts at their scan and prunes tenant partitions. Without a
    tenant there are no rows.
    """

    catalog: Catalog
    tenant_id: int | None

    def __getitem__(self, name: str) -> DataFrame:
        df = self.catalog[name]
        return scope_to_tenant(df, self.tenant_id) if "white_label_id" in df.columns else df

    def source(self, name: str) -> DataFrame:
        return self.catalog.source(name)

    @property
    def options(self) -> Options:
        return self.catalog.options


@dataclass(frozen=True)
class ScreenFilters:
    """Optional dashboard filters; an absent one adds no predicate."""

    submitted_from: date | None = None
    submitted_to: date | None = None
    partner: tuple[str, ...] = ()
    county: tuple[str, ...] = ()
    utm_campaign: tuple[str, ...] = ()
    utm_medium: tuple[str, ...] = ()
    utm_source: tuple[str, ...] = ()
    referrer_code: tuple[str, ...] = ()

    @property
    def is_empty(self) -> bool:
        return self == ScreenFilters()

    def conditions(self) -> list[Column]:
        out = []
        if self.submitted_from is not None:
            out.append(F.col("submission_date") >= F.lit(self.submitted_from))
        if self.submitted_to is not None:
            out.append(F.col("submission_date") <= F.lit(self.submitted_to))
        for name in ("partner", "county", "utm_campaign", "utm_medium", "utm_source", "referrer_code"):
            values = getattr(self, name)
            if values:
                out.append(F.col(name).isin(list(values)))
        return out

    def apply(self, df: DataFrame) -> DataFrame:
        return df.where(all_of(self.conditions()))


@dataclass(frozen=True)
class EventScope:
    """State scope and date window of the event cards.

    With a tenant every form below is the same state list. Without one the forms
    differ: ``plain`` keeps the known states, ``flagged`` also rows before a state
    is known but no energy-program session, ``site`` also rows without a state.
    """

    epoch: date
    tenant_states: tuple[str, ...] | None = None
    start: date | None = None
    end: date | None = None

    @property
    def _known(self) -> Column:
        states = self.tenant_states
        if states is None:
            states = tuple(s for s in STATE_SLUGS if s != ENERGY_PROGRAM)
        return F.col("screener_state").isin(list(states))

    def plain(self) -> Column:
        return self._known

    def flagged(self) -> Column:
        if self.tenant_states is not None:
            return self._known
        return ~F.col("is_cesn") & (self._known | F.col("screener_state").isNull())

    def site(self) -> Column:
        if self.tenant_states is not None:
            return self._known
        return self._known | F.col("screener_state").isNull()

    def window(self, column: str = "event_date_parsed") -> Column:
        day = F.col(column)
        conditions = [day >= F.lit(self.epoch)]
        if self.start is not None:
            conditions.append(day >= F.lit(self.start))
        if self.end is not None:
            conditions.append(day <= F.lit(self.end))
        return all_of(conditions)

    def days(self, column: str = "event_date") -> Column:
        """The same window over the day as text (yyyyMMdd), the form tables are split by."""
        day, conditions = F.col(column), [F.col(column) >= F.lit(f"{self.epoch:%Y%m%d}")]
        if self.start is not None:
            conditions.append(day >= F.lit(f"{self.start:%Y%m%d}"))
        if self.end is not None:
            conditions.append(day <= F.lit(f"{self.end:%Y%m%d}"))
        return all_of(conditions)
