"""Typed columns out of key/value event parameters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenmart.functions.steps import sql_literal

EVENT_KEY = [
    "event_date", "event_timestamp", "event_name", "user_pseudo_id", "user_id",
    "event_bundle_sequence_id", "batch_event_index",
]

# How each parameter type reads the value record ``{v}``.
READERS = {
    "string": "{v}.string_value",
    "int": "{v}.int_value",
    "id": "coalesce(cast({v}.int_value as string), {v}.string_value)",
    "loose_int": "coalesce({v}.int_value, try_cast({v}.string_value as bigint))",
    "number": "coalesce({v}.double_value, cast({v}.int_value as double))",
}

SESSION = {"ga_session_id": "int"}
SCREENING = {**SESSION, "screener_state": "string", "screener_uid": "string"}


KEYS, VALUES = "event_params.key", "event_params.value"


def param_first(key: str, kind: str = "string") -> Column:
    """Value of a parameter's first occurrence within the event; NULL when it is absent."""
    at = f"get({VALUES}, cast(array_position({KEYS}, {sql_literal(key)}) as int) - 1)"
    return F.expr(READERS[kind].format(v=at))


def _largest(params: dict[str, tuple[str, str]]) -> Column:
    """All parameters of an event in one walk over the array: the largest value of each."""
    kinds = {"string": "string", "id": "string", "int": "bigint", "loose_int": "bigint", "number": "double"}
    fields = {f"p{i}": key_and_kind for i, key_and_kind in enumerate(params.values())}
    none = ", ".join(f"cast(null as {kinds[kind]}) as {f}" for f, (_, kind) in fields.items())
    step = ", ".join(
        f"if(p.key = {sql_literal(key)}, greatest(t.{f}, {READERS[kind].format(v='p.value')}), t.{f}) as {f}"
        for f, (key, kind) in fields.items()
    )
    return F.expr(f"aggregate(event_params, struct({none}), (t, p) -> struct({step}))")


@dataclass(frozen=True)
class EventFamily:
    """Event names that share one set of typed parameters.

    ``params`` maps an output column to (parameter key, type); ``key`` names the
    columns that identify an event.
    """

    names: Sequence[str]
    params: dict[str, tuple[str, str]]
    key: Sequence[str] = field(default_factory=lambda: list(EVENT_KEY))


def typed(**kinds: str) -> dict[str, tuple[str, str]]:
    return {name: (name, kind) for name, kind in kinds.items()}


def of_family(events: DataFrame, family: EventFamily) -> DataFrame:
    return events.where(F.col("event_name").isin(list(family.names)))


def typed_params(events: DataFrame, keep: Sequence[str], params: dict[str, tuple[str, str]]) -> DataFrame:
    """The columns ``keep`` and one column per parameter: its largest value within the event, NULL when it is absent.

    The keys of an event are laid out once as an array in which all parameters find their place, and their
    value is read there: plain expressions that stay in generated code. Events that repeat a key, which are rare, are
    walked over once, all parameters together.
    """
    repeats = f"size(array_distinct({KEYS})) < size(event_params)"
    walked = events.select(*keep, F.expr(KEYS).alias("_keys"), F.expr(VALUES).alias("_values"), F.when(F.expr(repeats), _largest(params)).alias("_walked"))

    def value(i: int, key: str, kind: str) -> Column:
        at = f"get(_values, cast(array_position(_keys, {sql_literal(key)}) as int) - 1)"
        return F.expr(f"if(_walked is not null, _walked.p{i}, {READERS[kind].format(v=at)})")

    return walked.select(*keep, *[value(i, key, kind).alias(out) for i, (out, (key, kind)) in enumerate(params.items())])


def pivot_params(events: DataFrame, family: EventFamily) -> DataFrame:
    """One row per event key with a column per parameter.

    Parameters are read inside the row, so the shuffle carries one narrow row per
    event instead of one per parameter. The grouping merges events whose whole key
    is equal; events without parameters do not exist downstream.
    """
    wide = typed_params(of_family(events, family).where(F.size("event_params") > 0), family.key, family.params)
    return wide.groupBy(*family.key).agg(*[F.max(out).alias(out) for out in family.params])


def event_day(c: str = "event_date") -> Column:
    return F.to_date(F.col(c), "yyyyMMdd")


def exploded_items(events: DataFrame, list_names: Sequence[str], columns: dict[str, Column]) -> DataFrame:
    """One row per item of the named lists; ``off`` is the position in the event."""
    rows = events.where(F.col("event_name") == "view_item_list").select(
        *[value.alias(name) for name, value in columns.items()], F.posexplode("items").alias("off", "item")
    )
    return rows.where(F.col("item.item_list_name").isin(list(list_names)))
