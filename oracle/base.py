"""Composition of check queries out of named SELECTs, in DuckDB's dialect.

The raw-table statements are shared with the sample adapter (they define the
input); everything computed from them is written here independently.
"""

from __future__ import annotations

import re

from screenmart.functions.steps import STEPS
from screenmart.functions.text import LANGUAGES
from screenmart.sources.sample import EVENT_KEYS, PARAM_COLUMNS, RAW_TABLES, STATEMENTS

EPOCH = "20240108"
EPOCH_DATE = "DATE '2024-01-08'"

DUCKDB_DIALECT = {
    "json_k": "cast(json_extract_string(props, '$.k') as int)",
    "micros_ts": "epoch_us(ts)",
}

CTES: dict[str, str] = {}


def _raw_statements() -> None:
    for name, text in STATEMENTS.items():
        for key, sql in DUCKDB_DIALECT.items():
            text = text.replace("{" + key + "}", sql)
        for ref in [*RAW_TABLES, *STATEMENTS]:
            text = text.replace("{" + ref + "}", ref)
        CTES[name] = text


_raw_statements()


def define(**selects: str) -> None:
    CTES.update(selects)


def _uses(text: str) -> list[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", re.sub(r"'[^']*'", "", text)))
    return [name for name in CTES if name in words]


def compose(select: str) -> str:
    """``WITH`` everything the select needs, in dependency order."""
    order: list[str] = []

    def visit(text: str, path: tuple[str, ...]) -> None:
        for name in _uses(text):
            if name not in order and name not in path:
                visit(CTES[name], (*path, name))
                order.append(name)

    visit(select, ())
    if not order:
        return select
    parts = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name]})" for name in order)
    return f"WITH {parts}\n{select}"


def pct(num: str, den: str, places: int = 1, scale: int = 100) -> str:
    """Half-up rounded ratio by integer arithmetic; NULL for a zero denominator."""
    unit = 10**places
    n, d = f"CAST(({num}) AS HUGEINT)", f"NULLIF(CAST(({den}) AS HUGEINT), 0)"
    return f"(CAST(({n} * {2 * unit * scale} + {d}) // ({d} * 2) AS DOUBLE) / CAST({unit} AS DOUBLE))"


def ratio(num: str, den: str, places: int) -> str:
    return pct(num, den, places, 1)


def share(num: str, den: str) -> str:
    return f"(CAST(({num}) AS DOUBLE) / CAST(NULLIF(({den}), 0) AS DOUBLE))"


def median(value: str, where: str = "TRUE") -> str:
    """Middle of the sorted values, the mean of both middles for an even count."""
    v = f"list(CAST({value} AS DOUBLE) ORDER BY CAST({value} AS DOUBLE)) FILTER (WHERE ({value}) IS NOT NULL AND ({where}))"
    n = f"count({value}) FILTER (WHERE ({where}))"
    return f"(({v})[({n} + 1) // 2] + ({v})[{n} // 2 + 1]) / 2"


def case_map(column: str, pairs: dict[str, str], default: str) -> str:
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    whens = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in pairs.items())
    return f"CASE {column} {whens} ELSE {default} END"


def step_label(column: str) -> str:
    return case_map(column, {slug: label for slug, label, _, _ in STEPS}, column)


def language(column: str) -> str:
    return case_map(column, LANGUAGES, "'(blank)'")


def values(rows: list[tuple]) -> str:
    def lit(x) -> str:
        if x is None:
            return "NULL"
        return str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(lit(x) for x in row) + ")" for row in rows)


def flat_event_columns() -> str:
    """Typed event columns out of the flat sample columns."""
    special = {
        "program_id": "coalesce(cast(program_id__i as varchar), program_id__s) as program_id",
        "navigator_id": "coalesce(cast(navigator_id__i as varchar), navigator_id__s) as navigator_id",
        "depth": "coalesce(depth__i, try_cast(depth__s as bigint)) as depth",
        "score": "coalesce(score__i, try_cast(score__s as bigint)) as nps_score",
        "total_estimated_value": (
            "coalesce(total_estimated_value__d, cast(total_estimated_value__i as double)) as total_estimated_value"
        ),
    }
    renamed = {
        "medium": "session_medium", "source": "session_source", "campaign": "session_campaign",
        "outbound": "is_outbound", "channel": "feedback_channel", "network": "social_network",
    }
    out = []
    for column in PARAM_COLUMNS:
        name = column.rsplit("__", 1)[0]
        if name in special:
            if special[name] not in out:
                out.append(special[name])
        else:
            out.append(f"{column} as {renamed.get(name, name)}")
    return ", ".join(out)


def has_params() -> str:
    return "coalesce(" + ", ".join(f"cast({c} as varchar)" for c in PARAM_COLUMNS) + ") is not null"


KEYS = ", ".join(EVENT_KEYS)
