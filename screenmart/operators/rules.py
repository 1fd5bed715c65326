"""Data rules compiled into one pass per table and one grouped exchange for all of them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NOT_NULL, UNIQUE, COMBINATION, ACCEPTED, RELATION = "not_null", "unique", "unique_combination", "accepted_values", "relationships"


@dataclass(frozen=True)
class Rule:
    """A rule on columns of one table.

    What counts as a failure: a NULL (not_null); a value held by several rows, NULLs apart (unique); a combination of
    values held by several rows, NULLs being values (unique_combination); a value off the list, NULL being
    accepted (accepted_values); a row whose value, if any, no row of the parent has (relationships).
    """

    table: str
    kind: str
    columns: tuple[str, ...]
    accepted: tuple[str, ...] = ()
    parent: tuple[str, str] | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{'_'.join(self.columns)}"


class Tables(Protocol):
    """Where tables are looked up: a dataset by name, else a source."""

    spark: SparkSession

    def __getitem__(self, name: str) -> DataFrame: ...


def not_null(table: str, *columns: str) -> list[Rule]:
    return [Rule(table, NOT_NULL, (c,)) for c in columns]


def unique(table: str, *columns: str) -> list[Rule]:
    return [Rule(table, UNIQUE, (c,)) for c in columns]


def combination(table: str, *columns: str) -> list[Rule]:
    return [Rule(table, COMBINATION, columns)]


def accepted(table: str, column: str, values: Sequence[str]) -> list[Rule]:
    return [Rule(table, ACCEPTED, (column,), accepted=tuple(values))]


def relation(table: str, column: str, parent: str, parent_column: str = "id") -> list[Rule]:
    return [Rule(table, RELATION, (column,), parent=(parent, parent_column))]


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _finding(number: int, key: Column, is_parent: bool = False) -> Column:
    return F.struct(F.lit(number).alias("number"), key.alias("key"), F.lit(is_parent).alias("is_parent"))


def _child(number: int, rule: Rule) -> Column:
    """What a row says on a rule: a failure, a key to compare, or NULL for nothing."""
    value = F.col(rule.columns[0])
    if rule.kind == NOT_NULL:
        return F.when(value.isNull(), _finding(number, F.lit(None).cast("string")))
    if rule.kind == ACCEPTED:
        return F.when(~value.isin(list(rule.accepted)), _finding(number, _text(rule.columns[0])))
    if rule.kind == COMBINATION:
        return _finding(number, F.to_json(F.struct(*rule.columns)))
    return F.when(value.isNotNull(), _finding(number, _text(rule.columns[0])))


def _findings(df: DataFrame, said: list[Column]) -> DataFrame:
    return df.select(F.explode(F.array_compact(F.array(*said))).alias("f")).select("f.*")


def rule_report(tables: Tables, rules: Sequence[Rule]) -> DataFrame:
    """(rule, table_name, kind, failures, passed): one row per rule.

    Each table is read once, whatever the number of its rules, and once more for the keys that others refer to. Rows that
    say nothing (values that are there, keys without a rule) send nothing; the rest meets by (rule, key)
    in one exchange, after partial aggregation, so a key that many rows share costs one entry a task.
    """
    parts = []
    for table in dict.fromkeys(r.table for r in rules):
        parts.append(_findings(tables[table], [_child(i, r) for i, r in enumerate(rules) if r.table == table]))
    for table in dict.fromkeys(r.parent[0] for r in rules if r.parent):
        said = [_finding(i, _text(r.parent[1]), True) for i, r in enumerate(rules) if r.parent and r.parent[0] == table]
        parts.append(_findings(tables[table], said))
    named = [(i, r.name, r.table, r.kind) for i, r in enumerate(rules)]
    listed = tables.spark.createDataFrame(named, "number int, rule string, table_name string, kind string")
    if not parts:
        return listed.selectExpr("rule", "table_name", "kind", "0L as failures", "true as passed")
    found = reduce(DataFrame.unionByName, parts)
    keys = found.groupBy("number", "key").agg(F.count_if(~F.col("is_parent")).alias("rows"), F.bool_or("is_parent").alias("known"))
    by_kind = keys.join(F.broadcast(listed), "number")  # as many rows as rules
    kind, rows = F.col("kind"), F.col("rows")
    failures = (
        F.when(kind.isin(UNIQUE, COMBINATION), (rows > 1).cast("bigint"))
        .when(kind == ACCEPTED, F.lit(1).cast("bigint"))
        .when(kind == RELATION, F.when(F.col("known"), 0).otherwise(rows))
        .otherwise(rows)
    )
    counted = by_kind.groupBy("number").agg(F.sum(failures).alias("failures"))
    out = listed.join(counted, "number", "left").withColumn("failures", F.coalesce("failures", F.lit(0).cast("bigint")))
    return out.select("rule", "table_name", "kind", "failures", (F.col("failures") == 0).alias("passed"))


class RuleViolation(Exception):
    """Rules that a table breaks, with their numbers of failures."""

    def __init__(self, failed: Mapping[str, int]):
        super().__init__(", ".join(f"{name}: {n}" for name, n in failed.items()))
        self.failed = dict(failed)


@dataclass
class Staged:
    """Tables of a catalog, one of them replaced by a version that is not published yet."""

    tables: Tables
    name: str
    df: DataFrame

    @property
    def spark(self) -> SparkSession:
        return self.df.sparkSession

    def __getitem__(self, name: str) -> DataFrame:
        return self.df if name == self.name else self.tables[name]


def enforce(tables: Tables, rules: Iterable[Rule]) -> None:
    """Raise RuleViolation if any rule fails; as many rows as rules come to the driver."""
    broken = rule_report(tables, list(rules)).where("not passed").select("rule", "failures").collect()
    if broken:
        raise RuleViolation({r["rule"]: r["failures"] for r in sorted(broken)})
