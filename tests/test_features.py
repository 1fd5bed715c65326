"""Rules and their gate, session tenants, mergeable counts, medians in rounds, changed days, buckets, concurrent refresh."""

import os
import random
import statistics

import pytest
from pyspark.sql import functions as F

from screenmart.catalog import Dataset, REGISTRY
from screenmart.operators import median, rules
from screenmart.operators.bitmaps import bitmap_rows, dense_ids, distinct_counts
from screenmart.operators.event_params import EventFamily, pivot_params
from screenmart.operators.median import exact_median, exact_medians, medians_in_a_row
from screenmart.operators.session_tenant import declare_tenant, register_tenant_views, set_tenant
from screenmart.plans import build, distinct_marts
from screenmart.plans.rules import RULES, CatalogTables
from screenmart.queries import DAY_TABLES, GLOBAL, LATE_DAY, SAMPLE_OPTIONS, bucketed, changed_days
from screenmart.sources import incremental, sinks
from screenmart.sources.sample import sample_catalog, stored_sample_catalog
from tests.conftest import SF_DIR, event


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df) -> str:
    df.collect()
    return plan_of(df)


def same_rows(a, b) -> bool:
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


# --- rules -------------------------------------------------------------------------


class Tables(dict):
    def __init__(self, spark, **tables):
        super().__init__(tables)
        self.spark = spark


@pytest.fixture
def tables(spark):
    child = [(1, 10, "a"), (1, 11, "b"), (None, None, "b"), (2, 99, None), (3, 99, "z"), (None, 10, "z"), (4, 11, "y")]
    return Tables(
        spark,
        child=spark.createDataFrame(child, "id long, parent_id long, kind string").repartition(3),
        parent=spark.createDataFrame([(10,), (11,), (11,), (None,)], "id long"),
    )


def test_rules_count_what_breaks_them(tables):
    checked = [
        *rules.not_null("child", "id", "kind"), *rules.unique("child", "id"), *rules.combination("child", "id", "kind"),
        *rules.accepted("child", "kind", ["a", "b"]), *rules.relation("child", "parent_id", "parent"),
        *rules.unique("parent", "id"), *rules.not_null("parent", "id"), *rules.combination("child", "id", "parent_id"),
    ]
    got = {r.rule: (r.failures, r.passed) for r in rules.rule_report(tables, checked).collect()}
    assert got == {
        "not_null_child_id": (2, False), "not_null_child_kind": (1, False), "unique_child_id": (1, False),
        "unique_combination_child_id_kind": (0, True), "accepted_values_child_kind": (2, False),
        "relationships_child_parent_id": (2, False), "unique_parent_id": (1, False), "not_null_parent_id": (1, False),
        "unique_combination_child_id_parent_id": (0, True),
    }


def test_rules_on_empty_tables_and_without_rules(spark, tables):
    empty = Tables(spark, child=tables["child"].where("false"), parent=tables["parent"].where("false"))
    checked = [*rules.not_null("child", "id"), *rules.relation("child", "parent_id", "parent")]
    assert [r.failures for r in rules.rule_report(empty, checked).collect()] == [0, 0]
    assert rules.rule_report(empty, []).count() == 0


def test_each_table_is_read_once_for_its_rules(spark):
    tables = CatalogTables(stored_sample_catalog(spark, SF_DIR, SAMPLE_OPTIONS))
    own = [r for r in RULES if r.table == "mart_income"]
    plan = plan_of(rules.rule_report(tables, own))
    assert len(own) == 10 and plan.count("Scan parquet") == 1 and plan.count("SortMergeJoin") <= 1


def test_a_broken_rule_keeps_the_last_version(spark, tmp_path, monkeypatch):
    rows = {"values": [1, 2, 3]}
    name = "mart_of_this_test"
    fn = lambda c: c.spark.createDataFrame([(v,) for v in rows["values"]], "id long")
    monkeypatch.setitem(REGISTRY, name, Dataset(name, fn, "mart"))
    own = [*rules.unique(name, "id"), *rules.not_null(name, "id")]
    monkeypatch.setattr(build, "rules_of", lambda n: own if n == name else [])
    c = sample_catalog(spark, SF_DIR, SAMPLE_OPTIONS)
    base, audit = str(tmp_path), build.published_by_rules(c)
    first = sinks.refresh(c, [name], base, audit=audit)[name]
    rows["values"] = [4, 4, None]
    with pytest.raises(rules.RuleViolation) as broken:
        sinks.refresh(c, [name], base, audit=audit)
    assert broken.value.failed == {f"unique_{name}_id": 1, f"not_null_{name}_id": 1}
    assert sinks.current_version(spark, f"{base}/{name}").endswith(os.path.basename(first))
    assert sorted(r.id for r in c[name].collect()) == [1, 2, 3]
    rows["values"] = [7]
    sinks.refresh(c, [name], base, workers=2, audit=audit)
    assert [r.id for r in c[name].collect()] == [7] and len(sinks.complete_versions(spark, f"{base}/{name}")) == 2


# --- tenants of a session ----------------------------------------------------------


def test_views_follow_the_session_variable(spark):
    c = stored_sample_catalog(spark, SF_DIR, SAMPLE_OPTIONS)
    declare_tenant(spark)
    register_tenant_views(c, ["mart_income", "visitor_ids"])
    everything = c["mart_income"]
    counts = {}
    for value in (None, "", "  ", "3", " 5 "):
        set_tenant(spark, value)
        counts[value] = spark.table("mart_income").count()
    own = lambda t: everything.where(F.col("white_label_id") == t).count()
    assert counts == {None: 0, "": 0, "  ": 0, "3": own(3), " 5 ": own(5)} and counts["3"] > 0
    set_tenant(spark, "3")
    assert "(white_label_id" in plan_of(spark.table("mart_income")).split("PartitionFilters")[1].split("]")[0]
    assert " = 3)" in plan_of(spark.table("mart_income")).split("PartitionFilters")[1].split("PushedFilters")[0]
    assert spark.table("visitor_ids").count() == c["visitor_ids"].count()
    assert spark.sql("SELECT current_white_label_id()").first()[0] == 3
    set_tenant(spark, "3 or 5")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.table("mart_income").count()
    set_tenant(spark, None)


# --- distinct counts ---------------------------------------------------------------


def test_dense_ids_are_dense_stable_and_extend(spark):
    values = [f"user {k % 700}" for k in range(3000)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "who string").repartition(5)
    ids = {r.who: r.id for r in dense_ids(df, "who").collect()}
    assert sorted(ids.values()) == list(range(1, 701))
    assert ids == {r.who: r.id for r in dense_ids(df.repartition(2), "who").collect()}
    known = spark.createDataFrame(list(ids.items()), "who string, id long")
    more = spark.createDataFrame([("user 3",), ("new a",), ("new b",), ("new a",)], "who string")
    assert sorted(r.id for r in dense_ids(more, "who", known).collect()) == [701, 702]
    assert dense_ids(df.where("false"), "who").count() == 0


def test_bitmaps_unite_to_exact_counts(spark):
    rng = random.Random(2)
    rows = [(rng.choice("abc"), rng.randint(1, 3), rng.choice([None, *range(1, 100_000, 37)])) for _ in range(4000)]
    df = spark.createDataFrame(rows, "k string, day int, id long").repartition(4)
    held = bitmap_rows(df, ["k", "day"])
    for keys in (["k"], ["day"], ["k", "day"]):
        got = {tuple(r)[:-1]: r.n for r in distinct_counts(held, keys, "n").collect()}
        want = {tuple(r)[:-1]: r.n for r in df.where("id is not null").groupBy(*keys).agg(F.countDistinct("id").alias("n")).collect()}
        assert got == want


def test_cards_of_bitmaps_do_not_shuffle_visitors(spark):
    c = stored_sample_catalog(spark, SF_DIR, SAMPLE_OPTIONS)
    for df in (distinct_marts.resource_engagement(c, GLOBAL), distinct_marts.monthly_active_users(c, ["co"])):
        plan = executed(df)
        assert "screener_uid" not in plan and "user_pseudo_id" not in plan and "bucket" in plan


# --- medians -------------------------------------------------------------------------


def test_medians_of_many_kinds_of_values(spark):
    rng = random.Random(1)
    kinds = [lambda: rng.random(), lambda: rng.random() * 1e9, lambda: -rng.random() * 1e-9, lambda: float(rng.randint(-5, 5)),
             lambda: 1e300 * rng.random(), lambda: 0.0, lambda: 5e-324, lambda: -1.7e308, lambda: None]
    rows = [(rng.choice(["a", "b", None]), rng.choice(kinds)(), rng.randint(0, 9)) for _ in range(2001)] + [("only null", None, None), ("one", 2.5, 1)]
    df = spark.createDataFrame(rows, "k string, v double, w int")
    groups = {}
    for k, v, _ in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    for rounds in (0, 1, 2):
        got = {r.k: r.median for r in exact_medians(df, {"v": F.col("v")}, ["k"], rounds).collect()}
        assert got == {k: statistics.median(v) for k, v in groups.items()}
    one = medians_in_a_row(df, {"v": F.col("v"), "w": F.col("w"), "none": F.lit(None).cast("double")}).first()
    assert one.v == statistics.median([v for _, v, _ in rows if v is not None])
    assert one.w == statistics.median([w for *_, w in rows if w is not None]) and one.none is None
    assert [r.m for r in exact_median(df.where("false"), F.col("v"), out="m").collect()] == [None]


def test_no_task_orders_a_large_middle(spark):
    """Of a million different values the windows see thousands at most."""
    df = spark.range(1_000_001).select((F.col("id") * 7 % 1_000_001 / F.lit(3.0)).alias("v"))
    for rounds in (0, 1):
        medians = exact_medians(df, {"v": F.col("v"), "w": F.col("v") + 0.5}, rounds=rounds)
        assert {r.metric: r.median for r in medians.collect()} == {"v": 500_000 / 3, "w": 500_000 / 3 + 0.5}
    counted = df.groupBy(median._first_range(F.col("v")).alias("b")).count()
    assert counted.count() < 30_000 and counted.agg(F.max("count")).first()[0] < 1000


# --- parameters --------------------------------------------------------------------


def test_repeated_parameters_and_events_give_the_largest_value(spark, make_catalog):
    family = EventFamily(["e"], {"s": ("s", "string"), "n": ("n", "int"), "i": ("i", "id"), "l": ("l", "loose_int"), "d": ("d", "number")})
    value = lambda s=None, i=None, d=None: (s, i, d)
    once = event("e", s="b", n=4, i=17, l="8", d=0.5)
    twice = event("e", user="u2")
    twice["event_params"] = [
        ("s", value("b")), ("s", value("c")), ("n", value(i=5)), ("n", value(i=3)), ("i", value(i=9)), ("i", value("10")),
        ("l", value("7")), ("l", value(i=6)), ("l", value("no")), ("d", value(i=2)), ("d", value(d=1.5)), ("other", value("x")),
    ]
    rest = event("e", user="u3", s="a")
    again = event("e", user="u3", n=1, s="A")
    none = event("e", user="u4", x="y")
    c = make_catalog(events=[once, twice, rest, again, none])
    df = pivot_params(c.source("events"), family)
    got = {r.user_pseudo_id: (r.s, r.n, r.i, r.l, r.d) for r in df.collect()}
    assert got == {"u1": ("b", 4, "17", 8, 0.5), "u2": ("c", 5, "9", 7, 2.0), "u3": ("a", 1, None, None, None), "u4": (None,) * 5}
    logical = df._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("aggregate(event_params") == 1 and "filter(event_params" not in logical


# --- changed days, buckets, refresh --------------------------------------------------


def test_changed_days_give_the_full_build(spark):
    tables = changed_days(spark, SF_DIR)
    whole = sample_catalog(spark, SF_DIR, SAMPLE_OPTIONS)
    for name in DAY_TABLES:
        new, full = tables[name], whole[name]
        assert same_rows(new, full), name
    early = whole.source("events").where(F.col("event_date") != LATE_DAY).select("event_date").distinct().count()
    touched = tables.touched_days([LATE_DAY])
    assert LATE_DAY in touched and len(touched) < early


def test_days_that_lose_all_rows_are_removed(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("1", 1), ("2", 2), ("3", 3)], "event_date string, v int").select("v", "event_date")
    incremental.overwrite_days(df, path, ["1", "2", "3"])
    incremental.overwrite_days(df.where("v <> 2").withColumn("v", F.col("v") * 10), path, ["2", "3"])
    assert incremental.stored_days(spark, path) == ["1", "3"]
    assert sorted(tuple(r) for r in spark.read.schema(df.schema).parquet(path).collect()) == [(1, "1"), (30, "3")]


def test_bucketed_screens_join_without_an_exchange(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    c = bucketed(spark, SF_DIR)
    c.prepare(["mart_screener_data", "screener_householdmember", "screener_incomestream", "screener_expense"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("int_householdmembers", "int_income", "mart_screener_expense"):
            plan = plan_of(c[name])
            assert "SortMergeJoin" in plan and "Exchange" not in plan, name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_refresh_waits_for_inputs_and_runs_the_rest_at_once(spark, tmp_path, monkeypatch):
    c = sample_catalog(spark, SF_DIR, SAMPLE_OPTIONS)
    names = ["mart_income", "mart_screener_data", "stg_program_eligibility", "mart_referrer_codes", "mart_qualified_benefits"]
    waits = sinks.dependencies(c, names)
    assert waits["mart_income"] == {"mart_screener_data"} and waits["mart_referrer_codes"] == set()
    assert waits["mart_qualified_benefits"] == {"mart_screener_data", "stg_program_eligibility"}
    order, write = [], sinks.write_table
    monkeypatch.setattr(sinks, "write_table", lambda df, path, *a: (order.append(os.path.basename(path)), write(df, path, *a))[1])
    paths = sinks.refresh(c, names, str(tmp_path), workers=4)
    assert set(paths) == set(names) and order.index("mart_income") > order.index("mart_screener_data")
    alone = sample_catalog(spark, SF_DIR, SAMPLE_OPTIONS)
    for name in names:
        assert same_rows(c[name], alone[name]), name


def test_a_failed_table_ends_the_refresh(spark, tmp_path, monkeypatch):
    bad = "mart_that_fails"
    monkeypatch.setitem(REGISTRY, bad, Dataset(bad, lambda c: c.spark.range(3).selectExpr("1 / (id - id) as x"), "mart"))
    c = sample_catalog(spark, SF_DIR, SAMPLE_OPTIONS)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        sinks.refresh(c, [bad, "mart_referrer_codes"], str(tmp_path), workers=2)
    assert bad not in c.written
