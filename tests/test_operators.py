import random
from datetime import date
from decimal import ROUND_HALF_UP, Decimal
from statistics import median

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from screenmart.functions.numbers import annual_amount, monthly_amount, pct, round_ratio
from screenmart.functions.text import url_state, word_caps
from screenmart.operators import checks, skew
from screenmart.operators.median import exact_median
from screenmart.operators.scope import EventScope, ScreenFilters, scope_to_tenant, tenant_from_role, tenant_from_setting


def one(spark, value, kind, fn):
    return spark.createDataFrame([(value,)], f"x {kind}").select(fn(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("n", [1, 2, 3, 10, 777, 1000])
def test_median_matches_sorting(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice(["a", "b", None]), rng.choice([rng.randint(0, 5), rng.random() * 1000, None])) for _ in range(n)]
    rows = [(g, None if v is None else float(v)) for g, v in rows]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r["median"] for r in exact_median(df, F.col("v"), ["g"]).collect()}
    want = {}
    for g in {g for g, _ in rows}:
        values = [v for k, v in rows if k == g and v is not None]
        if values:
            want[g] = median(values)
    assert got == pytest.approx(want)
    everything = [v for _, v in rows if v is not None]
    total = exact_median(df, F.col("v")).collect()
    assert [r["median"] for r in total] == ([pytest.approx(median(everything))] if everything else [None])


def test_median_of_one_dominant_value(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id").cast("double")).alias("v"))
    values = [7.0 if i % 3 == 0 else float(i) for i in range(5000)]
    assert exact_median(df, F.col("v")).first()["median"] == median(values)


def hot_rows(spark, n=4000):
    """A third of the rows on one key, another share on the NULL key."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 5 == 0, None).otherwise((F.col("id") % 97).cast("string"))
    return spark.range(n).select(key.alias("k"), F.col("id").alias("v"))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [True, False])
def test_lookup_equals_plain_join(spark, how, null_safe):
    fact = hot_rows(spark)
    dim = spark.createDataFrame([("hot", 1), ("1", 2), ("2", 3), (None, 4)], "k string, d int")
    got = skew.lookup_join(fact, dim, ["k"], how, null_safe=null_safe)
    cond = fact["k"].eqNullSafe(dim["k"]) if null_safe else fact["k"] == dim["k"]
    want = fact.join(dim, cond, how).select(fact["k"], "v", "d")
    assert sorted(map(tuple, got.select("k", "v", "d").collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_rows_without_a_key_are_dealt_out(spark):
    dim = spark.createDataFrame([("hot", 1)], "k string, d int")
    joined = skew.lookup_join(hot_rows(spark), dim, ["k"])
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_spread" in plan and "xxhash64" in plan


def test_group_values_equal_a_window(spark):
    rows = hot_rows(spark).withColumn("odd", F.when(F.col("v") % 7 == 0, F.col("v") % 2 == 1))
    got = skew.attach_group_values(rows, ["k"], [F.bool_or("odd").alias("any_odd"), F.max("v").alias("top")])
    w = Window.partitionBy("k")
    want = rows.withColumns({"any_odd": F.bool_or("odd").over(w), "top": F.max("v").over(w)})
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_rounded_ratio_is_half_up(spark):
    pairs = [(n, d) for d in (1, 3, 7, 8, 16, 40, 200, 2000) for n in (0, 1, 3, 5, 7, 33, 201)]
    df = spark.createDataFrame(pairs, "n long, d long")
    rows = df.select("n", "d", pct("n", "d").alias("p"), round_ratio("n", "d", 2).alias("r")).collect()
    for row in rows:
        exact = Decimal(row["n"]) / Decimal(row["d"])
        assert row["p"] == float((exact * 100).quantize(Decimal("0.1"), ROUND_HALF_UP))
        assert row["r"] == float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))
    assert spark.range(1).select(pct(F.lit(1), F.lit(0)).alias("p")).first()["p"] is None


def test_two_month_conversions_stay_apart(spark):
    df = spark.createDataFrame(
        [("weekly", Decimal("100"), 10), ("hourly", Decimal("10"), None), ("other", Decimal("5"), 3)],
        "f string, a decimal(18,2), h int",
    )
    yearly, monthly, hourly = [], [], []
    for r in df.select(
        annual_amount(F.col("a"), F.col("f")).alias("y"),
        monthly_amount(F.col("a"), F.col("f")).alias("m"),
        monthly_amount(F.col("a"), F.col("f"), F.col("h")).alias("mh"),
    ).collect():
        yearly.append(None if r["y"] is None else float(r["y"]))
        monthly.append(r["m"])
        hourly.append(r["mh"])
    assert yearly == [5200.0, 20800.0, None]
    assert monthly == pytest.approx([435.0, 10.0, 5.0])
    assert hourly == pytest.approx([435.0, 0.0, 5.0])


@pytest.mark.parametrize(
    "url, state",
    [
        ("https://x.org/co/step-1", "co"),
        ("https://x.org/co-tax-calculator/step-1", None),
        ("https://x.org/nc?a=1", "nc"),
        ("https://x.org", None),
        ("https://x.org/zz/step-1", None),
        (None, None),
    ],
)
def test_state_of_url(spark, url, state):
    assert one(spark, url, "string", url_state) == state


@pytest.mark.parametrize("text, want", [("linkedIn", "Linkedin"), ("income help-text", "Income Help-Text"),
                                        ("(unspecified)", "(Unspecified)"), ("a_b c.d", "A_B C.D"), (None, None)])
def test_word_capitals(spark, text, want):
    assert one(spark, text, "string", word_caps) == want


def test_tenant_scope(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "white_label_id int")
    assert [r[0] for r in scope_to_tenant(df, 2).collect()] == [2]
    assert scope_to_tenant(df, None).count() == 0
    assert (tenant_from_setting(" 7 "), tenant_from_setting(" "), tenant_from_setting(None)) == (7, None, None)
    assert tenant_from_role("wl_nc_5_ro") == 5
    assert tenant_from_role("wl_nc_5_rw") is None


def test_filters_add_only_what_is_set(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), "A", "x"), (date(2024, 2, 1), None, "y")], "submission_date date, partner string, county string")
    assert ScreenFilters().apply(df).count() == 2
    assert ScreenFilters(partner=("A",)).apply(df).count() == 1
    assert ScreenFilters(submitted_from=date(2024, 1, 2)).apply(df).count() == 1


def test_scope_forms(spark):
    rows = [("co", False), (None, False), ("co", True), ("co", None), ("cesn", True), ("Colorado", False)]
    df = spark.createDataFrame(rows, "screener_state string, is_cesn boolean")
    world = EventScope(epoch=date(2024, 1, 1))

    def kept(cond):
        return sorted((tuple(r) for r in df.where(cond).collect()), key=str)

    assert kept(world.plain()) == sorted([("co", False), ("co", True), ("co", None)], key=str)
    assert kept(world.flagged()) == sorted([("co", False), (None, False)], key=str)
    assert kept(world.site()) == sorted([("co", False), (None, False), ("co", True), ("co", None)], key=str)
    tenant = EventScope(epoch=date(2024, 1, 1), tenant_states=("cesn",))
    assert kept(tenant.flagged()) == [("cesn", True)]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, None), (None, "a")], "id int, v string")
    nulls = {r["column_name"]: r["null_rows"] for r in checks.null_counts(df, ["id", "v"]).collect()}
    assert nulls == {"id": 2, "v": 1}
    assert [tuple(r) for r in checks.duplicate_keys(df, ["id"]).collect()] == [(1, 2)]
    assert checks.duplicate_keys(df, ["id", "v"]).count() == 0
    assert [tuple(r) for r in checks.unaccepted_values(df, "v", ["a"]).collect()] == [("b", 1)]
    parent = spark.createDataFrame([("a",)], "k string")
    assert [tuple(r) for r in checks.orphan_keys(df, "v", parent, "k").collect()] == [("b", 1)]
