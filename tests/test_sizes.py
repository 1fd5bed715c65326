"""What keeps shuffles, writes and task memory in step with the input; each test builds its own rows."""

import os

import pytest
from pyspark.sql import functions as F

from screenmart.queries import SAMPLE_OPTIONS, bucket_count
from screenmart.session import tune
from screenmart.sources import sample
from screenmart.sources.sinks import write_table


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Sample tables of 40 orders; some lines come twice and some have no order number."""
    folder = str(tmp_path_factory.mktemp("small"))
    day = "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 300 as int))"
    tables = {
        "region": spark.range(5).selectExpr("cast(id as int) as r_regionkey", "'REGION_' || id as r_name"),
        "nation": spark.range(25).selectExpr("cast(id as int) as n_nationkey", "'NATION_' || id as n_name", "cast(id % 5 as int) as n_regionkey"),
        "customer": spark.range(10).selectExpr("id as c_custkey", "cast(id % 25 as int) as c_nationkey", "if(id % 2 = 0, 'MACHINERY', 'AUTO') as c_mktsegment"),
        "part": spark.range(50).selectExpr("id as p_partkey"),
        "orders": spark.range(40).selectExpr(
            "id as o_orderkey", "id % 10 as o_custkey", "if(id % 5 = 0, 'P', 'O') as o_orderstatus", "id * 10.5D as o_totalprice",
            f"{day} as o_orderdate", "'1-URGENT' as o_orderpriority",
        ),
        "lineitem": spark.range(300).selectExpr(
            "if(id % 37 = 0, null, id % 40) as l_orderkey", "id % 50 as l_partkey", "id % 20 as l_suppkey", "cast(id % 7 + 1 as int) as l_linenumber",
            "cast(id % 50 as double) as l_quantity", "id * 3.25D as l_extendedprice", "if(id % 3 = 0, 'R', 'N') as l_returnflag",
            f"{day} as l_shipdate",
        ),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_raw_tables_are_cut_out_of_bases_stored_once(spark, small):
    c = sample.sample_catalog(spark, small, SAMPLE_OPTIONS)
    for name in sample.VIEWS:
        plan = plan_of(c.source(name))
        assert "Exchange" not in plan and "Aggregate" not in plan, name
    folder = sample._landing_folder(spark, small)
    assert sorted(os.listdir(folder)) == ["line_base", "order_base"]
    for name in sample.BASES:
        assert len(os.listdir(f"{folder}/{name}")) == 1


def test_raw_tables_hold_the_rows_of_their_statements(spark, small):
    c = sample.sample_catalog(spark, small, SAMPLE_OPTIONS)
    for name in sample.VIEWS:
        text, known = "{" + name + "}", {}
        for ref, select in sample.STATEMENTS.items():  # in evaluation order, nothing stored
            if ref in ("order_base", "line_base", name):
                inputs = {t: spark.read.parquet(f"{small}/{t}.parquet") for t in sample.RAW_TABLES if "{" + t + "}" in select}
                inputs |= {t: known[t] for t in known if "{" + t + "}" in select}
                known[ref] = spark.sql(select, **inputs)
        plain = spark.sql(f"select * from {text}", **{name: known[name]})
        kept = c.source(name)
        plain = plain.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in kept.schema])
        assert kept.count() == plain.count() > 0, name
        assert kept.exceptAll(plain).isEmpty(), name


def test_snapshots_of_a_screen_meet_in_one_exchange(spark, make_catalog):
    from datetime import datetime

    def snapshot(i, screen, day):
        return {"id": i, "screen_id": screen, "submission_date": day and datetime(2024, 1, day)}

    rows = [
        snapshot(1, 7, 3), snapshot(2, 7, 5), snapshot(2, 7, 4), snapshot(3, 7, 5),  # an id twice, two of one day
        snapshot(4, 8, 9), snapshot(5, 8, None), snapshot(5, 8, 1),  # undated once: newest
        snapshot(6, None, 2), snapshot(9, None, 1), snapshot(6, None, 2), snapshot(None, 10, 1),
    ]
    latest = make_catalog(screener_eligibilitysnapshot=rows)["stg_latest_eligibility_snapshot"]
    found = {r[0]: (r[1], r[2]) for r in latest.collect()}
    assert found == {7: (3, 3), 8: (5, 2), None: (6, 2), 10: (None, 0)}
    known = plan_of(latest.select("*")).split("\n   +- ")[0]  # the first side of the union
    assert known.count("Aggregate") >= 2 and known.count("Exchange") == 1


def test_tenant_tables_are_written_where_their_rows_lie(spark, tmp_path):
    rows = spark.range(0, 900, 1, 3).selectExpr("id", "cast(id % 2 as int) as tenant")
    version = write_table(rows, str(tmp_path / "t"), ["tenant"], ["id"])
    for tenant in (0, 1):
        assert len([f for f in os.listdir(f"{version}/tenant={tenant}") if f.endswith(".parquet")]) == 3
    back = spark.read.schema(rows.schema).parquet(version)
    assert back.exceptAll(rows).isEmpty() and back.count() == 900


def test_exchanges_start_wide_on_a_narrow_cluster(spark):
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        counted = tune(spark).range(100).selectExpr("id % 7 as k").groupBy("k").count()
        assert "hashpartitioning(k" in plan_of(counted) and ", 200)" in plan_of(counted)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)


def test_buckets_grow_with_the_input():
    assert bucket_count(0) == bucket_count(13_000_000) == 8
    assert bucket_count(600_000_000) == 240 and bucket_count(6_000_000_000) == 2400
