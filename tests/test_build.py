"""Stored tables: build order, refresh, backfill."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from screenmart.catalog import REGISTRY
from screenmart.operators.scope import EventScope
from screenmart.plans import build, event_marts
from screenmart.plans.event_cards import scoped
from screenmart.queries import SAMPLE_OPTIONS
from screenmart.sources import sample
from screenmart.sources.backfill import copy_days
from screenmart.sources.readers import events_since, jdbc_options, parquet_catalog
from screenmart.sources.sample import sample_catalog, stored_sample_catalog
from screenmart.sources.sinks import current_version, drop_old_versions, refresh, register_views, write_table
from tests.conftest import SF_DIR


def test_backfill_copies_each_day_once(spark, tmp_path):
    events = sample_catalog(spark, SF_DIR).source("events")
    target, manifest = str(tmp_path / "events"), str(tmp_path / "manifest")
    days = events.select("event_date").distinct().count()
    early = events.where("event_date < '20240110'")

    dry = copy_days(spark, early, target, manifest, dry_run=True)
    assert (len(dry.copied), dry.skipped) == (9, 0) and not os.path.exists(target)
    first = copy_days(spark, early, target, manifest)
    assert (len(first.copied), first.skipped, first.failed) == (9, 0, {})
    second = copy_days(spark, events.where("event_date < '20240113'"), target, manifest)
    assert (len(second.copied), second.skipped, second.total) == (3, 9, 12) and days >= 12
    again = copy_days(spark, events.where("event_date < '20240113'"), target, manifest)
    assert (again.copied, again.skipped) == ([], 12)
    stored = spark.read.schema(events.schema).parquet(target)
    want = events.where("event_date < '20240113'")
    assert stored.count() == want.count()
    assert stored.select("event_name").distinct().count() == want.select("event_name").distinct().count()


def test_backfill_after_a_run_that_ended_between_write_and_manifest(spark, tmp_path):
    events = sample_catalog(spark, SF_DIR).source("events").where("event_date < '20240104'")
    target, manifest = str(tmp_path / "events"), str(tmp_path / "manifest")
    events.where("event_date = '20240101'").limit(1).write.parquet(f"{target}/event_date=20240101")
    broken = f"{target}/event_date=20240102"
    events.where("event_date = '20240102'").limit(1).write.parquet(broken)
    os.remove(f"{broken}/_SUCCESS")
    report = copy_days(spark, events, target, manifest)
    assert (report.copied, report.failed) == (["20240101", "20240102", "20240103"], {})
    assert spark.read.parquet(f"{target}/event_date=20240101").count() == 1  # complete: recorded, not overwritten
    assert spark.read.parquet(broken).count() == events.where("event_date = '20240102'").count()
    assert copy_days(spark, events, target, manifest).copied == []


def test_a_failed_build_leaves_the_last_version(spark, tmp_path):
    path = str(tmp_path / "table")
    first = write_table(spark.range(5), path)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        write_table(spark.range(5).selectExpr("1 / (id - 3) as x"), path)
    assert current_version(spark, path).endswith(os.path.basename(first))
    assert spark.read.parquet(current_version(spark, path)).count() == 5
    second = write_table(spark.range(7), path, sort_by=["id"])
    assert spark.read.parquet(current_version(spark, path)).count() == 7
    assert spark.read.parquet(first).count() == 5
    drop_old_versions(spark, path, keep=1)
    assert not os.path.exists(first) and os.path.exists(second)
    assert current_version(spark, str(tmp_path / "nothing")) is None


def test_event_days_prune_partitions(spark):
    days = events_since(sample_catalog(spark, SF_DIR).source("events"), "20240120")
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_tables_and_lazy_plans_agree(spark, tmp_path):
    lazy = sample_catalog(spark, SF_DIR, SAMPLE_OPTIONS)
    stored = sample_catalog(spark, SF_DIR, SAMPLE_OPTIONS)
    names = ["mart_screener_data", "mart_householdmembers", "stg_ga_screener_form_funnel", "mart_screener_step_facts", "mart_ga_kpi_summary"]
    paths = refresh(stored, names, str(tmp_path))
    assert set(paths) == set(names) == set(stored.written)
    for name in names:
        columns = sorted(lazy[name].columns)
        left, right = lazy[name].select(*columns), stored[name].select(*columns)
        assert left.dtypes == right.dtypes
        assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
    assert os.path.isdir(f"{paths['mart_screener_data']}/white_label_id=1")
    register_views(stored, names)
    assert spark.sql("select count(*) from mart_screener_data where white_label_id = 1").first()[0] > 0


def raw_event_scans(df) -> int:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return sum("event_params" in line for line in plan.splitlines() if "FileScan" in line)


@pytest.mark.parametrize("name", ["stg_ga_screener_form_funnel", "mart_screener_results_outcomes"])
def test_raw_events_are_read_once_a_family(spark, name):
    c = stored_sample_catalog(spark, SF_DIR, SAMPLE_OPTIONS, ("rows",))
    assert raw_event_scans(c[name]) == 0  # the stored rows serve flags and rows
    assert raw_event_scans(REGISTRY["ga_form_rows"].fn(c)) == 1


def test_card_windows_prune_days(spark):
    c = stored_sample_catalog(spark, SF_DIR, SAMPLE_OPTIONS)
    s = EventScope(date(2024, 1, 8), start=date(2024, 1, 10), end=date(2024, 1, 12))
    rows = scoped(c, "mart_screener_shares", s, "site")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert {r[0] for r in rows.select("event_date").distinct().collect()} <= {"20240110", "20240111", "20240112"}


def test_marts_without_days_are_sorted_by_day():
    grains = [d for d in REGISTRY.values() if d.fn.__module__ == event_marts.__name__ and d.layer == "mart"]
    plain = [d.name for d in grains if not d.partition_by and not d.sort_by]
    assert sorted(plain) == ["mart_screener_cesn_combined_ladder", "mart_screener_step_ladder"]


def test_jdbc_options():
    # The reader itself needs a database, which the tests have not.
    got = jdbc_options({"url": "u", "fetchsize": "10000"}, "t", 8, (3, 900), "id")
    assert got["lowerBound"] == "3" and got["numPartitions"] == "8" and got["fetchsize"] == "10000"
    assert jdbc_options({"url": "u"}, "t", 8, (None, None), "id") == {"url": "u", "dbtable": "t"}


def test_sample_folder_is_shared_without_a_checkpoint_folder(spark, monkeypatch):
    monkeypatch.setattr(sample, "checkpoint_dir", lambda spark: None)
    assert sample._work_folder(spark) == spark.conf.get("spark.sql.warehouse.dir")


def test_build_order_puts_inputs_first():
    order = [*build.relational_order(), *build.event_order(), *build.first_generation_order()]
    assert len(order) == len(set(order))
    assert order.index("mart_screener_data") < order.index("mart_income")
    assert order.index("stg_ga_screener_form_funnel") < order.index("mart_screener_form_funnel")
    assert order.index("data") < order.index("data_currentbenefits")


def test_parquet_catalog_reads_declared_types(spark, tmp_path):
    catalog = sample_catalog(spark, SF_DIR)
    for name in ("screener_whitelabel", "programs_referrer"):
        catalog.source(name).write.parquet(str(tmp_path / name))
    c = parquet_catalog(spark, str(tmp_path))
    assert c["mart_referrer_codes"].count() == 25
    assert dict(c.source("programs_referrer").dtypes)["white_label_id"] == "int"


def test_event_scan_reads_needed_columns_only(spark):
    c = sample_catalog(spark, SF_DIR, SAMPLE_OPTIONS)
    plan = c["stg_ga_screener_scroll_depth"]._jdf.queryExecution().executedPlan().toString()
    assert "items" not in plan.split("ReadSchema")[1].split("\n")[0]
    assert "event_name" in plan.split("PartitionFilters: [")[1].split("]")[0]
    funnel = c["mart_screener_screening_funnel"].select(F.col("screener_uid"))
    assert "Window" not in funnel._jdf.queryExecution().executedPlan().toString()
