"""Day-grain marts of bitmaps, and the cards that unite them over a window instead of regrouping visitors."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenmart.catalog import Catalog, dataset
from screenmart.operators.bitmaps import bitmap_rows, dense_ids, distinct_counts, n_ids, united
from screenmart.operators.scope import EventScope, all_of
from screenmart.plans.event_cards import scoped


@dataset("mart", grain=["user_pseudo_id"])
def visitor_ids(c: Catalog) -> DataFrame:
    """Visitors of the site's pages and sessions, numbered."""
    seen = c["int_ga4_page_views"].select("user_pseudo_id").unionByName(c["int_ga4_sessions"].select("user_pseudo_id"))
    return dense_ids(seen, "user_pseudo_id")


@dataset("mart", grain=["screener_uid"])
def screening_ids(c: Catalog) -> DataFrame:
    """Screenings that met a resource, numbered."""
    return dense_ids(c["mart_screener_resource_engagement_by_screening"], "screener_uid")


@dataset("mart", grain=["event_date", "event_date_parsed", "state_code", "bucket"], partition_by=["event_date"])
def mart_page_visitor_bitmaps(c: Catalog) -> DataFrame:
    views = c["int_ga4_page_views"].join(c["visitor_ids"], "user_pseudo_id", "left")
    return bitmap_rows(views, ["event_date", "event_date_parsed", "state_code"])


@dataset("mart", grain=["event_date", "event_date_parsed", "state_code", "stage", "bucket"], partition_by=["event_date"])
def mart_session_visitor_bitmaps(c: Catalog) -> DataFrame:
    """Visitors by day, state and how far one of their sessions came."""
    started = F.col("hit_screener_start") == 1
    completed = started & (F.col("hit_screener_results") == 1)
    clicked = completed & (F.col("has_outbound_click") == 1)
    stages = F.array(F.lit("visited"), F.when(started, "started"), F.when(completed, "completed"), F.when(clicked, "clicked"))
    sessions = c["int_ga4_sessions"].select("event_date", "event_date_parsed", "state_code", "user_pseudo_id", F.explode(F.array_compact(stages)).alias("stage"))
    sessions = sessions.join(c["visitor_ids"], "user_pseudo_id", "left")
    return bitmap_rows(sessions, ["event_date", "event_date_parsed", "state_code", "stage"])


RESOURCE_KINDS = ["shown", "more_info", "website", "phone"]


def _resource_kind() -> Column:
    metric, method = F.col("metric"), F.col("contact_method")
    clicked = (metric == "resource_click") & method.isin("website", "phone")
    return F.when(metric.isin("resource_shown", "resource_more_info"), F.substring_index(metric, "resource_", -1)).when(clicked, method).otherwise("none")


@dataset("mart", grain=["event_date", "screener_state", "is_cesn", "resource", "kind", "bucket"], partition_by=["event_date"])
def mart_resource_screening_bitmaps(c: Catalog) -> DataFrame:
    """Screenings by day, scope columns, resource and what they did with it."""
    rows = c["mart_screener_resource_engagement_by_screening"].where(F.col("metric").isin("resource_shown", "resource_more_info", "resource_click"))
    rows = rows.where("screener_uid is not null").join(c["screening_ids"], "screener_uid")
    rows = rows.withColumns({"event_date": F.date_format("event_date_parsed", "yyyyMMdd"), "resource": F.col("dimension"), "kind": _resource_kind()})
    return bitmap_rows(rows, ["event_date", "event_date_parsed", "screener_state", "is_cesn", "resource", "kind"])


def resource_engagement(c: Catalog, s: EventScope, k: int = 20) -> DataFrame:
    """The card of the same name, from bitmaps: resources by the screenings that saw, opened, visited or called them."""
    held = united(scoped(c, "mart_resource_screening_bitmaps", s, "flagged"), ["resource", "kind"])
    out = held.groupBy("resource").agg(*[n_ids(F.col("kind") == kind).alias(kind) for kind in RESOURCE_KINDS])
    used = sum((F.col(kind) for kind in RESOURCE_KINDS), F.lit(0))
    return out.where(used > 0).orderBy(F.desc("shown"), F.desc("more_info"), "resource").limit(k)


def monthly_active_users(c: Catalog, state_codes: list[str]) -> DataFrame:
    """Distinct visitors per month of the pages of some states, from bitmaps."""
    days = c["mart_page_visitor_bitmaps"].where(F.col("state_code").isin(state_codes))
    days = days.withColumn("month", F.trunc("event_date_parsed", "MM"))
    return distinct_counts(days, ["month"], "active_users").orderBy("month")


def window_visitors(c: Catalog, start: date, end: date) -> DataFrame:
    """Visitors per state over any days, and those who started, completed and clicked: distinct over the whole window."""
    day = F.col("event_date")
    days = c["mart_session_visitor_bitmaps"].where(all_of([day >= f"{start:%Y%m%d}", day <= f"{end:%Y%m%d}"]))
    held = united(days, ["state_code", "stage"])
    stages = {"visited": "visitors", "started": "visitors_started", "completed": "visitors_completed", "clicked": "visitors_clicked"}
    return held.groupBy("state_code").agg(*[n_ids(F.col("stage") == stage).alias(out) for stage, out in stages.items()]).orderBy("state_code")
