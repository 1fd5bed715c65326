"""Event families as typed rows, sessions and page activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenmart.catalog import Catalog, dataset
from screenmart.functions import steps
from screenmart.functions.text import extract, host_name, page_path, path_state_code, url_state
from screenmart.operators.event_params import (
    EVENT_KEY,
    SCREENING,
    EventFamily,
    event_day,
    exploded_items,
    param_first,
    pivot_params,
    typed,
)
from screenmart.operators.skew import attach_group_values

SESSION_KEYS = ["user_pseudo_id", "ga_session_id"]
CLICK_KEY = ["event_date", "event_timestamp", "user_pseudo_id", "user_id"]


def session_json() -> Column:
    """Printable session key; grouping uses the two columns themselves."""
    return F.to_json(F.struct(*SESSION_KEYS), {"ignoreNullFields": "false"})


def lower_is(c: str, value: str) -> Column:
    return F.lower(F.col(c)) == value


def _dated(df: DataFrame, moment: str | None = "event_datetime") -> DataFrame:
    df = df.withColumn("event_date_parsed", event_day())
    return df if moment is None else df.withColumn(moment, F.timestamp_micros("event_timestamp"))


def _energy_flag(c: Catalog, flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False)) if c.options.coalesce_cesn else flag


# --- visits -----------------------------------------------------------------

LINK_CLICKS = EventFamily(
    ["outbound_link"],
    {
        **typed(ga_session_id="int", link_url="string", link_domain="string", page_location="string"),
        "is_outbound": ("outbound", "string"),
    },
    CLICK_KEY,
)

PAGE_VIEWS = EventFamily(
    ["page_view"],
    typed(ga_session_id="int", page_location="string"),
    ["event_date", "event_timestamp", "event_name", "user_pseudo_id", "user_id"],
)

SESSIONS = EventFamily(
    ["session_start"],
    {
        **typed(ga_session_id="int"),
        "session_medium": ("medium", "string"),
        "session_source": ("source", "string"),
        "session_campaign": ("campaign", "string"),
    },
    CLICK_KEY,
)


@dataset("staging", partition_by=["event_date"])
def stg_ga_link_clicks(c: Catalog) -> DataFrame:
    clicks = pivot_params(c.source("events"), LINK_CLICKS)
    clicks = clicks.withColumn("page_path", extract(F.col("page_location"), "https?://[^/]+(/.*)$"))
    return _dated(clicks, "click_datetime")


@dataset("staging", partition_by=["event_date"])
def stg_ga_page_views(c: Catalog) -> DataFrame:
    return _dated(pivot_params(c.source("events"), PAGE_VIEWS))


@dataset("staging", partition_by=["event_date"])
def stg_ga_sessions(c: Catalog) -> DataFrame:
    return _dated(pivot_params(c.source("events"), SESSIONS), "session_start_datetime")


@dataset("intermediate")
def int_ga4_page_views(c: Catalog) -> DataFrame:
    location = F.col("page_location")
    return c["stg_ga_page_views"].where(location.isNotNull()).withColumns(
        {
            "page_path": page_path(location),
            "page_hostname": host_name(location),
            "state_code": path_state_code(location),
        }
    )


def session_states(c: Catalog) -> DataFrame:
    """Latest-sorting page state per session."""
    views = c["int_ga4_page_views"].where("ga_session_id is not null")
    return views.groupBy(*SESSION_KEYS).agg(F.max("state_code").alias("state_code"))


@dataset("intermediate")
def int_ga4_sessions(c: Catalog) -> DataFrame:
    """Session starts with the page and click activity of their session.

    Views and clicks are reduced together, once, to the session. Whether any click
    followed the results page needs only the last click, so no click-to-page join.
    """
    on_start, on_results = F.col("page_path").like("%/step-1%"), F.col("page_path").like("%/results%")
    at = F.col("event_timestamp")
    views = c["int_ga4_page_views"].select(
        *SESSION_KEYS,
        "state_code",
        F.lit(1).alias("viewed"),
        F.when(on_start, at).alias("start_ts"),
        F.when(on_results, at).alias("results_ts"),
        F.lit(None).cast("bigint").alias("click_ts"),
    )
    clicks = c["stg_ga_link_clicks"].where(F.col("is_outbound") == "true")
    clicks = clicks.select(*SESSION_KEYS, at.alias("click_ts"))
    activity = views.unionByName(clicks, allowMissingColumns=True).where("ga_session_id is not null")
    activity = activity.groupBy(*SESSION_KEYS).agg(
        F.max("state_code").alias("state_code"),
        F.min("start_ts").alias("start_ts"),
        F.min("results_ts").alias("results_ts"),
        F.min("click_ts").alias("first_outbound_click_ts"),
        F.max("click_ts").alias("last_click_ts"),
        F.count("click_ts").alias("total_link_clicks"),
    )
    starts = c["stg_ga_sessions"].where("ga_session_id is not null")
    joined = starts.join(activity, SESSION_KEYS, "left")
    seconds = (F.col("results_ts") - F.col("start_ts")) / F.lit(1000000.0)
    return joined.select(
        "event_date",
        "event_date_parsed",
        *SESSION_KEYS,
        F.coalesce("state_code", F.lit("unknown")).alias("state_code"),
        F.coalesce("session_medium", F.lit("(none)")).alias("session_medium"),
        F.coalesce("session_source", F.lit("(direct)")).alias("session_source"),
        "session_campaign",
        "session_start_datetime",
        F.col("start_ts").isNotNull().cast("int").alias("hit_screener_start"),
        F.col("results_ts").isNotNull().cast("int").alias("hit_screener_results"),
        F.when(seconds >= 20, seconds).alias("completion_time_seconds"),
        F.coalesce(F.col("last_click_ts") > F.col("results_ts"), F.lit(False)).cast("int").alias("has_outbound_click"),
        "first_outbound_click_ts",
        F.coalesce("total_link_clicks", F.lit(0)).alias("total_link_clicks"),
    )


# --- screener families ------------------------------------------------------

FORM = EventFamily(
    [
        "screener_form_start", "screener_form_step", "screener_form_complete", "screener_form_error",
        "screener_form_back",
    ],
    typed(
        **SCREENING, screener_path="string", screener_step_name="string", screener_step_number="int",
        step_action="string", member_index="int", form_field_name="string", form_error_reason="string",
        form_error_message="string", form_error_count="int",
    ),
)

HELP = EventFamily(
    ["screener_help_click", "screener_get_help_click", "screener_more_help_resource_click"],
    typed(
        **SCREENING, help_topic="string", screener_step_name="string", screener_step_number="int",
        location="string", resource_name="string", resource_index="int", url="string",
    ),
)

PROGRAMS = EventFamily(
    [
        "screener_apply_click", "screener_program_more_info", "screener_program_visit_website",
        "screener_program_phone_click", "screener_program_document_download", "screener_required_program_click",
        "screener_filter_engaged", "screener_results_tab_click", "screener_navigator_engaged",
    ],
    typed(
        **SCREENING, program_id="id", program_name="string", url="string", document_name="string",
        filter_type="string", tab_name="string", navigator_id="id", navigator_name="string",
        contact_method="string",
    ),
)

RESOURCES = EventFamily(
    [
        "screener_results_tab_click", "screener_additional_resource_more_info",
        "screener_additional_resource_click",
    ],
    typed(**SCREENING, tab_name="string", resource_name="string", url="string", contact_method="string"),
)

OUTCOMES = EventFamily(
    [
        "screener_results_loaded", "screener_results_none_eligible", "screener_results_error",
        "screener_results_error_recovery",
    ],
    typed(**SCREENING, program_count="int", total_estimated_value="number", reference_id="string"),
)

SCROLL = EventFamily(
    ["screener_results_scroll_depth"], typed(**SCREENING, depth="loose_int", tab_name="string")
)

SECTIONS = EventFamily(
    ["screener_household_member", "screener_income_source"],
    typed(**SCREENING, action="string", member_index="int"),
)

SHARES = EventFamily(
    ["screener_share", "screener_share_popup_shown", "screener_results_save"],
    typed(
        **SCREENING, page_location="string", share_location="string", share_channel="string",
        share_provider="string", share_action="string", save_channel="string", save_action="string",
    ),
)

STEP_INTERACTIONS = EventFamily(
    [
        "screener_household_member", "screener_income_source", "screener_has_benefits_load_error",
        "screener_language_changed", "screener_confirmation_edit", "screener_confirmation_proceed",
    ],
    typed(
        **SCREENING, page_location="string", screener_step_name="string", screener_step_number="int",
        action="string", language_name="string", section="string",
    ),
)

UI_EVENTS = EventFamily(
    [
        "screener_confirmation_edit", "screener_signup_completed", "screener_filter_engaged",
        "screener_nps_score_submitted", "screener_nps_reason_submitted", "screener_nps_reason_skipped",
        "screener_feedback_click", "screener_link_click", "screener_logo_click", "screener_language_changed",
        "screener_social_click", "screener_results_back_to_screener",
    ],
    {
        **typed(
            **SCREENING, screener_step_name="string", page_location="string", section="string",
            filter_type="string", sms_consent="string", email_consent="string", link_name="string",
            link_location="string", location="string",
        ),
        "nps_score": ("score", "loose_int"),
        "feedback_channel": ("channel", "string"),
        "social_network": ("network", "string"),
    },
)


# Families whose rows are read twice, for session flags and for themselves: stored between.


@dataset("rows", partition_by=["event_date"])
def ga_form_rows(c: Catalog) -> DataFrame:
    return pivot_params(c.source("events"), FORM)


@dataset("rows", partition_by=["event_date"])
def ga_outcome_rows(c: Catalog) -> DataFrame:
    return pivot_params(c.source("events"), OUTCOMES)


@dataset("rows", partition_by=["event_date"])
def ga_resource_rows(c: Catalog) -> DataFrame:
    """Resource clicks, and one row per resource of a shown list."""
    shown = exploded_items(c.source("events"), ["results_resources"], _impression_columns())
    shown = shown.withColumns(
        {
            "event_name": F.lit("screener_resource_shown"),
            "batch_event_index": F.col("batch_event_index") + F.col("off"),
            "resource_name": F.col("item.item_name"),
        }
    ).drop("item", "off")
    return pivot_params(c.source("events"), RESOURCES).unionByName(shown, allowMissingColumns=True)


@dataset("staging", partition_by=["event_date"])
def stg_ga_screener_form_funnel(c: Catalog) -> DataFrame:
    """Form events with two facts of their whole session.

    ``is_cesn``: any event of the session belongs to the energy program; NULL when
    nothing in the session decides. ``cesn_path``: stated path, else inferred from
    the step only one path shows.
    """
    step = F.lower("screener_step_name")
    path = F.lower(F.trim("screener_path"))
    flags = [
        _energy_flag(c, F.bool_or(lower_is("screener_state", "cesn") | step.like("cesn-%"))).alias("is_cesn"),
        F.coalesce(
            F.max(F.when(path.isin("homeowner", "renter"), path)),
            F.when(F.bool_or(step == "cesn-appliances"), "homeowner"),
            F.when(F.bool_or(step == "cesn-energy-expenses"), "renter"),
        ).alias("cesn_path"),
    ]
    return _dated(attach_group_values(c["ga_form_rows"], SESSION_KEYS, flags))


@dataset("staging", partition_by=["event_date"])
def stg_ga_screener_help(c: Catalog) -> DataFrame:
    return _dated(pivot_params(c.source("events"), HELP))


def _first_screening() -> dict[str, Column]:
    return {name: param_first(name, kind) for name, kind in SCREENING.items()}


def _impression_columns() -> dict[str, Column]:
    keys = [k for k in EVENT_KEY if k != "event_name"]
    return {**{k: F.col(k) for k in keys}, **_first_screening()}


@dataset("staging", partition_by=["event_date"])
def stg_ga_screener_program_interactions(c: Catalog) -> DataFrame:
    """Program clicks, and one shown event per listed program, navigator or document."""
    lists = {
        "results_programs": "screener_program_shown",
        "results_navigators": "screener_navigator_shown",
        "results_documents": "screener_program_document_shown",
    }
    shown = exploded_items(c.source("events"), list(lists), _impression_columns())
    kind = F.col("item.item_list_name")

    def only(list_name: str, column: str) -> Column:
        return F.when(kind == list_name, F.col(column))

    shown = shown.withColumns(
        {
            "event_name": steps.lookup(lists, kind),
            "batch_event_index": F.col("batch_event_index") + F.col("off"),
            "program_id": F.when(kind == "results_programs", F.col("item.item_id")).otherwise(
                F.col("item.item_category")
            ),
            "program_name": only("results_programs", "item.item_name"),
            "document_name": only("results_documents", "item.item_name"),
            "navigator_id": only("results_navigators", "item.item_id"),
            "navigator_name": only("results_navigators", "item.item_name"),
        }
    ).drop("item", "off")
    clicks = pivot_params(c.source("events"), PROGRAMS)
    return _dated(clicks.unionByName(shown, allowMissingColumns=True))


@dataset("staging", partition_by=["event_date"])
def stg_ga_screener_resource_engagement(c: Catalog) -> DataFrame:
    """Resource clicks and shown resources with the session's energy-program flag."""
    flag = _energy_flag(c, F.bool_or(lower_is("screener_state", "cesn"))).alias("is_cesn")
    return _dated(attach_group_values(c["ga_resource_rows"], SESSION_KEYS, [flag]))


@dataset("staging", partition_by=["event_date"])
def stg_ga_screener_results_outcomes(c: Catalog) -> DataFrame:
    flag = _energy_flag(c, F.bool_or(lower_is("screener_state", "cesn"))).alias("is_cesn")
    return _dated(attach_group_values(c["ga_outcome_rows"], SESSION_KEYS, [flag]))


@dataset("staging", partition_by=["event_date"])
def stg_ga_screener_scroll_depth(c: Catalog) -> DataFrame:
    return _dated(pivot_params(c.source("events"), SCROLL))


@dataset("staging", partition_by=["event_date"])
def stg_ga_screener_section_engagement(c: Catalog) -> DataFrame:
    return _dated(pivot_params(c.source("events"), SECTIONS))


def _with_url_state(df: DataFrame) -> DataFrame:
    return df.withColumn("url_screener_state", url_state(F.col("page_location"))).drop("page_location")


@dataset("staging", partition_by=["event_date"])
def stg_ga_screener_shares(c: Catalog) -> DataFrame:
    return _dated(_with_url_state(pivot_params(c.source("events"), SHARES)))


@dataset("staging", partition_by=["event_date"])
def stg_ga_screener_step_interactions(c: Catalog) -> DataFrame:
    return _dated(_with_url_state(pivot_params(c.source("events"), STEP_INTERACTIONS)))


@dataset("staging", partition_by=["event_date"])
def stg_ga_screener_ui_events(c: Catalog) -> DataFrame:
    return _dated(_with_url_state(pivot_params(c.source("events"), UI_EVENTS)), None)


# --- intermediates ----------------------------------------------------------


@dataset("intermediate", grain=["session_key"])
def int_screener_furthest_step(c: Catalog) -> DataFrame:
    """Highest funnel rank a session reached by viewing a step or loading results."""
    kept = [*SESSION_KEYS, "event_date", "event_date_parsed", "screener_state", "is_cesn"]
    views = c["stg_ga_screener_form_funnel"].where(
        (F.col("event_name") == "screener_form_step") & (F.col("step_action") == "view")
    )
    views = views.select(*kept, steps.shared_rank(F.col("screener_step_name")).alias("step_rank"))
    loads = c["stg_ga_screener_results_outcomes"].where(F.col("event_name") == "screener_results_loaded")
    loads = loads.select(*kept, F.lit(steps.RESULTS_RANK).alias("step_rank"))
    reached = views.where("step_rank is not null").unionByName(loads)
    furthest = reached.groupBy(*SESSION_KEYS).agg(
        F.max("step_rank").cast("bigint").alias("furthest_step_rank"),
        *[F.max(x).alias(x) for x in ("event_date", "event_date_parsed", "screener_state", "is_cesn")],
    )
    return furthest.select(session_json().alias("session_key"), *furthest.columns[2:])


@dataset("intermediate", grain=["program_id"])
def int_screener_program_names(c: Catalog) -> DataFrame:
    named = c["stg_ga_screener_program_interactions"].where("program_id is not null and program_name is not null")
    return named.groupBy("program_id").agg(F.max("program_name").alias("program_name"))
