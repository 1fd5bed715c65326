"""Event marts at their stated grains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenmart.catalog import Catalog, dataset
from screenmart.functions import steps
from screenmart.functions.numbers import pct, round_ratio
from screenmart.functions.text import STATE_SLUGS, blank_to_null, host_name, word_caps
from screenmart.operators.event_params import event_day, param_first
from screenmart.operators.skew import attach_group_values, null_safe_join
from screenmart.plans.event_staging import SESSION_KEYS, lower_is, session_json, session_states
from screenmart.sources.readers import events_since

DAY_STATE = ["event_date", "event_date_parsed", "screener_state"]


def named(*names: str) -> Column:
    return F.col("event_name").isin(list(names))


def counted(df: DataFrame, keys: list[str], rows: str, distinct: str, who: list[str] | str) -> DataFrame:
    """Rows and distinct visitors per key in two reductions.

    The first is by (key, visitor), so a dominant key is spread over its visitors
    before it meets in one place as small counts. NULL visitors do not count.
    """
    by = [who] if isinstance(who, str) else list(who)
    per = df.groupBy(*keys, *by).agg(F.count(F.lit(1)).alias("_n"))
    known = F.col(by[0]).isNotNull() if isinstance(who, str) else F.lit(True)
    return per.groupBy(*keys).agg(F.sum("_n").alias(rows), F.count_if(known).alias(distinct))


def first_known_state(ts: str = "event_timestamp") -> Column:
    """(time, state) of the earliest event with a known tenant slug; NULL without one."""
    return F.min(F.when(F.col("screener_state").isin(STATE_SLUGS), F.struct(ts, "screener_state")))


# --- visits -----------------------------------------------------------------


@dataset("mart", partition_by=["event_date"])
def mart_ga_clicked_links(c: Catalog) -> DataFrame:
    """Clicks on the results page by day, state and link domain.

    Clicks are reduced to (day, session, link) before the session's state joins,
    and the same rows then yield clicks, sessions and users in turn.
    """
    clicks = c["stg_ga_link_clicks"].where(
        F.col("ga_session_id").isNotNull() & F.col("page_path").like("%/results%")
    )
    domain = F.coalesce(F.nullif("link_domain", F.lit("")), host_name(F.col("link_url")))
    link = ["event_date", "event_date_parsed", "domain", "is_outbound"]
    per_session = clicks.withColumn("domain", domain).groupBy(*link, *SESSION_KEYS)
    per_session = per_session.agg(F.count(F.lit(1)).alias("n")).join(session_states(c), SESSION_KEYS, "left")
    per_session = per_session.withColumn("state_code", F.coalesce("state_code", F.lit("unknown")))
    keys = ["event_date", "event_date_parsed", "state_code", "domain", "is_outbound"]
    per_user = per_session.groupBy(*keys, "user_pseudo_id").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("sessions")
    )
    out = per_user.groupBy(*keys).agg(
        F.sum("n").alias("total_clicks"),
        F.sum("sessions").alias("sessions_with_clicks"),
        F.count("user_pseudo_id").alias("users_with_clicks"),
    )
    return out.withColumnRenamed("domain", "link_domain")


def _session_users(df: DataFrame, keys: list[str], aggs: list[Column], sums: list[str]) -> DataFrame:
    """Sessions, users and summed session columns per key: session, then user, then key."""
    per_session = df.groupBy(*keys, *SESSION_KEYS).agg(*aggs)
    per_user = per_session.groupBy(*keys, "user_pseudo_id").agg(
        F.count(F.lit(1)).alias("total_sessions"), *[F.sum(s).alias(s) for s in sums]
    )
    return per_user.groupBy(*keys).agg(
        F.sum("total_sessions").alias("total_sessions"),
        F.count("user_pseudo_id").alias("total_users"),
        *[F.sum(s).alias(s) for s in sums],
    )


@dataset("mart", partition_by=["event_date"])
def mart_ga_kpi_summary(c: Catalog) -> DataFrame:
    sessions = c["int_ga4_sessions"]
    keys = ["event_date", "event_date_parsed", "state_code"]
    started = F.col("hit_screener_start") == 1
    completed = started & (F.col("hit_screener_results") == 1)
    clicked = completed & (F.col("has_outbound_click") == 1)
    flags = {
        "sessions_started_screener": started,
        "sessions_completed_screener": completed,
        "sessions_clicked_after_completion": clicked,
    }
    counts = _session_users(
        sessions,
        keys,
        [F.max(cond.cast("int")).alias(name) for name, cond in flags.items()],
        list(flags),
    )
    seconds = F.col("completion_time_seconds")
    times = sessions.groupBy(*keys).agg(
        F.round(F.avg(seconds), 1).alias("avg_completion_time_seconds"),
        F.round(F.percentile_approx(seconds, F.lit(0.5), F.lit(10000)), 1).alias("median_completion_time_seconds"),
    )
    return null_safe_join(counts, times, keys).withColumns(
        {
            "pct_started_screener": pct("sessions_started_screener", "total_sessions", 2),
            "completed_to_click_rate_pct": pct(
                "sessions_clicked_after_completion", "sessions_completed_screener", 2
            ),
        }
    )


@dataset("mart", partition_by=["event_date"])
def mart_ga_traffic_mediums(c: Catalog) -> DataFrame:
    keys = ["event_date", "event_date_parsed", "state_code", "session_medium", "session_source"]
    return _session_users(c["int_ga4_sessions"], keys, [F.count(F.lit(1)).alias("rows")], []).drop("rows")


# --- funnels ----------------------------------------------------------------


@dataset("mart")
def mart_screener_step_ladder(c: Catalog) -> DataFrame:
    return steps.shared_ladder(c.spark)


@dataset("mart")
def mart_screener_cesn_combined_ladder(c: Catalog) -> DataFrame:
    return steps.energy_ladder(c.spark)


@dataset("mart", grain=["session_key"], sort_by=["event_date_parsed"])
def mart_screener_cesn_funnel(c: Catalog) -> DataFrame:
    """Highest energy-program rung per session; starting the form is rung 0."""
    viewed = named("screener_form_step") & (F.col("step_action") == "view")
    rank = F.when(viewed, steps.energy_rank(F.col("screener_step_name"))).when(named("screener_form_start"), F.lit(0))
    reached = c["stg_ga_screener_form_funnel"].where("is_cesn").withColumn("step_rank", rank)
    out = reached.where("step_rank is not null").groupBy(*SESSION_KEYS)
    out = out.agg(
        F.max("step_rank").cast("bigint").alias("furthest_step_rank"),
        F.max("event_date").alias("event_date"),
        F.max("event_date_parsed").alias("event_date_parsed"),
    )
    return out.select(session_json().alias("session_key"), *out.columns[2:])


@dataset("mart", grain=["session_key"], sort_by=["event_date_parsed"])
def mart_screener_furthest_step(c: Catalog) -> DataFrame:
    return c["int_screener_furthest_step"]


@dataset("mart", partition_by=["event_date"])
def mart_screener_form_funnel(c: Catalog) -> DataFrame:
    """Sessions that viewed, completed, left or failed each step, by day and state.

    One pass instead of four summaries joined on their common grain: each event
    carries flags, the session is reduced first, the grain second. A grain without
    a decided program flag or step name matches nothing, so its counts are zero.
    """
    viewed = (named("screener_form_step") & (F.col("step_action") == "view")) | named(
        "screener_form_start", "screener_form_complete"
    )
    flags = {
        "screenings_viewed_step": viewed,
        "screenings_completed_step": named("screener_form_step") & (F.col("step_action") == "complete"),
        "screenings_navigated_back": named("screener_form_back"),
        "screenings_with_error": named("screener_form_error"),
    }
    synthetic = F.when(named("screener_form_start"), steps.FORM_START).when(
        named("screener_form_complete"), steps.FORM_COMPLETE
    )
    in_step = named("screener_form_step") & viewed
    events = c["stg_ga_screener_form_funnel"].select(
        *DAY_STATE,
        "is_cesn",
        F.coalesce(synthetic, "screener_step_name").alias("screener_step_name"),
        *SESSION_KEYS,
        F.when(in_step, F.col("screener_step_number")).alias("screener_step_number"),
        *[F.coalesce(cond, F.lit(False)).cast("int").alias(name) for name, cond in flags.items()],
    )
    events = events.where(reduce(lambda a, b: a | b, [F.col(name) == 1 for name in flags]))
    keys = [*DAY_STATE, "is_cesn", "screener_step_name"]
    per_session = events.groupBy(*keys, *SESSION_KEYS).agg(
        F.max("screener_step_number").alias("screener_step_number"),
        F.sum("screenings_with_error").alias("total_error_count"),
        *[F.max(name).alias(name) for name in flags],
    )
    counts = [*flags, "total_error_count"]
    out = per_session.groupBy(*keys).agg(
        F.max("screener_step_number").alias("screener_step_number"), *[F.sum(x).alias(x) for x in counts]
    )
    matched = F.col("is_cesn").isNotNull() & F.col("screener_step_name").isNotNull()
    out = out.withColumns({x: F.when(matched, F.col(x)).otherwise(F.lit(0)) for x in counts})
    return out.withColumns(
        {
            "screener_step_number": F.when(matched, F.col("screener_step_number")),
            "screener_step_label": steps.funnel_step_label(F.col("screener_step_name")),
        }
    )


def _form_steps(c: Catalog) -> DataFrame:
    step = F.col("screener_step_name")
    return c["stg_ga_screener_form_funnel"].where(
        step.isNotNull() & ~step.isin(steps.FORM_START, steps.FORM_COMPLETE)
    )


def _any(cond: Column) -> Column:
    """True if any row meets the condition; a NULL condition does not decide."""
    return F.max(cond)


def viewed_step() -> Column:
    return named("screener_form_step") & (F.col("step_action") == "view")


@dataset("mart", grain=["session_key", "screener_step_name"], sort_by=["event_date_parsed"])
def mart_screener_step_facts(c: Catalog) -> DataFrame:
    out = (
        _form_steps(c)
        .groupBy(*SESSION_KEYS, "screener_step_name")
        .agg(
            *[F.max(x).alias(x) for x in ("screener_state", "is_cesn", "event_date_parsed")],
            _any(viewed_step()).alias("viewed"),
            _any(named("screener_form_error")).alias("errored"),
            _any(named("screener_form_back")).alias("navigated_back"),
            F.count_if(named("screener_form_error")).alias("error_events"),
        )
    )
    return out.select(
        session_json().alias("session_key"),
        *out.columns[2:],
        steps.step_label(F.col("screener_step_name")).alias("screener_step_label"),
    )


@dataset("mart", grain=["screener_uid", "screener_step_name", "event_date_parsed"], sort_by=["event_date_parsed"])
def mart_screener_step_views_by_screening(c: Catalog) -> DataFrame:
    out = (
        _form_steps(c)
        .where("screener_uid is not null")
        .groupBy("screener_uid", "screener_step_name", "event_date_parsed")
        .agg(F.max("screener_state").alias("screener_state"), _any(viewed_step()).alias("viewed"))
    )
    return out.withColumn("screener_step_label", steps.step_label(F.col("screener_step_name")))


SCREENING_STAGES = {
    "loaded": "screener_results_loaded",
    "details": "screener_program_more_info",
    "applied": "screener_apply_click",
}


@dataset("rows", grain=["event_date", "screener_uid", "ga_session_id"], partition_by=["event_date"])
def ga_screening_days(c: Catalog) -> DataFrame:
    """What one day adds to the state of a screening, by session: a day that is stored never has to be read again.

    Days merge in any order: the first known state comes with its time, flags are or-ed, sessions are a set.
    """
    events = c.source("events").select(
        "event_date",
        param_first("screener_uid").alias("screener_uid"),
        param_first("screener_state").alias("screener_state"),
        param_first("ga_session_id", "int").alias("ga_session_id"),
        "event_timestamp",
        *[named(event).alias(name) for name, event in SCREENING_STAGES.items()],
    )
    return (
        events.where("screener_uid is not null")
        .groupBy("event_date", "screener_uid", "ga_session_id")
        .agg(
            first_known_state().alias("first"),
            F.bool_or(lower_is("screener_state", "cesn")).alias("is_cesn"),
            *[F.bool_or(name).alias(name) for name in SCREENING_STAGES],
        )
    )


@dataset("mart", grain=["screener_uid"], sort_by=["event_date_parsed"])
def mart_screener_screening_funnel(c: Catalog) -> DataFrame:
    """Stages a screening reached over its whole life, merged from its days.

    Most sessions lie within a day, so sessions are counted by (screening, session) first.
    """
    flags = ["is_cesn", *SCREENING_STAGES]
    merged = [F.min("first").alias("first"), F.min("event_date").alias("event_date"), *[F.bool_or(name).alias(name) for name in flags]]
    per_session = c["ga_screening_days"].groupBy("screener_uid", "ga_session_id").agg(*merged)
    out = per_session.groupBy("screener_uid").agg(*merged, F.count("ga_session_id").alias("distinct_sessions"))
    details = F.col("details") | F.col("applied")
    return out.select(
        "screener_uid",
        F.col("first.screener_state").alias("screener_state"),
        event_day().alias("event_date_parsed"),
        "is_cesn",
        "distinct_sessions",
        (F.col("loaded") | details).alias("saw_results"),
        details.alias("viewed_details"),
        "applied",
    )


# --- results ----------------------------------------------------------------


@dataset("rows", partition_by=["event_date"])
def ga_placeholder_rows(c: Catalog) -> DataFrame:
    """Result lists that hold only the "nothing to show" placeholder program."""
    programs = F.filter("items", lambda i: i["item_list_name"] == "results_programs")
    lists = events_since(c.source("events"), c.options.analytics_epoch).where(named("view_item_list"))
    only_placeholder = (F.size(programs) == 1) & (F.get(programs, F.lit(0))["item_id"] == "(not set)")
    return lists.where(only_placeholder).select(
        "event_date",
        event_day().alias("event_date_parsed"),
        param_first("screener_state").alias("screener_state"),
        param_first("screener_uid").alias("screener_uid"),
        "user_pseudo_id",
        param_first("ga_session_id", "int").alias("ga_session_id"),
    ).where("screener_uid is not null")


def _placeholder_impressions(c: Catalog) -> DataFrame:
    flag = F.bool_or(lower_is("screener_state", "cesn"))
    if c.options.coalesce_cesn:
        flag = F.coalesce(flag, F.lit(False))
    return attach_group_values(c["ga_placeholder_rows"], SESSION_KEYS, [flag.alias("is_cesn")])


@dataset("mart", partition_by=["event_date"])
def mart_screener_results_outcomes(c: Catalog) -> DataFrame:
    """Screenings that loaded results, were eligible for none, failed or recovered.

    "None eligible" is its own event or, where that is missing, a placeholder list.
    """
    outcomes = {
        "screener_results_loaded": "screenings_results_loaded",
        "screener_results_none_eligible": "screenings_none_eligible",
        "screener_results_error": "screenings_results_error",
        "screener_results_error_recovery": "screenings_error_recovered",
    }
    keys = [*DAY_STATE, "is_cesn"]
    events = c["stg_ga_screener_results_outcomes"]
    placeholders = _placeholder_impressions(c).withColumn("event_name", F.lit("screener_results_none_eligible"))
    rows = events.select(*keys, "event_name", "screener_uid")
    rows = rows.unionByName(placeholders.select(*keys, "event_name", "screener_uid"))
    seen = [F.max((named(e) & F.col("screener_uid").isNotNull()).cast("int")).alias(n) for e, n in outcomes.items()]
    counts = rows.groupBy(*keys, "screener_uid").agg(*seen).groupBy(*keys)
    counts = counts.agg(*[F.sum(n).alias(n) for n in outcomes.values()])
    decided = F.col("is_cesn").isNotNull()
    counts = counts.withColumns({n: F.when(decided, F.col(n)).otherwise(F.lit(0)) for n in outcomes.values()})

    def middle(x: str) -> Column:
        return F.round(F.percentile_approx(x, F.lit(0.5), F.lit(10000)).cast("double"), 2)

    loaded = events.where(named("screener_results_loaded") & decided)
    values = loaded.groupBy(*keys).agg(
        round_ratio(F.sum("program_count"), F.count("program_count"), 2).alias("avg_program_count"),
        middle("program_count").alias("median_program_count"),
        F.round(F.avg("total_estimated_value"), 2).alias("avg_total_estimated_value"),
        middle("total_estimated_value").alias("median_total_estimated_value"),
    )
    return null_safe_join(counts, values, keys)


@dataset("mart", grain=["screener_uid"], sort_by=["event_date_parsed"])
def mart_screener_results_revisits(c: Catalog) -> DataFrame:
    loads = c["stg_ga_screener_results_outcomes"].where(
        named("screener_results_loaded") & F.col("screener_uid").isNotNull()
    )
    return loads.groupBy("screener_uid").agg(
        F.count(F.lit(1)).alias("results_load_count"),
        F.min("event_date_parsed").alias("event_date_parsed"),
        first_known_state()["screener_state"].alias("screener_state"),
        F.max("is_cesn").alias("is_cesn"),
    )


@dataset("mart", partition_by=["event_date"])
def mart_screener_results_back(c: Catalog) -> DataFrame:
    backs = c["stg_ga_screener_ui_events"].where(
        named("screener_results_back_to_screener") & F.col("screener_uid").isNotNull()
    )
    return counted(backs, DAY_STATE, "total_clicks", "screenings_went_back", "screener_uid")


@dataset("mart", sort_by=["event_date_parsed"])
def mart_screener_scroll_depth(c: Catalog) -> DataFrame:
    """Screenings by the furthest depth they reached in a tab."""
    scroll = c["stg_ga_screener_scroll_depth"].where("depth is not null and tab_name is not null")
    furthest = scroll.groupBy("screener_uid", "tab_name").agg(
        F.max("depth").alias("depth"),
        F.min("event_date_parsed").alias("event_date_parsed"),
        F.max("screener_state").alias("screener_state"),
    )
    keys = ["event_date_parsed", "screener_state", "tab_name", "depth"]
    # One row per screening and tab already, so counting rows counts screenings.
    return furthest.groupBy(*keys).agg(F.count("screener_uid").alias("screenings_reached_depth"))


# --- form detail ------------------------------------------------------------

# Fixed values, first match wins: (label, exact names, prefix).
ERROR_FIELDS = [
    ("Zip code", ["zipcode"], None),
    ("County", ["county"], None),
    ("Household size", ["householdSize"], None),
    ("Household assets", ["householdAssets"], None),
    ("State", ["state"], None),
    ("Referral source", ["referralSource"], None),
    ("Other referral source", ["otherReferrer"], None),
    ("Immediate needs", ["needs"], "needs."),
    ("Member birth month", ["birthMonth", "members.birthMonth"], None),
    ("Member birth year", ["birthYear", "members.birthYear"], None),
    ("Member relationship", ["relationshipToHH", "members.relationshipToHH"], None),
    ("Receives SSI", ["receivesSsi"], None),
    ("Health insurance", ["healthInsurance"], "healthInsurance."),
    ("Household conditions", [], "conditions."),
    ("Student eligibility", [], "studentEligibility."),
    ("Income: employed?", ["incomeEmployed"], None),
    ("Income: gig work?", ["incomeGig"], None),
    ("Income: other payments?", ["incomeOther"], None),
    ("Income amount", ["incomeStreams.incomeAmount"], None),
    ("Income frequency", ["incomeStreams.incomeFrequency"], None),
    ("Income category", ["incomeStreams.incomeCategory"], None),
    ("Income type", ["incomeStreams.incomeStreamName"], None),
    ("Income hours per week", ["incomeStreams.hoursPerWeek"], None),
    ("Income", [], "incomeStreams."),
    ("Expense amount", ["expenses.expenseAmount"], None),
    ("Expense frequency", ["expenses.expenseFrequency"], None),
    ("Expense type", ["expenses.expenseSourceName"], None),
    ("Expenses", ["expenses"], "expenses."),
    ("First name", ["contactInfo.firstName"], None),
    ("Last name", ["contactInfo.lastName"], None),
    ("Email", ["contactInfo.email"], None),
    ("Phone number", ["contactInfo.cell"], None),
    ("Email consent", ["contactInfo.emailConsent"], None),
    ("Consent to contact", ["contactInfo.tcpa"], None),
    ("Contact info", [], "contactInfo."),
    ("Contact preferences", ["contactType"], "contactType."),
    ("Agree to terms", ["agreeToTermsOfService"], None),
    ("Age 13 or older", ["is13OrOlder"], None),
    ("Electricity provider", ["electricityProvider"], None),
    ("Gas provider", ["gasProvider"], None),
    ("Energy calculator", [], "energyCalculator."),
]


def error_field_label(field: Column) -> Column:
    """Exact names first (no exact name falls under an earlier prefix), then prefixes."""
    exact = {name: label for label, names, _ in ERROR_FIELDS for name in names}
    prefixed = None
    for label, _, prefix in ERROR_FIELDS:
        if prefix is not None:
            cond = field.startswith(prefix)
            prefixed = F.when(cond, label) if prefixed is None else prefixed.when(cond, label)
    return F.coalesce(steps.lookup(exact, field), prefixed, field, F.lit("(unspecified)"))


@dataset("mart", partition_by=["event_date"])
def mart_screener_form_errors(c: Catalog) -> DataFrame:
    """Errors by step, field and stated problem."""
    errors = c["stg_ga_screener_form_funnel"].where(
        named("screener_form_error") & F.col("screener_step_name").isNotNull()
    )
    errors = errors.select(
        *DAY_STATE,
        "is_cesn",
        "screener_step_name",
        "screener_uid",
        error_field_label(blank_to_null(F.col("form_field_name"))).alias("error_field_label"),
        F.coalesce(blank_to_null(F.col("form_error_reason")), F.lit("(no detail captured)")).alias("error_problem"),
    )
    keys = [*DAY_STATE, "is_cesn", "screener_step_name", "error_field_label", "error_problem"]
    out = counted(errors, keys, "total_errors", "screenings_with_error", "screener_uid")
    return out.withColumn("screener_step_label", steps.step_label(F.col("screener_step_name"))).drop(
        "screener_step_name"
    )


# Form sections and the step that edits them.
SECTION_LABELS = {
    "zipcode": "Zip Code",
    "householdSize": "Household Size",
    "householdData": "Household & Member Details",
    "hasExpenses": "Expenses",
    "householdAssets": "Assets",
    "hasBenefits": "Current Benefits",
    "acuteHHConditions": "Additional Resources",
    "referralSource": "Referral Source",
    "signUpInfo": "Sign Up",
}


@dataset("mart", partition_by=["event_date"])
def mart_screener_confirmation_edits(c: Catalog) -> DataFrame:
    section = F.col("section")
    edits = c["stg_ga_screener_ui_events"].where(named("screener_confirmation_edit") & section.isNotNull())
    edits = edits.withColumn("section_label", steps.lookup(SECTION_LABELS, section, section))
    return counted(edits, [*DAY_STATE, "section_label"], "total_edits", "screenings", "screener_uid")


@dataset("mart", sort_by=["event_date_parsed"])
def mart_screener_member_income(c: Catalog) -> DataFrame:
    """Member pages viewed, and those where income was added or deleted."""
    page = ["screener_uid", "member_index"]
    present = F.col("screener_uid").isNotNull() & F.col("member_index").isNotNull()
    viewed = c["stg_ga_screener_form_funnel"].where(
        viewed_step() & (F.col("screener_step_name") == "member-details") & present
    )
    viewed = viewed.groupBy(*page).agg(
        F.min("event_date_parsed").alias("event_date_parsed"), F.max("screener_state").alias("screener_state")
    )
    actions = c["stg_ga_screener_section_engagement"].where(named("screener_income_source") & present)
    actions = actions.groupBy(*page).agg(
        F.bool_or(F.col("action") == "add").alias("added"), F.bool_or(F.col("action") == "delete").alias("deleted")
    )
    pages = viewed.join(actions, page, "left")
    return pages.groupBy("event_date_parsed", "screener_state").agg(
        F.count(F.lit(1)).alias("member_pages_viewed"),
        F.count_if("added").alias("member_pages_added_income"),
        F.count_if("deleted").alias("member_pages_deleted_income"),
    )


@dataset("mart", grain=["screener_uid", "section", "action"], sort_by=["event_date_parsed"])
def mart_screener_section_engagement(c: Catalog) -> DataFrame:
    sections = {"screener_household_member": "Household Members", "screener_income_source": "Income Sources"}
    engaged = c["stg_ga_screener_section_engagement"].where("screener_uid is not null")
    engaged = engaged.withColumns(
        {
            "section": steps.lookup(sections, F.col("event_name"), F.col("event_name")),
            "action": F.coalesce("action", F.lit("(unknown)")),
        }
    )
    return engaged.groupBy("screener_uid", "section", "action").agg(
        F.max("screener_state").alias("screener_state"),
        F.max("event_date_parsed").alias("event_date_parsed"),
        F.count(F.lit(1)).alias("total_actions"),
    )


@dataset("mart", partition_by=["event_date"])
def mart_screener_signup_consent(c: Catalog) -> DataFrame:
    """Screenings that signed up, by channel they agreed to."""
    signups = c["stg_ga_screener_ui_events"].where(
        named("screener_signup_completed") & F.col("screener_uid").isNotNull()
    )
    consents = {"sms_opt_ins": "sms_consent", "email_opt_ins": "email_consent"}
    per = signups.groupBy(*DAY_STATE, "screener_uid").agg(
        *[F.max(F.coalesce(F.col(x) == "true", F.lit(False)).cast("int")).alias(n) for n, x in consents.items()]
    )
    return per.groupBy(*DAY_STATE).agg(
        F.count(F.lit(1)).alias("signups"), *[F.sum(n).alias(n) for n in consents]
    )


# --- site chrome, help, language ----------------------------------------------

# Pages of the footer links.
FOOTER_PAGES = ["About Us", "Privacy Policy", "Terms and Conditions"]


@dataset("mart", grain=["element_group", "element", "session_key"], sort_by=["event_date_parsed"])
def mart_screener_footer_engagement(c: Catalog) -> DataFrame:
    """Header and footer elements a session used, under the session's own state."""
    state = F.coalesce("screener_state", "url_screener_state").alias("row_state")
    group = (
        F.when(named("screener_social_click"), "social")
        .when(named("screener_feedback_click"), "feedback_share")
        .otherwise("nav")
    )
    channel, link = F.col("feedback_channel"), F.col("link_name")
    element = (
        F.when(
            named("screener_logo_click"),
            F.concat(F.lit("Logo ("), F.coalesce("location", F.lit("unknown")), F.lit(")")),
        )
        .when(named("screener_language_changed"), "Changed Language")
        .when(named("screener_social_click"), word_caps(F.col("social_network")))
        .when(named("screener_feedback_click") & (channel == "survey"), "Report a Bug")
        .when(named("screener_feedback_click") & (channel == "email"), "Contact Us")
        .when(link.isin(FOOTER_PAGES), link)
    )
    clicks = c["stg_ga_screener_ui_events"].where(
        named(
            "screener_logo_click", "screener_language_changed", "screener_social_click", "screener_feedback_click",
            "screener_link_click",
        )
    )
    clicks = clicks.select(
        *SESSION_KEYS, "event_date_parsed", group.alias("element_group"), element.alias("element"), state
    )
    shares = c["stg_ga_screener_shares"].where("share_location = 'footer' and share_action = 'open'")
    shares = shares.select(
        *SESSION_KEYS,
        "event_date_parsed",
        F.lit("feedback_share").alias("element_group"),
        F.lit("Share").alias("element"),
        state,
    )
    used = (
        clicks.unionByName(shares)
        .groupBy(*SESSION_KEYS, "element_group", "element")
        .agg(F.max("event_date_parsed").alias("event_date_parsed"), F.max("row_state").alias("row_state"))
    )
    # The session's state also comes from its events that are no chrome element.
    states = used.groupBy(*SESSION_KEYS).agg(F.max("row_state").alias("screener_state"))
    out = null_safe_join(used.where("element is not null"), states, SESSION_KEYS)
    return out.select(
        "element_group", "element", session_json().alias("session_key"), "event_date_parsed", "screener_state"
    )


# Resource name keys shown as text.
HELP_RESOURCES = {
    "moreHelp.resource_name1": "2-1-1 Colorado",
    "moreHelp.resource_name2": "Colorado Family Resource Centers",
    "moreHelp.coloradoHumanServicesOffices.resourceName": "Colorado County Human Services",
    "moreHelp.nc_resource_name1": "NC 2-1-1",
}


@dataset("mart", partition_by=["event_date"])
def mart_screener_help(c: Catalog) -> DataFrame:
    """Three help metrics in one long table."""
    metrics = {
        "screener_help_click": "help_click",
        "screener_get_help_click": "get_help_click",
        "screener_more_help_resource_click": "more_help_resource_click",
    }
    resource = F.coalesce(
        steps.lookup(HELP_RESOURCES, F.col("resource_name")),
        "resource_name",
        F.nullif("url", F.lit("")),
        F.concat(F.lit("Resource #"), F.col("resource_index").cast("string")),
    )
    dimension = (
        F.when(named("screener_help_click"), F.col("help_topic"))
        .when(named("screener_get_help_click"), F.col("location"))
        .otherwise(resource)
    )
    rows = c["stg_ga_screener_help"].select(
        *DAY_STATE,
        "screener_uid",
        steps.lookup(metrics, F.col("event_name")).alias("metric"),
        F.coalesce(dimension, F.lit("(unspecified)")).alias("dimension"),
        F.when(named("screener_help_click"), F.col("screener_step_name")).alias("screener_step_name"),
    )
    keys = [*DAY_STATE, "metric", "dimension", "screener_step_name"]
    out = counted(rows, keys, "total_clicks", "distinct_screenings", "screener_uid")
    return out.withColumn("screener_step_label", steps.step_label(F.col("screener_step_name")))


@dataset("mart", partition_by=["event_date"])
def mart_screener_language(c: Catalog) -> DataFrame:
    changes = c["stg_ga_screener_step_interactions"].where(
        named("screener_language_changed") & F.col("language_name").isNotNull()
    )
    changes = changes.withColumn("screener_state", F.coalesce("screener_state", "url_screener_state"))
    return counted(changes, [*DAY_STATE, "language_name"], "total_changes", "distinct_screenings", SESSION_KEYS)


# The link that leads back to a step.
EDIT_STEP_LINK = "Additional Resources — Edit Step"


@dataset("mart", partition_by=["event_date"])
def mart_screener_link_clicks(c: Catalog) -> DataFrame:
    """Links inside steps and results; footer links are counted elsewhere."""
    name, place = F.col("link_name"), F.col("link_location")
    in_footer = F.coalesce(place == "footer", F.lit(False)) | (
        place.isNull() & F.coalesce(name.isin(FOOTER_PAGES), F.lit(False))
    )
    edits = (place == "results_needs") | (place.isNull() & (name == EDIT_STEP_LINK))
    clicks = c["stg_ga_screener_ui_events"].where(named("screener_link_click") & ~in_footer)
    clicks = clicks.withColumns(
        {
            "link_group": F.when(edits, "edit_nav").otherwise("in_step"),
            "link_label": F.coalesce(name, F.lit("(unnamed)")),
        }
    )
    keys = [*DAY_STATE, "link_group", "link_location", "link_label", "screener_step_name"]
    out = counted(clicks, keys, "total_clicks", "screenings", SESSION_KEYS)
    return out.withColumn("screener_step_label", steps.step_label(F.col("screener_step_name")))


@dataset("mart", partition_by=["event_date"])
def mart_screener_filter_usage(c: Catalog) -> DataFrame:
    used = c["stg_ga_screener_ui_events"].where(
        named("screener_filter_engaged") & F.col("screener_uid").isNotNull()
    )
    used = used.withColumn("filter_type", F.coalesce("filter_type", F.lit("(unknown)")))
    return counted(used, [*DAY_STATE, "filter_type"], "total_engagements", "screenings_engaged", "screener_uid")


def nps_category(score: Column) -> Column:
    return F.when(score <= 6, "Detractor").when(score <= 8, "Passive").when(score.isNotNull(), "Promoter")


@dataset("mart", partition_by=["event_date"])
def mart_screener_nps(c: Catalog) -> DataFrame:
    counts = {
        "screener_nps_score_submitted": "scores_submitted",
        "screener_nps_reason_submitted": "reasons_submitted",
        "screener_nps_reason_skipped": "reasons_skipped",
        "screener_feedback_click": "feedback_clicks",
    }
    rows = c["stg_ga_screener_ui_events"].where(named(*counts))
    out = rows.groupBy(*DAY_STATE, "nps_score").agg(
        *[F.count_if(named(event)).alias(name) for event, name in counts.items()]
    )
    return out.withColumn("nps_category", nps_category(F.col("nps_score")))


# --- sharing and saving -------------------------------------------------------


@dataset("mart", partition_by=["event_date"])
def mart_screener_shares(c: Catalog) -> DataFrame:
    shares = c["stg_ga_screener_shares"].where(named("screener_share"))
    keys = [*DAY_STATE, "share_location", "share_channel", "share_provider", "share_action"]
    return counted(shares, keys, "total_shares", "screenings_with_share", "screener_uid")


@dataset("mart", partition_by=["event_date"])
def mart_screener_saves(c: Catalog) -> DataFrame:
    """Saves by channel and action, plus one marker row each for savers and popups shown.

    The kinds of row never overlap, so any sum over the table stays additive.
    """
    saves = c["stg_ga_screener_shares"].where(named("screener_results_save"))
    action = F.col("save_action")
    zero = F.lit(0).cast("bigint")
    detail = saves.groupBy(*DAY_STATE, "save_channel", "save_action").agg(F.count(F.lit(1)).alias("total_saves"))
    sent = counted(saves.where(action == "send"), DAY_STATE, "_rows", "screenings_with_save", "screener_uid")
    shown = counted(
        saves.where(action == "open"), DAY_STATE, "total_popup_impressions", "screenings_shown_popup", "screener_uid"
    )
    measures = ["total_saves", "screenings_with_save", "total_popup_impressions", "screenings_shown_popup"]
    kinds = [
        detail,
        sent.drop("_rows").withColumn("save_action", F.lit("__saved__")),
        shown.withColumn("save_action", F.lit("__popup_shown__")),
    ]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), kinds)
    return out.withColumns({m: F.coalesce(F.col(m), zero) for m in measures})


# --- programs, navigators, resources ------------------------------------------

# Interaction kinds by event.
INTERACTIONS = {
    "screener_apply_click": "apply",
    "screener_program_more_info": "more_info",
    "screener_program_visit_website": "visit_website",
    "screener_program_phone_click": "phone_click",
    "screener_program_document_download": "document_download",
    "screener_program_document_shown": "document_shown",
    "screener_required_program_click": "required_program_click",
    "screener_program_shown": "shown",
}


def _program_events(c: Catalog) -> DataFrame:
    rows = c["stg_ga_screener_program_interactions"].where(
        named(*INTERACTIONS) & F.col("program_id").isNotNull()
    )
    return rows.withColumn("interaction_type", steps.lookup(INTERACTIONS, F.col("event_name"))).drop("program_name")


def _with_program_name(c: Catalog, df: DataFrame) -> DataFrame:
    out = df.join(c["int_screener_program_names"], "program_id", "left")
    return out.withColumn("program_name", F.coalesce("program_name", "program_id"))


@dataset("mart", partition_by=["event_date"])
def mart_screener_program_interactions(c: Catalog) -> DataFrame:
    rows = _program_events(c).where(F.col("program_id") != "(not set)")
    keys = [*DAY_STATE, "program_id", "interaction_type", "document_name"]
    totals = counted(rows, keys, "total_interactions", "screenings_with_interaction", "screener_uid")
    return _with_program_name(c, totals)


@dataset("mart", sort_by=["event_date_parsed"])
def mart_screener_program_interactions_by_screening(c: Catalog) -> DataFrame:
    """Distinct interactions per screening; the placeholder program stays in."""
    keys = [
        "event_date_parsed", "screener_state", "interaction_type", "program_id", "document_name", "screener_uid",
    ]
    return _with_program_name(c, _program_events(c).select(*keys).distinct())


@dataset("mart", partition_by=["event_date"])
def mart_screener_navigator_engagement(c: Catalog) -> DataFrame:
    """Navigator contacts by method, and impressions under their own method."""
    rows = c["stg_ga_screener_program_interactions"].where(
        named("screener_navigator_engaged", "screener_navigator_shown")
        & F.col("program_id").isNotNull()
        & F.col("navigator_id").isNotNull()
    )
    rows = rows.withColumn(
        "contact_method",
        F.when(named("screener_navigator_shown"), F.lit("__shown__")).otherwise(F.col("contact_method")),
    )
    keys = [*DAY_STATE, "program_id", "navigator_id", "contact_method"]
    per = rows.groupBy(*keys, "screener_uid").agg(
        F.max("navigator_name").alias("navigator_name"), F.count(F.lit(1)).alias("n")
    )
    totals = per.groupBy(*keys).agg(
        F.max("navigator_name").alias("navigator_name"),
        F.sum("n").alias("total_engagements"),
        F.count("screener_uid").alias("screenings_with_engagement"),
    )
    return _with_program_name(c, totals)


def _resource_rows(c: Catalog) -> DataFrame:
    metrics = {
        "screener_results_tab_click": "tab_open",
        "screener_resource_shown": "resource_shown",
        "screener_additional_resource_more_info": "resource_more_info",
        "screener_additional_resource_click": "resource_click",
    }
    in_tab = named("screener_results_tab_click")
    rows = c["stg_ga_screener_resource_engagement"].select(
        *DAY_STATE,
        "screener_uid",
        "is_cesn",
        steps.lookup(metrics, F.col("event_name")).alias("metric"),
        F.when(in_tab, F.col("tab_name")).otherwise(F.col("resource_name")).alias("dimension"),
        F.when(named("screener_additional_resource_click"), F.col("contact_method")).alias("contact_method"),
    )
    return rows.where("dimension is not null")


@dataset("mart", partition_by=["event_date"])
def mart_screener_resource_engagement(c: Catalog) -> DataFrame:
    keys = [*DAY_STATE, "is_cesn", "metric", "dimension", "contact_method"]
    return counted(_resource_rows(c), keys, "total_clicks", "distinct_screenings", "screener_uid")


@dataset("mart", sort_by=["event_date_parsed"])
def mart_screener_resource_engagement_by_screening(c: Catalog) -> DataFrame:
    return _resource_rows(c).drop("event_date").distinct()
