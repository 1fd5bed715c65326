"""Dashboard queries on the event marts.

Each takes the catalog and an EventScope. ``form`` names which of the scope's
state rules a mart is read under when no tenant is set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenmart.catalog import Catalog
from screenmart.functions import steps
from screenmart.functions.numbers import banded, pct, round_ratio
from screenmart.functions.steps import lookup
from screenmart.functions.text import word_caps
from screenmart.operators.scope import EventScope
from screenmart.plans.event_marts import EDIT_STEP_LINK, nps_category


def scoped(c: Catalog, mart: str, s: EventScope, form: str = "plain") -> DataFrame:
    rows = c[mart]
    kept = getattr(s, form)() & s.window()
    # Day-split tables are pruned by the day as they store it.
    return rows.where(kept & s.days() if "event_date" in rows.columns else kept)


def capped(value: Column) -> Column:
    """Ceiling of 100 that keeps NULL."""
    return F.when(value.isNotNull(), F.least(value, F.lit(100.0)))


def total(df: DataFrame, column: str, alias: str = "n") -> DataFrame:
    return df.agg(F.sum(column).alias(alias))


def row_count(df: DataFrame, alias: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def result_viewers(c: Catalog, s: EventScope) -> Column:
    """Screenings that loaded results, the denominator of many cards."""
    return row_count(scoped(c, "mart_screener_results_revisits", s, "flagged")).scalar()


def rows_of(df: DataFrame, pairs: list[tuple[str, str]], name: str, value: str) -> DataFrame:
    """(label, column) pairs of a one-row frame as ordered rows."""
    wide = df.select(*[F.col(column).cast("bigint").alias(label) for label, column in pairs])
    long = wide.unpivot([], [label for label, _ in pairs], name, value)
    order = {label: i for i, (label, _) in enumerate(pairs)}
    return long.orderBy(lookup(order, F.col(name)))


# --- funnels --------------------------------------------------------------------


def conversion_funnel(c: Catalog, s: EventScope) -> DataFrame:
    stages = {"saw_results": "Saw Results", "viewed_details": "Viewed Details", "applied": "Clicked Apply"}
    counts = scoped(c, "mart_screener_screening_funnel", s, "flagged").agg(
        F.count(F.lit(1)).alias("created"), *[F.count_if(x).alias(x) for x in stages]
    )
    pairs = [("Screeners Created", "created"), *[(label, x) for x, label in stages.items()]]
    return rows_of(counts, pairs, "funnel_step", "screenings")


def sessions_per_screener(c: Catalog, s: EventScope) -> DataFrame:
    rows = scoped(c, "mart_screener_screening_funnel", s, "flagged").where("distinct_sessions > 0")
    order = F.least("distinct_sessions", F.lit(4))
    counts = rows.groupBy(order.alias("sort_order")).agg(F.count(F.lit(1)).alias("n"))
    everything = F.sum("n").over(Window.partitionBy())  # at most four rows
    label = F.when(F.col("sort_order") == 4, "4+").otherwise(F.col("sort_order").cast("string"))
    return counts.select(
        label.alias("sessions"), pct("n", everything).alias("pct_of_screeners"), "sort_order"
    ).orderBy("sort_order")


def _reached(ladder: DataFrame, sessions: DataFrame, entry_rank: int) -> DataFrame:
    """Sessions at or beyond each rung.

    Sessions are counted per furthest rank first; the running sum then has no more
    rows than the ladder.
    """
    at = sessions.groupBy(F.col("furthest_step_rank").alias("funnel_rank")).agg(F.count(F.lit(1)).alias("n"))
    down = Window.partitionBy(F.lit(0)).orderBy(F.desc("funnel_rank"))
    rungs = F.broadcast(ladder.where("funnel_rank is not null")).join(at, "funnel_rank", "left")
    rungs = rungs.withColumn("sessions", F.coalesce(F.sum("n").over(down), F.lit(0)))
    entry = F.max(F.when(F.col("funnel_rank") == entry_rank, F.col("sessions"))).over(Window.partitionBy(F.lit(0)))
    return (
        rungs.withColumn("pct_of_started", pct("sessions", entry))
        .where("sessions > 0")
        .orderBy("funnel_rank")
        .select("screener_step_label", "pct_of_started", "sessions")
    )


def step_funnel(c: Catalog, s: EventScope) -> DataFrame:
    sessions = scoped(c, "mart_screener_furthest_step", s, "flagged")
    return _reached(c["mart_screener_step_ladder"], sessions, 1)


def energy_step_funnel(c: Catalog, s: EventScope) -> DataFrame:
    """All energy-program sessions; the state scope does not apply."""
    sessions = c["mart_screener_cesn_funnel"].where(s.window())
    return _reached(c["mart_screener_cesn_combined_ladder"], sessions, 0)


def _step_rate(c: Catalog, s: EventScope, flag: str, aggs: list[Column], kept: list[str]) -> DataFrame:
    facts = scoped(c, "mart_screener_step_facts", s, "flagged")
    out = facts.groupBy(F.col("screener_step_label").alias("step")).agg(
        F.count_if("viewed").alias("viewed"), F.count_if(flag).alias("screenings"), *aggs
    )
    rate = pct("screenings", "viewed").alias("pct_of_viewers")
    return out.where("screenings > 0").select("step", rate, "screenings", *kept).orderBy(
        F.desc_nulls_last("pct_of_viewers"), "step"
    )


def errors_by_step(c: Catalog, s: EventScope) -> DataFrame:
    return _step_rate(c, s, "errored", [F.sum("error_events").alias("total_errors")], ["total_errors"])


def back_navigation_by_step(c: Catalog, s: EventScope) -> DataFrame:
    return _step_rate(c, s, "navigated_back", [], [])


# --- results ----------------------------------------------------------------------


def results_revisits(c: Catalog, s: EventScope) -> DataFrame:
    n = F.col("results_load_count")
    label, order = banded(n, [("1 time", n == 1), ("2 times", n == 2)], "3+ times")
    rows = scoped(c, "mart_screener_results_revisits", s, "flagged")
    out = rows.groupBy(label.alias("times_viewed"), order.alias("sort_key"))
    return out.agg(F.count(F.lit(1)).alias("screenings")).orderBy("sort_key")


def results_viewed(c: Catalog, s: EventScope) -> DataFrame:
    return row_count(scoped(c, "mart_screener_results_revisits", s, "flagged"), "results_viewed")


def eligible_share(c: Catalog, s: EventScope) -> DataFrame:
    """Share of result viewers eligible for something; daily counts may overlap, hence the floor."""
    none = total(scoped(c, "mart_screener_results_outcomes", s, "flagged"), "screenings_none_eligible").scalar()
    viewed = row_count(scoped(c, "mart_screener_results_revisits", s, "flagged"))
    some = F.greatest(F.col("n") - F.coalesce(none, F.lit(0)), F.lit(0))
    return viewed.select(pct(some, "n").alias("pct_eligible"))


def results_error_rate(c: Catalog, s: EventScope) -> DataFrame:
    out = scoped(c, "mart_screener_results_outcomes", s, "flagged").agg(
        F.coalesce(F.sum("screenings_results_error"), F.lit(0)).alias("errored"),
        F.coalesce(F.sum("screenings_results_loaded"), F.lit(0)).alias("loaded"),
    )
    return out.select(pct("errored", F.col("errored") + F.col("loaded")).alias("error_rate"))


# --- sharing and saving ---------------------------------------------------------------

# Channel names.
CHANNELS = {"email": "Email", "sms": "SMS", "whatsapp": "WhatsApp", "copy_link": "Copy Link"}


def channel_name(channel: Column) -> Column:
    return lookup(CHANNELS, channel, F.coalesce(channel, F.lit("(none)")))


def _share_funnel(c: Catalog, s: EventScope, place: str, shown: Column, first: str) -> DataFrame:
    shares = scoped(c, "mart_screener_shares", s).where(F.col("share_location") == place)

    def by(action: str) -> Column:
        return F.sum(F.when(F.col("share_action") == action, F.col("screenings_with_share")).otherwise(0))

    counts = shares.agg(by("open").alias("opened"), by("send").alias("sent")).withColumn("shown", shown)
    return rows_of(counts, [(first, "shown"), ("Opened", "opened"), ("Sent", "sent")], "funnel_step", "screenings")


def share_funnel_popup(c: Catalog, s: EventScope) -> DataFrame:
    return _share_funnel(c, s, "results_popup", result_viewers(c, s), "Shown (reached results)")


def share_funnel_footer(c: Catalog, s: EventScope) -> DataFrame:
    starts = scoped(c, "mart_screener_form_funnel", s, "flagged")
    starts = starts.where(F.col("screener_step_name") == steps.FORM_START)
    return _share_funnel(c, s, "footer", total(starts, "screenings_viewed_step").scalar(), "Shown (started screener)")


def shares_by_channel(c: Catalog, s: EventScope) -> DataFrame:
    sent = scoped(c, "mart_screener_shares", s).where("share_action = 'send'")
    out = sent.groupBy(
        channel_name(F.col("share_channel")).alias("channel"),
        F.coalesce("share_provider", F.lit("(none)")).alias("provider"),
    )
    return out.agg(F.sum("total_shares").alias("total_shares")).orderBy(F.desc("total_shares"), "channel", "provider")


def save_funnel(c: Catalog, s: EventScope) -> DataFrame:
    counts = scoped(c, "mart_screener_saves", s).agg(
        F.sum("screenings_shown_popup").alias("opened"), F.sum("screenings_with_save").alias("saved")
    )
    counts = counts.withColumn("shown", result_viewers(c, s))
    pairs = [("Shown (reached results)", "shown"), ("Opened Save Popup", "opened"), ("Saved", "saved")]
    return rows_of(counts, pairs, "funnel_step", "screenings")


def saves_by_channel(c: Catalog, s: EventScope) -> DataFrame:
    sent = scoped(c, "mart_screener_saves", s).where("save_action = 'send'")
    out = sent.groupBy(channel_name(F.col("save_channel")).alias("channel"))
    return out.agg(F.sum("total_saves").alias("total_saves")).orderBy(F.desc("total_saves"), "channel")


# --- programs, navigators, documents ---------------------------------------------------


def _per_program(c: Catalog, s: EventScope, by_state: bool) -> DataFrame:
    keys = ["program_id", "screener_state"] if by_state else ["program_id"]
    kinds = {"shown": "shown", "more_info": "more_info", "applied": "apply"}

    def seen(kind: str) -> Column:
        return F.sum(
            F.when(F.col("interaction_type") == kind, F.col("screenings_with_interaction")).otherwise(0)
        )

    return (
        scoped(c, "mart_screener_program_interactions", s)
        .groupBy(*keys)
        .agg(F.max("program_name").alias("program_name"), *[seen(kind).alias(out) for out, kind in kinds.items()])
    )


def _program_label(by_state: bool) -> Column:
    name = F.col("program_name")
    return F.concat(name, F.lit(" ("), F.upper("screener_state"), F.lit(")")) if by_state else name


def most_shown_programs(c: Catalog, s: EventScope, by_state: bool = False, k: int = 15) -> DataFrame:
    rows = _per_program(c, s, by_state).where("shown > 0")
    rows = rows.select(_program_label(by_state).alias("program"), "shown", "program_id")
    return rows.orderBy(F.desc("shown"), "program", "program_id").limit(k).drop("program_id")


def program_detail_rate(
    c: Catalog, s: EventScope, by_state: bool = False, least: int | None = None, k: int = 15
) -> DataFrame:
    """Programs by the share of their impressions that led to details; rarely shown ones left out."""
    least = (20 if by_state else 5) if least is None else least
    rows = _per_program(c, s, by_state).where(F.col("shown") >= least)
    rows = rows.select(
        _program_label(by_state).alias("program"), pct("more_info", "shown").alias("detail_rate"), "program_id"
    )
    return rows.orderBy(F.desc("detail_rate"), "program", "program_id").limit(k).drop("program_id")


def program_conversion(c: Catalog, s: EventScope, by_state: bool = False, least: int | None = None) -> DataFrame:
    least = (20 if by_state else 5) if least is None else least
    tenant = [F.upper("screener_state").alias("white_label")] if by_state else []
    rows = _per_program(c, s, by_state).where(F.col("shown") >= least)
    return rows.select(
        F.col("program_name").alias("program"),
        *tenant,
        "shown",
        "more_info",
        "applied",
        pct("more_info", "shown").alias("shown_to_details"),
        pct("applied", "more_info").alias("details_to_applied"),
        pct("applied", "shown").alias("shown_to_applied"),
    ).orderBy(F.desc("shown_to_details"), "program")


def navigator_engagement(c: Catalog, s: EventScope, by_state: bool = False) -> DataFrame:
    keys = ["program_id", "navigator_id", *(["screener_state"] if by_state else [])]
    method = F.col("contact_method")

    def contacts(kind: str) -> Column:
        return F.sum(F.when(method == kind, F.col("total_engagements")).otherwise(0))

    kinds = ["website", "email", "phone"]
    rows = scoped(c, "mart_screener_navigator_engagement", s).groupBy(*keys)
    rows = rows.agg(
        F.max("program_name").alias("program"),
        F.max("navigator_name").alias("navigator"),
        F.sum(F.when(method == "__shown__", F.col("screenings_with_engagement")).otherwise(0)).alias("shown"),
        *[contacts(kind).alias(kind) for kind in kinds],
    )
    used = sum((F.col(kind) for kind in kinds), F.lit(0))
    tenant = [F.upper("screener_state").alias("white_label")] if by_state else []
    rows = rows.where(F.col("shown") + used > 0).orderBy(F.desc("shown"), used.desc(), "navigator", "program")
    return rows.select("navigator", "program", *tenant, "shown", *kinds)


def document_downloads(c: Catalog, s: EventScope) -> DataFrame:
    kinds = {"shown": "document_shown", "downloaded": "document_download"}
    keys = ["program_id", "document_name"]
    rows = scoped(c, "mart_screener_program_interactions_by_screening", s).where(
        F.col("interaction_type").isin(list(kinds.values())) & F.col("document_name").isNotNull()
    )
    per = rows.groupBy(*keys, "screener_uid").agg(
        F.max("program_name").alias("program"),
        *[
            F.max(((F.col("interaction_type") == kind) & F.col("screener_uid").isNotNull()).cast("int")).alias(out)
            for out, kind in kinds.items()
        ],
    )
    out = per.groupBy(*keys).agg(F.max("program").alias("program"), *[F.sum(x).alias(x) for x in kinds])
    rate = capped(pct("downloaded", "shown")).alias("download_rate")
    return (
        out.where(F.col("shown") + F.col("downloaded") > 0)
        .select(F.col("document_name").alias("document"), "program", "shown", "downloaded", rate)
        .orderBy(F.desc("downloaded"), F.desc("shown"), "document", "program")
    )


# --- resources ----------------------------------------------------------------------------


def resource_engagement(c: Catalog, s: EventScope, k: int = 20) -> DataFrame:
    """Resources by the screenings that saw, opened, visited or called them."""
    metric, clicked = F.col("metric"), F.col("metric") == "resource_click"
    kinds = {
        "shown": metric == "resource_shown",
        "more_info": metric == "resource_more_info",
        "website": clicked & (F.col("contact_method") == "website"),
        "phone": clicked & (F.col("contact_method") == "phone"),
    }
    rows = scoped(c, "mart_screener_resource_engagement_by_screening", s, "flagged").where(
        metric.isin("resource_shown", "resource_more_info", "resource_click") & F.col("screener_uid").isNotNull()
    )
    per = rows.groupBy(F.col("dimension").alias("resource"), "screener_uid").agg(
        *[F.max(F.coalesce(cond, F.lit(False)).cast("int")).alias(out) for out, cond in kinds.items()]
    )
    out = per.groupBy("resource").agg(*[F.sum(x).alias(x) for x in kinds])
    used = sum((F.col(x) for x in kinds), F.lit(0))
    return out.where(used > 0).orderBy(F.desc("shown"), F.desc("more_info"), "resource").limit(k)


def resources_tab_engagement(c: Catalog, s: EventScope) -> DataFrame:
    opened = scoped(c, "mart_screener_resource_engagement_by_screening", s, "flagged").where(
        "metric = 'tab_open' and dimension = 'additional_resources'"
    )
    n = opened.agg(F.countDistinct("screener_uid").alias("opened_additional_resources"))
    rate = pct("opened_additional_resources", result_viewers(c, s)).alias("pct_of_results_viewers")
    return n.select(rate, "opened_additional_resources")


def _resources_tab(c: Catalog, s: EventScope) -> DataFrame:
    return scoped(c, "mart_screener_resource_engagement", s, "flagged").where(
        "metric = 'tab_open' and dimension = 'additional_resources'"
    )


def _edit_links(c: Catalog, s: EventScope) -> DataFrame:
    return scoped(c, "mart_screener_link_clicks", s).where(
        (F.col("link_group") == "edit_nav") & (F.col("link_label") == EDIT_STEP_LINK)
    )


def additional_resources_edits(c: Catalog, s: EventScope) -> DataFrame:
    openers = total(_resources_tab(c, s), "distinct_screenings").scalar()
    n = _edit_links(c, s).agg(F.coalesce(F.sum("screenings"), F.lit(0)).alias("screenings_that_edited"))
    return n.select(capped(pct("screenings_that_edited", openers)).alias("pct_of_tab_openers"), "screenings_that_edited")


# --- reading and help -----------------------------------------------------------------------

# Depth and tab names.
DEPTHS = {25: "1. Quarter Page", 50: "2. Half Page", 75: "3. Three-Quarter Page", 100: "4. Full Page"}
TABS = {"long_term_benefits": "Long-Term Benefits", "additional_resources": "Additional Resources"}


def scroll_depth(c: Catalog, s: EventScope) -> DataFrame:
    rows = scoped(c, "mart_screener_scroll_depth", s).groupBy("depth", "tab_name")
    rows = rows.agg(F.sum("screenings_reached_depth").alias("screenings"))
    in_tab = F.sum("screenings").over(Window.partitionBy("tab_name"))  # few depths per tab
    depth = lookup(DEPTHS, F.col("depth").cast("int"), F.concat(F.col("depth").cast("string"), F.lit("%")))
    tab = lookup(TABS, F.col("tab_name"), F.coalesce("tab_name", F.lit("(unknown)")))
    shown = rows.withColumns({"pct_of_tab_scrollers": pct("screenings", in_tab), "depth_label": depth, "tab": tab})
    return shown.orderBy("depth", "tab").select(
        F.col("depth_label").alias("depth"), "tab", "pct_of_tab_scrollers", "screenings"
    )


def help_by_topic(c: Catalog, s: EventScope) -> DataFrame:
    """Help clicks by topic as a share of the step's viewers.

    Clickers are summed over days, viewers are distinct over the window, hence the cap.
    """
    topic = word_caps(F.replace(F.col("dimension"), F.lit("-"), F.lit(" ")))
    clicks = scoped(c, "mart_screener_help", s).where("metric = 'help_click' and screener_step_name is not null")
    clicks = clicks.groupBy("screener_step_name", topic.alias("help_topic")).agg(
        F.sum("distinct_screenings").alias("clicked"), F.sum("total_clicks").alias("clicks")
    )
    viewers = scoped(c, "mart_screener_step_views_by_screening", s).where("viewed")
    viewers = viewers.select("screener_step_name", "screener_uid").distinct().groupBy("screener_step_name")
    viewers = viewers.agg(F.count(F.lit(1)).alias("viewers"))
    rate = capped(pct("clicked", "viewers")).alias("pct_of_step_viewers")
    joined = clicks.join(viewers, "screener_step_name", "left")
    return joined.select("help_topic", rate, "clicks").orderBy(F.desc_nulls_last("pct_of_step_viewers"), "help_topic")


def more_help_resources(c: Catalog, s: EventScope) -> DataFrame:
    rows = scoped(c, "mart_screener_help", s).where("metric = 'more_help_resource_click'")
    rows = rows.groupBy(F.col("dimension").alias("resource")).agg(
        F.sum("distinct_screenings").alias("distinct_screeners"), F.sum("total_clicks").alias("total_clicks")
    )
    return rows.orderBy(F.desc("total_clicks"), "resource")


def _get_help(c: Catalog, s: EventScope) -> DataFrame:
    return scoped(c, "mart_screener_help", s).where("metric = 'get_help_click'")


def get_help_clicks(c: Catalog, s: EventScope) -> DataFrame:
    n = _get_help(c, s).agg(
        F.coalesce(F.sum("distinct_screenings"), F.lit(0)).alias("clicked"),
        F.coalesce(F.sum("total_clicks"), F.lit(0)).alias("more_help_clicks"),
    )
    return n.select(capped(pct("clicked", result_viewers(c, s))).alias("pct_of_results_viewers"), "more_help_clicks")


# --- form sections --------------------------------------------------------------------------

# Member actions in display order.
MEMBER_ACTIONS = {
    "add": "Add",
    "delete": "Delete",
    "edit_from_summary": "Edit (from summary)",
    "delete_from_summary": "Delete (from summary)",
}


def household_member_actions(c: Catalog, s: EventScope) -> DataFrame:
    """Member actions as a share of everyone who viewed a member step or acted on one."""
    views = scoped(c, "mart_screener_step_views_by_screening", s).where(
        F.col("screener_step_name").isin("member-basics", "household-members") & F.col("viewed")
    )
    acted = scoped(c, "mart_screener_section_engagement", s).where("section = 'Household Members'")
    people = views.select("screener_uid").unionByName(acted.select("screener_uid")).distinct()
    viewers = people.agg(F.count("screener_uid").alias("n")).scalar()
    action = F.col("action")
    order = lookup({a: i for i, a in enumerate(MEMBER_ACTIONS, start=1)}, action, F.lit(5))
    rows = acted.groupBy("action").agg(
        F.count("screener_uid").alias("screenings"), F.sum("total_actions").alias("total_actions")
    )
    return rows.orderBy(order, "action").select(
        lookup(MEMBER_ACTIONS, action, word_caps(action)).alias("action"),
        pct("screenings", viewers).alias("pct_of_viewers"),
        "screenings",
        "total_actions",
    )


def income_source_actions(c: Catalog, s: EventScope) -> DataFrame:
    sums = scoped(c, "mart_screener_member_income", s).agg(
        F.sum("member_pages_viewed").alias("viewed"),
        F.sum("member_pages_added_income").alias("added"),
        F.sum("member_pages_deleted_income").alias("deleted"),
    )
    sums = sums.where("viewed > 0").select(
        "viewed", F.col("added").alias("Add"), F.col("deleted").alias("Delete")
    )
    rows = sums.unpivot(["viewed"], ["Add", "Delete"], "action", "pages")
    return rows.select("action", pct("pages", "viewed").alias("pct_of_member_pages"), "pages").orderBy("action")


def confirmation_edits(c: Catalog, s: EventScope) -> DataFrame:
    viewers = scoped(c, "mart_screener_step_facts", s, "flagged").where(
        (F.col("screener_step_name") == "confirm-information") & F.col("viewed")
    )
    n = row_count(viewers).scalar()  # one row per session and step
    rows = scoped(c, "mart_screener_confirmation_edits", s).groupBy(F.col("section_label").alias("section"))
    rows = rows.agg(F.sum("screenings").alias("screenings"))
    return rows.select("section", pct("screenings", n).alias("pct_of_viewers"), "screenings").orderBy(
        F.desc("screenings"), "section"
    )


def signup_consent(c: Catalog, s: EventScope) -> DataFrame:
    sums = scoped(c, "mart_screener_signup_consent", s).agg(
        F.sum("signups").alias("signups"), F.sum("sms_opt_ins").alias("SMS"), F.sum("email_opt_ins").alias("Email")
    )
    rows = sums.unpivot(["signups"], ["SMS", "Email"], "channel", "opt_ins")
    return rows.select("channel", pct("opt_ins", "signups").alias("pct_opted_in"), "opt_ins").orderBy(F.desc("channel"))


def filter_usage(c: Catalog, s: EventScope) -> DataFrame:
    n = scoped(c, "mart_screener_filter_usage", s).agg(
        F.coalesce(F.sum("screenings_engaged"), F.lit(0)).alias("filtered_screenings")
    )
    rate = pct("filtered_screenings", result_viewers(c, s)).alias("pct_of_results_viewers")
    return n.select(rate, "filtered_screenings")


def errors_detail(c: Catalog, s: EventScope) -> DataFrame:
    rows = scoped(c, "mart_screener_form_errors", s, "flagged").groupBy(
        F.col("screener_step_label").alias("step"),
        F.col("error_field_label").alias("field"),
        F.col("error_problem").alias("problem"),
    )
    return rows.agg(F.sum("total_errors").alias("errors")).orderBy(F.desc("errors"), "step", "field", "problem")


# --- feedback ----------------------------------------------------------------------------------


def nps_distribution(c: Catalog, s: EventScope) -> DataFrame:
    """Responses for every score 0-10; a score nobody gave has no number."""
    axis = c.spark.range(11).select(F.col("id").alias("nps_score"))
    counts = scoped(c, "mart_screener_nps", s).where("nps_score is not null").groupBy("nps_score")
    counts = counts.agg(F.sum("scores_submitted").alias("responses"))
    return (
        axis.join(counts, "nps_score", "left")
        .orderBy("nps_score")
        .select(
            F.col("nps_score").cast("string").alias("score"),
            nps_category(F.col("nps_score")).alias("category"),
            "responses",
        )
    )


def nps_engagement(c: Catalog, s: EventScope) -> DataFrame:
    n = scoped(c, "mart_screener_nps", s).agg(F.coalesce(F.sum("scores_submitted"), F.lit(0)).alias("scored_nps"))
    return n.select(pct("scored_nps", result_viewers(c, s)).alias("pct_of_results_viewers"), "scored_nps")


def back_to_screener(c: Catalog, s: EventScope) -> DataFrame:
    n = scoped(c, "mart_screener_results_back", s).agg(
        F.coalesce(F.sum("screenings_went_back"), F.lit(0)).alias("went_back")
    )
    return n.select(capped(pct("went_back", result_viewers(c, s))).alias("pct_of_results_viewers"), "went_back")


# --- site chrome -----------------------------------------------------------------------------------


def _chrome(c: Catalog, s: EventScope, group: str) -> DataFrame:
    """Sessions that used each element, as a share of all screener sessions."""
    facts = scoped(c, "mart_screener_step_facts", s, "flagged")
    sessions = facts.select("session_key").distinct().agg(F.count("session_key").alias("n")).scalar()
    rows = scoped(c, "mart_screener_footer_engagement", s, "site").where(F.col("element_group") == group)
    rows = rows.groupBy("element").agg(F.count("session_key").alias("sessions"))  # one row per session and element
    return rows.select("element", capped(pct("sessions", sessions)).alias("pct_of_sessions"), "sessions").orderBy(
        F.desc("pct_of_sessions"), "element"
    )


def chrome_navigation(c: Catalog, s: EventScope) -> DataFrame:
    return _chrome(c, s, "nav")


def social_clicks(c: Catalog, s: EventScope) -> DataFrame:
    return _chrome(c, s, "social")


def footer_feedback_share(c: Catalog, s: EventScope) -> DataFrame:
    return _chrome(c, s, "feedback_share")


# Links of the disclaimer page.
DISCLAIMER_LINKS = [(1, "Public Charge"), (2, "Privacy Policy"), (3, "Terms and Conditions")]


def disclaimer_link_rates(c: Catalog, s: EventScope) -> DataFrame:
    """The three disclaimer links, listed even when nobody clicked them."""
    viewers = scoped(c, "mart_screener_step_facts", s).where(
        (F.col("screener_step_name") == "disclaimer") & F.col("viewed")
    )
    n = row_count(viewers).scalar()  # one row per session and step
    axis = c.spark.createDataFrame(DISCLAIMER_LINKS, "sort_key int, link_label string")
    clicks = scoped(c, "mart_screener_link_clicks", s).where("link_location = 'disclaimer_inline'")
    clicks = clicks.groupBy("link_label").agg(
        F.sum("screenings").alias("clicked"), F.sum("total_clicks").alias("clicks")
    )
    rate = F.when(F.col("clicked") > 0, capped(pct("clicked", n))).alias("pct_of_disclaimer_viewers")
    joined = F.broadcast(axis).join(clicks, "link_label", "left")
    return joined.orderBy("sort_key").select(F.col("link_label").alias("link"), rate, "clicks")


def language_switches(c: Catalog, s: EventScope) -> DataFrame:
    rows = scoped(c, "mart_screener_language", s, "site").groupBy(F.col("language_name").alias("switched_to"))
    return rows.agg(F.sum("distinct_screenings").alias("sessions")).orderBy(F.desc("sessions"), "switched_to")


# --- averages per engaged screening -------------------------------------------------------------------


def _average(rows: DataFrame, events: str, who: str, alias: str) -> DataFrame:
    return rows.agg(round_ratio(F.sum(events), F.sum(who), 1).alias(alias))


def average_help_clicks(c: Catalog, s: EventScope) -> DataFrame:
    return _average(_get_help(c, s), "total_clicks", "distinct_screenings", "avg_clicks_per_screening")


def average_tab_opens(c: Catalog, s: EventScope) -> DataFrame:
    return _average(_resources_tab(c, s), "total_clicks", "distinct_screenings", "avg_opens_per_screening")


def average_edits(c: Catalog, s: EventScope) -> DataFrame:
    return _average(_edit_links(c, s), "total_clicks", "screenings", "avg_edits_per_screening")


def average_filter_uses(c: Catalog, s: EventScope) -> DataFrame:
    rows = scoped(c, "mart_screener_filter_usage", s).where("filter_type = 'citizenship'")
    return _average(rows, "total_engagements", "screenings_engaged", "avg_uses_per_screening")
