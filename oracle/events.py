"""Event families, intermediates and marts."""

from oracle.base import EPOCH, KEYS, case_map, define, flat_event_columns, has_params, pct, ratio, step_label, values
from screenmart.functions.steps import STEPS

SLUGS = "('co','nc','tx','wa','il','ma','cesn')"
ITEMS = ", ".join(f"item{n}__{f}" for n in (1, 2, 3) for f in ("list_name", "id", "name", "category"))
SCREENING = "ga_session_id, screener_state, screener_uid"
DAY = "event_date, event_date_parsed, screener_state"
SEGMENT = "nullif(regexp_extract(page_location, 'https?://[^/]+/([^/?#]+)', 1), '')"
SESSION_KEY = "CAST(to_json({'user_pseudo_id': user_pseudo_id, 'ga_session_id': ga_session_id}) AS VARCHAR)"
SESSION = "{'u': user_pseudo_id, 's': ga_session_id}"


def family(names: str, columns: str, keys: str = KEYS, moment: str | None = "event_datetime") -> str:
    listed = ", ".join(f"'{n}'" for n in names.split())
    when = "" if moment is None else f", event_datetime AS {moment}"
    return (
        f"SELECT {keys}, event_date_parsed, {columns}{when} FROM ev WHERE with_params AND event_name IN ({listed})"
    )


CLICK_KEYS = "event_date, event_timestamp, user_pseudo_id, user_id"
LADDER = values([(s, r) for s, _, r, _ in STEPS if r is not None])
ENERGY = values([(s, r) for s, _, _, r in STEPS if r is not None])

define(
    ev=f"""
SELECT {KEYS}, CAST(strptime(event_date, '%Y%m%d') AS DATE) AS event_date_parsed,
  make_timestamp(event_timestamp) AS event_datetime, {flat_event_columns()}, {ITEMS},
  {has_params()} AS with_params
FROM flat_events""",
    stg_ga_link_clicks=family(
        "outbound_link",
        "ga_session_id, link_url, link_domain, is_outbound, page_location, "
        "nullif(regexp_extract(page_location, 'https?://[^/]+(/.*)$', 1), '') AS page_path",
        CLICK_KEYS,
        "click_datetime",
    ),
    stg_ga_page_views=family(
        "page_view", "ga_session_id, page_location", "event_date, event_timestamp, event_name, user_pseudo_id, user_id"
    ),
    stg_ga_sessions=family(
        "session_start",
        "ga_session_id, session_medium, session_source, session_campaign",
        CLICK_KEYS,
        "session_start_datetime",
    ),
    int_ga4_page_views="""
SELECT *, nullif(regexp_extract(page_location, '[^/]+://[^/]+(/[^?]*)', 1), '') AS page_path,
  nullif(regexp_extract(page_location, '[^/]+://([^/]+)', 1), '') AS page_hostname,
  nullif(regexp_extract(page_location, '^[^/]+://[^/]+/([a-z][a-z0-9_]+)/', 1), '') AS state_code
FROM stg_ga_page_views WHERE page_location IS NOT NULL""",
    # Views and outbound clicks of a session as one list of moments, reduced to one row.
    session_moments="""
SELECT user_pseudo_id, ga_session_id, state_code, event_timestamp AS moment,
  CASE WHEN contains(page_path, '/step-1') THEN 'start' END AS began,
  CASE WHEN contains(page_path, '/results') THEN 'results' END AS ended, FALSE AS is_click
FROM int_ga4_page_views
UNION ALL SELECT user_pseudo_id, ga_session_id, NULL, event_timestamp, NULL, NULL, TRUE FROM stg_ga_link_clicks WHERE is_outbound = 'true'""",
    session_activity="""
SELECT user_pseudo_id, ga_session_id, max(state_code) AS state, min(moment) FILTER (began = 'start') AS started,
  min(moment) FILTER (ended = 'results') AS finished, min(moment) FILTER (is_click) AS first_click, max(moment) FILTER (is_click) AS last_click,
  count_if(is_click) AS clicks
FROM session_moments WHERE ga_session_id IS NOT NULL GROUP BY ALL""",
    timed_sessions="""
SELECT s.*, a.* EXCLUDE (user_pseudo_id, ga_session_id), (a.finished - a.started) / CAST(1000000 AS DOUBLE) AS seconds
FROM stg_ga_sessions s LEFT JOIN session_activity a USING (user_pseudo_id, ga_session_id) WHERE s.ga_session_id IS NOT NULL""",
    int_ga4_sessions="""
SELECT event_date, event_date_parsed, user_pseudo_id, ga_session_id, session_campaign, session_start_datetime,
  ifnull(state, 'unknown') AS state_code, ifnull(session_medium, '(none)') AS session_medium,
  ifnull(session_source, '(direct)') AS session_source, CAST(started IS NOT NULL AS INT) AS hit_screener_start,
  CAST(finished IS NOT NULL AS INT) AS hit_screener_results, CASE WHEN seconds >= 20 THEN seconds END AS completion_time_seconds,
  CAST(ifnull(last_click > finished, FALSE) AS INT) AS has_outbound_click, first_click AS first_outbound_click_ts,
  ifnull(clicks, 0) AS total_link_clicks
FROM timed_sessions""",
    form_events=family(
        "screener_form_start screener_form_step screener_form_complete screener_form_error screener_form_back",
        f"{SCREENING}, screener_path, screener_step_name, screener_step_number, step_action, member_index, "
        "form_field_name, form_error_reason, form_error_message, form_error_count",
    ),
    form_sessions="""
SELECT user_pseudo_id AS u, ga_session_id AS g,
  bool_or(lower(screener_state) = 'cesn' OR starts_with(lower(screener_step_name), 'cesn-')) AS is_cesn,
  max(lower(trim(screener_path))) FILTER (WHERE lower(trim(screener_path)) IN ('homeowner', 'renter')) AS stated,
  count_if(lower(screener_step_name) = 'cesn-appliances') > 0 AS owns,
  count_if(lower(screener_step_name) = 'cesn-energy-expenses') > 0 AS rents
FROM form_events GROUP BY ALL""",
    stg_ga_screener_form_funnel="""
SELECT form_events.*, is_cesn, CASE WHEN stated IS NOT NULL THEN stated WHEN owns THEN 'homeowner' WHEN rents THEN 'renter' END
  AS cesn_path
FROM form_events JOIN form_sessions ON user_pseudo_id IS NOT DISTINCT FROM u AND ga_session_id IS NOT DISTINCT FROM g""",
    stg_ga_screener_help=family(
        "screener_help_click screener_get_help_click screener_more_help_resource_click",
        f"{SCREENING}, help_topic, screener_step_name, screener_step_number, location, resource_name, "
        "resource_index, url",
    ),
    item_rows=" UNION ALL ".join(
        f"SELECT {KEYS}, event_date_parsed, event_datetime, {SCREENING}, {n - 1} AS off, item{n}__list_name AS "
        f"list_name, item{n}__id AS item_id, item{n}__name AS item_name, item{n}__category AS item_category "
        f"FROM ev WHERE item{n}__list_name IS NOT NULL"
        for n in (1, 2, 3)
    ),
    stg_ga_screener_program_interactions=family(
        "screener_apply_click screener_program_more_info screener_program_visit_website "
        "screener_program_phone_click screener_program_document_download screener_required_program_click "
        "screener_filter_engaged screener_results_tab_click screener_navigator_engaged",
        f"{SCREENING}, program_id, program_name, url, document_name, filter_type, tab_name, navigator_id, "
        "navigator_name, contact_method",
    )
    + f"""
UNION ALL
SELECT event_date, event_timestamp, CASE list_name WHEN 'results_programs' THEN 'screener_program_shown'
    WHEN 'results_navigators' THEN 'screener_navigator_shown' ELSE 'screener_program_document_shown' END,
  user_pseudo_id, user_id, event_bundle_sequence_id, batch_event_index + off, event_date_parsed, {SCREENING},
  CASE WHEN list_name = 'results_programs' THEN item_id ELSE item_category END,
  CASE WHEN list_name = 'results_programs' THEN item_name END, NULL,
  CASE WHEN list_name = 'results_documents' THEN item_name END, NULL, NULL,
  CASE WHEN list_name = 'results_navigators' THEN item_id END,
  CASE WHEN list_name = 'results_navigators' THEN item_name END, NULL, event_datetime
FROM item_rows WHERE list_name IN ('results_programs', 'results_navigators', 'results_documents')""",
    resource_rows=family(
        "screener_results_tab_click screener_additional_resource_more_info screener_additional_resource_click",
        f"{SCREENING}, tab_name, resource_name, url, contact_method",
    )
    + f"""
UNION ALL
SELECT event_date, event_timestamp, 'screener_resource_shown', user_pseudo_id, user_id, event_bundle_sequence_id,
  batch_event_index + off, event_date_parsed, {SCREENING}, NULL, item_name, NULL, NULL, event_datetime
FROM item_rows WHERE list_name = 'results_resources'""",
    stg_ga_screener_resource_engagement="""
SELECT *, bool_or(lower(screener_state) = 'cesn') OVER (PARTITION BY user_pseudo_id, ga_session_id) AS is_cesn
FROM resource_rows""",
    outcome_rows=family(
        "screener_results_loaded screener_results_none_eligible screener_results_error "
        "screener_results_error_recovery",
        f"{SCREENING}, program_count, total_estimated_value, reference_id",
    ),
    stg_ga_screener_results_outcomes="""
SELECT *, bool_or(lower(screener_state) = 'cesn') OVER (PARTITION BY user_pseudo_id, ga_session_id) AS is_cesn
FROM outcome_rows""",
    stg_ga_screener_scroll_depth=family("screener_results_scroll_depth", f"{SCREENING}, depth, tab_name"),
    stg_ga_screener_section_engagement=family(
        "screener_household_member screener_income_source", f"{SCREENING}, action, member_index"
    ),
    stg_ga_screener_shares=family(
        "screener_share screener_share_popup_shown screener_results_save",
        f"{SCREENING}, CASE WHEN {SEGMENT} IN {SLUGS} THEN {SEGMENT} END AS url_screener_state, share_location, "
        "share_channel, share_provider, share_action, save_channel, save_action",
    ),
    stg_ga_screener_step_interactions=family(
        "screener_household_member screener_income_source screener_has_benefits_load_error "
        "screener_language_changed screener_confirmation_edit screener_confirmation_proceed",
        f"{SCREENING}, CASE WHEN {SEGMENT} IN {SLUGS} THEN {SEGMENT} END AS url_screener_state, screener_step_name, "
        "screener_step_number, action, language_name, section",
    ),
    stg_ga_screener_ui_events=family(
        "screener_confirmation_edit screener_signup_completed screener_filter_engaged screener_nps_score_submitted "
        "screener_nps_reason_submitted screener_nps_reason_skipped screener_feedback_click screener_link_click "
        "screener_logo_click screener_language_changed screener_social_click screener_results_back_to_screener",
        f"{SCREENING}, screener_step_name, CASE WHEN {SEGMENT} IN {SLUGS} THEN {SEGMENT} END AS url_screener_state, "
        "section, filter_type, sms_consent, email_consent, nps_score, feedback_channel, link_name, link_location, "
        "location, social_network",
        moment=None,
    ),
    ladder=f"SELECT * FROM (VALUES {LADDER}) t(screener_step_name, funnel_rank)",
    energy_steps=f"SELECT * FROM (VALUES {ENERGY}) t(screener_step_name, funnel_rank)",
    # Steps seen by their place on the ladder; loaded results come after all of them.
    steps_seen=f"""
SELECT f.* EXCLUDE (screener_step_name), r.funnel_rank AS place FROM stg_ga_screener_form_funnel f JOIN ladder r USING (screener_step_name)
WHERE event_name = 'screener_form_step' AND step_action = 'view'
UNION ALL BY NAME SELECT *, 12 AS place FROM stg_ga_screener_results_outcomes WHERE event_name = 'screener_results_loaded'""",
    int_screener_furthest_step=f"""
SELECT {SESSION_KEY} AS session_key, max(place)::BIGINT AS furthest_step_rank, bool_or(is_cesn) AS is_cesn,
  {", ".join(f"max({c}) AS {c}" for c in DAY.split(", "))}
FROM steps_seen GROUP BY ALL""",
    int_screener_program_names="""
SELECT program_id, max(program_name) AS program_name FROM stg_ga_screener_program_interactions
WHERE program_id IS NOT NULL AND program_name IS NOT NULL GROUP BY 1""",
)

# --- marts --------------------------------------------------------------------------

VIEWED = "(event_name = 'screener_form_step' AND step_action = 'view')"
STEP_CASE = step_label("screener_step_name")


def grouped(source: str, where: str, keys: str, rows: str, distinct: str, who: str = "screener_uid") -> str:
    return (
        f"SELECT {keys}, count(*) AS {rows}, count(DISTINCT {who}) AS {distinct} FROM {source} "
        f"WHERE {where} GROUP BY ALL"
    )


INTERACTIONS = case_map(
    "event_name",
    {
        "screener_apply_click": "apply",
        "screener_program_more_info": "more_info",
        "screener_program_visit_website": "visit_website",
        "screener_program_phone_click": "phone_click",
        "screener_program_document_download": "document_download",
        "screener_program_document_shown": "document_shown",
        "screener_required_program_click": "required_program_click",
        "screener_program_shown": "shown",
    },
    "NULL",
)

FIELD_LABEL = """CASE
  WHEN f IS NULL THEN '(unspecified)' WHEN f = 'zipcode' THEN 'Zip code'
  WHEN f = 'needs' OR f LIKE 'needs.%' THEN 'Immediate needs'
  WHEN f = 'members.birthMonth' THEN 'Member birth month'
  WHEN f LIKE 'incomeStreams.%' THEN 'Income' WHEN f = 'contactInfo.email' THEN 'Email' ELSE f END"""

GRAIN = "event_date, event_date_parsed, screener_state, is_cesn"


define(
    result_clicks=f"""
SELECT event_date, event_date_parsed, user_pseudo_id, {SESSION} AS visit, is_outbound,
  CASE WHEN link_domain <> '' THEN link_domain ELSE nullif(regexp_extract(link_url, '[^/]+://([^/]+)', 1), '') END AS link_domain
FROM stg_ga_link_clicks WHERE ga_session_id IS NOT NULL AND contains(page_path, '/results')""",
    visit_states=f"SELECT {SESSION} AS visit, state AS state_code FROM session_activity WHERE state IS NOT NULL",
    mart_ga_clicked_links="""
SELECT event_date, event_date_parsed, coalesce(state_code, 'unknown') AS state_code, link_domain, is_outbound,
  count(*) AS total_clicks, count(DISTINCT visit) AS sessions_with_clicks, count(DISTINCT user_pseudo_id) AS users_with_clicks
FROM result_clicks LEFT JOIN visit_states USING (visit) GROUP BY ALL""",
    # A session counts at the furthest of: 0 seen, 1 started, 2 saw results, 3 clicked on from there.
    kpi_counts=f"""
SELECT event_date, event_date_parsed, state_code, count(DISTINCT visit) AS total_sessions,
  count(DISTINCT user_pseudo_id) AS total_users, count(DISTINCT visit) FILTER (reached >= 1) AS sessions_started_screener,
  count(DISTINCT visit) FILTER (reached >= 2) AS sessions_completed_screener,
  count(DISTINCT visit) FILTER (reached >= 3) AS sessions_clicked_after_completion,
  round(avg(seconds), 1) AS avg_completion_time_seconds,
  round(quantile_disc(seconds, 0.5), 1) AS median_completion_time_seconds
FROM (SELECT event_date, event_date_parsed, state_code, user_pseudo_id, {SESSION} AS visit,
    completion_time_seconds AS seconds, hit_screener_start + hit_screener_start * hit_screener_results
      + hit_screener_start * hit_screener_results * has_outbound_click AS reached
  FROM int_ga4_sessions) GROUP BY ALL""",
    mart_ga_kpi_summary=f"""
SELECT *, {pct("sessions_started_screener", "total_sessions", 2)} AS pct_started_screener,
  {pct("sessions_clicked_after_completion", "sessions_completed_screener", 2)} AS completed_to_click_rate_pct
FROM kpi_counts""",
    mart_ga_traffic_mediums=f"""
SELECT event_date, event_date_parsed, state_code, session_medium, session_source,
  count(DISTINCT {SESSION}) AS total_sessions, count(DISTINCT user_pseudo_id) AS total_users
FROM int_ga4_sessions GROUP BY 1, 2, 3, 4, 5""",
    mart_screener_step_ladder="SELECT * FROM (VALUES "
    + values([(s, label, r) for s, label, r, _ in STEPS])
    + ") t(screener_step_name, screener_step_label, funnel_rank)",
    mart_screener_cesn_combined_ladder="SELECT * FROM (VALUES "
    + values([("__form_start__", "Started Screener", 0), *[(s, label, r) for s, label, _, r in STEPS if r is not None]])
    + ") t(screener_step_name, screener_step_label, funnel_rank)",
    energy_places=f"""
SELECT f.*, CASE WHEN f.event_name = 'screener_form_start' THEN 0 WHEN {VIEWED} THEN l.funnel_rank END AS place
FROM stg_ga_screener_form_funnel f LEFT JOIN energy_steps l USING (screener_step_name) WHERE f.is_cesn""",
    mart_screener_cesn_funnel=f"""
SELECT {SESSION_KEY} AS session_key, max(place)::BIGINT AS furthest_step_rank, max(event_date) AS event_date,
  max(event_date_parsed) AS event_date_parsed
FROM energy_places WHERE place IS NOT NULL GROUP BY ALL""",
    mart_screener_furthest_step="SELECT * FROM int_screener_furthest_step",
    funnel_views=f"""
SELECT {GRAIN}, screener_step_name, screener_step_number, {SESSION_KEY} AS session_key
FROM stg_ga_screener_form_funnel WHERE {VIEWED}
UNION ALL SELECT {GRAIN}, '__form_start__', NULL, {SESSION_KEY} FROM stg_ga_screener_form_funnel
  WHERE event_name = 'screener_form_start'
UNION ALL SELECT {GRAIN}, '__form_complete__', NULL, {SESSION_KEY} FROM stg_ga_screener_form_funnel
  WHERE event_name = 'screener_form_complete'""",
    # Every counted form event tagged with what it counts as.
    funnel_facts=f"""
SELECT {GRAIN}, screener_step_name, screener_step_number AS seen_number, session_key, 'view' AS fact FROM funnel_views
UNION ALL BY NAME
SELECT {GRAIN}, screener_step_name, {SESSION_KEY} AS session_key, CASE
    WHEN event_name = 'screener_form_back' THEN 'back' WHEN event_name = 'screener_form_error' THEN 'error'
    WHEN event_name = 'screener_form_step' AND step_action = 'complete' THEN 'complete' END AS fact
FROM stg_ga_screener_form_funnel WHERE fact IS NOT NULL""",
    mart_screener_form_funnel=f"""
SELECT *, CASE screener_step_name WHEN '__form_start__' THEN 'Started Screener'
    WHEN '__form_complete__' THEN 'Reached Results' ELSE {step_label("screener_step_name")} END AS screener_step_label
FROM (SELECT {GRAIN}, screener_step_name, max(seen_number) FILTER (known) AS screener_step_number,
    count(DISTINCT session_key) FILTER (known AND fact = 'view') AS screenings_viewed_step,
    count(DISTINCT session_key) FILTER (known AND fact = 'complete') AS screenings_completed_step,
    count(DISTINCT session_key) FILTER (known AND fact = 'back') AS screenings_navigated_back,
    count(DISTINCT session_key) FILTER (known AND fact = 'error') AS screenings_with_error,
    count(*) FILTER (known AND fact = 'error') AS total_error_count
  FROM (SELECT *, is_cesn IS NOT NULL AND screener_step_name IS NOT NULL AS known FROM funnel_facts) GROUP BY ALL)""",
    step_events="""
SELECT * FROM stg_ga_screener_form_funnel WHERE screener_step_name IS NOT NULL
  AND screener_step_name NOT IN ('__form_start__', '__form_complete__')""",
    mart_screener_step_facts=f"""
SELECT {SESSION_KEY} AS session_key, screener_step_name, max(screener_state) AS screener_state,
  bool_or(is_cesn) AS is_cesn, max(event_date_parsed) AS event_date_parsed, bool_or({VIEWED}) AS viewed,
  bool_or(event_name = 'screener_form_error') AS errored, bool_or(event_name = 'screener_form_back') AS navigated_back,
  count(*) FILTER (WHERE event_name = 'screener_form_error') AS error_events, {STEP_CASE} AS screener_step_label
FROM step_events GROUP BY 1, 2""",
    mart_screener_step_views_by_screening=f"""
SELECT screener_uid, screener_step_name, event_date_parsed, max(screener_state) AS screener_state,
  bool_or({VIEWED}) AS viewed, {STEP_CASE} AS screener_step_label
FROM step_events WHERE screener_uid IS NOT NULL GROUP BY 1, 2, 3""",
    mart_screener_screening_funnel=f"""
SELECT screener_uid, screener_state, event_date_parsed, is_cesn, distinct_sessions,
  loaded OR details OR applied AS saw_results, details OR applied AS viewed_details, applied
FROM (SELECT screener_uid,
    arg_min(screener_state, event_timestamp) FILTER (WHERE screener_state IN {SLUGS}) AS screener_state,
    min(event_date_parsed) AS event_date_parsed, bool_or(lower(screener_state) = 'cesn') AS is_cesn,
    count(DISTINCT ga_session_id) AS distinct_sessions, bool_or(event_name = 'screener_results_loaded') AS loaded,
    bool_or(event_name = 'screener_program_more_info') AS details,
    bool_or(event_name = 'screener_apply_click') AS applied
  FROM ev WHERE screener_uid IS NOT NULL GROUP BY 1) x""",
    placeholder_lists=f"""
SELECT {DAY}, screener_uid,
  bool_or(lower(screener_state) = 'cesn') OVER (PARTITION BY user_pseudo_id, ga_session_id) AS is_cesn
FROM (SELECT event_date, event_timestamp, event_date_parsed, screener_state, screener_uid, user_pseudo_id,
    ga_session_id FROM item_rows WHERE list_name = 'results_programs'
  GROUP BY ALL HAVING count(*) = 1 AND bool_and(item_id = '(not set)')) x
WHERE event_date >= '{EPOCH}' AND screener_uid IS NOT NULL""",
    loaded_rows="SELECT * FROM stg_ga_screener_results_outcomes WHERE event_name = 'screener_results_loaded'",
    none_rows=f"""
SELECT {GRAIN}, screener_uid FROM stg_ga_screener_results_outcomes
WHERE event_name = 'screener_results_none_eligible'
UNION SELECT {GRAIN}, screener_uid FROM placeholder_lists""",
    outcome_facts=f"""
SELECT {GRAIN}, screener_uid, 'none' AS outcome, NULL AS program_count, NULL AS total_estimated_value FROM none_rows
UNION ALL SELECT {GRAIN}, screener_uid, CASE event_name WHEN 'screener_results_loaded' THEN 'loaded'
    WHEN 'screener_results_error' THEN 'error' ELSE 'recovered' END, program_count, total_estimated_value
FROM stg_ga_screener_results_outcomes
WHERE event_name IN ('screener_results_loaded', 'screener_results_error', 'screener_results_error_recovery')""",
    # Counts and values of rows whose flag is undecided stay empty, as published.
    mart_screener_results_outcomes=f"""
SELECT {GRAIN}, count(DISTINCT screener_uid) FILTER (decided AND outcome = 'loaded') AS screenings_results_loaded,
  count(DISTINCT screener_uid) FILTER (decided AND outcome = 'none') AS screenings_none_eligible,
  count(DISTINCT screener_uid) FILTER (decided AND outcome = 'error') AS screenings_results_error,
  count(DISTINCT screener_uid) FILTER (decided AND outcome = 'recovered') AS screenings_error_recovered,
  {ratio("sum(program_count) FILTER (valued)", "count(program_count) FILTER (valued)", 2)} AS avg_program_count,
  CAST(quantile_disc(program_count, 0.5) FILTER (valued) AS DOUBLE) AS median_program_count,
  round(avg(total_estimated_value) FILTER (valued), 2) AS avg_total_estimated_value,
  round(quantile_disc(total_estimated_value, 0.5) FILTER (valued), 2) AS median_total_estimated_value
FROM (SELECT *, is_cesn IS NOT NULL AS decided, is_cesn IS NOT NULL AND outcome = 'loaded' AS valued FROM outcome_facts) GROUP BY {GRAIN}""",
    mart_screener_results_revisits=f"""
SELECT screener_uid, count(*) AS results_load_count, min(event_date_parsed) AS event_date_parsed,
  arg_min(screener_state, event_timestamp) FILTER (WHERE screener_state IN {SLUGS}) AS screener_state,
  bool_or(is_cesn) AS is_cesn
FROM loaded_rows WHERE screener_uid IS NOT NULL GROUP BY 1""",
    mart_screener_results_back=grouped(
        "stg_ga_screener_ui_events",
        "event_name = 'screener_results_back_to_screener' AND screener_uid IS NOT NULL",
        DAY, "total_clicks", "screenings_went_back",
    ),
    mart_screener_scroll_depth="""
SELECT event_date_parsed, screener_state, tab_name, depth, count(DISTINCT screener_uid) AS screenings_reached_depth
FROM (SELECT screener_uid, tab_name, max(depth) AS depth, min(event_date_parsed) AS event_date_parsed,
    max(screener_state) AS screener_state
  FROM stg_ga_screener_scroll_depth WHERE depth IS NOT NULL AND tab_name IS NOT NULL GROUP BY 1, 2) x
GROUP BY 1, 2, 3, 4""",
    form_error_rows=f"""
SELECT {GRAIN}, screener_uid, screener_step_name, {STEP_CASE} AS screener_step_label, {FIELD_LABEL} AS error_field_label,
  coalesce(nullif(trim(form_error_reason), ''), '(no detail captured)') AS error_problem
FROM (SELECT *, nullif(trim(form_field_name), '') AS f FROM stg_ga_screener_form_funnel
  WHERE event_name = 'screener_form_error' AND screener_step_name IS NOT NULL) x""",
    mart_screener_form_errors=grouped(
        "form_error_rows", "TRUE", f"{GRAIN}, screener_step_label, error_field_label, error_problem",
        "total_errors", "screenings_with_error",
    ),
    mart_screener_confirmation_edits=grouped(
        "stg_ga_screener_ui_events",
        "event_name = 'screener_confirmation_edit' AND section IS NOT NULL",
        DAY
        + ", "
        + case_map(
            "section",
            {"zipcode": "Zip Code", "householdData": "Household & Member Details", "hasBenefits": "Current Benefits"},
            "section",
        )
        + " AS section_label",
        "total_edits", "screenings",
    ),
    # One row per page of a member and per income action on it, reduced to the member.
    member_facts="""
SELECT screener_uid, member_index, event_date_parsed AS day, screener_state AS state, 'page' AS fact FROM stg_ga_screener_form_funnel
WHERE (event_name, step_action, screener_step_name) = ('screener_form_step', 'view', 'member-details')
UNION ALL SELECT screener_uid, member_index, NULL, NULL, action FROM stg_ga_screener_section_engagement
WHERE event_name = 'screener_income_source'""",
    mart_screener_member_income="""
SELECT event_date_parsed, screener_state, count(*) AS member_pages_viewed, count_if(added) AS member_pages_added_income,
  count_if(deleted) AS member_pages_deleted_income
FROM (SELECT min(day) FILTER (fact = 'page') AS event_date_parsed, max(state) FILTER (fact = 'page') AS screener_state,
    count_if(fact = 'page') AS pages, count_if(fact = 'add') > 0 AS added, count_if(fact = 'delete') > 0 AS deleted
  FROM member_facts WHERE screener_uid IS NOT NULL AND member_index IS NOT NULL GROUP BY screener_uid, member_index)
WHERE pages > 0 GROUP BY ALL""",
    mart_screener_section_engagement="""
SELECT screener_uid, CASE event_name WHEN 'screener_household_member' THEN 'Household Members'
    WHEN 'screener_income_source' THEN 'Income Sources' END AS section, coalesce(action, '(unknown)') AS action,
  max(screener_state) AS screener_state, max(event_date_parsed) AS event_date_parsed, count(*) AS total_actions
FROM stg_ga_screener_section_engagement WHERE screener_uid IS NOT NULL GROUP BY 1, 2, 3""",
    mart_screener_signup_consent=f"""
SELECT {DAY}, count(DISTINCT screener_uid) AS signups,
  count(DISTINCT CASE WHEN sms_consent = 'true' THEN screener_uid END) AS sms_opt_ins,
  count(DISTINCT CASE WHEN email_consent = 'true' THEN screener_uid END) AS email_opt_ins
FROM stg_ga_screener_ui_events WHERE event_name = 'screener_signup_completed' AND screener_uid IS NOT NULL
GROUP BY 1, 2, 3""",
    # (event, group, expression of the element's name)
    chrome_rows=" UNION ALL ".join(
        f"SELECT {SESSION_KEY} AS session_key, event_date_parsed, '{group}' AS element_group, {element} AS element, "
        f"coalesce(screener_state, url_screener_state) AS row_state FROM {table} WHERE {where}"
        for table, where, group, element in (
            ("stg_ga_screener_ui_events", "event_name = 'screener_logo_click'", "nav",
             "concat('Logo (', coalesce(location, 'unknown'), ')')"),
            ("stg_ga_screener_ui_events", "event_name = 'screener_language_changed'", "nav", "'Changed Language'"),
            ("stg_ga_screener_ui_events", "event_name = 'screener_link_click'", "nav",
             "if(link_name IN ('About Us', 'Privacy Policy', 'Terms and Conditions'), link_name, NULL)"),
            ("stg_ga_screener_ui_events", "event_name = 'screener_social_click'", "social",
             "upper(left(social_network, 1)) || lower(substr(social_network, 2))"),
            ("stg_ga_screener_ui_events", "event_name = 'screener_feedback_click'", "feedback_share",
             "map {'survey': 'Report a Bug', 'email': 'Contact Us'}[feedback_channel]"),
            ("stg_ga_screener_shares", "share_location = 'footer' AND share_action = 'open'", "feedback_share", "'Share'"),
        )
    ),
    mart_screener_footer_engagement="""
SELECT element_group, element, session_key, max(event_date_parsed) AS event_date_parsed,
  max(session_state) AS screener_state
FROM (SELECT *, max(row_state) OVER (PARTITION BY session_key) AS session_state FROM chrome_rows) x
WHERE element IS NOT NULL GROUP BY 1, 2, 3""",
    help_rows=f"""
SELECT {DAY}, screener_uid, CASE event_name WHEN 'screener_help_click' THEN 'help_click'
    WHEN 'screener_get_help_click' THEN 'get_help_click' ELSE 'more_help_resource_click' END AS metric,
  CASE event_name WHEN 'screener_help_click' THEN coalesce(help_topic, '(unspecified)')
    WHEN 'screener_get_help_click' THEN coalesce(location, '(unspecified)')
    ELSE coalesce(CASE resource_name WHEN 'moreHelp.resource_name1' THEN '2-1-1 Colorado' END, resource_name,
      nullif(url, ''), 'Resource #' || CAST(resource_index AS VARCHAR), '(unspecified)') END AS dimension,
  CASE WHEN event_name = 'screener_help_click' THEN screener_step_name END AS step_name
FROM stg_ga_screener_help""",
    mart_screener_help=grouped(
        "help_rows",
        "TRUE",
        f"{DAY}, metric, dimension, step_name AS screener_step_name, {step_label('step_name')} AS screener_step_label",
        "total_clicks", "distinct_screenings",
    ),
    language_rows="""
SELECT * REPLACE (coalesce(screener_state, url_screener_state) AS screener_state)
FROM stg_ga_screener_step_interactions WHERE event_name = 'screener_language_changed'""",
    mart_screener_language=grouped(
        "language_rows", "language_name IS NOT NULL", f"{DAY}, language_name", "total_changes", "distinct_screenings",
        SESSION,
    ),
    # What a link is by its place, and by its name where the place is not told; all others lie in a step.
    placed_links="SELECT * FROM (VALUES ('footer', 'left out'), ('results_needs', 'edit_nav')) t(link_location, kind)",
    unplaced_links="""
SELECT * FROM (VALUES ('About Us', 'left out'), ('Privacy Policy', 'left out'), ('Terms and Conditions', 'left out'),
  ('Additional Resources — Edit Step', 'edit_nav')) t(link_name, kind)""",
    link_rows=f"""
SELECT * FROM (
  SELECT {DAY}, user_pseudo_id, ga_session_id, e.link_location, ifnull(e.link_name, '(unnamed)') AS link_label,
    screener_step_name, {STEP_CASE} AS screener_step_label, coalesce(p.kind, n.kind, 'in_step') AS link_group
  FROM stg_ga_screener_ui_events e LEFT JOIN placed_links p USING (link_location)
  LEFT JOIN unplaced_links n ON e.link_location IS NULL AND n.link_name = e.link_name
  WHERE event_name = 'screener_link_click') WHERE link_group <> 'left out'""",
    mart_screener_link_clicks=grouped(
        "link_rows", "TRUE",
        f"{DAY}, link_group, link_location, link_label, screener_step_name, screener_step_label",
        "total_clicks", "screenings", SESSION,
    ),
    mart_screener_filter_usage=grouped(
        "stg_ga_screener_ui_events",
        "event_name = 'screener_filter_engaged' AND screener_uid IS NOT NULL",
        f"{DAY}, coalesce(filter_type, '(unknown)') AS filter_type",
        "total_engagements", "screenings_engaged",
    ),
    mart_screener_nps=f"""
SELECT {DAY}, nps_score, CASE WHEN nps_score <= 6 THEN 'Detractor' WHEN nps_score <= 8 THEN 'Passive'
    WHEN nps_score IS NOT NULL THEN 'Promoter' END AS nps_category,
  count(*) FILTER (WHERE event_name = 'screener_nps_score_submitted') AS scores_submitted,
  count(*) FILTER (WHERE event_name = 'screener_nps_reason_submitted') AS reasons_submitted,
  count(*) FILTER (WHERE event_name = 'screener_nps_reason_skipped') AS reasons_skipped,
  count(*) FILTER (WHERE event_name = 'screener_feedback_click') AS feedback_clicks
FROM stg_ga_screener_ui_events
WHERE event_name IN ('screener_nps_score_submitted', 'screener_nps_reason_submitted',
  'screener_nps_reason_skipped', 'screener_feedback_click')
GROUP BY 1, 2, 3, 4""",
    mart_screener_shares=grouped(
        "stg_ga_screener_shares", "event_name = 'screener_share'",
        f"{DAY}, share_location, share_channel, share_provider, share_action",
        "total_shares", "screenings_with_share",
    ),
    save_rows="SELECT * FROM stg_ga_screener_shares WHERE event_name = 'screener_results_save'",
    # Each row counts under its own action, and a second time under the marker of what it means.
    save_marks=f"""
SELECT {DAY}, screener_uid, 0 AS kind, save_channel, save_action FROM save_rows
UNION ALL SELECT {DAY}, screener_uid, if(save_action = 'send', 1, 2), NULL,
  if(save_action = 'send', '__saved__', '__popup_shown__')
FROM save_rows WHERE save_action IN ('send', 'open')""",
    mart_screener_saves=f"""
SELECT {DAY}, save_channel, save_action, count(*) FILTER (kind = 0) AS total_saves,
  count(DISTINCT screener_uid) FILTER (kind = 1) AS screenings_with_save, count(*) FILTER (kind = 2) AS total_popup_impressions,
  count(DISTINCT screener_uid) FILTER (kind = 2) AS screenings_shown_popup
FROM save_marks GROUP BY {DAY}, kind, save_channel, save_action""",
    interaction_rows=f"""
SELECT * FROM (SELECT {DAY}, screener_uid, program_id, document_name, {INTERACTIONS} AS interaction_type
  FROM stg_ga_screener_program_interactions WHERE program_id IS NOT NULL) x WHERE interaction_type IS NOT NULL""",
    interaction_totals=grouped(
        "interaction_rows", "program_id <> '(not set)'", f"{DAY}, program_id, interaction_type, document_name",
        "total_interactions", "screenings_with_interaction",
    ),
    mart_screener_program_interactions="""
SELECT a.*, coalesce(pn.program_name, a.program_id) AS program_name
FROM interaction_totals a LEFT JOIN int_screener_program_names pn ON a.program_id = pn.program_id""",
    mart_screener_program_interactions_by_screening="""
SELECT d.*, coalesce(pn.program_name, d.program_id) AS program_name
FROM (SELECT DISTINCT event_date_parsed, screener_state, interaction_type, program_id, document_name, screener_uid
  FROM interaction_rows) d LEFT JOIN int_screener_program_names pn ON d.program_id = pn.program_id""",
    navigator_totals=f"""
SELECT {DAY}, program_id, navigator_id, method AS contact_method, max(navigator_name) AS navigator_name,
  count(*) AS total_engagements, count(DISTINCT screener_uid) AS screenings_with_engagement
FROM (SELECT *, CASE WHEN event_name = 'screener_navigator_shown' THEN '__shown__' ELSE contact_method END AS method
  FROM stg_ga_screener_program_interactions
  WHERE event_name IN ('screener_navigator_engaged', 'screener_navigator_shown')
    AND program_id IS NOT NULL AND navigator_id IS NOT NULL) x
GROUP BY 1, 2, 3, 4, 5, 6""",
    mart_screener_navigator_engagement="""
SELECT a.*, coalesce(pn.program_name, a.program_id) AS program_name
FROM navigator_totals a LEFT JOIN int_screener_program_names pn ON a.program_id = pn.program_id""",
    resource_metrics=f"""
SELECT {GRAIN}, screener_uid, metric, if(metric = 'tab_open', tab_name, resource_name) AS dimension,
  if(metric = 'resource_click', contact_method, NULL) AS contact_method
FROM stg_ga_screener_resource_engagement JOIN (VALUES ('screener_results_tab_click', 'tab_open'),
    ('screener_resource_shown', 'resource_shown'), ('screener_additional_resource_more_info', 'resource_more_info'),
    ('screener_additional_resource_click', 'resource_click')) kinds(event_name, metric) USING (event_name)
WHERE if(metric = 'tab_open', tab_name, resource_name) IS NOT NULL""",
    mart_screener_resource_engagement=grouped(
        "resource_metrics", "TRUE", f"{GRAIN}, metric, dimension, contact_method", "total_clicks",
        "distinct_screenings",
    ),
    mart_screener_resource_engagement_by_screening="""
SELECT DISTINCT event_date_parsed, screener_state, is_cesn, metric, dimension, contact_method, screener_uid
FROM resource_metrics""",
)
