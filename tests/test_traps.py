"""Ten-row fixtures for semantics that are easy to get wrong."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from screenmart.catalog import Options
from screenmart.plans import build, event_cards  # noqa: F401  (registers the datasets)
from tests.conftest import event

EPOCH = Options(analytics_epoch="20260801")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_equal_event_keys_merge_and_empty_events_vanish(make_catalog):
    c = make_catalog(
        events=[
            event("screener_results_scroll_depth", ga_session_id=1, depth=25),
            event("screener_results_scroll_depth", ga_session_id=1, depth=75, tab_name="t"),
            event("screener_results_scroll_depth", batch=1),
        ]
    )
    assert rows(c["stg_ga_screener_scroll_depth"], "ga_session_id", "depth", "tab_name") == [(1, 75, "t")]


def test_unreadable_numbers_are_null(make_catalog):
    c = make_catalog(
        events=[
            event("screener_results_scroll_depth", batch=i, screener_uid=str(i), depth=d)
            for i, d in enumerate(["abc", "50", 25])
        ]
    )
    assert rows(c["stg_ga_screener_scroll_depth"], "screener_uid", "depth") == [("0", None), ("1", 50), ("2", 25)]


def test_a_null_session_is_a_session(make_catalog):
    c = make_catalog(
        events=[
            event("screener_language_changed", batch=i, ga_session_id=s, language_name="Spanish", screener_state="co")
            for i, s in enumerate([1, 1, None])
        ]
    )
    assert rows(c["mart_screener_language"], "total_changes", "distinct_screenings") == [(3, 2)]


def undecided_events():
    return [
        event("screener_form_step", screener_uid="a", ga_session_id=1, screener_step_name=None, step_action="view"),
        event("screener_form_start", batch=1, ga_session_id=2, screener_state="co", user="u2"),
        event("screener_form_back", batch=3, ga_session_id=2, screener_state="co", screener_step_name="language", user="u2"),
        event("screener_form_start", batch=2, ga_session_id=3, user="u3"),
    ]


def test_undecided_program_flag_loses_the_count(make_catalog):
    """Without a state or step the flag is NULL, and the grain matches no summary."""
    out = make_catalog(EPOCH, events=undecided_events())["mart_screener_form_funnel"]
    got = rows(out, "is_cesn", "screener_step_name", "screenings_viewed_step")
    assert got == sorted(
        [(None, None, 0), (False, "__form_start__", 1), (False, "language", 0), (None, "__form_start__", 0)], key=str
    )


def test_undecided_program_flag_can_count_as_no(make_catalog):
    options = Options(analytics_epoch="20260801", coalesce_cesn=True)
    out = make_catalog(options, events=undecided_events())["mart_screener_form_funnel"]
    got = rows(out.where("screener_step_name = '__form_start__'"), "screener_state", "is_cesn", "screenings_viewed_step")
    assert got == sorted([("co", False, 1), (None, False, 1)], key=str)


def test_energy_path_prefers_the_stated_one(make_catalog):
    def step(user, name, path=None, batch=0):
        return event("screener_form_step", user=user, batch=batch, ga_session_id=1, screener_step_name=name,
                     screener_path=path, step_action="view")

    c = make_catalog(
        events=[
            step("u1", "cesn-appliances", " Renter "),
            step("u1", "language", batch=1),
            step("u2", "cesn-appliances"),
            step("u3", "cesn-energy-expenses"),
            step("u4", "language"),
        ]
    )
    out = c["stg_ga_screener_form_funnel"].select("user_pseudo_id", "is_cesn", "cesn_path").distinct()
    assert rows(out, "*") == sorted(
        [("u1", True, "renter"), ("u2", True, "homeowner"), ("u3", True, "renter"), ("u4", None, None)], key=str
    )


def test_link_domain_is_derived_before_grouping(make_catalog):
    page = "https://x.org/co/results"
    links = ["benefits.org", "", None]
    c = make_catalog(
        events=[
            event("outbound_link", ts=1_700_000_000_000_000 + i, ga_session_id=1, page_location=page, outbound="true",
                  link_url="https://benefits.org/a", link_domain=d)
            for i, d in enumerate(links)
        ]
    )
    assert rows(c["mart_ga_clicked_links"], "link_domain", "total_clicks", "sessions_with_clicks") == [
        ("benefits.org", 3, 1)
    ]


def test_first_known_state_skips_display_names(make_catalog):
    loads = [("Colorado", 10), ("nc", 20), ("co", 30)]
    c = make_catalog(
        events=[
            event("screener_results_loaded", ts=ts, ga_session_id=1, screener_uid="a", screener_state=s)
            for s, ts in loads
        ]
    )
    assert rows(c["mart_screener_results_revisits"], "screener_state", "results_load_count") == [("nc", 3)]
    assert rows(c["mart_screener_screening_funnel"], "screener_state", "saw_results") == [("nc", True)]


def item(list_name, item_id, category=None):
    return (item_id, f"name {item_id}", category, list_name)


def test_placeholder_list_means_none_eligible(make_catalog):
    def shown(uid, *items, batch=0):
        return event("view_item_list", user=uid, batch=batch, ga_session_id=1, screener_uid=uid, screener_state="co",
                     items=items)

    empty = item("results_programs", "(not set)")
    c = make_catalog(
        EPOCH,
        events=[
            shown("a", empty),
            shown("b", empty, item("results_programs", "1")),
            shown("c", item("results_resources", "r"), empty),
            shown("d", item("results_navigators", "(not set)")),
        ],
    )
    out = c["mart_screener_results_outcomes"]
    assert rows(out, "is_cesn", "screenings_none_eligible", "screenings_results_loaded") == [(False, 2, 0)]


def test_impressions_keep_their_place_in_the_list(make_catalog):
    c = make_catalog(
        events=[
            event("view_item_list", batch=4, ga_session_id=1, items=[
                item("results_resources", "r"), item("results_programs", "7"), item("results_navigators", "n", "7")])
        ]
    )
    got = rows(c["stg_ga_screener_program_interactions"], "event_name", "batch_event_index", "program_id", "navigator_id")
    assert got == [("screener_navigator_shown", 6, "7", "n"), ("screener_program_shown", 5, "7", None)]
    assert rows(c["stg_ga_screener_resource_engagement"], "batch_event_index", "resource_name") == [(4, "name r")]


def test_one_screening_on_two_days(make_catalog):
    days = ["20260801", "20260802"]
    c = make_catalog(
        events=[
            event("screener_results_tab_click", day=d, ga_session_id=1, screener_uid="a", screener_state="co",
                  tab_name="additional_resources")
            for d in days
        ]
    )
    assert rows(c["mart_screener_resource_engagement"], "event_date", "distinct_screenings") == [
        ("20260801", 1), ("20260802", 1),
    ]
    scope = event_cards.EventScope(epoch=date(2026, 8, 1))
    assert event_cards.resources_tab_engagement(c, scope).first()["opened_additional_resources"] == 1


def screen(i, **more):
    base = {
        "id": i, "white_label_id": 1, "completed": True, "is_test": False, "is_test_data": False,
        "start_date": datetime(2024, 1, 7, 9), "submission_date": datetime(2024, 1, 7, 10), "household_size": 2,
    }
    return {**base, **more}


def test_null_test_flags_drop_a_screen(make_catalog):
    c = make_catalog(
        screener_screen=[screen(1), screen(2, is_test=None), screen(3, is_test_data=None), screen(4, completed=None),
                         screen(5, referral_source="STAGINGTEST")]
    )
    assert rows(c["mart_screener_data"], "id", "start_day", "start_hour", "county", "partner") == [
        (1, "7", "09", "Unspecified", "No Partner")
    ]


def test_partner_rules(make_catalog):
    referrer = {"id": 1, "white_label_id": 1, "referrer_code": "r", "name": "Partner R", "is_partner": True}
    pairs = [("r", None), ("zzz", "r"), (" ", "r"), (None, "friend"), ("", "  "), (None, None)]
    c = make_catalog(
        programs_referrer=[referrer],
        screener_screen=[screen(i, referrer_code=a, referral_source=b) for i, (a, b) in enumerate(pairs)],
    )
    got = [p for _, p in rows(c["mart_screener_data"], "id", "partner")]
    assert got == ["Partner R", "Other", "Partner R", "Other", "No Partner", "No Partner"]
    wide = [p for _, p in rows(c["data"], "id", "partner")]
    assert wide == ["Partner R", ", Partner R", "Partner R", "Other", "No Partner", "No Partner"]


def test_undated_snapshot_counts_as_newest(make_catalog):
    def snapshot(i, day):
        return {"id": i, "screen_id": 1, "submission_date": day and datetime(2024, 1, day), "had_error": False}

    dated = make_catalog(screener_eligibilitysnapshot=[snapshot(1, 3), snapshot(2, 9), snapshot(3, 5), snapshot(4, 9)])
    assert rows(dated["stg_latest_eligibility_snapshot"], "latest_snapshot_id", "snapshots") == [(4, 4)]
    undated = make_catalog(screener_eligibilitysnapshot=[snapshot(1, None), snapshot(2, 9)])
    assert rows(undated["stg_latest_eligibility_snapshot"], "latest_snapshot_id", "snapshots") == [(1, 2)]


def test_monthly_values_keep_their_fraction(make_catalog):
    c = make_catalog(
        screener_screen=[screen(1)],
        screener_eligibilitysnapshot=[{"id": 5, "screen_id": 1, "had_error": False}],
        screener_programeligibilitysnapshot=[
            {"id": 1, "eligibility_snapshot_id": 5, "name_abbreviated": "p", "estimated_value": Decimal("7"), "eligible": True},
            {"id": 2, "eligibility_snapshot_id": 5, "name_abbreviated": "q", "estimated_value": Decimal("9"), "eligible": None},
        ],
        screener_incomestream=[
            {"id": 1, "screen_id": 1, "type": "wages", "amount": Decimal("100"), "frequency": "weekly"},
            {"id": 2, "screen_id": 1, "type": "wages", "amount": Decimal("100"), "frequency": "now and then"},
        ],
    )
    row = c["mart_screener_data"].first()
    assert row["non_tax_credit_benefits_monthly"] == 7 / 12
    assert row["monthly_income"] == 5200 / 12
    assert (row["programs_matched"], row["tax_credits_annual"]) == (1, Decimal("0.00"))


def test_null_age_counts_in_the_denominator_only(make_catalog):
    c = make_catalog(
        screener_householdmember=[{"id": i, "screen_id": 1, "age": a} for i, a in enumerate([17, 18, None])]
    )
    row = c["stg_household_demographics"].first()
    assert (row["age_lt18_n"], row["age_18_24_n"], row["age_lt18_share"]) == (1, 1, 0.33)


def test_results_rank_closes_the_funnel(make_catalog):
    c = make_catalog(
        EPOCH,
        events=[
            event("screener_form_step", ga_session_id=1, screener_state="co", screener_step_name="language", step_action="view"),
            event("screener_form_step", batch=1, ga_session_id=2, screener_state="co", screener_step_name="zip-code", step_action="view"),
            event("screener_results_loaded", ga_session_id=1, screener_state="co", screener_uid="a"),
        ],
    )
    scope = event_cards.EventScope(epoch=date(2026, 8, 1))
    funnel = event_cards.step_funnel(c, scope).collect()
    assert [r["sessions"] for r in funnel] == [2, 2, 2] + [1] * 9
    assert funnel[-1]["pct_of_started"] == 50.0


def test_first_generation_pairs_by_position(make_catalog):
    from screenmart.plans.firstgen import BENEFIT_LABELS, WIDE_PROGRAMS

    pairs = BENEFIT_LABELS
    assert (len(WIDE_PROGRAMS), len(pairs)) == (113, 111)
    assert ("MA SSP", "ma_ssp") in pairs and ("MA TAFDC", "ma_ssp") in pairs and pairs[-1] == (None, "wic")
    c = make_catalog(screener_screen=[screen(1)])
    counts = c["data_currentbenefits"]
    assert counts.count() == 111
    assert counts.agg(F.sum("count")).first()[0] == 0
