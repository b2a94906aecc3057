import json
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from orderlake.operators import clicks as ck
from orderlake.operators.orders import parse_json_lines

BASE = datetime(2024, 4, 25, 9, 0, 0)
SCHEMA = "event_id string, session_id string, user_id_hash string, event_type string, page_url string, occurred_at string"


def ev(i, sid="s", sec=0, kind="page_view", page=None, at=None, user="u"):
    return (f"e{i:05d}", sid, user, kind, page or f"/p{i}", at if at is not None else (BASE + timedelta(seconds=sec)).isoformat() + "+00:00")


def sessions(spark, events):
    return ck.sessionize(spark.createDataFrame(events, SCHEMA)).orderBy("session_id", "session_seq").collect()


@pytest.mark.parametrize("gap,count", [(1799, 1), (1800, 1), (1801, 2)])
def test_gap_boundary(spark, gap, count):
    assert len(sessions(spark, [ev(1), ev(2, sec=gap)])) == count


def test_counts_pages_and_duration(spark):
    (row,) = sessions(spark, [ev(1, page="/in", user="first"), ev(2, sec=60, kind="product_view"), ev(3, sec=90, kind="add_to_cart"), ev(4, sec=100, kind="search"),
                              ev(5, sec=120, kind="purchase", page="/out", user=None)])
    assert (row.event_count, row.page_views, row.product_views, row.add_to_cart_count, row.search_count) == (5, 1, 1, 1, 1)
    assert (row.converted, row.entry_page, row.exit_page, row.duration_seconds, row.user_id_hash) == (True, "/in", "/out", 120, "first")


def test_interleaved_sessions_and_equal_times(spark):
    rows = sessions(spark, [ev(1, "a"), ev(2, "b"), ev(3, "a", 10), ev(4, "b", 10), ev(5, "b", 10)])
    assert [(r.session_id, r.event_count) for r in rows] == [("a", 2), ("b", 3)]
    assert rows[1].exit_page == "/p5"


def test_chain_of_short_gaps_stays_together(spark):
    assert len(sessions(spark, [ev(i, sec=i * 1500) for i in range(40)])) == 1


def test_unreadable_times_do_not_split(spark):
    rows = sessions(spark, [ev(1), ev(2, sec=60), ev(3, at="garbage")])
    assert [(r.event_count, r.duration_seconds) for r in rows] == [(3, 0)]
    rows = sessions(spark, [ev(1, at="", page="/head"), ev(2), ev(3, sec=7200)])
    assert [(r.event_count, r.duration_seconds, r.entry_page) for r in rows] == [(2, 0, "/head"), (1, 0, "/p3")]


def test_only_unreadable_times(spark):
    (row,) = sessions(spark, [ev(1, at="x"), ev(2, at="")])
    assert (row.event_count, row.session_start, row.duration_seconds) == (2, None, 0)


def test_rows_without_session_are_routed_away(spark):
    df = spark.createDataFrame([ev(1), ev(2, sid=None)], SCHEMA)
    assert ck.sessionize(df).count() == 1 and ck.missing_session(df).count() == 1


def test_parse(spark):
    items = [{"event_id": "1", "session_id": "s", "user_id": None}, {"after": {"event_id": "2", "event_type": "search", "user_id": "u"}},
             {"session_id": "s3", "event_type": None, "after": None}, {"user_id": "u"}, {"after": {}, "event_id": "5"}]
    df = spark.createDataFrame([(json.dumps(i),) for i in items] + [("oops",)], "value string")
    rows = {(r.event_id, r.session_id): r for r in ck.parse_click_events(parse_json_lines(df).filter("v is not null"), "salt").collect()}
    assert set(rows) == {("1", "s"), ("2", None), (None, "s3"), ("5", None)}
    assert rows[("1", "s")].event_type == "page_view" and rows[("1", "s")].user_id_hash is None
    assert rows[("2", None)].event_type == "search" and len(rows[("2", None)].user_id_hash) == 64
    assert rows[(None, "s3")].event_type is None


def naive(events):
    out = []
    for sid in sorted({e[1] for e in events}):
        times = sorted((datetime.fromisoformat(e[5]), e[0]) for e in events if e[1] == sid)
        groups = [[times[0]]]
        for item in times[1:]:
            if (item[0] - groups[-1][-1][0]).total_seconds() > 1800:
                groups.append([])
            groups[-1].append(item)
        out += [(sid, len(g), int((g[-1][0] - g[0][0]).total_seconds())) for g in groups]
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 20000)), min_size=1, max_size=60))
def test_matches_a_sequential_scan(spark, items):
    events = [ev(i, sid, sec) for i, (sid, sec) in enumerate(items)]
    assert [(r.session_id, r.event_count, r.duration_seconds) for r in sessions(spark, events)] == naive(events)


def test_one_session_id_with_most_events_is_reduced_before_the_window(spark, plan):
    df = spark.range(20000).selectExpr("cast(id as string) event_id", "'bot' session_id", "cast(null as string) user_id_hash", "'page_view' event_type",
                                       "'/x' page_url", "timestamp_seconds(1700000000 + id) occurred_at")
    out = ck.sessionize(df)
    assert [(r.event_count, r.duration_seconds) for r in out.collect()] == [(20000, 19999)]
    text = plan(out)
    assert text.index("Window") < text.rindex("Aggregate"), "the window must sit above the slice aggregate"
