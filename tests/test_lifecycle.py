import datetime as dt

import pytest
from pyspark.sql import functions as F

from seqtables.operators import lifecycle

NOW = dt.datetime(2026, 1, 1)
LAB = ("uid string, libstatus int, libstatustxt string, deleted int, forcerun int, url string, params string, "
       "dateanalyzed timestamp_ntz, tagstotal bigint, tagsmapped bigint, tagsribo bigint, tagssuppressed bigint, tagsused bigint")

EVENTS = "uid string, ts timestamp_ntz, event_id bigint, event string, message string, params string"


def row(uid, libstatus=0, deleted=0, forcerun=0, url="x", analyzed=None):
    return (uid, libstatus, "old", deleted, forcerun, url, "{}", analyzed, 1, 2, 3, 4, 5)


def after(rows, lab_row, event, message=None, params=None):
    return lifecycle.lifecycle_next(rows([lab_row], LAB), rows([(lab_row[0], NOW, 1, event, message, params)], EVENTS)).first()


@pytest.mark.parametrize("event,lab,status,text", [
    ("queued", {}, 1, "old"),
    ("queued", {"url": ""}, 0, "old"), ("queued", {"url": None}, 0, "old"),
    ("queued", {"libstatus": 10}, 10, "old"), ("queued", {"deleted": 1}, 0, "old"),
    ("retry", {"libstatus": 1}, 1000, "Download Failed. Retry!"),
    ("download_failed", {"libstatus": 1}, 2000, 'it "broke"'),
    ("downloaded", {"libstatus": 1}, 10, "downloaded"),
    ("started", {"libstatus": 10}, 11, "Analysing"),
    ("completed", {"libstatus": 11}, 12, "Complete:upgraded"),
    ("failed", {"libstatus": 11}, 2010, 'Fail:it "broke"'),
    ("reprocess", {"libstatus": 12, "forcerun": 1}, 10, "Ready to be reanalyzed"),
    ("reprocess", {"libstatus": 11, "forcerun": 1}, 11, "old"),
    ("reprocess", {"libstatus": 12, "forcerun": 0}, 12, "old"),
    ("delete", {"libstatus": 12, "deleted": 1}, 12, "Deleted"),
    ("delete", {"libstatus": 12}, 12, "old"),
])
def test_transition(rows, event, lab, status, text):
    got = after(rows, row("a", **lab), event, "it 'broke'")
    assert (got.libstatus, got.libstatustxt) == (status, text)
    assert (got.event is None) == (text == "old" and status == lab.get("libstatus", 0))


def test_other_columns(rows):
    started = after(rows, row("a", 10, forcerun=1), "started")
    assert (started.forcerun, started.dateanalyzes, started.dateanalyzed) == (0, NOW, NOW)
    kept = dt.datetime(2020, 5, 5)
    assert after(rows, row("a", 10, analyzed=kept), "started").dateanalyzed == kept
    done = after(rows, row("a", 11), "completed", params='{"promoter":1}')
    assert (done.dateanalyzee, done.params) == (NOW, '{"promoter":1}')
    again = after(rows, row("a", 12, forcerun=1), "reprocess")
    assert (again.forcerun, again.tagstotal, again.tagsused) == (0, 0, 0)
    gone = after(rows, row("a", 12, deleted=1), "delete")
    assert (gone.deleted, gone.datedel, gone.tagstotal) == (2, NOW.date(), 1)
    assert after(rows, row("a"), "unknown").libstatus == 0


def at(day):
    return dt.datetime(2024, 1, day)


def test_all_events_of_an_experiment_apply_once(rows):
    log = [("a", at(1), 1, "downloaded", None, None), ("a", at(2), 2, "started", None, None),
           ("a", at(3), 3, "completed", None, '{"x":1}'), ("b", at(2), 5, "failed", "it's", None), ("b", at(2), 4, "started", None, None)]
    lab = rows([row("a", 1, forcerun=1), row("b", 10), row("c", 12)], LAB)
    once = lifecycle.lifecycle_next(lab, rows(log, EVENTS))
    got = {r.uid: r for r in once.collect()}
    a, b, c = got["a"], got["b"], got["c"]
    assert (a.libstatus, a.libstatustxt, a.forcerun, a.params) == (12, "Complete:upgraded", 0, '{"x":1}')
    assert (a.dateanalyzes, a.dateanalyzed, a.dateanalyzee) == (at(2), at(2), at(3))
    assert (b.libstatus, b.libstatustxt, b.dateanalyzes) == (2010, 'Fail:it"s', at(2))
    assert c.event is None and c.libstatustxt == "old"
    assert (a.applied_ts, a.applied_id, c.applied_id) == (at(3), 3, None)
    again = {r.uid: r for r in lifecycle.lifecycle_next(once.drop("event"), rows(log, EVENTS)).collect()}
    assert all(again[u].event is None and again[u].asDict() | {"event": 0} == got[u].asDict() | {"event": 0} for u in got)
    more = rows([*log, ("a", at(3), 6, "started", None, None)], EVENTS)
    later = {r.uid: r for r in lifecycle.lifecycle_next(once.drop("event"), more).collect()}
    assert (later["a"].libstatus, later["a"].dateanalyzed, later["a"].applied_id) == (11, at(2), 6)


def test_late_events_fill_what_no_newer_event_wrote(rows):
    started, completed = ("a", at(2), 1, "started", None, None), ("a", at(3), 2, "completed", None, '{"x":1}')
    refused = ("a", at(1), 3, "delete", None, None)
    lab = rows([row("a", 10, forcerun=1)], LAB)
    step = lambda state, *log: lifecycle.lifecycle_next(state, rows(list(log), EVENTS))
    first = step(lab, completed).drop("event")
    late = step(first, completed, started)
    got = late.first()
    assert (got.libstatus, got.libstatustxt, got.event) == (12, "Complete:upgraded", "started")
    assert (got.forcerun, got.dateanalyzes, got.dateanalyzed, got.dateanalyzee) == (0, at(2), at(2), at(3))
    assert (got.applied_ts, got.applied_id) == (at(3), 2)
    again = step(late.drop("event"), completed, started).first()
    assert again.event is None and again.asDict() | {"event": 0} == got.asDict() | {"event": 0}
    earlier = step(late.drop("event"), completed, started, ("a", at(1), 4, "started", None, None)).first()
    assert (earlier.dateanalyzes, earlier.dateanalyzed, earlier.libstatus) == (at(2), at(1), 12)
    # an event refused once is not taken later
    kept = step(lab, refused).drop("event")
    asked = step(kept.withColumn("deleted", F.lit(1)), refused).first()
    assert (asked.deleted, asked.event) == (1, None)


def intervals(frame):
    return {r.uid: [tuple(i) for i in r.applied] if r.applied else r.applied for r in frame.collect()}


def test_taken_events_are_kept_as_intervals(rows):
    lab = rows([row("a", 1), row("b", 1), row("c", 1)], LAB)
    log = [("ab"[i % 2], at(1), i, "started", None, None) for i in range(1, 41)] + [("a", at(2), 100, "completed", None, None), ("x", at(2), 101, "failed", "", None)]
    step = lambda state, events: lifecycle.lifecycle_next(state, rows(events, EVENTS))
    once = step(lab, log).drop("event")
    assert intervals(once) == {"a": [(2, 40), (100, 100)], "b": [(1, 39)], "c": None}
    late = ("a", at(3), 60, "failed", "x", None)
    more = step(once, [late, ("b", at(1), 41, "started", None, None)])
    got = {r.uid: r for r in more.collect()}
    assert (got["a"].libstatus, got["a"].event, got["b"].event) == (2010, "failed", "started")
    assert intervals(more) == {"a": [(2, 40), (60, 60), (100, 100)], "b": [(1, 39), (41, 41)], "c": None}
    # the whole log again changes nothing but joins what lies in one island
    again = step(more.drop("event"), [*log, late, ("b", at(1), 41, "started", None, None)])
    assert all(r.event is None for r in again.collect())
    assert intervals(again) == {"a": [(2, 40), (60, 60), (100, 100)], "b": [(1, 41)], "c": None}


def test_intervals_end_at_blocks_of_ids(rows, monkeypatch):
    monkeypatch.setattr(lifecycle, "BLOCK_BITS", 3)
    lab = rows([row("a", 1), row("b", 1)], LAB)
    log = [("a" if i % 3 else "b", at(1 + i % 5), i, "started", None, None) for i in range(30)] + [("b", at(9), -5, "failed", "m", None)]
    once = lifecycle.lifecycle_next(lab, rows(log, EVENTS)).drop("event")
    got = intervals(once)
    assert got["a"] == [(1, 7), (8, 14), (16, 23), (25, 29)] and got["b"] == [(-5, -5), (0, 6), (9, 15), (18, 21), (24, 27)]
    assert all(r.event is None for r in lifecycle.lifecycle_next(once, rows(log[::-1], EVENTS)).collect())
    other = [("a", at(20), 24, "failed", "late", None)]
    # an id that the log gave to another experiment lies between intervals only where blocks end
    assert lifecycle.lifecycle_next(once, rows(other, EVENTS)).filter("uid = 'a'").first().event == "failed"


def test_very_many_events_of_one_experiment(spark, rows):
    """A hundred thousand events: a state of two intervals, no event meets a list, and no plan pairs events with events."""
    lab = rows([row("a", 1), row("b", 1)], LAB)
    log = spark.range(100000).selectExpr(
        "case when id % 1000 = 7 then 'b' else 'a' end as uid", "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, id) as ts", "id as event_id",
        "case when id % 2 = 0 then 'started' else 'completed' end as event", "cast(null as string) as message", "cast(null as string) as params")
    first = lifecycle.lifecycle_next(lab, log).drop("event")
    kept = spark.createDataFrame(first.collect(), first.schema)
    assert intervals(kept)["a"] == [(0, 65535), (65536, 99999)]
    again = lifecycle.lifecycle_next(kept, log.unionByName(rows([("a", at(30), 100000, "failed", "end", None)], EVENTS)))
    assert {(r.uid, r.event, r.libstatus) for r in again.collect()} == {("a", "failed", 2010), ("b", None, 12)}


def test_decisions_stand_at_their_own_time(rows):
    log = rows([("a", at(2), 1, "failed", None), ("b", at(1), 2, "started", None)],
               "uid string, ts timestamp_ntz, event_id bigint, event string, message string")
    ready = rows([("a", "delete", at(1)), ("d", "delete", at(3))], "uid string, action string, ts timestamp")
    events = lifecycle.pending_events(log, rows([("c",)], "uid string"), ready, F.lit("2026-01-01").cast("timestamp_ntz"))
    assert {(r.uid, r.event, r.ts) for r in events.collect()} == {
        ("a", "failed", at(2)), ("b", "started", at(1)), ("c", "queued", NOW), ("a", "delete", at(1)), ("d", "delete", at(3))}
    lab = rows([row("a", 11, deleted=1), row("b", 10), row("c", 0), row("d", 12, deleted=1)], LAB)
    got = {r.uid: r for r in lifecycle.lifecycle_next(lab, events).collect()}
    assert (got["a"].libstatus, got["a"].deleted, got["a"].libstatustxt) == (2010, 2, "Fail:")
    assert (got["c"].libstatus, got["d"].deleted, got["d"].datedel) == (1, 2, at(3).date())


def test_metrics_keep_old_values(rows):
    lab = rows([("a", 1, 1, 9.0), ("b", 2, 2, None)], "uid string, tagstotal bigint, tagsused bigint, size double")
    got = lifecycle.apply_metrics(lab, rows([("a", 7)], "uid string, tagstotal bigint"),
                                  rows([("b", 3.5)], "uid string, size double"))
    assert {tuple(r) for r in got.collect()} == {("a", 7, 1, 9.0), ("b", 2, 2, 3.5)}


def test_latest_status_breaks_ties_by_event(rows):
    t = dt.datetime(2024, 1, 1)
    got = lifecycle.status_latest(rows([("a", t, 1, 10), ("a", t, 2, 0), ("b", t, 3, 12)],
                                       "uid string, ts timestamp_ntz, event_id bigint, libstatus int"))
    assert {tuple(r) for r in got.collect()} == {("a", 0, 2), ("b", 12, 3)}
