import pytest
from helpers import at, clicks, requests, same_rows, wins
from pyspark.sql import functions as F

from bidtide.operators.interval_join import enrich


def flags(spark, r, w, c, **kw):
    out = enrich(requests(spark, *r), wins(spark, *w), clicks(spark, *c), **kw)
    return sorted((x.request_id, x.is_clicked) for x in out.collect())


@pytest.mark.parametrize("delay,kept", [(-1, False), (0, True), (5000, True), (5001, False)])
def test_win_bounds_are_inclusive(spark, delay, kept):
    # Around a slice boundary as well as inside a slice.
    for start in (10_000, 58_000, 59_999, 60_000):
        assert flags(spark, [("a", start)], [("a", start + delay)], []) == ([("a", 0)] if kept else [])


@pytest.mark.parametrize("delay,clicked", [(-1, 0), (0, 1), (11000, 1), (11001, 0)])
def test_click_bounds_are_inclusive(spark, delay, clicked):
    for start in (10_000, 52_000, 59_999):
        assert flags(spark, [("a", start)], [("a", start)], [("a", start + delay)]) == [("a", clicked)]


def test_every_match_gives_a_row(spark):
    r, w = [("a", 0)], [("a", 100), ("a", 200)]
    assert flags(spark, r, w, [("a", 300), ("a", 301)]) == [("a", 1)] * 4


def test_click_without_action_is_no_click(spark):
    assert flags(spark, [("a", 0)], [("a", 0)], [("a", 5, None)]) == [("a", 0)]


def test_null_request_ids_never_match(spark):
    assert flags(spark, [(None, 0), ("a", 0)], [(None, 0), ("a", 1)], [(None, 1)]) == [("a", 0)]


def test_slice_width_does_not_change_results(spark):
    r = requests(spark, *[("hot" if i % 3 == 0 else f"r{i}", i * 700) for i in range(300)])
    w = wins(spark, *[("hot" if i % 3 == 0 else f"r{i}", i * 700 + i * 37 % 6000) for i in range(300)])
    c = clicks(spark, *[("hot" if i % 3 == 0 else f"r{i}", i * 700 + i * 53 % 13000) for i in range(0, 300, 2)])
    narrow, wide = enrich(r, w, c, slice_ms=1000), enrich(r, w, c, slice_ms=10**9)
    same_rows(narrow, wide)
    plain = (
        w.alias("w").join(r.alias("r"), F.expr("w.request_id = r.request_id AND w.ts BETWEEN r.ts AND r.ts + INTERVAL 5 SECOND"))
        .join(c.alias("c"), F.expr("w.request_id = c.request_id AND c.ts BETWEEN w.ts AND w.ts + INTERVAL 11 SECOND"), "left")
    )
    assert narrow.count() == plain.count() > 300
    assert narrow.where("is_clicked = 1").count() == plain.where("c.ts IS NOT NULL").count()


def test_event_time_is_the_win_time(spark):
    out = enrich(requests(spark, ("a", 0)), wins(spark, ("a", 7)), clicks(spark)).first()
    assert out.event_time == at(7).replace(tzinfo=None)
