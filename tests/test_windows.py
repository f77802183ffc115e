import random
from datetime import datetime, timedelta, timezone

import pytest
from conftest import at, clock
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streamwin.functions import BASELINE, COUNT_AND_AVERAGE, COUNT_ONLY, FULL
from streamwin.operators import (
    hybrid,
    keyed_multi_granularity,
    keyed_session,
    keyed_sliding,
    keyed_tumbling,
    multi_granularity,
    session,
    sliding,
    static_sliding,
    tumbling,
)

BUNDLE = ["event_count", "total_volume", "avg_price", "max_price", "min_price"]
BOUNDS = ["window_start", "window_end"]


def same_rows(left, right):
    assert left.columns == right.columns
    assert sorted(map(repr, left.collect())) == sorted(map(repr, right.collect()))


def counts(df):
    return {(clock(r.window_start), clock(r.window_end)): r.event_count for r in df.collect()}


def test_column_orders(trades):
    events = trades(("12:00",))
    assert tumbling(events).columns == BUNDLE + BOUNDS
    assert sliding(events).columns == BUNDLE + BOUNDS
    assert session(events).columns == ["user_id", "session_start", "session_end"] + BUNDLE
    assert hybrid(events).columns == BUNDLE + ["window_type"] + BOUNDS
    assert hybrid(events, shared=False).columns == BUNDLE + ["window_type"] + BOUNDS
    assert multi_granularity(events).columns == BUNDLE + ["granularity"] + BOUNDS
    assert multi_granularity(events, single_scan=False).columns == BUNDLE + ["granularity"] + BOUNDS
    assert static_sliding(events).columns == BUNDLE + ["watermark_delay"] + BOUNDS
    assert tumbling(events, measures=BASELINE).columns == BUNDLE[:3] + BOUNDS
    keyed = BOUNDS + ["symbol", "event_count", "avg_price"]
    assert keyed_tumbling(events).columns == keyed
    assert keyed_sliding(events).columns == keyed
    assert keyed_session(events).columns == keyed
    assert keyed_multi_granularity(events).columns == keyed + ["granularity"]
    assert keyed_multi_granularity(events, single_scan=False).columns == keyed + ["granularity"]


def test_tumbling_window_includes_its_start_and_excludes_its_end(trades):
    assert counts(tumbling(trades(("00:05:00",), ("00:04:59",)), measures=COUNT_ONLY)) == {
        ("00:05", "00:10"): 1,
        ("00:00", "00:05"): 1,
    }


def test_full_bundle_by_hand(trades):
    rows = tumbling(trades(("12:00", "u", 1.5, 10), ("12:01", "u", None, 5), ("12:04", "v", 4.5, None))).collect()
    assert [tuple(r)[:5] for r in rows] == [(3, 15, 3.0, 4.5, 1.5)]


@pytest.mark.parametrize("panes", [True, False])
def test_sliding_windows_by_hand(trades, panes):
    found = counts(sliding(trades(("12:03:30",), ("12:05",)), measures=COUNT_ONLY, panes=panes))
    assert found == {
        ("11:59", "12:04"): 1,
        ("12:00", "12:05"): 1,
        ("12:01", "12:06"): 2,
        ("12:02", "12:07"): 2,
        ("12:03", "12:08"): 2,
        ("12:04", "12:09"): 1,
        ("12:05", "12:10"): 1,
    }


def test_hybrid_tags_both_kinds(trades):
    rows = hybrid(trades(("12:03",))).collect()
    assert sorted((r.window_type, clock(r.window_start)) for r in rows) == [
        ("sliding", "11:59"),
        ("sliding", "12:00"),
        ("sliding", "12:01"),
        ("sliding", "12:02"),
        ("sliding", "12:03"),
        ("tumbling", "12:00"),
    ]


def test_hybrid_with_a_slide_that_does_not_divide(trades):
    events = trades(("12:03",), ("12:04", "v", 2.0, 3))
    same_rows(hybrid(events, "5 minutes", "2 minutes"), hybrid(events, "5 minutes", "2 minutes", shared=False))
    with pytest.raises(ValueError):
        hybrid(events, "5 minutes", "2 minutes", shared=True)


def test_rows_without_event_time_are_left_out_and_null_keys_kept(trades):
    events = trades((None, "u"), ("12:00", None), ("12:01", None))
    for build in (tumbling, sliding, hybrid, multi_granularity):
        assert build(events, keys=["user_id"]).filter("user_id = 'u'").count() == 0
    for cells in (True, False):
        rows = session(events, cells=cells).collect()
        assert [(r.user_id, r.event_count) for r in rows] == [(None, 2)]


def test_group_without_any_price(trades):
    events = trades(("12:00", "u", None, None))
    for rows in (tumbling(events), sliding(events), multi_granularity(events), session(events), session(events, cells=False)):
        assert {tuple(r[name] for name in BUNDLE) for r in rows.collect()} == {(1, None, None, None, None)}


def test_averages_do_not_count_missing_prices_in_any_form(trades):
    events = trades(("12:00", "u", 2.0), ("12:00:30", "u", None), ("12:01", "u", 4.0), ("12:02", "u", None))
    whole = {r.granularity: r.avg_price for r in multi_granularity(events, ["5 minutes", "1 minute"]).collect() if clock(r.window_start) == "12:00"}
    assert whole == {"5 minutes": 3.0, "1 minute": 2.0}
    assert session(events).first().avg_price == 3.0


@pytest.mark.parametrize("widths", [("1 minute", "5 minutes"), ("2 minutes", "3 minutes"), ("7 seconds", "1 minute"), ("10 minutes",)])
def test_single_scan_equals_union(trades, widths):
    rng = random.Random(7)
    start = at("10:00")
    rows = [
        (start + timedelta(seconds=rng.randint(0, 3600)), f"u{rng.randint(0, 3)}", rng.choice([None, 1.25, 7.5]), rng.choice([None, 3]))
        for _ in range(300)
    ]
    same_rows(multi_granularity(trades(*rows), widths), multi_granularity(trades(*rows), widths, single_scan=False))


def test_times_before_1970(trades):
    early = datetime(1969, 12, 31, 23, 58, 30, tzinfo=timezone.utc)
    events = trades((early, "u", 2.0, 1), (early + timedelta(minutes=2), "u", 4.0, 1))
    same_rows(multi_granularity(events), multi_granularity(events, single_scan=False))
    same_rows(hybrid(events), hybrid(events, shared=False))
    same_rows(session(events, "1 minute"), session(events, "1 minute", cells=False))


def test_empty_input(trades):
    events = trades(("12:00",)).limit(0)
    for build in (tumbling, sliding, hybrid, multi_granularity, session, keyed_session, static_sliding):
        assert build(events).count() == 0


def test_bad_arguments(trades):
    events = trades(("12:00",))
    with pytest.raises(ValueError):
        session(events, "1 month")
    with pytest.raises(ValueError):
        multi_granularity(events, [])


# --- sessions ---------------------------------------------------------------


def test_session_edge(trades):
    for cells in (True, False):
        together = session(trades(("12:00",), ("12:30",)), cells=cells).collect()
        assert [(clock(r.session_start), clock(r.session_end), r.event_count) for r in together] == [("12:00", "13:00", 2)]
        apart = session(trades(("12:00",), ("12:30:01",)), cells=cells).collect()
        assert sorted((clock(r.session_start), r.event_count) for r in apart) == [("12:00", 1), ("12:30", 1)]


@pytest.mark.parametrize("cells", [True, False])
def test_session_with_a_timeout_per_event(trades, cells):
    gap = F.when(F.col("price") > 5, "20 minutes").when(F.col("price") > 0, "5 minutes")
    events = trades(("12:00", "u", 9.0), ("12:15", "u", 1.0), ("12:21", "u", 1.0), ("12:22", "u", -1.0))
    rows = session(events, gap, cells=cells).collect()
    assert sorted((clock(r.session_start), clock(r.session_end), r.event_count) for r in rows) == [
        ("12:00", "12:20", 2),
        ("12:21", "12:26", 1),
    ]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from("ab"), st.integers(0, 300), st.sampled_from([1, 5, 7, 60])), min_size=1, max_size=50
    )
)
def test_timeouts_per_event_match_a_walk_over_the_sorted_times(trades, points):
    origin = at("09:59:48")
    events = trades(*[(origin + timedelta(seconds=offset), user, float(wait)) for user, offset, wait in points])
    wanted = []
    for user in {user for user, _, _ in points}:
        found = []
        for offset, wait in sorted((o, w) for u, o, w in points if u == user):
            if found and offset <= found[-1][1]:
                first, until, n = found[-1]
                found[-1] = (first, max(until, offset + wait), n + 1)
            else:
                found.append((offset, offset + wait, 1))
        wanted += [(user, *one) for one in found]
    gap = F.concat(F.col("price").cast("int").cast("string"), F.lit(" seconds"))
    for cells in (True, False):
        rows = session(events, gap, cells=cells, measures=COUNT_ONLY).collect()

        def offset(stamp):
            return round((stamp.replace(tzinfo=timezone.utc) - origin).total_seconds())

        got = sorted((r.user_id, offset(r.session_start), offset(r.session_end), r.event_count) for r in rows)
        assert got == sorted(wanted)


def sessions_by_hand(offsets, gap):
    """Sessions as (first, last, count) by going through the sorted offsets."""
    found = []
    for offset in sorted(offsets):
        if found and offset - found[-1][1] <= gap:
            first, _, n = found[-1]
            found[-1] = (first, offset, n + 1)
        else:
            found.append((offset, offset, 1))
    return found


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 600)), min_size=1, max_size=60),
    st.sampled_from([1, 7, 30, 60]),
)
def test_sessions_match_a_walk_over_the_sorted_times(trades, points, gap):
    origin = at("09:59:48")
    events = trades(*[(origin + timedelta(seconds=offset), user) for user, offset in points])
    wanted = sorted(
        (user, first, last + gap, n)
        for user in {user for user, _ in points}
        for first, last, n in sessions_by_hand([o for u, o in points if u == user], gap)
    )
    for cells in (True, False):
        rows = session(events, f"{gap} seconds", cells=cells, measures=COUNT_ONLY).collect()

        def offset(stamp):
            return round((stamp.replace(tzinfo=timezone.utc) - origin).total_seconds())

        assert sorted((r.user_id, offset(r.session_start), offset(r.session_end), r.event_count) for r in rows) == wanted


def test_a_busy_user_gives_the_same_sessions_in_both_forms(spark):
    """One user holds a third of the rows, at microsecond times."""
    rows = spark.range(60_000).select(
        F.timestamp_micros(F.lit(1_709_280_000_000_000) + (F.rand(3) * 86_400_000_000).cast("bigint")).alias("event_time"),
        F.when(F.rand(4) < 1 / 3, "busy").otherwise(F.concat(F.lit("u"), F.col("id") % 500)).alias("user_id"),
        (F.floor(F.rand(5) * 1000) / 100).alias("price"),
        F.col("id").alias("volume"),
    ).cache()
    for gap in ("5 minutes", "10 seconds", "1 second"):
        left, right = session(rows, gap, measures=FULL.exact()), session(rows, gap, measures=FULL.exact(), cells=False)
        assert left.exceptAll(right).count() == right.exceptAll(left).count() == 0
        assert left.count() == right.count()
    rows.unpersist()


def test_exact_averages_do_not_depend_on_the_partitioning(trades):
    rows = [("12:00", "u", 0.1 * n, 1) for n in range(200)]
    sums = {tumbling(trades(*rows).repartition(n), measures=COUNT_AND_AVERAGE.exact()).first().avg_price for n in (1, 3, 7)}
    assert len(sums) == 1


def test_cells_of_many_timeouts_stay_few(spark):
    """A busy key with a timeout of its own for every event: four cells at most for each smallest timeout."""
    events = spark.range(20_000).selectExpr(
        "timestamp_micros(1700000000000000 + id * 1000003) as event_time",
        "concat(1200000000 + (id * 7919) % 1500000000, ' microseconds') as gap",
        "'u' as user_id",
    )
    found = session(events, F.col("gap"), measures=COUNT_ONLY)
    assert [row.event_count for row in found.collect()] == [20_000]
    cells = events.selectExpr("length(bin(cast(split(gap, ' ')[0] as bigint))) - 1 as p", "unix_micros(event_time) as t")
    count = cells.selectExpr("p", "shiftright(t, p)").distinct().count()
    assert count <= 4 * 20_000 / 1200 + 3


@pytest.mark.parametrize(
    "size, slide", [("33 minutes", "1 minute"), ("64 minutes", "1 minute"), ("100 minutes", "3 minutes"), ("7 hours", "5 minutes")]
)
def test_doubled_panes_give_the_direct_windows(trades, size, slide):
    rows = [(f"{h:02d}:{(h * 17 + k * 7) % 60:02d}", f"u{k % 2}", float(h + k), k) for h in range(0, 24, 3) for k in range(4)]
    events = trades(*rows, ("12:00", "u0", None, None))
    for keys in ((), ("user_id",)):
        options = dict(keys=keys, measures=FULL.exact(2))
        doubled = sliding(events, size, slide, **options)
        direct = sliding(events, size, slide, panes=False, **options)
        assert doubled.columns == direct.columns
        assert sorted(map(str, doubled.collect())) == sorted(map(str, direct.collect()))
