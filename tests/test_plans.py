"""What the physical plans look like: scans, pruning, partial aggregation, no Python, no cross joins."""

import re

import pytest
from conftest import TESTDATA

from streamwin.functions import COUNT_ONLY
from streamwin.operators import hybrid, metrics, multi_granularity, session, sliding, tumbling
from streamwin.plans import batch_strategies, catalog, measure_all
from streamwin.plans.queries_windows import events_of
from streamwin.plans.scratch import scratch_folder

FOLDER = f"{TESTDATA}/sf0.001"
QUERIES = catalog.queries()
BATCH = [name for name in QUERIES if not name.startswith(("stream_", "json_")) and name != "metrics_csv_round_trip"]
WHOLE_TABLE = {"delay_stats", "adaptive_delay", "metrics_last_update", "window_adaptive", "window_adaptive_5min", "strategy_rows"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(plan):
    return re.findall(r"FileScan parquet \[([^\]]*)\]", plan)


def columns(scan):
    return {name.split("#")[0] for name in scan.split(",")}


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_of(QUERIES[name](spark, FOLDER)) for name in BATCH}


@pytest.mark.parametrize("name", BATCH)
def test_plans_stay_on_builtin_operators(plans, name):
    assert not re.search(r"Python|InPandas|InArrow|CartesianProduct|NestedLoopJoin", plans[name])


@pytest.mark.parametrize("name", BATCH)
def test_only_single_row_results_meet_in_one_partition(plans, name):
    assert ("SinglePartition" in plans[name]) <= (name in WHOLE_TABLE)


@pytest.mark.parametrize("name", BATCH)
def test_every_shuffle_carries_partial_aggregates(plans, name):
    """No exchange sends raw rows, but for the one that sorts a series."""
    for below in re.findall(r"Exchange [^\n]*\n([^\n]*)", plans[name]):
        assert re.search(r"HashAggregate|SortAggregate|MergingSessions|Window|Project", below), below
    assert plans[name].count("rangepartitioning") == (1 if name == "metrics_series" else 0)


def test_one_scan_for_several_windows(spark, plans):
    assert len(scans(plans["window_multi"])) == 1
    assert len(scans(plans["window_multi_union"])) == 3
    assert len(scans(plans["window_hybrid"])) == 1
    assert len(scans(plans["window_hybrid_union"])) == 2
    assert len(scans(plans["symbol_multi"])) == 1
    assert len(scans(plans["metrics_compare"])) == 1


def test_only_needed_columns_are_read(plans):
    assert columns(scans(plans["window_count"])[0]) == {"ts"}
    assert columns(scans(plans["symbol_tumbling"])[0]) == {"ts", "event_type", "value"}
    assert columns(scans(plans["window_tumbling"])[0]) == {"ts", "value", "props"}
    assert columns(scans(plans["window_session"])[0]) == {"ts", "user_id", "value", "props"}
    assert all(columns(scan) == {"ts"} for scan in scans(plans["delay_stats"]))


def test_missing_times_are_filtered_in_the_scan(plans):
    for name in ("window_tumbling", "window_sliding", "window_session", "window_multi", "delay_stats"):
        assert "PushedFilters: [IsNotNull(ts)" in plans[name]


def test_wide_windows_are_built_from_panes(spark):
    """The rows are combined before they are copied to their windows."""
    for build in (sliding, hybrid, multi_granularity):
        plan = plan_of(build(events_of(spark, FOLDER)))
        copies = plan.index("Expand" if build is not multi_granularity else "Generate explode")
        assert plan.count("HashAggregate") == 4
        assert copies < plan.rindex("Exchange hashpartitioning")


def test_sessions_shuffle_cells_and_not_events(spark):
    plan = plan_of(session(events_of(spark, FOLDER)))
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert [re.sub(r"#\d+L?", "", key).split(", ")[:-1] for key in keys] == [["user_id"], ["_groupingexpression", "user_id"]]
    assert plan.count("MergingSessions") == 1


def test_messages_are_parsed_once(plans):
    for name in ("messages_text_fields", "messages_short", "messages_windows"):
        assert plans[name].count("from_json(") == 1


def test_the_broadcast_of_the_percentile_is_the_filtered_day_list(plans):
    plan = plans["delay_stats"]
    assert plan.count("BroadcastExchange") == 1
    assert plan.index("BroadcastExchange") < plan.index("Exchange SinglePartition", plan.index("BroadcastExchange"))


def test_measured_strategies(spark):
    events = events_of(spark, FOLDER)
    built = batch_strategies(events)
    assert list(built) == [
        "Standard Window",
        "Session-Based Window",
        "Hybrid Window",
        "Multi-Granularity Window",
        "Adaptive Watermarked Window",
    ]
    two = {"count": lambda: tumbling(events, measures=COUNT_ONLY), "Standard Window": built["Standard Window"]}
    samples = measure_all(spark, two, runs=2).cache()
    assert samples.count() == 8
    summary = {row.window_type: row for row in metrics.run_summary(samples).collect()}
    rows = tumbling(events).count()
    for name in two:
        total = summary[name].avg_latency * 2
        assert summary[name].avg_throughput == pytest.approx(2 * rows / total)
        assert summary[name].min_latency <= summary[name].avg_latency <= summary[name].max_latency
    assert metrics.run_rates(samples).count() == 4
    samples.unpersist()


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    assert scratch_folder(spark, "a") != scratch_folder(spark, "a")

    class Cluster:
        class conf:
            @staticmethod
            def get(name, default=None):
                return {"spark.master": "yarn"}.get(name, default)

    with pytest.raises(ValueError):
        scratch_folder(Cluster, "a")
    Cluster.conf.get = staticmethod(lambda name, default=None: {"spark.checkpoint.dir": "s3://shared/cp"}.get(name, default))
    assert scratch_folder(Cluster, "a").startswith("s3://shared/cp/a-")
