"""Registered queries over whole event tables: batch windows, sessions and lateness."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..functions.columns import arrival_delay, tagged, with_event_time
from ..functions.measures import BASELINE, COUNT_AND_AVERAGE, COUNT_ONLY, FULL
from ..schema import EVENT_TABLE_SCHEMA, market_view
from .strategies import batch_strategies
from .sql import BOUNDS, COUNT, EVENTS, FULL_SQL, PAIR_SQL, REDUCED_SQL, session_sql, sliding_sql, tumbling_sql

# Prices have two decimals. Summed as decimals, averages have one right value
# that two engines can be compared on.
FULL_EXACT = FULL.exact(2)
PAIR_EXACT = COUNT_AND_AVERAGE.exact(2)
BASELINE_EXACT = BASELINE.exact(2)

AS_OF = "2024-01-31 00:00:00"
LATE_AS_OF = "2024-02-01 00:00:00"


def event_table(spark: SparkSession, folder: str) -> DataFrame:
    """The event table under its known schema, without a job that looks the schema up."""
    return spark.read.schema(EVENT_TABLE_SCHEMA).parquet(f"{folder}/events.parquet")


def events_of(spark: SparkSession, folder: str) -> DataFrame:
    return market_view(event_table(spark, folder))


def zoneless(rows: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the compared tables have them."""
    stamps = [name for name, kind in rows.dtypes if kind == "timestamp"]
    return rows.withColumns({name: F.col(name).cast("timestamp_ntz") for name in stamps})


def _over_events(build):
    return lambda spark, folder: zoneless(build(events_of(spark, folder)))


def _minutes_sql(p95: str, low: int, high: int, per_minute: int = 60, assumed: int = 300) -> str:
    known = f"coalesce(nullif({p95}, 0), {assumed})"
    return f"least(greatest(cast(trunc({known} / {per_minute} * 1.2) as bigint), {low}), {high})"


def _delay_sql(as_of: str) -> str:
    return f"epoch_us(timestamp '{as_of}') // 1000000 - epoch_us(event_time) // 1000000"


def _p95_sql(as_of: str) -> str:
    return f"(select quantile_cont(cast({_delay_sql(as_of)} as double), 0.95) from v)"


def _adaptive_sql(size: str, slide: str, copies: int, low: int, high: int, as_of: str) -> str:
    label = f"cast({_minutes_sql(_p95_sql(as_of), low, high)} as varchar) || ' minutes'"
    inner = sliding_sql(size, slide, copies, FULL_SQL, with_events=False)
    return f"with {EVENTS} select *, {label} as watermark_delay from ({inner})"


def hybrid_sql() -> str:
    tumbling = tumbling_sql("5 minutes", FULL_SQL, with_events=False)
    sliding = sliding_sql("5 minutes", "1 minute", 5, FULL_SQL, with_events=False)
    return (
        f"with {EVENTS} select *, 'tumbling' as window_type from ({tumbling}) "
        f"union all select *, 'sliding' as window_type from ({sliding})"
    )


def multi_sql(measures: str, key: str = "", closed: str = "") -> str:
    parts = [
        f"select *, '{width}' as granularity from ({tumbling_sql(width, measures, key, with_events=False)})"
        for width in ("1 minute", "5 minutes", "15 minutes")
    ]
    return f"with {EVENTS} select * from ({' union all '.join(parts)}) {closed}"


def _personal_gap(events: DataFrame, cells: bool | None = None) -> DataFrame:
    gap = F.when(F.col("symbol") == "purchase", "45 minutes").otherwise("20 minutes")
    return op.session(events, gap, measures=FULL_EXACT, cells=cells)


def _many_gaps(events: DataFrame, cells: bool | None = None) -> DataFrame:
    """A timeout of its own for nearly every event, from a second up to an hour."""
    seconds = F.floor(F.col("price") * 7919) % 3600 + 1
    return op.session(events, F.concat(seconds.cast("string"), F.lit(" seconds")), measures=FULL_EXACT, cells=cells)


def _gap_sql(gap: str) -> str:
    return f"""
with {EVENTS},
g as (select *, event_time + {gap} as until from v),
p as (select *, max(until) over (partition by user_id order by event_time, until rows between unbounded preceding and 1 preceding) as reach from g),
s as (select *, sum(case when reach is null or event_time > reach then 1 else 0 end) over (partition by user_id order by event_time, until rows unbounded preceding) as sid from p)
select user_id, min(event_time) as session_start, max(until) as session_end, {FULL_SQL} from s group by user_id, sid
"""


_PERSONAL_GAP_SQL = _gap_sql("case when symbol = 'purchase' then interval '45 minutes' else interval '20 minutes' end")
_MANY_GAPS_SQL = _gap_sql("to_seconds(cast(floor(price * 7919) as bigint) % 3600 + 1)")


def _delay_stats(spark: SparkSession, folder: str) -> DataFrame:
    return op.delay_stats(events_of(spark, folder), as_of=LATE_AS_OF, suffix="ms")


def _adaptive_delays(spark: SparkSession, folder: str) -> DataFrame:
    """The estimate between bounds that clamp it, bounds that do not, and in recorded units."""
    p95 = F.col("p95_delay_s")
    return op.delay_stats(events_of(spark, folder), as_of=LATE_AS_OF).select(
        p95,
        op.delay_minutes(p95).alias("clamped_minutes"),
        op.delay_minutes(p95, max_delay="2000 hours").alias("free_minutes"),
        op.delay_minutes(p95, min_delay="30 seconds", unit_compat=True).alias("compat_minutes"),
    )


_ADAPTIVE_DELAYS_SQL = f"""
with {EVENTS}, q as (select {_p95_sql(LATE_AS_OF)} as p95_delay_s)
select p95_delay_s,
  {_minutes_sql("p95_delay_s", 1, 30)} as clamped_minutes,
  {_minutes_sql("p95_delay_s", 1, 120000)} as free_minutes,
  {_minutes_sql("p95_delay_s", 1, 30, 60000, 300000)} as compat_minutes
from q
"""


def _arrival_delays(events: DataFrame) -> DataFrame:
    known = with_event_time(events)
    return known.select("user_id", "event_time", arrival_delay(as_of=LATE_AS_OF).alias("delay_s"))


def _strategy_rows(events: DataFrame) -> DataFrame:
    """How many rows each of the compared strategies gives."""
    counts = [tagged(build().agg(F.count("*").alias("records")), window_type=name) for name, build in batch_strategies(events).items()]
    return reduce(DataFrame.unionByName, counts)


def _strategy_rows_sql() -> str:
    strategies = {
        "Standard Window": tumbling_sql("5 minutes", REDUCED_SQL),
        "Session-Based Window": session_sql("30 minutes", FULL_SQL, "user_id"),
        "Hybrid Window": hybrid_sql(),
        "Multi-Granularity Window": multi_sql(FULL_SQL),
        "Adaptive Watermarked Window": sliding_sql("10 minutes", "2 minutes", 5, FULL_SQL),
    }
    return " union all ".join(
        f"select '{name}' as window_type, count(*) as records from ({sql})" for name, sql in strategies.items()
    )


QUERIES = {
    "window_tumbling": _over_events(lambda ev: op.tumbling(ev, measures=FULL_EXACT)),
    "window_sliding": _over_events(lambda ev: op.sliding(ev, measures=FULL_EXACT)),
    "window_sliding_direct": _over_events(lambda ev: op.sliding(ev, measures=FULL_EXACT, panes=False)),
    "window_sliding_day": _over_events(lambda ev: op.sliding(ev, "1 day", "1 minute", measures=FULL_EXACT)),
    "window_sliding_shift": _over_events(lambda ev: op.sliding(ev, "7 hours", "3 minutes", measures=FULL_EXACT)),
    "window_session": _over_events(lambda ev: op.session(ev, measures=FULL_EXACT)),
    "window_session_direct": _over_events(lambda ev: op.session(ev, measures=FULL_EXACT, cells=False)),
    "window_session_10min": _over_events(lambda ev: op.session(ev, "10 minutes", measures=FULL_EXACT)),
    "window_session_personal_gap": _over_events(_personal_gap),
    "window_session_many_gaps": _over_events(_many_gaps),
    "window_session_personal_gap_direct": _over_events(lambda ev: _personal_gap(ev, cells=False)),
    "window_hybrid": _over_events(lambda ev: op.hybrid(ev, measures=FULL_EXACT)),
    "window_hybrid_union": _over_events(lambda ev: op.hybrid(ev, measures=FULL_EXACT, shared=False)),
    "window_multi": _over_events(lambda ev: op.multi_granularity(ev, measures=FULL_EXACT)),
    "window_multi_union": _over_events(lambda ev: op.multi_granularity(ev, measures=FULL_EXACT, single_scan=False)),
    "window_adaptive": _over_events(lambda ev: op.adaptive_sliding(ev, as_of=AS_OF, measures=FULL_EXACT)),
    "window_adaptive_5min": _over_events(
        lambda ev: op.adaptive_sliding(
            ev,
            "5 minutes",
            "1 minute",
            max_event_delay="2000 hours",
            min_event_delay="30 seconds",
            as_of=AS_OF,
            measures=FULL_EXACT,
        )
    ),
    "window_static": _over_events(lambda ev: op.static_sliding(ev, measures=FULL_EXACT)),
    "window_baseline": _over_events(lambda ev: op.tumbling(ev, measures=BASELINE_EXACT)),
    "window_count": _over_events(lambda ev: op.tumbling(ev, "1 minute", delay="1 minute", measures=COUNT_ONLY)),
    "window_count_avg": _over_events(lambda ev: op.tumbling(ev, "1 minute", delay="1 minute", measures=PAIR_EXACT)),
    "symbol_tumbling": _over_events(lambda ev: op.keyed_tumbling(ev, measures=PAIR_EXACT)),
    "symbol_sliding": _over_events(lambda ev: op.keyed_sliding(ev, measures=PAIR_EXACT)),
    "symbol_multi": _over_events(lambda ev: op.keyed_multi_granularity(ev, measures=PAIR_EXACT)),
    "symbol_multi_union": _over_events(
        lambda ev: op.keyed_multi_granularity(ev, measures=PAIR_EXACT, single_scan=False)
    ),
    "symbol_session": _over_events(lambda ev: op.keyed_session(ev, measures=PAIR_EXACT)),
    "strategy_rows": _over_events(_strategy_rows),
    "arrival_delay": _over_events(_arrival_delays),
    "delay_stats": _delay_stats,
    "adaptive_delay": _adaptive_delays,
}

ORACLES = {
    "window_tumbling": tumbling_sql("5 minutes", FULL_SQL),
    "window_sliding": sliding_sql("5 minutes", "1 minute", 5, FULL_SQL),
    "window_sliding_direct": sliding_sql("5 minutes", "1 minute", 5, FULL_SQL),
    "window_sliding_day": sliding_sql("1 day", "1 minute", 1440, FULL_SQL),
    "window_sliding_shift": sliding_sql("7 hours", "3 minutes", 140, FULL_SQL),
    "window_session": session_sql("30 minutes", FULL_SQL, "user_id"),
    "window_session_direct": session_sql("30 minutes", FULL_SQL, "user_id"),
    "window_session_10min": session_sql("10 minutes", FULL_SQL, "user_id"),
    "window_session_personal_gap": _PERSONAL_GAP_SQL,
    "window_session_many_gaps": _MANY_GAPS_SQL,
    "window_session_personal_gap_direct": _PERSONAL_GAP_SQL,
    "window_hybrid": hybrid_sql(),
    "window_hybrid_union": hybrid_sql(),
    "window_multi": multi_sql(FULL_SQL),
    "window_multi_union": multi_sql(FULL_SQL),
    "window_adaptive": _adaptive_sql("10 minutes", "2 minutes", 5, 1, 30, AS_OF),
    "window_adaptive_5min": _adaptive_sql("5 minutes", "1 minute", 5, 1, 120000, AS_OF),
    "window_static": (
        f"with {EVENTS} select *, '5 minutes' as watermark_delay from "
        f"({sliding_sql('10 minutes', '2 minutes', 5, FULL_SQL, with_events=False)})"
    ),
    "window_baseline": tumbling_sql("5 minutes", REDUCED_SQL),
    "window_count": tumbling_sql("1 minute", COUNT),
    "window_count_avg": tumbling_sql("1 minute", PAIR_SQL),
    "symbol_tumbling": tumbling_sql("2 minutes", PAIR_SQL, "symbol"),
    "symbol_sliding": sliding_sql("2 minutes", "1 minute", 2, PAIR_SQL, "symbol"),
    "symbol_multi": multi_sql(PAIR_SQL, "symbol"),
    "symbol_multi_union": multi_sql(PAIR_SQL, "symbol"),
    "symbol_session": session_sql("2 minutes", PAIR_SQL, "symbol", *BOUNDS),
    "strategy_rows": _strategy_rows_sql(),
    "arrival_delay": f"with {EVENTS} select user_id, event_time, {_delay_sql(LATE_AS_OF)} as delay_s from v where event_time is not null",
    "delay_stats": (
        f"with {EVENTS}, d as (select {_delay_sql(LATE_AS_OF)} as delay from v where event_time is not null) "
        "select max(delay) as max_delay_ms, avg(delay) as avg_delay_ms, "
        "quantile_cont(cast(delay as double), 0.95) as p95_delay_ms from d"
    ),
    "adaptive_delay": _ADAPTIVE_DELAYS_SQL,
}
