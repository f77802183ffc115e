"""The same windows in plain SQL, to check the registered queries with another engine.

Window widths have to divide one day: the other engine counts buckets from
2000-01-03, Spark from 1970-01-01.
"""

from __future__ import annotations

EVENTS = (
    "v as (select ts as event_time, event_type as symbol, value as price, "
    "cast(json_extract_string(props, '$.k') as bigint) as volume, cast(user_id as varchar) as user_id, "
    "case when event_type = 'purchase' then 'BUY' else 'SELL' end as trade_type from events)"
)

COUNT = "count(*) as event_count"
VOLUME = "cast(sum(volume) as bigint) as total_volume"
AVERAGE = "cast(sum(cast(price as decimal(18,2))) as double) / nullif(count(price), 0) as avg_price"
FULL_SQL = f"{COUNT}, {VOLUME}, {AVERAGE}, max(price) as max_price, min(price) as min_price"
REDUCED_SQL = f"{COUNT}, {VOLUME}, {AVERAGE}"
PAIR_SQL = f"{COUNT}, {AVERAGE}"
BOUNDS = ("window_start", "window_end")


def _prefix(with_events: bool) -> str:
    return f"with {EVENTS} " if with_events else ""


def tumbling_sql(width: str, measures: str, key: str = "", with_events: bool = True) -> str:
    start = f"time_bucket(interval '{width}', event_time)"
    keys = f"{key}, " if key else ""
    return (
        f"{_prefix(with_events)}select {keys}{start} as window_start, {start} + interval '{width}' as window_end, "
        f"{measures} from v where event_time is not null group by {keys}{start}"
    )


def sliding_sql(size: str, slide: str, copies: int, measures: str, key: str = "", with_events: bool = True) -> str:
    keys = f"{key}, " if key else ""
    rows = (
        f"select time_bucket(interval '{slide}', event_time) - k * interval '{slide}' as window_start, v.* "
        f"from v, range({copies}) r(k) where event_time is not null"
    )
    return (
        f"{_prefix(with_events)}select {keys}window_start, window_start + interval '{size}' as window_end, {measures} "
        f"from ({rows}) group by {keys}window_start"
    )


def session_sql(
    gap: str, measures: str, key: str, start: str = "session_start", end: str = "session_end"
) -> str:
    return (
        f"with {EVENTS}, a as (select *, lag(event_time) over w as before from v where event_time is not null "
        f"window w as (partition by {key} order by event_time)), "
        f"b as (select *, sum(case when before is null or event_time - before > interval '{gap}' then 1 else 0 end) "
        f"over (partition by {key} order by event_time rows unbounded preceding) as sid from a) "
        f"select {key}, min(event_time) as {start}, max(event_time) + interval '{gap}' as {end}, {measures} "
        f"from b group by {key}, sid"
    )


def closed_sql(query: str, delay: str, end: str = "window_end") -> str:
    """Only the windows a stream in append mode has closed at its end."""
    mark = f"(select date_trunc('millisecond', max(ts)) from events) - interval '{delay}'"
    return f"select * from ({query}) where {end} <= {mark}"


# A table replayed in slices of arrival. After each slice the watermark stands at the latest event seen
# less the delay; with batches in one run it decides on late rows two batches on, after a restart in the next.
_DELAY = "interval '12 hours'"
_SLICE_MICROS = 5 * 86_400_000_000


def _arrived(lag: int) -> str:
    """The events ``v`` with their batch ``n`` and the mark ``late`` before which rows are dropped; ``b`` has the batches."""
    minutes = "case when event_id % 10 = 0 then event_id * 7919 % 17280 else event_id % 7 end"
    return f"""
a as (select ts as event_time, event_type as symbol, value as price,
    cast(json_extract_string(props, '$.k') as bigint) as volume, cast(user_id as varchar) as user_id,
    (epoch_us(ts) + ({minutes}) * 60000000) // {_SLICE_MICROS} as slice from events where ts is not null),
b as (select slice, row_number() over (order by slice) as n,
    date_trunc('millisecond', max(max(event_time)) over (order by slice)) - {_DELAY} as mark from a group by slice),
v as (select a.*, m.n, m.late from a join (select *, lag(mark, {lag}) over (order by n) as late from b) m using (slice))"""


def late_windows_sql(widths: tuple[str, ...], measures: str = FULL_SQL, lag: int = 2, tagged: bool = False) -> str:
    """Tumbling windows of a replay: rows whose window was closed are dropped, windows closed at the end are reported."""
    parts = []
    for width in widths:
        start = f"time_bucket(interval '{width}', event_time)"
        tag = f", '{width}' as granularity" if tagged else ""
        parts.append(
            f"select {start} as window_start, {start} + interval '{width}' as window_end, {measures}{tag} from v "
            f"where late is null or {start} + interval '{width}' > late group by {start}"
        )
    return f"with {_arrived(lag)} select * from ({' union all '.join(parts)}) where window_end <= (select max(mark) from b)"


LATE_DROPPED_SQL = f"""
with {_arrived(2)}, w as (select n, late, time_bucket(interval '5 minutes', event_time) as start from v)
select n - 1 as batch, count(*) as input_rows,
    count(distinct case when start + interval '5 minutes' <= late then start end) as late_windows
from w group by n
"""


def late_sessions_sql(gap: str, slices: int) -> str:
    """Sessions of a replay, batch by batch: live sessions and a batch's events merge, then what the mark has passed goes."""
    steps = [
        f"""
with {_arrived(2)},
x0 as (select user_id, event_time as s, event_time as e, 1::bigint as rows, volume::hugeint as volume,
    cast(price as decimal(38,2)) as total, 1::bigint as priced, price as most, price as least, false as done from v where false)"""
    ]
    for n in range(1, slices + 2):
        steps.append(f"""
r{n} as (select * from x{n - 1} where not done union all
    select user_id, event_time, event_time + interval '{gap}', 1, volume, cast(price as decimal(18,2)),
        case when price is null then 0 else 1 end, price, price, false
    from v where n = {n} and (late is null or event_time + interval '{gap}' > late)),
g{n} as (select *, max(e) over (partition by user_id order by s, e rows between unbounded preceding and 1 preceding) as reach from r{n}),
i{n} as (select *, sum(case when reach is null or s > reach then 1 else 0 end)
    over (partition by user_id order by s, e rows unbounded preceding) as sid from g{n}),
x{n} as materialized (select user_id, min(s) as s, max(e) as e, sum(rows)::bigint as rows, sum(volume)::hugeint as volume,
    sum(total)::decimal(38,2) as total, sum(priced)::bigint as priced, max(most) as most, min(least) as least,
    coalesce(max(e) <= (select max(mark) from b where b.n < {n}), false) as done from i{n} group by user_id, sid)""")
    done = " union all ".join(f"select * from x{n} where done" for n in range(1, slices + 2))
    return (
        ",".join(steps)
        + " select user_id, s as session_start, e as session_end, rows as event_count, cast(volume as bigint) as total_volume, "
        f"cast(total as double) / nullif(priced, 0) as avg_price, most as max_price, least as min_price from ({done})"
    )


def adaptive_cycles_sql(as_of: str, low: int, high: int) -> str:
    """Sliding windows of a replay, a run for each slice, its delay from the 95th percentile of all events so far."""
    delay = f"cast(epoch(timestamp '{as_of}') - floor(epoch(event_time)) as double)"
    return f"""
with {_arrived(1)},
p as (select b.n, (select quantile_cont({delay}, 0.95) from v where v.n <= b.n) as p95,
    (select date_trunc('millisecond', max(event_time)) from v where v.n = b.n) as seen from b),
d as (select *, least(greatest(cast(trunc(coalesce(nullif(p95, 0), 300) / 60 * 1.2) as bigint), {low}), {high}) as minutes from p),
w as (select n, minutes, max(seen - to_minutes(minutes)) over (order by n) as mark from d),
s as (select time_bucket(interval '1 minute', event_time) - k * interval '1 minute' as window_start, v.* exclude (late),
    (select mark from w where w.n = v.n - 1) as late from v, range(5) r(k)),
g as (select window_start, window_start + interval '5 minutes' as window_end, {FULL_SQL} from s
    where late is null or window_start + interval '5 minutes' > late group by window_start)
select g.*, (select arg_min(minutes, n) from w where mark >= window_end) || ' minutes' as watermark_delay
from g where window_end <= (select max(mark) from w)"""
