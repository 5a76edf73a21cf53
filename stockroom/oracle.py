"""DuckDB SQL with the same result as each registered query.

Used as the correctness oracle: written independently of the Spark code,
directly from the model semantics (``row_number`` instead of ``max_by``,
plain explode instead of the sweep, scalar subqueries instead of driver-side
marks). Fixture inputs come from the same SQL text as on Spark
(:mod:`stockroom.sources.fixtures`). DuckDB's ``arg_max``/``any_value`` skip
nulls, so "latest" is always written with ``row_number``.
"""

from __future__ import annotations

from stockroom.sources.fixtures import AS_OF, duckdb_sql

CUT = "2024-01-20"
RANGE = ("2024-01-18", "2024-01-25")
STOCK_DAYS = ("2024-01-29", "2024-02-05")
CDP_RANGE_1 = ("2024-01-15", "2024-02-20")
CDP_RANGE_2 = ("2024-01-20", "2024-01-31")


def J(path: str, col: str = "value") -> str:
    return f"(case when json_valid({col}) then json_extract_string({col}, '{path}') end)"


def ts(v: str) -> str:
    return f"timestamp '{v}'"


def d(v: str) -> str:
    return f"date '{v}'"


FIXTURE_CTES = [(n, duckdb_sql(n)) for n in ("markets", "vehicle_data", "raw_demo", "raw_preview")]


def build(ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{n} as (\n{s}\n)" for n, s in FIXTURE_CTES + ctes)
    return f"with {body}\n{final}"


# ------------------------------------------------------------------ demo chain

PARSED_DEMO = ("parsed_demo", f"""
select timestamp as event_timestamp,
  cast({J('$.vehicle.arrivalDate')} as date) as arrival_date,
  cast({J('$.vehicle.salesDate')} as date) as sales_date,
  {J('$.vehicle.id')} as inventory_id,
  {J('$.vehicle.country')} as country,
  {J('$.vehicle.conditionType')} as vehicle_condition,
  {J('$.vehicle.vehicleType')} as vehicle_type,
  {J('$.vehicle.dealership.displayName')} as dealer_name,
  coalesce(cast({J('$.vehicle.onlineOrderingEnabled')} as boolean), false) as online_orderable,
  cast({J('$.vehicle.porscheApproved')} as boolean) as porsche_approved,
  processed_at, value
from raw_demo""")

SDP_COLS = ("event_timestamp, arrival_date, sales_date, inventory_id, country, vehicle_condition, "
            "vehicle_type, dealer_name, online_orderable, porsche_approved, processed_at")

SDP_DEMO = ("sdp_demo", f"""
select {SDP_COLS} from (
  select *, row_number() over (partition by inventory_id, event_timestamp
                               order by processed_at desc, value desc) as rn
  from parsed_demo where inventory_id is not null) where rn = 1""")

ATTRS = ["country", "vehicle_condition", "vehicle_type", "dealer_name", "online_orderable",
         "porsche_approved", "arrival_date", "sales_date"]

LATEST_DEMO = ("latest_demo", f"""
select inventory_id, {', '.join(ATTRS)} from (
  select *, row_number() over (partition by inventory_id order by event_timestamp desc) as rn
  from sdp_demo) where rn = 1""")

SPANS_DEMO = ("spans_demo", """
select inventory_id, min(event_timestamp) as valid_from, max(event_timestamp) as valid_to,
       count(*) as event_count, max(processed_at) as processed_at
from sdp_demo group by inventory_id""")

AGG_DEMO = ("agg_demo", """
select s.inventory_id, s.valid_from, s.valid_to, l.country, m.region, m.market,
       l.vehicle_condition, v.model_series, l.vehicle_type, v.engine_type, l.dealer_name,
       l.online_orderable, l.porsche_approved, l.arrival_date, l.sales_date,
       s.event_count, s.processed_at
from spans_demo s join latest_demo l on s.inventory_id = l.inventory_id
left join markets m on l.country = m.country
left join vehicle_data v on s.inventory_id = v.inventory_id""")

DEMO = [PARSED_DEMO, SDP_DEMO]
DEMO_AGG = DEMO + [LATEST_DEMO, SPANS_DEMO, AGG_DEMO]

DIMS = "region, market, country, vehicle_condition, model_series, vehicle_type, engine_type, dealer_name"

EXPLODED_DEMO = ("exploded_demo", f"""
select {DIMS}, online_orderable, porsche_approved, cast(stock_ts as date) as stock_date,
       date_diff('day', cast(valid_from as date), cast(stock_ts as date)) as stock_days
from (select *, unnest(generate_series(cast(valid_from as date), cast(valid_to as date),
                                       interval 1 day)) as stock_ts
      from agg_demo where cast(valid_from as date) <= cast(valid_to as date))
union all
select {DIMS}, online_orderable, porsche_approved, null::date, null::bigint
from agg_demo where not coalesce(cast(valid_from as date) <= cast(valid_to as date), false)""")

CDP_DEMO_FINAL = f"""
select stock_date, {DIMS},
  count(*) as published_net_stock_count, count(*) as net_stock_count,
  cast(sum(case when online_orderable then 1 else 0 end) as bigint) as online_orderable_count,
  cast(sum(case when porsche_approved then 1 else 0 end) as bigint) as approved_count,
  cast(sum(stock_days) as bigint) as stock_days
from exploded_demo group by all"""


# ------------------------------------------------------------------ preview chain

PARSED_PREVIEW = ("parsed_preview", f"""
select timestamp as event_timestamp,
  {J('$.vehicleSnapshot.id')} as inventory_id,
  {J('$.vehicleSnapshot.removalDateTime')} as removal_date_time,
  {J('$.vehicleSnapshot.creationDateTime')} as creation_date_time,
  processed_at, value
from raw_preview""")

EARLY = (f"event_timestamp < {ts(CUT + ' 00:00:00')} "
         "and not coalesce(inventory_id like '%7', false)")

B1 = ("b1", f"select * from parsed_preview where {EARLY}")
B2 = ("b2", f"select * from parsed_preview where not ({EARLY})")

SNAP_COLS = "event_timestamp, inventory_id, removal_date_time, creation_date_time"


def latest(src: str, keys: str = "inventory_id", cols: str = SNAP_COLS, where: str = "true") -> str:
    return f"""
select {cols} from (
  select *, row_number() over (partition by {keys}
                               order by event_timestamp desc, processed_at desc, value desc) as rn
  from {src} where inventory_id is not null and ({where})) where rn = 1"""


def spans(snap: str, name: str = "spans") -> tuple[str, str]:
    """Padded valid spans of a snapshot relation."""
    return (name, f"""
select inventory_id, cast(creation_date_time as timestamp) as span_start,
       coalesce(cast(removal_date_time as timestamp), {ts(AS_OF)}) as span_end
from {snap}
where coalesce(cast(removal_date_time as timestamp), {ts(AS_OF)})
      > cast(creation_date_time as timestamp)""")


def exploded(span_rel: str, name: str = "exploded") -> tuple[str, str]:
    return (name, f"""
select inventory_id, cast(stock_ts as date) as stock_date,
       cast(date_diff('day', cast(span_start as date), cast(stock_ts as date)) as integer) as stock_days
from (select *, unnest(generate_series(cast(span_start as date), cast(span_end as date),
                                       interval 1 day)) as stock_ts
      from {span_rel})""")


def daily(exploded_rel: str, where: str = "true") -> str:
    return f"""
select stock_date, count(*) as net_stock_count, cast(sum(stock_days) as bigint) as stock_days
from {exploded_rel} where {where} group by stock_date"""


PREVIEW = [PARSED_PREVIEW, ("sdp_preview", latest("parsed_preview"))]
PREVIEW_DAILY = PREVIEW + [spans("sdp_preview"), exploded("spans")]

RAW_SPANS = ("raw_spans", """
select inventory_id, cast(creation_date_time as timestamp) as span_start,
       cast(removal_date_time as timestamp) as span_end from sdp_preview""")


def between_ts(col: str, lo: str, hi: str) -> str:
    return (f"{col} >= {ts(lo + ' 00:00:00')} and "
            f"{col} < {ts(hi + ' 00:00:00')} + interval 1 day")


# ------------------------------------------------------------------ incremental scenarios

# P6: B1 loaded, then rows of B2 newer than B1's latest event time.
P6 = [B1, B2, ("mark", "select max(event_timestamp) as m from b1"),
      ("inc", "select * from b1 union all select * from b2 where event_timestamp > (select m from mark)"),
      ("p6", latest("inc"))]

# P7: run 1 over RANGE on B1 only; run 2 over 19..22 on everything.
P7 = [B1,
      ("p7_run1", latest("b1", "inventory_id, cast(event_timestamp as date)",
                         where=between_ts("event_timestamp", *RANGE))),
      ("p7_run2", latest("parsed_preview", "inventory_id, cast(event_timestamp as date)",
                         where=between_ts("event_timestamp", "2024-01-19", "2024-01-22"))),
      ("p7", f"""
select * from p7_run1 where not (cast(event_timestamp as date) between {d('2024-01-19')} and {d('2024-01-22')})
union all select * from p7_run2""")]

# P8: one-job backfill over RANGE (latest per id), then day RANGE[0] re-run.
P8 = [("all_days", latest("parsed_preview", where=between_ts("event_timestamp", *RANGE))),
      ("day_one", latest("parsed_preview", where=between_ts("event_timestamp", RANGE[0], RANGE[0]))),
      ("p8", """
select * from day_one union all
select * from all_days where inventory_id not in (select inventory_id from day_one)""")]

# P9: daily stock from the P6 state after B1, then days >= its last day
# recomputed from the P6 state after B2 and merged on the day.
P9 = P6 + [("s1", latest("b1")), spans("s1", "spans1"), exploded("spans1", "ex1"),
           ("t1", daily("ex1")), ("m9", "select max(stock_date) as m from t1"),
           spans("p6", "spans2"), exploded("spans2", "ex2"),
           ("t2", daily("ex2", "stock_date >= (select m from m9)")),
           ("p9", "select * from t2 union all select * from t1 where stock_date not in (select stock_date from t2)")]

# P10: daily stock over CDP_RANGE_1 from the P7 state after run 1, then
# CDP_RANGE_2 replaced from the P7 state after run 2.
P10 = P7 + [spans("p7_run1", "spans1"), exploded("spans1", "ex1"),
            spans("p7", "spans2"), exploded("spans2", "ex2"),
            ("p10", f"""
{daily('ex1', f"stock_date between {d(CDP_RANGE_1[0])} and {d(CDP_RANGE_1[1])} and not (stock_date between {d(CDP_RANGE_2[0])} and {d(CDP_RANGE_2[1])})")}
union all
{daily('ex2', f"stock_date between {d(CDP_RANGE_2[0])} and {d(CDP_RANGE_2[1])}")}""")]


# ------------------------------------------------------------------ the oracle queries

def _q() -> dict[str, str]:
    q: dict[str, str] = {}
    q["sdp_demo"] = build(DEMO, "select * from sdp_demo")
    q["sdp_demo_get_json"] = q["sdp_demo"]
    q["contract_projection"] = q["sdp_demo"]
    q["agg_demo"] = build(DEMO_AGG, "select * from agg_demo")
    q["agg_demo_window"] = q["agg_demo"]
    q["full_refresh"] = q["agg_demo"]
    q["cdp_demo"] = build(DEMO_AGG + [EXPLODED_DEMO], CDP_DEMO_FINAL)
    q["cdp_demo_sweep"] = q["cdp_demo"]
    q["demo_chain_tables"] = q["cdp_demo"]
    q["cdp_demo_explode"] = q["cdp_demo"]
    q["sdp_preview"] = build(PREVIEW, "select * from sdp_preview")
    q["sdp_preview_max_by"] = q["sdp_preview"]
    q["passthrough_copy"] = q["sdp_preview"]
    q["view_materialization"] = q["sdp_preview"]
    q["cdp_preview"] = build(PREVIEW_DAILY, daily("exploded"))
    q["daily_stock"] = build(DEMO_AGG + [EXPLODED_DEMO], """
select stock_date, country, count(*) as net_stock_count,
  cast(sum(case when online_orderable then 1 else 0 end) as bigint) as online_orderable_count,
  cast(sum(stock_days) as bigint) as stock_days
from exploded_demo where stock_date is not null group by all""")
    q["preview_chain_tables"] = q["cdp_preview"]
    q["cdp_preview_explode"] = q["cdp_preview"]

    q["sdp_incremental_hwm"] = build([PARSED_PREVIEW] + P6, "select * from p6")
    q["incremental_first_run"] = q["sdp_incremental_hwm"]
    q["sdp_incremental_lookback"] = build([PARSED_PREVIEW, B1, ("seen", """
select * from b1 union
select * from parsed_preview where event_timestamp > (select max(event_timestamp) - interval 3 day from b1)""")],
                                          "select * from (" + latest("seen") + ")")
    q["sdp_incremental_key_newer"] = build([PARSED_PREVIEW], "select * from (" + latest(
        "parsed_preview", where=between_ts("event_timestamp", *RANGE)) + ")")
    q["sdp_incremental_range"] = build([PARSED_PREVIEW] + P7, "select * from p7")
    q["backfill_daily"] = build([PARSED_PREVIEW], "select * from (" + latest(
        "parsed_preview", "inventory_id, cast(event_timestamp as date)",
        where=between_ts("event_timestamp", *RANGE)) + ")")
    q["backfill_chunked"] = q["backfill_daily"]
    q["write_on_curve"] = q["sdp_demo"]
    q["sdp_incremental_key"] = build([PARSED_PREVIEW] + P8, "select * from p8")
    q["cdp_incremental_hwm"] = build([PARSED_PREVIEW] + P9, "select * from p9")
    q["cdp_incremental_range"] = build([PARSED_PREVIEW] + P10, "select * from p10")

    q["cdp_incremental_delta"] = q["cdp_preview"]

    # sources / sinks / streams
    q["stream_dedup_redelivery"] = build([PARSED_DEMO], """
select distinct inventory_id, event_timestamp, country, vehicle_type, dealer_name, online_orderable,
       porsche_approved, arrival_date, sales_date
from parsed_demo where inventory_id is not null""")
    q["stream_latest_stateful"] = q["sdp_preview"]
    q["merge_delta_compact"] = """
select * exclude (rn) from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
                            from events) where rn = 1"""
    q["source_declared_schema"] = "select event_id, ts, user_id, event_type from events"
    land = f"select key, topic, timestamp, value, {ts(AS_OF)} as processed_at from raw_preview"
    q["land_raw_projection"] = build([], land)
    q["stream_land_raw"] = q["land_raw_projection"]
    q["stream_upsert_latest"] = q["sdp_preview"]
    q["merge_by_key"] = """
with first as (
  select * exclude (rn) from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
                              from events where ts < timestamp '2024-01-15 00:00:00') where rn = 1),
batch as (
  select * exclude (rn) from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
                              from events where event_type = 'purchase' or ts >= timestamp '2024-01-15 00:00:00') where rn = 1)
select * from batch union all
select * from first where user_id not in (select user_id from batch)"""
    q["replace_time_range"] = """
with full_counts as (
  select cast(ts as date) as event_date, event_type, count(*) as event_count from events group by all),
changed as (
  select cast(ts as date) as event_date, event_type, count(*) as event_count from events
  where event_type <> 'error' and cast(ts as date) <> date '2024-01-12'
    and cast(ts as date) between date '2024-01-10' and date '2024-01-15'
  group by all)
select * from full_counts where not (event_date between date '2024-01-10' and date '2024-01-15')
union all select * from changed"""

    # filters
    q["filter_null_id"] = build([PARSED_PREVIEW], "select event_timestamp, inventory_id from parsed_preview where inventory_id is not null")
    q["filter_valid_span"] = build(PREVIEW + [RAW_SPANS], f"""
select * from raw_spans where coalesce(span_end, {ts(AS_OF)}) > span_start""")
    q["pad_open_span"] = build(PREVIEW + [RAW_SPANS], f"""
select inventory_id, span_start, coalesce(span_end, {ts(AS_OF)}) as span_end from raw_spans""")
    q["interval_filter_ts"] = build([PARSED_PREVIEW], f"""
select event_timestamp, inventory_id, removal_date_time, creation_date_time from parsed_preview
where inventory_id is not null and {between_ts('event_timestamp', *RANGE)}""")
    q["interval_filter_date"] = build(PREVIEW_DAILY, f"""
select inventory_id, stock_date, stock_days from exploded
where stock_date between {d(STOCK_DAYS[0])} and {d(STOCK_DAYS[1])}""")
    q["hwm_strict_filter"] = build([PARSED_PREVIEW, B1], """
select event_timestamp, inventory_id, removal_date_time, creation_date_time from parsed_preview
where inventory_id is not null and event_timestamp > (select max(event_timestamp) from b1)""")
    q["hwm_inclusive_filter"] = build(PREVIEW_DAILY + [B1, ("s1", latest("b1")), spans("s1", "spans1"),
                                                       exploded("spans1", "ex1")], """
select inventory_id, stock_date, stock_days from exploded
where stock_date >= (select max(stock_date) from ex1)""")

    # windows / latest
    q["latest_per_key"] = """
select * exclude (rn) from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
                            from events) where rn = 1"""
    q["dedup_redelivery"] = build([], """
select * exclude (rn) from (select *, row_number() over (partition by key, timestamp
                                                        order by processed_at desc, value desc) as rn
                            from raw_demo) where rn = 1""")
    fv = ", ".join(f"first_value({c}) over w as {c}" for c in ATTRS)
    q["first_value_full_frame"] = build(DEMO, f"""
select inventory_id, event_timestamp, {fv} from sdp_demo
window w as (partition by inventory_id order by event_timestamp desc
             rows between unbounded preceding and unbounded following)""")
    q["any_value_constant"] = build(DEMO + [LATEST_DEMO], "select * from latest_demo")
    q["latest_attributes"] = q["any_value_constant"]

    # aggregates
    q["validity_span"] = build(DEMO + [SPANS_DEMO], "select inventory_id, valid_from, valid_to, event_count from spans_demo")
    q["group_by_one"] = "select event_type, count(*) as event_count from events group by event_type"
    q["group_by_many"] = build(DEMO_AGG, f"""
select cast(valid_from as date) as first_day, {DIMS}, count(*) as vehicle_count from agg_demo group by all""")
    q["conditional_count"] = build(DEMO_AGG, """
select country,
  cast(sum(case when online_orderable then 1 else 0 end) as bigint) as online_orderable_count,
  cast(sum(case when porsche_approved then 1 else 0 end) as bigint) as approved_count
from agg_demo group by country""")

    # joins
    q["left_join_dimension"] = build(DEMO_AGG, "select inventory_id, country, region, market from agg_demo")
    q["left_join_entity_bucketed"] = build(DEMO_AGG, "select inventory_id, model_series, engine_type from agg_demo")
    q["left_join_entity"] = build(DEMO_AGG, "select inventory_id, model_series, engine_type from agg_demo")

    # generators, day arithmetic
    q["explode_days_inner"] = build(PREVIEW + [RAW_SPANS], """
select inventory_id, cast(stock_ts as date) as stock_date from (
  select inventory_id, unnest(generate_series(cast(span_start as date), cast(span_end as date), interval 1 day)) as stock_ts
  from raw_spans where cast(span_start as date) <= cast(span_end as date))""")
    q["explode_days_outer"] = build(PREVIEW + [RAW_SPANS], """
select inventory_id, cast(stock_ts as date) as stock_date from (
  select inventory_id, unnest(generate_series(cast(span_start as date), cast(span_end as date), interval 1 day)) as stock_ts
  from raw_spans where cast(span_start as date) <= cast(span_end as date))
union all
select inventory_id, null::date from raw_spans
where not coalesce(cast(span_start as date) <= cast(span_end as date), false)""")
    q["expand_days"] = build(DEMO_AGG + [("x", """
select inventory_id, cast(stock_ts as date) as stock_date,
       date_diff('day', cast(valid_from as date), cast(stock_ts as date)) as stock_days
from (select *, unnest(generate_series(cast(valid_from as date), cast(valid_to as date), interval 1 day)) as stock_ts
      from agg_demo)""")], "select * from x")
    q["date_diff_days"] = build(PREVIEW_DAILY, "select inventory_id, stock_date, stock_days from exploded")
    q["date_diff_unit"] = build(DEMO_AGG, """
select inventory_id, date_diff('day', cast(valid_from as date), cast(valid_to as date)) as span_days from agg_demo""")

    # JSON and casts
    q["json_extract"] = build([], f"""
select key, timestamp, processed_at, {J('$.vehicle')} as vehicle_json,
       {J('$.vehicle.country')} as country from raw_demo""")
    q["json_extract_nested"] = build([], f"""
select key, timestamp, {J('$.vehicleSnapshot.id')} as inventory_id,
       {J('$.vehicleSnapshot.removalDateTime')} as removal_date_time,
       {J('$.vehicleSnapshot.creationDateTime')} as creation_date_time from raw_preview""")
    q["json_extract_path"] = build([], f"""
select key, timestamp, processed_at, {J('$.vehicle.dealership.displayName')} as dealer_name from raw_demo""")
    q["cast_date"] = build([], f"""
select key, timestamp, processed_at, cast({J('$.vehicle.arrivalDate')} as date) as arrival_date,
       cast({J('$.vehicle.salesDate')} as date) as sales_date from raw_demo""")
    q["cast_boolean"] = build([], f"""
select key, timestamp, processed_at,
       cast({J('$.vehicle.onlineOrderingEnabled')} as boolean) as online_ordering_enabled,
       cast({J('$.vehicle.porscheApproved')} as boolean) as porsche_approved from raw_demo""")
    q["coalesce_default"] = build([], f"""
select key, timestamp, processed_at,
       coalesce(cast({J('$.vehicle.onlineOrderingEnabled')} as boolean), false) as online_orderable
from raw_demo""")

    # quality
    q["audit_not_null"] = build(DEMO, """
select inventory_id, event_timestamp, vehicle_condition from sdp_demo where vehicle_condition is null""")
    q["audit_accepted_values"] = build(DEMO, """
select inventory_id, event_timestamp, vehicle_type from sdp_demo
where vehicle_type not in ('USED_CAR', 'COMMISSION_CAR') and vehicle_type is not null""")
    q["audit_unique_grain"] = build([], """
select key, timestamp, count(*) as row_count from raw_demo group by key, timestamp having count(*) > 1""")
    q["audit_summary"] = build(DEMO, """
select 'assert_vehicle_condition_not_null' as audit, cast(count_if(vehicle_condition is null) as bigint) as violations from sdp_demo
union all
select 'assert_valid_vehicle_types', cast(count_if(vehicle_type not in ('USED_CAR', 'COMMISSION_CAR') and vehicle_type is not null) as bigint) from sdp_demo
union all
select 'assert_unique_grain', cast(coalesce(sum(n), 0) as bigint) from (
  select count(*) as n from sdp_demo group by inventory_id, event_timestamp having count(*) > 1)""")
    q["table_diff"] = build([PARSED_PREVIEW, B1, ("s1", latest("b1")), ("s2", latest("parsed_preview"))], """
select coalesce(a.inventory_id, b.inventory_id) as inventory_id,
  case when a.inventory_id is null then 'added'
       when b.inventory_id is null then 'removed' else 'changed' end as change
from s1 a full outer join s2 b on a.inventory_id = b.inventory_id
where a.inventory_id is null or b.inventory_id is null
   or a.event_timestamp is distinct from b.event_timestamp
   or a.removal_date_time is distinct from b.removal_date_time
   or a.creation_date_time is distinct from b.creation_date_time""")
    q["table_diff_pruned"] = q["table_diff"]
    return q


ORACLE: dict[str, str] = _q()
