"""ANSI SQL twins of the registered queries, for the DuckDB check."""

from __future__ import annotations

_VISITS = """
v as (
  select event_id, user_id, ts, event_type, cast(ts as date) as d, event_type = 'signup' as entry,
         case when event_type = 'signup' then '1' else '0' end as is_new,
         cast(round(value * 100) as bigint) as dur
  from events),
w as (
  select *, lead(ts) over k as next_ts, lead(entry) over k as next_entry,
         row_number() over (partition by user_id, d order by ts, event_id) as day_rank
  from v window k as (partition by user_id order by ts, event_id)),
f as (
  select *, entry and (next_ts is null or next_ts - ts >= interval 12 hours or next_entry) as bounce from w)
"""

VISITOR_STATS = f"""
with {_VISITS}
select strftime(d, '%Y-%m-%d %H:%M:%S') as stt, strftime(d + interval 1 day, '%Y-%m-%d %H:%M:%S') as edt,
       event_type as vc, event_type as ch, event_type as ar, is_new,
       cast(sum(case when day_rank = 1 then 1 else 0 end) as bigint) as uv_ct,
       count(*) as pv_ct,
       cast(sum(case when entry then 1 else 0 end) as bigint) as sv_ct,
       cast(sum(case when bounce then 1 else 0 end) as bigint) as uj_ct,
       cast(sum(dur) as bigint) as dur_sum
from f group by d, event_type, is_new
"""

NEW_VISITOR = f"""
with {_VISITS},
r as (select *, row_number() over (partition by user_id, is_new order by ts, event_id) as claim from v)
select event_id, user_id, case when is_new = '1' and claim > 1 then '0' else is_new end as is_new from r
"""

DAILY_UNIQUE = f"""
with {_VISITS} select event_id, user_id, strftime(d, '%Y-%m-%d') as day from w where day_rank = 1
"""

BOUNCE = f"with {_VISITS} select event_id, user_id from f where bounce"

_DELTA = """
select event_id, user_id, last_value, value from (
  select event_id, user_id, value, {base} over (partition by user_id order by ts, event_id) as last_value from events)
where abs(value - last_value) >= 100
"""
DELTA_PREVIOUS = _DELTA.format(base="lag(value)")

LOGS = """
g as (
  select *, cast(user_id as varchar) as mid, case when event_type = 'signup' then '1' else '0' end as is_new,
         epoch_us(ts) // 1000 as ts_ms
  from events where event_id % 101 not in (3, 4, 5, 7))
"""

_WIDE = """
w as (
  select l_orderkey * 10 + l_linenumber as detail_id, o_orderkey as order_id, l_partkey as sku_id,
         cast(l_extendedprice as double) as order_price, cast(l_quantity as bigint) as sku_num,
         o_custkey % 25 as province_id, o_orderstatus as order_status, o_custkey as user_id,
         cast(o_totalprice as double) as total_amount, cast(l_extendedprice as double) as split_total_amount,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as create_time, strftime(o_orderdate, '%Y-%m-%d') as create_date,
         strftime(o_orderdate, '%H') as create_hour
  from orders join lineitem on l_orderkey = o_orderkey
   and l_shipdate between o_orderdate - interval 90 days and o_orderdate + interval 90 days)
"""

#: All columns of the wide order row.
FULL_DIMENSIONS = "u as (select c_custkey, c_custkey % 2 = 0 as f, date '1960-01-01' + cast(c_custkey % 15000 as integer) as b from customer)"
_SPLIT = "cast(l_extendedprice as double) as split_total_amount,"
_FULL = f"""
{_WIDE.replace(_SPLIT, _SPLIT + " cast(l_discount as double) as split_activity_amount, cast(l_tax as double) as split_coupon_amount,")},
{FULL_DIMENSIONS},
x as (
  select w.*, p_name as sku_name, total_amount as original_total_amount, 0.0::double as activity_reduce_amount, 0.0::double as coupon_reduce_amount,
    0.0::double as feight_fee, cast(null as double) as split_feight_fee, cast(null as varchar) as expire_time, create_time as operate_time,
    cast(2021 - year(b) - case when dayofyear(date '2021-11-02') < dayofyear(b) then 1 else 0 end as integer) as user_age,
    case when f then 'F' else 'M' end as user_gender, n_name as province_name, cast(n_regionkey as varchar) as province_area_code,
    'N' || n_nationkey as province_iso_code, r_name as province_3166_2_code, p_partkey % 100 as spu_id, s_name as spu_name,
    cast(split_part(p_brand, '#', 2) as bigint) as tm_id, p_brand as tm_name, cast(p_size as bigint) as category3_id, 'Size ' || p_size as category3_name
  from w
  left join u on user_id = c_custkey left join nation on province_id = n_nationkey left join region on n_regionkey = r_regionkey
  left join part on sku_id = p_partkey left join supplier on s_suppkey = p_partkey % 100)
"""

ORDER_WIDE = f"with {_WIDE} select * from w"

_PAYMENT = """
select o_orderkey as payment_id, o_orderkey as order_id, o_custkey as user_id, cast(o_totalprice as double) as total_amount,
       cast(o_totalprice as double) as order_total_amount, o_orderpriority as subject, 'card' as payment_type,
       strftime(o_orderdate + to_minutes(o_orderkey % 30), '%Y-%m-%d %H:%M:%S') as payment_create_time,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as order_create_time, o_orderstatus as order_status,
       o_custkey % 25 as province_id
from orders where o_orderstatus = 'F'
"""
PAYMENT_WIDE = _PAYMENT + " and o_orderkey % 30 <= 15"

_CDC = """
c as (
  select o_orderkey, o_custkey, o_orderstatus, cast(cast(o_totalprice as decimal(18,2)) as varchar) as price,
         epoch_ms(o_orderdate) as ts, 'orders_' || lower(o_orderstatus) as tab,
         case when o_orderkey % 10 = 0 then 'delete' when o_orderkey % 10 < 4 then 'update' else 'insert' end as kind
  from orders)
"""

_ROUTED = f"""
{_CDC},
r as (
  select *, case
      when tab = 'orders_f' and kind = 'insert' then 'fact'
      when tab = 'orders_o' and kind = 'update' then 'fact'
      when tab = 'orders_o' and kind = 'insert' then 'dim'
      when tab = 'orders_f' and kind = 'delete' then 'dim'
      when kind = 'update' then 'bad_key'
      else 'unrouted' end as tag
  from c)
"""

_CONFIG = """
ch as (
  select p_brand as sourceTable, p_type as operateType,
         case when p_partkey % 3 = 0 then 'kafka' else 'hbase' end as sinkType,
         'dim_' || lower(p_brand) || '_' || cast(p_partkey % 2 as varchar) as sinkTable,
         case when p_partkey % 5 = 0 then 'delete' else 'set' end as kind, p_partkey
  from part),
live as (
  select * from (select *, row_number() over (partition by sourceTable, operateType order by p_partkey desc) as rn from ch)
  where rn = 1 and kind <> 'delete')
"""

KEYED_UPSERT = """
with ch as (
  select o_custkey, o_orderkey as ver, o_orderkey % 10 = 0 as del,
         case when o_orderkey % 3 = 0 then o_orderstatus end as status,
         case when o_orderkey % 3 <> 0 then o_totalprice end as price
  from orders),
g as (
  select o_custkey, coalesce(max(ver) filter (where del), -1) as gone, max(ver) filter (where not del) as put
  from ch group by o_custkey)
select g.o_custkey, arg_max(status, ver) filter (where status is not null and ver > gone) as status,
       arg_max(price, ver) filter (where price is not null and ver > gone) as price
from g join ch on ch.o_custkey = g.o_custkey
where put is not null and put > gone
group by g.o_custkey
"""

WINDOW_COUNT = """
select user_id, cast(epoch(cast(ts as date) + interval 1 day) as bigint) as window_end, count(*) as n
from events group by user_id, cast(ts as date)
"""

_COUNT_WINDOW = """
select user_id, cast((rn - 1) // 5 as bigint) as bucket, count(*) as n, cast(sum(cents) as bigint) as total from (
  select user_id, row_number() over (partition by user_id order by ts, event_id) as rn,
         cast(round(value * 100) as bigint) as cents from events)
group by all
"""

_HASH = """
select c_custkey, cast(case when h >= 2147483648 then h - 4294967296 else h end as integer) as code from (
  select c_custkey, ((list_reduce(list_transform(string_split(c_name, ''), lambda x: cast(unicode(x) as bigint)),
         lambda a, x: (a * 31 + x) % 4294967296)) * 10) % 4294967296 as h from customer)
"""

_SPLIT = """
select p_partkey, word, cast(length(word) as integer) as length
from (select p_partkey, unnest(string_split(p_name, ' ')) as word from part)
"""

SESSIONS = """
with g as (
  select *, case when ts - lag(ts) over (partition by user_id order by ts, event_id) <= interval 1 hour then 0 else 1 end as opens
  from events),
s as (select *, sum(opens) over (partition by user_id order by ts, event_id) as sid from g)
select user_id, epoch_us(min(ts)) as session_start, epoch_us(max(ts)) + 3600000000 as session_end, count(*) as n,
       cast(sum(cast(round(value * 100) as bigint)) as bigint) as total
from s group by user_id, sid
"""

_BUCKETED = """
select event_type, cast(epoch({end}) as bigint) as window_end, count(*) as n from ({rows}) group by all
"""

ORACLES = {
    "visitor_stats": VISITOR_STATS,
    "visitor_stats_feeds": VISITOR_STATS,
    "new_visitor_repair": NEW_VISITOR,
    "new_visitor_repair_seeded": f"""
with {_VISITS}, r as (select *, row_number() over (partition by user_id order by ts, event_id) as seen from v)
select event_id, user_id, case when is_new = '1' and seen > 1 then '0' else is_new end as is_new from r""",
    "daily_unique_visitor": DAILY_UNIQUE,
    "daily_unique_change": """
select event_id, user_id, strftime(d, '%Y-%m-%d') as day from (
  select event_id, user_id, d, lag(d) over (partition by user_id order by event_id % 7, event_id) as before
  from (select *, cast(ts as date) as d from events))
where before is null or before <> d""",
    "bounce_detection": BOUNCE,
    "delta_alert": DELTA_PREVIOUS,
    "delta_alert_first": _DELTA.format(base="first_value(value)"),
    "log_parse_dirty": """
select event_id, case event_id % 101 when 3 then 'bad_json' when 4 then 'bad_json' when 5 then 'not_an_object'
       else 'no_mid' end as reason
from events where event_id % 101 in (3, 4, 5, 7)""",
    "log_split": f"""
with {LOGS} select event_id, case when event_type = 'error' then 'start' else 'page' end as kind, mid, is_new, ts_ms
from g""",
    "display_explode": f"""
with {LOGS} select event_id, mid, ts_ms as ts, event_id * 10 + i as item
from g join (select unnest([1, 2, 3]) as i) on i <= event_id % 4
where event_type <> 'error'""",
    "log_repair_text": f"""
with {LOGS} select event_id, mid, ts_ms,
  case when is_new = '1' and row_number() over (partition by mid, is_new order by ts_ms, event_id) > 1 then '0'
       else is_new end as is_new
from g""",
    "parse_lines": """
select event_id, event_type as name, case when event_id % 50 <> 3 then value end as temperature,
       case when event_id % 50 <> 4 then cast(floor(epoch(ts)) as bigint) end as time, event_id % 50 in (3, 4) as dirty
from events""",
    "typed_json": """
select o_orderkey as id, cast(o_totalprice as double) as total_amount, cast(null as varchar) as absent from orders""",
    "order_wide_interval": ORDER_WIDE,
    "order_wide_full": f"with {_FULL} select * from x",
    "payment_wide_full": f"""
with {_FULL}
select o_orderkey as payment_id, order_id, user_id, cast(o_totalprice as double) as total_amount, o_orderpriority as subject, 'card' as payment_type,
  strftime(o_orderdate + to_minutes(o_orderkey % 30), '%Y-%m-%d %H:%M:%S') as callback_time,
  strftime(o_orderdate + to_minutes(o_orderkey % 30), '%Y-%m-%d %H:%M:%S') as payment_create_time,
  create_time as order_create_time, total_amount as order_total_amount,
  x.* exclude (order_id, user_id, total_amount, expire_time, create_time, operate_time, create_date, create_hour)
from x join orders on o_orderkey = order_id where o_orderstatus = 'F' and o_orderkey % 30 <= 15""",
    "order_wide_dims": f"""
with {_WIDE},
u as (select c_custkey, c_custkey % 2 = 0 as f, date '1960-01-01' + cast(c_custkey % 15000 as integer) as b from customer)
select detail_id, order_id, sku_id, p_name as sku_name,
       cast(2021 - year(b) - case when dayofyear(date '2021-11-02') < dayofyear(b) then 1 else 0 end as integer) as user_age,
       case when f then 'F' else 'M' end as user_gender, n_name as province_name,
       cast(n_regionkey as varchar) as province_area_code, 'N' || n_nationkey as province_iso_code,
       r_name as province_3166_2_code, p_partkey % 100 as spu_id, s_name as spu_name,
       cast(split_part(p_brand, '#', 2) as bigint) as tm_id, p_brand as tm_name, cast(p_size as bigint) as category3_id,
       'Size ' || p_size as category3_name, order_price
from w left join u on user_id = c_custkey left join nation on province_id = n_nationkey
left join region on n_regionkey = r_regionkey left join part on sku_id = p_partkey
left join supplier on s_suppkey = p_partkey % 100""",
    "dim_lookup_missing_left": """
select o_orderkey, o_custkey, c_name from orders left join (select * from customer where c_acctbal > 0)
on o_custkey = c_custkey""",
    "dim_lookup_missing_inner": """
select o_orderkey, o_custkey, c_name from orders join (select * from customer where c_acctbal > 0)
on o_custkey = c_custkey""",
    "payment_wide": PAYMENT_WIDE,
    "payment_wide_same_day": _PAYMENT,
    "coalesce_merge": """
select o_orderkey, o_custkey, case when o_orderkey % 2 = 0 then o_orderstatus else lower(o_orderstatus) end as o_orderstatus,
       o_totalprice
from orders""",
    "age_from_birthday": """
select o_orderkey, case when o_orderkey % 11 <> 0 and o_orderdate <= date '2001-03-01' then
  cast(2001 - year(o_orderdate) - case when dayofyear(date '2001-03-01') < dayofyear(o_orderdate) then 1 else 0 end
  as integer) end as age
from orders""",
    "cdc_normalise": f"""with {_CDC} select o_orderkey, 'shop' as database, tab as "table", kind as type, ts, price from c""",
    "cdc_normalise_both": f"""
with {_CDC} select o_orderkey, tab as "table", kind as type,
  cast(case when kind = 'insert' then 0 else 4 end as integer) as before_fields,
  case when kind <> 'delete' then cast(o_custkey as varchar) end as after_custkey from c""",
    "cdc_normalise_after": f"""
with {_CDC} select o_orderkey, tab as "table",
  case kind when 'insert' then 'CREATE' when 'update' then 'UPDATE' else 'DELETE' end as type,
  case when kind <> 'delete' then o_orderstatus end as status from c""",
    "cdc_initial_snapshot": f"""
with {_CDC} select tab as "table", kind as type, cast(o_orderkey as varchar) as key from c
union all select tab, 'read', cast(o_orderkey as varchar) from c""",
    "cdc_route_dim": f"""
with {_ROUTED} select o_orderkey, tag, case tab when 'orders_o' then 'dim_orders_o' else 'dim_orders_f' end as sinkTable,
  case tab when 'orders_o' then o_custkey || '-' || o_orderkey else cast(o_orderkey as varchar) end as pk,
  case tab when 'orders_o' then 'o_orderkey,o_orderstatus' else 'o_custkey,o_orderkey' end as columns
from r where tag = 'dim'""",
    "cdc_route_fact": f"""
with {_ROUTED} select o_orderkey, tag, case tab when 'orders_o' then 'dwd_orders_o' else 'dwd_orders_f' end as sinkTable,
  cast(o_orderkey as varchar) as pk,
  case tab when 'orders_o' then 'o_custkey,o_orderkey' else 'o_orderkey,o_totalprice' end as columns
from r where tag = 'fact'""",
    "cdc_unrouted": f"with {_ROUTED} select o_orderkey, tag from r where tag in ('unrouted', 'bad_key')",
    "config_state": f"with {_CONFIG} select sourceTable, operateType, sinkType, sinkTable from live",
    "config_sink_tables": f"""
with {_CONFIG} select sinkTable, case when sinkTable in (select sinkTable from live where sinkType = 'hbase')
  then 'create' else 'drop' end as action
from (select distinct sinkTable from ch where sinkType = 'hbase' and kind <> 'delete')""",
    "keyed_upsert": KEYED_UPSERT,
    "keyed_upsert_nulls": """
with g as (
  select o_custkey, coalesce(max(o_orderkey) filter (where o_orderkey % 10 = 0), -1) as gone,
         max(o_orderkey) filter (where o_orderkey % 10 <> 0) as put from orders group by o_custkey)
select o.o_custkey, case when o_orderkey % 3 = 0 then o_orderstatus end as status,
       case when o_orderkey % 3 <> 0 then o_totalprice end as price
from orders o join g on g.o_custkey = o.o_custkey and o_orderkey = put where put > gone""",
    "keyed_upsert_same_ts": KEYED_UPSERT.replace("o_orderkey as ver", "year(o_orderdate) * 1000000000000 + o_orderkey as ver"),
    "log_topics_full": f"""
with {LOGS}, r as (
  select event_id, event_type, case when event_id % 101 > 7 then event_id end as action,
    case when is_new = '1' and row_number() over (partition by mid, is_new order by ts_ms, event_id) > 1 then '0' else is_new end as is_new
  from g)
select event_id, case when event_type = 'error' then 'start' else 'page' end as topic, is_new, action, cast(null as bigint) as item from r
union all select event_id, 'display', is_new, null, event_id * 10 + i
from r join (select unnest([1, 2, 3]) as i) on i <= event_id % 4 where event_type <> 'error'
union all select event_id, 'dirty', null, null, null from events where event_id % 101 in (3, 4, 5, 7)""",
    "running_sum": """
select event_id, user_id, cast(sum(cast(round(value * 100) as bigint)) over
  (partition by user_id order by ts, event_id) as bigint) as total from events""",
    "word_count": "select word, count(*) as n from (select unnest(string_split(p_name, ' ')) as word from part) group by word",
    "word_pairs": "select unnest(string_split(p_name, ' ')) as word, cast(1 as integer) as n from part",
    "running_max_by": """
select event_id, user_id, arg_max(event_id, (value, -epoch_us(ts), -event_id)) over k as best_id, max(value) over k as best_value
from events window k as (partition by user_id order by ts, event_id)""",
    "running_reduce_max": """
select event_id, user_id, max(value) over (partition by user_id order by ts, event_id) as top from events""",
    "running_max_field": """
select event_id, user_id, first_value(event_type) over k as first_event_type, max(value) over k as max_value
from events window k as (partition by user_id order by ts, event_id)""",
    "window_count": WINDOW_COUNT,
    "window_min_by": """
select user_id, cast(epoch(cast(ts as date) + interval 1 day) as bigint) as window_end, event_id, value from events
qualify row_number() over (partition by user_id, cast(ts as date) order by value, ts, event_id) = 1""",
    "window_avg_count": """
select user_id, count(value) as n,
  cast(cast(sum(cast(value as decimal(18,2))) / count(value) as decimal(22,6)) as double) as mean,
  cast(epoch(cast(ts as date) + interval 1 day) as bigint) as window_end
from events group by user_id, cast(ts as date)""",
    "sliding_window": _BUCKETED.format(
        end="s + interval 24 hours",
        rows="""select event_type, time_bucket(interval 6 hours, ts) - to_hours(6 * k) as s
                from events cross join (select unnest([0, 1, 2, 3]) as k)""".replace(
            "time_bucket(interval 6 hours, ts)",
            "(time_bucket(interval 6 hours, ts + interval 2 hours) - interval 2 hours)"),
    ),
    "offset_window": _BUCKETED.format(
        end="s + interval 24 hours",
        rows="select event_type, cast(ts + interval 8 hours as date) - interval 8 hours as s from events"),
    "arrival_window": _BUCKETED.format(
        end="s + interval 1 hour", rows="select event_type, date_trunc('hour', ts + interval 5 minutes) as s from events"),
    "session_window": SESSIONS,
    "global_window": """
select user_id, count(*) as n, cast(sum(cast(round(value * 100) as bigint)) as bigint) as total from events group by user_id""",
    "count_window": _COUNT_WINDOW,
    "count_window_full": f"select * from ({_COUNT_WINDOW}) where n = 5",
    "window_all": """
select cast(epoch(cast(ts as date) + interval 1 day) as bigint) as window_end, count(*) as n
from events group by cast(ts as date)""",
    "late_classify": """
with e as (select event_id, ts, event_id // 1000 + case when event_id % 10 = 0 then 1 else 0 end as batch_no from events),
b as (select batch_no, max(ts) as top from e group by batch_no),
m as (select batch_no, max(top) over (order by batch_no rows between unbounded preceding and 1 preceding)
        - interval 12 hours as mark from b),
j as (select event_id, e.batch_no, mark, cast(ts as date) + interval 1 day as w_end from e join m on e.batch_no = m.batch_no)
select event_id, batch_no, case when mark is null or w_end > mark then 'on_time'
  when w_end + interval 24 hours > mark then 'late_accepted' else 'too_late' end as tag
from j""",
    "udtf_split": _SPLIT,
    "udtf_split_sql": _SPLIT,
    "udf_hash": _HASH,
    "udf_hash_sql": _HASH,
    "udf_hash_arrow": _HASH,
    "partition_counts": "select count(*) as n, true as each_task_once from events",
    "udaf_avg": "select user_id, round(avg(value), 6) as mean from events group by user_id",
    "rich_map": "select c_custkey, c_acctbal * 2 as c_acctbal from customer",
    "key_list_lookup": """
select k as lookup_key, n_name from (
  select distinct unnest([cast(s_nationkey as varchar), cast((s_nationkey + 1) % 30 as varchar), '99']) as k from supplier)
left join nation on k = cast(n_nationkey as varchar)""",
    "filter_prefix": "select p_partkey, p_name from part where starts_with(p_name, 'red')",
    "map_length": """
select p_partkey, cast(length(p_name) as integer) as length, cast(length(p_name) as integer) as units from part""",
    "string_functions": """
select p_partkey, cast(len(string_split(p_name, ' ')) as integer) as parts, upper(p_name) as upper_name,
  p_type = 'ECONOMY' as blank, cast(p_size as bigint) as number, split_part(p_brand, '#', 2) as brand_no
from part""",
    "time_functions": """
select event_id, strftime(ts, '%Y-%m-%d') as day, epoch_ms(date_trunc('second', ts)) as ms_utc,
  epoch_ms(date_trunc('second', ts)) - 28800000 as ms_east, strftime(ts + interval 8 hours, '%Y-%m-%d %H:%M:%S') as text_east,
  epoch_ms(date_trunc('day', ts)) as midnight,
  case when event_id % 5 = 0 then 1700000000 else epoch_ms(date_trunc('second', ts)) // 1000 end as event_second
from events""",
    "snake_to_camel": 'select p_partkey as "pPartkey", p_brand as "pBrand", p_retailprice as "pRetailprice" from part',
    "sql_view_select": "select event_id, event_type as name, value as temp from events",
    "redistribute": "select event_type, count(*) as n, cast(sum(event_id) as bigint) as ids from events group by event_type",
    "new_visitor_repair_stream": NEW_VISITOR,
    "daily_unique_visitor_stream": DAILY_UNIQUE,
    "daily_unique_pairs_stream": f"select user_id, day from ({DAILY_UNIQUE})",
    "delta_alert_stream": DELTA_PREVIOUS,
    "bounce_detection_stream": BOUNCE,
    "visitor_stats_stream": VISITOR_STATS,
    "window_count_stream": WINDOW_COUNT,
    "session_window_stream": SESSIONS,
    "order_wide_interval_stream": ORDER_WIDE,
    "payment_wide_stream": PAYMENT_WIDE,
    "keyed_upsert_stream": KEYED_UPSERT,
    "cdc_fan_out_stream": f"""
with {_ROUTED} select o_orderkey, 'dim_orders_o' as target, o_custkey || '-' || o_orderkey as pk
from r where tag = 'dim' and tab = 'orders_o'
union all select o_orderkey, tag, null from r where tag in ('unrouted', 'bad_key')
union all select o_orderkey, case tab when 'orders_o' then 'dwd_orders_o' else 'dwd_orders_f' end, cast(o_orderkey as varchar)
from r where tag = 'fact'""",
    "repair_processor": """
select user_id, count(*) as n, cast(max(case when event_type = 'signup' then 1 else 0 end) as bigint) as claims from events group by user_id""",
    "daily_processor": "select distinct user_id, strftime(ts, '%Y-%m-%d') as day from events",
    "delta_processor": f"select user_id, last_value as last, value as current from ({DELTA_PREVIOUS})",
    "bounce_processor": BOUNCE,
    "log_topics_stream": f"""
with {LOGS}, r as (
  select event_id, event_type, mid, ts_ms, case when event_id % 101 > 7 then event_id end as action,
    case when is_new = '1' and row_number() over (partition by mid, is_new order by ts_ms, event_id) > 1 then '0' else is_new end as is_new
  from g)
select case when event_type = 'error' then 'dwd_start_log' else 'dwd_page_log' end as topic, mid, is_new, ts_ms, action, cast(null as bigint) as item from r
union all select 'dwd_display_log', mid, is_new, ts_ms, null, event_id * 10 + i
from r join (select unnest([1, 2, 3]) as i) on i <= event_id % 4 where event_type <> 'error'
union all select 'dirty_log', null, null, null, null, null from events where event_id % 101 in (3, 4, 5, 7)""",
}
