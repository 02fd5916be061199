"""DuckDB side of the contract: the same results in plain SQL, under the same keys."""

from __future__ import annotations


# The result names of the checks and of the gold tables are fixed values.


def rounded(expression: str) -> str:
    """Two places, half away from zero, on the shortest decimal text of a double."""
    return f"cast(round(cast(cast({expression} as varchar) as decimal(38,18)), 2) as double)"


SQL: dict[str, str] = {}

# ---- gold models -------------------------------------------------------------------------------

SQL["top_groups"] = f"""
select l_partkey, l_suppkey, {rounded("total")} as l_extendedprice
from (
  select l_partkey, l_suppkey, sum(l_extendedprice) as total
  from lineitem where l_extendedprice is not null
  group by l_partkey, l_suppkey
  order by total desc, l_partkey nulls first, l_suppkey nulls first limit 10
) z
"""

SQL["top_groups_threshold"] = f"""
select l_orderkey, {rounded("total")} as l_extendedprice
from (
  select l_orderkey, sum(l_extendedprice) as total
  from lineitem where l_extendedprice is not null
  group by l_orderkey order by total desc, l_orderkey nulls first limit 10
) z
"""

SQL["top_n_per_year"] = """
select * from (
  select *, cast(year(o_orderdate) as integer) as release_year,
    cast(row_number() over (
      partition by year(o_orderdate)
      order by o_totalprice desc, o_orderkey nulls first) as integer)
      as rank_in_year
  from orders where o_totalprice is not null
) z where rank_in_year <= 5
"""

SQL["top_lines_per_year"] = """
select * from (
  select *, cast(year(l_shipdate) as integer) as release_year,
    cast(row_number() over (
      partition by year(l_shipdate)
      order by l_extendedprice desc, l_orderkey nulls first, l_linenumber nulls first,
        l_partkey nulls first, l_suppkey nulls first) as integer)
      as rank_in_year
  from lineitem where l_extendedprice is not null
) z where rank_in_year <= 5
"""

SQL["top_n_null_key"] = """
select * from (
  select o_orderkey, nullif(o_orderstatus, 'F') as status, o_totalprice as price,
    cast(row_number() over (
      partition by nullif(o_orderstatus, 'F')
      order by o_totalprice desc, o_orderkey nulls first) as integer) as place
  from orders where o_orderpriority <> '5-LOW' and o_totalprice is not null
) z where place <= 3
"""

SQL["top_n_deep"] = """
select * from (
  select o_orderkey, o_orderstatus, o_totalprice,
    cast(row_number() over (
      partition by o_orderstatus
      order by o_totalprice desc, o_orderkey nulls first) as integer) as place
  from orders where o_totalprice is not null
) z where place <= 2000
"""

SQL["avg_by_group"] = f"""
select event_type, {rounded("avg(value)")} as avg_value from events group by event_type
"""

SQL["avg_null_groups"] = f"""
select nullif(event_type, 'click') as event_type,
  {rounded("avg(case when event_type <> 'view' then value end)")} as avg_value
from events group by nullif(event_type, 'click')
"""

SQL["group_summary"] = f"""
select c_nationkey, {rounded("sum(c_acctbal)")} as total_balance,
  {rounded("avg(c_acctbal)")} as avg_balance
from customer group by c_nationkey
"""

SQL["trends_null_year"] = f"""
select release_year, row_count, {rounded("total")} as total,
  {rounded("total - lag(total) over (partition by release_year is null order by release_year)")} as change
from (
  select cast(case when o_orderpriority <> '5-LOW' then year(o_orderdate) end as integer) as release_year,
    count(*) as row_count, sum(o_totalprice) as total
  from orders group by 1
) z
"""

SQL["rounding_once"] = f"""
select o_orderkey, {rounded("o_orderkey * cast(0.005 as double)")} as at_half,
  {rounded("o_orderkey * cast(0.005 as double) - cast(4e-11 as double)")} as below_half
from orders
"""

SQL["yearly_trends"] = f"""
select release_year, row_count, {rounded("total")} as total,
  {rounded("total - lag(total) over (partition by release_year is null order by release_year)")} as change
from (
  select cast(year(o_orderdate) as integer) as release_year, count(*) as row_count,
    sum(o_totalprice) as total
  from orders group by year(o_orderdate)
) z
"""

SQL["top_customers"] = f"""
select o_custkey, {rounded("total")} as o_totalprice
from (
  select o_custkey, sum(o_totalprice) as total from orders
  where o_totalprice is not null
  group by o_custkey order by total desc, o_custkey nulls first limit 10
) z
"""

# Quantities are whole numbers, so these sums of integers are exact.
SQL["exact_sums"] = """
select l_returnflag, sum(cast(l_quantity as bigint)) / cast(1073741824 as double) as total
from lineitem group by l_returnflag
"""

SQL["exact_summary"] = f"""
select l_linestatus, cast(sum(cast(l_quantity as bigint)) as double) as quantity,
  {rounded("sum(cast(l_quantity as bigint)) / cast(count(l_quantity) as double)")} as avg_quantity
from lineitem group by l_linestatus
"""

# ---- columns and refinement --------------------------------------------------------------------

SQL["clean_names"] = """
select c_custkey as customer_key, c_name as name_full, c_nationkey as nation_key,
  c_acctbal as "balance_total_%", c_mktsegment as "mkt._segment"
from customer
"""

SQL["clean_names_keep_case"] = """
select c_custkey as "Customer_Key", c_name as "Name_Full", c_nationkey as "Nation_Key",
  c_acctbal as "Balance_Total_%", c_mktsegment as "Mkt._Segment"
from customer
"""

SQL["drop_and_stamp"] = """
select doc_id, lang, date '2024-01-02' as silver_transform_time from documents
"""

SQL["dedup"] = "select distinct text, lang, n_chars from documents"

SQL["dedup_earliest"] = """
select text, lang, n_chars, min(doc_id) as doc_id from documents group by text, lang, n_chars
"""

SQL["dedup_earliest_pair"] = """
select o_custkey, o_orderstatus, o_orderpriority, o_orderdate, o_orderkey
from (
  select *, row_number() over (
    partition by o_custkey, o_orderstatus, o_orderpriority
    order by o_orderdate, o_orderkey) as rn
  from orders
) z where rn = 1
"""

SQL["dedup_wide"] = SQL["dedup"]

SQL["dedup_wide_earliest"] = SQL["dedup_earliest_pair"]

SQL["dedup_across_batches"] = """
select distinct text, lang, ingestion_time
from (
  select text, lang, 1 as ingestion_time from documents
  union all
  select text, lang, 2 as ingestion_time from documents
) z
"""

SQL["conform"] = """
select o_orderkey, case when o_orderstatus = 'F' then o_totalprice end as price,
  try_cast(split_part(o_orderpriority, '-', 1) as integer) as priority
from orders
"""

SQL["conform_rescue"] = """
select o_orderkey, case when o_orderstatus = 'F' then o_totalprice end as price,
  try_cast(split_part(o_orderpriority, '-', 1) as integer) as priority,
  case when o_orderstatus = 'O' then '{"price":"' || o_orderpriority || '"}' end as rescued
from orders
"""

SQL["conform_lossy"] = """
select o_orderkey,
  case when o_orderkey % 3 <> 0 then cast(o_orderkey as integer) end as n,
  case when o_orderkey % 5 <> 0 then cast(o_orderkey as double) end as d,
  case when o_orderkey % 7 <> 0 then cast(o_orderdate as date) end as day,
  case when coalesce(lost_n, lost_d, lost_day) is not null
    then '{' || concat_ws(',', lost_n, lost_d, lost_day) || '}' end as rescued
from (
  select o_orderkey, o_orderdate,
    case when o_orderkey % 3 = 0 then '"n":"' || o_orderkey || '.5"' end as lost_n,
    case when o_orderkey % 5 = 0 then '"d":"' || o_orderkey || '.125"' end as lost_d,
    case when o_orderkey % 7 = 0 then '"day":"' || strftime(o_orderdate, '%Y-%m-%d') || ' 10:11:12"' end as lost_day
  from orders
) z
"""

SQL["normalize_text"] = r"""
select doc_id, lower(nullif(trim(regexp_replace(text, '\s+', ' ', 'g')), '')) as text, lang
from documents
"""

SQL["blank_to_null"] = """
select n_nationkey, case when n_regionkey <> 0 then n_name end as name from nation
"""

SQL["require_not_null"] = """
select c_custkey, c_mktsegment as segment, c_acctbal from customer
where c_mktsegment <> 'BUILDING' and c_acctbal is not null
"""

# ---- quality checks ----------------------------------------------------------------------------

SQL["row_counts"] = """
select (select count(*) from orders) as orders_rows,
  (select count(*) from customer) as customer_rows,
  (select count(*) from lineitem) as lineitem_rows,
  (select count(*) from events) as events_rows,
  (select count(*) from documents) as documents_rows
"""

SQL["null_counts"] = """
select (select count(*) from orders where nullif(o_orderstatus, 'F') is null) as null_status,
  (select count(*) from orders where o_totalprice is null) as null_price,
  (select count(*) from events where value is null) as null_value
"""

SQL["distinct_counts"] = """
select (select count(distinct o_custkey) from orders) as customers_with_orders,
  (select count(distinct o_orderpriority) from orders) as priorities,
  (select count(distinct C_CUSTKEY) from customer) as customers
"""

SQL["expect_drop"] = """
select event_id, event_type, value from events
where value < 100 and event_type <> 'view' and event_type <> 'click'
"""

SQL["expect_counts"] = """
select count(*) as row_count,
  count(*) filter (where not coalesce(value < 100, false)) as small_value,
  count(*) filter (where not coalesce(nullif(event_type, 'view') <> 'click', false)) as known_type
from events
"""

SQL["expect_quarantine"] = """
select distinct * from (
  select event_id, ts, user_id, event_type, value, props,
    concat_ws(',', case when not coalesce(value < 100, false) then 'small_value' end,
      case when not coalesce(nullif(event_type, 'view') <> 'click', false) then 'known_type' end) as violated
  from events
) z
"""
SQL["expect_quarantine"] = f"select event_id, violated from ({SQL['expect_quarantine']}) y"

SQL["expect_streamed_counts"] = """
select count(*) as row_count,
  count(*) filter (where not coalesce(value < 100, false)) as small_value,
  count(*) filter (where not coalesce(nullif(event_type, 'view') <> 'click', false)) as known_type
from (select distinct * from events) z
"""

SQL["newest"] = "select * from events order by ts desc limit 20"

# ---- splitting ---------------------------------------------------------------------------------

SQL["row_index"] = """
select o_orderkey, o_orderstatus, o_totalprice,
  row_number() over (order by o_orderstatus desc, o_orderkey nulls first) - 1 as row_index
from orders
"""

SQL["chunks"] = """
select o_orderkey, o_custkey,
  cast(least(row_index // size, 4) + 1 as integer) as chunk
from (
  select o_orderkey, o_custkey, row_number() over (order by o_orderkey nulls first) - 1 as row_index,
    (select count(*) // 5 from orders) as size
  from orders
) z
"""

SQL["chunks_hot_key"] = """
select cast(least(row_index // size, 6) + 1 as integer) as chunk, count(*) as row_count,
  min(o_orderstatus) as first_status, max(o_orderstatus) as last_status
from (
  select o_orderstatus, row_number() over (order by o_orderstatus nulls first) - 1 as row_index,
    (select count(*) // 7 from orders) as size
  from orders
) z
group by 1
"""

SQL["chunks_scan_order"] = """
select cast(least(row_index // size, 6) + 1 as integer) as chunk, count(*) as row_count
from (
  select row_number() over (order by l_orderkey) - 1 as row_index,
    (select count(*) // 7 from lineitem) as size
  from lineitem
) z
group by 1
"""

SQL["write_chunks"] = """
select event_id, event_type, value, props,
  cast(least(row_index // size, 4) + 1 as integer) as chunk
from (
  select event_id, event_type, value, props,
    row_number() over (order by event_id nulls first) - 1 as row_index,
    (select count(*) // 5 from events) as size
  from events
) z
"""

# ---- sources, sinks and streams ----------------------------------------------------------------

_EVENTS = """
select event_id, ts, user_id, event_type, value as value_units, props from events
"""

SQL["ingest_incremental"] = _EVENTS

SQL["silver_streaming"] = """
select distinct event_id, ts, user_id, event_type, value as value_units, props, true as earliest from events
"""

SQL["silver_streaming_late"] = """
select distinct event_id, ts, user_id, event_type, value as value_units, props,
  case event_id % 4 when 0 then timestamp '2024-01-02' when 1 then timestamp '2024-01-03'
    when 2 then timestamp '2024-01-01' else timestamp '2024-01-04' end as ingestion_time
from events
"""

SQL["ingest_json"] = """
select event_id, event_type as kind, value,
  case when event_id % 3 = 0 then '{"_unknown_fields":"{\\"Label\\":\\"new\\"}"}' end as _rescued_data
from events
"""

SQL["ingest_inferred"] = """
select distinct event_id,
  case when event_id <= floor((select max(event_id) from events) * 11 / 12) then floor(value) else value end as amount
from events
"""

SQL["ingest_header_drift"] = """
select event_id, ts, user_id, event_type,
  case when event_id % 4 <> 3 then value end as value_units, case when event_id % 4 <> 3 then props end as props,
  case when event_id % 4 = 2 and event_type is not null
    then '{"_unknown_fields":"{\\"label_new\\":\\"' || event_type || '\\"}"}' end as _rescued_data
from events
"""

SQL["ingest_schema_growth"] = """
select distinct event_id, case when event_id % 4 <> 1 then value end as value_units,
  case when event_id % 4 <> 0 then event_type end as event_type,
  case when event_id % 4 > 1 then event_id + 0.5::double end as score
from events
"""

SQL["ingest_lineage"] = """
select count(*) as rows_with_file, count(*) as rows_with_time, cast(1 as bigint) as batches,
  cast(0 as bigint) as rescued
from events
"""

SQL["csv_inferred"] = "select * from customer"

_BALANCES = """
select c_nationkey, {measure} as balance from customer group by c_nationkey
"""

SQL["refresh_table"] = _BALANCES.format(measure=rounded("sum(c_acctbal)"))

SQL["write_once"] = _BALANCES.format(measure=rounded("avg(c_acctbal)"))

SQL["publish_snapshots"] = f"""
select * from ({_BALANCES.format(measure=rounded("sum(c_acctbal)"))}) b where c_nationkey > 4
"""

SQL["catalog_tables"] = """
select (select 2 * count(*) from orders) as bronze_rows,
  (select count(*) from (select distinct * from orders) z) as silver_rows,
  (select 2 * count(*) from orders where o_custkey is null) as null_customers,
  (select count(distinct o_custkey) from orders) as distinct_customers
"""

_RELEASES = """
releases as (
  select distinct 'country ' || l_linestatus as country, 'artist ' || l_suppkey as artist,
    'album ' || l_partkey as album, 'genre ' || l_returnflag as genre,
    cast(year(l_shipdate) as integer) as release_year, l_extendedprice as total_streams,
    l_quantity as streams_30d, l_tax as duration, l_discount as skip_rate
  from lineitem
)
"""

_TOP_ARTISTS = """
top_artists as (
  select artist, sum(total_streams) as total from releases
  where total_streams is not null
  group by artist order by total desc, artist nulls first limit 10
)
"""

SQL["gold_tables"] = f"""
with {_RELEASES}, {_TOP_ARTISTS}
select 'avg_duration_by_genre' as model, genre as key, {rounded("avg(duration)")} as value
from releases group by genre
union all
select 'genre_country_platform', country, {rounded("sum(streams_30d)")}
from releases group by country
union all
select 'yearly_stream_trends', cast(release_year as varchar), {rounded("sum(total_streams)")}
from releases group by release_year
union all
select 'top_artists', artist, {rounded("total")} from top_artists
"""

SQL["gold_incremental"] = SQL["gold_tables"]

SQL["checks_incremental"] = """
select count(*) as rows, count(*) - count(event_type) as null_event_type, count(*) - count(user_id) as null_user_id,
  true as within_bound
from events
"""

SQL["checks_across_layers"] = f"""
with {_RELEASES}, {_TOP_ARTISTS},
years as (select release_year, count(*) as n from releases group by release_year),
ranked as (
  select release_year, count(*) as n from releases
  where total_streams is not null group by release_year
)
select 'bronze_rows' as "check", (select count(*) from lineitem) as value
union all
select 'silver_rows', (select count(*) from releases)
union all
select 'gold_rows_yearly_stream_trends', (select count(*) from years)
union all
select 'gold_rows_top_songs_per_year', (select cast(sum(least(n, 5)) as bigint) from ranked)
union all
select 'gold_rows_top_artists', (select count(*) from top_artists)
union all
select 'null_artists_bronze', (select count(*) from lineitem where l_suppkey is null)
union all
select 'null_streams_silver', (select count(*) from releases where streams_30d is null)
union all
select 'distinct_artists_silver', (select count(distinct artist) from releases)
union all
select 'distinct_artists_gold', (select count(distinct artist) from top_artists)
"""
