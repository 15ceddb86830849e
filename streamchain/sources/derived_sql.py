"""DuckDB SQL of the derived logs, as common table expressions."""

_ROWS = """
rows_ as (
  select o_custkey % 8 as stream_id, o_orderkey as height, 0 as block_type, cast(0 as bigint) as shard_id, o_orderdate as ts,
    cast(0 as bigint) as k1, cast(0 as bigint) as k2, cast(0 as double) as k3 from orders
  union all
  select o_custkey % 8, l_orderkey, 1, cast(l_linenumber as bigint), l_shipdate, cast(l_partkey as bigint), cast(l_suppkey as bigint), l_extendedprice
  from lineitem join orders on l_orderkey = o_orderkey
),
heads_ as (
  select o_orderkey as height, md5(cast(o_orderkey as varchar)) as hash,
    coalesce(md5(cast(lag(o_orderkey) over (partition by o_custkey % 8 order by o_orderkey) as varchar)), '') as prev_hash from orders
)"""
_LOG = """{name} as (
  select stream_id, row_number() over (partition by stream_id order by {order}) as seq, height, block_type, shard_id, hash, prev_hash, ts
  from rows_ join heads_ using (height)
)"""
CHAIN = f"{_ROWS}, {_LOG.format(name='chain_log', order='height, block_type, ts, shard_id, k1, k2, k3')}"
NOISY = f"{_ROWS}, {_LOG.format(name='noisy_log', order='ts, height, block_type, shard_id, k1, k2, k3')}"
EVENT = """event_log as (
  select user_id as stream_id, event_id as seq, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as height, event_type = 'error' as corrupted,
    event_type as subject, value, cast(length(props) as bigint) as bytes, ts from events
)"""
DOCS = """doc_log as (select 'docs' as stream_id, doc_id + 1 as seq, concat_ws('.', lang, source) as subject, n_chars as bytes from documents)"""
CONV = """conv_log as (
  select 0 as stream_id, conv_id as height, case when turn = 0 then 0 else 1 end as block_type, turn as shard_id, cast(strlen("text") as bigint) as bytes from conversations
)"""
INPUTS = f"""{CHAIN}, inputs as (
  select *, 'a' as input_id from chain_log where block_type = 0 and height % 3 <> 0
  union all select *, 'b' from chain_log where block_type = 0 and height % 5 <> 0
)"""
REDUNDANT = f"""{CHAIN}, redundant as (
  select * replace (case when height % 7 = 0 and height % 3 = 2 then 'bad' else prev_hash end as prev_hash), 'a' as input_id from chain_log where block_type = 0 and height % 3 <> 0
  union all select *, 'b' from chain_log where block_type = 0 and height % 3 <> 1
)"""
#: Reason of a row against the one before (columns l_height, l_type, l_shard, l_hash), by rules that are on.
REASON = """case
  when l_height is null then 'OK' when height < l_height then 'LowHeight'
  when height > l_height and block_type <> 0 then 'UnannouncedBlock'
  when {gap} and height - l_height > 1 then 'HeightGap'
  when {hash} and height > l_height and prev_hash <> l_hash then 'HashMismatch'
  when height > l_height then 'OK' when block_type = 0 then 'Reannouncement' when block_type <> 1 then 'UnknownBlockType'
  when l_type = 1 and shard_id <= l_shard then 'LowShard'
  when {hash} and hash <> l_hash then 'ShardHashConflict' else 'OK' end"""
LAGGED = """(select *, lag(height) over w as l_height, lag(block_type) over w as l_type, lag(shard_id) over w as l_shard, lag(hash) over w as l_hash
  from {log} window w as (partition by stream_id order by seq))"""
CLASS = """case when {reason} in ('LowHeight', 'Reannouncement', 'LowShard', 'UnwantedShard', 'ShardHashConflict') then 'low'
  when {reason} in ('IncompletePreviousBlock', 'UnannouncedBlock', 'HeightGap', 'HashMismatch', 'ShardGap') then 'high'
  when {reason} in ('FilteredShard', 'UnknownBlockType') then 'irrelevant' else 'ok' end"""
