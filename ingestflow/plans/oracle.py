"""DuckDB SQL for every registered query, written independently of the Spark code.

The test tables are pre-registered views.  The fixture derivations are
repeated here as CTEs; the operators are re-stated in plain SQL (windows with
``row_number`` where the Spark side uses ``min_by``/``max_by``, ``GLOB`` where
it builds a regex), so a match is evidence rather than a tautology.
"""

from __future__ import annotations

import datetime as _dt

from ingestflow import fixtures as fx
from ingestflow.functions.timing import epoch_ms

NOW_SQL = "timestamp '2024-01-31 00:00:00'"
MISSING = "Flow file does not contained configured attribute: "


def _pending_cte(blank: bool = False, name: str = "pending") -> str:
    stamp = "cast(epoch_us(ts) // 1000 as varchar)"
    if blank:
        stamp = (f"case when event_id % 34 = 0 then null when event_id % 17 = 0 then '' "
                 f"else {stamp} end")
    return f"""{name} as (
  select 'r' || event_id as request_id,
    case when props = '{{"k": 0}}' then null else 'pipe_' || ((event_id // 3) % 5) end as pipe,
    case when props = '{{"k": 1}}' then null else 'f_' || (event_id // 3) || '.csv' end as file,
    {stamp} as queued_ms,
    epoch_us(greatest(ts, timestamp '2024-01-11')) // 1000 as lineage_ms,
    event_id as arrival_seq
  from events where event_type = 'view')"""


HISTORY_CTE = """history as (
  select 'pipe_' || ((event_id // 3) % 5) as pipe,
    'f_' || (event_id // 3) || '.csv' as path,
    case event_type when 'purchase' then 'LOADED' when 'signup' then 'PARTIALLY_LOADED'
      when 'error' then 'LOAD_FAILED' else 'LOAD_IN_PROGRESS' end as status,
    case when event_type <> 'click' then event_id % 50 + 10 end as rows_parsed,
    case event_type when 'purchase' then event_id % 50 + 10
      when 'signup' then event_id % 50 + 10 - (event_id % 7 + 1)
      when 'error' then 0 end as rows_loaded,
    case when event_type in ('signup', 'error') then event_id % 7 + 1 end as errors_seen,
    case when event_type in ('signup', 'error') then 'err ' || event_id end as first_error,
    ts as event_ts, event_id as seq
  from events where event_type <> 'view')"""


def _ts(d: _dt.datetime) -> str:
    return f"timestamp '{d.isoformat(sep=' ')}'"


def await_ctes(src: str, now: _dt.datetime, max_age: int, p: str) -> str:
    """CTEs computing the await routing of table ``src`` at ``now`` into ``{p}_out``."""
    now_ms = epoch_ms(now)
    return f"""
{p}_keyed as (select * from {src} where pipe is not null and file is not null),
{p}_lb as (select greatest(1, coalesce(max(({now_ms} - lineage_ms) // 60000), 1)) as mins
  from {p}_keyed),
{p}_win as (select h.* from history h, {p}_lb
  where h.event_ts >= {_ts(now)} - to_minutes({p}_lb.mins) and h.event_ts <= {_ts(now)}
    and h.pipe in (select pipe from {p}_keyed)),
{p}_latest as (select * from (select *, row_number() over (partition by pipe, path
  order by seq desc) as rn from {p}_win) where rn = 1),
{p}_aged as (select s.*, coalesce(queued_ms, '') <> ''
    and not regexp_full_match(queued_ms, '[+-]?[0-9]{{1,18}}') as bad_stamp,
  case when coalesce(queued_ms, '') = '' then 0
       else ({now_ms} - try_cast(queued_ms as bigint)) // 60000 end as age from {src} s),
{p}_first as (select pipe, file, age as first_age from (select pipe, file, age,
  row_number() over (partition by pipe, file order by arrival_seq nulls last) as rn
  from {p}_aged where pipe is not null and file is not null and not bad_stamp) where rn = 1),
{p}_j as (select a.*, f.first_age, l.path is not null as has, l.path as h_path,
    l.status as h_status, l.rows_parsed as h_rows_parsed, l.rows_loaded as h_rows_loaded,
    l.errors_seen as h_errors, l.first_error as h_first_error
  from {p}_aged a left join {p}_first f on a.pipe = f.pipe and a.file = f.file
  left join {p}_latest l on a.pipe = l.pipe and a.file = l.path),
{p}_r as (select *,
  case when bad_stamp then 'load_failure'
       when pipe is null then 'load_failure' when file is null then 'load_failure'
       when has and h_status = 'LOADED' then 'loaded'
       when has and h_status = 'PARTIALLY_LOADED' then 'partially_loaded'
       when has and h_status = 'LOAD_FAILED' then 'load_failure'
       when has then 'waiting'
       when first_age > {max_age} then 'unmatched' else 'waiting' end as route
  from {p}_j),
{p}_out as (select request_id, pipe, file, lineage_ms, arrival_seq, route,
  case when route = 'unmatched' then null
       when bad_stamp then queued_ms
       else coalesce(nullif(queued_ms, ''), '{now_ms}') end as queued_ms,
  coalesce(first_age, age) as age_minutes,
  h_status as status,
  case when bad_stamp then 'invalid queued timestamp'
       when pipe is null then '{MISSING}pipe' when file is null then '{MISSING}file'
       when has and h_status in ('PARTIALLY_LOADED', 'LOAD_FAILED') then h_first_error
  end as error,
  case when has and h_status in ('PARTIALLY_LOADED', 'LOAD_FAILED')
       then cast(h_errors as varchar) end as error_count,
  case when has then '{{' || concat_ws(',', '"path":' || to_json(h_path),
       '"status":' || to_json(h_status), '"rows_parsed":' || h_rows_parsed,
       '"rows_loaded":' || h_rows_loaded, '"errors_seen":' || h_errors,
       '"first_error":' || to_json(h_first_error)) || '}}' end as payload
  from {p}_r)"""


def _await_sql(select: str, blank: bool = False) -> str:
    return (f"with {_pending_cte(blank)},\n{HISTORY_CTE},"
            f"{await_ctes('pending', fx.NOW, fx.MAX_AGE_MINUTES, 'a')}\n{select}")


def _pending_skewed_cte() -> str:
    base = _pending_cte(name="pending0")
    return base + """,
pending as (select request_id,
    case when arrival_seq % 3 = 0 and pipe is not null then 'pipe_0' else pipe end as pipe,
    case when arrival_seq % 3 = 0 and file is not null then 'f_0.csv' else file end as file,
    queued_ms, lineage_ms, arrival_seq from pending0)"""


AWAIT_ROUTES_SKEWED = (f"with {_pending_skewed_cte()},\n{HISTORY_CTE},"
                       f"{await_ctes('pending', fx.NOW, fx.MAX_AGE_MINUTES, 'a')}\n"
                       "select arrival_seq, request_id, pipe, file, route, queued_ms, error, "
                       "error_count, age_minutes, status from a_out")

AWAIT_ROUTES = _await_sql("""select arrival_seq, request_id, pipe, file, route, queued_ms,
  error, error_count, age_minutes, status from a_out""")

ROUTE_COUNTS = _await_sql("select route, count(*) as n from a_out group by route")

QUEUE_STAMP = _await_sql("select arrival_seq, route, queued_ms from a_out", blank=True)

RESULT_PAYLOAD = _await_sql("select arrival_seq, payload from a_out where payload is not null")

QUEUE_AGE = f"""with {_pending_cte(True)}
select arrival_seq, queued_ms,
  case when coalesce(queued_ms, '') = '' then 0
       else ({fx.NOW_MS} - try_cast(queued_ms as bigint)) // 60000 end as age_minutes
from pending"""

LOOKBACK = f"""with {_pending_cte()}
select greatest(1, coalesce(max(({fx.NOW_MS} - lineage_ms) // 60000), 1)) as lookback_minutes
from pending where pipe is not null and file is not null"""

DISTINCT_PIPES = f"""with {_pending_cte()}
select distinct pipe from pending where pipe is not null and file is not null"""

FIRST_WINS_AGE = f"""with {_pending_cte()},
aged as (select *, case when coalesce(queued_ms, '') = '' then 0
  else ({fx.NOW_MS} - try_cast(queued_ms as bigint)) // 60000 end as age,
  row_number() over (partition by pipe, file order by arrival_seq) as rn,
  count(*) over (partition by pipe, file) as n_pending
  from pending where pipe is not null and file is not null)
select pipe, file, n_pending, age as first_age from aged where rn = 1"""

LATEST_PER_FILE = f"""with {HISTORY_CTE}
select pipe, path, status, rows_parsed, rows_loaded, errors_seen, first_error, seq
from (select *, row_number() over (partition by pipe, path order by seq desc) as rn
      from history) where rn = 1"""

HISTORY_FOR_PENDING = f"""with {_pending_cte()},\n{HISTORY_CTE}
select seq, pipe, path, status from history h
where exists (select 1 from pending p where p.pipe = h.pipe and p.file = h.path)"""

HISTORY_FOR_PENDING_SKEWED = f"""with {_pending_cte()},
{HISTORY_CTE.replace("history as (", "history0 as (")},
history as (select case when seq % 3 = 0 then 'pipe_0' else pipe end as pipe,
  case when seq % 3 = 0 then 'f_0.csv' else path end as path, status, seq from history0)
select seq, pipe, path, status from history h
where exists (select 1 from pending p where p.pipe = h.pipe and p.file = h.path)"""

HISTORY_MULTI_PIPE = f"""with {_pending_cte()},\n{HISTORY_CTE},
keyed as (select * from pending where pipe is not null and file is not null),
lb as (select greatest(1, coalesce(max(({fx.NOW_MS} - lineage_ms) // 60000), 1)) as mins
  from keyed)
select seq, pipe, path, status from history, lb
where event_ts between {NOW_SQL} - to_minutes(lb.mins) and {NOW_SQL}
  and pipe in (select pipe from keyed)"""

_TRAIL = abs(fx.REPORT_TRAIL_MINUTES)

PIPE_HISTORY = f"""with {HISTORY_CTE}
select seq, pipe, path, status, errors_seen, first_error from history
where pipe = '{fx.REPORT_PIPE}'
  and event_ts between {NOW_SQL} - to_minutes({_TRAIL}) and {NOW_SQL}"""

HISTORY_DOCUMENT = f"""with {HISTORY_CTE}
select seq, '{{' || concat_ws(',', '"pipe":' || to_json(pipe), '"path":' || to_json(path),
  '"status":' || to_json(status), '"rows_parsed":' || rows_parsed,
  '"rows_loaded":' || rows_loaded, '"errors_seen":' || errors_seen,
  '"first_error":' || to_json(first_error),
  '"event_time":' || to_json(strftime(event_ts, '%Y-%m-%d %H:%M:%S.%g')),
  '"seq":' || seq) || '}}' as json
from history where pipe = '{fx.REPORT_PIPE}'
  and event_ts between {NOW_SQL} - to_minutes({_TRAIL}) and {NOW_SQL}"""

OUTCOME_CTE = """outcome as (
  select cast(o_orderkey as varchar) as request_id, 'pipe_' || (o_custkey % 5) as pipe,
    'f_' || o_orderkey || '.csv' as file,
    case o_orderkey % 10 when 0 then 'backoff' when 7 then 'other'
      when 8 then null when 9 then null else 'response' end as kind,
    case o_orderkey % 10 when 0 then 'slow down' when 1 then 'HTTP Status: 400'
      when 2 then 'HTTP Status: 404' when 3 then 'HTTP Status: 429'
      when 4 then 'HTTP Status: 500' when 5 then 'HTTP Status: 503'
      when 6 then 'connection reset' when 7 then 'boom' end as message
  from orders)"""

_CLASSIFY = """select *,
  case when kind is null then 'success' when kind = 'backoff' then 'retry'
       when kind = 'response' and (code like '%429%' or code like '%500%') then 'retry'
       else 'failure' end as route,
  case when kind is not null then message end as error_message
  from (select *, case when kind is null then '200'
                       when kind = 'response' then coalesce(nullif(
                         regexp_extract(message, '.*HTTP Status: (\\d+)', 1), ''), '0')
                  end as code from {src})"""

SUBMIT_ROUTES = f"""with {OUTCOME_CTE}, c as ({_CLASSIFY.format(src='outcome')})
select request_id, pipe, file, route, code as response_code, error_message from c"""

SUBMIT_TWO_ROUNDS = f"""with {OUTCOME_CTE},
c1 as ({_CLASSIFY.format(src='outcome')}),
outcome2 as (select cast(o_orderkey as varchar) as request_id,
  case when o_orderkey % 2 = 1 then 'backoff' end as kind,
  case when o_orderkey % 2 = 1 then 'slow down again' end as message from orders),
c2 as ({_CLASSIFY.format(src='outcome2')})
select request_id, route, 1 as round, code as response_code, error_message from c1
where route <> 'retry'
union all
select request_id, route, 2 as round, code as response_code, error_message from c2
where request_id in (select request_id from c1 where route = 'retry')"""

SUBMIT_ROUTE_COUNTS = f"""with {OUTCOME_CTE}, c as ({_CLASSIFY.format(src='outcome')})
select route, count(*) as n from c group by route"""

RESPONSE_CODE = """select o_orderkey as id, coalesce(nullif(regexp_extract(
  case o_orderkey % 6 when 0 then 'HTTP Status: ' || (o_orderkey % 200 + 400)
    when 1 then 'x HTTP Status: 429 y HTTP Status: 1500'
    when 2 then 'no status here'
    when 3 then 'first line' || chr(10) || 'HTTP Status: ' || (o_orderkey % 7 + 500) || ' tail'
    when 4 then 'HTTP Status: abc' end,
  '.*HTTP Status: (\\d+)', 1), ''), '0') as response_code
from orders"""

LOAD_REQUESTS = """select event_id,
  'pipe_' || coalesce(json_extract_string(props, '$.k'), '') as pipe,
  'f_' || event_id || '.csv' as file
from events"""

RESOLVE_TEMPLATE = """select event_id, 'f_' || event_id || '.csv' as t1,
  'in/' || coalesce(json_extract_string(props, '$.k'), '') || '/f_' || event_id || '.csv' as t2,
  'x' as t3
from events"""

_SC = ("case c_custkey % 9 when 0 then 'default' when 1 then 'AUTO_DETECT' when 2 then 'GZIP' "
       "when 3 then 'BZ2' when 4 then 'BROTLI' when 5 then 'ZSTD' when 6 then 'DEFLATE' "
       "when 7 then 'RAW_DEFLATE' else 'NONE' end")
_AC = "case c_custkey % 3 when 0 then 'default' when 1 then 'true' else 'false' end"
_PAR = "case c_custkey % 4 when 0 then '4' when 1 then '10' when 2 then '1' else '99' end"

REQUEST_CTE = f"""req as (
  select cast(c_custkey as varchar) as request_id,
    '/home/account/' || lower(c_mktsegment) as input_directory,
    'c_' || c_custkey || '_*.csv' as file_name,
    'database.schema.stage_' || (c_nationkey % 5) as internal_stage,
    {_AC} as auto_compress, {_SC} as source_compression, {_PAR} as parallel
  from customer),
cmd as (select request_id,
  'PUT file://' || input_directory || '/' || file_name || ' @' || internal_stage
  || case when auto_compress <> 'default' then ' AUTO_COMPRESS = ' || auto_compress else '' end
  || case when source_compression <> 'default'
          then ' SOURCE_COMPRESSION = ' || source_compression else '' end
  || case when cast(parallel as int) <> 4 then ' PARALLEL = ' || cast(parallel as int) else '' end
  as stage_command from req)"""

STAGE_COMMAND = f"with {REQUEST_CTE} select request_id, stage_command from cmd"

VALIDATE_REQUESTS = f"""with raw as (
  select cast(c_custkey as varchar) as request_id,
    case when c_custkey % 17 = 0 then '' else '/home/account/' || lower(c_mktsegment) end
      as input_directory,
    case when c_custkey % 23 = 0 then null else 'c_' || c_custkey || '_*.csv' end as file_name,
    'database.schema.stage_' || (c_nationkey % 5) as internal_stage,
    case when c_custkey % 13 = 0 then 'maybe' else {_AC} end as auto_compress,
    case when c_custkey % 19 = 0 then 'LZO' else {_SC} end as source_compression,
    case when c_custkey % 11 = 0 then 'x4' else {_PAR} end as parallel
  from customer),
r as (select request_id, parallel, concat_ws('; ',
    case when coalesce(input_directory, '') = '' then 'input_directory is empty' end,
    case when coalesce(file_name, '') = '' then 'file_name is empty' end,
    case when coalesce(internal_stage, '') = '' then 'internal_stage is empty' end,
    case when auto_compress not in ('true', 'false', 'default')
         then 'auto_compress is not an allowed value' end,
    case when source_compression not in ('AUTO_DETECT', 'GZIP', 'BZ2', 'BROTLI', 'ZSTD',
         'DEFLATE', 'RAW_DEFLATE', 'NONE', 'default')
         then 'source_compression is not an allowed value' end,
    case when parallel is not null and (not regexp_full_match(parallel, '[+-]?[0-9]+')
              or try_cast(parallel as int) is null)
         then 'parallel is not an integer' end) as why
  from raw)
select request_id, nullif(why, '') as invalid_reason,
  coalesce(case when regexp_full_match(parallel, '[+-]?[0-9]+')
                then try_cast(parallel as int) end, 4) as parallel from r"""

FILES_CTE = """files as (select '/src/' || source as dir, 'd' || doc_id || '.txt' as name,
  n_chars as size, md5(text) as md5, doc_id, text from documents)"""

WILDCARD_MATCH = f"""with {FILES_CTE},
dirs as (select distinct dir from files),
pats as (select * from (values (0, 'd1*.txt'), (1, 'd?.txt'), (2, 'd??.txt'), (3, 'none*'),
  (4, 'd1*.txt'), (5, 'absent.txt')) t(n, pattern)),
req as (select dir || '|' || n || '|' || pattern as request_id, dir, pattern from dirs, pats
  union all select dir || '|-1|' || name, dir, name from files)
select r.request_id, r.dir, r.pattern, f.name, f.size
from req r left join files f on f.dir = r.dir and f.name glob r.pattern"""

STAGE_PLAN = f"""with {FILES_CTE},
manifest as (select 'd' || doc_id || '.txt' as target_name,
  case when doc_id % 6 = 0 then md5(text || 'x') else md5(text) end as md5
  from documents where doc_id % 3 = 0)
select '{fx.DOC_STAGE}' as stage, dir, name, size, md5,
  case when exists (select 1 from manifest m where m.target_name = f.name and m.md5 = f.md5)
       then 'SKIPPED' else 'UPLOADED' end as status
from files f"""

REQUEST_ALL_CTE = REQUEST_CTE.replace("""
  from customer),""", """
  from customer
  union all
  select 's' || s_suppkey, '/home/supplier', 's_' || s_suppkey || '_*.csv',
    'database.schema.stage_' || (s_nationkey % 5), 'default', 'NONE', '4' from supplier),""")

RESULTS_CTE = """res as (select cast(o_custkey as varchar) as request_id,
  'c_' || o_custkey || '_' || o_orderkey || '.csv' as source_filename,
  case o_orderstatus when 'F' then 'UPLOADED' when 'P' then 'SKIPPED' else 'FAILED' end as status,
  cast(floor(o_totalprice) as bigint) as source_size, o_orderdate, o_orderkey, o_custkey
  from orders)"""

_STAGE_ROUTES_BODY = f"""with {REQUEST_ALL_CTE}, {RESULTS_CTE},
routed as (
  select r.request_id, r.source_filename, r.status,
    case r.status when 'UPLOADED' then 'uploaded' when 'SKIPPED' then 'skipped'
      else 'failure' end as route, cast(null as varchar) as error
  from res r
  union all
  select c.request_id, null, null, 'failure',
    'No results received from PUT statement: ' || c.stage_command
  from cmd c where not exists (select 1 from res r where r.request_id = c.request_id))"""

STAGE_ROUTES = _STAGE_ROUTES_BODY + "\nselect * from routed"

STAGE_ROUTES_SKEWED = f"""with {REQUEST_ALL_CTE}, {RESULTS_CTE.replace("res as (", "res0 as (")},
res as (select case when o_orderkey % 3 = 0 then '1' else request_id end as request_id,
  source_filename, status from res0),
routed as (
  select r.request_id, r.source_filename, r.status,
    case r.status when 'UPLOADED' then 'uploaded' when 'SKIPPED' then 'skipped'
      else 'failure' end as route, cast(null as varchar) as error, c.stage_command
  from res r left join cmd c on c.request_id = r.request_id
  union all
  select c.request_id, null, null, 'failure',
    'No results received from PUT statement: ' || c.stage_command, c.stage_command
  from cmd c where not exists (select 1 from res r where r.request_id = c.request_id))
select * from routed"""

STAGE_ROUTE_COUNTS = (_STAGE_ROUTES_BODY + "\nselect route, count(*) as n from routed "
                      "group by route")

STAGE_NO_RESULTS = (_STAGE_ROUTES_BODY + "\nselect request_id, route, error from routed "
                    "where source_filename is null")

AUDIT_EVENTS = f"""with {RESULTS_CTE}
select request_id, source_filename,
  case when o_custkey % 4 = 0 then 'jdbc://unknown-host'
       else 'jdbc:warehouse://acct' || (o_custkey % 3) || '.example.com' end as target_url,
  (o_orderkey % 5000) * 7 as transmission_ms,
  ((o_orderkey % 5000) * 7) // 1000 as duration_s
from res"""

LINES_CTE = f"""lines as (select 'part_' || (l_orderkey % 200) || '.csv' as path,
  ((l_partkey % 97 = 0 and l_orderkey % 4 <> 0) or l_orderkey % 40 = 7) as bad,
  l_orderkey || ',' || l_partkey || ',' ||
    case when ((l_partkey % 97 = 0 and l_orderkey % 4 <> 0) or l_orderkey % 40 = 7) then 'bad'
         else cast(cast(l_quantity as int) as varchar) end as value,
  l_orderkey, l_partkey, cast(l_quantity as int) as quantity,
  row_number() over (partition by l_orderkey % 200 order by l_orderkey, l_linenumber,
    l_partkey, l_suppkey, l_extendedprice, l_shipdate) as line_no
  from lineitem)"""


def _load_history_sql(all_or_nothing: bool) -> str:
    partial = "'LOAD_FAILED'" if all_or_nothing else "'PARTIALLY_LOADED'"
    loaded_partial = "0" if all_or_nothing else "n - e"
    return f"""with {LINES_CTE},
s as (select path, count(*) as n, count(*) filter (where bad) as e,
  min(line_no) filter (where bad) as first_bad from lines group by path)
select '{fx.LOAD_PIPE}' as pipe, s.path,
  case when e = 0 then 'LOADED' when n - e = 0 then 'LOAD_FAILED' else {partial} end as status,
  n as rows_parsed, case when e = 0 then n else {loaded_partial} end as rows_loaded,
  e as errors_seen, 'Invalid record: ' || l.value as first_error
from s left join lines l on l.path = s.path and l.line_no = s.first_bad"""


LOAD_HISTORY = _load_history_sql(False)
LOAD_HISTORY_SKIP_FILE = _load_history_sql(True)

LOAD_ROWS = f"""with {LINES_CTE}
select path, l_orderkey as orderkey, l_partkey as partkey, quantity from lines where not bad"""

LOAD_ROWS_SKIP_FILE = f"""with {LINES_CTE}
select path, l_orderkey as orderkey, l_partkey as partkey, quantity from lines
where path not in (select path from lines where bad)"""


JSON_CTE = """jl as (select 'ev_' || (event_id % 50) || '.json' as path, event_id, user_id,
  event_type,
  case when event_id % 50 = 13 then 'array'
       when event_type = 'error' and event_id % 3 = 0 then 'broken'
       when event_type = 'signup' and event_id % 4 = 0 then 'badtype'
       when event_type = 'click' and event_id % 5 = 0 then 'short'
       else 'full' end as shape
  from events),
j as (select path, event_id, shape in ('array', 'broken', 'badtype') as bad,
  case shape when 'array' then '[' || event_id || ']'
    when 'broken' then '{broken ' || event_id
    when 'badtype' then '{"id": "x' || event_id || '", "user": ' || user_id || '}'
    when 'short' then '{"id": ' || event_id || '}'
    else '{"id": ' || event_id || ', "user": ' || user_id || ', "kind": "' || event_type || '"}'
  end as value,
  case when shape in ('short', 'full') then event_id end as id,
  case when shape = 'full' then user_id end as "user",
  case when shape = 'full' then event_type end as kind
  from jl)"""

LOAD_HISTORY_JSON = f"""with {JSON_CTE},
s as (select path, count(*) as n, count(*) filter (where bad) as e,
  arg_min(value, event_id) filter (where bad) as first_bad from j group by path)
select 'database.schema.events_pipe' as pipe, path,
  case when e = 0 then 'LOADED' when n - e = 0 then 'LOAD_FAILED' else 'PARTIALLY_LOADED' end
    as status,
  n as rows_parsed, n - e as rows_loaded, e as errors_seen,
  case when e > 0 then 'Invalid record: ' || first_bad end as first_error
from s"""

LOAD_ROWS_JSON = f"""with {JSON_CTE}
select path, id, "user", kind from j where not bad"""


def _two_rounds() -> str:
    r1 = fx.ROUND1_NOW
    r1_ms = epoch_ms(r1)
    return f"""with {_pending_cte()},\n{HISTORY_CTE},
p1 as (select * from pending where try_cast(queued_ms as bigint) <= {r1_ms}
                                 or try_cast(queued_ms as bigint) is null),
{await_ctes('p1', r1, fx.MAX_AGE_MINUTES, 'x')},
p2 as (select request_id, pipe, file, queued_ms, lineage_ms, arrival_seq from x_out
       where route = 'waiting'
       union all
       select request_id, pipe, file, queued_ms, lineage_ms, arrival_seq from pending
       where try_cast(queued_ms as bigint) > {r1_ms}),
{await_ctes('p2', fx.NOW, fx.MAX_AGE_MINUTES, 'y')}
select arrival_seq, route, 1 as round, queued_ms, error from x_out where route <> 'waiting'
union all
select arrival_seq, route, 2 as round, queued_ms, error from y_out"""


AWAIT_TWO_ROUNDS = _two_rounds()


def _rounds_late() -> str:
    """Two early rounds over the same rows; who arrives later waits."""
    one, two = fx.EARLY_ROUNDS
    ms1, ms2 = epoch_ms(one), epoch_ms(two)
    cols = "request_id, pipe, file, queued_ms, lineage_ms, arrival_seq"
    return f"""with {_pending_cte()},\n{HISTORY_CTE},
p1 as (select * from pending where cast(queued_ms as bigint) <= {ms1}),
{await_ctes('p1', one, fx.MAX_AGE_MINUTES, 'x')},
p2 as (select {cols} from x_out where route = 'waiting'
       union all select {cols} from pending
       where cast(queued_ms as bigint) > {ms1} and cast(queued_ms as bigint) <= {ms2}),
{await_ctes('p2', two, fx.MAX_AGE_MINUTES, 'y')}
select arrival_seq, route, 1 as round, queued_ms, error from x_out where route <> 'waiting'
union all select arrival_seq, route, 2 as round, queued_ms, error from y_out
union all select arrival_seq, 'waiting' as route, 2 as round, queued_ms, null as error
from pending where cast(queued_ms as bigint) > {ms2}"""


_PENDING_BAD = """pending as (
  select 'r' || event_id as request_id, 'pipe_' || ((event_id // 3) % 5) as pipe,
    'f_' || (event_id // 3) || '.csv' as file,
    case when event_id % 5 = 1 then ' ' || (epoch_us(ts) // 1000)
         when event_id % 10 = 6 then 'soon' else cast(epoch_us(ts) // 1000 as varchar) end as queued_ms,
    epoch_us(ts) // 1000 as lineage_ms,
    case when event_id % 7 <> 0 then event_id end as arrival_seq, ts, event_id
  from events)"""

AWAIT_ROUTES_BAD_STAMPS = f"""with {_PENDING_BAD},\n{HISTORY_CTE},
{await_ctes('pending', fx.NOW, fx.MAX_AGE_MINUTES, 'a')}
select request_id, pipe, file, route, queued_ms, error, age_minutes, status from a_out"""

FIRST_WINS_BAD_STAMPS = f"""with {_PENDING_BAD},
good as (select pipe, file, arg_min(({fx.NOW_MS} - epoch_us(ts) // 1000) // 60000,
    coalesce(arrival_seq, 9000000000000000 + event_id)) as first_age
  from pending where event_id % 5 <> 1 and event_id % 10 <> 6 group by pipe, file)
select p.pipe, p.file, p.n as n_pending, g.first_age
from (select pipe, file, count(*) as n from pending group by pipe, file) p
left join good g on g.pipe = p.pipe and g.file = p.file"""

WILDCARD_MATCH_SKEWED = f"""with {FILES_CTE},
req as (select case when doc_id % 11 <> 0 then cast(doc_id % 100 as varchar) end as request_id,
  case when doc_id % 3 = 0 then '/src/src0' else '/src/' || source end as dir,
  case doc_id % 3 when 0 then 'd1?.txt' when 1 then 'absent.txt'
    else 'd' || (doc_id % 10) || '?.txt' end as pattern from documents)
select r.request_id, r.dir, r.pattern, f.name, f.size
from req r left join files f on f.dir = r.dir and f.name glob r.pattern"""

DETECT_COMPRESSION = """with f as (
  select 'p' || page_id as file, page_id as k, encode(substring(html, 1, 16)) as t from pages
  union all select 'd' || doc_id, doc_id, encode(substring(text, 1, 16)) from documents),
s as (select file, k, case k % 5 when 0 then 'AUTO_DETECT' when 1 then 'default' when 2 then 'NONE'
    when 3 then 'BROTLI' else 'GZIP' end as declared,
  case when k % 8 >= 6 then 'NONE'
    else case k % 6 when 0 then 'GZIP' when 1 then 'BZ2' when 2 then 'ZSTD' else 'DEFLATE' end end as sniffed,
  case when k % 4 <> 3 then case k % 3 when 0 then 'default' when 1 then 'true' else 'false' end end as wish
  from f),
c as (select file, wish, case when declared in ('AUTO_DETECT', 'default') then sniffed else declared end
  as source_compression from s)
select file, source_compression,
  case when source_compression = 'NONE' and coalesce(wish, 'default') <> 'false' then 'GZIP'
       else source_compression end as target_compression
from c"""

STAGE_RESULTS_NAMED = f"""with {REQUEST_ALL_CTE}
select cast(o_custkey as varchar) as request_id, 'c_' || o_custkey || '_' || o_orderkey || '.csv' as source_filename,
  'c_' || o_custkey || '_' || o_orderkey || '.csv.gz' as target_filename,
  cast(floor(o_totalprice) as bigint) as source_size, cast(floor(o_totalprice) as bigint) // 3 as target_size,
  'NONE' as source_compression, 'GZIP' as target_compression,
  case o_orderstatus when 'F' then 'UPLOADED' when 'P' then 'SKIPPED' else 'FAILED' end as status,
  'ENCRYPTED' as encryption,
  case when o_orderstatus in ('F', 'P') then ''
       else 'upload failed for c_' || o_custkey || '_' || o_orderkey || '.csv' end as message,
  case o_orderstatus when 'F' then 'uploaded' when 'P' then 'skipped' else 'failure' end as route,
  (o_orderkey % 5000) * 7 as transmission_ms, ((o_orderkey % 5000) * 7) // 1000 as duration_s
from orders
union all
select request_id, null, null, null, null, null, null, null, null, null, 'failure', null, null from req
where request_id not in (select cast(o_custkey as varchar) from orders)"""

STAGE_REQUESTS = """select cast(c_custkey as varchar) as request_id,
  '/home/account/' || lower(c_mktsegment) as input_directory, 'c_' || c_custkey || '_*.csv' as file_name,
  'database.schema.stage_' || c_nationkey as internal_stage,
  case when c_custkey % 2 = 0 then 'true' else 'false' end as auto_compress,
  'default' as source_compression, 9 as parallel, cast(null as varchar) as invalid_reason,
  lower(c_mktsegment) as segment
from customer"""

_CUSTOMER_COMMAND = """'PUT file:///home/account/' || lower(c_mktsegment) || '/c_' || c_custkey
    || '_*.csv @database.schema.stage_' || c_nationkey"""

STAGE_STEP_TABLES = f"""select cast(o_custkey as varchar) as request_id,
  'c_' || o_custkey || '_' || o_orderkey || '.csv' as source_filename,
  case o_orderstatus when 'F' then 'uploaded' when 'P' then 'skipped' else 'failure' end as route,
  case when o_orderstatus not in ('F', 'P') then null when o_custkey % 4 = 0 then 'jdbc://unknown-host'
       else 'jdbc:warehouse://acct' || (o_custkey % 3) || '.example.com' end as target_url,
  case when o_orderstatus in ('F', 'P') then (o_orderkey % 5000) * 7 end as transmission_ms,
  case when o_orderstatus in ('F', 'P') then ((o_orderkey % 5000) * 7) // 1000 end as duration_s,
  cast(c_nationkey as varchar) as nation, {_CUSTOMER_COMMAND} as stage_command
from orders left join customer on c_custkey = o_custkey
union all
select cast(c_custkey as varchar), null, 'failure', null, null, null, cast(c_nationkey as varchar),
  {_CUSTOMER_COMMAND}
from customer where c_custkey not in (select o_custkey from orders)"""

LOAD_HISTORY_RELOAD = f"""with {LINES_CTE},
s as (select path, regexp_extract(path, '[0-9]+')::int % 2 = 0 as mended, count(*) as n,
  count(*) filter (where bad) as e, arg_min(value, line_no) filter (where bad) as first_bad
  from lines group by path)
select '{fx.LOAD_PIPE}' as pipe, path,
  case when mended or e = 0 then 'LOADED' else 'LOAD_FAILED' end as status, n as rows_parsed,
  case when mended or e = 0 then n else 0 end as rows_loaded,
  case when mended then 0 else e end as errors_seen,
  case when not mended and e > 0 then 'Invalid record: ' || first_bad end as first_error, 2 as seq
from s"""

LOAD_HISTORY_MISSING = f"""{LOAD_HISTORY}
union all
select '{fx.LOAD_PIPE}', 'other_' || m || '.csv', case when m % 3 = 0 then 'LOADED' else 'LOAD_FAILED' end,
  0, 0, case when m % 3 = 0 then 0 else 1 end,
  case m % 3 when 1 then 'File cannot be read' when 2 then 'File not found' end
from (select distinct o_orderkey % 30 as m from orders)"""

LOAD_HISTORY_TWO_PIPES = f"""select pipe, status, count(*) as files,
  cast(sum(rows_loaded) as bigint) as rows_loaded, cast(sum(errors_seen) as bigint) as errors_seen
from (select pipe, status, rows_loaded, errors_seen from ({LOAD_HISTORY_SKIP_FILE})
      union all select pipe, status, rows_loaded, errors_seen from ({LOAD_HISTORY_JSON}))
group by pipe, status"""

_PENDING_EXTREME = """pending as (
  select 'r' || event_id as request_id, 'pipe_' || ((event_id // 3) % 5) as pipe,
    'f_' || (event_id // 3) || '.csv' as file,
    case event_id % 11 when 3 then '-9223372036854775808' when 5 then '9223372036854775807'
      else cast(event_id * 60000 as varchar) end as queued_ms,
    case event_id % 13 when 4 then -100000000000000000::hugeint when 6 then -9223372036854775808::hugeint
      when 8 then 9223372036854775807::hugeint else (epoch_us(ts) // 1000)::hugeint end as lineage_ms,
    case when event_id % 7 <> 0 then event_id end as arrival_seq
  from events)"""


def _extreme_sql() -> str:
    """The await rules with ages in 128 bits; those beyond a long are null, the look-back is bounded."""
    def minutes(ms: str) -> str:
        age = f"({fx.NOW_MS}::hugeint - {ms})"
        return (f"case when {age} between -9223372036854775808::hugeint and 9223372036854775807::hugeint "
                f"then cast(trunc({age} / 60000.0::decimal(38, 6)) as bigint) end")

    return f"""with {_PENDING_EXTREME},\n{HISTORY_CTE},
lb as (select least(2147483647, greatest(1, coalesce(max({minutes("lineage_ms")}), 1))) as mins from pending),
latest as (select pipe, path, arg_max(status, seq) as status from history, lb
  where event_ts >= {NOW_SQL} - to_minutes(lb.mins) and event_ts <= {NOW_SQL} group by pipe, path),
aged as (select *, {minutes("queued_ms::hugeint")} as age from pending),
firsts as (select pipe, file, age as first_age from aged
  qualify row_number() over (partition by pipe, file order by arrival_seq nulls last) = 1),
j as (select a.request_id, a.pipe, a.file, a.queued_ms, f.first_age, a.age, l.status
  from aged a join firsts f using (pipe, file) left join latest l on l.pipe = a.pipe and l.path = a.file),
r as (select *, case status when 'LOADED' then 'loaded' when 'PARTIALLY_LOADED' then 'partially_loaded'
    when 'LOAD_FAILED' then 'load_failure' when 'LOAD_IN_PROGRESS' then 'waiting'
    else case when first_age > {fx.MAX_AGE_MINUTES} then 'unmatched' else 'waiting' end end as route from j)
select request_id, pipe, file, route, case when route <> 'unmatched' then queued_ms end as queued_ms,
  coalesce(first_age, age) as age_minutes, status from r"""


SUBMIT_ROUNDS_UNANSWERED = f"""with {OUTCOME_CTE},
c1 as ({_CLASSIFY.format(src='outcome')}),
again as (select cast(o_orderkey as varchar) as request_id, o_orderkey as k,
  case when o_orderkey % 2 = 1 then 'backoff' end as kind,
  case when o_orderkey % 2 = 1 then 'slow down again' end as message from orders),
second as (select request_id, kind, message from again where k % 3 <> 0),
third as (select request_id, kind, message from again where k % 6 = 0),
c2 as ({_CLASSIFY.format(src='second')}),
c3 as ({_CLASSIFY.format(src='third')}),
tried as (select request_id, route, 1 as round, code, error_message from c1
  union all select request_id, route, 2, code, error_message from c2
    where request_id in (select request_id from c1 where route = 'retry')
  union all select request_id, route, 3, code, error_message from c3
    where request_id in (select request_id from c1 where route = 'retry')
      and request_id not in (select request_id from c2 where route <> 'retry'))
select request_id, route, round, code as response_code, error_message from tried
qualify row_number() over (partition by request_id order by route = 'retry',
  case when route = 'retry' then -round else round end) = 1"""

LOAD_PIPES = f"""select pipe, path, status, rows_parsed, rows_loaded, errors_seen, first_error,
  rows_loaded as target_rows from ({LOAD_HISTORY_SKIP_FILE})
union all select pipe, path, status, rows_parsed, rows_loaded, errors_seen, first_error, rows_loaded
from ({LOAD_HISTORY_JSON})"""

FLOW_TWO_BATCHES = f"""select path || '|' || pipe as request_id, pipe,
  case status when 'LOADED' then 'loaded' when 'PARTIALLY_LOADED' then 'partially_loaded'
    else 'load_failure' end as route, status,
  case when status <> 'LOADED' then first_error end as error,
  case when status <> 'LOADED' then cast(errors_seen as varchar) end as error_count,
  case when pipe = '{fx.LOAD_PIPE}' then 0 else 1 end as batch
from (select * from ({LOAD_HISTORY_SKIP_FILE}) union all by name select * from ({LOAD_HISTORY_JSON}))"""

ORACLE: dict[str, str] = {
    "await_routes": AWAIT_ROUTES,
    "route_counts": ROUTE_COUNTS,
    "queue_age": QUEUE_AGE,
    "queue_stamp": QUEUE_STAMP,
    "result_payload": RESULT_PAYLOAD,
    "lookback": LOOKBACK,
    "distinct_pipes": DISTINCT_PIPES,
    "first_wins_age": FIRST_WINS_AGE,
    "latest_per_file": LATEST_PER_FILE,
    "history_for_pending": HISTORY_FOR_PENDING,
    "history_multi_pipe": HISTORY_MULTI_PIPE,
    "pipe_history": PIPE_HISTORY,
    "history_document": HISTORY_DOCUMENT,
    "submit_routes": SUBMIT_ROUTES,
    "submit_two_rounds": SUBMIT_TWO_ROUNDS,
    "response_code": RESPONSE_CODE,
    "load_requests": LOAD_REQUESTS,
    "resolve_template": RESOLVE_TEMPLATE,
    "stage_command": STAGE_COMMAND,
    "validate_requests": VALIDATE_REQUESTS,
    "wildcard_match": WILDCARD_MATCH,
    "stage_plan": STAGE_PLAN,
    "stage_routes": STAGE_ROUTES,
    "stage_no_results": STAGE_NO_RESULTS,
    "audit_events": AUDIT_EVENTS,
    "load_rows": LOAD_ROWS,
    "load_history": LOAD_HISTORY,
    "load_rows_skip_file": LOAD_ROWS_SKIP_FILE,
    "load_history_skip_file": LOAD_HISTORY_SKIP_FILE,
    "await_two_rounds": AWAIT_TWO_ROUNDS,
    "await_routes_skewed": AWAIT_ROUTES_SKEWED,
    "load_history_json": LOAD_HISTORY_JSON,
    "load_rows_json": LOAD_ROWS_JSON,
    "stage_routes_skewed": STAGE_ROUTES_SKEWED,
    "stage_route_counts": STAGE_ROUTE_COUNTS,
    "submit_route_counts": SUBMIT_ROUTE_COUNTS,
    "history_for_pending_skewed": HISTORY_FOR_PENDING_SKEWED,
    "await_routes_bad_stamps": AWAIT_ROUTES_BAD_STAMPS,
    "first_wins_bad_stamps": FIRST_WINS_BAD_STAMPS,
    "await_rounds_late": _rounds_late(),
    "wildcard_match_skewed": WILDCARD_MATCH_SKEWED,
    "detect_compression": DETECT_COMPRESSION,
    "stage_results_named": STAGE_RESULTS_NAMED,
    "stage_requests": STAGE_REQUESTS,
    "stage_step_tables": STAGE_STEP_TABLES,
    "load_history_reload": LOAD_HISTORY_RELOAD,
    "load_history_missing": LOAD_HISTORY_MISSING,
    "load_history_two_pipes": LOAD_HISTORY_TWO_PIPES,
    "await_routes_extreme": _extreme_sql(),
    "submit_rounds_unanswered": SUBMIT_ROUNDS_UNANSWERED,
    "history_store_multi_pipe": HISTORY_MULTI_PIPE,
    "latest_upkeep": LATEST_PER_FILE,
    "load_pipes": LOAD_PIPES,
    "flow_two_batches": FLOW_TWO_BATCHES,
}
