"""Independent SQL formulations of the registered queries (one statement each)."""

from __future__ import annotations

from .views import DAY, FRESH, HOUR, STALE

EV = "ev as (select *, cast(json_extract(props, '$.k') as bigint) as k from events)"

GRID = """grid as (
  select user_id % 16 as x, user_id // 16 as y,
         row_number() over (partition by user_id order by event_id) - 1 as time_step,
         ts, value as temperature from events)"""

DIFFS = f"""{GRID},
lagged as (select *, lag(temperature) over w as prev_value, lag(time_step) over w as prev_step
           from grid window w as (partition by x, y order by time_step)),
diffs as (select *, temperature - prev_value as diff from lagged where prev_value is not null)"""

TIME_WINDOWS = f"""{GRID},
placed as (
  select *, unnest(range((epoch_us(ts) // 1000000 - 360000) // 36000 + 1, epoch_us(ts) // 1000000 // 36000 + 1)) as w
  from grid),
wins as (
  select x, y, w, min(ts) as window_start, max(ts) as window_end, min(time_step) as window_start_step,
         max(time_step) as window_end_step, arg_max(temperature, time_step) - arg_min(temperature, time_step) as temp_diff
  from placed group by x, y, w)"""

READINGS = """readings as (
  select event_id as seq, ts, user_id as device_id,
         case event_type when 'view' then 'temperature' when 'click' then 'humidity'
                         when 'error' then 'wind' when 'purchase' then 'airQuality' else event_type end as sensor_type,
         value
  from events),
config(sensor_type, low, high, size, slide) as (
  values ('temperature', -50.0, 100.0, 10, 5), ('humidity', 0.0, 100.0, 15, 5),
         ('wind', 0.0, 200.0, 20, 10), ('airQuality', 0.0, 500.0, 30, 10)),
flagged as (
  select r.*, coalesce(value < low or value > high, false) as is_anomaly
  from readings r left join config c on r.sensor_type = c.sensor_type)"""


def _positions(extra_reset: str = "false") -> str:
    return f"""{READINGS},
marked as (
  select f.*, {extra_reset} as is_command from flagged f where sensor_type in (select sensor_type from config)),
epochs as (
  select *, coalesce(sum(case when is_anomaly or is_command then 1 else 0 end) over (
              partition by sensor_type order by seq rows between unbounded preceding and 1 preceding), 0) as epoch
  from marked),
positions as (
  select *, row_number() over (partition by sensor_type, epoch order by seq) as position from epochs
  where not is_command)"""


def _count_windows(columns: str, positions: str | None = None) -> str:
    return f"""{positions or _positions()},
joined as (select p.*, c.size, least(c.slide, c.size) as step from positions p join config c using (sensor_type)),
spread as (
  select *, unnest(range(greatest(0, cast(ceil((position - size) / step) as bigint)), (position - 1) // step + 1)) as window_no
  from joined),
windows as (
  select sensor_type, cast(epoch as bigint) as epoch, window_no, size, {columns}
  from spread group by sensor_type, epoch, window_no, size having count(*) = size)"""


def _reports(root_rank: bool = False) -> str:
    rank = "case when k < 3 then 128 else 256 + k * 5 end" if root_rank else "256 + k * 5"
    us = 1_000_000
    return f"""{EV},
rep as (
  select event_id, epoch_us(ts) as t, user_id + 2 as node_id, k, k % 4 as seq,
         case when k % 7 = 0 then null
              else greatest(1, case when k % 10 = 0 then (user_id + 2) // 2 else (user_id + 2) // 3 end) end as raw_parent,
         case when user_id % 2 = 0 then 'MRHOF' else 'OF0' end as objective_function,
         {rank} as rank
  from ev),
gaps as (
  select *, lag(t) over w as pt, lead(t) over w as nt, lag(seq) over w as pseq
  from rep window w as (partition by node_id order by event_id)),
sessions as (
  select *, sum(case when pt is null or t - pt > {STALE * us} then 1 else 0 end)
              over (partition by node_id order by event_id) as sid from gaps),
kept as (
  select *, last_value(raw_parent ignore nulls) over (
              partition by node_id, sid order by event_id rows between unbounded preceding and current row) as parent_id
  from sessions),
cand as (
  select event_id, node_id, k,
         unnest([greatest(1, node_id // 3), node_id * 3, node_id * 3 + 1, node_id * 3 + 2, node_id + 1, node_id - 1]) as nb,
         unnest([0, 1, 2, 3, 4, 5]) as j
  from rep),
heard as (
  select event_id, node_id, nb, j,
         case when j = 2 and k % 3 = 0 then 160 + k
              when j < 4 then 128 + ((k * 7 + j * 13) % 60) * 8
              when j = 5 then k * 2 end as raw
  from cand where nb between 1 and (select max(node_id) from rep) and (k + j) % 5 <> 0),
nbr as (
  select event_id, node_id, nb, greatest(1e-6, case when arg_max(coalesce(raw, -1), j) > 0
                                                    then arg_max(coalesce(raw, -1), j) / 128.0 else 1.0 end) as cost
  from heard group by event_id, node_id, nb),
deg as (select r.event_id, count(nb) as degree from rep r left join nbr n using (event_id) group by r.event_id)"""


def _states(every: int = DAY, root_rank: bool = False) -> str:
    us = 1_000_000
    return f"""{_reports(root_rank)},
ticks as (
  select unnest(range(min(t) // {every * us}, (max(t) + {STALE * us}) // {every * us} + 1)) * {every} as tick from rep),
vis as (
  select tick, k.*, d.degree, tick * {us} - t as age
  from kept k join deg d using (event_id)
  join ticks on tick * {us} >= t and tick * {us} <= t + {STALE * us} and (nt is null or tick * {us} < nt)),
st as (
  select tick, node_id, parent_id, rank, seq, objective_function, event_id, degree, age, t from vis
  union all
  select distinct tick, 1, null, null, null, null, null, 0, 0, null from vis),
tree as (select tick, node_id as child, parent_id as parent from st where parent_id is not null and parent_id <> node_id),
listing as (select tick, v.node_id as lister, n.nb as listed, n.cost, v.age from vis v join nbr n using (event_id))"""


ANY_EDGES = """edges as (
  select tick, least(lister, listed) as a, greatest(lister, listed) as b, avg(cost) as cost
  from listing where lister <> listed group by all)"""

MUTUAL_EDGES = f"""edges as (
  select x.tick, least(x.lister, x.listed) as a, greatest(x.lister, x.listed) as b,
         avg(coalesce((x.cost + y.cost) / 2, x.cost)) as cost
  from listing x left join listing y
    on x.tick = y.tick and x.lister = y.listed and x.listed = y.lister
  where x.age <= {FRESH * 1_000_000}
    and (x.listed = 1 or (y.lister is not null and y.age <= {FRESH * 1_000_000}))
  group by all)"""

DEPTHS = """reach as (
  select tick, node_id, 0 as depth from st where node_id = 1
  union all
  select t.tick, t.child, r.depth + 1 from reach r join tree t on t.tick = r.tick and t.parent = r.node_id)"""


def _all_pairs(links: str, keyed: str, weight: str) -> str:
    """Cheapest distance of every reachable ordered pair by repeated relaxation."""
    return f"""both_ways as (
  select tick, a, b, {weight} as w from {links} union all select tick, b, a, {weight} from {links}),
{keyed}(tick, src, node, dist) using key (tick, src, node) as (
  select distinct tick, a, a, cast(0 as double) from both_ways
  union
  select d.tick, d.src, e.b, min(d.dist + e.w)
  from {keyed} d join both_ways e on e.tick = d.tick and e.a = d.node
  left join recurring.{keyed} k on k.tick = d.tick and k.src = d.src and k.node = e.b
  where k.dist is null or d.dist + e.w < k.dist
  group by d.tick, d.src, e.b)"""


TREE_PAIRS = _all_pairs("(select tick, least(child, parent) as a, greatest(child, parent) as b from tree group by all)",
                        "tdist", "1.0")


def _instant(every: int = DAY) -> str:
    return f"""{_states(every)},
{ANY_EDGES},
{DEPTHS},
{TREE_PAIRS},
depth as (
  select tick, avg(depth) as depth_avg, min(depth) as depth_min, max(depth) as depth_max
  from reach where node_id <> 1 group by tick),
paths as (
  select tick, max(dist) as diameter, avg(dist) as avg_path_len from tdist where src <> node group by tick),
nodes as (
  select tick, count(*) as node_count, count(case when parent_id <> node_id then 1 end) as tree_edge_count,
         avg(case when node_id <> 1 then degree end) as neighbor_avg,
         min(case when node_id <> 1 then degree end) as neighbor_min,
         max(case when node_id <> 1 then degree end) as neighbor_max,
         arg_max(objective_function, event_id) as objective_function, arg_max(seq, event_id) as round_seq
  from st group by tick),
links as (select tick, count(*) as undirected_edge_count from edges group by tick),
inst as (
  select 'mesh' as network, n.tick, cast(1 as bigint) as root_id, coalesce(depth_avg, 0) as depth_avg, depth_min, depth_max,
         node_count, coalesce(undirected_edge_count, 0) as undirected_edge_count, tree_edge_count,
         neighbor_avg, neighbor_min, neighbor_max, objective_function, round_seq,
         cast(coalesce(diameter, 0) as bigint) as diameter, coalesce(avg_path_len, 0) as avg_path_len
  from nodes n left join depth using (tick) left join paths using (tick) left join links using (tick)),
means as (
  select *, avg(diameter) over w as diameter_avg, avg(depth_avg) over w as depth_avg_over_time,
         avg(neighbor_avg) over w as neighbor_avg_over_time, avg(avg_path_len) over w as avg_path_len_over_time,
         count(*) over w as samples
  from inst window w as (order by tick rows between unbounded preceding and current row))"""


def statement(ctes: str, select: str, recursive: bool = False) -> str:
    return f"with {'recursive ' if recursive else ''}{ctes}\n{select}"


def _result(column: str) -> str:
    return f"select sensor_type, epoch, window_no, size, round({column}, 6) as result from windows"


STATEMENTS: dict[str, str] = {}


def _add(name: str, ctes: str, select: str, recursive: bool = False) -> None:
    STATEMENTS[name] = statement(ctes, select, recursive)


_add("q1_consecutive_diff", DIFFS,
     """select x, y, round(min(diff), 6) as min_temp_diff, round(max(diff), 6) as max_temp_diff,
               round(avg(diff), 6) as avg_temp_diff from diffs group by x, y""")
_add("q2_time_window", TIME_WINDOWS,
     "select x, y, window_start, window_end, window_start_step, window_end_step, round(temp_diff, 6) as temp_diff from wins")
_add("q3_max_window_diff", TIME_WINDOWS,
     "select x, y, round(max(temp_diff), 6) as max_temperature_diff from wins group by x, y")
_add("step_convergence", f"""{DIFFS},
changes as (select prev_step as time_step, max(abs(diff)) as max_change from diffs group by prev_step)""",
     """select time_step, round(max_change, 6) as max_change, max_change < 50 as is_below,
               (select min(time_step) from changes where max_change < 50) as first_step from changes""")
_add("stencil_residual", GRID,
     """select c.x, c.y, c.time_step, round(c.temperature + 0.1 * (
                 coalesce(w.temperature, 0) + coalesce(e.temperature, 0) + coalesce(n.temperature, 0)
                 + coalesce(o.temperature, 0) - 4 * c.temperature), 6) as expected,
               nx.temperature as observed,
               round(nx.temperature - (c.temperature + 0.1 * (
                 coalesce(w.temperature, 0) + coalesce(e.temperature, 0) + coalesce(n.temperature, 0)
                 + coalesce(o.temperature, 0) - 4 * c.temperature)), 6) as residual
        from grid c join grid nx on nx.x = c.x and nx.y = c.y and nx.time_step = c.time_step + 1
        left join grid w on w.time_step = c.time_step and w.x = c.x - 1 and w.y = c.y
        left join grid e on e.time_step = c.time_step and e.x = c.x + 1 and e.y = c.y
        left join grid n on n.time_step = c.time_step and n.x = c.x and n.y = c.y - 1
        left join grid o on o.time_step = c.time_step and o.x = c.x and o.y = c.y + 1""")

_add("sensor_parse_quarantine", READINGS,
     """select seq, sensor_type, case when seq % 17 = 0 then null else value end as value, seq % 17 = 0 as is_malformed
        from readings""")
_add("sensor_range_flags", READINGS, "select seq, sensor_type, value, is_anomaly from flagged")
_add("unknown_sensor_reject", READINGS,
     "select seq, device_id, sensor_type, value from readings where sensor_type not in (select sensor_type from config)")
_add("sample_reroute", f"""{READINGS},
digests as (select seq, value, md5(concat('0:', cast(seq as varchar))) as h from readings)""",
     """select seq, value, target_type, concat(target_type, '-data') as topic from (
          select seq, value, (['temperature', 'humidity', 'wind', 'airQuality'])[
                   cast(1 + cast(concat('0x', substr(h, 9, 8)) as bigint) % 4 as int)] as target_type
          from digests where cast(concat('0x', substr(h, 1, 8)) as bigint) % 1000 < 100)""")
for _name, _expr in (("avg", "avg(value)"), ("sum", "sum(value)"), ("min", "min(value)"), ("max", "max(value)")):
    _add(f"count_window_{_name}", _count_windows(f"{_expr} as r"), _result("r"))
_add("reset_epochs", _positions(), "select seq, sensor_type, is_anomaly, cast(epoch as bigint) as epoch, position from positions")
STATEMENTS["reset_epochs_cut"] = STATEMENTS["reset_epochs"]
_add("manual_flush_windows", _count_windows("avg(value) as r", _positions("seq % 97 = 0")), _result("r"))
_MESSAGE = """printf('{ "%s_average": %f}', sensor_type, r)"""
_TYPED = """printf('{ average %s: %f}', case sensor_type when 'wind' then 'wind speed' when 'airQuality' then 'Air quiality'
                                    else sensor_type end, r)"""
_add("window_message_format", _count_windows("avg(value) as r"),
     f"select sensor_type, epoch, window_no, {_MESSAGE} as message, {_TYPED} as typed_message from windows")
_add("output_topic_rows", _count_windows("avg(value) as r"),
     f"""select 'output' as topic, 'output' as "key", {_TYPED} as "value",
                concat(sensor_type, '/', epoch, '/', window_no) as id from windows""")
_add("next_topic_routing", _count_windows("avg(value) as r"),
     """select topic, count(*) as messages, count(distinct "key") as keys from (
          select case when r > 50 then 'high-' else 'low-' end || sensor_type as topic,
                 concat(sensor_type, ':', epoch) as "key" from windows) group by topic""")

_ADDRESS = "format('fe80::{:x}:{:x}:{:x}:{:x}', xor(node_id, 512), node_id, node_id, node_id)"
_add("node_id_from_addr", _reports(),
     f"""select node_id, {_ADDRESS} as address, count(*) as reports from rep group by node_id""")
_add("root_addresses", _reports(),
     f"""select "offset", dodag_id,
                case when regexp_matches(dodag_id, '::[0-9a-f]+:1:1:1$', 'i') then dodag_id else 'fe80::201:1:1:1' end as root_address
         from (select event_id as "offset",
                      case k % 4 when 0 then 'fd00::201:1:1:1' when 1 then upper(format('fd00::{{:x}}:1:1:1', k))
                                 when 2 then replace({_ADDRESS}, 'fe80', 'fd00') end as dodag_id from rep)""")
_add("link_local_from_lladdr", _reports(),
     f"""select node_id, repeat(lpad(format('{{:x}}', node_id), 4, '0'), 4) as lladdr,
                regexp_replace({_ADDRESS}, '^fe80::0:', 'fe80::') as link_local, count(*) as reports
         from rep group by node_id""")
_add("link_cost", _reports(), "select event_id as \"offset\", node_id, nb as neighbor, round(cost, 6) as cost from nbr")
_add("symmetric_cost", f"{_states()},\n{ANY_EDGES}", "select 'mesh' as network, tick, a, b, round(cost, 6) as cost from edges")
_add("dag_rank", _reports(root_rank=True),
     "select event_id as \"offset\", node_id, rank, rank // 128 as dag_rank, rank // 128 <= 1 as is_root from rep")
_add("objective_names", _reports(),
     """select event_id as "offset", k % 4 as code,
               case k % 4 when 0 then 'OF0' when 1 then 'MRHOF' else 'Unknown' end as name from rep""")
_add("latest_report", _reports(),
     """select 'mesh' as network, node_id, event_id as "offset", seq, parent_id, degree, objective_function
        from kept join deg using (event_id)
        qualify row_number() over (partition by node_id order by event_id desc) = 1""")
_add("state_as_of_tick", _states(),
     """select 'mesh' as network, tick, node_id, event_id as "offset", parent_id, degree, age,
               node_id = 1 as is_root from st""")
_add("state_as_of_instants", f"""{_reports()},
instants as (select min(t) as tick_t from rep group by t // {HOUR * 1_000_000})""",
     """select 'mesh' as network, tick_t, node_id, event_id as "offset", tick_t - t as age
        from kept join instants on tick_t >= t and (nt is null or tick_t < nt) and tick_t <= t + 172800000000""")
_add("message_degree_means", f"""{_reports()},
msgs as (select event_id as msg, t as tick_t from rep),
at_msg as (
  select msg, tick_t, count(*) as visible, sum(degree) as degrees
  from kept join deg using (event_id)
  join msgs on tick_t >= t and (nt is null or tick_t < nt) and tick_t <= t + 172800000000
  group by msg, tick_t)""",
     """select 'mesh' as network, msg as "offset", visible, round(degrees / visible, 6) as neighbor_avg,
               round(avg(degrees / visible) over (order by msg rows between unbounded preceding and current row), 6)
                 as neighbor_avg_over_time from at_msg""")
_add("message_metrics", f"""{_reports()},
vis as (
  select m.event_id as tick, k.node_id, k.parent_id, k.event_id, d.degree
  from kept k join deg d using (event_id)
  join rep m on m.t >= k.t and (k.nt is null or m.t < k.nt) and m.t <= k.t + {STALE * 1_000_000}),
st as (select tick, node_id, parent_id from vis union all select event_id, 1, null from rep),
tree as (select tick, node_id as child, parent_id as parent from vis where parent_id is not null and parent_id <> node_id),
up as (
  select tick, child as node, parent as above, child as branch, 1 as hops from tree
  union all
  select u.tick, u.node, t.parent, u.above, u.hops + 1 from up u join tree t on t.tick = u.tick and t.child = u.above),
{DEPTHS},
depth as (
  select tick, avg(depth) as depth_avg, min(depth) as depth_min, max(depth) as depth_max from reach where node_id <> 1 group by tick),
sizes as (select tick, above as node, count(*) + 1 as size from up group by tick, above),
tops as (
  select u.tick, u.node, max_by(u.above, u.hops) as top, max(u.hops) as hops from up u group by u.tick, u.node),
cuts as (
  select p.tick, sum(coalesce(s.size, 1) * (c.size - coalesce(s.size, 1))) as total
  from tops p left join sizes s on s.tick = p.tick and s.node = p.node join sizes c on c.tick = p.tick and c.node = p.top group by p.tick),
pairs as (
  select tick, sum(size * (size - 1) / 2) as pairs from sizes
  where not exists (select 1 from tree t where t.tick = sizes.tick and t.child = sizes.node) group by tick),
branches as (select tick, above, branch, max(hops) as height from up group by tick, above, branch),
bends as (
  select tick, above, height + coalesce(lead(height) over (partition by tick, above order by height desc), 0) as bend from branches),
paths as (select tick, max(bend) as diameter from bends group by tick),
nodes as (
  select tick, count(*) + 1 as node_count, count(case when parent_id <> node_id then 1 end) as tree_edge_count,
         avg(degree) as neighbor_avg, min(degree) as neighbor_min, max(degree) as neighbor_max from vis group by tick),
links as (
  select tick, count(distinct (least(v.node_id, n.nb), greatest(v.node_id, n.nb))) as undirected_edge_count
  from vis v join nbr n using (event_id) where v.node_id <> n.nb group by tick),
inst as (
  select 'mesh' as network, r.event_id as "offset", cast(null as varchar) as dag_id, r.objective_function, cast(1 as bigint) as root_id,
         node_count, coalesce(undirected_edge_count, 0) as undirected_edge_count, tree_edge_count,
         coalesce(depth_avg, 0) as depth_avg, depth_min, depth_max, cast(coalesce(diameter, 0) as bigint) as diameter,
         coalesce(total / pairs, 0) as avg_path_len, neighbor_avg, neighbor_min, neighbor_max, r.seq as round_seq
  from rep r join nodes n on n.tick = r.event_id left join depth d on d.tick = r.event_id left join links l on l.tick = r.event_id
  left join paths p on p.tick = r.event_id left join cuts c on c.tick = r.event_id left join pairs q on q.tick = r.event_id)""",
     """select network, "offset", dag_id, objective_function, root_id, node_count, undirected_edge_count, tree_edge_count,
               round(depth_avg, 6) as depth_avg, depth_min, depth_max, diameter, round(avg_path_len, 6) as avg_path_len,
               round(neighbor_avg, 6) as neighbor_avg, neighbor_min, neighbor_max, round_seq,
               count(*) over w as samples, round(avg(diameter) over w, 6) as diameter_avg, round(avg(depth_avg) over w, 6) as depth_avg_over_time,
               round(avg(neighbor_avg) over w, 6) as neighbor_avg_over_time, round(avg(avg_path_len) over w, 6) as avg_path_len_over_time
        from inst window w as (order by "offset" rows between unbounded preceding and current row)""", True)
_add("sticky_parent", _reports(),
     """select event_id as "offset", node_id, parent_id, (pt is null or t - pt > 172800000000) as session_start from kept""")
_KEPT = {
    "parent_id": "raw_parent",
    "ipv6": "case when k % 6 = 0 then format('fe80::{:x}:{:x}:{:x}:{:x}', xor(node_id, 512), node_id, node_id, node_id) end",
    "objective_function": "case when k % 5 <> 0 then objective_function end",
    "dodag_id": "case when k % 4 <> 0 then concat('fd00::', k % 3) end",
    "dodag_version": "case when k % 2 = 0 then k % 9 end",
    "rank": "case when k % 3 <> 1 then rank end",
    "dag_rank": "case when k % 3 <> 2 then rank // 128 end",
}
_add("kept_fields", _reports(),
     "select event_id as \"offset\", node_id, " + ", ".join(f"last_value({e} ignore nulls) over w as {c}" for c, e in _KEPT.items())
     + """, (pt is null or t - pt > 172800000000) as session_start from sessions
        window w as (partition by node_id, sid order by event_id rows between unbounded preceding and current row)""")
_add("neighbor_sets", _reports(),
     """select event_id as "offset", node_id, degree, coalesce(ids, '') as neighbors
        from rep join deg using (event_id) left join (
          select event_id, string_agg(cast(nb as varchar), ',' order by nb) as ids from nbr group by event_id) using (event_id)""")
_add("neighbor_table_merge", f"""{EV},
rep as (select event_id, user_id + 2 as node_id, k,
               greatest(1, case when k % 10 = 0 then (user_id + 2) // 2 else (user_id + 2) // 3 end) as parent from ev),
cand as (
  select event_id, node_id, k, parent,
         unnest([greatest(1, node_id // 3), node_id * 3, node_id * 3 + 1, node_id * 3 + 2, node_id + 1, node_id - 1]) as nb,
         unnest([0, 1, 2, 3, 4, 5]) as j
  from rep),
entries as (
  select *, format('{{:x}}:{{:x}}:{{:x}}:{{:x}}', xor(nb, 512), nb, nb, nb) as tail from cand
  where nb between 1 and (select max(node_id) from rep) and not (j = 5 and node_id = 2)),
routing as (
  select event_id, node_id, case when (k + j) % 11 = 0 then 'fd00::' else 'fe80::' end || tail as addr,
         (k * 7 + j * 13) % 120 as age, 128 + k + j as rank, 128 + (k * 3 + j) % 64 as link_metric, j <= 1 as is_parent,
         nb = parent as is_preferred, j = 4 as is_default_route
  from entries where (k + j) % 3 <> 0),
cache as (
  select event_id, node_id, 'fe80::' || tail as addr, (k * 5 + j * 29) % 120 as age,
         repeat(lpad(format('{{:x}}', nb), 4, '0'), 4) as lladdr
  from entries where (k + j) % 4 <> 0)""",
     """select r.event_id, r.node_id, r.addr, c.lladdr, r.rank, r.rank // 128 as dag_rank, r.link_metric, r.is_parent, r.is_preferred
        from routing r left join cache c on c.event_id = r.event_id and c.addr = r.addr
        where (r.addr like 'fe80:%' or c.lladdr is not null) and (r.age <= 60 or r.is_preferred or r.is_default_route)
        union all
        select c.event_id, c.node_id, c.addr, c.lladdr, null, null, null, false, false from cache c
        where c.age <= 60 and not exists (select 1 from routing r where r.event_id = c.event_id and r.addr = c.addr)""")

_add("wireless_edges_any", f"{_states()},\n{ANY_EDGES}", "select 'mesh' as network, tick, a, b from edges")
_add("wireless_edges_mutual", f"{_states()},\n{MUTUAL_EDGES}",
     "select 'mesh' as network, tick, a, b, round(cost, 6) as cost from edges")
_add("edge_list_undirected", f"{_states()},\n{ANY_EDGES}",
     """select 'mesh' as network, tick, least(cast(a as varchar), cast(b as varchar)) as src,
               greatest(cast(a as varchar), cast(b as varchar)) as dst from edges""")
_add("tree_edges", _states(), "select 'mesh' as network, tick, child, parent from tree")
_add("node_depths", f"{_states()},\n{DEPTHS}", "select 'mesh' as network, tick, node_id, depth from reach", True)
_add("root_choice", _states(root_rank=True),
     """select 'mesh' as network, tick, max(node_id) as root_id from st where node_id = 1 or rank // 128 <= 1 group by tick""")
_add("hop_diameter_apl", f"{_states()},\n{MUTUAL_EDGES},\n{_all_pairs('edges', 'hops', '1.0')}",
     """select 'mesh' as network, tick, cast(max(dist) as bigint) as diameter, round(avg(dist), 6) as avg_path_len
        from hops where src <> node group by tick""", True)
_add("tree_diameter_apl", f"{_states()},\n{TREE_PAIRS}",
     """select 'mesh' as network, tick, cast(max(dist) as bigint) as diameter, round(avg(dist), 6) as avg_path_len
        from tdist where src <> node group by tick""", True)
_add("weighted_diameter_apl", f"{_states()},\n{MUTUAL_EDGES},\n{_all_pairs('edges', 'costs', 'cost')}",
     """select 'mesh' as network, tick, round(max(dist), 6) as diameter_weighted, round(avg(dist), 6) as avg_path_len_weighted
        from costs where src <> node group by tick""", True)
_add("node_table", _states(),
     """select 'mesh' as network, tick, node_id, node_id = 1 as is_root, rank // 128 as dag_rank, rank, parent_id,
               coalesce(ids, '') as neighbors, degree as neighbor_count
        from st left join (
          select event_id, string_agg(cast(nb as varchar), ',' order by nb) as ids from nbr group by event_id) using (event_id)""")
_add("depth_stats", f"{_states()},\n{DEPTHS}",
     """select 'mesh' as network, tick, cast(1 as bigint) as root_id,
               round(coalesce(avg(case when node_id <> 1 then depth end), 0), 6) as depth_avg,
               min(case when node_id <> 1 then depth end) as depth_min, max(case when node_id <> 1 then depth end) as depth_max
        from reach group by tick""", True)
_add("degree_stats", _states(HOUR),
     """select 'mesh' as network, tick, round(coalesce(avg(degree), 0), 6) as neighbor_avg, min(degree) as neighbor_min,
               max(degree) as neighbor_max from vis group by tick""")
_add("network_counts", f"{_states()},\n{ANY_EDGES}",
     """select 'mesh' as network, tick, node_count, coalesce(n, 0) as undirected_edge_count, tree_edge_count from (
          select tick, count(*) as node_count, count(case when parent_id <> node_id then 1 end) as tree_edge_count
          from st group by tick) left join (select tick, count(*) as n from edges group by tick) using (tick)""")
_add("degree_midrange", _reports(),
     """select 'mesh' as network, node_id, count(*) as samples, min(degree) as min_neighbors, max(degree) as max_neighbors,
               (min(degree) + max(degree)) / 2 as avg_neighbors
        from gaps join deg using (event_id) where pt is null or seq is distinct from pseq group by node_id""")
_add("degree_mean", _states(),
     """select 'mesh' as network, node_id, count(*) as samples, round(avg(degree), 6) as avg_neighbors,
               min(degree) as min_neighbors, max(degree) as max_neighbors from vis group by node_id""")
_INSTANT = """network, tick, root_id, round(depth_avg, 6) as depth_avg, depth_min, depth_max, node_count, undirected_edge_count,
  tree_edge_count, round(neighbor_avg, 6) as neighbor_avg, neighbor_min, neighbor_max, objective_function, round_seq, diameter,
  round(avg_path_len, 6) as avg_path_len"""
_add("instant_metrics", _instant(), f"select {_INSTANT} from inst", True)
_add("running_means", _instant(),
     """select network, tick, samples, round(diameter_avg, 6) as diameter_avg, round(depth_avg_over_time, 6) as depth_avg_over_time,
               round(neighbor_avg_over_time, 6) as neighbor_avg_over_time,
               round(avg_path_len_over_time, 6) as avg_path_len_over_time from means""", True)
_add("last_500", _states(HOUR),
     """select 'mesh' as network, tick, round(avg(degree), 6) as neighbor_avg, min(degree) as neighbor_min,
               max(degree) as neighbor_max from vis group by tick
        qualify row_number() over (order by tick desc) <= 500""")
_add("metrics_by_objective", _instant(),
     "select objective_function, count(*) as samples, " + ", ".join(
         f"round(avg({m}), 6) as {m}_mean, round(min({m}), 6) as {m}_low, round(max({m}), 6) as {m}_high"
         for m in ("diameter", "depth_avg", "neighbor_avg", "avg_path_len")) + " from inst group by objective_function", True)
_add("metric_series_long", _instant(),
     " union all ".join(
         f"select network, tick, '{label}' as metric, round(cast({m} as double), 6) as instant, round({mean}, 6) as avg from means"
         for label, m, mean in (("diameter", "diameter", "diameter_avg"), ("depth_avg", "depth_avg", "depth_avg_over_time"),
                                ("neighbor_avg", "neighbor_avg", "neighbor_avg_over_time"),
                                ("apl", "avg_path_len", "avg_path_len_over_time"))), True)
_add("topology_table", _states(),
     """select 'mesh' as network, tick, node_id as Node, coalesce(cast(parent_id as varchar), '') as Parent,
               coalesce(ids, '') as Neighbors
        from vis left join (
          select event_id, string_agg(cast(nb as varchar), ',' order by nb) as ids from nbr group by event_id) using (event_id)""")
_add("per_node_table", f"""{_states()},
hist as (
  select node_id, min(degree) as lo, max(degree) as hi from gaps join deg using (event_id)
  where pt is null or seq is distinct from pseq group by node_id)""",
     """select 'mesh' as network, tick, node_id as Node, round((lo + hi) / 2, 2) as avg_neigh, lo as min_neigh, hi as max_neigh
        from vis join hist using (node_id)""")
_add("general_table", _instant(),
     """select network, tick, objective_function, diameter, round(diameter_avg, 3) as diameter_avg,
               round(depth_avg_over_time, 3) as depth_avg, depth_min, depth_max
        from means where tick = (select max(tick) from means)""", True)
_add("network_summary", _instant(),
     """select network, tick, node_count as nodes, diameter, round(depth_avg, 3) as depth_avg,
               round(neighbor_avg, 3) as neighbor_avg, objective_function as "of", root_id as root from inst""", True)


# --- streams give the batch result -----------
for _stream, _batch in (("stream_count_windows", "count_window_avg"), ("stream_trigger_windows", "count_window_avg"),
                        ("stream_flush_windows", "manual_flush_windows")):
    STATEMENTS[_stream] = STATEMENTS[_batch]
_add("stream_time_windows", f"""{READINGS},
placed as (
  select *, unnest(range((epoch_us(ts) // 1000000 - 360000) // 36000 + 1, epoch_us(ts) // 1000000 // 36000 + 1)) as w
  from readings)""",
     """select sensor_type, min(seq) as window_start_step, max(seq) as window_end_step,
               round(arg_max(value, seq) - arg_min(value, seq), 6) as temp_diff
        from placed group by sensor_type, w""")
for _n in (1, 2, 3):
    _query = {1: "q1_consecutive_diff", 2: "q2_time_window", 3: "q3_max_window_diff"}[_n]
    STATEMENTS[f"q{_n}_sorted_csv"] = f"{STATEMENTS[_query]} order by all"
STATEMENTS["q1_first_rows"] = f"{STATEMENTS['q1_consecutive_diff']} order by x, y limit 20"
_add("stream_network_state", _states(),
     """select 'mesh' as network, tick, node_id, event_id as "offset", parent_id, degree, age from vis""")
_add("stream_network_metrics", _instant(),
     """select network, tick, node_count, undirected_edge_count, tree_edge_count, diameter, round(depth_avg, 6) as depth_avg,
               round(neighbor_avg, 6) as neighbor_avg, round(avg_path_len, 6) as avg_path_len
        from inst""", True)
_add("grid_csv_snapshots", GRID, "select x, y, time_step, time_step as seconds, temperature from grid")
_add("report_json_source", _reports(),
     """select event_id, node_id, seq, objective_function, rank, coalesce(n, 0) as listed
        from rep left join (select event_id, count(*) as n from heard group by event_id) using (event_id)
        where event_id % 19 <> 0""")
_add("report_json_quarantine", _reports(),
     "select count(*) as broken, cast(40 as bigint) as longest from rep where event_id % 19 = 0")
_add("reset_states", f"""{EV},
rep as (
  select event_id, epoch_us(ts) as t, user_id + 2 as node_id, k,
         case when k % 7 = 0 then null
              else greatest(1, case when k % 10 = 0 then (user_id + 2) // 2 else (user_id + 2) // 3 end) end as raw_parent,
         cast(sum(case when event_id % 997 = 996 then 1 else 0 end) over (order by event_id) as bigint) as epoch
  from ev),
gaps as (
  select *, lag(t) over (partition by epoch, node_id order by event_id) as pt from rep where event_id % 997 <> 996),
sessions as (
  select *, sum(case when pt is null or t - pt > 172800000000 then 1 else 0 end)
              over (partition by epoch, node_id order by event_id) as sid from gaps)""",
     """select event_id as "offset", node_id, epoch, last_value(raw_parent ignore nulls) over (
                 partition by epoch, node_id, sid order by event_id rows between unbounded preceding and current row) as parent_id,
               (pt is null or t - pt > 172800000000) as session_start from sessions""")
STATEMENTS["stream_network_resets"] = STATEMENTS["reset_states"]
STATEMENTS["output_reader_once"] = STATEMENTS["output_topic_rows"]
_NO_FIGURES = "null::double as avg_neigh, null::bigint as min_neigh, null::bigint as max_neigh"
_NO_GENERAL = """null::varchar as objective_function, null::bigint as diameter, null::double as diameter_avg, null::double as depth_avg,
               null::bigint as depth_min, null::bigint as depth_max"""
_add("stream_result_tables", _instant(),
     f"""select 'topology' as result_table, 'mesh' as network, tick, node_id as Node, coalesce(cast(parent_id as varchar), '') as Parent,
               coalesce(ids, '') as Neighbors, {_NO_FIGURES}, {_NO_GENERAL}
        from vis left join (
          select event_id, string_agg(cast(nb as varchar), ',' order by nb) as ids from nbr group by event_id) using (event_id)
        where tick = (select max(tick) from vis)
        union all
        select 'nodes', 'mesh', tick, node_id, null, null, degree::double, degree, degree, {_NO_GENERAL}
        from vis where tick = (select max(tick) from vis)
        union all
        select 'general', network, tick, null, null, null, {_NO_FIGURES}, objective_function, diameter, round(diameter_avg, 3),
               round(depth_avg_over_time, 3), depth_min, depth_max
        from means where tick = (select max(tick) from means)""", True)
