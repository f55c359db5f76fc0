"""The registered queries as SQL for DuckDB, over the same tables; names as in tracklake.queries.

Each text begins with the CTEs of the event adapter it needs. Doubles are rounded as the queries round them.
"""

from __future__ import annotations

H = 3_600_000_000
T0 = 1704067200000000

POINTS = f"""
e0 as (
  select event_id, epoch_us(ts) as t, user_id as vehicle_id, cast(round(value * 100) as bigint) as cents,
         cast(json_extract_string(props, '$.k') as integer) as k, event_type
  from events),
e1 as (
  select *, case when t - lag(t) over (partition by vehicle_id order by t, event_id) > {12 * H} then 1 else 0 end as brk from e0),
points as (
  select event_id, t, vehicle_id, cast(vehicle_id * 1000 + sum(brk) over w as bigint) as fragment_id,
         case when vehicle_id % 2 = 0 then 1 else -1 end as direction, vehicle_id % 4 as compute_node_id,
         cast((case when vehicle_id % 2 = 0 then 1 else -1 end) * sum(cents) over w as bigint) as x_cents,
         cast(k * 72 as double) / 100 as y, cast((event_id * 37) % 100 as double) / 100 as conf,
         15.0::double + vehicle_id % 5 as length, 6.0::double + (vehicle_id % 3) * 0.5::double as width
  from e1 window w as (partition by vehicle_id order by t, event_id rows unbounded preceding)),
ho as (select *, cast(t - {T0} as double) / {H} as th, cast(x_cents as double) / 100 as x from points)"""

FRAGMENTS = """
fragments as (
  select fragment_id, any_value(vehicle_id) as vehicle_id, any_value(direction) as direction, any_value(compute_node_id) as compute_node_id,
         any_value(length) as length, any_value(width) as width, min(t) as first_t, max(t) as last_t, count(*) as n,
         arg_min(x_cents, t) as starting_x, arg_max(x_cents, t) as ending_x
  from points group by fragment_id)"""

P = f"with recursive {POINTS},{FRAGMENTS}"

SLOTS = f""",
gridm as (select fragment_id, cast(floor(t / {2.0 * H}) as bigint) as slot, avg(cast(x_cents as double)) as x, avg(y) as y from points group by all),
slots as (select g.*, f.direction, f.length, f.width from gridm g join fragments f using (fragment_id))"""

SNAP = """,
snap as (
  select slot, fragment_id, direction, x + direction * length * 0.5 as cx, y as cy, length as l, width as w,
         direction * coalesce(lead(x) over v - x, x - lag(x) over v) / coalesce(lead(slot) over v - slot, slot - lag(slot) over v) as v
  from {src} window v as (partition by fragment_id order by slot))"""

ROAD = SLOTS + """,
road as (select fragment_id, slot, x / 100 as x, y, direction, length, width from slots)""" + SNAP.format(src="road")

CROWD = SLOTS + """,
ring as (select fragment_id, slot, cast((cast(round(x) as bigint) % 200000 + 200000) % 200000 as double) / 100 as x, y, direction, length, width from slots)""" + SNAP.format(src="ring") + """,
sp as (
  select a.slot, a.direction, a.fragment_id as a_fragment_id, b.fragment_id as b_fragment_id,
         a.cx as acx, a.cy as acy, a.l as al, a.w as aw, b.cx as bcx, b.cy as bcy, b.l as bl, b.w as bw
  from snap a join snap b on a.slot = b.slot and a.direction = b.direction and a.fragment_id < b.fragment_id),
touching as (
  select * from sp
  where not (acx - al / 2 > bcx + bl / 2 or acy + aw / 2 < bcy - bw / 2 or acx + al / 2 < bcx - bl / 2 or acy - aw / 2 > bcy + bw / 2)),
seconds as (select a_fragment_id, b_fragment_id, cast(count(*) as double) as seconds from touching group by all),
each as (
  select a_fragment_id as id, b_fragment_id as other, seconds from seconds
  union all select b_fragment_id, a_fragment_id, seconds from seconds)"""

SCORES = CROWD + """,
d1 as (
  select fragment_id, event_id, th as t, x, y, direction,
         lead(x) over v - x as dx, (lead(x) over v - x) / nullif(lead(th) over v - th, 0) as vx, (lead(y) over v - y) / nullif(lead(th) over v - th, 0) as vy,
         (lead(x, 2) over v - 2 * lead(x) over v + x) / nullif((lead(th) over v - th) * (lead(th) over v - th), 0) as a
  from ho window v as (partition by fragment_id order by th, event_id)),
d2 as (select *, atan2(abs(vy), abs(vx)) * (180 / 3.14::double) as theta from d1),
d3 as (
  select fragment_id, least(1.0, abs(arg_max(x, t) - arg_min(x, t)) / 2000.0::double) as distance,
         1 - count(*) filter (dx * direction < 0) / nullif(count(dx), 0)::double as backward,
         1 - count(*) filter (theta >= 30) / nullif(count(theta), 0)::double as rotation,
         1 - count(*) filter (abs(a) > 10) / nullif(count(a), 0)::double as acceleration,
         max(t) - min(t) as duration
  from d2 group by fragment_id),
scores as (
  select d3.*, 1 - coalesce(m.s, 0) / nullif(duration, 0) as conflict
  from d3 left join (select id, max(seconds) as s from each group by id) m on m.id = d3.fragment_id),
flags as (
  select *, tol = 1 and coalesce(backward, 1) = 1 and coalesce(rotation, 1) = 1 and coalesce(acceleration, 1) = 1 and coalesce(conflict, 1) = 1 as all_feasible,
         tol * coalesce(backward, 1) * coalesce(rotation, 1) * coalesce(acceleration, 1) * coalesce(conflict, 1) as score
  from (select *, case when distance >= 0.8 then 1.0 else distance end as tol from scores) s)"""

MERGE = f""",
mp as (
  select a.fragment_id as a_fragment_id, b.fragment_id as b_fragment_id
  from (select *, least(starting_x, ending_x) - case when direction = 1 then 0 else length * 100 end as lo,
               greatest(starting_x, ending_x) + case when direction = 1 then length * 100 else 0 end as hi from fragments) a
  join (select *, least(starting_x, ending_x) - case when direction = 1 then 0 else length * 100 end as lo,
               greatest(starting_x, ending_x) + case when direction = 1 then length * 100 else 0 end as hi from fragments) b
    on a.direction = b.direction and a.fragment_id < b.fragment_id
  where a.last_t > b.first_t and b.last_t > a.first_t and a.lo <= b.hi and b.lo <= a.hi)"""

SHARED = SLOTS + MERGE + """,
shared as (
  select a_fragment_id, b_fragment_id, a.slot, a.x / 100 as ax, b.x / 100 as bx, a.y as ay, b.y as "by", a.length as al, b.length as bl, a.width as aw, b.width as bw,
         count(*) over (partition by a_fragment_id, b_fragment_id) as shared, row_number() over (partition by a_fragment_id, b_fragment_id order by a.slot) as place
  from mp join slots a on a.fragment_id = a_fragment_id join slots b on b.fragment_id = b_fragment_id and a.slot = b.slot),
costs as (
  select a_fragment_id, b_fragment_id,
         (sum((ax - bx) * (ax - bx)) / ((avg(al) + avg(bl)) / 2) + sum((ay - "by") * (ay - "by")) / ((avg(aw) + avg(bw)) / 2)) / 8 / (count(*) + 1)
         + ln((avg(al) + avg(bl)) / 2 * ((avg(aw) + avg(bw)) / 2) / sqrt(avg(al) * avg(aw) * avg(bl) * avg(bw))) / 2 as cost
  from shared where place < shared group by all)"""

COMPONENTS = """,
links as (
  select a.fragment_id as a, b.fragment_id as b from fragments a join fragments b
    on a.direction = b.direction and a.fragment_id <> b.fragment_id and a.last_t > b.first_t and b.last_t > a.first_t and abs(a.starting_x - b.starting_x) < 2000),
reach as (select fragment_id as a, fragment_id as b from fragments union select r.a, l.b from reach r join links l on r.b = l.a),
comps as (select a as fragment_id, min(b) as component from reach group by a)"""

LINES = """,
cen as (select *, th - max(th) over (partition by fragment_id) as c, row_number() over (partition by fragment_id order by t, event_id) / cast(count(*) over (partition by fragment_id) as double) as w from ho)"""

GAPS = f""",
gaps as (
  select a.fragment_id as a_fragment_id, b.fragment_id as b_fragment_id, b.first_t - a.last_t as gap, cast(b.first_t - a.last_t as double) / {H} as gap_units
  from fragments a join fragments b on a.direction = b.direction and a.compute_node_id = b.compute_node_id and a.fragment_id <> b.fragment_id
  where b.first_t - a.last_t between 0 and {20 * H})"""

CONE = GAPS + """,
tr as (
  select fragment_id, row_number() over (partition by fragment_id order by th, x, y) as i, count(*) over (partition by fragment_id) as n, th as t, x, y from ho),
tr3 as (select * from tr where n >= 3),
ext as (select fragment_id, any_value(n) as n, min(t) as t0, max(t) as t1 from tr3 group by fragment_id),
pr as (
  select g.*, ea.n >= eb.n as fwd, case when ea.n >= eb.n then ea.t1 else eb.t0 end as o,
         case when ea.n >= eb.n then g.a_fragment_id else g.b_fragment_id end as fit_id, case when ea.n >= eb.n then g.b_fragment_id else g.a_fragment_id end as seen_id
  from gaps g join ext ea on ea.fragment_id = g.a_fragment_id join ext eb on eb.fragment_id = g.b_fragment_id),
ft as (
  select p.a_fragment_id, p.b_fragment_id, t - o as t, x, y,
         case when fwd then 1e-6 + (1 - 1e-6) / greatest(least(n, 25) - 1, 1) * (i - greatest(n - 25, 0) - 1) else 1 - (1 - 1e-6) / greatest(least(n, 25) - 1, 1) * (i - 1) end as w
  from pr p join tr3 on fragment_id = fit_id where case when fwd then i > n - 25 else i <= 25 end),
sm as (
  select a_fragment_id, b_fragment_id, sum(w) as sw, sum(w * t) as st, sum(w * x) as sx, sum(w * y) as sy, sum(w * t * t) as stt, sum(w * t * x) as stx, sum(w * t * y) as sty
  from ft group by all),
ln as (
  select *, (sw * stx - st * sx) / nullif(sw * stt - st * st, 0) as bx, (sw * sty - st * sy) / nullif(sw * stt - st * st, 0) as "by" from sm),
l2 as (select *, (sx - bx * st) / sw as cx, (sy - "by" * st) / sw as cy from ln),
se as (
  select p.a_fragment_id, p.b_fragment_id, p.gap_units, (case when fwd then 1 else -1 end) * (t - o) as td, t - o as t, x, y,
         row_number() over (partition by p.a_fragment_id, p.b_fragment_id order by i) as k, greatest(var_pop(y) over (partition by p.a_fragment_id, p.b_fragment_id), 2.0) as vy
  from pr p join tr3 on fragment_id = seen_id where case when fwd then i <= 25 else i > n - 25 end),
sv as (
  select s.*, l.bx, l."by", l.cx, l.cy, power((0.1 + td * 0.01) * l.bx, 2) as vx, first_value(power((0.1 + td * 0.01) * l.bx, 2)) over (partition by s.a_fragment_id, s.b_fragment_id order by k) as v0,
         power((1 + td * 0.1) * l."by", 2) as vp
  from se s join l2 l using (a_fragment_id, b_fragment_id)),
ok as (select * from sv where bx <> 0 and "by" <> 0),
bh as (
  select a_fragment_id, b_fragment_id, avg(
           power(bx * t + cx - x, 2) / ((vx + v0) / 2) / 8 + ln((vx + v0) / 2 / sqrt(vx * v0)) / 2
         + power("by" * t + cy - y, 2) / ((vp + vy) / 2) / 8 + ln((vp + vy) / 2 / sqrt(vp * vy)) / 2) + 0.1 * any_value(gap_units) as cost
  from ok group by all)"""


def stats(table: str, column: str, by: str, label: str) -> str:
    return f"""select {by}, '{label}' as metric, round(min({column})::double, 4) as min, round(max({column})::double, 4) as max, round(median({column}::double), 4) as median,
    round(avg({column}::double), 4) as avg, round(stddev_pop({column}::double), 4) as stdev from {table} group by {by}"""


WITH_INDEX = "select *, row_number() over (partition by fragment_id order by t, event_id) as i from points"

ORACLE: dict[str, str] = {
    "fragments_all": P + " select fragment_id, vehicle_id, direction, compute_node_id, first_t, last_t, n, starting_x, ending_x from fragments",
    "scan_long_fragments": P + " select fragment_id, compute_node_id, last_t, n from fragments where n > 3 and direction = 1",
    "find_filter": P + " select fragment_id, first_t, last_t from fragments where direction = 1 and compute_node_id = 2",
    "find_in": P + " select fragment_id, vehicle_id, n from fragments where vehicle_id in (2, 3, 5, 8, 13, 21)",
    "find_range": P + f" select fragment_id, first_t from fragments where first_t >= {T0 + 100 * H} and first_t < {T0 + 200 * H}",
    "find_exists_min": P + " select min(t) as first_t from points where direction = 1",
    "projection_ids": P + " select fragment_id from fragments where n >= 4",
    "topk_starting_x": P + " select fragment_id, starting_x from fragments order by starting_x desc, fragment_id limit 20",
    "latest_per_vehicle": P + " select vehicle_id, arg_max(event_id, t) as event_id, max(t) as t, arg_max(x_cents, t) as x_cents from points group by vehicle_id",
    "distinct_nodes_ordered": P
    + """ select compute_node_id, first_x, cast(row_number() over (order by first_x, compute_node_id) - 1 as integer) as position
    from (select compute_node_id, arg_min(starting_x, first_t) as first_x from fragments group by compute_node_id)""",
    "time_bounds": P + " select direction, min(last_t) as t_min, max(last_t) as t_max, count(distinct compute_node_id) as nodes from fragments group by direction",
    "range_read_batches": P
    + f""" select cast(floor((last_t - (select min(last_t) from fragments)) / {10.0 * H}) as bigint) as batch, count(*) as n, min(fragment_id) as first_id from fragments group by 1""",
    "interval_touch": P
    + f""" select fragment_id, direction from fragments where
    ((first_t between {T0 + 200 * H} and {T0 + 248 * H}) or (last_t between {T0 + 200 * H} and {T0 + 248 * H}) or (first_t <= {T0 + 200 * H} and last_t >= {T0 + 248 * H}))
    and ((starting_x between -200000 and 200000) or (ending_x between -200000 and 200000) or (least(starting_x, ending_x) <= -200000 and greatest(starting_x, ending_x) >= 200000))""",
    "slice_time_space": P
    + f""", s as (select *, row_number() over (partition by fragment_id order by t desc, event_id desc) as r from points
    where t between {T0 + 150 * H} and {T0 + 350 * H} and x_cents between -300000 and 300000)
    select fragment_id, direction, min(t) as first_t, max(t) as last_t, arg_min(x_cents, t) as starting_x, arg_max(x_cents, t) as ending_x, count(*) as n from s where r > 1 group by all""",
    "chunk_export_plan": P
    + f""" select cast(floor((first_t - (select min(first_t) from fragments)) / {24.0 * H}) as bigint) as chunk, count(*) as n, min(first_t) as first_t, max(first_t) as last_first_t from fragments group by 1""",
    "csv_sessions": P
    + f""", s as (select *, case when t - lag(t) over (partition by vehicle_id order by t) > {6 * H} then 1 else 0 end as b from points),
    u as (select *, cast(sum(b) over (partition by vehicle_id order by t rows unbounded preceding) as bigint) as session from s)
    select vehicle_id, session, count(*) as n, min(t) as first_t, max(t) as last_t from u group by all""",
    "size_histogram": P + " select size, count(*) as n from (select vehicle_id, cast(count(*) as integer) as size from fragments group by 1) group by size",
    "fragment_length_histogram": P + " select n as size, count(*) as n from fragments group by 1",
    "sample_every_k": P + " select event_id, vehicle_id, t from (select *, row_number() over (partition by vehicle_id order by t, event_id) - 1 as r from points) where r % 7 = 0",
    "sample_by_id": P + " select event_id, fragment_id from points where event_id % 10 = 3",
    "anti_lookup": P + " select fragment_id, n from fragments f where not exists (select 1 from fragments g where g.n > 3 and g.fragment_id = f.fragment_id)",
    "member_join": P + " select vehicle_id, fragment_id, n, first_t from fragments where n > 3",
    "gt_fragment_map": P + " select fragment_id // 1000 as gt_id, count(*) as n_fragments, min(fragment_id) as first_id, max(fragment_id) as last_id from fragments where n > 3 group by 1",
    "existing_members": P + " select vehicle_id, count(*) as n_left from fragments where n > 6 group by vehicle_id",
    "id_set_difference": P + " select vehicle_id, count(*) filter (n <= 3) as n_unlisted from fragments group by vehicle_id",
    "union_in_order": P + " select fragment_id, direction, last_t, row_number() over (partition by direction order by last_t, fragment_id) as place from fragments",
    "set_unset": P + " select fragment_id, case when n > 5 then n * 10 else n end as n, case when n > 5 then 1 end as checked from fragments",
    "push_upsert": P
    + """, a as (select vehicle_id, fragment_id, 0 as late from fragments where n > 3 and vehicle_id % 3 <> 0 union all select vehicle_id, fragment_id, 1 from fragments where n <= 3)
    select vehicle_id, count(*) as n_ids, arg_min(fragment_id, late * 1000000000 + fragment_id) as first_id, arg_max(fragment_id, late * 1000000000 + fragment_id) as last_id from a group by 1""",
    "delete_many": P + " select fragment_id, n from fragments where n <> 1",
    "time_align": P
    + f""", h as (select cast(floor(t / {1.0 * H}) as bigint) as slot, direction, count(*) as n from points group by all),
    a as (select slot, n as n_east from h where direction = 1), b as (select slot, n as n_west from h where direction = -1),
    r as (select greatest((select min(slot) from a), (select min(slot) from b)) as lo, least((select max(slot) from a), (select max(slot) from b)) as hi)
    select slot, n_east, n_west from a join b using (slot), r where slot between lo and hi""",
    "json_documents": "select cast(json_extract_string(props, '$.k') as integer) as k, count(*) as n from events group by 1",
    "date_parts": "select strftime(ts, '%Y-%m-%d') as day, cast(hour(ts) as integer) as hour, count(*) as n from events group by all",
    "name_parts": P + " select case when direction = 1 then 'eb' else 'wb' end as side, cast(compute_node_id as integer) as node, count(*) as n from fragments group by 1, 2",
    "rollup_nodes": P + " select direction, compute_node_id, count(*) as n, cast(sum(n) as bigint) as samples from fragments group by rollup (direction, compute_node_id)",
    "cube_nodes": P + " select direction, compute_node_id, count(*) as n from fragments group by cube (direction, compute_node_id)",
    "set_operations": P
    + """ select vehicle_id, 'both' as kind from (select vehicle_id from fragments where n > 3 intersect select vehicle_id from fragments where direction = 1)
    union all select distinct vehicle_id, 'only' from (select vehicle_id from fragments where n > 3 except all select vehicle_id from fragments where direction = 1)""",
    "conf_mask": P
    + """, k as (select *, count(*) over (partition by fragment_id) as m from points where conf >= 0.5)
    select fragment_id, min(t) as first_t, max(t) as last_t, arg_min(x_cents, t) as starting_x, arg_max(x_cents, t) as ending_x, count(*) as n from k where m >= 4 group by fragment_id""",
    "conf_mask_arrays": P
    + """ select fragment_id, count(*) filter (conf >= 0.5) as n, min(t) filter (conf >= 0.5) as first_t, cast(arg_max(x_cents, t) filter (conf >= 0.5) as double) as ending_x
    from points group by fragment_id having count(*) >= 4 and count(*) filter (conf >= 0.5) >= 4""",
    "short_track_filter": P + " select fragment_id, count(*) as n, count(*) filter (conf >= 0.2) as n_valid from points group by 1 having count(*) > 3 and count(*) filter (conf >= 0.2) > 3",
    "wrong_direction": P + " select fragment_id, count(*) as n from points group by fragment_id having case when avg(y) < 36 then 1 else -1 end = any_value(direction)",
    "null_outliers_2sd": P
    + """ select vehicle_id, count(*) filter (abs(y - m) <= 1.5 * s) as n_kept, count(*) as n
    from (select vehicle_id, y, avg(y) over v as m, stddev_pop(y) over v as s from points window v as (partition by vehicle_id)) group by 1""",
    "quantile_outliers": P
    + """, f as (select vehicle_id, regr_slope(x, th) as bx, regr_intercept(x, th) as cx, regr_slope(y, th) as "by", regr_intercept(y, th) as cy from ho group by 1),
    r as (select vehicle_id, x - (bx * th + cx) as rx, y - ("by" * th + cy) as ry from ho join f using (vehicle_id)),
    q as (select vehicle_id, quantile_cont(rx, 0.1) as x1, quantile_cont(rx, 0.9) as x9, quantile_cont(ry, 0.1) as y1, quantile_cont(ry, 0.9) as y9 from r group by 1)
    select vehicle_id, count(*) filter (rx < x1 or rx > x9 or ry < y1 or ry > y9) as n_outliers, count(*) as n from r join q using (vehicle_id) group by 1""",
    "median_outliers": P
    + """, m as (select vehicle_id, median(y) as m, stddev_pop(y) as s from points group by 1)
    select vehicle_id, count(*) filter (abs(y - m) > 1.5 * s) as n_far from points join m using (vehicle_id) group by 1""",
    "trim_ends": P
    + """, b as (select fragment_id, min(t) as lo, max(t) as hi from points where conf >= 0.5 group by 1)
    select fragment_id, count(*) as n, min(t) as first_t, max(t) as last_t from points join b using (fragment_id) where t between lo and hi group by 1""",
    "duplicate_frames": P
    + f""" select vehicle_id, count(*) - count(distinct frame) as duplicates from (select vehicle_id, floor(t / {6.0 * H}) as frame from points) group by 1 having count(*) > count(distinct frame)""",
    "mean_of_repeats": P + f" select vehicle_id, cast(floor(t / {6.0 * H}) as bigint) as frame, round(avg(x_cents), 6) as x, round(avg(y), 6) as y from points group by 1, 2",
    "first_of_repeats": P
    + f""", r as (select vehicle_id, cast(floor(t / {6.0 * H}) as bigint) as frame, event_id, case when conf >= 0.5 then x_cents end as valid, t from points)
    select vehicle_id, frame, event_id, valid from r qualify row_number() over (partition by vehicle_id, frame order by valid is null, t, event_id) = 1""",
    "frame_time_map": P
    + f""", e as (select min(event_id) as f0, max(event_id) as f1, arg_min(t, event_id) as t0, arg_max(t, event_id) as t1 from points)
    select event_id, round((t0 + cast((t1 - t0) * cast(event_id - f0 as hugeint) as double) / (f1 - f0) - t) / {1.0 * H}, 6) as shift from points, e""",
    "extend_tracks": P
    + f""", e as (select fragment_id, direction, cast(floor(min(t) / {1.0 * H}) as bigint) as ff, cast(floor(max(t) / {1.0 * H}) as bigint) as lf, arg_min(x_cents, t)::double as fx, arg_max(x_cents, t)::double as lx
      from points group by 1, 2),
    v as (select *, abs(lx - fx) / (lf - ff) as v from e where lf > ff),
    s as (select *, least(1000, {T0 // H + 720} - lf, floor(case when direction = 1 then 2000000 - lx else lx + 2000000 end / v)) as na,
                 least(1000, ff - {T0 // H}, floor(case when direction = 1 then fx + 2000000 else 2000000 - fx end / v)) as nb from v where v >= 1),
    o as (select fragment_id, lf + k as frame, lx + direction * v * k as x from (select *, unnest(range(1, cast(greatest(na, 0) as bigint) + 1)) as k from s)
      union all select fragment_id, ff - k, fx - direction * v * k from (select *, unnest(range(1, cast(greatest(nb, 0) as bigint) + 1)) as k from s))
    select fragment_id, count(*) as n, min(frame) as first_frame, max(frame) as last_frame, round(max(x), 6) as max_x from o group by 1""",
    "grid_resample_mean": P + f" select fragment_id, cast(floor(t / {H / 2}) as bigint) as slot, round(avg(x_cents), 6) as x, round(avg(y), 6) as y from points group by 1, 2",
    "grid_resample_linear": P
    + SLOTS
    + """, b as (select fragment_id, min(slot) as a, max(slot) as z from slots group by 1),
    g as (select fragment_id, unnest(range(a, z + 1)) as slot from b),
    j as (select g.fragment_id, g.slot, s.x, s.y from g left join slots s using (fragment_id, slot)),
    k as (select *, last_value(case when x is not null then slot end ignore nulls) over p as s0, last_value(x ignore nulls) over p as x0, last_value(y ignore nulls) over p as y0,
      first_value(case when x is not null then slot end ignore nulls) over n as s1, first_value(x ignore nulls) over n as x1, first_value(y ignore nulls) over n as y1
      from j window p as (partition by fragment_id order by slot rows unbounded preceding), n as (partition by fragment_id order by slot rows between current row and unbounded following))
    select fragment_id, slot, round(coalesce(x, x0 + (x1 - x0) * (slot - s0) / (s1 - s0)), 6) as x, round(coalesce(y, y0 + (y1 - y0) * (slot - s0) / (s1 - s0)), 6) as y from k""",
    "merge_resample": P
    + f""", c as (select *, count(*) over (partition by fragment_id) as m, min(t) over (partition by fragment_id) as t0 from points where conf >= 0.5),
    m as (select fragment_id, cast(floor((t - t0) / {H / 2}) as bigint) as slot, avg(x_cents::double) as x, avg(y) as y from c where m >= 4 group by 1, 2),
    g as (select fragment_id, unnest(range(min(slot), max(slot) + 1)) as slot from m group by fragment_id),
    j as (select g.fragment_id, g.slot, m.x, m.y from g left join m using (fragment_id, slot)),
    k as (select *, last_value(case when x is not null then slot end ignore nulls) over p as s0, last_value(x ignore nulls) over p as x0, last_value(y ignore nulls) over p as y0,
      first_value(case when x is not null then slot end ignore nulls) over n as s1, first_value(x ignore nulls) over n as x1, first_value(y ignore nulls) over n as y1
      from j window p as (partition by fragment_id order by slot rows unbounded preceding), n as (partition by fragment_id order by slot rows between current row and unbounded following))
    select fragment_id, slot // 4 as slot, round(coalesce(x, x0 + (x1 - x0) * (slot - s0) / (s1 - s0)), 6) as x, round(coalesce(y, y0 + (y1 - y0) * (slot - s0) / (s1 - s0)), 6) as y from k where slot % 4 = 0""",
    "index_interpolate": P
    + f""", i as (select *, case when conf >= 0.5 then x_cents::double end as s from ({WITH_INDEX})),
    k as (select *, last_value(case when s is not null then i end ignore nulls) over p as i0, last_value(s ignore nulls) over p as s0,
      first_value(case when s is not null then i end ignore nulls) over n as i1, first_value(s ignore nulls) over n as s1
      from i window p as (partition by fragment_id order by i rows unbounded preceding), n as (partition by fragment_id order by i rows between current row and unbounded following))
    select event_id, fragment_id, round(case when s is not null then s when s0 is null then s1 when s1 is null then s0 else s0 + (s1 - s0) * (i - i0) / (i1 - i0) end, 6) as x from k""",
    "speed": P
    + """ select event_id, round((x - lag(x) over v) / nullif(th - lag(th) over v, 0), 6) as vx, round((y - lag(y) over v) / nullif(th - lag(th) over v, 0), 6) as vy,
    round(abs((x - lag(x) over v) / nullif(th - lag(th) over v, 0)), 6) as speed from ho window v as (partition by fragment_id order by t, event_id)""",
    "accel": P
    + """ select event_id, round((lead(x, 2) over v - 2 * lead(x) over v + x) / nullif((lead(th) over v - th) * (lead(th) over v - th), 0), 6) as ax
    from ho window v as (partition by fragment_id order by t, event_id)""",
    "velocity_signed": P + " select event_id, round(direction * (coalesce(lead(x) over v - x, x - lag(x) over v) / 0.04::double), 6) as v from ho window v as (partition by fragment_id order by t, event_id)",
    "rotation": P
    + """, r as (select event_id, (x - lag(x) over v) / nullif(th - lag(th) over v, 0) as vx, (y - lag(y) over v) / nullif(th - lag(th) over v, 0) as vy from ho window v as (partition by fragment_id order by t, event_id))
    select event_id, round(atan2(abs(vy), abs(vx)) * (180 / 3.14::double), 6) as theta from r where vx is not null""",
    "lane_index": P + " select cast(least(greatest(floor((y + 12) / 12) + 1, 0), 13) as integer) as lane, count(*) as n, count(distinct vehicle_id) as vehicles from points group by 1",
    "lane_changes": P
    + """, l as (select *, least(greatest(floor((y + 12) / 12) + 1, 0), 13) as lane from points),
    c as (select fragment_id, case when lane <> lag(lane) over (partition by fragment_id order by t, event_id) then 1 else 0 end as c from l)
    select fragment_id, cast(sum(c) as bigint) as changes from c group by 1""",
    "lane_change_vehicles": P
    + """ select fragment_id, count(distinct floor(y / 12)) as lanes, round(max(y) - min(y), 6) as span from points group by 1 having count(distinct floor(y / 12)) > 1 and round(max(y) - min(y), 6) > 12""",
    "longest_run": P
    + f""", f as (select distinct vehicle_id, cast(floor(t / {12.0 * H}) as bigint) as frame from points),
    g as (select *, frame - row_number() over (partition by vehicle_id order by frame) as run from f),
    r as (select vehicle_id, run, count(*) as size, min(frame) as a, max(frame) as z from g group by 1, 2),
    b as (select * from r qualify row_number() over (partition by vehicle_id order by size desc, a) = 1)
    select vehicle_id, size - 1 as n, a as first_frame from b where size > 1""",
    "travel_direction": P
    + """, s as (select fragment_id, arg_min(x_cents, t) filter (conf >= 0.5) as a, arg_max(x_cents, t) filter (conf >= 0.5) as z, arg_min(y, t) as y from points group by 1)
    select fragment_id, case when z - a > 0 then 1 when z - a < 0 then -1 when y < 18 then 1 else -1 end as way from s""",
    "fill_forward": P
    + " select event_id, last_value(case when conf >= 0.7 then x_cents end ignore nulls) over (partition by vehicle_id order by t, event_id rows unbounded preceding) as x from points",
    "moving_avg": P
    + """ select event_id, round(cast(sum(x_cents) over v as double) / 5, 6) as x, round(cast(sum(x_cents) over v as double) / count(*) over v, 6) as x_edge
    from points window v as (partition by vehicle_id order by t, event_id rows between 2 preceding and 2 following)""",
    "gaussian_smooth": P
    + f""", i as (select *, x_cents::double / 100 as s, count(*) over (partition by fragment_id) as n from ({WITH_INDEX}))
    select a.event_id, round(sum(b.s * exp(-power(a.i - b.i + floor((a.n - 1) / 2) - (a.n - 1) / 2.0, 2) / 200) / (10 * sqrt(2 * pi()))), 6) as x
    from i a join i b on a.fragment_id = b.fragment_id group by 1""",
    "euler_path": P
    + """ select event_id, round(coalesce(sum(direction * cast(round(y * 100) as bigint)) over (partition by fragment_id order by t, event_id rows between unbounded preceding and 1 preceding), 0) * 0.04::double, 6) as x from points""",
    "track_facts": P
    + """, r as (select *, direction * ((x - lag(x) over v) / nullif(th - lag(th) over v, 0)) as vx, (y - lag(y) over v) / nullif(th - lag(th) over v, 0) as vy from ho window v as (partition by fragment_id order by t, event_id))
    select fragment_id, max(case when vx < 0 then 1 else 0 end) as backward, round(min(vy), 6) as min_vy, round(max(y) - min(y), 6) as y_range, max(t) - min(t) as duration, max(x_cents) - min(x_cents) as x_travelled from r group by 1""",
    "box_corners": P
    + """, h as (select *, cos(case when direction = 1 then 0.1 else -0.1 end) as c, sin(case when direction = 1 then 0.1 else -0.1 end) as s from ho)
    select event_id, round(x + s * width / 2, 6) as bbr_x, round(y - c * width / 2, 6) as bbr_y, round(x + c * length + s * width / 2, 6) as fbr_x, round(y + s * length - c * width / 2, 6) as fbr_y,
    round(x + c * length - s * width / 2, 6) as fbl_x, round(y + s * length + c * width / 2, 6) as fbl_y, round(x - s * width / 2, 6) as bbl_x, round(y + c * width / 2, 6) as bbl_y from h""",
    "reorder_corners": P
    + """ select event_id, round(case when direction = 1 then x else x + length end, 6) as bbr_x, round(case when direction = 1 then y else y + width end, 6) as bbr_y,
    round(case when direction = 1 then x + length else x end, 6) as fbl_x, round(case when direction = 1 then y + width else y end, 6) as fbl_y from ho""",
    "homography": P
    + """, u as (select event_id, abs(x) / 100 as u, y as v from ho)
    select event_id, round((u * 1.2::double + v * 0.1::double + 30) / (u * 1e-4::double + v * 2e-4::double + 1), 6) as u, round((u * -0.05::double + v * 0.9::double + 4) / (u * 1e-4::double + v * 2e-4::double + 1), 6) as v from u""",
    "planar_distance": P
    + """, q as (select event_id, 36.0::double + y / 1000 as lat, -86.6::double + x / 1e6::double as lon from ho),
    w as (select event_id, 6371000 * (radians(lon) - radians(-86.6::double)) * cos((radians(36.0::double) + radians(lat)) / 2) as dx, 6371000 * (radians(lat) - radians(36.0::double)) as dy from q)
    select event_id, round(sqrt(dx * dx + dy * dy), 4) as d, round(dx, 4) as dx, round(dy, 4) as dy from w""",
    "unit_scale": P
    + """ select event_id, round(x * 3.281::double, 6) as feet, round(y * 5280 / 3600, 6) as fps, round(greatest(least(x, 100.0), -100.0), 6) as clamped,
    round(cast((4 - least(greatest(floor((y + 12) / 12) + 1, 0), 13)) * 12 + 6 as double) / 3.281::double, 6) as lane_y from ho""",
    "camera_lookup": P
    + """ select case when abs(x) < 500 then 'p1c1' when abs(x) < 2000 then 'p1c2' when abs(x) < 8000 then 'p2c1' when abs(x) < 1e9 then 'p2c2' end as camera,
    coalesce(case when abs(x) < 500 then 'p1c1' when abs(x) < 2000 then 'p1c2' when abs(x) < 8000 then 'p2c1' when abs(x) < 1e9 then 'p2c2' end, '') as again, count(*) as n from ho group by 1, 2""",
    "vehicle_class": "select coalesce(try_cast(substr(event_type, 1, 1) as integer), 1) as class, count(*) as n from events group by 1",
    "snapshot_pivot": P + ROAD + " select slot, fragment_id, direction, round(cx, 6) as cx, round(cy, 6) as cy, l, w, round(v, 6) as v from snap",
    "snapshot_nested": P + ROAD + " select slot, count(*) filter (direction = 1) as n_eb, count(*) filter (direction = -1) as n_wb from snap group by slot",
    "snapshot_pairs_overlap": P + CROWD + " select slot, direction, a_fragment_id, b_fragment_id from touching",
    "space_gap": P
    + CROWD
    + """ select slot, a_fragment_id, b_fragment_id, round(greatest((bcx - bl / 2) - (acx + al / 2), (acx - al / 2) - (bcx + bl / 2)), 6) as gap from sp
    where abs((acy + aw / 2) + (acy - aw / 2) - (bcy + bw / 2) - (bcy - bw / 2)) / 2 < 6 and greatest((bcx - bl / 2) - (acx + al / 2), (acx - al / 2) - (bcx + bl / 2)) <= 181""",
    "pair_configuration": P
    + CROWD
    + """ select acx - al * 0.5 - 5 > bcx + bl * 0.5 as ahead, acx + al * 0.5 + 5 < bcx - bl * 0.5 as behind, acy + aw * 0.5 + 1 < bcy - bw * 0.5 as "right", acy - aw * 0.5 - 1 > bcy + bw * 0.5 as "left", count(*) as n
    from sp where abs(acx - bcx) <= 19 group by 1, 2, 3, 4""",
    "box_iou": P
    + CROWD
    + """ select slot, a_fragment_id, b_fragment_id, round(greatest(least(acx + al / 2, bcx + bl / 2) - greatest(acx - al / 2, bcx - bl / 2), 0.0)
    * greatest(least(acy + aw / 2, bcy + bw / 2) - greatest(acy - aw / 2, bcy - bw / 2), 0.0)
    / least(((acx + al / 2) - (acx - al / 2)) * ((acy + aw / 2) - (acy - aw / 2)), ((bcx + bl / 2) - (bcx - bl / 2)) * ((bcy + bw / 2) - (bcy - bw / 2))), 6) as iou from touching""",
    "conflict_seconds": P + CROWD + " select a_fragment_id, b_fragment_id, round(seconds / 25, 6) as seconds from seconds",
    "conflict_lists": P + CROWD + " select id, count(*) as n, round(sum(seconds), 6) as seconds, min(other) as first_other from each group by id",
    "snapshot_to_tracks": P
    + ROAD
    + """, g as (select *, case when slot - lag(slot) over (partition by fragment_id order by slot) > 1 then 1 else 0 end as b from snap),
    s as (select *, cast(sum(b) over (partition by fragment_id order by slot rows unbounded preceding) as bigint) as stay from g)
    select fragment_id, stay, count(*) as n, min(slot) as first_slot, max(slot) as last_slot, round(arg_min(cx - direction * l * 0.5, slot), 6) as starting_x from s group by 1, 2""",
    "merge_candidates": P + MERGE + " select * from mp",
    "grid_track_join": P + SHARED + " select a_fragment_id, b_fragment_id, count(*) as shared, min(slot) as first_slot, max(slot) as last_slot from shared group by 1, 2",
    "merge_cost": P + SHARED + " select a_fragment_id, b_fragment_id, round(cost, 4) as cost from costs",
    "merge_cost_all": P + SHARED + " select coalesce(cost, 1e5) >= 1e5 as apart, count(*) as n from mp left join costs using (a_fragment_id, b_fragment_id) group by 1",
    "merge_cost_simple": P
    + SHARED
    + """ select a_fragment_id, b_fragment_id, round(sqrt(sum((ax - bx) * (ax - bx) + (ay - "by") * (ay - "by"))) / count(*), 4) as cost from shared where place < shared group by 1, 2""",
    "merge_cost_samples": P
    + SHARED
    + """ select a_fragment_id, b_fragment_id, round(avg((ax - bx) * (ax - bx) / ((al + bl) / 2) / 8 + ln((al + bl) / 2 / sqrt(al * bl)) / 2
    + (ay - "by") * (ay - "by") / ((aw + bw) / 2) / 8 + ln((aw + bw) / 2 / sqrt(aw * bw)) / 2), 4) as cost from shared group by 1, 2""",
    "merge_components": P + COMPONENTS + " select fragment_id, component from comps",
    "merge_by_cost": P
    + SHARED
    + """, lk as (select a_fragment_id as a, b_fragment_id as b from costs where cost <= 3.0), und as (select a, b from lk union select b, a from lk),
    reach as (select fragment_id as a, fragment_id as b from fragments union select r.a, u.b from reach r join und u on r.b = u.a)
    select a as fragment_id, min(b) as component from reach group by a""",
    "merge_combined": P + SLOTS + COMPONENTS + " select component, slot, round(avg(x), 6) as x, round(avg(y), 6) as y, count(*) as n from slots join comps using (fragment_id) group by 1, 2",
    "merge_summary": P
    + COMPONENTS
    + " select component, arg_min(fragment_id, last_t) as base_id, count(*) as n_ids, min(first_t) as first_t, max(last_t) as last_t from fragments join comps using (fragment_id) group by 1",
    "ols_fit": P + LINES + " select fragment_id, round(regr_slope(x, c), 4) as slope, round(regr_intercept(x, c), 4) as intercept from cen group by 1 having count(*) >= 4",
    "wls_fit": P
    + LINES
    + """, s as (select fragment_id, sum(w) as sw, sum(w * c) as st, sum(w * x) as sv, sum(w * c * c) as stt, sum(w * c * x) as stv from cen group by 1 having count(*) >= 4),
    b as (select *, (sw * stv - st * sv) / nullif(sw * stt - st * st, 0) as slope from s)
    select fragment_id, round(slope, 4) as slope, round((sv - slope * st) / sw, 4) as intercept from b""",
    "stitch_candidates": P + GAPS + " select a_fragment_id, count(*) as n_next, min(gap) as least_gap from gaps group by 1",
    "stitch_candidates_master": P
    + f""", pos as (select compute_node_id, row_number() over (order by arg_min(starting_x, first_t), compute_node_id) as p from fragments group by 1)
    select a.fragment_id as a_fragment_id, b.fragment_id as b_fragment_id, b.first_t - a.last_t as gap from (fragments join pos using (compute_node_id)) a
    join (fragments join pos using (compute_node_id)) b on a.direction = b.direction and a.fragment_id <> b.fragment_id and b.first_t - a.last_t between 0 and {5 * H} and abs(a.p - b.p) <= 1""",
    "stitch_cost": P
    + CONE
    + """ select p.a_fragment_id, p.b_fragment_id, round(coalesce(cost, 1e6), 3) as cost from pr p left join bh using (a_fragment_id, b_fragment_id)""",
    "stitched_greedy": P
    + CONE
    + """, near as (select a_fragment_id as a, b_fragment_id as b, cost from bh where cost <= 50.0),
    ba as (select a, b from (select *, row_number() over (partition by a order by cost, b) as k from near) x where k = 1),
    bb as (select a, b from (select *, row_number() over (partition by b order by cost, a) as k from near) x where k = 1),
    lk as (select a, b from ba join bb using (a, b)), und as (select a, b from lk union select b, a from lk),
    reach as (select fragment_id as a, fragment_id as b from fragments union select r.a, u.b from reach r join und u on r.b = u.a)
    select min(b) as trajectory_id, a as fragment_id from reach group by a""",
    "id_combinations": P + " select a.vehicle_id, a.fragment_id as a_fragment_id, b.fragment_id as b_fragment_id from fragments a join fragments b on a.vehicle_id = b.vehicle_id and a.fragment_id < b.fragment_id",
    "moments": P + " select direction, round(avg(y - 36), 6) as mean, round(avg(abs(y - 36)), 6) as mean_size, round(stddev_pop(y - 36), 6) as sd, round(max(abs(y - 36)), 6) as most from points group by 1",
    "dimensions_of_class": P
    + """, k as (select event_id, case when event_id % 9 = 4 then 'SUV' when event_id % 9 = 5 then 'truck' when event_id % 9 = 6 then 'trailer' when event_id % 9 = 7 then 'bus' else 'sedan' end as kind from points)
    select event_id, kind, case kind when 'truck' then 8.0::double when 'bus' then 12.0::double when 'trailer' then 12.0::double else 4.5::double end as length,
    case kind when 'sedan' then 1.7::double when 'SUV' then 1.9::double when 'truck' then 2.0::double else 2.2::double end as width from k""",
    "legacy_nll_cost": P
    + LINES
    + GAPS
    + """, l as (select fragment_id, regr_slope(x, c) as s, regr_intercept(x, c) as i from cen group by 1 having count(*) >= 4)
    select a_fragment_id, b_fragment_id, round((ln(2 + gap_units) + power(s * gap_units + i - starting_x / 100.0::double, 2) / (2 + gap_units)) / 2, 2) as cost
    from gaps join l on l.fragment_id = a_fragment_id join fragments b on b.fragment_id = b_fragment_id""",
    "headway_cost": P
    + GAPS
    + " select a_fragment_id, b_fragment_id, round(0.5 * (abs(gap_units) - 2), 6) as headway, round(exp(-(ln(2.0::double) + gap_units * gap_units / 2) / 2), 6) as likelihood from gaps",
    "combine_by_vehicle": P
    + """ select vehicle_id as trajectory_id, median(length) as length, median(width) as width, max(compute_node_id) as compute_node_id, min(t) as first_t, max(t) as last_t, arg_min(x_cents, t) as starting_x,
    arg_max(x_cents, t) as ending_x, count(*) as n, count(distinct fragment_id) as n_fragments, any_value(direction) as direction from points group by 1""",
    "asof_previous": P
    + """ select e.event_id, w.x_cents as last_x from (select event_id, t, compute_node_id % 2 as part from points where direction = 1) e
    asof left join (select t, x_cents, (compute_node_id % 2 + 1) % 2 as part from points where direction = -1) w on e.part = w.part and e.t >= w.t""",
    "follow_counts": P + f" select a.direction, count(*) as n from fragments a join fragments b on a.direction = b.direction and b.first_t - a.last_t between 0 and {H} group by 1",
    "feasibility": P + SCORES + " select fragment_id, round(distance, 6) as distance, round(backward, 6) as backward, round(rotation, 6) as rotation, round(acceleration, 6) as acceleration, round(conflict, 6) as conflict from scores",
    "feasible_flags": P + SCORES + " select fragment_id, all_feasible, not all_feasible as any_infeasible, round(score, 6) as score from flags",
    "aggregate_score": P
    + SCORES
    + """ select round(12.0::double / 30, 6) as realtime, round(avg(score), 6) as soft, round(avg(all_feasible::integer), 6) as hard,
    round(12.0::double / 30 * 0.5 + avg(score) * 2 + avg(all_feasible::integer) * 2, 6) as total from flags""",
    "five_number": P
    + ", f as (select direction, (last_t - first_t) / 1000000.0::double as duration, abs(ending_x - starting_x) as travelled, n from fragments) "
    + " union all ".join(stats("f", c, "direction", c) for c in ("duration", "travelled", "n")),
    "binned_statistics": P + f", f as (select cast(floor(t / {24.0 * H}) as bigint) as day, y from points) " + stats("f", "y", "day", "y"),
    "collection_counts": P + " select direction, compute_node_id, count(*) as n, cast(sum(n) as bigint) as samples from fragments group by 1, 2",
    "stage_report": P
    + """ select count(*) as total, count(*) filter (n > 3) as long, count(*) filter (direction = 1) as east, count(*) filter (starting_x = ending_x) as still, count(*) filter (n = 1) as one_sample from fragments""",
    "histogram": P
    + """, e as (select min(y) as lo, max(y) as hi from points)
    select direction, cast(least(floor((y - lo) * 30 / (hi - lo)), 29) as bigint) as bin, count(*) as n from points, e group by 1, 2""",
    "kde": P
    + """, v as (select y as v, count(*) as times from points group by 1),
    f as (select min(v) as lo, max(v) as hi, sum(times) as n, sum(v * times) as s, sum(v * v * times) as q from v),
    g as (select *, sqrt((q - s * s / n) / (n - 1)) * power(n, -0.2::double) as h from f),
    k as (select unnest(range(0, 50)) as place)
    select cast(place as integer) as place, round(any_value(lo + (hi - lo) * place / 49), 4) as at,
    round(sum(times * exp(-power((lo + (hi - lo) * place / 49 - v) / h, 2) / 2)) / any_value(n * h) / sqrt(2 * pi()), 8) as density from k, v, g group by 1""",
    "confusion_pct": P
    + """, c as (select vehicle_id % 5 as class, cast(least(greatest(floor((y + 12) / 12) + 1, 0), 13) as integer) as lane, count(*) as n from points group by 1, 2)
    select class, lane, n, round(n / cast(sum(n) over (partition by lane) as double), 6) as share from c""",
    "cv_per_vehicle": P + " select vehicle_id, round(stddev_pop(y) / nullif(avg(y), 0), 6) as cv from points group by 1",
    "x_covered": P
    + """, o as (select vehicle_id, max(x_cents) - min(x_cents) as covered from points group by 1)
    select vehicle_id, covered, round(covered / cast((select max(x_cents) - min(x_cents) from points) as double), 6) as share from o""",
    "frame_match_error": P
    + f""", a as (select vehicle_id, floor(t / {6.0 * H}) as f, avg(x_cents) as x, avg(y) as y, avg(x_cents) filter (conf >= 0.5) as x2, avg(y) filter (conf >= 0.5) as y2 from points group by 1, 2)
    select vehicle_id, round(avg(sqrt((x - x2) * (x - x2) + (y - y2) * (y - y2))), 4) as correction, count(*) as n from a where x2 is not null group by 1""",
    "r2": P + " select direction, round(regr_r2(y, conf), 6) as r2, round(regr_slope(y, conf), 6) as slope from points group by 1",
    "ids_fgmt": P
    + """, m as (select vehicle_id, (vehicle_id // 7) * 100 + fragment_id % 3 as t from fragments)
    select cast((select sum(k - 1) from (select count(distinct vehicle_id) as k from m group by t)) as bigint) as ids, cast((select sum(k - 1) from (select count(distinct t) as k from m group by vehicle_id)) as bigint) as fgmt""",
    "merge_stage_eval": P
    + SCORES
    + """, mem as (select vehicle_id as set_id, fragment_id as member from fragments),
    mean as (select set_id, avg(rotation) as rotation, avg(acceleration) as acceleration, avg(backward) as backward, count(*) as n_members from mem join scores on fragment_id = member group by 1),
    outer_ as (select m.set_id, e.other, max(e.seconds) as s from mem m join each e on e.id = m.member
      where not exists (select 1 from mem k where k.set_id = m.set_id and k.member = e.other) group by 1, 2),
    worst as (select set_id, max(s) as most_conflict, count(*) as n_conflicts from outer_ group by 1)
    select mean.set_id, n_members, round(rotation, 6) as rotation, round(acceleration, 6) as acceleration, round(backward, 6) as backward,
    round(coalesce(most_conflict, 0), 6) as most_conflict, coalesce(n_conflicts, 0) as n_conflicts from mean left join worst using (set_id)""",
    "conflict_graph_edges": P
    + CROWD
    + f""", dur as (select fragment_id as id, cast(last_t - first_t as double) / {H} as d from fragments where last_t > first_t),
    w as (select e.id as u, e.other as v, seconds / d as weight from each e join dur using (id) where exists (select 1 from dur x where x.id = e.other))
    select u, v, round(weight, 6) as weight from w qualify row_number() over (partition by least(u, v), greatest(u, v) order by weight desc, v > u desc) = 1""",
    "valid_tracks": P
    + f""", k as (select fragment_id, floor(min(t) / {1.0 * H}) as a, floor(max(t) / {1.0 * H}) as z, min(x_cents) as lo, max(x_cents) as hi from points group by 1),
    v as (select min(lo) as lo0, max(hi) as hi0, min(a) as a0, max(z) as z0 from k)
    select fragment_id, hi - lo > 0.02 * (hi0 - lo0) or a <= a0 + 2 or z >= z0 - 2 as valid from k, v""",
    "dashboard_ratio": P
    + """, o as (select direction, count(*)::double as tracks, sum(n)::double as samples, max(n)::double as longest from fragments group by 1),
    u as (unpivot o on tracks, samples, longest into name metric value v)
    select a.metric, round(a.v / greatest(a.v, b.v), 6) as a, round(b.v / greatest(a.v, b.v), 6) as b from u a join u b on a.metric = b.metric and a.direction = 1 and b.direction = -1""",
    "pie_shares": P + " select compute_node_id, count(*) as n, round(count(*) / cast(sum(count(*)) over () as double), 6) as share from fragments group by 1",
    "best_run": P + " select compute_node_id, max(n) as best, arg_max(n, last_t) as latest from fragments group by 1",
    "bounding_extents": P + " select round(min(x), 6) as min_x, round(max(x + length), 6) as max_x, round(min(y - width / 2), 6) as min_y, round(max(y + width / 2), 6) as max_y from ho",
    "metric_registry": P + " select vehicle_id, round(avg(y), 6) as mean_y, count(*) as samples, round(avg(conf), 6) as mean_conf from points group by 1",
}
