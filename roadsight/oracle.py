"""Reference SQL for every registered query, runnable by DuckDB over the same
Parquet tables (views ``events`` etc.).  It restates the fixture rules and each
operator's semantics in plain SQL; it is the correctness check, not an engine.

Floating results are rounded to a fixed number of digits on both sides.  Double
constants are written with an exponent so both engines read them as DOUBLE.
"""

from __future__ import annotations

from .functions.exact import SCALE as EXACT_SCALE
from .functions.geometry import METRES_PER_UNIT, road_homography, sql_double as d
from .operators.tracking import (DIR_WINDOW, DT_MIN, EMA_ALPHA, EMA_HISTORY,
                                 KMH_PER_MPS, WRONG_WAY_UNITS, SESSION_START)
from .operators.zones import ROUNDS as ZONE_ROUNDS, SEED as ZONE_SEED
from .queries_params import DEMO_SELECTION, ROLLUP_ADDED, ROLLUP_CHANGED, ROLLUP_DROPPED
from .sources.fixtures import (FIXTURE_CAMERAS, FIXTURE_FIRST_START, FIXTURE_FPS, FIXTURE_ROADS_PX, camera_map,
                               FIXTURE_SESSION_DAYS, FIXTURE_SESSION_OFFSET, FIXTURE_SESSIONS)

SPEED_DIGITS = 4
AVG_DIGITS = 6

VIOLATIONS = f"""
select printf('%08d', event_id) as Violation_ID,
       case when event_id % 101 = 0 then null else ts end as Timestamp,
       case when user_id % 37 = 5 then null
            else cast(user_id % 50 - 25 as double) / 100e0 end as Latitude,
       case when user_id % 37 = 6 then null
            else cast(8000 + (user_id * 7) % 60 as double) / 100e0 end as Longitude,
       event_type as Violation_Type,
       case user_id % 4 when 0 then 'car' when 1 then 'truck'
                        when 2 then 'bus' else 'motorcycle' end as Vehicle_Type,
       cast(case when value <= 50e0 then 0
                 when (value - 50e0) / 50e0 * 100e0 < 10e0 then 1
                 when (value - 50e0) / 50e0 * 100e0 < 20e0 then 2
                 when (value - 50e0) / 50e0 * 100e0 < 30e0 then 3
                 when (value - 50e0) / 50e0 * 100e0 < 40e0 then 4
                 else 5 end as integer) as Severity
from events
"""

FEATURES = """
select *,
       cast(hour(Timestamp) as integer) as hour,
       strftime(Timestamp, '%a') as day_of_week,
       cast(month(Timestamp) as integer) as month,
       cast(year(Timestamp) as integer) as year,
       strftime(Timestamp, '%a') as weekday,
       case when strftime(Timestamp, '%a') in ('Sat', 'Sun') then 'Weekend'
            else 'Weekday' end as day_type,
       cast(trunc(hour(Timestamp) / 3) as integer) * 3 as hour_window,
       try_cast(trunc(Latitude * 10e0) as integer) as lat_bin,
       try_cast(trunc(Longitude * 10e0) as integer) as lon_bin
from v
"""

GRID = "select *, concat_ws('_', lat_bin, lon_bin) as grid_cell from f0"


def with_fact(body: str) -> str:
    """Prefix the fact CTEs: v (violations), f (features + grid)."""
    return f"with v as ({VIOLATIONS}), f0 as ({FEATURES}), f as ({GRID})\n{body}"


def selection_sql(sel=DEMO_SELECTION, types=True, sev=True, dates=True) -> str:
    preds = ["true"]
    if types and sel.types:
        preds.append("Violation_Type in (" + ", ".join(f"'{t}'" for t in sel.types) + ")")
    if sev and sel.severities:
        preds.append("Severity in (" + ", ".join(str(int(s)) for s in sel.severities) + ")")
    if dates and sel.date_range:
        s, e = sel.date_range
        preds.append(f"Timestamp >= TIMESTAMP '{s.isoformat()} 00:00:00'")
        preds.append(f"Timestamp <= TIMESTAMP '{e.isoformat()} 00:00:00'"
                     " + INTERVAL 1 DAY - INTERVAL 1 SECOND")
    return " and ".join(preds)


def exact_mean(c: str) -> str:
    """The mean of doubles as an exact sum of multiples of 2^-40."""
    return f"cast(sum(cast(floor({c} * {d(EXACT_SCALE)} + 0.5e0) as hugeint)) // count({c}) as double) / {d(EXACT_SCALE)}"


VALID = ("Latitude is not null and Longitude is not null "
         "and Latitude <> 0 and Longitude <> 0")


def _count(keys: str, where: str = "true") -> str:
    return with_fact(f"select {keys}, count(*) as total_violations from f "
                     f"where {where} group by {keys}")


def _matrix(row_expr: str, row_alias: str, col: str, values) -> str:
    cells = ", ".join(f'count(*) filter (where {col} = {v}) as "{v}"' for v in values)
    return with_fact(f"select {row_expr} as {row_alias}, {cells}, "
                     f'count(*) filter (where {col} is null) as "null" '
                     f"from f group by {row_expr}")


def _grid_stats() -> str:
    return (f"select grid_cell, count(*) as total_violations, "
            f"{exact_mean('Latitude')} as avg_lat, "
            f"{exact_mean('Longitude')} as avg_lon from f group by grid_cell")


def fact_queries() -> dict[str, str]:
    sel_all = selection_sql()
    q = {
        "record_count": with_fact("select count(*) as record_count from f"),
        "clean_violations": with_fact(
            "select distinct Violation_ID, Timestamp, Latitude, Longitude, Violation_Type, "
            "Vehicle_Type, Severity from f where Violation_ID is not null"),
        "time_features": with_fact(
            "select Violation_ID, Timestamp, hour, day_of_week, month, year, weekday, "
            "day_type, hour_window from f"),
        "grid_features": with_fact(
            "select Violation_ID, Latitude, Longitude, lat_bin, lon_bin, grid_cell from f"),
        "violations_per_hour": _count("hour"),
        "violations_per_day": _count("day_of_week"),
        "violations_by_type": _count("Violation_Type"),
        "type_hour_matrix": _matrix("coalesce(Violation_Type, 'null')", "Violation_Type_hour",
                                    "hour", range(24)),
        "violations_per_location": _count("Latitude, Longitude"),
        "top_locations": with_fact(
            "select Latitude, Longitude, count(*) as total_violations from f "
            "group by Latitude, Longitude "
            "order by total_violations desc, Latitude asc nulls first, "
            "Longitude asc nulls first limit 10"),
        "violations_by_window": _count("hour_window"),
        "violations_by_daytype": _count("day_type"),
        "violations_type_time": _count("Violation_Type, hour_window"),
        "grid_stats": with_fact(_grid_stats()),
        "top_hotspots": with_fact(
            f"select * from ({_grid_stats()}) "
            "order by total_violations desc, grid_cell asc nulls first limit 10"),
        "type_window_matrix": _matrix("Violation_Type", "Violation_Type", "hour_window",
                                      range(0, 24, 3)),
        "top_types": with_fact(
            "select Violation_Type, count(*) as total_violations from f group by Violation_Type "
            "order by total_violations desc, Violation_Type asc nulls first limit 15"),
        "filter_by_type": with_fact(
            f"select Violation_ID, Timestamp, Latitude, Longitude, Violation_Type, Vehicle_Type, "
            f"Severity from f where {selection_sql(sev=False, dates=False)}"),
        "filter_by_severity": with_fact(
            f"select Violation_ID, Timestamp, Latitude, Longitude, Violation_Type, Vehicle_Type, "
            f"Severity from f where {selection_sql(types=False, dates=False)}"),
        "filter_by_date": with_fact(
            f"select Violation_ID, Timestamp, Latitude, Longitude, Violation_Type, Vehicle_Type, "
            f"Severity from f where {selection_sql(types=False, sev=False)}"),
        "filter_combined": with_fact(
            f"select Violation_ID, Timestamp, Latitude, Longitude, Violation_Type, Vehicle_Type, "
            f"Severity from f where {sel_all}"),
        "valid_coordinates": with_fact(
            f"select Violation_ID, Latitude, Longitude from f where {VALID}"),
        "hourly_filtered": _count("hour", selection_sql(sev=False, dates=False)),
        "hotspot_locations": _count("Latitude, Longitude", f"{sel_all} and {VALID}"),
        "top_hotspot_locations": with_fact(
            f"select Latitude, Longitude, count(*) as total_violations from f "
            f"where {sel_all} and {VALID} group by Latitude, Longitude "
            "order by total_violations desc, Latitude, Longitude limit 10"),
        "map_center": with_fact(
            f"select {exact_mean('Latitude')} as mid_lat, "
            f"{exact_mean('Longitude')} as mid_lon from "
            f"(select Latitude, Longitude from f where {sel_all} and {VALID} "
            "group by Latitude, Longitude)"),
        "map_points": with_fact(
            f"select Latitude as lat, Longitude as lon, count(*) as total_violations from f "
            f"where {sel_all} and {VALID} group by Latitude, Longitude "
            "order by Latitude, Longitude limit 1000"),
        "kpi_summary": with_fact(
            f"""select cast(coalesce(sum(n), 0) as bigint) as total_violations,
                       count(*) as unique_types,
                       coalesce(first(Violation_Type order by n desc,
                                      Violation_Type asc nulls first), 'N/A')
                           as most_common_type,
                       cast(coalesce(sum(high), 0) as bigint) as high_severity
                from (select Violation_Type, count(*) as n,
                             count(*) filter (where Severity >= 4) as high
                      from f where {sel_all} group by Violation_Type)"""),
        "filter_options_types": with_fact(
            "select distinct Violation_Type from f where Violation_Type is not null"),
        "filter_options_severity": with_fact(
            "select distinct Severity from f where Severity is not null"),
        "filter_options_dates": with_fact(
            "select cast(min(Timestamp) as date) as min_date, "
            "cast(max(Timestamp) as date) as max_date from f"),
        "filtered_sample": with_fact(
            f"select Violation_ID, Timestamp, Latitude, Longitude, Violation_Type, Vehicle_Type, "
            f"Severity from f where {sel_all} order by Violation_ID nulls first, "
            "Timestamp nulls first, Latitude nulls first, Longitude nulls first, "
            "Violation_Type nulls first, Vehicle_Type nulls first, Severity nulls first "
            "limit 200"),
        "report_summary": with_fact(
            f"select (select count(*) from f) as records_analyzed, * from ({_grid_stats()}) "
            "order by total_violations desc, grid_cell asc nulls first limit 5"),
    }
    return q




# ---------------------------------------------------------------- tracking --

def _cams_sql(sessions: int = 0) -> str:
    """One setting per camera (session 0), or per session and camera."""
    spot = FIXTURE_CAMERAS[0]
    first = FIXTURE_FIRST_START if sessions else SESSION_START
    rows = ", ".join(
        f"({c}, {d(spot[1] if sessions and c == 1 else lat)}, "
        f"{d(spot[2] if sessions and c == 1 else lon)}, {d(lim + n)}, {'true' if pos else 'false'}, "
        f"{n}, TIMESTAMP '{first.isoformat(sep=' ')}' + INTERVAL {n * FIXTURE_SESSION_DAYS} DAY)"
        for n in range(max(1, sessions)) for c, lat, lon, lim, pos in FIXTURE_CAMERAS)
    return (f"select * from (values {rows}) as c(camera_id, latitude, longitude, "
            "speed_limit_kmh, flow_positive_y, session_id, session_start)")


def _detections_sql(sessions: int = 0) -> str:
    n = max(1, sessions)
    return f"""
select cast(user_id % 4 as integer) as camera_id, user_id as track_id,
       cast(f as integer) as frame_idx,
       cast(f as double) / {d(FIXTURE_FPS)} + session_id * {d(FIXTURE_SESSION_OFFSET)} as t_sec,
       event_id as det_idx,
       case user_id % 5 when 0 then 'car' when 1 then 'truck' when 2 then 'bus'
                        when 3 then 'motorcycle' else 'person' end as class_name,
       900 as x1, cast(1000 + user_id % 50 as integer) as x2,
       cast(case when user_id % 7 = 0 then 800 - f * (1 + user_id % 9) - event_id % 3
                 else 200 + f * (1 + user_id % 9) + event_id % 3 end as integer) as y2,
       session_id
from (select *, event_id % {n} as session_id,
             row_number() over (partition by user_id, event_id % {n} order by event_id) - 1 as f
      from events where user_id is not null) b
"""


def _camera_maps() -> list[str]:
    """The coefficients of each row's camera; null for a camera without a map."""
    maps = {c: camera_map(c) for c, road in FIXTURE_ROADS_PX.items() if len(road) == 4}
    return ["case camera_id " + " ".join(f"when {c} then {d(m[i])}" for c, m in maps.items()) + " end" for i in range(8)]


def _tracking_ctes(sessions: int = 0, detections: str | None = None, cameras: str | None = None, m: list[str] | None = None) -> str:
    m = m or [d(v) for v in road_homography()]
    den = f"({m[6]} * bx + {m[7]} * \"by\" + 1e0)"
    w_s = "partition by session_id, camera_id, track_id order by frame_idx, det_idx"
    w_st = "partition by session_id, camera_id, track_id order by step_no"
    return f"""
det as ({detections or _detections_sql(sessions)}),
cams as ({cameras or _cams_sql(sessions)}),
veh as (select * from det where class_name in ('car', 'truck', 'bus', 'motorcycle')
        and camera_id is not null and track_id is not null and frame_idx is not null),
enr as (select veh.*, cams.latitude, cams.longitude, cams.speed_limit_kmh, cams.flow_positive_y,
               cams.session_start
        from veh join cams using (session_id, camera_id)),
s0 as (select *, cast(trunc((x1 + x2) / 2) as integer) as bx, y2 as "by",
              case when flow_positive_y then 1e0 else -1e0 end as flow_sign from enr),
s as (select *, ({m[0]} * bx + {m[1]} * "by" + {m[2]}) / {den} as tx,
                ({m[3]} * bx + {m[4]} * "by" + {m[5]}) / {den} as ty from s0),
l as (select *, lag(tx) over (w) as ptx, lag(ty) over (w) as pty, lag(t_sec) over (w) as pt,
             lag(t_sec) over (w) is not null or lag(frame_idx) over (w) is not null as has_prev
      from s window w as ({w_s})),
st0 as (select *, t_sec - pt as dt, tx - ptx as dx, ty - pty as dy from l
        where has_prev and t_sec - pt > {d(DT_MIN)}),
st1 as (select *, sqrt(dx * dx + dy * dy) * {d(METRES_PER_UNIT)} as dist_m,
               row_number() over ({w_s}) as step_no from st0),
st as (select *, dist_m / dt * {d(KMH_PER_MPS)} as raw_kmh from st1),
sm0 as (select *,
          list_reduce(list(raw_kmh) over w15,
                      lambda acc, x: {d(EMA_ALPHA)} * x + {d(1 - EMA_ALPHA)} * acc, 0e0)
            as smooth_kmh,
          sum(dy) over wd as net_dy
        from st window w15 as ({w_st} rows between {EMA_HISTORY - 1} preceding and current row),
                       wd as ({w_st} rows between {DIR_WINDOW - 1} preceding and current row)),
sm as (select *, net_dy * flow_sign < -{d(WRONG_WAY_UNITS)} as is_wrong_way,
              smooth_kmh > speed_limit_kmh as is_speeding from sm0),
fh as (select session_id, camera_id, track_id,
              min(step_no) filter (where is_wrong_way) as wstep,
              min(step_no) filter (where is_speeding) as vstep
       from sm group by session_id, camera_id, track_id),
ww as (select sm.*, 'Wrong Way' as Violation_Type, 5 as Severity, 0 as kr
       from sm join fh using (session_id, camera_id, track_id) where sm.step_no = fh.wstep),
vv as (select sm.*, 'Speeding' as Violation_Type,
              cast(case when smooth_kmh <= speed_limit_kmh then 0
                        when (smooth_kmh - speed_limit_kmh) / speed_limit_kmh * 100e0 < 10e0 then 1
                        when (smooth_kmh - speed_limit_kmh) / speed_limit_kmh * 100e0 < 20e0 then 2
                        when (smooth_kmh - speed_limit_kmh) / speed_limit_kmh * 100e0 < 30e0 then 3
                        when (smooth_kmh - speed_limit_kmh) / speed_limit_kmh * 100e0 < 40e0 then 4
                        else 5 end as integer) as Severity, 1 as kr
       from sm join fh using (session_id, camera_id, track_id) where sm.step_no = fh.vstep),
ev as (select * from ww union all select * from vv),
logv as (select printf('%s%04d', case when kr = 0 then 'W' else 'V' end,
                       row_number() over (partition by session_id, camera_id
                                          order by frame_idx, det_idx, kr)) as Violation_ID,
                session_start + to_seconds(cast(floor(t_sec) as bigint)) as Timestamp,
                latitude as Latitude, longitude as Longitude, Violation_Type,
                class_name as Vehicle_Type, Severity, camera_id, track_id, session_id
         from ev)"""


def with_tracks(body: str, sessions: int = 0) -> str:
    return f"with {_tracking_ctes(sessions)}\n{body}"


def _long_track_sql() -> str:
    """All events as the sightings of one track, one frame each."""
    return f"""
select 0 as camera_id, cast(1 as bigint) as track_id, cast(f as integer) as frame_idx,
       cast(f as double) / {d(FIXTURE_FPS)} as t_sec, event_id as det_idx, 'car' as class_name,
       900 as x1, 1000 as x2,
       cast(200 + abs((f * 2) % 1600 - 800) + event_id % 3 as integer) as y2, cast(0 as bigint) as session_id
from (select event_id, row_number() over (order by event_id) - 1 as f from events) b
"""


R = SPEED_DIGITS
_HIT_COLS = (f"camera_id, track_id, Violation_Type, step_no, frame_idx, det_idx, t_sec, "
             f"class_name, round(smooth_kmh, {R}) as smooth_kmh, latitude, longitude, "
             f"speed_limit_kmh, Severity")


def tracking_queries() -> dict[str, str]:
    k = "camera_id, track_id, frame_idx, det_idx"
    own = _tracking_ctes(m=_camera_maps())
    return {
        "calibrated_topdown": f"with {own} select {k}, round(tx, {R}) as tx, round(ty, {R}) as ty from s",
        "calibrated_violations": "with " + own.replace("from s window w", "from (select * from s where tx is not null) s window w")
                                 + " select * exclude (session_id) from logv",
        "detections_scan": with_tracks("select * exclude (session_id) from det"),
        "vehicle_detections": with_tracks(
            "select camera_id, track_id, frame_idx, t_sec, det_idx, class_name, x1, x2, y2 "
            "from veh"),
        "camera_enriched": with_tracks(
            "select camera_id, track_id, frame_idx, t_sec, det_idx, class_name, x1, x2, y2, "
            "latitude, longitude, speed_limit_kmh, flow_positive_y from enr"),
        "bottom_center": with_tracks(f'select {k}, bx, "by" from s'),
        "topdown_positions": with_tracks(
            f"select {k}, round(tx, {R}) as tx, round(ty, {R}) as ty from s"),
        "track_steps": with_tracks(
            f"select {k}, step_no, round(dt, {R}) as dt, round(dx, {R}) as dx, "
            f"round(dy, {R}) as dy from st"),
        "raw_speed": with_tracks(
            f"select {k}, step_no, round(dist_m, {R}) as dist_m, "
            f"round(raw_kmh, {R}) as raw_kmh from st"),
        "smoothed_speed": with_tracks(
            f"select {k}, step_no, round(smooth_kmh, {R}) as smooth_kmh from sm"),
        "net_direction": with_tracks(
            f"select {k}, step_no, round(net_dy, {R}) as net_dy, is_wrong_way from sm"),
        "severity_score": with_tracks(
            f"""select {k}, step_no, round(smooth_kmh, {R}) as smooth_kmh,
                cast(case when smooth_kmh <= speed_limit_kmh then 0
                     when (smooth_kmh - speed_limit_kmh) / speed_limit_kmh * 100e0 < 10e0 then 1
                     when (smooth_kmh - speed_limit_kmh) / speed_limit_kmh * 100e0 < 20e0 then 2
                     when (smooth_kmh - speed_limit_kmh) / speed_limit_kmh * 100e0 < 30e0 then 3
                     when (smooth_kmh - speed_limit_kmh) / speed_limit_kmh * 100e0 < 40e0 then 4
                     else 5 end as integer) as severity from sm"""),
        "speeding_violations": with_tracks(f"select {_HIT_COLS} from vv"),
        "wrong_way_violations": with_tracks(f"select {_HIT_COLS} from ww"),
        "violation_log": with_tracks("select * exclude (session_id) from logv"),
        "violation_log_sessions": with_tracks("select * from logv", FIXTURE_SESSIONS),
        "frame_logs_scan": with_tracks("select * replace (round(t_sec, 6) as t_sec) from det", FIXTURE_SESSIONS),
        "frame_logs_stream": with_tracks("select * from logv", FIXTURE_SESSIONS),
        "stream_log_numbered": with_tracks("select * from logv", FIXTURE_SESSIONS),
        "stream_violations_ended": with_tracks(
            """select session_id, camera_id, cast(count(distinct track_id) as bigint) as held_first, cast(0 as bigint) as held_last,
                      cast(coalesce(any_value(n), 0) as bigint) as hits
               from veh left join (select session_id, camera_id, count(*) as n from ev group by session_id, camera_id) e using (session_id, camera_id)
               group by session_id, camera_id""", FIXTURE_SESSIONS),
        "stream_violations_multi": with_tracks("select * from logv", FIXTURE_SESSIONS),
        "session_hotspots": with_tracks(
            f"select grid_cell, count(*) as total_violations, {exact_mean('Latitude')} as avg_lat, "
            f"{exact_mean('Longitude')} as avg_lon from (select *, "
            f"concat_ws('_', try_cast(trunc(Latitude * 10e0) as integer), "
            f"try_cast(trunc(Longitude * 10e0) as integer)) as grid_cell from logv) group by grid_cell",
            FIXTURE_SESSIONS),
        "long_track_states": f"""with {_tracking_ctes(0, _long_track_sql())}
            select {k}, step_no, round(smooth_kmh, {R}) as smooth_kmh, round(net_dy, {R}) as net_dy,
                   wrong_so_far from (select sm.*, coalesce(sm.step_no >= fh.wstep, false) as wrong_so_far
                   from sm join fh using (session_id, camera_id, track_id))""",
        "stream_violations": with_tracks(
            f"select {_HIT_COLS} from ww union all select {_HIT_COLS} from vv"),
        "annotated_tracks": with_tracks(
            f"""select {k}, step_no, wrong_so_far, wrong_so_far or is_speeding as flag,
                       printf('ID %d: %.1f km/h', track_id, smooth_kmh)
                         || case when wrong_so_far then ' (WRONG)' else '' end as label
                from (select sm.*, coalesce(sm.step_no >= fh.wstep, false) as wrong_so_far
                      from sm join fh using (session_id, camera_id, track_id))"""),
    }


def _zones_sql(body: str, k: int = 5, starts: int = 10) -> str:
    """Exact K-Means of the places, step by step; a round in which nothing
    moves changes nothing, so all of them are run."""
    hexed = lambda i: f"(strpos('0123456789abcdef', substr(h, {i}, 1)) - 1)"
    near = "(p.a - c.a) * (p.a - c.a) + (p.o - c.o) * (p.o - c.o)"
    steps = [f"""pts as (select Latitude, Longitude, cast(floor(Latitude * 1e6 + 0.5e0) as bigint) as a, cast(floor(Longitude * 1e6 + 0.5e0) as bigint) as o
        from f where Latitude is not null and Longitude is not null),
    p as materialized (select a, o, count(*) as w from pts group by a, o),
    seed0 as materialized (select s, cast(0 as bigint) as n, a, o from (
        select s, a, o, row_number() over (partition by s order by sha256(concat_ws(':', s + {ZONE_SEED}, 0, a, o)), a, o) as r
        from p, range({starts}) as t(s)) x where r = 1)"""]
    for t in range(1, k):
        steps.append(f"""near{t} as materialized (select s, p.a, p.o, p.w, min({near}) as d from p, seed{t - 1} c group by s, p.a, p.o, p.w),
    seed{t} as materialized (select * from seed{t - 1} union all select s, {t}, a, o from (
        select s, a, o, row_number() over (partition by s order by cast(d as hugeint) * (1 + {hexed(1)} * 4096 + {hexed(2)} * 256 + {hexed(3)} * 16 + {hexed(4)}) * w desc, a, o) as r
        from (select *, sha256(concat_ws(':', s + {ZONE_SEED}, {t}, a, o)) as h from near{t} where d > 0) y) x where r = 1)""")
    floor_ = lambda c: f"cast((sum(p.{c} * w) - ((sum(p.{c} * w) % sum(w)) + sum(w)) % sum(w)) // sum(w) as bigint)"
    steps.append(f"c0 as (select * from seed{k - 1})")
    for r in range(ZONE_ROUNDS + 1):
        steps.append(f"""m{r} as materialized (select c.s, p.a, p.o, p.w, min({near}) as d, arg_min(c.n, ({near}, c.n)) as n from p, c{r} c group by c.s, p.a, p.o, p.w)""")
        if r < ZONE_ROUNDS:
            steps.append(f"""c{r + 1} as materialized (select c.s, c.n, coalesce(x.a, c.a) as a, coalesce(x.o, c.o) as o from c{r} c left join (
        select s, n, {floor_('a')} as a, {floor_('o')} as o from m{r} p group by s, n) x on x.s = c.s and x.n = c.n)""")
    steps.append(f"""cost as (select s, sum(cast(d as hugeint) * w) as cost from m{ZONE_ROUNDS} group by s),
    z as materialized (select row_number() over (order by a, o) - 1 as cluster, a, o from c{ZONE_ROUNDS} where s = (select arg_min(s, (cost, s)) from cost))""")
    return with_fact("select 1").removesuffix("\nselect 1") + ", " + ",\n    ".join(steps) + "\n" + body


def io_queries() -> dict[str, str]:
    m1 = "Violation_ID, Timestamp, Latitude, Longitude, Violation_Type, Vehicle_Type, Severity"
    sel = selection_sql()

    def text_ts(fmt):
        return (f"select Violation_ID, strftime(Timestamp, '{fmt}') as Timestamp, Latitude, "
                f"Longitude, Violation_Type, Vehicle_Type, Severity from f where {sel}")

    def mart(name, inner, total="total_violations"):
        return (f"select '{name}' as mart, count(*) as rows, "
                f"cast(coalesce(sum({total}), 0) as bigint) as total from ({inner})")

    grp = "select {k}, count(*) as total_violations from f group by {k}"
    top = (grp.format(k="Latitude, Longitude") + " order by total_violations desc, "
           "Latitude nulls first, Longitude nulls first limit 10")
    marts = [
        mart("all_locations", grp.format(k="Latitude, Longitude")),
        mart("daily", grp.format(k="day_of_week")),
        mart("daytype", grp.format(k="day_type")),
        mart("hourly", grp.format(k="hour")),
        mart("spatial_grid", grp.format(k="grid_cell")),
        mart("time_window", grp.format(k="hour_window")),
        mart("top_locations", top),
        mart("type_hour_matrix", grp.format(k="coalesce(Violation_Type, 'null')")),
        mart("type_summary", grp.format(k="Violation_Type")),
        mart("type_time", grp.format(k="Violation_Type, hour_window")),
    ]
    log_order = ", ".join(f"\"{c}\" desc nulls last" for c in
                          ("Timestamp", "Violation_ID", "Latitude", "Longitude",
                           "Violation_Type", "Vehicle_Type", "Severity"))
    hot = (f"select grid_cell, count(*) as total_violations, "
           f"{exact_mean('Latitude')} as avg_lat, "
           f"{exact_mean('Longitude')} as avg_lon from "
           f"(select *, concat_ws('_', try_cast(trunc(Latitude * 10e0) as integer), "
           f"try_cast(trunc(Longitude * 10e0) as integer)) as grid_cell "
           f"from (select distinct {m1}, camera_id, track_id from logv where Violation_ID is not null)) "
           f"group by grid_cell")
    group = "user_id % 5"
    separated = (f"select 10e0 * ({group}) + (event_id % 7) * 1e-3 as Latitude, "
                 f"100e0 - 15e0 * ({group}) + (event_id % 11) * 1e-3 as Longitude, cast({group} as integer) as cluster "
                 f"from events where user_id is not null")
    return {
        "kmeans_centers": _zones_sql("select cast(cluster as integer) as cluster, a / 1e6 as Latitude, o / 1e6 as Longitude from z"),
        "kmeans_clusters": _zones_sql("""select Latitude, Longitude, cast(arg_min(cluster, ((pts.a - z.a) * (pts.a - z.a) + (pts.o - z.o) * (pts.o - z.o), cluster)) as integer) as cluster
            from (select *, row_number() over () as r from pts) pts, z group by r, Latitude, Longitude"""),
        "kmeans_separated": f"""select cluster, count(*) as points,
            round(avg(Latitude), {AVG_DIGITS}) as center_lat, round(avg(Longitude), {AVG_DIGITS}) as center_lon
            from ({separated}) group by cluster""",
        "valid_coordinates_nan": with_fact(
            "select Violation_ID, Latitude, Longitude from v where Violation_ID is not null "
            "and Latitude is not null and Longitude is not null and Latitude <> 0 and Longitude <> 0 "
            "and cast(Violation_ID as bigint) % 13 <> 0"),
        "mart_values": with_fact(f"""
            select 'hourly' as mart, cast(hour as varchar) as key, total_violations, cast(row_number() over (
                     order by hour nulls first) as integer) as place
              from ({grp.format(k="hour")})
            union all select 'daily', day_of_week, total_violations, row_number() over (
                     order by day_of_week nulls first) from ({grp.format(k="day_of_week")})
            union all select 'type_summary', Violation_Type, total_violations, row_number() over (
                     order by total_violations desc, Violation_Type nulls first) from ({grp.format(k="Violation_Type")})
            union all select 'time_window', cast(hour_window as varchar), total_violations, row_number() over (
                     order by hour_window nulls first) from ({grp.format(k="hour_window")})
            union all select 'daytype', day_type, total_violations, row_number() over (order by day_type)
              from ({grp.format(k="day_type")})
            union all select 'type_time', concat_ws('|', Violation_Type, hour_window), total_violations,
                     row_number() over (order by Violation_Type nulls first, hour_window nulls first)
              from ({grp.format(k="Violation_Type, hour_window")})
            union all select 'spatial_grid', grid_cell, total_violations, row_number() over (
                     order by total_violations desc, grid_cell nulls first) from ({grp.format(k="grid_cell")})
            union all select 'all_locations', concat_ws('|', round(Latitude, 2), round(Longitude, 2)), total_violations,
                     row_number() over (order by total_violations desc, Latitude nulls first, Longitude nulls first)
              from ({grp.format(k="Latitude, Longitude")})
            union all select 'top_locations', concat_ws('|', round(Latitude, 2), round(Longitude, 2)), total_violations,
                     row_number() over (order by total_violations desc, Latitude nulls first, Longitude nulls first)
              from ({top})"""),
        "ingest_csv_roundtrip": with_fact(f"select {m1} from v"),
        "mart_roundtrip": with_fact(" union all ".join(marts)),
        "export_summaries_roundtrip": f"""
            select 'top_locations_data' as summary, concat_ws('|', round(Latitude, 2), round(Longitude, 2)) as key,
                   total_violations from ({fact_queries()["top_hotspot_locations"]})
            union all select 'violation_type_summary', coalesce(Violation_Type, ''), count(*)
                from ({with_fact(f"select Violation_Type from f where {sel}")}) group by Violation_Type
            union all select 'hourly_summary', coalesce(cast(hour as varchar), ''), count(*)
                from ({with_fact(f"select hour from f where {sel}")}) group by hour""",
        "export_csv_roundtrip": with_fact(text_ts("%Y-%m-%d %H:%M:%S.%f")),
        "export_json_roundtrip": with_fact(text_ts("%Y-%m-%dT%H:%M:%S.%g")),
        "log_tail10": with_tracks(f"select {m1} from logv order by {log_order} limit 10"),
        "violation_hotspots": with_tracks(hot),
        "fact_partitioned_roundtrip": with_fact(
            f"select distinct {m1} from f where Violation_ID is not null and "
            f"{selection_sql(types=False, sev=False)}"),
    }


# --------------------------------------------------------------- roll-up --

def _rolled(body: str) -> str:
    """The fact after the roll-up queries' changes: one date is gone."""
    kept = f"select * from ({VIOLATIONS}) where Timestamp is null or cast(Timestamp as date) <> DATE '{ROLLUP_DROPPED}'"
    return f"with v as ({kept}), f0 as ({FEATURES}), f as ({GRID})\n{body}"


def rollup_queries() -> dict[str, str]:
    direct, sel = fact_queries(), selection_sql()

    def after(name: str) -> str:
        """A fact query's own SQL over the changed fact."""
        return _rolled(direct[name].removeprefix(with_fact("")))

    def summary(name: str, key: str, inner: str) -> str:
        return f"select '{name}' as summary, {key} as key, total_violations from ({inner})"

    places = (f"select Latitude, Longitude, count(*) as total_violations from f where {sel} and {VALID} group by Latitude, Longitude "
              "order by total_violations desc, Latitude, Longitude limit 10")
    cells = ", ".join(f'count(*) filter (where hour_window = {w}) as "{w}"' for w in range(0, 24, 3))
    return {
        "rollup_kpi_summary": after("kpi_summary"),
        "rollup_hourly": _rolled(f"select hour, count(*) as total_violations from f where {sel} group by hour"),
        "rollup_types": _rolled(f"select Violation_Type, count(*) as total_violations from f where {sel} group by Violation_Type"),
        "rollup_type_time": _rolled(f"select Violation_Type, hour_window, count(*) as total_violations from f where {sel} group by Violation_Type, hour_window"),
        "rollup_heatmap": _rolled(f'select Violation_Type, {cells}, count(*) filter (where hour_window is null) as "null" from f where {sel} group by Violation_Type'),
        "rollup_hotspots": after("hotspot_locations"),
        "rollup_map_center": after("map_center"),
        "rollup_map_points": after("map_points"),
        "rollup_grid_stats": after("grid_stats"),
        "rollup_filter_options": _rolled(
            "select 'type' as option, Violation_Type as value from f where Violation_Type is not null group by Violation_Type "
            "union all select 'severity', cast(Severity as varchar) from f where Severity is not null group by Severity "
            "union all select 'from', cast(min(cast(Timestamp as date)) as varchar) from f union all select 'to', cast(max(cast(Timestamp as date)) as varchar) from f"),
        "rollup_summaries": _rolled(
            summary("top_locations_data", "concat_ws('|', round(Latitude, 2), round(Longitude, 2))", places) + " union all "
            + summary("violation_type_summary", "coalesce(Violation_Type, '')", f"select Violation_Type, count(*) as total_violations from f where {sel} group by Violation_Type")
            + " union all " + summary("hourly_summary", "coalesce(cast(hour as varchar), '')", f"select hour, count(*) as total_violations from f where {sel} group by hour")),
        "rollup_refresh_log": with_fact(f"""
            select event_date, case event_date when DATE '{ROLLUP_ADDED}' then 'added' when DATE '{ROLLUP_CHANGED}' then 'changed'
                   when DATE '{ROLLUP_DROPPED}' then 'deleted' else 'kept' end as action
            from (select distinct cast(Timestamp as date) as event_date from f)"""),
    }


def oracle_sql() -> dict[str, str]:
    out = fact_queries()
    out.update(tracking_queries())
    out.update(io_queries())
    out.update(rollup_queries())
    return out
