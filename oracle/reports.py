"""Oracle SQL for R-01..R-15 (plain and date-bounded) and Q-01..Q-09 (on the defect star and as loaded).

A second opinion, not a second star: answers come from one flat relation ``ev`` of the dated ODS rows
with their labels, on which a report is a single GROUP BY, and a check says what the injected
defects must lead to. No dimension or fact is rebuilt and no surrogate key joined.
"""

from __future__ import annotations

from oracle.blocks import BASE, DEPTH_BUCKET, FACT_KEYS, MAG_BUCKET, avg2, hundredths, norm, with_

BOUNDS = """bounds AS (SELECT CAST(min(ts) AS DATE) + 5 AS d_from, CAST(max(ts) AS DATE) - 5 AS d_to FROM events)"""

# Labels of an event, under the names that the reports give them.
_LABELS = {"region_name": "region", "place": "place", "mag_type": "mag_type", "mag_source": "mag_source", "net": "net",
           "location_source": "location_source", "status": "status", "event_type": "event_type"}
EV = f"""ev AS (SELECT id, event_time, CAST(event_time AS DATE) AS day, latitude, longitude, mag, depth,
    {', '.join(f'{norm(src)} AS {name}' for name, src in _LABELS.items())}
  FROM ods WHERE event_time IS NOT NULL)"""

_SIDES = {"both": ["d_from", "d_to"], "from": ["d_from"], "to": ["d_to"]}


def _report(columns: str, where: str = "", tail: str = "", ranged: bool | str = False) -> str:
    """One SELECT over the events ``f``, of the days in range if ``ranged`` ("both" bounds or True, "from", "to")."""
    ctes, tests = [*BASE, EV], [where] if where else []
    if ranged:
        ctes.append(BOUNDS)
        for side in _SIDES["both" if ranged is True else ranged]:
            tests.append(f"f.day {'>=' if side == 'd_from' else '<='} (SELECT {side} FROM bounds)")
    where = f" WHERE {' AND '.join(tests)}" if tests else ""
    return with_(ctes, f"SELECT {columns} FROM ev f{where} {tail}")


_COUNT, _AVG = "COUNT(*) AS events_cnt", f"{avg2('f.mag')} AS avg_mag"


def daily_events(ranged=False):
    return _report(f"day, {_COUNT}", tail="GROUP BY day", ranged=ranged)


def daily_events_ma7(ranged=False):
    week = "OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
    ma7 = hundredths(f"(SUM(COUNT(*)) {week} * 100)", f"(COUNT(*) {week})")
    return _report(f"day, {_COUNT}, {ma7} AS ma7", tail="GROUP BY day", ranged=ranged)


def top_regions(ranged=False):
    return _report(f"region_name, {_COUNT}, {_AVG}", ranged=ranged,
                   tail="GROUP BY region_name HAVING events_cnt >= 10 ORDER BY events_cnt DESC, region_name LIMIT 20")


def magnitude_distribution(ranged=False):
    return _report(f"{MAG_BUCKET} AS mag_bucket, {_COUNT}", "mag IS NOT NULL", "GROUP BY mag_bucket", ranged)


def depth_distribution(ranged=False):
    return _report(f"{DEPTH_BUCKET} AS depth_bucket, {_COUNT}", "depth IS NOT NULL", "GROUP BY depth_bucket", ranged)


def status_distribution(ranged=False):
    return _report(f"status, {_COUNT}", tail="GROUP BY status", ranged=ranged)


def _strong(ranged: bool | str, k: int) -> str:
    return _report("event_time, region_name, place, mag, depth, net, location_source, status, event_type", "mag >= 5",
                   f"ORDER BY f.event_time DESC, id DESC LIMIT {k}", ranged)


def recent_strong_events(ranged=False):
    return _strong(ranged, 100)


def recent_significant_events():
    return _strong(False, 200)


def map_points(ranged=False):
    return _report(f"latitude, longitude, region_name, {_COUNT}, {_AVG}", "latitude + longitude IS NOT NULL",
                   "GROUP BY latitude, longitude, region_name", ranged)


def heatmap_day_hour(ranged=False):
    return _report(f"CAST(isodow(event_time) AS INTEGER) AS day_of_week, CAST(hour(event_time) AS INTEGER) AS hour_utc, {_COUNT}",
                   tail="GROUP BY day_of_week, hour_utc", ranged=ranged)


def regions_intensity():
    return _report(f"region_name, {_COUNT}, {_AVG}, MAX(mag) AS max_mag, COUNT(CASE WHEN mag >= 5 THEN 1 END) AS events_mag_5_plus",
                   tail="GROUP BY region_name HAVING events_cnt >= 10 "
                        "ORDER BY events_cnt DESC, avg_mag DESC NULLS FIRST, region_name LIMIT 25")


def daily_trend():
    return _report(f"day, {_COUNT}, {_AVG}", tail="GROUP BY day")


def weekly_trend():
    return _report(f"day - CAST(isodow(day) - 1 AS INTEGER) AS week_start, {_COUNT}, {_AVG}", tail="GROUP BY week_start")


def event_type_status():
    return _report(f"event_type, status, {_COUNT}, {_AVG}", tail="GROUP BY event_type, status")


def depth_vs_magnitude():
    return _report(f"{DEPTH_BUCKET} AS depth_bucket, {MAG_BUCKET} AS mag_bucket, {_COUNT}",
                   "depth IS NOT NULL AND mag IS NOT NULL", "GROUP BY depth_bucket, mag_bucket")


# Q-01..Q-09 -------------------------------------------------------------------------------------------
def _n(col: str = "id") -> str:
    return f"CAST(substr({col}, 3) AS BIGINT)"


#: The defects as relations of the star, for the operators' queries that read it.
DEFECTS = [
    f"""fact_d AS (SELECT id, time_id,
      CASE WHEN {_n()} % 107 = 0 THEN -1 ELSE location_id END AS location_id, mag_type_id, network_id,
      CASE WHEN {_n()} % 103 = 0 THEN NULL ELSE status_id END AS status_id, event_type_id
    FROM fact WHERE {_n()} % 101 <> 0)""",
    """dim_magnitude_d AS (SELECT * FROM dim_magnitude UNION ALL
      SELECT (SELECT max(mag_type_id) FROM dim_magnitude) + 1, mag_type, mag_source FROM dim_magnitude WHERE mag_type_id = 1)""",
    """dim_network_d AS (SELECT * FROM dim_network UNION ALL
      SELECT (SELECT max(network_id) FROM dim_network) + 1, net, location_source FROM dim_network WHERE network_id = 1)""",
    """dim_status_d AS (SELECT * FROM dim_status UNION ALL SELECT (SELECT max(status_id) FROM dim_status) + 1, 'retired')""",
    """dim_event_type_d AS (SELECT * FROM dim_event_type UNION ALL
      SELECT (SELECT max(event_type_id) FROM dim_event_type) + 1, 'landslide')""",
    """ods_d AS (SELECT * FROM ods WHERE CAST(event_time AS DATE) IS DISTINCT FROM (SELECT min(CAST(event_time AS DATE)) FROM ods))""",
]

# Natural keys in the order that surrogate ids follow at a first load.
_NATURAL = {"time_id": ["event_time"], "location_id": ["latitude", "longitude", "place"], "mag_type_id": ["mag_type", "mag_source"],
            "network_id": ["net", "location_source"], "status_id": ["status"], "event_type_id": ["event_type"]}


def _check(body: str, broken: bool) -> str:
    """``body`` over ``left_`` (ODS rows that are left) and ``kept`` (events that the fact holds, with
    what became of their keys); ``broken`` says whether the defects are injected."""
    n, flag = _n(), str(broken).upper()
    kept = f"""kept AS (SELECT *, {flag} AND {n} % 103 = 0 AS no_status, {flag} AND {n} % 107 = 0 AS bad_place
  FROM ev WHERE NOT ({flag} AND {n} % 101 = 0))"""
    left = f"left_ AS (SELECT id, CAST(event_time AS DATE) AS day FROM ods QUALIFY NOT {flag} OR day IS NULL OR day > min(day) OVER ())"
    return with_([*BASE, EV, kept, left], body)


def q01(broken=True):
    return _check("""SELECT max(n) FILTER (WHERE ods) AS ods_cnt, max(n) FILTER (WHERE NOT ods) AS fact_cnt,
    ods_cnt - fact_cnt AS diff_cnt
FROM (SELECT TRUE AS ods, COUNT(*) AS n FROM left_ UNION ALL SELECT FALSE, COUNT(*) FROM kept)""", broken)


def q02(broken=True):
    return _check("SELECT COUNT(*) AS missing_in_fact FROM (SELECT id FROM left_ EXCEPT SELECT id FROM kept)", broken)


def q03(broken=True):
    return _check("""SELECT dt, CAST(SUM(o) AS BIGINT) AS ods_cnt, CAST(SUM(f) AS BIGINT) AS fact_cnt, ods_cnt - fact_cnt AS diff
FROM (SELECT day AS dt, 1 AS o, 0 AS f FROM left_ UNION ALL SELECT day, 0, 1 FROM kept)
GROUP BY dt HAVING ods_cnt <> fact_cnt""", broken)


def q04(broken=True):
    return _check("SELECT COUNT(*) AS fact_fk_nulls FROM kept WHERE no_status", broken)


def q05(broken=True):
    ids = {k: f"dense_rank() OVER (ORDER BY {', '.join(f'{c} NULLS FIRST' for c in cols)})" for k, cols in _NATURAL.items()}
    shown = {**{k: f"r.{k}" for k in FACT_KEYS}, "location_id": "CASE WHEN bad_place THEN -1 ELSE r.location_id END", "status_id": "NULL"}
    return _check(f"""SELECT id, {', '.join(f'CAST({shown[k]} AS BIGINT) AS {k}' for k in FACT_KEYS)}
FROM kept JOIN (SELECT id, {', '.join(f'{x} AS {k}' for k, x in ids.items())} FROM ev) r USING (id) WHERE no_status""", broken)


def q06(broken=True):
    return _check("SELECT COUNT(*) AS broken_dim_links FROM kept WHERE no_status OR bad_place", broken)


def _twice(a: str, b: str, broken: bool) -> str:
    """The pairs of a dimension, of which a defect adds the first once more."""
    return _check(f"""SELECT {a}, {b}, COUNT(*) AS cnt FROM (
    SELECT DISTINCT {a}, {b} FROM ev UNION ALL (SELECT DISTINCT {a}, {b} FROM ev ORDER BY {a}, {b} LIMIT {int(broken)}))
GROUP BY {a}, {b} HAVING cnt > 1""", broken)


def q07(broken=True):
    return _twice("mag_type", "mag_source", broken)


def q08(broken=True):
    return _twice("net", "location_source", broken)


def q09(broken=True):
    def unused(dim: str, label: str, added: str, where: str) -> str:
        more = f" UNION SELECT '{added}'" if broken else ""
        return (f"SELECT '{dim}' AS dim_name, COUNT(*) AS orphan_rows FROM ((SELECT {label} FROM ev{more}) "
                f"EXCEPT SELECT {label} FROM kept{where})")

    return _check(unused("dim_status", "status", "retired", " WHERE NOT no_status") + " UNION ALL "
                  + unused("dim_event_type", "event_type", "landslide", ""), broken)
