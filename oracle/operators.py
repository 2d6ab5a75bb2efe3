"""Oracle SQL for the operator-level queries (O-01..O-52)."""

from __future__ import annotations

from oracle.blocks import (
    BASE, DEPTH_BUCKET, FACT_KEYS, FACT_MEASURES, ISO, MAG_BUCKET, NOW, ODS_COLS, STAR, STG_SELECT, avg2,
    fact_select, norm, standardize, star, with_,
)
from oracle.reports import BOUNDS, DEFECTS

STG_COLS = ["time", "latitude", "longitude", "depth", "mag", "mag_type", "nst", "gap", "dmin", "rms", "net", "id",
            "updated", "place", "type", "horizontal_error", "depth_error", "mag_error", "mag_nst", "status",
            "location_source", "mag_source"]


def q(cols: list[str]) -> str:
    return ", ".join(f'"{c}"' for c in cols)


def base(body: str) -> str:
    return with_(BASE, body)


FEED_DATE = 'CAST(CAST("time" AS TIMESTAMP) AS DATE)'

_N = "CAST(substr(id, 3) AS BIGINT)"
FEED2 = f"""feed2 AS (
  SELECT * REPLACE (strftime(CAST(updated AS TIMESTAMP) + INTERVAL 24 HOUR, {ISO}) AS updated, '1.11' AS mag,
      'deleted' AS status, 'Moved, New Region' AS place, '999.9' AS depth) FROM feed WHERE {_N} % 20 = 3
  UNION ALL
  SELECT * REPLACE (strftime(CAST(updated AS TIMESTAMP) - INTERVAL 24 HOUR, {ISO}) AS updated, '0.50' AS mag)
  FROM feed WHERE {_N} % 50 = 7
  UNION ALL
  SELECT * REPLACE ('nx' || substr(id, 3) AS id, strftime(CAST("time" AS TIMESTAMP) + INTERVAL 720 HOUR, {ISO}) AS "time")
  FROM feed WHERE {_N} % 40 = 9)"""

_UPD = {"updated_at", "mag", "status", "place", "region"}
_KNOWN = ", ".join(f"b.{c}" if c in _UPD else f"o.{c}" for c in ODS_COLS)
SECOND = [
    FEED2,
    f"stg2 AS ({STG_SELECT} FROM feed2)",
    f"b2 AS ({standardize('stg2')})",
    f"""ods2 AS (
  SELECT {_KNOWN} FROM ods o JOIN b2 b ON b.id = o.id
  UNION ALL SELECT o.* FROM ods o WHERE NOT EXISTS (SELECT 1 FROM b2 b WHERE b.id = o.id)
  UNION ALL SELECT {', '.join('b.' + c for c in ODS_COLS[:-1])}, {NOW} FROM b2 b
  WHERE NOT EXISTS (SELECT 1 FROM ods o WHERE o.id = b.id))""",
]


def _new_rows(dim: str, id_col: str, keys: list[str], select_cands: str, extra: str = "") -> str:
    order = ", ".join(f"{k} NULLS FIRST" for k in keys)
    match = " AND ".join(f"d.{k} IS NOT DISTINCT FROM c.{k}" for k in keys)
    cols = ", ".join(["c." + k for k in keys] + ([f"c.{x.strip()}" for x in extra.split(",")] if extra else []))
    return f"""{dim}2 AS (SELECT * FROM {dim} UNION ALL BY NAME
  SELECT CAST((SELECT COALESCE(max({id_col}), 0) FROM {dim}) + row_number() OVER (ORDER BY {order}) AS BIGINT)
      AS {id_col}, {cols}
  FROM ({select_cands}) c WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE {match}))"""


_ROWS2 = "(SELECT * FROM ods2 WHERE event_time IS NOT NULL)"
DIMS2 = [
    _new_rows("dim_region", "region_id", ["region_name"], f"SELECT DISTINCT {norm('region')} AS region_name FROM {_ROWS2}"),
    _new_rows("dim_time", "time_id", ["event_time"], f"""SELECT DISTINCT event_time, CAST(year(event_time) AS INTEGER) AS year,
    CAST(month(event_time) AS INTEGER) AS month, CAST(day(event_time) AS INTEGER) AS day,
    CAST(hour(event_time) AS INTEGER) AS hour, CAST(quarter(event_time) AS INTEGER) AS quarter,
    rpad(dayname(event_time), 9, ' ') AS day_of_week, dayofweek(event_time) IN (0, 6) AS is_weekend FROM {_ROWS2}""",
              "year, month, day, hour, quarter, day_of_week, is_weekend"),
    _new_rows("dim_location", "location_id", ["latitude", "longitude", "place"],
              f"""SELECT DISTINCT r.region_id, e.latitude, e.longitude, {norm('e.place')} AS place FROM {_ROWS2} e
    LEFT JOIN dim_region2 r ON r.region_name = {norm('e.region')}""", "region_id"),
    _new_rows("dim_magnitude", "mag_type_id", ["mag_type", "mag_source"],
              f"SELECT DISTINCT {norm('mag_type')} AS mag_type, {norm('mag_source')} AS mag_source FROM {_ROWS2}"),
    _new_rows("dim_network", "network_id", ["net", "location_source"],
              f"SELECT DISTINCT {norm('net')} AS net, {norm('location_source')} AS location_source FROM {_ROWS2}"),
    _new_rows("dim_status", "status_id", ["status"], f"SELECT DISTINCT {norm('status')} AS status FROM {_ROWS2}"),
    _new_rows("dim_event_type", "event_type_id", ["event_type"],
              f"SELECT DISTINCT {norm('event_type')} AS event_type FROM {_ROWS2}"),
    f"fact2 AS ({fact_select('ods', 'ods2')})",
]


def second(body: str) -> str:
    return with_(STAR + SECOND + DIMS2, body)


def _ods_cols(cols: list[str], where: str = "") -> str:
    return base(f"SELECT id, {', '.join(cols)} FROM ods{where}")


_TIMED = " WHERE event_time IS NOT NULL"


def joined_back(src: str = "ods", where: str = "") -> str:
    m = ", ".join(f"e.{c} AS f_{c}" for c in FACT_MEASURES)
    return f"""SELECT e.id, e.event_time, e.latitude, e.longitude, {norm('e.place')} AS place,
    {norm('e.region')} AS region_name, {norm('e.mag_type')} AS mag_type, {norm('e.mag_source')} AS mag_source,
    {norm('e.net')} AS net, {norm('e.location_source')} AS location_source, {norm('e.status')} AS status,
    {norm('e.event_type')} AS event_type, {m}, {NOW} AS dwh_loaded_at
  FROM {src} e WHERE e.event_time IS NOT NULL{where}"""


# O-46 -----------------------------------------------------------------------------------------------
# The declared rules of the source tables, written down here on their own, so that a rule missing
# in the library shows. (relation, key, natural key, other NOT NULL columns, lengths, foreign keys)
RULES = {
    "ods.earthquakes": ("ods_d", ["id"], [], [], {"id": 50, "mag_type": 20, "net": 10, "event_type": 50, "status": 20,
                                                  "location_source": 10, "mag_source": 10}, {}),
    "dm.dim_time": ("dim_time", ["time_id"], ["event_time"], ["event_time"], {"day_of_week": 10}, {}),
    "dm.dim_region": ("dim_region", ["region_id"], ["region_name"], ["region_name"], {}, {}),
    "dm.dim_location": ("dim_location", ["location_id"], ["latitude", "longitude", "place"], [], {},
                        {"region_id": ("dim_region", "region_id")}),
    "dm.dim_magnitude": ("dim_magnitude_d", ["mag_type_id"], ["mag_type", "mag_source"], ["mag_type", "mag_source"],
                         {"mag_type": 20, "mag_source": 10}, {}),
    "dm.dim_network": ("dim_network_d", ["network_id"], ["net", "location_source"], ["net", "location_source"],
                       {"net": 10, "location_source": 10}, {}),
    "dm.dim_status": ("dim_status_d", ["status_id"], ["status"], ["status"], {"status": 20}, {}),
    "dm.dim_event_type": ("dim_event_type_d", ["event_type_id"], ["event_type"], ["event_type"], {"event_type": 50}, {}),
    "dm.fact_earthquakes": ("fact_d", ["id"], [], [], {"id": 50}, {
        "time_id": ("dim_time", "time_id"), "location_id": ("dim_location", "location_id"),
        "mag_type_id": ("dim_magnitude_d", "mag_type_id"), "network_id": ("dim_network_d", "network_id"),
        "status_id": ("dim_status_d", "status_id"), "event_type_id": ("dim_event_type_d", "event_type_id")}),
}


def validate_sql() -> str:
    parts = []
    for cname, (rel, key, natural, not_null, lengths, refs) in RULES.items():
        def row(rule, col, expr):
            parts.append(f"SELECT '{cname}' AS table_name, '{rule}' AS rule, '{col}' AS column_name, "
                         f"CAST(({expr}) AS BIGINT) AS violations")
        for col in [*key, *not_null]:
            row("not_null", col, f"SELECT COUNT(*) FROM {rel} WHERE {col} IS NULL")
        for col, n in lengths.items():
            row("max_length", col, f"SELECT COUNT(*) FROM {rel} WHERE length({col}) > {n}")
        k = ", ".join(key)
        row("primary_key_unique", ",".join(key),
            f"SELECT COUNT(*) FROM (SELECT {k} FROM {rel} GROUP BY {k} HAVING COUNT(*) > 1)")
        if natural:
            k = ", ".join(natural)
            nn = " AND ".join(f"{x} IS NOT NULL" for x in natural)
            row("unique", ",".join(natural),
                f"SELECT COUNT(*) FROM (SELECT {k} FROM {rel} WHERE {nn} GROUP BY {k} HAVING COUNT(*) > 1)")
        for col, (ref, ref_col) in refs.items():
            row("foreign_key", col, f"SELECT COUNT(*) FROM {rel} t WHERE t.{col} IS NOT NULL AND NOT EXISTS "
                                    f"(SELECT 1 FROM {ref} r WHERE r.{ref_col} = t.{col})")
    return with_(STAR + DEFECTS, "\nUNION ALL\n".join(parts))


# ODS after files in which an event with n % 20 = 3 stands a day early too: the early version gave what is only inserted
EARLY = f"""ods_early AS (
  SELECT * REPLACE (CASE WHEN {_N} % 20 = 3 AND CAST(event_time AS DATE) - 1 IN (SELECT CAST(event_time AS DATE) FROM ods WHERE event_time IS NOT NULL)
                         THEN CAST(999.9 AS DECIMAL(10,4)) ELSE depth END AS depth) FROM ods)"""

# O-06 -----------------------------------------------------------------------------------------------
# Columns and types of the source tables, written down here on their own; * marks the key, ! NOT NULL.
_MEASURE_TYPES = ("mag decimal(5,2), depth decimal(10,4), nst int, gap decimal(6,2), dmin decimal(8,4), rms decimal(6,3), "
                  "horizontal_error decimal(10,5), depth_error decimal(10,5), mag_error decimal(10,5), mag_nst int")
DEFINITIONS = {
    "stg.earthquake_raw": ("stg", "loaded_at timestamp, " + ", ".join(f"{c} string" for c in STG_COLS)),
    "ods.earthquakes": ("ods", "id* string, event_time timestamp, updated_at timestamp, latitude decimal(12,8), longitude decimal(12,8), "
                        "depth decimal(10,4), mag decimal(5,2), mag_type string, nst int, gap decimal(6,2), dmin decimal(8,4), rms decimal(6,3), "
                        "horizontal_error decimal(10,5), depth_error decimal(10,5), mag_error decimal(10,5), mag_nst int, net string, place string, "
                        "event_type string, status string, location_source string, mag_source string, region string, ods_loaded_at timestamp"),
    "dm.dim_region": ("dim_region", "region_id* bigint, region_name! string"),
    "dm.dim_time": ("dim_time", "time_id* bigint, event_time! timestamp, year int, month int, day int, hour int, quarter int, "
                    "day_of_week string, is_weekend boolean"),
    "dm.dim_location": ("dim_location", "location_id* bigint, region_id bigint, latitude decimal(12,8), longitude decimal(12,8), place string"),
    "dm.dim_magnitude": ("dim_magnitude", "mag_type_id* bigint, mag_type! string, mag_source! string"),
    "dm.dim_network": ("dim_network", "network_id* bigint, net! string, location_source! string"),
    "dm.dim_status": ("dim_status", "status_id* bigint, status! string"),
    "dm.dim_event_type": ("dim_event_type", "event_type_id* bigint, event_type! string"),
    "dm.fact_earthquakes": ("fact", "id* string, " + ", ".join(f"{k} bigint" for k in FACT_KEYS) + f", {_MEASURE_TYPES}, dwh_loaded_at timestamp"),
}


def definitions_sql() -> str:
    parts = []
    for table, (rel, columns) in DEFINITIONS.items():
        for column in _split(columns):
            name, kind = column.split(" ", 1)
            col = name.rstrip("*!")
            parts.append(f"""SELECT '{table}' AS table_name, '{col}' AS column_name, '{kind}' AS data_type, {'*' in name} AS is_key,
  {name != col} AS not_null, COUNT(*) - COUNT("{col}") AS n_nulls, COUNT(*) AS n_rows FROM {rel}""")
    return star("\nUNION ALL\n".join(parts))


def _split(columns: str) -> list[str]:
    """Parts of a list of columns whose types may hold commas."""
    out, depth, last = [], 0, ""
    for c in columns:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(last.strip())
            last = ""
        else:
            last += c
    return [*out, last.strip()]


def catalog_sql() -> dict[str, str]:
    ods_cols = ", ".join(ODS_COLS)
    raw = base(f'SELECT *, {FEED_DATE} AS load_date FROM feed')
    out = {
        "o01_read_feed": base("SELECT * FROM feed"),
        "o02_write_raw_day": raw,
        "o03_read_raw_day": base("SELECT * FROM feed"),
        "o04_read_layer": base(f"SELECT {ods_cols} FROM ods"),
        "o05_append_by_name": base("SELECT * FROM stg"),
        "o07_rename": base(f"SELECT {q(STG_COLS)} FROM stg"),
        "o08_to_instant": _ods_cols(["event_time", "updated_at"]),
        "o09_strict_decimal": _ods_cols(["latitude", "longitude", "depth", "mag"]),
        "o10_blank_to_null": _ods_cols(["nst", "gap", "dmin", "rms", "horizontal_error", "depth_error", "mag_error",
                                        "mag_nst"]),
        "o11_trim": _ods_cols(["place"]),
        "o12_lower": _ods_cols(["event_type"]),
        "o13_region_from_place": _ods_cols(["region"]),
        "o14_normalize_labels": _ods_cols([f"{norm(c)} AS {c}_label" for c in
                                           ["region", "place", "mag_type", "mag_source", "net", "location_source",
                                            "status", "event_type"]]),
        "o15_to_day": _ods_cols(["CAST(event_time AS DATE) AS event_date"]),
        "o16_calendar_parts": _ods_cols([
            "CAST(year(event_time) AS INTEGER) AS year", "CAST(month(event_time) AS INTEGER) AS month",
            "CAST(day(event_time) AS INTEGER) AS day", "CAST(hour(event_time) AS INTEGER) AS hour",
            "CAST(quarter(event_time) AS INTEGER) AS quarter", "dayofweek(event_time) IN (0, 6) AS is_weekend",
            "CAST(isodow(event_time) AS INTEGER) AS iso_dow"], _TIMED),
        "o17_day_name": _ods_cols(["rpad(dayname(event_time), 9, ' ') AS day_of_week"], _TIMED),
        "o18_week_start": _ods_cols(["CAST(date_trunc('week', event_time) AS DATE) AS week_start"], _TIMED),
        "o19_mag_bucket": base(f"SELECT f.id, {MAG_BUCKET} AS mag_bucket FROM ods f"),
        "o20_depth_bucket": base(f"SELECT f.id, {DEPTH_BUCKET} AS depth_bucket FROM ods f"),
        "o21_exact_avg": base(f"SELECT region, {avg2('mag')} AS avg_mag FROM ods GROUP BY region"),
        "o22_zero_fill": star("""SELECT COALESCE(o.dt, f.dt) AS dt, COALESCE(o.cnt, 0) AS ods_cnt,
    COALESCE(f.cnt, 0) AS fact_cnt, COALESCE(o.cnt, 0) - COALESCE(f.cnt, 0) AS diff
FROM (SELECT CAST(event_time AS DATE) AS dt, COUNT(*) AS cnt FROM ods GROUP BY 1) o
FULL JOIN (SELECT CAST(t.event_time AS DATE) AS dt, COUNT(*) AS cnt FROM fact f
           JOIN dim_time t ON t.time_id = f.time_id GROUP BY 1) f ON f.dt = o.dt"""),
        "o23_day_filter": base("""SELECT id, event_time FROM ods
WHERE CAST(event_time AS DATE) = (SELECT max(CAST(event_time AS DATE)) FROM ods)"""),
        "o25_null_checks": base("""SELECT id, latitude, longitude, depth, mag FROM ods
WHERE latitude IS NULL OR longitude IS NULL OR depth IS NULL OR mag IS NULL"""),
        "o26_threshold": base("SELECT id, mag FROM ods WHERE mag >= 5"),
        "o27_semi_join": with_(STAR + [BOUNDS], """SELECT f.id, f.time_id FROM fact f WHERE f.time_id IN (
    SELECT t.time_id FROM dim_time t WHERE CAST(t.event_time AS DATE) >= (SELECT d_from FROM bounds)
      AND CAST(t.event_time AS DATE) <= (SELECT d_to FROM bounds))"""),
        "o28_star_join": star("""SELECT f.id, t.event_time, r.region_name, l.place, f.mag, f.depth, m.mag_type, m.mag_source,
    n.net, n.location_source, s.status, et.event_type
FROM fact f JOIN dim_time t ON t.time_id = f.time_id
JOIN dim_location l ON l.location_id = f.location_id JOIN dim_region r ON r.region_id = l.region_id
JOIN dim_magnitude m ON m.mag_type_id = f.mag_type_id JOIN dim_network n ON n.network_id = f.network_id
JOIN dim_status s ON s.status_id = f.status_id JOIN dim_event_type et ON et.event_type_id = f.event_type_id"""),
        "o29_lookup_keys": star(f"SELECT id, {', '.join(FACT_KEYS)} FROM fact"),
        "o30_null_safe_lookup": star("SELECT id, location_id FROM fact"),
        "o31_anti_join": with_(STAR + DEFECTS, "SELECT e.id FROM ods_d e WHERE NOT EXISTS (SELECT 1 FROM fact_d f WHERE f.id = e.id)"),
        "o33_group_by": star(f"""SELECT r.region_name, COUNT(*) AS events_cnt, MAX(f.mag) AS max_mag, {avg2('f.mag')} AS avg_mag
FROM fact f JOIN dim_location l ON l.location_id = f.location_id JOIN dim_region r ON r.region_id = l.region_id
GROUP BY 1"""),
        "o34_filtered_count": star("""SELECT r.region_name, COUNT(*) FILTER (WHERE f.mag >= 5) AS events_mag_5_plus
FROM fact f JOIN dim_location l ON l.location_id = f.location_id JOIN dim_region r ON r.region_id = l.region_id
GROUP BY 1"""),
        "o35_having": star("""SELECT r.region_name, COUNT(*) AS events_cnt
FROM fact f JOIN dim_location l ON l.location_id = f.location_id JOIN dim_region r ON r.region_id = l.region_id
GROUP BY 1 HAVING COUNT(*) >= 10"""),
        "o36_distinct": base(f"SELECT DISTINCT latitude, longitude, {norm('place')} AS place FROM ods{_TIMED}"),
        "o40_dim_location_second_load": second("SELECT * FROM dim_location2"),
        "o40_dim_region_second_load": second("SELECT * FROM dim_region2"),
        "o40_dim_time_second_load": second("SELECT * FROM dim_time2"),
        "o41_upsert_ods": second("SELECT * FROM ods2"),
        "o42_upsert_fact": second("SELECT * FROM fact2"),
        "o44_dedupe_latest": base(f"""SELECT * REPLACE (strftime(CAST(updated AS TIMESTAMP) + INTERVAL 25 HOUR, {ISO}) AS updated,
    '1.11' AS mag, 'reviewed-again' AS status, 'Moved, New Region' AS place, '999.9' AS depth)
FROM feed WHERE {_N} % 20 = 3"""),
        "o44_bad_keys": base(f"""SELECT id, CAST(2 AS BIGINT) AS n FROM feed WHERE {_N} % 20 = 3
UNION ALL SELECT NULL AS id, COUNT(*) AS n FROM feed WHERE {_N} % 100 = 1 HAVING COUNT(*) > 0"""),
        "o45_fact_rows": star("SELECT * FROM fact"),
        "o46_validate": validate_sql(),
        "o47_ingest_raw": raw,
        "o48_load_stg": base("SELECT * FROM stg"),
        "o49_load_ods": base(f"SELECT {ods_cols} FROM ods"),
        "o50_load_dm": base(joined_back()),
        "o51_run_day": base(joined_back(where=" AND CAST(e.event_time AS DATE) = (SELECT min(CAST(event_time AS DATE)) FROM ods)")),
        "o51_second_day": base(joined_back(where=" AND CAST(e.event_time AS DATE) IN (SELECT DISTINCT CAST(event_time AS DATE) FROM ods WHERE event_time IS NOT NULL ORDER BY 1 LIMIT 2)")),
        "o52_backfill": base(joined_back()),
        "o52_backfill_overlap": with_(BASE + [EARLY], joined_back("ods_early")),
        "o49_key_index": base("SELECT id, CAST(event_time AS DATE) AS event_date FROM ods"),
        "o06_table_definitions": definitions_sql(),
    }
    # O-43: the second batch appended after the first day is deleted
    out["o43_replace_day"] = with_(BASE + [FEED2, f"stg2 AS ({STG_SELECT} FROM feed2)"],
                                   f"""SELECT * FROM stg WHERE {FEED_DATE} IS DISTINCT FROM (SELECT min({FEED_DATE}) FROM stg)
UNION ALL SELECT * FROM stg2""")
    for k in ["dim_region", "dim_time", "dim_location", "dim_magnitude", "dim_network", "dim_status", "dim_event_type"]:
        out[f"o39_{k}"] = star(f"SELECT * FROM {k}")
    return out
