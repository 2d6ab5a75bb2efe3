"""CTE blocks and helpers for the DuckDB oracle SQL."""

from __future__ import annotations

NOW = "TIMESTAMP '2026-01-01 00:00:00'"


def dec(x: str, k: int) -> str:
    step = f"CAST({10 ** -k:.{k}f} AS DECIMAL({k + 1},{k}))"
    return f"CAST(CAST({x} AS DECIMAL(9,0)) * {step} AS DECIMAL(12,{k}))"


def txt(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def blank_every(n: int, v: str) -> str:
    return f"CASE WHEN e.event_id % {n} = 0 THEN '' ELSE {v} END"


def null_every(n: int, v: str) -> str:
    return f"CASE WHEN e.event_id % {n} = 0 THEN NULL ELSE {v} END"


ISO = "'%Y-%m-%dT%H:%M:%S.%gZ'"

FEED = f"""feed AS (
  SELECT
    strftime(e.ts, {ISO}) AS "time",
    {null_every(97, txt(dec('(e.user_id*3701) % 18001 - 9000', 2)))} AS latitude,
    {null_every(97, txt(dec('(e.user_id*5303) % 36001 - 18000', 2)))} AS longitude,
    {null_every(89, txt(dec('(e.event_id*17) % 7031 - 20', 1)))} AS depth,
    {null_every(83, txt(dec('(e.event_id*31 + e.user_id) % 903 - 100', 2)))} AS mag,
    CASE e.event_id % 4 WHEN 0 THEN 'ml' WHEN 1 THEN 'md' WHEN 2 THEN ' mb ' ELSE '' END AS "magType",
    {blank_every(5, txt('e.event_id % 60'))} AS nst,
    {blank_every(6, txt(dec('(e.event_id*13) % 36000', 2)))} AS gap,
    {blank_every(7, txt(dec('(e.event_id*11) % 9000', 4)))} AS dmin,
    {blank_every(8, txt(dec('(e.event_id*7) % 3000', 3)))} AS rms,
    CASE e.event_id % 3 WHEN 0 THEN 'us' WHEN 1 THEN 'ci' ELSE 'nc' END AS net,
    'ev' || {txt('e.event_id')} AS id,
    strftime(e.ts + to_hours(CAST(e.event_id % 5 AS INTEGER)), {ISO}) AS updated,
    CASE WHEN e.event_id % 1999 = 0 THEN '1 km N of X, RARE_' || {txt('e.event_id % 3')}
         WHEN e.event_id % 13 = 0 THEN NULL
         WHEN e.event_id % 11 = 0 THEN 'Mid-ocean ridge'
         WHEN e.event_id % 17 = 0 THEN '5 km N of Camp, '
         ELSE ' ' || {txt('e.user_id % 40')} || ' km NE of Town ' || {txt('e.user_id % 9')} || ', Area, ' || n.n_name
    END AS place,
    CASE e.event_type WHEN 'click' THEN 'Earthquake' WHEN 'view' THEN 'earthquake'
         WHEN 'error' THEN 'Quarry Blast' WHEN 'signup' THEN 'explosion' ELSE '' END AS "type",
    {blank_every(9, txt(dec('(e.event_id*19) % 99991', 5)))} AS "horizontalError",
    {blank_every(10, txt(dec('(e.event_id*23) % 99991', 5)))} AS "depthError",
    {blank_every(12, txt(dec('(e.event_id*29) % 99991', 5)))} AS "magError",
    {blank_every(14, txt('e.event_id % 77'))} AS "magNst",
    CASE e.event_id % 10 WHEN 0 THEN 'automatic' WHEN 1 THEN ' ' ELSE 'reviewed' END AS status,
    CASE e.event_id % 2 WHEN 0 THEN 'us' ELSE 'ci' END AS "locationSource",
    {null_every(19, "'us'")} AS "magSource"
  FROM events e JOIN nation n ON n.n_nationkey = e.user_id % 25
)"""

FEED_COLS = ['"time"', "latitude", "longitude", "depth", "mag", '"magType"', "nst", "gap", "dmin", "rms", "net",
             "id", "updated", "place", '"type"', '"horizontalError"', '"depthError"', '"magError"', '"magNst"',
             "status", '"locationSource"', '"magSource"']

STG_SELECT = f"""SELECT {NOW} AS loaded_at, "time", latitude, longitude, depth, mag, "magType" AS mag_type, nst, gap,
    dmin, rms, net, id, updated, place, "type", "horizontalError" AS horizontal_error,
    "depthError" AS depth_error, "magError" AS mag_error, "magNst" AS mag_nst, status,
    "locationSource" AS location_source, "magSource" AS mag_source"""

STG = f"stg AS ({STG_SELECT} FROM feed)"


def region_of(place: str) -> str:
    return (f"CASE WHEN contains({place}, ',') THEN trim(regexp_replace({place}, '(?s)^.*,\\s*', '')) "
            f"ELSE 'Unknown' END")


def standardize(src: str) -> str:
    """ODS columns (without ods_loaded_at) from an STG-shaped relation."""
    return f"""SELECT id, CAST("time" AS TIMESTAMP) AS event_time, CAST(updated AS TIMESTAMP) AS updated_at,
    CAST(latitude AS DECIMAL(12,8)) AS latitude, CAST(longitude AS DECIMAL(12,8)) AS longitude,
    CAST(depth AS DECIMAL(10,4)) AS depth, CAST(mag AS DECIMAL(5,2)) AS mag, mag_type,
    CAST(NULLIF(nst, '') AS INTEGER) AS nst, CAST(NULLIF(gap, '') AS DECIMAL(6,2)) AS gap,
    CAST(NULLIF(dmin, '') AS DECIMAL(8,4)) AS dmin, CAST(NULLIF(rms, '') AS DECIMAL(6,3)) AS rms,
    CAST(NULLIF(horizontal_error, '') AS DECIMAL(10,5)) AS horizontal_error,
    CAST(NULLIF(depth_error, '') AS DECIMAL(10,5)) AS depth_error,
    CAST(NULLIF(mag_error, '') AS DECIMAL(10,5)) AS mag_error,
    CAST(NULLIF(mag_nst, '') AS INTEGER) AS mag_nst, net, trim(place) AS place,
    lower("type") AS event_type, status, location_source, mag_source, {region_of('place')} AS region
  FROM {src}"""


ODS_COLS = ["id", "event_time", "updated_at", "latitude", "longitude", "depth", "mag", "mag_type", "nst", "gap",
            "dmin", "rms", "horizontal_error", "depth_error", "mag_error", "mag_nst", "net", "place", "event_type",
            "status", "location_source", "mag_source", "region", "ods_loaded_at"]

ODS = f"ods AS (SELECT *, {NOW} AS ods_loaded_at FROM ({standardize('stg')}))"


def norm(x: str) -> str:
    return f"COALESCE(NULLIF(trim({x}), ''), 'unknown')"


def dims(src: str = "ods") -> list[str]:
    """The seven dimension CTEs over the dated rows of ``src`` (first load: ids from 1)."""
    rows = f"(SELECT * FROM {src} WHERE event_time IS NOT NULL)"
    return [
        f"""dim_region AS (SELECT CAST(row_number() OVER (ORDER BY region_name NULLS FIRST) AS BIGINT) AS region_id,
    region_name FROM (SELECT DISTINCT {norm('region')} AS region_name FROM {rows}))""",
        f"""dim_time AS (SELECT CAST(row_number() OVER (ORDER BY event_time NULLS FIRST) AS BIGINT) AS time_id,
    event_time, CAST(year(event_time) AS INTEGER) AS year, CAST(month(event_time) AS INTEGER) AS month,
    CAST(day(event_time) AS INTEGER) AS day, CAST(hour(event_time) AS INTEGER) AS hour,
    CAST(quarter(event_time) AS INTEGER) AS quarter, rpad(dayname(event_time), 9, ' ') AS day_of_week,
    dayofweek(event_time) IN (0, 6) AS is_weekend
  FROM (SELECT DISTINCT event_time FROM {rows}))""",
        f"""dim_location AS (SELECT CAST(row_number() OVER (ORDER BY latitude NULLS FIRST, longitude NULLS FIRST,
      place NULLS FIRST) AS BIGINT) AS location_id, region_id, latitude, longitude, place
  FROM (SELECT DISTINCT r.region_id, e.latitude, e.longitude, {norm('e.place')} AS place
        FROM {rows} e LEFT JOIN dim_region r ON r.region_name = {norm('e.region')}))""",
        f"""dim_magnitude AS (SELECT CAST(row_number() OVER (ORDER BY mag_type NULLS FIRST, mag_source NULLS FIRST)
      AS BIGINT) AS mag_type_id, mag_type, mag_source
  FROM (SELECT DISTINCT {norm('mag_type')} AS mag_type, {norm('mag_source')} AS mag_source FROM {rows}))""",
        f"""dim_network AS (SELECT CAST(row_number() OVER (ORDER BY net NULLS FIRST, location_source NULLS FIRST)
      AS BIGINT) AS network_id, net, location_source
  FROM (SELECT DISTINCT {norm('net')} AS net, {norm('location_source')} AS location_source FROM {rows}))""",
        f"""dim_status AS (SELECT CAST(row_number() OVER (ORDER BY status NULLS FIRST) AS BIGINT) AS status_id, status
  FROM (SELECT DISTINCT {norm('status')} AS status FROM {rows}))""",
        f"""dim_event_type AS (SELECT CAST(row_number() OVER (ORDER BY event_type NULLS FIRST) AS BIGINT)
      AS event_type_id, event_type FROM (SELECT DISTINCT {norm('event_type')} AS event_type FROM {rows}))""",
    ]


FACT_MEASURES = ["mag", "depth", "nst", "gap", "dmin", "rms", "horizontal_error", "depth_error", "mag_error",
                 "mag_nst"]
#: The columns that tell the rows of a dimension apart, as they stand in ``labelled``.
NATURAL = {"time_id": ["event_time"], "location_id": ["latitude", "longitude", "place"], "mag_type_id": ["mag_type", "mag_source"],
           "network_id": ["net", "location_source"], "status_id": ["status"], "event_type_id": ["event_type"]}
FACT_KEYS = list(NATURAL)
_LABELS = ["place", "mag_type", "mag_source", "net", "location_source", "status", "event_type"]


def labelled(src: str, load: int) -> str:
    """The dated events of ``src`` with their labels, as one flat relation."""
    return f"""SELECT {load} AS load, id, event_time, latitude, longitude, {', '.join(f'{norm(c)} AS {c}' for c in _LABELS)},
    {', '.join(FACT_MEASURES)} FROM {src} WHERE event_time IS NOT NULL"""


def fact_select(*loads: str) -> str:
    """The fact after the last of ``loads`` (relations of ODS shape), from flat events alone. A key is the rank of its
    natural key: those of an earlier load come first, within a load they are in order, nulls first."""
    events = " UNION ALL ".join(labelled(src, i) for i, src in enumerate(loads, 1))
    since = ", ".join(f"min(load) OVER (PARTITION BY {', '.join(cols)}) AS since_{key}" for key, cols in NATURAL.items())
    ranks = ",\n    ".join(f"dense_rank() OVER (ORDER BY since_{key}, {', '.join(f'{c} NULLS FIRST' for c in cols)}) AS {key}"
                           for key, cols in NATURAL.items())
    return f"""SELECT id, {ranks}, {', '.join(FACT_MEASURES)}, {NOW} AS dwh_loaded_at, CAST(event_time AS DATE) AS event_date
  FROM (SELECT *, {since} FROM ({events})) QUALIFY load = {len(loads)}"""


FACT = f"fact AS ({fact_select('ods')})"

BASE = [FEED, STG, ODS]
STAR = BASE + dims() + [FACT]


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def star(body: str) -> str:
    return with_(STAR, body)


def avg2(x: str) -> str:
    """ROUND(AVG(x), 2) of a decimal(.,2) column, half away from zero, exactly, as DECIMAL(18,2)."""
    s = f"SUM(CAST({x} * 100 AS BIGINT))"
    n = f"COUNT({x})"
    return hundredths(s, n)


def hundredths(s: str, n: str) -> str:
    """round(s / n) half away from zero as DECIMAL(18,2) hundredths (s already in hundredths)."""
    return (f"CASE WHEN {n} > 0 THEN CAST(CAST((CASE WHEN {s} < 0 THEN -1 ELSE 1 END) * "
            f"((2 * abs({s}) + {n}) // (2 * {n})) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) END")


# The report bucket labels and their exclusive upper edges, in order.
MAG_BUCKET = """CASE WHEN f.mag < 2 THEN '<2' WHEN f.mag < 3 THEN '2-3' WHEN f.mag < 4 THEN '3-4'
    WHEN f.mag < 5 THEN '4-5' WHEN f.mag < 6 THEN '5-6' ELSE '6+' END"""
DEPTH_BUCKET = """CASE WHEN f.depth < 10 THEN '0-10 km' WHEN f.depth < 30 THEN '10-30 km'
    WHEN f.depth < 70 THEN '30-70 km' WHEN f.depth < 150 THEN '70-150 km' ELSE '150+ km' END"""
