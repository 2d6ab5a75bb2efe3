"""O-06: table contracts of every layer: schema, key, lengths, foreign keys.

One definition drives reads (O-04), writes, upserts and the validator (O-46).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The source feed's column names in feed order, and the snake_case name each
# becomes at the staging load.
FEED_COLUMNS = [
    "time", "latitude", "longitude", "depth", "mag", "magType", "nst", "gap", "dmin", "rms", "net",
    "id", "updated", "place", "type", "horizontalError", "depthError", "magError", "magNst",
    "status", "locationSource", "magSource",
]
FEED_TO_STG = {
    "magType": "mag_type",
    "horizontalError": "horizontal_error",
    "depthError": "depth_error",
    "magError": "mag_error",
    "magNst": "mag_nst",
    "locationSource": "location_source",
    "magSource": "mag_source",
}
STG_COLUMNS = [FEED_TO_STG.get(c, c) for c in FEED_COLUMNS]

FEED_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in FEED_COLUMNS])


def dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


@dataclass(frozen=True)
class Contract:
    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    natural_key: tuple[str, ...] = ()  # UNIQUE natural key of a dimension
    not_null: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)  # col -> (table, col)
    partition_by: str | None = None  # storage-only partition column (not part of the schema)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


S, I, TS, B = T.StringType(), T.IntegerType(), T.TimestampType(), T.BooleanType()
K = T.LongType()  # surrogate ids: some dimensions grow by about a row per event

STG = Contract(
    "stg.earthquake_raw",
    _struct(("loaded_at", TS), *[(c, S) for c in STG_COLUMNS]),
    partition_by="stg_date",
)

ODS_MEASURES = [
    ("latitude", dec(12, 8)), ("longitude", dec(12, 8)), ("depth", dec(10, 4)), ("mag", dec(5, 2)),
]
ODS = Contract(
    "ods.earthquakes",
    _struct(
        ("id", S), ("event_time", TS), ("updated_at", TS),
        *ODS_MEASURES,
        ("mag_type", S), ("nst", I), ("gap", dec(6, 2)), ("dmin", dec(8, 4)), ("rms", dec(6, 3)),
        ("horizontal_error", dec(10, 5)), ("depth_error", dec(10, 5)), ("mag_error", dec(10, 5)),
        ("mag_nst", I), ("net", S), ("place", S), ("event_type", S), ("status", S),
        ("location_source", S), ("mag_source", S), ("region", S), ("ods_loaded_at", TS),
    ),
    key=("id",),
    not_null=("id",),
    max_length={"id": 50, "mag_type": 20, "net": 10, "event_type": 50, "status": 20,
                "location_source": 10, "mag_source": 10},
    partition_by="event_date",
)

DIM_REGION = Contract("dm.dim_region", _struct(("region_id", K), ("region_name", S)),
                      key=("region_id",), natural_key=("region_name",), not_null=("region_id", "region_name"))
DIM_TIME = Contract(
    "dm.dim_time",
    _struct(("time_id", K), ("event_time", TS), ("year", I), ("month", I), ("day", I), ("hour", I),
            ("quarter", I), ("day_of_week", S), ("is_weekend", B)),
    key=("time_id",), natural_key=("event_time",), not_null=("time_id", "event_time"),
    max_length={"day_of_week": 10},
)
DIM_LOCATION = Contract(
    "dm.dim_location",
    _struct(("location_id", K), ("region_id", K), ("latitude", dec(12, 8)), ("longitude", dec(12, 8)),
            ("place", S)),
    key=("location_id",), natural_key=("latitude", "longitude", "place"), not_null=("location_id",),
    foreign_keys={"region_id": ("dm.dim_region", "region_id")},
)
DIM_MAGNITUDE = Contract("dm.dim_magnitude", _struct(("mag_type_id", K), ("mag_type", S), ("mag_source", S)),
                         key=("mag_type_id",), natural_key=("mag_type", "mag_source"), not_null=("mag_type_id", "mag_type", "mag_source"),
                         max_length={"mag_type": 20, "mag_source": 10})
DIM_NETWORK = Contract("dm.dim_network", _struct(("network_id", K), ("net", S), ("location_source", S)),
                       key=("network_id",), natural_key=("net", "location_source"), not_null=("network_id", "net", "location_source"),
                       max_length={"net": 10, "location_source": 10})
DIM_STATUS = Contract("dm.dim_status", _struct(("status_id", K), ("status", S)),
                      key=("status_id",), natural_key=("status",), not_null=("status_id", "status"),
                      max_length={"status": 20})
DIM_EVENT_TYPE = Contract("dm.dim_event_type", _struct(("event_type_id", K), ("event_type", S)),
                          key=("event_type_id",), natural_key=("event_type",), not_null=("event_type_id", "event_type"),
                          max_length={"event_type": 50})

FACT_MEASURES = [
    ("mag", dec(5, 2)), ("depth", dec(10, 4)), ("nst", I), ("gap", dec(6, 2)), ("dmin", dec(8, 4)),
    ("rms", dec(6, 3)), ("horizontal_error", dec(10, 5)), ("depth_error", dec(10, 5)),
    ("mag_error", dec(10, 5)), ("mag_nst", I),
]
FACT_KEYS = ["time_id", "location_id", "mag_type_id", "network_id", "status_id", "event_type_id"]
FACT = Contract(
    "dm.fact_earthquakes",
    _struct(("id", S), *[(k, K) for k in FACT_KEYS], *FACT_MEASURES, ("dwh_loaded_at", TS)),
    key=("id",), not_null=("id",), max_length={"id": 50},
    foreign_keys={
        "time_id": ("dm.dim_time", "time_id"),
        "location_id": ("dm.dim_location", "location_id"),
        "mag_type_id": ("dm.dim_magnitude", "mag_type_id"),
        "network_id": ("dm.dim_network", "network_id"),
        "status_id": ("dm.dim_status", "status_id"),
        "event_type_id": ("dm.dim_event_type", "event_type_id"),
    },
    partition_by="event_date",
)

DIMENSIONS = [DIM_REGION, DIM_TIME, DIM_LOCATION, DIM_MAGNITUDE, DIM_NETWORK, DIM_STATUS, DIM_EVENT_TYPE]
ALL = {c.name: c for c in [STG, ODS, *DIMENSIONS, FACT]}


def contract(name: str) -> Contract:
    """Look up a contract by its layer-qualified name, e.g. ``"dm.dim_time"``."""
    return ALL[name]
