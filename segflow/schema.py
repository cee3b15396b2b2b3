"""Table schemas, column lists and codes shared by the whole package."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


_S, _I, _D, _TS = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampType()

#: One row per (segment, hour); three files: all vehicles, passenger, truck.
PROBE = _struct(
    tmc_code=_S, measurement_tstamp=_TS, speed=_D, average_speed=_D,
    travel_time_seconds=_D, data_density=_S,
)

#: Attributes of a road segment, ``direction`` still as text.
SEGMENT = _struct(
    tmc=_S, direction=_S, state=_S, county=_S, zip=_I,
    start_latitude=_D, start_longitude=_D, end_latitude=_D, end_longitude=_D,
    miles=_D, f_system=_I, urban_code=_I, aadt=_I, thrulanes=_I,
    thrulanes_unidir=_I, route_sign=_I, road=_S, intersection=_S, active_start_date=_S,
)

#: Segment geometry as text.
SHAPE = _struct(Tmc=_S, DIR=_S, F_System=_I, County=_S, State=_S, geometry=_S)

#: Counting stations. Ids are text: they carry leading zeros.
STATION = _struct(STATION_ID=_S, STATE_NAME=_S, DIR=_I, F_SYSTEM=_I, LAT=_D, LONG=_D)

#: Station-to-segment matches as the spatial join writes them.
MATCH = _struct(
    Tmc=_S, STATION_ID=_S, DIR=_I, geometry=_S, County=_S, State=_S, LAT=_D, LONG=_D, tier=_I,
)

# The 33 columns and types of the hourly count file.
COUNT = _struct(
    STATE=_I, STATION_ID=_S, DIR=_D, DATE=_S, YEAR=_I, MONTH=_I, DAY=_I, HOUR=_I,
    DAY_TYPE=_S, PEAKING=_S, VOL=_D, F_SYSTEM=_D, URB_RURAL=_S, COUNTY=_I, REPCTY=_S,
    ROUTE_SIGN=_D, ROUTE_NUMBER=_S, LAT=_D, LONG=_D, STATE_NAME=_S, COUNTY_NAME=_S,
    HPMS_TYPE10=_D, HPMS_TYPE25=_D, HPMS_TYPE40=_D, HPMS_TYPE50=_D, HPMS_TYPE60=_D,
    HPMS_ALL=_D, NOISE_AUTO=_D, NOISE_MED_TRUCK=_D, NOISE_HVY_TRUCK=_D, NOISE_BUS=_D,
    NOISE_MC=_D, NOISE_ALL=_D,
)

PROBE_KEY = ["tmc_code", "measurement_tstamp"]
COUNT_KEY = ["STATION_ID", "measurement_tstamp", "state", "DIR"]
TARGET = "VOL"
PREDICTION = "Predicted_VOL"

# Direction text to code, in the long and the one-letter form.
DIRECTIONS = {"NORTHBOUND": 1, "EASTBOUND": 3, "SOUTHBOUND": 5, "WESTBOUND": 7}
DIRECTION_LETTERS = {"N": 1, "E": 3, "S": 5, "W": 7}

# Hours (inclusive ends) of the day share and of the two peaks.
DAY_HOURS = (7, 18)
MORNING_PEAK = (6, 9)
EVENING_PEAK = (16, 19)

# The twenty dataset columns a model reads, in model order.
BASE_FEATURES = [
    "tmc_code", "measurement_tstamp", "speed_All", "data_density_All", "data_density_Pass",
    "data_density_Truck", "travel_time_seconds_All", "start_latitude", "start_longitude",
    "end_latitude", "end_longitude", "miles", "aadt", "urban_code", "thrulanes_unidir",
    "f_system", "route_sign", "thrulanes", "zip", "DIR",
]
DENSITY_COLUMNS = ["data_density_All", "data_density_Pass", "data_density_Truck"]
CALENDAR_COLUMNS = ["year", "month", "day", "hour", "dayofweek"]

# Columns that do not change from hour to hour of one segment.
STATIC_COLUMNS = {
    "tmc_code", "aadt", "TMC_Value", "start_latitude", "start_longitude", "end_latitude",
    "end_longitude", "miles", "f_system", "urban_code", "thrulanes_unidir", "route_sign",
    "thrulanes", "zip", "Population_2022",
}


def shifted_columns(columns: list[str]) -> list[str]:
    """Columns that get a ``_before`` and an ``_after`` neighbour: everything
    but the static ones and those spelled in capitals (targets, keys)."""
    return [c for c in columns if c not in STATIC_COLUMNS and not c.isupper()]


def feature_columns() -> list[str]:
    """The 48 model inputs, in model order."""
    plain = BASE_FEATURES + ["TMC_Value"] + CALENDAR_COLUMNS
    density_last = [c for c in plain if c not in DENSITY_COLUMNS]
    order = density_last[:density_last.index("travel_time_seconds_All") + 1] + DENSITY_COLUMNS
    order += [c for c in density_last if c not in order]
    neighbours = [f"{c}_{side}" for c in shifted_columns(order) for side in ("before", "after")]
    return plain + neighbours


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """Return ``df``; raise ``ValueError`` naming every column it lacks."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df
