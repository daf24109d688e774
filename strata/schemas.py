"""Schema contracts for the layered datasets.

Bronze schemas are declared, never inferred: a CSV header is skipped and the
columns map by position, so the field order below is part of the contract.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

S, I, D = StringType(), IntegerType(), DoubleType()


def _struct(fields: list[tuple[str, DataType]]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# --- Fixed values: source field names, types and order of the bronze inputs. ---
# In the tsunami file a space in a field name is spelled "Nan"; several names
# carry ".", "(", ")" or "$" and must be quoted with backticks in expressions.

COUNTRY_FIELDS = [
    ("City", S), ("Latitude", D), ("Longitude", D), ("Country", S), ("Continent", S),
]

EARTHQUAKE_FIELDS = [
    ("title", S), ("magnitude", D), ("date_time", S), ("cdi", I), ("mmi", I),
    ("alert", S), ("tsunami", I), ("sig", I), ("net", S), ("nst", I), ("dmin", D),
    ("gap", D), ("magType", S), ("depth", S), ("latitude", D), ("longitude", D),
    ("location", S), ("continent", S), ("country", S),
]

TSUNAMI_FIELDS = [
    ("Sr.no", I), ("Year", I), ("Mo", I), ("Dy", I), ("Hr", I), ("Mn", I), ("Sec", D),
    ("TsunamiNanEventNanValidity", I), ("TsunamiNanCauseNanCode", I),
    ("EarthquakeNanMagnitude", D), ("Vol", I), ("MoreNanInfo", S), ("Deposits", I),
    ("Country", S), ("LocationNanName", S), ("Latitude", D), ("Longitude", D),
    ("MaximumNanWaterNanHeightNan(m)", D), ("NumberNanofNanRunups", I),
    ("TsunamiNanMagnitudeNan(Abe)", D), ("TsunamiNanMagnitudeNan(Iida)", D),
    ("TsunamiNanIntensity", D), ("Deaths", I), ("DeathNanDescription", S),
    ("Missing", I), ("MissingNanDescription", S), ("Injuries", I),
    ("InjuriesNanDescription", S), ("DamageNan($Mil)", D), ("DamageNanDescription", S),
    ("HousesNanDestroyed", I), ("HousesNanDestroyedNanDescription", S),
    ("HousesNanDamaged", I), ("HousesNanDamagedNanDescription", S),
    ("TotalNanDeaths", I), ("TotalNanDeathNanDescription", S), ("TotalNanMissing", I),
    ("TotalNanMissingNanDescription", S), ("TotalNanInjuries", I),
    ("TotalNanInjuriesNanDescription", S), ("TotalNanDamageNan($Mil)", D),
    ("TotalNanDamageNanDescription", S), ("TotalNanHousesNanDestroyed", I),
    ("TotalNanHousesNanDestroyedNanDescription", S), ("TotalNanHousesNanDamaged", I),
    ("TotalNanHousesNanDamagedNanDescription", S),
]

# Date and time parts of a tsunami row; removed once `time_stamp` is built.
TSUNAMI_TIME_PARTS = ["Year", "Mo", "Dy", "Hr", "Mn", "Sec"]

# Text formats and constants of the cleaning steps.
EARTHQUAKE_TIME_FORMAT = "dd-MM-yyyy HH:mm"
PARTS_TIME_FORMAT = "yyyy-MM-dd HH:mm"
LOCATION_SEPARATOR = ", "
SPACE_TOKEN = "Nan"
POWER_MEASURAND = "Power.Active.Import"
SECONDS_PER_HOUR = 3600
WH_PER_KWH = 1000
# --- end of fixed values ---

COUNTRY_SCHEMA = _struct(COUNTRY_FIELDS)
EARTHQUAKE_SCHEMA = _struct(EARTHQUAKE_FIELDS)
TSUNAMI_SCHEMA = _struct(TSUNAMI_FIELDS)



def silver_earthquake_schema(bronze: StructType) -> StructType:
    """Contract of the silver earthquakes of a bronze layout: a timestamp last in
    place of the date text."""
    return StructType([*[f for f in bronze.fields if f.name != "date_time"], StructField("time_stamp", TimestampNTZType(), True)])


def silver_tsunami_schema(bronze: StructType) -> StructType:
    """Contract of the silver tsunamis: a timestamp last in place of its parts."""
    return StructType([*[f for f in bronze.fields if f.name not in TSUNAMI_TIME_PARTS], StructField("time_stamp", TimestampNTZType(), True)])


GOLD_EARTHQUAKE_SCHEMA = StructType(
    [
        StructField("Country", StringType(), True),
        StructField("Title", StringType(), True),
        StructField("Magnitude", DoubleType(), True),
        StructField("Depth", StringType(), True),
        StructField("Tsunami", IntegerType(), True),
        StructField("Timestamp", TimestampNTZType(), True),
    ]
)

GOLD_TOP_TSUNAMI_SCHEMA = StructType(
    [
        StructField("Country", StringType(), True),
        StructField("Timestamp", TimestampNTZType(), True),
        *[StructField(name, IntegerType(), True) for name in ("Deaths", "Missing", "Injuries", "HousesDestroyed", "HousesDamaged")],
    ]
)

# Output contracts of the gold steps (types of the driver-table mapping: keys
# are bigint there, timestamps are wall-clock `timestamp_ntz`).
CHARGE_RECORD_SCHEMA = StructType(
    [
        StructField("charge_point_id", StringType(), True),
        StructField("transaction_id", LongType(), True),
        StructField("meter_start", LongType(), True),
        StructField("meter_stop", LongType(), True),
        StructField("start_timestamp", TimestampNTZType(), True),
        StructField("stop_timestamp", TimestampNTZType(), True),
        StructField("total_time", DoubleType(), True),
        StructField("total_energy", DoubleType(), True),
        StructField("total_parking_time", DoubleType(), True),
    ]
)


def assert_contract(actual: StructType, expected: StructType, check_nullable: bool = False) -> None:
    """Raise ``ValueError`` when names, order or types differ from the contract."""
    got = [(f.name, f.dataType) for f in actual.fields]
    want = [(f.name, f.dataType) for f in expected.fields]
    if got != want:
        raise ValueError(f"schema contract violated:\n got  {got}\n want {want}")
    if check_nullable:
        bad = [f.name for f, e in zip(actual.fields, expected.fields) if f.nullable != e.nullable]
        if bad:
            raise ValueError(f"nullability differs for {bad}")
