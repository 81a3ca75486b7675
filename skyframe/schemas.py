"""Column layouts."""

from pyspark.sql import types as T

BRONZE = T.StructType(
    [
        T.StructField("payload", T.StringType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("load_date", T.TimestampType()),
        T.StructField("pipeline_run_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("fetched_date", T.DateType()),
    ]
)

# The same with the payload parsed at landing.
BRONZE_PARSED = T.StructType(
    [*BRONZE.fields, T.StructField("fields", T.VariantType()), T.StructField("has_fields", T.BooleanType())]
)

# Columns of the position table.
POSITIONS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("created_at", T.TimestampType(), False),
        T.StructField("icao24", T.StringType()),
        T.StructField("time_position", T.IntegerType()),
        T.StructField("callsign", T.StringType()),
        T.StructField("longitude", T.FloatType()),
        T.StructField("latitude", T.FloatType()),
        T.StructField("on_ground", T.BooleanType()),
        T.StructField("true_track", T.DoubleType()),
        T.StructField("vertical_rate", T.DoubleType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

# The eight columns both feeds are mapped onto, in the order of the positional feed.
POSITION_COLUMNS = [
    "icao24",
    "callsign",
    "time_position",
    "longitude",
    "latitude",
    "on_ground",
    "true_track",
    "vertical_rate",
]

# Columns of the live map.
CURRENT_COLUMNS = [
    "icao24",
    "callsign",
    "longitude",
    "latitude",
    "on_ground",
    "true_track",
    "vertical_rate",
    "updated_at",
]

# Columns of the delay dataset.
DELAY = T.StructType(
    [
        T.StructField("Flight", T.LongType()),
        T.StructField("Time", T.DoubleType()),
        T.StructField("Length", T.DoubleType()),
        T.StructField("Airline", T.StringType()),
        T.StructField("AirportFrom", T.StringType()),
        T.StructField("AirportTo", T.StringType()),
        T.StructField("DayOfWeek", T.IntegerType()),
        T.StructField("Class", T.IntegerType()),
    ]
)

# A stored flight-leg document: one call with its query and the legs it returned.
LEGS_DOCUMENT = (
    "endpoint string, query_params struct<airport:string,`begin`:bigint,`end`:bigint>, flight_count bigint, "
    "flights array<struct<icao24:string,callsign:string,firstSeen:bigint,lastSeen:bigint,"
    "estDepartureAirport:string,estArrivalAirport:string,"
    "estDepartureAirportHorizDistance:bigint,estArrivalAirportHorizDistance:bigint>>"
)
