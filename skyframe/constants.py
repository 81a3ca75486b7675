"""Fixed values shared by the operators.

These have to equal what users of the data already rely on (source names, table
names, thresholds, labels, model defaults), so they are stated here in one place.
"""

# Names of the two landed feeds and of the tables they may refresh.
POSITIONAL_SOURCE = "states_all"
KEYED_SOURCE = "adsb_raw"
POSITION_TABLES = ("map1", "q_map1")

# Bounding box in degrees, bounds included.
SOUTH, NORTH, WEST, EAST = 47.0, 52.0, 5.0, 15.0

# Centre and radius (nautical miles) of the circle the keyed feed is asked for.
CIRCLE_LAT, CIRCLE_LON, CIRCLE_RADIUS_NM = 49.5, 10.0, 150.0

# Indices read from a positional state vector, by column.
VECTOR_INDEX = {
    "icao24": 0,
    "callsign": 1,
    "time_position": 3,
    "longitude": 5,
    "latitude": 6,
    "on_ground": 8,
    "true_track": 10,
    "vertical_rate": 11,
}
VECTOR_MIN_LENGTH = 12

# Marker rules of the live map.
LEVEL_BELOW = 1.0
GROUND_COLOR = "#9ca3af"
AIRBORNE_COLOR = "#2563eb"
CLIMB_ARROW, DESCEND_ARROW = "▲", "▼"

# Headers of the aircraft table, in display order.
DISPLAY_HEADERS = {
    "icao24": "ICAO24",
    "callsign": "Callsign",
    "latitude": "Latitude",
    "longitude": "Longitude",
    "on_ground": "On Ground",
    "true_track": "Track (°)",
    "vertical_rate": "Vertical Rate (m/s)",
    "time_position": "Time Position (UTC)",
}

# Seconds after which a feed or the position table counts as stale, raw retention.
LANDING_STALE_SECONDS = 150
REFRESH_STALE_SECONDS = 30
RETENTION_HOURS = 24

# Delay dataset.
TARGET = "Class"
DELAY_COLUMNS = ["Flight", "Time", "Length", "Airline", "AirportFrom", "AirportTo", "DayOfWeek", "Class"]
FEATURE_COLUMNS = ["Time", "Length", "Airline", "AirportFrom", "AirportTo", "DayOfWeek"]
NUMERIC_FEATURES = ["Time", "Length"]
LOW_CARD_FEATURES = ["Airline", "DayOfWeek", "TimeOfDayBucket"]
HIGH_CARD_FEATURES = ["AirportFrom", "AirportTo"]
CLASS_LABELS = {0: "On-time", 1: "Delayed"}
SEED = 42
VAL_SHARE = 0.15
TEST_SHARE = 0.15

# Upper edges (minutes, edge included) of the departure buckets.
DAY_BUCKETS = [("night", 359), ("morning", 719), ("afternoon", 1079), ("evening", 1439)]
WEEKEND_DAYS = (6, 7)

# Feature documentation stored with every model.
FEATURE_SCHEMA = {
    "Time": "float (minutes since midnight, 0-1439)",
    "Length": "float (flight duration in minutes)",
    "Airline": "string (IATA carrier code)",
    "AirportFrom": "string (IATA airport code)",
    "AirportTo": "string (IATA airport code)",
    "DayOfWeek": "int (1=Monday .. 7=Sunday)",
}

# Training and reporting sizes.
SEARCH_SAMPLE = 100_000
SEARCH_DRAWS = 20
SEARCH_FOLDS = 3
IMPORTANCE_REPEATS = 5

# Bins and carriers of the profiling report.
TIME_BINS = 48
LENGTH_BINS = 50
TOP_CARRIERS = 12
