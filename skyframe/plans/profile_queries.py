"""Delay dataset: loading, validation, profiling and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframe import constants as K
from skyframe.operators import profile, requests, split
from skyframe.plans.registry import query
from skyframe.plans.standins import view
from skyframe.session import new_folder
from skyframe.sources import flights as source
from skyframe.sources import profiles

KEY = ("Flight",)


def flights(spark, sf_dir) -> DataFrame:
    return view(spark, sf_dir, "flights")


@query("SELECT * REPLACE (CASE WHEN Flight % 5 = 0 THEN Flight + 9007199254740993 ELSE Flight END AS Flight) FROM flights")
def load_flights(spark, sf_dir):
    path = new_folder(spark, "flights")
    # As text with a fraction, and beyond what a double holds: both must come back as they were.
    big = F.when(F.col("Flight") % 5 == 0, F.col("Flight") + F.lit(9007199254740993)).otherwise(F.col("Flight"))
    day = F.when(F.col("Flight") % 3 == 0, F.concat(F.col("DayOfWeek").cast("string"), F.lit(".0"))).otherwise(F.col("DayOfWeek").cast("string"))
    flights(spark, sf_dir).withColumn("Flight", big).withColumn("DayOfWeek", day).write.option("header", True).csv(path)
    return source.load_flights(spark, path)


def requests_of(spark, sf_dir) -> DataFrame:
    """Flights as scoring records, some of them out of range."""
    n = F.col("Flight")
    return flights(spark, sf_dir).select(
        "Flight",
        F.when(n % 11 == 0, 1500.0).otherwise(F.col("Time")).alias("Time"),
        F.when(n % 17 == 0, 0.0).when(n % 31 == 0, float("nan")).otherwise(F.col("Length")).alias("Length"),
        F.when(n % 23 == 0, "   ").otherwise(F.lower("Airline")).alias("Airline"),
        F.when(n % 19 == 0, " JFK ").otherwise(F.lower("AirportFrom")).alias("AirportFrom"),
        "AirportTo",
        F.when(n % 13 == 0, 9.0).when(n % 29 == 0, 1.5).otherwise(F.col("DayOfWeek")).alias("DayOfWeek"),
    )


def shown(checked: DataFrame) -> DataFrame:
    """Not a number as null, which both engines compare alike."""
    return checked.withColumn("Length", F.nanvl("Length", F.lit(None).cast("double")))


CHECKED = """
    r AS (SELECT Flight, CASE WHEN Flight % 11 = 0 THEN 1500 ELSE Time END AS Time,
        CASE WHEN Flight % 17 = 0 THEN 0 WHEN Flight % 31 = 0 THEN NULL ELSE Length END AS Length,
        CASE WHEN Flight % 23 = 0 THEN '' ELSE Airline END AS Airline,
        CASE WHEN Flight % 19 = 0 THEN 'JFK' ELSE AirportFrom END AS AirportFrom, AirportTo,
        CAST(CASE WHEN Flight % 13 = 0 THEN 9 WHEN Flight % 29 = 0 THEN 1.5 ELSE DayOfWeek END AS double) AS DayOfWeek,
        concat_ws(',', CASE WHEN Flight % 19 = 0 THEN 'AirportFrom' END,
          CASE WHEN Flight % 13 = 0 OR Flight % 29 = 0 THEN 'DayOfWeek' END,
          CASE WHEN Flight % 17 = 0 OR Flight % 31 = 0 THEN 'Length' END, CASE WHEN Flight % 11 = 0 THEN 'Time' END) AS reasons
      FROM flights)
"""


@query(f"WITH {CHECKED} SELECT * FROM r")
def validate_requests(spark, sf_dir):
    checked = requests.check_requests(requests_of(spark, sf_dir))
    return shown(checked).withColumn("reasons", F.concat_ws(",", "reasons"))


@query(f"WITH {CHECKED} SELECT * EXCLUDE (reasons) FROM r WHERE reasons = ''")
def valid_requests(spark, sf_dir):
    return requests.valid_requests(requests.check_requests(requests_of(spark, sf_dir)))


@query("SELECT * EXCLUDE (Class) FROM flights")
def xy_columns(spark, sf_dir):
    return profile.features_only(flights(spark, sf_dir))


@query("SELECT Class FROM flights")
def xy_target(spark, sf_dir):
    return profile.target_only(flights(spark, sf_dir))


@query("SELECT Time, CAST(NULL AS double) AS Length, Airline, AirportFrom, AirportTo, DayOfWeek FROM flights")
def select_features(spark, sf_dir):
    chosen = profile.select_features(flights(spark, sf_dir).drop("Length"))
    return chosen.withColumn("Length", F.col("Length").cast("double"))


@query(
    """
    SELECT Class AS class, count(*) AS flights, CASE Class WHEN 0 THEN 'On-time' ELSE 'Delayed' END AS label,
      count(*) / CAST((SELECT count(*) FROM flights) AS double) AS share
    FROM flights GROUP BY Class
    """
)
def class_balance(spark, sf_dir):
    return profile.class_balance(flights(spark, sf_dir))


OVERALL = "(SELECT sum(Class) / CAST(count(*) AS double) FROM flights)"


@query(
    f"""
    SELECT DayOfWeek AS day_of_week, count(*) AS flights, sum(Class) / CAST(count(*) AS double) AS delay_rate,
      {OVERALL} AS overall_rate FROM flights GROUP BY DayOfWeek
    """
)
def delay_rate_by_dow(spark, sf_dir):
    return profile.delay_rate_by_dow(flights(spark, sf_dir))


@query(
    f"""
    SELECT Airline AS airline, count(*) AS flights, sum(Class) / CAST(count(*) AS double) AS delay_rate,
      {OVERALL} AS overall_rate FROM flights GROUP BY Airline ORDER BY flights DESC, airline LIMIT {K.TOP_CARRIERS}
    """
)
def delay_rate_top_airlines(spark, sf_dir):
    return profile.delay_rate_top_airlines(flights(spark, sf_dir))


@query(
    f"""
    SELECT AirportFrom AS airline, count(*) AS flights, sum(Class) / CAST(count(*) AS double) AS delay_rate,
      {OVERALL} AS overall_rate FROM flights GROUP BY AirportFrom ORDER BY flights DESC, airline LIMIT {K.TOP_CARRIERS}
    """
)
def top_k_ties(spark, sf_dir):
    """The same report over origin airports, where there are more than twelve groups and many ties."""
    return profile.delay_rate_top_airlines(flights(spark, sf_dir), airline="AirportFrom")


DISTINCT_OF = {"airlines": "Airline", "airports_from": "AirportFrom", "airports_to": "AirportTo"}


@query(
    """
    SELECT count(DISTINCT Airline) AS airlines, count(DISTINCT AirportFrom) AS airports_from,
      count(DISTINCT AirportTo) AS airports_to FROM flights
    """
)
def distinct_counts(spark, sf_dir):
    return profile.distinct_counts(flights(spark, sf_dir), DISTINCT_OF)


POSITION_NULLABLE = (
    "id", "icao24", "time_position", "callsign", "longitude", "latitude", "on_ground", "true_track", "vertical_rate",
    "updated_at",
)


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM positions" for c in POSITION_NULLABLE
    )
)
def null_counts(spark, sf_dir):
    return profile.null_counts(view(spark, sf_dir, "positions"))


DESCRIBED = ("Flight", "Time", "Length", "DayOfWeek", "Class")


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
        CAST(min({c}) AS double) AS min, quantile_cont(CAST({c} AS double), 0.25) AS p25,
        quantile_cont(CAST({c} AS double), 0.5) AS p50, quantile_cont(CAST({c} AS double), 0.75) AS p75,
        CAST(max({c}) AS double) AS max FROM flights"""
        for c in DESCRIBED
    )
)
def describe(spark, sf_dir):
    described = profile.describe(flights(spark, sf_dir))
    return described.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, count(*) - count({c}) AS nulls, round(avg({c}), 6) AS mean,
        round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS double) AS min, CAST(max({c}) AS double) AS max FROM flights"""
        for c in DESCRIBED
        if c != "DayOfWeek"
    )
)
def merged_profile(spark, sf_dir):
    """Days profiled one by one and merged; of what is stored, the columns that are exact."""
    path, rows = new_folder(spark, "profiles"), flights(spark, sf_dir)
    for part in ("DayOfWeek < 4 OR DayOfWeek IS NULL", "DayOfWeek >= 4"):
        profiles.add_days(rows.where(part), path, "DayOfWeek", [c for c in DESCRIBED if c != "DayOfWeek"])
    whole = profiles.merged(profiles.read_days(spark, path))
    return whole.select("column", "count", "nulls", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min", "max")


@query(
    """
    SELECT (SELECT count(*) FROM flights) AS rows, * FROM (VALUES (0, 'Flight', 'bigint'), (1, 'Time', 'double'),
      (2, 'Length', 'double'), (3, 'Airline', 'string'), (4, 'AirportFrom', 'string'), (5, 'AirportTo', 'string'),
      (6, 'DayOfWeek', 'int'), (7, 'Class', 'int')) t(position, "column", dtype)
    """
)
def shape_dtypes(spark, sf_dir):
    return profile.shape_dtypes(flights(spark, sf_dir))


def histogram_sql(column: str, bins: int) -> str:
    return f"""
    WITH b AS (SELECT min({column}) AS lo, max({column}) AS hi, (max({column}) - min({column})) / {bins} AS width FROM flights)
    SELECT class, bin, lo + bin * width AS bin_start, lo + (bin + 1) * width AS bin_end, count(*) AS flights
    FROM (SELECT Class AS class, lo, width, CAST(least(floor(({column} - lo) / width), {bins - 1}) AS int) AS bin
      FROM flights, b) GROUP BY class, bin, lo, width
    """


@query(histogram_sql("Time", K.TIME_BINS))
def histogram_by_class(spark, sf_dir):
    return profile.histogram_by_class(flights(spark, sf_dir), "Time", K.TIME_BINS)


@query(histogram_sql("Length", K.LENGTH_BINS))
def histogram_length(spark, sf_dir):
    return profile.histogram_by_class(flights(spark, sf_dir), "Length", K.LENGTH_BINS)


# Rows per class and split by largest remainder, then rows in md5 order.
SPLIT = f"""
    cnt AS (SELECT Class, count(*) AS k FROM flights GROUP BY Class),
    tot AS (SELECT CAST(sum(k) AS bigint) AS n, CAST(ceil({K.TEST_SHARE}e0 * sum(k)) AS bigint) AS n_test FROM cnt),
    siz AS (SELECT n, n_test, CAST(ceil({K.VAL_SHARE}e0 / (1e0 - {K.TEST_SHARE}e0) * (n - n_test)) AS bigint) AS n_val FROM tot),
    r0 AS (SELECT Class, k, (k * (n - n_test)) // n AS f, (k * (n - n_test)) % n AS rem, n - n_test AS want FROM cnt, siz),
    r1 AS (SELECT Class, k, f + CASE WHEN row_number() OVER (ORDER BY rem DESC, Class) <= want - sum(f) OVER ()
        THEN 1 ELSE 0 END AS rest FROM r0),
    t0 AS (SELECT Class, k, rest, (rest * (n - n_test - n_val)) // (n - n_test) AS f,
        (rest * (n - n_test - n_val)) % (n - n_test) AS rem, n - n_test - n_val AS want FROM r1, siz),
    t1 AS (SELECT Class, k - rest AS n_test_c, rest - (f + CASE WHEN row_number() OVER (ORDER BY rem DESC, Class) <= want - sum(f) OVER ()
        THEN 1 ELSE 0 END) AS n_val_c FROM t0),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY Class ORDER BY md5(concat(CAST(Flight AS varchar), '|42'))) AS rn FROM flights),
    split AS (SELECT f.* EXCLUDE (rn), CASE WHEN rn <= n_test_c THEN 'test' WHEN rn <= n_test_c + n_val_c THEN 'val'
        ELSE 'train' END AS split FROM ranked f JOIN t1 ON f.Class = t1.Class)
"""


def split_of(spark, sf_dir) -> DataFrame:
    return split.stratified_split(flights(spark, sf_dir), key=KEY)


@query(f"WITH {SPLIT} SELECT * FROM split")
def stratified_split(spark, sf_dir):
    return split_of(spark, sf_dir)


@query(
    f"""
    WITH {SPLIT}
    SELECT split, count(*) AS rows, sum(Class) / CAST(count(*) AS double) AS delay_rate, {OVERALL} AS overall_rate,
      count(*) / CAST((SELECT count(*) FROM flights) AS double) AS share, true AS size_ok, true AS rate_ok
    FROM split GROUP BY split
    """
)
def split_summary(spark, sf_dir):
    return profile.split_summary(split_of(spark, sf_dir))


@query(f"WITH {SPLIT} SELECT * EXCLUDE (split) FROM split WHERE split <> 'test'")
def train_plus_val(spark, sf_dir):
    parts = split_of(spark, sf_dir)
    train, val = [parts.where(F.col("split") == s).drop("split") for s in ("train", "val")]
    return split.train_plus_val(train, val)


SAMPLE = 1000
RANKED = "row_number() OVER (PARTITION BY Class ORDER BY md5(concat(CAST(Flight AS varchar), '|42'))) AS rn"


@query(
    f"""
    WITH cnt AS (SELECT Class, count(*) AS k, (SELECT count(*) FROM flights) AS n FROM flights GROUP BY Class),
    f AS (SELECT Class, (k * {SAMPLE}) // n AS f, (k * {SAMPLE}) % n AS rem FROM cnt),
    q AS (SELECT Class, f + CASE WHEN row_number() OVER (ORDER BY rem DESC, Class) <= {SAMPLE} - sum(f) OVER ()
      THEN 1 ELSE 0 END AS take FROM f)
    SELECT r.* EXCLUDE (rn) FROM (SELECT *, {RANKED} FROM flights) r JOIN q ON q.Class = r.Class WHERE rn <= take
    """
)
def stratified_sample(spark, sf_dir):
    return split.stratified_sample(flights(spark, sf_dir), SAMPLE, key=KEY)


@query(f"SELECT * FROM flights ORDER BY md5(concat(CAST(Flight AS varchar), '|42')) LIMIT {SAMPLE}")
def sample_n(spark, sf_dir):
    return split.sample_n(flights(spark, sf_dir), SAMPLE, key=KEY)
