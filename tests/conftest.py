import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidewatch import presets

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def events(spark):
    return spark.read.parquet(f"{SF}/events.parquet")


@pytest.fixture(scope="session")
def weather(spark):
    """200 hourly rows with the weather columns; snowfall is constant."""
    return weather_rows(spark, 200)


def weather_rows(spark, n):
    """Weather columns filled from the first events: each a digest of the event, scaled
    into a range of its own."""
    events = spark.read.parquet(f"{SF}/events.parquet").filter(F.col("event_id") < n)
    level = lambda c: F.pmod(F.xxhash64("event_id", "value", F.lit(c)), F.lit(10_007)) / 10_007
    spans = {c: presets.REQUEST_LIMITS[c] for c in presets.WEATHER_COLUMNS}
    columns = [
        (low + level(c) * ((high or low + 2) - low)).alias(c)
        for c, (low, high) in ((c, (low or 0.0, high)) for c, (low, high) in spans.items())
    ]
    columns = [F.lit(0.0).alias("snowfall") if c == "snowfall" else x for c, x in zip(spans, columns)]
    hour = F.timestamp_add("HOUR", F.col("event_id"), F.lit("2024-01-01").cast("timestamp_ntz"))
    return spark.createDataFrame(events.select(hour.alias("time"), *columns).collect())


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
