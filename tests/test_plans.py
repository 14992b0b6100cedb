"""The distributed shapes give what one global sort would give."""

import datetime as dt
import tempfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch.functions import clock_instant, clock_micros, instant_clock
from tidewatch.functions.columns import as_long
from tidewatch.plans import (
    before,
    dense_index,
    exact_quantiles,
    fresh_path,
    order_statistics,
    ordering,
    over_series,
    row_index,
    row_positions,
    scratch,
    selection,
    stage,
    staging,
    staging_root,
)
from tests.conftest import rows_of

ORDER = ["ts", "event_id"]


def build(window):
    return [
        F.lag("value", 24).over(window).alias("lag"),
        F.round(F.avg("value").over(window.rowsBetween(-23, 0)), 6).alias("mean"),
        F.round(F.stddev_samp("value").over(window.rowsBetween(-2, 0)), 6).alias("std"),
    ]


def test_row_index_is_the_global_row_number(events):
    expected = events.withColumn("i", F.row_number().over(Window.orderBy(*ORDER)) - 1)
    found = row_index(events, ORDER, "i")
    assert rows_of(found.select("event_id", "i")) == rows_of(expected.select("event_id", "i"))


def test_dense_index_numbers_every_row_once(events):
    numbers = [r["i"] for r in dense_index(events, "i").select("i").collect()]
    assert sorted(numbers) == list(range(events.count()))


@pytest.mark.parametrize("block_rows", [1, 100, 10_000])
def test_blocked_windows_equal_one_global_window(events, block_rows):
    expected = events.select("event_id", *build(Window.orderBy(*ORDER)))
    found = over_series(events, [], ORDER, 24, build, block_rows=block_rows)
    assert rows_of(found.select(*expected.columns)) == rows_of(expected)


@pytest.mark.parametrize("hot_rows", [0, 200, 10_000])
def test_hot_keys_equal_plain_keyed_windows(events, hot_rows):
    window = Window.partitionBy("event_type").orderBy(*ORDER)
    expected = events.select("event_id", *build(window))
    found = over_series(events, ["event_type"], ORDER, 24, build, hot_rows, block_rows=64)
    assert rows_of(found.select(*expected.columns)) == rows_of(expected)


def test_null_key_is_a_series_of_its_own(events):
    keyed = events.withColumn("key", F.nullif("event_type", F.lit("click")))
    window = Window.partitionBy("key").orderBy(*ORDER)
    expected = keyed.select("event_id", *build(window))
    found = over_series(keyed, ["key"], ORDER, 24, build, hot_rows=150, block_rows=50)
    assert rows_of(found.select(*expected.columns)) == rows_of(expected)


def short(window):
    return [F.lag("value", 3).over(window).alias("lag"),
            F.round(F.avg("value").over(window.rowsBetween(-3, 0)), 6).alias("mean")]


def as_axis(df):
    return as_long(df, ORDER[0]).cast("double")


def test_hot_keys_take_a_constant_number_of_jobs(spark, events):
    """More hot keys do not mean more passes over the table."""
    tracker = spark.sparkContext.statusTracker()

    def jobs(keys):
        spark.sparkContext.setJobGroup(f"hot{keys}", "")
        keyed = events.withColumn("key", F.col("event_id") % keys)
        rows = over_series(keyed, ["key"], ORDER, 3, short, hot_rows=0, block_rows=60)
        expected = keyed.select("event_id", *short(Window.partitionBy("key").orderBy(*ORDER)))
        assert rows_of(rows.select(*expected.columns)) == rows_of(expected)
        return len(tracker.getJobIdsForGroup(f"hot{keys}"))

    assert abs(jobs(2) - jobs(9)) <= 3


@pytest.mark.parametrize("block_rows", [1, 200, 10_000])
def test_blocks_cut_by_time_equal_one_global_window(events, block_rows):
    cut = ordering._cut_along(events, as_axis(events), events.count(), [], ORDER, 3, short, block_rows)
    expected = events.select("event_id", *short(Window.orderBy(*ORDER)))
    assert rows_of(cut.select(*expected.columns)) == rows_of(expected)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and plan.count("Exchange hashpartitioning(_blk") == 1


def test_crowded_instants_fall_back_to_row_numbers(events):
    """A third of the rows share one instant."""
    crowded = events.withColumn(
        "ts", F.when(F.col("event_id") % 3 == 0, F.lit("2024-01-09").cast("timestamp_ntz")).otherwise(F.col("ts"))
    )
    assert ordering._cut_along(crowded, as_axis(crowded), crowded.count(), [], ORDER, 1, short, 60) is None
    expected = crowded.select("event_id", *short(Window.orderBy(*ORDER)))
    found = over_series(crowded, [], ORDER, 3, short, block_rows=60)
    assert rows_of(found.select(*expected.columns)) == rows_of(expected)


def test_rows_without_time_are_kept(events):
    holes = events.withColumn("ts", F.nullif("ts", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")))
    holes = holes.withColumn("ts", F.when(F.col("event_type") != "error", F.col("ts")))
    expected = holes.select("event_id", *short(Window.orderBy(*ORDER)))
    found = over_series(holes, [], ORDER, 3, short, block_rows=150)
    assert rows_of(found.select(*expected.columns)) == rows_of(expected)


def test_no_window_without_partition_in_blocked_plan(events):
    found = over_series(events, [], ORDER, 24, build, block_rows=100)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("sort_rows", [1_000_000, 5])
def test_exact_quantiles_equal_percentile(events, sort_rows):
    probabilities = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    found = exact_quantiles(events, ["value", "user_id"], probabilities, sort_rows)
    for c in ("value", "user_id"):
        expected = events.agg(F.percentile(c, probabilities)).first()[0]
        assert [found[c, p] for p in probabilities] == pytest.approx(expected, abs=1e-12)


@pytest.mark.parametrize("sample_rows, sort_rows", [(200, 50), (200, 10**6), (3, 5)])
def test_brackets_from_a_sample_give_exact_quantiles(events, monkeypatch, sample_rows, sort_rows):
    monkeypatch.setattr(selection, "SKETCH_BYTES", 0)
    monkeypatch.setattr(selection, "SAMPLE_ROWS", sample_rows)
    probabilities = [0.0, 0.3, 0.5, 1.0]
    found = exact_quantiles(events, ["value"], probabilities, sort_rows)
    expected = events.agg(F.percentile("value", probabilities)).first()[0]
    assert [found["value", p] for p in probabilities] == pytest.approx(expected, abs=1e-12)
    (stat,) = order_statistics(events, "user_id", [700], sort_rows)
    assert stat.below <= 700 < stat.below + stat.equal


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.sampled_from([0.0, 1.0, 1.5, -3.0, 7.25]), min_size=1, max_size=40))
def test_order_statistics_with_ties(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ordered = sorted(values)
    ranks = sorted({0, len(values) // 2, len(values) - 1})
    for rank, stat in zip(ranks, order_statistics(df, "v", ranks, sort_rows=3)):
        assert stat.value == ordered[rank]
        assert stat.below == sum(v < stat.value for v in values)
        assert stat.equal == values.count(stat.value)


def test_quantiles_skip_nan_and_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (4.0,)], "v double")
    assert exact_quantiles(df, ["v"], [0.5]) == {("v", 0.5): 2.5}
    assert exact_quantiles(df.filter("v IS NULL"), ["v"], [0.5]) == {("v", 0.5): None}


@pytest.mark.parametrize("order", [ORDER, ["user_id", "event_id"], ["user_id", "props", "event_id"]])
def test_row_positions_split_at_the_rank(events, order):
    n = events.count()
    ranks = [1, n // 3, n - 1]
    for rank, position in zip(ranks, row_positions(events, order, ranks, sort_rows=10)):
        assert events.filter(before(events, order, position)).count() == rank


def test_repeated_rows_have_no_position(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "i long")
    with pytest.raises(ValueError, match="repeat"):
        row_positions(df, ["i"], [1])


def test_split_filter_reaches_the_scan(events):
    (position,) = row_positions(events, ORDER, [500])
    plan = events.filter(before(events, ORDER, position))._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(ts), LessThan" in plan


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_clock_time_ignores_the_session_zone(spark, zone):
    moments = [dt.datetime(1969, 7, 20, 20, 17, 40, 5), dt.datetime(2024, 3, 10, 2, 30)]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(m,) for m in moments], "ts timestamp_ntz")
        back = instant_clock(clock_instant(F.col("ts")))
        rows = df.select("ts", clock_micros(F.col("ts")).alias("us"), back.alias("back")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    for row in rows:
        assert row["us"] == (row["ts"] - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
        assert row["back"] == row["ts"]


def test_staged_tables_live_in_the_shared_folder(spark, events):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert fresh_path(spark, "x").startswith(named or tempfile.gettempdir())
    assert rows_of(stage(events, "copy")) == rows_of(events)


class Session:
    """A session with other settings."""

    def __init__(self, spark, **settings):
        self.sparkContext, self.settings = spark.sparkContext, settings
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key.replace(".", "_"), default)


def test_root_is_the_setting_or_below_the_warehouse(spark):
    assert staging_root(Session(spark, spark_checkpoint_dir="s3://bucket/shared/")) == "s3://bucket/shared"
    below = staging_root(Session(spark, spark_sql_warehouse_dir="hdfs://n/warehouse"))
    assert below == "hdfs://n/warehouse/staged"


def test_scratch_empties_its_own_tables_only(spark, events, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "staging_root", lambda spark: str(tmp_path))
    kept = stage(events, "kept")
    with scratch(spark):
        inside = stage(events, "inside")
        path = inside.inputFiles()[0].rsplit("/", 1)[0]
        assert inside.count() == 1000
    assert spark.read.schema(events.schema).parquet(path).count() == 0 and kept.count() == 1000


def test_cuts_do_not_grow_with_the_rows(events, monkeypatch):
    """Small blocks of a long series become larger, not more."""
    asked = []
    segment = ordering._segment
    monkeypatch.setattr(ordering, "_segment", lambda df, pairs: (asked.append(len(pairs)), segment(df, pairs))[1])
    monkeypatch.setattr(ordering, "FEW_BLOCKS", 5, raising=False)
    short = lambda w: [F.lag("value", 1).over(w).alias("before")]
    found = over_series(events, ["event_type"], ORDER, 1, short, hot_rows=0, block_rows=2)
    plain = over_series(events, ["event_type"], ORDER, 1, short)
    assert rows_of(found) == rows_of(plain.select(found.columns))
    assert asked and max(asked) <= 5


def test_a_key_of_some_million_rows_is_not_one_task(spark):
    rows = spark.range(2_400_000).select("id", F.lit(1).alias("key"), F.col("id").cast("double").alias("value"))
    found = over_series(rows, ["key"], ["id"], 3, lambda w: [F.lag("value", 3).over(w).alias("lag")])
    parts = found.groupBy(F.spark_partition_id()).agg(
        F.count(F.lit(1)).alias("n"), F.count("lag").alias("known"), F.sum(F.col("value") - F.col("lag")).alias("apart")
    ).collect()
    assert sum(r["n"] for r in parts) == 2_400_000 and max(r["n"] for r in parts) < 2_400_000
    assert sum(r["known"] for r in parts) == 2_399_997 and sum(r["apart"] for r in parts) == 3.0 * 2_399_997
