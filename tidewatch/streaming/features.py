"""Lag and rolling features over a stream, independent of how it is cut into batches.

Each key keeps its state in the state store: the rows that wait, by hours, and the last rows that
later windows look back to. Rows wait until the watermark, the newest time seen less the allowed
lateness, has passed them; then no earlier row can come any more and their features are final.
A timer wakes a key when its first waiting row is passed, so a batch touches the keys that it
brings rows for, or whose time has come, and no others.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidewatch.functions import clock_instant, clock_micros
from tidewatch.operators.features import FeatureSpec, add_features, hour_columns

LATE = "late"
BUCKET = 3_600_000_000  # microseconds of rows that wait together
TOGETHER = 1 << 17  # new rows of a key that are put to their hours at a time
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_MICROS, _KEY = "_micros", "_series"


@dataclass(frozen=True)
class FeatureStream:
    """Where a feature stream keeps its rows and how late a row may come.

    ``out`` gets a folder per batch with the final rows, their features, and ``late`` rows without
    features: those without a time, or not after the watermark of the batch before theirs.
    """

    spec: FeatureSpec
    out: str
    lateness: timedelta

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Process what is there, batch by batch."""
        spark = stream.sparkSession
        before = spark.conf.get(PROVIDER, None)
        spark.conf.set(PROVIDER, ROCKS)  # the query keeps the setting that it starts with
        try:
            return (
                self.rows(stream)
                .writeStream.foreachBatch(self._write)
                .option("checkpointLocation", checkpoint)
                .trigger(availableNow=True)
                .start()
            )
        finally:
            if before is None:
                spark.conf.unset(PROVIDER)
            else:
                spark.conf.set(PROVIDER, before)

    def rows(self, stream: DataFrame) -> DataFrame:
        """The columns of ``stream``, the features, and ``late``."""
        spec, time = self.spec, self.spec.order_by[0]
        delay = f"{round(self.lateness / timedelta(microseconds=1))} microseconds"
        # The watermark goes by a column of its own that ends here, so that late rows are not
        # dropped before they can be told apart.
        marked = stream.withColumn("_instant", clock_instant(F.col(time))).withWatermark("_instant", delay).drop("_instant")
        keys = [F.col(f"`{c}`") for c in spec.keys]
        named = marked.withColumns({_MICROS: clock_micros(F.col(time)), _KEY: F.to_json(F.struct(*keys)) if keys else F.lit("")})
        kept = T.StructType([f for f in named.schema.fields if f.name != _KEY])
        extra = [T.StructField(c, T.DoubleType()) for c in _numbers(spec)]
        schema = T.StructType([*stream.schema.fields, *extra, T.StructField(LATE, T.BooleanType())])
        found = named.groupBy(_KEY).transformWithStateInPandas(
            statefulProcessor=_Series(spec, kept, [f.name for f in schema.fields]),
            outputStructType=schema,
            outputMode="Append",
            timeMode="EventTime",
        )
        if spec.hour_of_day:
            found = found.select("*", *[F.when(~F.col(LATE), c).alias(n) for c, n in zip(hour_columns(time), ("hour_sin", "hour_cos"))])
        return found

    def _write(self, rows: DataFrame, batch: int) -> None:
        """One write of the whole batch; a replay overwrites it."""
        rows.write.mode("overwrite").parquet(f"{self.out}/batch={batch}")

    def finish(self, spark: SparkSession, checkpoint: str, schema: T.StructType) -> None:
        """Write the features of all rows that still wait, as one more batch, for the end of a stream.

        Read from the state store; the batch operator computes them after the last rows of each key.
        """
        state = spark.read.format("statestore").option("path", checkpoint)
        kept_schema = T.StructType([*schema.fields, T.StructField(_MICROS, T.LongType())])

        def unpack(batches):
            for batch in batches:
                for value in batch.column(0):
                    yield from _unpacked(value.as_py()).to_batches()

        def of(variable: str, value: str, new: bool) -> DataFrame:
            packed = state.option("stateVarName", variable).load().select(F.col(f"{value}.rows").alias("rows"))
            return packed.mapInArrow(unpack, kept_schema).drop(_MICROS).withColumn("_new", F.lit(new))

        series = of("kept", "value", False).unionByName(of("waiting", "user_map_value", True))
        last = add_features(series, self.spec).filter("_new").drop("_new").withColumn(LATE, F.lit(False))
        done = spark.read.parquet(self.out).agg(F.max("batch")).first()[0]
        self._write(last, -1 if done is None else done + 1)


def _numbers(spec: FeatureSpec) -> list[str]:
    """Names of the lag and rolling columns."""
    return [c for c in spec.feature_columns if c.startswith(f"{spec.target}_lag_") or c.startswith(f"{spec.target}_roll_")]


def _packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(value: bytes) -> pa.Table:
    return pa.ipc.open_stream(value).read_all()


class _Series(StatefulProcessor):
    """State of one key: waiting rows by bucket of time, and the last rows that were final.

    Rows that come to a bucket are a part of their own, so that those before them are not written again.
    """

    def __init__(self, spec: FeatureSpec, schema: T.StructType, columns: list[str]):
        self.spec, self.schema, self.columns = spec, schema, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "bucket long, part long", "rows binary")
        self.parts = handle.getValueState("parts", "made long")
        self.kept = handle.getValueState("kept", "rows binary")
        self.arrow = to_arrow_schema(self.schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        held, count, first = [], 0, None
        for frame in rows:
            # Computed columns arrive without their names, so places count; the key is the last.
            there = frame.iloc[:, : len(self.arrow.names)].set_axis(self.arrow.names, axis=1)
            late = there[_MICROS].isna()
            if mark > 0:
                late |= there[_MICROS] <= mark
            if late.any():
                yield there[late].assign(**{LATE: True}).reindex(columns=self.columns)
            there = there[~late].astype({_MICROS: np.int64})
            if len(there):
                least = int(there[_MICROS].min())
                first = least if first is None else min(first, least)
                held.append(pa.Table.from_pandas(there, self.arrow, preserve_index=False))
                count += len(there)
            if count >= TOGETHER:
                self._wait(pa.concat_tables(held))
                held, count = [], 0
        if held:
            self._wait(pa.concat_tables(held))
        if first is not None:
            self._wake(first)

    def _wait(self, rows: pa.Table) -> None:
        """Add rows to their buckets, as a part each."""
        made = self.parts.get()[0] if self.parts.exists() else 0
        bucket = np.asarray(rows.column(_MICROS)) // BUCKET
        order = np.argsort(bucket, kind="stable")
        rows, bucket = rows.take(pa.array(order)).combine_chunks(), bucket[order]
        starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        for start, end in zip(starts, np.append(starts[1:], len(bucket)), strict=True):
            self.waiting.updateValue((int(bucket[start]), made), (_packed(rows.slice(start, end - start)),))
        self.parts.update((made + 1,))

    def _rows(self, bucket: int, parts: Sequence[int]) -> pa.Table:
        return pa.concat_tables([_unpacked(bytes(self.waiting.getValue((bucket, part))[0])) for part in parts])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        waiting: dict[int, list[int]] = {}
        for bucket, part in sorted(self.waiting.keys()):
            waiting.setdefault(bucket, []).append(part)
        for bucket, parts in waiting.items():
            if bucket * BUCKET > mark:
                self._wake(int(np.asarray(self._rows(bucket, parts).column(_MICROS)).min()))
                return
            rows = self._rows(bucket, parts)
            final = np.asarray(rows.column(_MICROS)) <= mark
            if final.any():
                for part in parts[1:] if not final.all() else parts:
                    self.waiting.removeKey((bucket, part))
                if not final.all():
                    self.waiting.updateValue((bucket, parts[0]), (_packed(rows.filter(pa.array(~final))),))
                yield self._featured(rows.filter(pa.array(final)))
            if not final.all():
                self._wake(int(np.asarray(rows.column(_MICROS))[~final].min()))
                return

    def _wake(self, micros: int) -> None:
        """Set a timer for the moment when the watermark has passed a time."""
        at = -(-micros // 1000)
        if at not in set(self.handle.listTimers()):
            self.handle.registerTimer(at)

    def _featured(self, rows: pa.Table) -> pd.DataFrame:
        """Rows that became final, in order, after the kept ones; keeps the new last ones."""
        order = list(self.spec.order_by)
        rows = rows.sort_by([(c, "ascending") for c in order])
        held = self.kept.get() if self.kept.exists() else None
        before = _unpacked(bytes(held[0])) if held else rows.slice(0, 0)
        both = pa.concat_tables([before, rows])
        self.kept.update((_packed(both.slice(max(0, both.num_rows - self.spec.history))),))
        values = both.column(self.spec.target)
        known = ~np.asarray(values.is_null())
        numbers = np.where(known, np.asarray(values.cast(pa.float64()).fill_null(0.0)), np.nan)
        found = window_numbers(numbers, known, self.spec)
        frame = rows.to_pandas()
        for name, column in found.items():
            frame[name] = column[before.num_rows :]
        return frame.assign(**{LATE: False})[self.columns]


def window_numbers(numbers: np.ndarray, known: np.ndarray, spec: FeatureSpec) -> dict[str, np.ndarray]:
    """Lag and rolling columns of one ordered series; NaN where the batch operator has NULL."""
    n, out = len(numbers), {}
    for lag in spec.lags:
        out[f"{spec.target}_lag_{lag}"] = np.concatenate([np.full(min(lag, n), np.nan), numbers[: max(0, n - lag)]])
    for size in spec.windows:
        back = size - 1 if spec.include_current else size
        padded = np.concatenate([np.zeros(back), np.where(known, numbers, 0.0)])
        there = np.concatenate([np.zeros(back, bool), known])
        # Without the current row the last window has one row too many at its end.
        values = np.lib.stride_tricks.sliding_window_view(padded, size)[:n]
        mask = np.lib.stride_tricks.sliding_window_view(there, size)[:n]
        count = mask.sum(axis=1)
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = values.sum(axis=1) / count
            spread = np.where(mask, values - mean[:, None], 0.0)
            deviation = np.sqrt(np.square(spread).sum(axis=1) / (count - 1))
        out[f"{spec.target}_roll_mean_{size}"] = np.where(count > 0, mean, np.nan)
        out[f"{spec.target}_roll_std_{size}"] = np.where(count > 1, deviation, 0.0)
    return out


def read_features(spark: SparkSession, stream: FeatureStream, columns: Sequence[str | Column] = ("*",)) -> DataFrame:
    """All features written so far."""
    return spark.read.parquet(stream.out).filter(~F.col(LATE)).drop("batch", LATE).select(*columns)


def read_late(spark: SparkSession, stream: FeatureStream) -> DataFrame:
    """Rows that came too late, or without a time."""
    return spark.read.parquet(stream.out).filter(LATE).drop("batch", LATE)
