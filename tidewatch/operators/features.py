"""Lag, rolling and cyclical features with a fit/transform split."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, WindowSpec
from pyspark.sql import functions as F

from tidewatch import presets
from tidewatch.functions import normalise_missing
from tidewatch.operators.profile import unpivot
from tidewatch.plans.ordering import over_series
from tidewatch.plans.selection import exact_quantiles
from tidewatch.plans.staging import stage


@dataclass(frozen=True)
class FeatureSpec:
    """What to compute.

    ``order_by`` must identify a row within its series; its first column is the
    event time. ``keys`` name the series; without keys the table is one series.
    """

    target: str
    order_by: tuple[str, ...]
    numeric: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    lags: tuple[int, ...] = presets.LAGS
    windows: tuple[int, ...] = presets.ROLLING_WINDOWS
    hour_of_day: bool = True
    # False computes rolling values from the rows before the current one only, so
    # that a row's target does not enter its own features.
    include_current: bool = True

    @property
    def history(self) -> int:
        rolling = [w - 1 if self.include_current else w for w in self.windows]
        return max([*self.lags, *rolling, 1])

    @property
    def feature_columns(self) -> list[str]:
        names = list(self.numeric)
        names += [f"{self.target}_lag_{n}" for n in self.lags]
        for n in self.windows:
            names += [f"{self.target}_roll_mean_{n}", f"{self.target}_roll_std_{n}"]
        if self.hour_of_day:
            names += ["hour_sin", "hour_cos"]
        return names


def lag_columns(target: str, lags: Sequence[int], window: WindowSpec) -> list[Column]:
    """Value of ``target`` n rows earlier, for each n."""
    return [F.lag(target, n).over(window).alias(f"{target}_lag_{n}") for n in lags]


def rolling_columns(
    target: str, sizes: Sequence[int], window: WindowSpec, include_current: bool = True
) -> list[Column]:
    """Mean and sample standard deviation over the last n rows; std of one row is 0."""
    columns = []
    for n in sizes:
        frame = window.rowsBetween(1 - n, 0) if include_current else window.rowsBetween(-n, -1)
        columns.append(F.avg(target).over(frame).alias(f"{target}_roll_mean_{n}"))
        columns.append(
            F.coalesce(F.stddev_samp(target).over(frame), F.lit(0.0)).alias(f"{target}_roll_std_{n}")
        )
    return columns


def hour_columns(time_column: str) -> list[Column]:
    """Hour of day as a point on the unit circle."""
    angle = F.lit(2 * math.pi) * F.hour(time_column) / 24
    return [F.sin(angle).alias("hour_sin"), F.cos(angle).alias("hour_cos")]


def add_features(df: DataFrame, spec: FeatureSpec, **sizes) -> DataFrame:
    """Append the lag, rolling and hour columns of ``spec``."""

    def build(window: WindowSpec) -> list[Column]:
        return lag_columns(spec.target, spec.lags, window) + rolling_columns(
            spec.target, spec.windows, window, spec.include_current
        )

    out = over_series(df, spec.keys, spec.order_by, spec.history, build, **sizes)
    if spec.hour_of_day:
        out = out.select("*", *hour_columns(spec.order_by[0]))
    return out


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact median per present column."""
    present = [c for c in columns if c in df.columns]
    found = exact_quantiles(df, present, [0.5])
    return {c: found[c, 0.5] for c in present}


def impute(df: DataFrame, medians: dict[str, float | None]) -> DataFrame:
    """Replace NULL and NaN by the column's median."""
    data = normalise_missing(df)
    fills = {
        c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(m)).alias(c)
        for c, m in medians.items()
        if m is not None and c in df.columns
    }
    return data.select(*[fills.get(c, F.col(f"`{c}`")) for c in data.columns])


@dataclass
class FeatureModel:
    """Fitted medians and scaler of a :class:`FeatureSpec`.

    ``transform`` gives the same feature columns, in the same order, for any input.
    """

    spec: FeatureSpec
    medians: dict[str, float | None] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    stds: dict[str, float] = field(default_factory=dict)
    feature_columns: list[str] = field(default_factory=list)

    @property
    def fitted(self) -> bool:
        return bool(self.feature_columns)

    def fit(self, df: DataFrame) -> FeatureModel:
        """Learn medians from the raw rows and the scaler from the complete feature rows."""
        self._fit_medians(df)
        return self._fit_scaler(self.complete_rows(df, self._columns(df)), self._columns(df))

    def _columns(self, df: DataFrame) -> list[str]:
        spec = self.spec
        return [c for c in spec.feature_columns if c not in spec.numeric or c in df.columns]

    def _fit_medians(self, df: DataFrame) -> None:
        self.medians = fit_medians(df, [*self.spec.numeric, self.spec.target])

    def _fit_scaler(self, rows: DataFrame, columns: list[str]) -> FeatureModel:
        moments = unpivot(rows, columns).groupBy("position").agg(
            F.count("value").alias("n"),
            F.avg("value").alias("mean"),
            F.stddev_pop("value").alias("std"),
            (F.min("value") == F.max("value")).alias("constant"),
        )
        found = {columns[r["position"]]: r for r in moments.collect()}  # a row per column
        if not found:
            raise ValueError("no row has a value in every feature column")
        self.feature_columns = columns
        self.means = {c: found[c]["mean"] for c in columns}
        self.stds = {c: 0.0 if found[c]["constant"] else found[c]["std"] for c in columns}
        self.rows = found[columns[0]]["n"]
        return self

    def complete_rows(self, df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """Unscaled features after imputation, without rows that miss any of them."""
        columns = list(columns or self.feature_columns)
        return add_features(impute(df, self.medians), self.spec).na.drop(
            "any", subset=[*columns, self.spec.target]
        )

    def divisor(self, column: str) -> float:
        """Scale of ``column``: its standard deviation, or 1 for a constant one."""
        return self.stds[column] or 1.0

    def transform(
        self, df: DataFrame, include_target: bool = True, keep: Sequence[str] = ()
    ) -> DataFrame:
        """Key and order columns, scaled features and, if wanted, the raw target.

        ``keep`` names imputed columns that come along unscaled in the struct ``inputs``.
        """
        self._require_fitted("transform")
        return self._scale(self.complete_rows(df), include_target, keep)

    def _scale(self, rows: DataFrame, include_target: bool, keep: Sequence[str] = ()) -> DataFrame:
        spec = self.spec
        labels = [c for c in (*spec.keys, *spec.order_by) if c not in self.feature_columns]
        scaled = [
            ((F.col(f"`{c}`") - F.lit(self.means[c])) / F.lit(self.divisor(c))).alias(c)
            for c in self.feature_columns
        ]
        target = [F.col(f"`{spec.target}`")] if include_target else []
        raw = [F.struct(*[F.col(f"`{c}`").alias(c) for c in keep]).alias("inputs")] if keep else []
        return rows.select(*dict.fromkeys(labels), *scaled, *target, *raw)

    def fit_transform(self, df: DataFrame, include_target: bool = True) -> DataFrame:
        """Fit and transform; the window stage runs once and its rows are staged."""
        self._fit_medians(df)
        columns = self._columns(df)
        spec = self.spec
        kept = dict.fromkeys([*spec.keys, *spec.order_by, *columns, spec.target])
        rows = stage(self.complete_rows(df, columns).select(*kept), "features")
        return self._fit_scaler(rows, columns)._scale(rows, include_target)

    def state(self, spark: SparkSession) -> DataFrame:
        """Fitted state, one row per column."""
        self._require_fitted("read the state of")
        names = list(dict.fromkeys([*self.medians, *self.feature_columns]))
        position = {c: i for i, c in enumerate(self.feature_columns)}
        rows = [
            (c, position.get(c), self.medians.get(c), self.means.get(c), self.stds.get(c))
            for c in names
        ]
        return spark.createDataFrame(
            rows, "column string, ordinal int, median double, mean double, std double"
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the fitted state below ``path``."""
        self._require_fitted("save")
        self.state(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")
        spec = spark.createDataFrame(
            [(json.dumps(asdict(self.spec)), self.rows)], "spec string, rows long"
        )
        spec.coalesce(1).write.mode("overwrite").parquet(f"{path}/spec")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeatureModel:
        """Read a state written by :meth:`save`."""
        try:
            header = spark.read.parquet(f"{path}/spec").first()
            columns = spark.read.parquet(f"{path}/columns").collect()
        except AnalysisException as e:
            raise FileNotFoundError(f"no fitted features at {path}") from e
        values = {
            k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(header["spec"]).items()
        }
        model = cls(FeatureSpec(**values))
        model.rows = header["rows"]
        fitted = sorted((r for r in columns if r["ordinal"] is not None), key=lambda r: r["ordinal"])
        imputed = {*model.spec.numeric, model.spec.target}
        model.feature_columns = [r["column"] for r in fitted]
        model.means = {r["column"]: r["mean"] for r in fitted}
        model.stds = {r["column"]: r["std"] for r in fitted}
        model.medians = {r["column"]: r["median"] for r in columns if r["column"] in imputed}
        return model

    def _require_fitted(self, action: str) -> None:
        if not self.fitted:
            raise RuntimeError(f"cannot {action} unfitted features; call fit() first")
