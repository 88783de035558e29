"""Fit / transform stages for `pyspark.ml.Pipeline`, all built from column expressions.

Every stage saves and loads with the pipeline, so training and scoring share one code path.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
    MLReadable, MLReader, MLWritable, MLWriter,
)
from pyspark.sql import DataFrame, functions as F

from tidewatch import vocabulary as v
from tidewatch.functions.joins import attach, fits_broadcast
from tidewatch.functions.scalars import grouped_flag, log1p_clipped, ratio, text
from tidewatch.functions.storage import materialize


class _Columns(Params):
    columns = Param(Params._dummy(), "columns", "columns the stage works on", TypeConverters.toListString)

    def present(self, df: DataFrame) -> list[str]:
        return [c for c in self.getOrDefault(self.columns) if c in df.columns]


class ColumnDropper(Transformer, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Drop listed columns; absent ones are ignored (`missing` lists them)."""

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._setDefault(columns=v.CORRELATED)
        self._set(**self._input_kwargs)

    def missing(self, df: DataFrame) -> list[str]:
        return [c for c in self.getOrDefault(self.columns) if c not in df.columns]

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.present(df))


class LogColumns(Transformer, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Add `<c>_log` = log(1 + max(c, 0)); the originals stay."""

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._setDefault(columns=v.LOGGED)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"{c}_log": log1p_clipped(F.col(c)) for c in self.present(df)})


class ValueGrouper(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Add `<c>_grouped`: 0 stays 0, every other value becomes 1."""

    column = Param(Params._dummy(), "column", "column to group", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, column=None):
        super().__init__()
        self._setDefault(column=v.GROUPED)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        name = self.getOrDefault(self.column)
        return df.withColumn(f"{name}_grouped", grouped_flag(F.col(name))) if name in df.columns else df

    def observed(self, df: DataFrame) -> DataFrame:
        """Distinct original values in order, marking those other than 0 and 1."""
        name = self.getOrDefault(self.column)
        return df.select(F.col(name).alias("value")).distinct().select(
            "value", (~F.coalesce(F.col("value").isin(0, 1), F.lit(False))).alias("unexpected")
        ).orderBy("value")


class ConstantDropper(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Fit: keep those of the listed columns that are constant (nulls ignored). Model: drop them."""

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._setDefault(columns=v.CONSTANT)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ColumnDropper:
        listed = self.present(df)
        if not listed:
            return ColumnDropper(columns=[])
        spread = df.agg(*[F.min(c).eqNullSafe(F.max(c)).alias(c) for c in listed]).first()
        return ColumnDropper(columns=[c for c in listed if spread[c]])


class IndicatorModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """0/1 columns `<c>_<value>` for the fitted values; unseen values and NULL give all zeros."""

    categories = Param(Params._dummy(), "categories", "values per column")

    def _transform(self, df: DataFrame) -> DataFrame:
        table = self.getOrDefault(self.categories)
        flags = {
            f"{c}_{x}": text(F.col(c)).eqNullSafe(F.lit(x)).cast("int") for c, values in table.items() for x in values
        }
        return df.withColumns(flags).drop(*table)

    @classmethod
    def fixed(cls, categories: dict[str, list[str]]) -> IndicatorModel:
        model = cls()
        model._set(categories=categories)
        return model


class IndicatorEncoder(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """One-hot columns defined by the training values only."""

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._setDefault(columns=["protocol_type", "flag"])
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> IndicatorModel:
        found: dict[str, list[str]] = {}
        for c in self.present(df):
            # One output column for each value: as many come to the driver as the result has columns.
            values = df.select(text(F.col(c)).alias("x")).where("x is not null").distinct()
            found[c] = sorted(r.x for r in values.collect())
        return IndicatorModel.fixed(found)


def sparse_indicators(columns: list[str]) -> Pipeline:
    """One sparse 0/1 vector `<c>_vector` for each column, for columns of many values.

    Values are indexed by frequency; one not seen in fitting, or NULL, takes the vector's last place.
    """
    indexers = [StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="keep") for c in columns]
    encoder = OneHotEncoder(inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_vector" for c in columns], dropLast=False)
    return Pipeline(stages=[*indexers, encoder])


class _RateParams(Params):
    key = Param(Params._dummy(), "key", "column whose values get a rate", TypeConverters.toString)
    target = Param(Params._dummy(), "target", "0/1 target", TypeConverters.toString)
    output = Param(Params._dummy(), "output", "rate column", TypeConverters.toString)
    fallback = Param(Params._dummy(), "fallback", "rate of unseen values", TypeConverters.toFloat)
    small = Param(Params._dummy(), "small", "rate table checked to fit a broadcast", TypeConverters.toBoolean)


class RateModel(Model, _RateParams, MLReadable, MLWritable):
    """Left lookup of the fitted rate with the overall mean for unseen values."""

    def __init__(self, rates: DataFrame | None = None):
        super().__init__()
        self.rates = rates

    def _transform(self, df: DataFrame) -> DataFrame:
        key, output = self.getOrDefault(self.key), self.getOrDefault(self.output)
        joined = attach(df, self.rates, [key], "left", self.getOrDefault(self.small))
        rate = F.coalesce(F.col("_rate"), F.lit(self.getOrDefault(self.fallback)))
        return joined.withColumn(output, rate).drop("_rate").select(*df.columns, output)

    def write(self) -> MLWriter:
        return _RateWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _RateReader(cls)


class _RateWriter(MLWriter):
    def __init__(self, model: RateModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.rates.write.mode("overwrite").parquet(f"{path}/rates")


class _RateReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> RateModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(self.sparkSession.read.parquet(f"{path}/rates"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class RateEncoder(Estimator, _RateParams, DefaultParamsReadable, DefaultParamsWritable):
    """Mean of the target per value, learned on the training rows only."""

    @keyword_only
    def __init__(self, *, key="service", target="is_anomaly", output="service_anomaly_rate"):
        super().__init__()
        self._set(**{"key": key, "target": target, "output": output})

    def _fit(self, df: DataFrame) -> RateModel:
        key, target = self.getOrDefault(self.key), self.getOrDefault(self.target)
        sums = materialize(df.groupBy(key).agg(F.sum(target).alias("_sum"), F.count(target).alias("_n")))
        overall = sums.agg(ratio(F.sum("_sum"), F.sum("_n"))).first()[0]
        rates = sums.where(F.col(key).isNotNull()).select(key, ratio(F.col("_sum"), F.col("_n")).alias("_rate"))
        model = RateModel(rates)
        model._set(
            key=key, target=target, output=self.getOrDefault(self.output),
            fallback=v.MISSING_ENCODER_RATE if overall is None else float(overall),
            small=fits_broadcast(rates),
        )
        return model


class ScalerModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / deviation into `<c>_scaled`; a constant column becomes 0."""

    moments = Param(Params._dummy(), "moments", "mean and deviation per column")

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            f"{c}_scaled": (F.col(c) - F.lit(mean)) / F.lit(std if std else 1.0)
            for c, (mean, std) in self.getOrDefault(self.moments).items()
        })


class PopulationScaler(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Standard scaling with the population deviation; all columns in one aggregate."""

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ScalerModel:
        names = self.present(df)
        aggregates = [f(c).alias(f"{kind}_{i}") for i, c in enumerate(names) for kind, f in (("m", F.avg), ("s", F.stddev_pop))]
        row = df.agg(*aggregates).first()
        model = ScalerModel()
        model._set(moments={c: [float(row[f"m_{i}"]), float(row[f"s_{i}"])] for i, c in enumerate(names)})
        return model
