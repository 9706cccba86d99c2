"""Cleaning, encoding and scaling as Spark ML stages, so that raw rows to scores is one saved ``PipelineModel``.

Each estimator fits by the aggregates of ``clean`` and ``fitted`` and yields a
model that holds parameters only; transforming is a projection (and one join a
column for the encoder), on a batch or a stream. Fills and scales are saved in
a stage's metadata, one entry a column; the encoder's codes, which grow with
the distinct values, as a Parquet table beside it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable,
                             MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession

from churnlens.functions.columns import encode_binary
from churnlens.operators import clean as C
from churnlens.operators import fitted as D
from churnlens.session import materialize


class _Cleaning(Params):
    numericText = Param(Params._dummy(), "numericText", "text columns that hold numbers", TypeConverters.toListString)
    numeric = Param(Params._dummy(), "numeric", "numeric columns, nulls filled by the median", TypeConverters.toListString)
    categorical = Param(Params._dummy(), "categorical", "text columns, nulls filled by the mode", TypeConverters.toListString)
    fill = Param(Params._dummy(), "fill", "'zero' or 'median' for numbers that do not parse", TypeConverters.toString)


class Cleaner(Estimator, _Cleaning, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the fill values of the cleaning step."""

    @keyword_only
    def __init__(self, *, numericText: Sequence[str] = (), numeric: Sequence[str] = (), categorical: Sequence[str] = (), fill: str = "zero"):
        super().__init__()
        self._setDefault(numericText=[], numeric=[], categorical=[], fill="zero")
        self._set(**{k: list(v) if not isinstance(v, str) else v for k, v in self._input_kwargs.items()})

    def _fit(self, df: DataFrame) -> CleanerModel:
        # a column that serving rows do not have (the target) is filled where it stands only
        found = C.fit_cleaning(df, self.getOrDefault("numericText"), self.getOrDefault("numeric"),
                               [c for c in self.getOrDefault("categorical") if c in df.columns], self.getOrDefault("fill"))
        return CleanerModel(found)


class CleanerModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    values = Param(Params._dummy(), "values", "fill values of fit_cleaning")

    def __init__(self, values: Mapping | None = None):
        super().__init__()
        if values is not None:
            self._set(values=dict(values))

    def _transform(self, df: DataFrame) -> DataFrame:
        v = dict(self.getOrDefault("values"))
        v["modes"] = {c: m for c, m in v["modes"].items() if c in df.columns}
        return C.apply_cleaning(df, v)


class _Encoding(Params):
    columns = Param(Params._dummy(), "columns", "columns to encode", TypeConverters.toListString)
    target = Param(Params._dummy(), "target", "Yes/No column that becomes 1/0 where it stands", TypeConverters.toString)


class LabelCoder(Estimator, _Encoding, DefaultParamsReadable, DefaultParamsWritable):
    """Fits codes: the place of each value among the column's sorted values."""

    @keyword_only
    def __init__(self, *, columns: Sequence[str] = (), target: str = ""):
        super().__init__()
        self._setDefault(columns=[], target="")
        self._set(**{k: list(v) if not isinstance(v, str) else v for k, v in self._input_kwargs.items()})

    def _fit(self, df: DataFrame) -> LabelCoderModel:
        columns = self.getOrDefault("columns")
        codes = materialize(D.fit_label_encoder(df, columns), "encoder")
        return LabelCoderModel(columns, self.getOrDefault("target"), codes)


class LabelCoderModel(Model, _Encoding, MLReadable, MLWritable):
    def __init__(self, columns: Sequence[str] = (), target: str = "", codes: DataFrame | None = None):
        super().__init__()
        self._set(columns=list(columns), target=target)
        self.codes = codes

    def _transform(self, df: DataFrame) -> DataFrame:
        target = self.getOrDefault("target")
        if target and target in df.columns:
            df = df.withColumn(target, encode_binary(target))
        return D.apply_label_encoder(df, self.codes, self.getOrDefault("columns"))

    def write(self) -> MLWriter:
        return _CodesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _CodesReader(cls)


class _CodesWriter(MLWriter):
    def __init__(self, model: LabelCoderModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.codes.write.parquet(f"{path}/codes")


class _CodesReader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> LabelCoderModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(codes=self.sparkSession.read.parquet(f"{path}/codes"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class Scaler(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fits (offset, width) a column: 'minmax' or 'standard'."""
    columns = Param(Params._dummy(), "columns", "columns to scale", TypeConverters.toListString)
    method = Param(Params._dummy(), "method", "'minmax' or 'standard'", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, columns: Sequence[str] = (), method: str = "minmax"):
        super().__init__()
        self._setDefault(columns=[], method="minmax")
        self._set(**{k: list(v) if not isinstance(v, str) else v for k, v in self._input_kwargs.items()})

    def _fit(self, df: DataFrame) -> ScalerModel:
        fit = D.fit_minmax if self.getOrDefault("method") == "minmax" else D.fit_standard
        return ScalerModel({c: [None if v is None else float(v) for v in ab] for c, ab in fit(df, self.getOrDefault("columns")).items()})


class ScalerModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    values = Param(Params._dummy(), "values", "column -> (offset, width)")

    def __init__(self, values: Mapping | None = None):
        super().__init__()
        if values is not None:
            self._set(values=dict(values))

    def _transform(self, df: DataFrame) -> DataFrame:
        return D.apply_affine(df, {c: tuple(ab) for c, ab in self.getOrDefault("values").items()})


def churn_pipeline(spec: Mapping, model_stages: Sequence) -> Pipeline:
    """Raw rows to scores: clean, encode, scale, then ``model_stages`` (an assembler and a classifier).

    ``spec`` is that of ``fitted.prepare_training``.
    """
    coded = [c for c in spec["categorical"] if c not in (spec["target"], spec.get("id"))]
    return Pipeline(stages=[
        Cleaner(numericText=spec["numeric_text"], numeric=spec["numeric"], categorical=spec["categorical"], fill=spec.get("fill", "zero")),
        LabelCoder(columns=coded, target=spec["target"]),
        Scaler(columns=spec["scaled"], method=spec.get("scaler", "minmax")), *model_stages])


def load_pipeline(spark: SparkSession, path: str) -> PipelineModel:
    return PipelineModel.load(path)
