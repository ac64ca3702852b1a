"""Preparation steps as pipeline stages that are fitted, saved with the model, loaded and applied to other rows."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlore.operators.prep import (
    category_classes,
    column_means,
    column_scales,
    fill_mean,
    label_encode,
    one_hot,
    power_features,
    standardize,
)


class _Columns(HasInputCols):
    def getInputCols(self) -> list[str]:
        return list(self.getOrDefault(self.inputCols))


class _OneHot(Params):
    oneHot = Param(Params._dummy(), "oneHot", "a column for each class in place of its code", TypeConverters.toBoolean)


class CategoryEncoder(Estimator, _Columns, _OneHot, DefaultParamsReadable, DefaultParamsWritable):
    """Codes of the classes of each column, counted up from 0 in ascending order of the values."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] = (), oneHot: bool = False):
        super().__init__()
        self._setDefault(oneHot=False)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "CategoryEncoderModel":
        columns = self.getInputCols()
        return CategoryEncoderModel(
            {c: category_classes(dataset, c) for c in columns}, inputCols=columns, oneHot=self.getOrDefault(self.oneHot)
        )


class CategoryEncoderModel(Model, _Columns, _OneHot, MLReadable, MLWritable):
    """Columns as the codes of their values, or one column of 0 and 1 for each class. Values without a code are errors."""

    def __init__(self, classes: dict[str, DataFrame] | None = None, **params):
        super().__init__()
        self.classes = classes or {}
        self._setDefault(oneHot=False)
        self._set(**params)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for c in self.getInputCols():
            if self.getOrDefault(self.oneHot):
                dataset, _ = one_hot(dataset, c, self.classes[c])
            else:
                dataset, _ = label_encode(dataset, c, self.classes[c])
        return dataset

    def write(self) -> MLWriter:
        return _ClassesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ClassesReader()


class _ClassesWriter(MLWriter):
    """Parameters as metadata, and a table of classes for each column."""

    def __init__(self, model: CategoryEncoderModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        for c, classes in self.model.classes.items():
            classes.write.mode("overwrite").parquet(f"{path}/classes/{c}")


class _ClassesReader(MLReader):
    def load(self, path: str) -> CategoryEncoderModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = CategoryEncoderModel()
        DefaultParamsReader.getAndSetParams(model, metadata)
        model._resetUid(metadata["uid"])
        model.classes = {c: self.sparkSession.read.parquet(f"{path}/classes/{c}") for c in model.getInputCols()}
        return model


class _Statistics(Params):
    """A few numbers for each column, as JSON text, so that they are saved with the other parameters."""

    statistics = Param(Params._dummy(), "statistics", "numbers by column", TypeConverters.toString)

    def values(self) -> dict:
        return json.loads(self.getOrDefault(self.statistics))


class MeanFiller(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Means of the fitted rows for the nulls of other ones."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] = ()):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "MeanFillerModel":
        columns = self.getInputCols()
        return MeanFillerModel(inputCols=columns, statistics=json.dumps(column_means(dataset, columns)))


class MeanFillerModel(Model, _Columns, _Statistics, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] = (), statistics: str = "{}"):
        super().__init__()
        self._setDefault(statistics="{}")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return fill_mean(dataset, self.getInputCols(), self.values())


class Scaler(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Mean and population deviation of the fitted rows."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] = ()):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "ScalerModel":
        columns = self.getInputCols()
        return ScalerModel(inputCols=columns, statistics=json.dumps(column_scales(dataset, columns)))


class ScalerModel(Model, _Columns, _Statistics, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] = (), statistics: str = "{}"):
        super().__init__()
        self._setDefault(statistics="{}")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return standardize(dataset, self.getInputCols(), {c: tuple(v) for c, v in self.values().items()})


class ConstantFiller(Transformer, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Nulls of the columns become one value."""

    value = Param(Params._dummy(), "value", "what nulls become", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] = (), value: float = 0.0):
        super().__init__()
        self._setDefault(value=0.0)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        value = F.lit(self.getOrDefault(self.value))
        return dataset.withColumns({c: F.coalesce(F.col(c).cast("double"), value) for c in self.getInputCols()})


class PowerFeatures(Transformer, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the square and the square root of each column."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] = ()):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return power_features(dataset, self.getInputCols())
