"""Own estimators and models as ``pyspark.ml`` classes (D3).

A ``StateModel`` keeps what it learned as one JSON parameter plus, if need
be, fitted ``ml`` models as parts. It is a ``Model``: it takes its place in
a ``PipelineModel``, and ``write`` / ``load`` store metadata and parts in one
folder (any file system Spark knows), so a model, its scaler and its feature
list are one saved unit that another session can load.
"""

from __future__ import annotations

import json

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class _Writer(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        parts = self.instance.parts
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata={"parts": len(parts)})
        for i, p in enumerate(parts):
            p.write().save(f"{path}/part-{i}")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        model.parts = [DefaultParamsReader.loadParamsInstance(f"{path}/part-{i}", self.sparkSession)
                       for i in range(meta["parts"])]
        return model


class StateModel(Model, MLReadable, MLWritable):
    """A fitted model: ``state`` (JSON) and fitted ``parts``; subclasses define ``_transform``."""

    state = Param(Params._dummy(), "state", "what was learned, as JSON", typeConverter=TypeConverters.toString)

    def __init__(self, state: dict | None = None, parts=()):
        super().__init__()
        self.parts = list(parts)
        if state is not None:
            self._set(state=json.dumps(state))

    @property
    def learned(self) -> dict:
        return json.loads(self.getOrDefault(self.state))

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader(cls)


class FitEstimator(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """An estimator whose settings are one JSON parameter; subclasses define ``_fit``."""

    settings = Param(Params._dummy(), "settings", "keyword arguments of the fit, as JSON", typeConverter=TypeConverters.toString)

    def __init__(self, **settings):
        super().__init__()
        self._set(settings=json.dumps(settings))

    @property
    def options(self) -> dict:
        return json.loads(self.getOrDefault(self.settings))


class AveragingModel(StateModel):
    """Mean of the parts' predictions."""

    def _transform(self, df: DataFrame) -> DataFrame:
        names = []
        for i, m in enumerate(self.parts):
            df = m.transform(df).withColumnRenamed("prediction", f"_avg{i}")
            names.append(f"_avg{i}")
            df = df.drop("rawPrediction", "probability")
        mean = sum((F.col(n).cast("double") for n in names[1:]), F.col(names[0]).cast("double")) / len(names)
        return df.withColumn("prediction", mean).drop(*names)


class Averaging(Estimator):
    """Fits every given estimator on the same rows and averages their predictions."""

    def __init__(self, estimators=()):
        super().__init__()
        self.estimators = list(estimators)

    def _fit(self, df: DataFrame) -> AveragingModel:
        return AveragingModel({}, [e.fit(df) for e in self.estimators])
