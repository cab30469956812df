"""Spark ML stages of the preparation (SNK-10, IMP-03, SCL-02, FN-09, SRV-02): imputer, scaler and index.

Estimators and models that can be written and read, so that training and serving share one
``PipelineModel``: what was fitted on the training rows (donors in their buckets, means, scales, bounds)
lies beside the regression model, and a new session loads all of it. Small values are kept in the stage's
metadata, donors as a Parquet table.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession

from ..functions import index as IDX
from . import scale as SC
from .knn import KnnModel, fit_knn, read_directory


class _Writer(MLWriter):
    def __init__(self, stage: _Stored):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata={"stored": self.stage._values()})
        self.stage._write_tables(path)


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.cls._restored(metadata["stored"], path, self.sparkSession)
        stage._resetUid(metadata["uid"])
        return stage


class _Stored(MLWritable, MLReadable):
    """Written as its values (JSON) and tables, and made again from them."""

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)

    def _values(self) -> dict:
        return dict(self.settings)

    def _write_tables(self, path: str) -> None:
        """Tables of the stage; most have none."""

    @classmethod
    def _restored(cls, values: dict, path: str, spark: SparkSession):
        return cls(**values)


class PanelImputer(Estimator, _Stored):
    """IMP-01 as a stage: exact k nearest neighbours over ``cols``, donors known by ``key``."""

    def __init__(self, key: list[str], cols: list[str], k: int = 5):
        super().__init__()
        self.settings = {"key": list(key), "cols": list(cols), "k": k}

    def _fit(self, dataset: DataFrame) -> PanelImputerModel:
        return PanelImputerModel(fit_knn(dataset, **self.settings))


class PanelImputerModel(Model, _Stored):
    def __init__(self, knn: KnnModel):
        super().__init__()
        self.knn = knn

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.knn.transform(dataset)

    def _values(self) -> dict:
        m = self.knn
        return {"key": m.key, "cols": m.cols, "k": m.k, "means": m.means, "n_donors": m.n_donors}

    def _write_tables(self, path: str) -> None:
        self.knn.donors.write.mode("overwrite").parquet(f"{path}/donors")

    @classmethod
    def _restored(cls, values: dict, path: str, spark: SparkSession) -> PanelImputerModel:
        donors = spark.read.parquet(f"{path}/donors")
        return cls(KnnModel(values["key"], values["cols"], values["k"], donors, values["means"], values["n_donors"], read_directory(donors, len(values["cols"]))))


class PanelScaler(Estimator, _Stored):
    """SCL-01 as a stage: (x - mean) / population deviation of ``cols``, as new columns with ``suffix``."""

    def __init__(self, cols: list[str], suffix: str = "_s"):
        super().__init__()
        self.settings = {"cols": list(cols), "suffix": suffix}

    def _fit(self, dataset: DataFrame) -> PanelScalerModel:
        return PanelScalerModel(SC.fit_scaler(dataset, self.settings["cols"]), self.settings["suffix"])


class PanelScalerModel(Model, _Stored):
    def __init__(self, params: dict, suffix: str):
        super().__init__()
        self.settings = {"params": {c: list(v) for c, v in params.items()}, "suffix": suffix}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return SC.apply_scaler(dataset, {c: tuple(v) for c, v in self.settings["params"].items()}, self.settings["suffix"])


class PanelIndex(Estimator, _Stored):
    """FN-09 as a stage: the weighted index of min-max scaled channels, with the bounds of the rows it is fitted on."""

    def __init__(self, weights: dict[str, float], name: str = "pollution_index"):
        super().__init__()
        self.settings = {"weights": dict(weights), "name": name}

    def _fit(self, dataset: DataFrame) -> PanelIndexModel:
        return PanelIndexModel(**self.settings, bounds=IDX.fit_index_bounds(dataset, self.settings["weights"]))


class PanelIndexModel(Model, _Stored):
    def __init__(self, weights: dict[str, float], name: str, bounds: dict):
        super().__init__()
        self.settings = {"weights": weights, "name": name, "bounds": {c: list(v) for c, v in bounds.items()}}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        s = self.settings
        return IDX.composite_index(dataset, s["weights"], {c: tuple(v) for c, v in s["bounds"].items()}, s["name"])
