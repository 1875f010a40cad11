"""Preparation as ML stages: fitted on the training rows, saved and loaded with the model.

Clipping and filling keep one or two values per column, as JSON. Category codes are a table,
which is saved beside the stage's metadata: a column may have any number of categories.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.numeric import col
from riskloom.operators.prepare import TARGET, category_codes, clip_bounds, encode, modes
from riskloom.operators.quantiles import exact_quantiles
from riskloom.session import materialise


class _Fitted(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """A model whose fitted values are a JSON object by column."""

    values = Param(Params._dummy(), "values", "fitted values by column, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, values: str | None = None) -> None:
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def fitted(self) -> dict:
        return json.loads(self.getOrDefault(self.values))


class ClipQuantiles(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Limits numbers to two quantiles of the training rows, by nearest rank."""

    low = Param(Params._dummy(), "low", "share below the lower limit", TypeConverters.toFloat)
    high = Param(Params._dummy(), "high", "share below the upper limit", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, low: float = 0.001, high: float = 0.999) -> None:
        super().__init__()
        self._setDefault(low=0.001, high=0.999)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> ClippedModel:
        bounds = clip_bounds(dataset, self.getInputCols(), self.getOrDefault(self.low), self.getOrDefault(self.high))
        found = {r["column"]: [r["lower"], r["upper"]] for r in bounds.collect()}  # one row per column
        return ClippedModel(inputCols=self.getInputCols(), values=json.dumps(found))


class ClippedModel(_Fitted):
    """Values beyond the limits become the limits; NULL stays, as does a column without limits."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        def limited(c: str, low: float, high: float):
            value = col(c).cast("double")
            return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))

        return dataset.withColumns({c: limited(c, *limits) for c, limits in self.fitted().items()})


def filled_with_zero(column: str) -> bool:
    """Previous-application sums and counts: no application is none, not an unknown number."""
    return column.startswith("PREV_") and "RATIO" not in column and "RATE" not in column


class FillMissing(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fills numbers with 0 or the median of the training rows by their names, and the columns in
    ``texts`` with the most frequent value."""

    texts = Param(Params._dummy(), "texts", "text columns", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, texts: list[str] | None = None) -> None:
        super().__init__()
        self._setDefault(texts=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> FilledModel:
        numeric, texts = self.getInputCols(), self.getOrDefault(self.texts)
        found: dict = {c: 0.0 for c in numeric if filled_with_zero(c)}
        middle = [c for c in numeric if c not in found]
        if middle:
            found |= {r["column"]: r["q0"] for r in exact_quantiles(dataset, middle, [0.5]).collect()}
        if texts:
            row = dataset.limit(1).select(modes(dataset, texts).alias("m")).first()
            found |= {c: row["m"][c]["mode"] for c in texts if row and row["m"][c]}
        return FilledModel(inputCols=[*numeric, *texts], values=json.dumps(found))


class FilledModel(_Fitted):
    """NULL becomes the fitted value; a column that was all NULL has none and stays."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        whole = {c: col(c) if isinstance(v, str) else col(c).cast("double") for c, v in self.fitted().items()}
        return dataset.withColumns({c: F.coalesce(whole[c], F.lit(v)) for c, v in self.fitted().items()})


class CategoryCodes(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Codes of text columns by sorted value of the training rows."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None) -> None:
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> CodedModel:
        columns = self.getInputCols()
        return CodedModel(columns, materialise(category_codes(dataset, columns), "codes"))


class CodedModel(Model, HasInputCols, MLReadable, MLWritable):
    """Text becomes its code, -1 when it was not seen or is NULL."""

    def __init__(self, columns: list[str] | None = None, codes: DataFrame | None = None) -> None:
        super().__init__()
        self.codes = codes
        if columns is not None:
            self._set(inputCols=columns)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return encode(dataset, self.codes, self.getInputCols())

    def write(self) -> MLWriter:
        return _CodesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _CodesReader(cls)


class _CodesWriter(MLWriter):
    def __init__(self, model: CodedModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.codes.write.parquet(f"{path}/codes")


class _CodesReader(MLReader):
    def __init__(self, cls: type) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> CodedModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(None, self.sparkSession.read.parquet(f"{path}/codes"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


def training_chain(
    numeric: list[str], categorical: list[str], label: str = TARGET, rounds: int = 300, depth: int = 4, step: float = 0.05,
    rows: float = 0.8, seed: int = 42,
) -> Pipeline:
    """Clip, fill, encode, assemble, boosted trees: one pipeline to fit, save and load."""
    trees = GBTClassifier(
        labelCol=label, featuresCol="features", maxIter=rounds, maxDepth=depth, stepSize=step, subsamplingRate=rows, seed=seed, maxBins=64
    )
    return Pipeline(
        stages=[
            ClipQuantiles(inputCols=numeric),
            FillMissing(inputCols=numeric, texts=categorical),
            CategoryCodes(inputCols=categorical),
            VectorAssembler(inputCols=[*numeric, *categorical], outputCol="features", handleInvalid="keep"),
            trees,
        ]
    )
