"""A string index whose mapping is a table: for columns with more values than a driver should hold.

``TableIndexer`` is an ML estimator like Spark's own index, for pipelines that are fitted, saved and reloaded. Its model keeps
the mapping as Parquet below the work folder (below the model's own folder once saved) and joins it at transform: by
broadcast where it is small, by shuffle where not, so no number of values is refused.
Codes go by frequency, ties by value; null and unseen values get the number of known values as their code. Indexed columns carry no
category metadata, so trees treat them as numbers and need no bin for each value.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.operators.features import index_values, value_codes
from cartflow.plans.lookup import BROADCAST_ROWS
from cartflow.session import work_folder

_SCHEMA = "column_name string, value string, code long"


class TableIndexer(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fits codes for all input columns in one aggregation; only their number of rows is read back."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> TableIndexModel:
        path = work_folder(dataset.sparkSession, "index")
        columns = self.getInputCols()
        value_codes([dataset], columns, by="frequency").select("column_name", "value", F.col("code").cast("long")).write.parquet(path)
        model = TableIndexModel(path)
        return model._set(inputCols=columns, outputCols=self.getOutputCols())


class TableIndexModel(Model, HasInputCols, HasOutputCols, MLReadable, MLWritable):
    """The mapping at ``path``; ``transform`` adds one double column for each input column."""

    path = Param(Params._dummy(), "path", "folder of the mapping")

    def __init__(self, path: str | None = None):
        super().__init__()
        if path:
            self._set(path=path)

    def mapping(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(_SCHEMA).parquet(self.getOrDefault(self.path))

    def _transform(self, dataset: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
        codes = self.mapping(dataset.sparkSession)
        columns, outputs = self.getInputCols(), self.getOutputCols()
        sizes = {r["column_name"]: r["count"] for r in codes.groupBy("column_name").count().collect()}
        coded = index_values(dataset, codes, columns, suffix="_table_index", max_rows=max_rows)
        return coded.select(*[F.col(f"`{c}`") for c in dataset.columns], *[
            F.coalesce(F.col(f"{c}_table_index"), F.lit(sizes.get(c, 0))).cast("double").alias(out) for c, out in zip(columns, outputs)])

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    """Parameters as usual, and a copy of the mapping beside them."""

    def __init__(self, model: TableIndexModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.mapping(self.sparkSession).write.mode("overwrite").parquet(f"{path}/mapping")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TableIndexModel:
        model = self.cls()
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model._set(path=f"{path}/mapping")
