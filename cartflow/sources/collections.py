"""Named collections of documents, kept in any Spark format.

With ``fmt="mongodb"`` and the connector on the class path, the database and collection
names are passed as options and connection settings come from ``options``. With a file
format (parquet by default) a collection is a folder ``root/database/name``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from cartflow.operators.dedup import keep_first


BATCH = "stream_batch"


@dataclass
class Collections:
    spark: SparkSession
    root: str | None = None
    fmt: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)

    @property
    def _is_files(self) -> bool:
        return self.root is not None

    def _path(self, database: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{database}/{name}"

    def read(self, database: str, name: str, schema: StructType | None = None) -> DataFrame:
        reader = self.spark.read.format(self.fmt).options(**self.options)
        if schema is not None:
            reader = reader.schema(schema)
        if self._is_files:
            # A stream writes each of its batches to a folder of this name.
            return reader.load(self._path(database, name)).drop(BATCH)
        return reader.option("database", database).option("collection", name).load()

    def read_earliest(self, database: str, name: str, keys: list[str],
                      order: list[str | Column], schema: StructType | None = None) -> DataFrame:
        """Only the earliest document of each key."""
        return keep_first(self.read(database, name, schema), keys, order)

    def write(self, df: DataFrame, database: str, name: str, mode: str = "errorifexists") -> None:
        """Save as a collection: ``append``, ``overwrite``, or fail when it already exists."""
        writer = df.write.format(self.fmt).options(**self.options).mode(mode)
        if self._is_files:
            writer.save(self._path(database, name))
        else:
            writer.option("database", database).option("collection", name).save()

    def is_empty(self, database: str, name: str) -> bool:
        """True when the collection is missing or holds no document."""
        try:
            return self.read(database, name).isEmpty()
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return True
            raise

    def load_once(self, df: DataFrame, database: str, name: str) -> bool:
        """Write ``df`` unless the collection already has documents; True when written."""
        if not self.is_empty(database, name):
            return False
        self.write(df, database, name, mode="append")
        return True
