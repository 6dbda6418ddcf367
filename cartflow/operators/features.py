"""Indexing, encoding, scaling and assembling features."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.operators.explore import long_form
from cartflow.plans.lookup import BROADCAST_ROWS
from cartflow.plans.ordered import positions
from cartflow.session import materialise

# The columns the purchase models are trained on.
CATEGORICAL = ["category_id_id1", "brand_f", "category_code_level1_f", "category_code_level2_f"]
NUMERIC = ["price", "activity_count"]
ONE_HOT = ["week_day", "dt_day", "dt_hour"]

# Spark's fitted string index is kept whole on the driver; columns with more values get an index that is a table.
MAX_INDEXED_VALUES = 100_000


def value_codes(frames: list[DataFrame], columns: list[str], by: str = "alphabetical",
                null_text: str | None = None, slices: int | None = None) -> DataFrame:
    """Mapping ``(column_name, value, code)`` with codes from 0, built for all columns at once.

    ``alphabetical`` numbers the sorted distinct values; ``frequency`` the most frequent
    first, ties in value order. Values of all frames share one numbering. ``null_text``
    codes nulls as that text; without it nulls get no code.
    """
    cells = [long_form(df, columns) for df in frames]
    everything = cells[0]
    for more in cells[1:]:
        everything = everything.unionByName(more)
    if null_text is not None:
        everything = everything.fillna(null_text, subset=["value"])
    counts = (everything.where(F.col("value").isNotNull()).groupBy("column_name", "value")
              .agg(F.count(F.lit(1)).alias("n")))
    order = ["value"] if by == "alphabetical" else [F.desc("n"), "value"]
    numbered = positions(counts, order, "_position", group=["column_name"], slices=slices)
    return numbered.select("column_name", "value", (F.col("_position") - 1).alias("code"))


def index_values(df: DataFrame, codes: DataFrame, columns: list[str], suffix: str = "_index",
                 null_text: str | None = None, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add each column's code from a ``value_codes`` mapping; unknown values stay null.

    The mapping is computed and counted once for all columns. The smallest parts are
    broadcast, up to ``max_rows`` rows in total; a column beyond that is joined by shuffle.
    """
    codes = materialise(codes)
    sizes = {r["column_name"]: r["count"] for r in codes.groupBy("column_name").count().collect()}
    out, left = df, max_rows
    for c in sorted(columns, key=lambda name: sizes.get(name, 0)):
        text = F.col(c).cast("string")
        one = codes.where(F.col("column_name") == c).select(
            F.col("value").alias("_value"), F.col("code").alias(f"{c}{suffix}"))
        keyed = out.withColumn("_value", text if null_text is None
                               else F.coalesce(text, F.lit(null_text)))
        left -= sizes.get(c, 0)
        small = left >= 0
        out = keyed.join(F.broadcast(one) if small else one, "_value", "left").drop("_value")
    return out.select(*df.columns, *[f"{c}{suffix}" for c in columns])


def scale_to_unit_deviation(df: DataFrame, columns: list[str], suffix: str = "_scaled") -> DataFrame:
    """Divide by the sample standard deviation, without centring.

    The deviations are one aggregate row, read as a scalar subquery.
    """
    out = df
    for c in columns:
        deviation = df.agg(F.stddev_samp(c)).scalar()
        out = out.withColumn(f"{c}{suffix}", F.col(c) / deviation)
    return out


def wide_columns(df: DataFrame, columns: list[str], limit: int = MAX_INDEXED_VALUES) -> list[str]:
    """Columns with about more than ``limit`` distinct values, whose index should stay a table."""
    sizes = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first().asDict()
    return [c for c in columns if sizes[c] > limit]


def feature_stages(categorical: list[str] = CATEGORICAL, numeric: list[str] = NUMERIC,
                   one_hot: list[str] = ONE_HOT, wide: list[str] = ()) -> Pipeline:
    """Index text, scale numbers, encode small integers, assemble ``features``.

    Unseen and null texts get an index of their own, so scoring never fails on new data.
    The ``wide`` ones of the categorical columns are indexed by a table (``TableIndexer``).
    """
    from cartflow.operators.indexing import TableIndexer

    indexed = [f"{c}_index" for c in categorical]
    coded = [f"{c}_coded" for c in one_hot]
    narrow = [c for c in categorical if c not in wide]
    indexes = []
    if narrow:
        indexes.append(StringIndexer(inputCols=narrow, outputCols=[f"{c}_index" for c in narrow], handleInvalid="keep"))
    if wide:
        indexes.append(TableIndexer(inputCols=list(wide), outputCols=[f"{c}_index" for c in wide]))
    return Pipeline(stages=[
        *indexes,
        VectorAssembler(inputCols=numeric, outputCol="numeric_vector"),
        StandardScaler(inputCol="numeric_vector", outputCol="numeric_scaled"),
        OneHotEncoder(inputCols=one_hot, outputCols=coded, handleInvalid="keep"),
        VectorAssembler(inputCols=[*coded, "numeric_scaled", *indexed], outputCol="features"),
    ])


def with_label(df: DataFrame, source: str = "is_purchased") -> DataFrame:
    """The 0/1 column as the label, unchanged.

    A frequency index would give the more frequent class 0.0, and so could swap classes.
    """
    return df.withColumn("label", F.col(source).cast("double"))


def fit_features(train: DataFrame, everything: DataFrame | None = None,
                 max_values: int = MAX_INDEXED_VALUES, **columns: list[str]) -> PipelineModel:
    """Fit the feature stages on the training part.

    Pass ``everything`` to fit on all rows before the split instead, the leaky order
    some published results used. Columns beyond ``max_values`` values keep their index as a table.
    """
    fit_on = everything if everything is not None else train
    wide = wide_columns(fit_on, columns.get("categorical", CATEGORICAL), max_values)
    return feature_stages(**columns, wide=wide).fit(fit_on)


def largest_category(model: PipelineModel) -> int:
    """Values of the widest indexed column, the unseen index included (for ``maxBins``)."""
    return max((len(labels) + 1 for stage in model.stages if hasattr(stage, "labelsArray")
                for labels in stage.labelsArray), default=0)
