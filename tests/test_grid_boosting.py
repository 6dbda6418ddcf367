"""Grid points that differ in the number of trees only come from one fit."""

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler

from cartflow.operators import models as m


def test_smaller_models_are_the_first_trees_of_the_largest(spark, monkeypatch):
    rows = [(float((i * 7919 % 101) + 3 * (i % 3) > 60), float(i * 7919 % 101 + i % 5), float(i % 7)) for i in range(400)]
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.createDataFrame(rows, "label double, a double, b double").coalesce(1)).persist()
    fits, fit = [], GBTClassifier._fit
    monkeypatch.setattr(GBTClassifier, "_fit", lambda self, df: fits.append(self.getMaxIter()) or fit(self, df))
    grid = {"stepSize": [0.1, 1.0], "maxIter": [1, 3], "maxDepth": [2]}
    shared = m.cross_validate(m.estimator("GBT"), grid, data, folds=2)
    # Two folds of two settings, and the best of all on all rows.
    assert sorted(fits)[-4:] == [3] * 4 and len(fits) == 5
    apart = m.cross_validate(GBTClassifier(maxIter=10, maxBins=32), grid, data, folds=2)
    assert len(fits) == 5 + 9
    assert shared.avgMetrics == apart.avgMetrics
    assert m.grid_results(spark, shared).collect() == m.grid_results(spark, apart).collect()
    few, alone = (m.first_trees(m.estimator("GBT", maxIter=3).fit(data), 2), GBTClassifier(maxIter=2).fit(data))
    assert few.getNumTrees == few.getMaxIter() == 2
    assert few.transform(data).select("probability", "prediction").collect() == alone.transform(data).select("probability", "prediction").collect()
    data.unpersist()
