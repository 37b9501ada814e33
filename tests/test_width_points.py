"""The width model goes over different trees, each weighed by its copies, and learns what it would from all rows."""

import pytest
from pyspark.sql import functions as F

from greenlake.operators import growth


def test_equal_trees_are_one_point(spark, monkeypatch):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    x = spark.range(4000).selectExpr("CAST(id AS STRING) AS source_tree_id", "concat('sp', id % 7 % (1 + id % 3)) AS species", "nullif(CAST(id % 11 AS DOUBLE), 4D) AS height_m", "(id % 11) * 0.5D + id % 7 + id % 13 % 2 AS width_m")
    stored, real = [], growth.written
    monkeypatch.setattr(growth, "written", lambda df, name, **o: stored.append(real(df, name, **o)) or stored[-1])
    model, scores = growth.mature_width_model(x, ["height_m"], iterations=6)
    assert stored[0].count() < 2500 and stored[0].agg(F.sum("_weight")).first()[0] == 4000
    unseen = F.pmod(F.xxhash64("species", F.lit(42)), F.lit(10)) == 0
    part = F.pmod(F.xxhash64("source_tree_id", F.lit(42)), F.lit(5))
    seen = x.where(~unseen)
    plain = Pipeline(stages=[
        StringIndexer(inputCol="species", outputCol="_species", handleInvalid="keep"), Imputer(inputCols=["height_m"], outputCols=["_height_m"]), VectorAssembler(inputCols=["_species", "_height_m"], outputCol="features"),
        GBTRegressor(labelCol="width_m", maxIter=6, maxDepth=5, maxBins=32, seed=42, validationIndicatorCol="_validation", validationTol=0.001),
    ]).fit(seen.where(part != 0).withColumn("_validation", part == 1))
    assert model.stages[0].labels == plain.stages[0].labels and scores["trees"] == plain.stages[-1].getNumTrees
    of = lambda m: [r["prediction"] for r in m.transform(x.select("species", "height_m").distinct()).orderBy("species", "height_m").collect()]
    assert of(model) == pytest.approx(of(plain), abs=1e-9)
