"""The registered model queries fit the reference's job."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from airspark import schemas as S
from airspark.plans import ml as M
from airspark.plans import q_ml


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(60).select(
        F.lit("a").alias("city"), (F.timestamp_seconds(F.col("id") * 3600)).cast("timestamp_ntz").alias("timestamp"),
        *[((F.col("id") * (i + 3)) % 17).cast("double").alias(c) for i, c in enumerate(S.MODEL_FEATURE_COLUMNS)],
        (F.col("id") % 17 * 5.0).alias(S.TARGET_COLUMN)).cache()


class Stop(Exception):
    pass


def test_queries_fit_300_trees_and_300_rounds(spark, rows, monkeypatch):
    seen = {}

    def stop(est, *args):
        seen["est"] = est
        raise Stop

    monkeypatch.setattr(q_ml, "_table", lambda spark, sf_dir: rows)
    monkeypatch.setattr(M, "assembled", stop)
    for query, size in ((q_ml.q_ml_forest, "numTrees"), (q_ml.q_ml_boosted, "rounds")):
        with pytest.raises(Stop):
            query(spark, "")
        assert seen["est"].params[size] == 300

    def compared(train, test, ests, *args):
        seen["ests"] = ests
        raise Stop

    monkeypatch.setattr(M, "compare", compared)
    for query in (q_ml.q_ml_compare, q_ml.q_ml_refit, q_ml.q_ml_importance, q_ml.q_ml_score, q_ml.q_registry_append):
        seen.clear()
        with pytest.raises(Stop):
            query(spark, "")
        assert seen["ests"][M.FOREST].params == {**M.FOREST_PARAMS} and M.FOREST_PARAMS["numTrees"] == 300
        assert seen["ests"][M.BOOSTED].params == {**M.BOOSTED_PARAMS} and M.BOOSTED_PARAMS["rounds"] == 300


def test_fit_on_written_vectors_equals_the_pipeline(spark, rows, tmp_path):
    est = M.estimators(rows)[M.RIDGE]
    model = M.fit_assembled(est, M.assembled(est, rows))
    M.save_model(model, f"{tmp_path}/m")
    # Spark ML's own ridge: its penalty is scaled by the label's deviation and the row count.
    n, deviation = rows.count(), rows.agg(F.stddev_pop(S.TARGET_COLUMN)).first()[0]
    own = LinearRegression(featuresCol="features", labelCol=S.TARGET_COLUMN, solver="normal", elasticNetParam=0.0,
                           standardization=True, regParam=M.RIDGE_ALPHA * deviation / n)
    want = Pipeline(stages=[*est.stages, own]).fit(rows)
    got, again, want = ([r.prediction for r in m.transform(rows).orderBy("timestamp").collect()]
                        for m in (model, PipelineModel.load(f"{tmp_path}/m"), want))
    assert got == again and got == pytest.approx(want, rel=1e-6, abs=1e-6)


def test_metrics_of_both_sides_come_from_one_prediction_of_each_row(spark, rows):
    calls = spark.sparkContext.accumulator(0)

    class Counting:
        def transform(self, df):
            def run(batches):
                for b in batches:
                    calls.add(b.num_rows)
                    yield b
            return df.withColumn("prediction", F.col(S.TARGET_COLUMN) + F.when(F.col(M.SIDE) == "test", 2.0).otherwise(0.0)).mapInArrow(
                run, f"{M.SIDE} string, {S.TARGET_COLUMN} double, prediction double")

    sides = rows.select(F.when(F.col("timestamp") < "1970-01-02", "train").otherwise("test").alias(M.SIDE), S.TARGET_COLUMN)
    found = M.side_metrics(Counting(), sides)
    assert calls.value == 60
    assert found["train"] == {"MAE": 0.0, "RMSE": 0.0, "R2": 1.0}
    assert found["test"]["MAE"] == found["test"]["RMSE"] == 2.0 and found["test"]["R2"] < 1
