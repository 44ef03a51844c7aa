"""Headline timings on the bench-scale series (lineitem-derived, FIXTURES.md §3).

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.

The flow mirrors production: observation rows are landed once as a table,
the training and forecast feature plans read it and write their tables,
and scoring, summaries, split, metrics, EDA and the ridge fit read those.
Each read-only query is forced with a ``noop`` write (the whole plan runs,
nothing is collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from airspark import schemas as S  # noqa: E402
from airspark.operators import forecast as FO  # noqa: E402
from airspark.operators import summarize as SU  # noqa: E402
from airspark.operators.split import time_split  # noqa: E402
from airspark.plans import eda as E  # noqa: E402
from airspark.plans import ml as M  # noqa: E402
from airspark.plans.features import build_forecast_features, build_training_features  # noqa: E402
from airspark.plans.q_core import observations  # noqa: E402
from airspark.session import get_session, release_scratch, scratch_path  # noqa: E402

BENCH_AS_OF = "1998-06-01 00:00:00"  # lineitem ship dates end in 1998


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                        driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    # Bench-scale data is tens of MB per shuffle; AQE would coalesce it into
    # one task and serialise the window stages.  Keep 2 x cores partitions.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled",
                   os.environ.get("BENCH_COALESCE", "false"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    paths = {k: scratch_path(spark, f"bench-{k}") for k in ("landed", "training", "forecast")}

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    def land():
        observations(spark, sf_dir, "lineitem").drop("emax").write.mode("overwrite").parquet(paths["landed"])

    def landed():
        return spark.read.parquet(paths["landed"])

    def training():
        obs = landed().drop("run", "forecast_run_timestamp")
        build_training_features(obs).write.mode("overwrite").parquet(paths["training"])

    def forecast():
        build_forecast_features(landed().drop("run"), BENCH_AS_OF, horizon=72).write.mode(
            "overwrite").parquet(paths["forecast"])

    def train_table():
        return spark.read.parquet(paths["training"])

    def scored():
        fc = spark.read.parquet(paths["forecast"])
        return FO.forecast_position(FO.predict_api(fc, FO.standin_score()))

    def prepare():
        noop(FO.prepare_scoring(spark.read.parquet(paths["forecast"]), horizon=72))

    def summaries():
        h = scored()
        noop(SU.daily_summary_api(h))
        noop(SU.headline_summary(h))
        noop(SU.pollutant_summary(h))

    def split():
        noop(time_split(train_table()))

    def metrics():
        t = train_table().withColumn("p", FO.standin_score())
        noop(SU.regression_metrics(t, S.TARGET_COLUMN, "p", group=["city"]))

    def distribution():
        noop(E.distribution(train_table(), S.MODEL_FEATURE_COLUMNS))

    def ridge():
        t = train_table()
        model = M.estimators(t, only=(M.RIDGE,))[M.RIDGE].fit(t)
        noop(model.transform(t).select("city", "timestamp", "prediction"))

    steps = [
        ("land_observations", land),
        ("training_features", training),
        ("forecast_features", forecast),
        ("prepare_scoring", prepare),
        ("summaries", summaries),
        ("time_split", split),
        ("regression_metrics", metrics),
        ("eda_distribution", distribution),
        ("ml_ridge", ridge),
    ]
    spark.range(1000).agg(F.sum("id")).collect()  # JVM warm-up, untimed
    timings = {}
    for name, fn in steps:
        t0 = time.time()
        fn()
        timings[name] = round(time.time() - t0, 3)
    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": timings,
                      "sf": sf}))
    release_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
