"""Folders that are not asked for are not read; records that do not parse are set apart."""

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from airspark import schemas as S
from airspark.operators.forecast import latest_run
from airspark.sources import landing as L
from airspark.sources import store as ST

T0 = dt.datetime(2024, 1, 1)


def runs(spark, days):
    base = spark.createDataFrame([("a", T0 + dt.timedelta(days=d), T0 + dt.timedelta(days=d, hours=h)) for d in days for h in range(3)],
                                 "city string, forecast_run_timestamp timestamp_ntz, timestamp timestamp_ntz")
    more = {f.name: F.lit(1).cast(f.dataType) if f.dataType.typeName() in ("double", "long") else F.lit(None).cast(f.dataType)
            for f in S.FORECAST_SCHEMA if f.name not in base.columns}
    return base.withColumns(more).select(*S.FORECAST_SCHEMA.names)


def test_old_runs_are_not_read(spark, tmp_path):
    path = f"{tmp_path}/forecast"
    ST.write_forecast_run(runs(spark, [0, 1]), path=path)
    ST.write_forecast_run(runs(spark, [9, 10]).withColumn("city", F.lit("007")), path=path)
    assert ST.run_dates(spark, path) == ["2024-01-01", "2024-01-02", "2024-01-10", "2024-01-11"]
    assert ST.read_forecast_table(spark, path).count() == 12
    for old in pathlib.Path(path).glob("run_date=2024-01-0*/*.parquet"):
        old.write_bytes(b"damaged")
    newest = ST.read_forecast_table(spark, path, newest_days=0)
    assert newest.columns == S.FORECAST_SCHEMA.names and {r.city for r in newest.collect()} == {"007"}
    assert "run_date" in newest._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:80]
    assert latest_run(ST.read_forecast_table(spark, path, newest_days=1)).count() == 3
    with pytest.raises(Exception, match="parquet"):
        ST.read_forecast_table(spark, path).count()
    with pytest.raises(ValueError, match="empty"):
        ST.read_forecast_table(spark, ST.write_table(runs(spark, [0]).limit(0), "none", f"{tmp_path}/none"), newest_days=0)


def responses(spark, days):
    rows = spark.createDataFrame([(c, T0 + dt.timedelta(days=d, hours=h), *[1.0] * len(L.AIR_RENAME)) for c in ("007", "b") for d in days for h in (0, 5)],
                                 "city string, timestamp timestamp_ntz, " + ", ".join(f"{c} double" for c in L.AIR_RENAME.values()))
    return L.responses_from_rows(rows, L.AIR_RENAME, chunk_days=7)


def test_a_date_range_reads_its_folders(spark, tmp_path):
    path = L.land_responses(responses(spark, range(0, 60, 2)), f"{tmp_path}/landing")
    part = L.read_landed(spark, path, S.AIR_RESPONSE_SCHEMA, "2024-01-20", "2024-01-29", chunk_days=7)
    files = {f.rsplit("/", 2)[-2] for r in part.select(F.input_file_name().alias("f")).distinct().collect() for f in [r.f]}
    assert len(files) <= 3 < len({p.name for p in pathlib.Path(path).glob("city=b/*")})
    days = {r.timestamp.date().isoformat() for r in L.rows_from_responses(part, L.AIR_RENAME).collect()}
    assert {d for d in days if "2024-01-20" <= d <= "2024-01-29"} == {(T0 + dt.timedelta(days=d)).date().isoformat() for d in range(20, 30, 2)}
    assert {r.city for r in part.collect()} == {"007", "b"}


def test_bad_records_are_set_apart(spark, tmp_path):
    path = L.land_responses(responses(spark, range(0, 20, 5)), f"{tmp_path}/landing")
    folder = next(pathlib.Path(path).glob("city=b/*"))
    good = L.read_landed(spark, path, S.AIR_RESPONSE_SCHEMA).count()
    (folder / "cut.json").write_text('{"hourly": {"time": ["2024-01-0')
    (folder / "bytes.json").write_bytes(bytes(range(1, 200)))
    (folder / "types.json").write_text('{"hourly": "not an object"}\n')
    bad = f"{tmp_path}/bad"
    landed = L.read_landed(spark, path, S.AIR_RESPONSE_SCHEMA, bad_path=bad)
    assert landed.count() == good and landed.columns == S.AIR_RESPONSE_SCHEMA.names
    apart = spark.read.parquet(bad).collect()
    assert {r.file.rsplit("/", 1)[1] for r in apart} == {"cut.json", "bytes.json", "types.json"}
    assert L.rows_from_responses(landed, L.AIR_RENAME).count() == 16
    assert len(L.read_landed(spark, path, S.AIR_RESPONSE_SCHEMA).collect()) == good  # not asked for: left out
