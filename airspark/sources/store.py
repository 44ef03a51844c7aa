"""Tables, sinks and the model registry.

Tables are Parquet folders under the shared checkpoint folder (or any path
the caller gives).  The keyed upsert keeps the newest row per
(city, timestamp), rewrites only the city partitions it touches, and commits before it does.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schemas as S
from ..functions.time import parse_timestamp
from ..operators.clean import dedupe_keep_last
from ..session import hadoop_path, scratch_path

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
MINUTE_FORMAT = "yyyy-MM-dd HH:mm"


def write_table(df: DataFrame, name: str, path: str | None = None, partition_by=None,
                mode: str = "overwrite") -> str:
    path = path or scratch_path(df.sparkSession, name)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_training_table(spark: SparkSession, path: str, columns=None) -> DataFrame:
    """Chosen columns only (pruned at the scan); empty table is an error."""
    cols = columns or ["city", "timestamp", *S.MODEL_FEATURE_COLUMNS, S.TARGET_COLUMN]
    schema = T.StructType([f for f in spark.read.parquet(path).schema if f.name != "city"])
    # A partition value has no stored type: declare the city as text.
    df = spark.read.schema(schema.add("city", "string")).parquet(path).select(*cols)
    if df.isEmpty():
        raise ValueError(f"Training table is empty: {path}")
    return df


RUN_PARTITION = "run_date"


def write_forecast_run(df: DataFrame, name: str = "forecast_table", path: str | None = None) -> str:
    """Append forecast rows, one folder for each day on which a run was made."""
    path = path or scratch_path(df.sparkSession, name)
    runs = [F.col(c) for c in ("forecast_run_timestamp", "ingestion_timestamp") if c in df.columns]
    df.withColumn(RUN_PARTITION, F.to_date(F.coalesce(*runs))).write.mode("append").partitionBy(RUN_PARTITION).parquet(path)
    return path


def run_dates(spark: SparkSession, path: str) -> list[str]:
    """The run dates of a forecast table, oldest first, from its folder names alone."""
    p = hadoop_path(spark, path)
    names = [f.getPath().getName() for f in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p) if f.isDirectory()]
    return sorted(n.partition("=")[2] for n in names if n.startswith(f"{RUN_PARTITION}=") and "__HIVE" not in n)


def read_forecast_table(spark: SparkSession, path: str, newest_days: int | None = None) -> DataFrame:
    """The forecast table with its declared schema; an empty one is an error.

    ``newest_days``: only runs of the newest run date and so many days before it; it is found by listing folders and
    given to the scan as a literal, so older runs are neither listed as files nor read.  A city whose newest run is
    older than that is left out.
    """
    dates = run_dates(spark, path)
    if newest_days is not None and not dates:
        raise ValueError(f"Forecast table is empty: {path}")
    schema = S.FORECAST_SCHEMA if not dates else T.StructType([*S.FORECAST_SCHEMA, T.StructField(RUN_PARTITION, T.DateType())])
    df = spark.read.schema(schema).parquet(path)
    if newest_days is not None:
        df = df.filter(F.col(RUN_PARTITION) >= F.lit(str(dt.date.fromisoformat(dates[-1]) - dt.timedelta(days=newest_days))).cast("date"))
    df = df.drop(RUN_PARTITION)
    if df.isEmpty():
        raise ValueError(f"Forecast table is empty: {path}")
    return df


def cast_for_store(df: DataFrame, time_columns=("timestamp", "ingestion_timestamp")) -> DataFrame:
    """String city, parsed timestamps, double measures, NULL ints -> 0 (bigint);
    rows with a missing time column are dropped."""
    ints = [c for c in ("is_future", *S.INT_TIME_COLUMNS) if c in df.columns]
    times = [c for c in df.columns if c in S.TIMESTAMP_COLUMNS]
    skip = {"city", *times, *ints}
    exprs = {}
    if "city" in df.columns:
        exprs["city"] = F.col("city").cast("string")
    for c in times:
        exprs[c] = parse_timestamp(c)
    for c in df.columns:
        if c not in skip:
            v = F.col(c).try_cast("double")
            exprs[c] = F.when(~F.isnan(v), v)
    for c in ints:
        v = F.col(c).try_cast("double")
        exprs[c] = F.coalesce(F.when(~F.isnan(v), v), F.lit(0.0)).cast("bigint")
    out = df.withColumns(exprs)
    return out.na.drop(subset=[c for c in time_columns if c in out.columns])


MONTH_PARTITION = "obs_month"


def read_keyed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a partitioned table with its declared schema.

    Without it, partition values are typed by guess: cities ``007`` and ``7`` would both become 7.
    """
    return spark.read.schema(schema).parquet(path)


def stored_schema(spark: SparkSession, path: str, batch: T.StructType) -> T.StructType:
    """The stored columns in their stored types, then the batch's new ones.

    A column of both must have one type; partition columns take the batch's, as folders have none.
    """
    with_types = {f.name: f for f in batch}
    found = spark.read.parquet(path).schema
    parts = _partition_columns(spark, path)
    out = T.StructType()
    for f in found:
        mine = with_types.get(f.name)
        if f.name in parts and mine is not None:
            out.add(mine)
            continue
        if mine is not None and mine.dataType != f.dataType:
            raise ValueError(f"Column {f.name} is {f.dataType.simpleString()} in the table, "
                             f"{mine.dataType.simpleString()} in the batch.")
        out.add(f)
    for f in batch:
        if f.name not in found.names:
            out.add(f)
    return out


def _partition_columns(spark: SparkSession, path: str) -> set[str]:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    out: set[str] = set()
    while True:
        names = [x.getPath() for x in fs.listStatus(p) if x.isDirectory() and "=" in x.getPath().getName()]
        if not names:
            return out
        out.add(names[0].getName().partition("=")[0])
        p = names[0]


class _Commits:
    """The commits of one keyed table: numbered marker files that name a staged folder.

    A marker is created exclusively and is the commit: before it the table is as it was, after it the staged partitions
    replace the table's, by this writer or, if it dies, by whoever writes next.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.fs = hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())

    def last(self) -> int:
        return max(claimed(self.spark, f"{self.path}/_commits"), default=0)

    def staged(self, name: str) -> str:
        return f"{self.path}/_staged/{name}"

    def commit(self, number: int, name: str, partition_by) -> bool:
        """False if another writer has this number."""
        from py4j.protocol import Py4JJavaError
        try:
            out = self.fs.create(hadoop_path(self.spark, f"{self.path}/_commits/{number}"), False)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        out.writeUTF(",".join([name, *partition_by]))
        out.close()
        return True

    def apply(self, name: str, partition_by) -> None:
        """Replace the staged partitions; doing it twice changes nothing."""
        (self.spark.read.parquet(self.staged(name)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by).parquet(self.path))
        self.fs.delete(hadoop_path(self.spark, self.staged(name)), True)
        for n in claimed(self.spark, f"{self.path}/_commits")[:-1]:
            self.fs.delete(hadoop_path(self.spark, f"{self.path}/_commits/{n}"), False)

    def finish(self, patience: float) -> None:
        """Apply the last commit if its writer has not; it gets ``patience`` seconds from its commit on."""
        n = self.last()
        marker = hadoop_path(self.spark, f"{self.path}/_commits/{n}")
        if not n or not self.fs.getFileStatus(marker).getLen():
            return  # a writer that died in the act has committed nothing
        read = self.fs.open(marker)
        name, *partition_by = read.readUTF().split(",")
        read.close()
        staged = hadoop_path(self.spark, self.staged(name))
        while self.fs.exists(staged):
            if time.time() - self.fs.getFileStatus(marker).getModificationTime() / 1000 >= patience:
                return self.apply(name, partition_by)
            time.sleep(0.5)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a keyed table holds any partition (a first write may have died before its commit)."""
    p = hadoop_path(spark, path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and any(not f.getPath().getName().startswith(("_", ".")) for f in fs.listStatus(p))


def keyed_upsert(incoming: DataFrame, path: str, key=("city", "timestamp"),
                 order=("ingestion_timestamp",), partition_by=("city",),
                 month_partitions: bool = False, ts: str = "timestamp", patience: float = 300.0, attempts: int = 5) -> DataFrame:
    """Insert-or-replace by primary key into a Parquet table partitioned by city.

    Existing rows of the touched partitions are unioned with the batch, the
    newest row per key wins (grouped ``max_by``, skew-safe), and only the
    touched partitions are overwritten (dynamic partition overwrite).
    ``month_partitions`` adds a (city, month) layout so an upsert of recent
    hours rewrites one month of a city, not its whole history.  The batch's
    first and last value of a date partition are literals in the scan's filter.
    A column that only the batch has is added (NULL in stored rows); one that
    only the table has is kept (NULL in new rows); a changed type is an error.

    The merged rows are staged in the table's folder, then committed under the next number, then put in place.  A
    writer that dies before its commit leaves the table as it was; one that dies after it is finished by the next
    (``patience`` seconds after the commit).  Of two writers with the same number one merges anew, so no update is lost.
    Returns the table as read back (without the partition helper column).
    """
    spark = incoming.sparkSession
    if month_partitions:
        incoming = incoming.withColumn(MONTH_PARTITION, F.trunc(F.to_date(ts), "month"))
        partition_by = (*partition_by, MONTH_PARTITION)
    commits = _Commits(spark, path)
    for _ in range(attempts):
        commits.finish(patience)
        base = commits.last()
        merged, schema = incoming, incoming.schema
        if table_exists(spark, path):
            schema = stored_schema(spark, path, incoming.schema)
            existing = read_keyed(spark, path, schema)
            for c in partition_by:  # time partitions are pruned by literals
                if incoming.schema[c].dataType.typeName() == "date":
                    existing = existing.filter(month_range(incoming, c))
            touched = incoming.select(*partition_by).distinct()
            # semi join keeps only partitions the batch touches (the side is one row per city and month)
            merged = existing.join(touched, list(partition_by), "left_semi").unionByName(
                incoming, allowMissingColumns=True)
        merged = dedupe_keep_last(merged.select(*schema.names), key=key, order=order)
        name = uuid.uuid4().hex
        merged.select(*schema.names).write.parquet(commits.staged(name))
        if commits.commit(base + 1, name, partition_by):
            commits.apply(name, partition_by)
            break
        commits.fs.delete(hadoop_path(spark, commits.staged(name)), True)
    else:
        raise RuntimeError(f"{attempts} other writers were faster: {path}")
    names = dict.fromkeys([*incoming.columns, *schema.names])
    return read_keyed(spark, path, schema).select(*names).drop(MONTH_PARTITION)


def month_range(rows: DataFrame, column: str = MONTH_PARTITION):
    """Partition filter: ``column`` between the first and the last month of ``rows``, as literals."""
    lo, hi = rows.agg(F.min(column), F.max(column)).first()
    if lo is None:
        return F.lit(False)
    return F.col(column).between(F.lit(lo), F.lit(hi))


def write_csv(df: DataFrame, name: str, path: str | None = None) -> str:
    path = path or scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def hourly_records(hourly: DataFrame) -> DataFrame:
    """Payload hourly columns in order, as far as the table has them."""
    out = hourly.select(*[c for c in ("city", *S.HOURLY_RECORD_COLUMNS) if c in hourly.columns])
    return out.withColumn("timestamp", F.date_format("timestamp", TS_FORMAT))


def daily_records(daily: DataFrame) -> DataFrame:
    return daily.withColumns({c: F.date_format(c, TS_FORMAT) for c in ("start_time", "end_time")
                              if c in daily.columns})


def display_table(df: DataFrame) -> DataFrame:
    """Dashboard view: display names, minute-precision times; absent columns skipped."""
    exprs = []
    for c in df.columns:
        col = F.col(c)
        if c in ("start_time", "end_time", "timestamp"):
            col = F.date_format(col, MINUTE_FORMAT)
        exprs.append(col.alias(S.DISPLAY_NAMES.get(c, c)))
    return df.select(*exprs)


# ---------------------------------------------------------------------------
# Model registry: one row per (name, version); artifacts are Spark ML folders.
# ---------------------------------------------------------------------------

REGISTRY_COLUMNS = ["name", "version", "mae", "rmse", "r2", "feature_count", "best_model_name",
                    "feature_columns", "training_rows", "training_start", "training_end", "created_at",
                    "model_path", "feature_importance"]


def read_registry(spark: SparkSession, registry_path: str) -> DataFrame:
    """All committed records.  The schema is declared, so an empty registry reads as no rows."""
    return spark.read.schema(S.REGISTRY_SCHEMA).parquet(registry_path)


def create_once(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already.  One writer of many gets True where the store creates atomically."""
    from py4j.protocol import Py4JJavaError
    p = hadoop_path(spark, path)
    try:
        return p.getFileSystem(spark._jsc.hadoopConfiguration()).createNewFile(p)
    except Py4JJavaError as e:  # taken between the look and the creation
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise


def claimed(spark: SparkSession, folder: str) -> list[int]:
    """The numbers taken in a folder of marker files."""
    p = hadoop_path(spark, folder)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(p)) if fs.exists(p) else []


def claim_version(spark: SparkSession, registry_path: str, name: str) -> int:
    """A version number of the name that no other writer gets.

    A marker file is created exclusively; whoever finds it taken goes on to the next number.  A writer that
    dies behind its claim leaves a gap, never a doubled version.
    """
    from urllib.parse import quote
    folder = f"{registry_path}/_versions/{quote(name, safe='')}"
    version = 1 + max(claimed(spark, folder), default=0)
    while not create_once(spark, f"{folder}/{version}"):
        version += 1
    return version


def registry_append(spark: SparkSession, registry_path: str, record: DataFrame) -> DataFrame:
    """Append model records; each takes the next free version of its name.

    The row is the commit: until it is written, a claimed version is not seen.
    """
    names = [r["name"] for r in record.select("name").distinct().collect()]  # one training job's models
    versions = {n: claim_version(spark, registry_path, n) for n in names}
    number = F.create_map(*[F.lit(x) for n, v in versions.items() for x in (n, v)])
    rec = record.withColumn("version", number[F.col("name")].cast("bigint"))
    missing = [c for c in REGISTRY_COLUMNS if c not in rec.columns]
    rec = rec.withColumns({c: F.lit(None).cast(S.REGISTRY_SCHEMA[c].dataType) for c in missing})
    rec.select(*REGISTRY_COLUMNS).write.mode("append").parquet(registry_path)
    return read_registry(spark, registry_path)


def registry_latest(registry: DataFrame, name: str | None = None, version: int | None = None) -> DataFrame:
    """Explicit version if given, else each name's highest version."""
    df = registry if name is None else registry.filter(F.col("name") == name)
    if version is not None:
        return df.filter(F.col("version") == version)
    top = df.groupBy("name").agg(F.max_by(F.struct(*[F.col(c) for c in df.columns if c != "name"]),
                                          F.col("version")).alias("_r"))
    return top.select("name", *[F.col("_r")[c].alias(c) for c in df.columns if c != "name"])


def registry_metadata_merge(documents: DataFrame, default_name: str = S.DEFAULT_MODEL_TITLE,
                            key: str = "name", order: str = "doc_order") -> DataFrame:
    """Merge metadata documents per model: later documents override earlier keys.

    Display name = best_model_name, else model_name, else ``default_name``;
    the feature list is the file's list over the bundle's, trimmed and
    lower-cased.  Each merged key is the last non-NULL value in document
    order (grouped ``max_by``, no per-model window).
    """
    def last(c):
        return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order)))

    merged = documents.groupBy(key).agg(
        last("best_model_name").alias("best_model_name"), last("model_name").alias("model_name"),
        last("file_feature_columns").alias("_ff"), last("bundle_feature_columns").alias("_bf"),
        last("training_rows").alias("training_rows"))
    features = F.transform(F.coalesce("_ff", "_bf"), lambda x: F.lower(F.trim(x)))
    return merged.select(
        key, F.coalesce("best_model_name", "model_name", F.lit(default_name)).alias("display_name"),
        "best_model_name", "model_name", features.alias("feature_columns"),
        F.size(features).cast("bigint").alias("feature_count"), "training_rows")


def selected_features(table: DataFrame, features=None) -> DataFrame:
    """feature, selected, rank 1..n for the model features present in ``table``."""
    features = list(features or S.MODEL_FEATURE_COLUMNS)
    counts = table.agg(*[F.count(F.col(c)).alias(c) for c in features])
    long = counts.unpivot([], features, "feature", "_n")
    rank = F.create_map(*[x for i, f in enumerate(features) for x in (F.lit(f), F.lit(i + 1))])
    return long.select("feature", (F.col("_n") > 0).alias("selected"),
                       rank[F.col("feature")].cast("bigint").alias("rank"))
