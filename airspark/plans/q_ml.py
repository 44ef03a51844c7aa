"""Model queries.  Ridge and the preprocessing have an exact SQL form; fits of trees have none (rows-only checks,
brute force in the tests).

``queries()`` fits with the library defaults, which are the reference's (300
trees, 300 boosting rounds).  The four queries that use the selected model share one training: it is registered
under the digest of the training table, and whoever comes with the same table loads it.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.numeric import np_round
from ..operators.clean import training_clean
from ..operators.forecast import prepare_scoring
from ..operators.split import time_split
from ..session import ensure_checkpoint_dir, scratch_path
from ..sources import fixture as FX
from ..sources import store as ST
from . import ml as M
from . import oracle as O
from .catalog import register
from .q_core import training_table
from .q_scoring import stored_forecast

MODEL_NAME = "aqi_model"


def _table(spark, sf_dir):
    """The training job's input: the stored feature table, read back and cleaned."""
    path = ST.write_table(training_table(spark, sf_dir), "training_table", partition_by=["city"])
    return training_clean(ST.read_training_table(spark, path))


def _split(spark, sf_dir):
    t = time_split(_table(spark, sf_dir))
    return t.filter(F.col("split") == "train").drop("split"), t.filter(F.col("split") == "test").drop("split")


def _fit_one(spark, sf_dir, name):
    train, test = _split(spark, sf_dir)
    model = M.estimators(train, only=(name,))[name].fit(train)
    return model.transform(test).select("city", "timestamp", S.TARGET_COLUMN, "prediction")


def ridge_ctes(src: str, learned: str = "TRUE") -> list[str]:
    """mo, mat, el: the normal equations over standardised features of some rows of ``src``, solved by elimination."""
    n, y, cols = len(S.MODEL_FEATURE_COLUMNS), S.TARGET_COLUMN, S.MODEL_FEATURE_COLUMNS
    moments = f"mo AS (SELECT avg({y}) AS my, " + ", ".join(
        f"avg({c}) AS m{i}, stddev_pop({c}) AS d{i}" for i, c in enumerate(cols)) + f" FROM {src} WHERE {learned})"
    z = f"zl AS (SELECT {src}.{y}, mo.my, " + ", ".join(f"{_standard(c, i)} AS z{i}" for i, c in enumerate(cols)) + f" FROM {src}, mo WHERE {learned})"
    rows = ", ".join("[" + ", ".join(
        [f"sum(z{i} * z{j})" + (f" + {O.dbl(M.RIDGE_ALPHA)}" if i == j else "") for j in range(n)] + [f"sum(z{i} * ({y} - my))"]) + "]"
        for i in range(n))
    eliminate = ("el AS (SELECT 1 AS k, m FROM mat UNION ALL SELECT k + 1, list_transform(m, lambda r, i: CASE WHEN i = k "
                 "THEN list_transform(r, lambda x: x / r[k]) ELSE list_transform(r, lambda x, j: x - r[k] * m[k][j] / m[k][k]) END) "
                 f"FROM el WHERE k <= {n})")
    return [moments, z, f"mat AS (SELECT [{rows}] AS m FROM zl)", eliminate, f"fit AS (SELECT m FROM el WHERE k = {n + 1})"]


def _standard(column: str, i: int) -> str:
    return f"CASE WHEN d{i} > 0 THEN ({column} - m{i}) / d{i} ELSE 0e0 END"


def ridge_prediction() -> str:
    """The prediction for a row joined with ``mo`` and ``fit``."""
    n = len(S.MODEL_FEATURE_COLUMNS)
    return "my + " + " + ".join(f"m[{i + 1}][{n + 1}] * {_standard(c, i)}" for i, c in enumerate(S.MODEL_FEATURE_COLUMNS))


def recursive(ctes, final: str) -> str:
    return O.with_(ctes, final).replace("WITH ", "WITH RECURSIVE ", 1)


def _ridge_sql():
    y = S.TARGET_COLUMN
    split = ("sp AS (SELECT *, row_number() OVER (ORDER BY timestamp, city) <= "
             "(SELECT CAST(floor(count(*) * 0.8e0) AS BIGINT) FROM train) AS learned FROM train)")
    return recursive([*O.training_ctes(), split, *ridge_ctes("sp", "learned")],
                     f"SELECT city, timestamp, {O.r6(y)} AS {y}, {O.r_digits(ridge_prediction(), 4)} AS prediction "
                     "FROM sp, mo, fit WHERE NOT learned")


@register("ml_ridge", _ridge_sql())
def q_ml_ridge(spark, sf_dir):
    """Test-side predictions; rounded to the digits that two ways of solving share."""
    from ..functions.numeric import stable6
    got = _fit_one(spark, sf_dir, M.RIDGE)
    return got.withColumns({S.TARGET_COLUMN: stable6(F.col(S.TARGET_COLUMN)), "prediction": np_round("prediction", 4)})


@register("ml_forest")
def q_ml_forest(spark, sf_dir):
    return _fit_one(spark, sf_dir, M.FOREST)


@register("ml_boosted")
def q_ml_boosted(spark, sf_dir):
    return _fit_one(spark, sf_dir, M.BOOSTED)


@register("ml_compare")
def q_ml_compare(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    metrics, _, _ = M.compare(train, test, M.estimators(train))
    return metrics


def _registered(spark, sf_dir):
    """(registry row of the selected model, table): trained once for a table, then loaded."""
    table = _table(spark, sf_dir)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/airspark/registry"
    return M.registered_model(table, path, MODEL_NAME), table


@register("ml_refit")
def q_ml_refit(spark, sf_dir):
    row, full = _registered(spark, sf_dir)
    row = row.first()
    return PipelineModel.load(row["model_path"]).transform(full).select(
        "city", "timestamp", S.TARGET_COLUMN, "prediction", F.lit(row["best_model_name"]).alias("model_name"))


@register("ml_importance")
def q_ml_importance(spark, sf_dir):
    row, _ = _registered(spark, sf_dir)
    return M.feature_importance(row)


@register("ml_score")
def q_ml_score(spark, sf_dir):
    """The registered model, loaded from its folder, with its stored feature list."""
    row, _ = _registered(spark, sf_dir)
    return M.score_with(row.first(), lambda features: prepare_scoring(
        stored_forecast(spark, sf_dir, newest_days=0), features, horizon=72, timezone=FX.CITY_TIMEZONE)
    ).select("city", "timestamp", "predicted_aqi", "aqi_category")


REGISTERED = ["name", "version", "feature_count", "training_rows", "training_start", "training_end", "created_at"]


@register("registry_append", O.with_(O.training_ctes(), f"""SELECT '{MODEL_NAME}' AS name, v AS version,
 CAST({len(S.MODEL_FEATURE_COLUMNS)} AS BIGINT) AS feature_count, CAST(count(*) AS BIGINT) AS training_rows,
 min(timestamp) AS training_start, max(timestamp) AS training_end, max(timestamp) AS created_at,
 TRUE AS scored FROM train, (VALUES (CAST(1 AS BIGINT)), (CAST(2 AS BIGINT))) AS t(v) GROUP BY v"""))
def q_registry_append(spark, sf_dir):
    """Two versions of the selected model: key, training rows and span, and whether it holds metrics and importances."""
    row, _ = _registered(spark, sf_dir)
    path = scratch_path(spark, "registry-twice")
    record = row.drop("version").withColumn("name", F.lit(MODEL_NAME))
    ST.registry_append(spark, path, record)
    scored = (F.col("mae") >= 0) & (F.col("rmse") >= F.col("mae")) & (F.size("feature_importance") == F.col("feature_count"))
    return ST.registry_append(spark, path, record).select(*REGISTERED, scored.alias("scored"))


GAP = "hour % 7 = 0"  # rows whose features are taken away, to be filled by the medians


@register("ml_preprocess", O.with_(O.training_ctes() + [
    "gap AS (SELECT city, timestamp, " + ", ".join(
        f"CASE WHEN {GAP} THEN NULL ELSE CAST({c} AS DOUBLE) END AS {c}" for c in S.MODEL_FEATURE_COLUMNS) + " FROM train)",
    "med AS (SELECT " + ", ".join(f"coalesce(median({c}), 0e0) AS {c}" for c in S.MODEL_FEATURE_COLUMNS) + " FROM gap)"],
    "SELECT g.city, g.timestamp, " + ", ".join(
        f"{O.r6(f'coalesce(g.{c}, m.{c})')} AS {c}" for c in S.MODEL_FEATURE_COLUMNS) + " FROM gap g, med m"))
def q_ml_preprocess(spark, sf_dir):
    """The model pipeline's own stages on rows with missing features: medians, then the vector, element by element."""
    from ..functions.numeric import stable6
    t = training_table(spark, sf_dir)
    gaps = t.select("city", "timestamp", *[F.when(F.expr(GAP), None).otherwise(F.col(c).cast("double")).alias(c)
                                           for c in S.MODEL_FEATURE_COLUMNS])
    done = Pipeline(stages=M.preprocessing(gaps)).fit(gaps).transform(gaps)
    vector = vector_to_array("features")
    return done.select("city", "timestamp", *[stable6(vector[i]).alias(c) for i, c in enumerate(S.MODEL_FEATURE_COLUMNS)])
