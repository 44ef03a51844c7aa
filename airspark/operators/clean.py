"""Projection, cleaning and predicate operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas as S
from ..functions.numeric import clip, np_round, try_double
from ..functions.time import parse_timestamp, to_local_time


def normalize_name(name: str) -> str:
    return str(name).strip().lower().replace(" ", "_").replace("-", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Trim, lower-case, space and '-' to '_' (a metadata-only rename)."""
    return df.toDF(*[normalize_name(c) for c in df.columns])


def coerce_numeric(df: DataFrame, cols) -> DataFrame:
    """Unparsable text -> NULL, NaN -> NULL; result is double."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: try_double(c) for c in present})


def coerce_timestamp(df: DataFrame, cols, drop: bool = True) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    out = df.withColumns({c: parse_timestamp(c) for c in present})
    return out.na.drop(subset=present) if drop and present else out


def localize_timestamps(df: DataFrame, cols, timezone: str) -> DataFrame:
    """Text and instants -> naive wall time in ``timezone``; naive values stay."""
    out = {}
    for c in cols:
        if c not in df.columns:
            continue
        kind = df.schema[c].dataType.typeName()
        if kind == "timestamp_ntz":
            continue
        if kind == "timestamp":
            from ..functions.time import instant_to_local
            out[c] = instant_to_local(F.col(c), timezone)
        else:
            out[c] = to_local_time(c, timezone)
    return df.withColumns(out) if out else df


def tag_location(df: DataFrame, city: str, country: str, latitude: float, longitude: float,
                 ingestion_timestamp) -> DataFrame:
    return df.withColumns({
        "city": F.lit(city),
        "country": F.lit(country),
        "latitude": F.lit(float(latitude)),
        "longitude": F.lit(float(longitude)),
        "ingestion_timestamp": F.lit(ingestion_timestamp).cast("timestamp_ntz"),
    })


def dedupe_keep_last(df: DataFrame, key=("city", "timestamp"), order=("ingestion_timestamp",)) -> DataFrame:
    """One row per key: the greatest ``order`` tuple wins ("keep last").

    Written as a grouped maximum of a struct, not a ``row_number`` window, so
    duplicates are combined map-side before the shuffle and a key with a huge
    number of copies never sits whole in one task.
    Rows that tie on ``order`` (or have none of its columns) are ordered by
    their remaining values, so the choice never depends on the partitioning.
    """
    key = list(key)
    order = [c for c in order if c in df.columns and c not in key]
    rest = [c for c in df.columns if c not in key]
    last = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest if c not in order])).alias("_row")
    out = df.groupBy(*key).agg(last)
    return out.select(*key, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def clip_bounds(df: DataFrame, bounds=None, only=None) -> DataFrame:
    """Clip every present column with bounds; NULL stays NULL."""
    bounds = S.CLIP_BOUNDS if bounds is None else bounds
    cols = [c for c in bounds if c in df.columns and (only is None or c in only)]
    return df.withColumns({c: clip(c, *bounds[c]) for c in cols})


def drop_incomplete(df: DataFrame, cols) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.na.drop(subset=present) if present else df


def round_to_int(df: DataFrame, cols) -> DataFrame:
    """Half-even round then integer (pandas ``round().astype('Int64')``)."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.rint(F.col(c).cast("double")).cast("bigint") for c in present})


def select_outputs(df: DataFrame, cols) -> DataFrame:
    return df.select(*S.unique(cols))


def training_clean(df: DataFrame, order=("ingestion_timestamp",)) -> DataFrame:
    """Coerce, round integer time features, dedupe, drop incomplete rows.

    The result is written once, for its users read it several times; without
    a row left it raises.
    """
    required = ["city", "timestamp", *S.MODEL_FEATURE_COLUMNS, S.TARGET_COLUMN]
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    out = coerce_timestamp(df, ["timestamp"])
    out = coerce_numeric(out, [c for c in S.MODEL_FEATURE_COLUMNS if c not in S.INT_TIME_COLUMNS]
                         + [S.TARGET_COLUMN])
    out = out.withColumns({c: try_double(c) for c in S.INT_TIME_COLUMNS})
    out = round_to_int(out, S.INT_TIME_COLUMNS)
    out = dedupe_keep_last(out, key=("city", "timestamp"), order=order)
    from .quality import written_rows
    return written_rows(drop_incomplete(out, S.MODEL_FEATURE_COLUMNS + [S.TARGET_COLUMN]), "training-clean",
                        "No rows left after cleaning the training table.")


def convert_units(df: DataFrame) -> DataFrame:
    """no2_1h copy, then ppb/ppm conversions of the rolled gases."""
    out = df.withColumn("no2_1h", F.col("nitrogen_dioxide"))
    return out.withColumns({
        "o3_8h_ppb": F.col("o3_8h") * F.lit(S.O3_TO_PPB),
        "co_8h_ppm": F.col("co_8h") * F.lit(S.CO_TO_PPM),
        "no2_1h_ppb": F.col("no2_1h") * F.lit(S.NO2_TO_PPB),
    })


def add_time_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    from ..functions.time import cyclic_columns, time_part_columns
    out = df.withColumns(time_part_columns(ts))
    return out.withColumns(cyclic_columns())


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column with the shared rint arithmetic."""
    dbl = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: np_round(F.col(f"`{c}`"), digits) for c in dbl})
