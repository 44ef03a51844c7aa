"""Column groups, bounds, breakpoints and conversion constants.

The values in the FIXED VALUES block must equal the reference behaviour for
results to match: column lists (order is part of the model contract), clip
bounds, gas conversion factors, AQI category edges, pollutant breakpoints and
advice texts.  They are stated here once, in natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reference semantics)
# ---------------------------------------------------------------------------

# Gas conversions, µg/m³ to ppb / ppm at 25 °C (molar volume 24.465 L).
O3_TO_PPB = 24.465 / 48
NO2_TO_PPB = 24.465 / 46
CO_TO_PPM = 24.465 / (28 * 1000)

RAW_AIR_QUALITY_COLUMNS = ["pm25", "pm10", "carbon_monoxide", "nitrogen_dioxide", "ozone"]

RAW_WEATHER_COLUMNS = [
    "temperature_2m",
    "relative_humidity_2m",
    "precipitation",
    "windspeed_10m",
    "surface_pressure",
    "shortwave_radiation",
    "et0_fao_evapotranspiration",
]

BASE_MODEL_FEATURE_COLUMNS = [
    "pm25_24h",
    "pm10_24h",
    "o3_8h_ppb",
    "co_8h_ppm",
    "no2_1h_ppb",
    "temperature_2m",
    "relative_humidity_2m",
    "precipitation",
    "windspeed_10m",
    "surface_pressure",
    "shortwave_radiation",
    "et0_fao_evapotranspiration",
]

TIME_FEATURE_COLUMNS = [
    "hour",
    "day_of_week",
    "is_weekend",
    "hour_sin",
    "hour_cos",
    "day_of_week_sin",
    "day_of_week_cos",
]

DERIVED_DIAGNOSTIC_COLUMNS = ["o3_8h", "co_8h", "no2_1h"]

# Display name of a model whose metadata name none.
DEFAULT_MODEL_TITLE = "Best AQI Model"

TARGET_COLUMN = "us_aqi"
REFERENCE_COLUMN = "openmeteo_us_aqi_reference"

CLIP_BOUNDS = {
    "pm25": (0, 500),
    "pm10": (0, 600),
    "carbon_monoxide": (0, 60000),
    "nitrogen_dioxide": (0, 4000),
    "ozone": (0, 1000),
    "temperature_2m": (-10, 55),
    "relative_humidity_2m": (0, 100),
    "precipitation": (0, 200),
    "windspeed_10m": (0, 150),
    "surface_pressure": (900, 1100),
    "shortwave_radiation": (0, 1200),
    "et0_fao_evapotranspiration": (0, 20),
    "pm25_24h": (0, 500),
    "pm10_24h": (0, 600),
    "o3_8h_ppb": (0, 300),
    "co_8h_ppm": (0, 50),
    "no2_1h_ppb": (0, 2049),
    "hour": (0, 23),
    "day_of_week": (0, 6),
    "is_weekend": (0, 1),
    "hour_sin": (-1, 1),
    "hour_cos": (-1, 1),
    "day_of_week_sin": (-1, 1),
    "day_of_week_cos": (-1, 1),
    "us_aqi": (0, 500),
    "openmeteo_us_aqi_reference": (0, 500),
}

PREDICTION_BOUNDS = (0, 500)

# AQI category: inclusive upper edge, label; above the last edge is Hazardous.
AQI_CATEGORY_EDGES = [
    (50, "Good"),
    (100, "Moderate"),
    (150, "Unhealthy for Sensitive Groups"),
    (200, "Unhealthy"),
    (300, "Very Unhealthy"),
]
AQI_TOP_CATEGORY = "Hazardous"
UNKNOWN = "Unknown"
MEASURED = "Measured"

AQI_ADVICE = {
    "Good": "Air quality is clean. Normal outdoor activity is fine.",
    "Moderate": "Air quality is acceptable. Sensitive people should stay aware.",
    "Unhealthy for Sensitive Groups": "Sensitive groups should reduce long outdoor exposure.",
    "Unhealthy": "Everyone should limit prolonged outdoor activity.",
    "Very Unhealthy": "Avoid outdoor exertion. Keep windows closed if possible.",
    "Hazardous": "Health warning. Avoid outdoor activity and use protection indoors.",
    "Unknown": "AQI status unavailable.",
}
# The dashboard wording differs for "Good" only.
AQI_ADVICE_DASHBOARD_GOOD = "Air quality is clean. Great time for normal outdoor activity."
AQI_ADVICE_FALLBACK = "AQI status unavailable."

# Pollutant level breakpoints: inclusive upper edges for the first five
# categories of AQI_CATEGORY_EDGES; above the last edge is Hazardous.
POLLUTANT_BREAKPOINTS = {
    "pm25_24h": [9.0, 35.4, 55.4, 125.4, 225.4],
    "pm10_24h": [54, 154, 254, 354, 424],
    "o3_8h_ppb": [54, 70, 85, 105, 200],
    "co_8h_ppm": [4.4, 9.4, 12.4, 15.4, 30.4],
    "no2_1h_ppb": [53, 100, 360, 649, 1249],
}

# Display name, column, unit, description.
POLLUTANT_COLUMNS = [
    ("PM2.5", "pm25_24h", "µg/m³", "Fine particles"),
    ("PM10", "pm10_24h", "µg/m³", "Coarse particles"),
    ("Ozone O₃", "o3_8h_ppb", "ppb", "Ground-level ozone"),
    ("CO", "co_8h_ppm", "ppm", "Carbon monoxide"),
    ("NO₂", "no2_1h_ppb", "ppb", "Nitrogen dioxide"),
]

# Columns of a payload's hourly records, in order; those that a table lacks are left out.
HOURLY_RECORD_COLUMNS = [
    "timestamp", "predicted_aqi", "aqi_category", "openmeteo_us_aqi_reference", "pm25_24h", "pm10_24h", "o3_8h_ppb",
    "co_8h_ppm", "no2_1h_ppb", "temperature_2m", "relative_humidity_2m", "precipitation", "windspeed_10m", "surface_pressure",
]

# Dashboard display names.
DISPLAY_NAMES = {
    "forecast_day": "Forecast Day",
    "start_time": "Start Time",
    "end_time": "End Time",
    "timestamp": "Time",
    "predicted_aqi": "Predicted AQI",
    "aqi_category": "AQI Category",
    "openmeteo_us_aqi_reference": "Open-Meteo AQI Reference",
    "pm25_24h": "PM2.5",
    "pm10_24h": "PM10",
    "o3_8h_ppb": "O₃",
    "co_8h_ppm": "CO",
    "no2_1h_ppb": "NO₂",
}

# Upstream response variable names.
AIR_RESPONSE_VARIABLES = ["pm2_5", "pm10", "carbon_monoxide", "nitrogen_dioxide", "ozone", "us_aqi"]
WEATHER_RESPONSE_VARIABLES = list(RAW_WEATHER_COLUMNS)

DEFAULT_HORIZON_HOURS = 72
MAX_HORIZON_HOURS = 168
TRAIN_FRACTION = 0.80
API_DAILY_MAX_DAYS = 3
BLOCKED_FEATURES = ["month", "month_sin", "month_cos"]

# ---------------------------------------------------------------------------
# Derived groups
# ---------------------------------------------------------------------------

RAW_FEATURE_COLUMNS = RAW_AIR_QUALITY_COLUMNS + RAW_WEATHER_COLUMNS
MODEL_FEATURE_COLUMNS = BASE_MODEL_FEATURE_COLUMNS + TIME_FEATURE_COLUMNS
INT_TIME_COLUMNS = ["hour", "day_of_week", "is_weekend"]
POLLUTANT_FEATURE_COLUMNS = [c for _, c, _, _ in POLLUTANT_COLUMNS]


def unique(cols):
    """Order-preserving de-duplication."""
    return list(dict.fromkeys(cols))


TRAINING_OUTPUT_COLUMNS = unique(
    ["city", "timestamp", "ingestion_timestamp"]
    + RAW_FEATURE_COLUMNS
    + DERIVED_DIAGNOSTIC_COLUMNS
    + MODEL_FEATURE_COLUMNS
    + [TARGET_COLUMN]
)

FORECAST_OUTPUT_COLUMNS = unique(
    ["city", "timestamp", "ingestion_timestamp", "forecast_run_timestamp", "is_future"]
    + RAW_FEATURE_COLUMNS
    + DERIVED_DIAGNOSTIC_COLUMNS
    + MODEL_FEATURE_COLUMNS
    + [REFERENCE_COLUMN]
)

LONG_COLUMNS = set(INT_TIME_COLUMNS) | {"is_future"}
TIMESTAMP_COLUMNS = {"timestamp", "ingestion_timestamp", "forecast_run_timestamp"}


def column_type(name: str) -> T.DataType:
    if name == "city":
        return T.StringType()
    if name in TIMESTAMP_COLUMNS:
        return T.TimestampNTZType()
    if name in LONG_COLUMNS:
        return T.LongType()
    return T.DoubleType()


def table_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, column_type(c), True) for c in columns])


REGISTRY_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("version", T.LongType()), T.StructField("mae", T.DoubleType()),
    T.StructField("rmse", T.DoubleType()), T.StructField("r2", T.DoubleType()), T.StructField("feature_count", T.LongType()),
    T.StructField("best_model_name", T.StringType()), T.StructField("feature_columns", T.ArrayType(T.StringType())),
    T.StructField("training_rows", T.LongType()), T.StructField("training_start", T.TimestampNTZType()),
    T.StructField("training_end", T.TimestampNTZType()), T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("model_path", T.StringType()), T.StructField("feature_importance", T.ArrayType(T.DoubleType())),
])
TRAINING_SCHEMA = table_schema(TRAINING_OUTPUT_COLUMNS)
FORECAST_SCHEMA = table_schema(FORECAST_OUTPUT_COLUMNS)


def hourly_response_schema(variables) -> T.StructType:
    """Upstream hourly response: parallel arrays keyed by variable name."""
    fields = [T.StructField("time", T.ArrayType(T.StringType()), True)]
    fields += [T.StructField(v, T.ArrayType(T.DoubleType()), True) for v in variables]
    return T.StructType([
        T.StructField("city", T.StringType(), True),
        T.StructField("chunk_start", T.DateType(), True),
        T.StructField("hourly", T.StructType(fields), True),
    ])


AIR_RESPONSE_SCHEMA = hourly_response_schema(AIR_RESPONSE_VARIABLES)
WEATHER_RESPONSE_SCHEMA = hourly_response_schema(WEATHER_RESPONSE_VARIABLES)

GEOCODE_RESULT_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("admin1", T.StringType(), True),
    T.StructField("latitude", T.DoubleType(), True),
    T.StructField("longitude", T.DoubleType(), True),
])
