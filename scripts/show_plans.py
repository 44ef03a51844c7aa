"""Print the formatted physical plans of the headline operators.

    python scripts/show_plans.py [sf_dir] [name ...]

Shows what the README claims: filters and column pruning at the Parquet
scan, one exchange feeding the series windows, WindowGroupLimit before the
shuffle for per-city top-N, partial aggregation before every grouped shuffle.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from airspark import schemas as S  # noqa: E402
from airspark.operators.clean import dedupe_keep_last  # noqa: E402
from airspark.operators.forecast import horizon_rows  # noqa: E402
from airspark.operators.series import add_positions, series_features  # noqa: E402
from airspark.plans.features import ROLLS  # noqa: E402
from airspark.plans.q_core import observations  # noqa: E402
from airspark.session import checkpoint, get_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    only = set(sys.argv[2:])
    spark = get_session("local[4]")
    landed = checkpoint(observations(spark, sf_dir).drop("emax"), "plans-landed")
    fill = S.RAW_FEATURE_COLUMNS + [S.TARGET_COLUMN]
    positioned = checkpoint(add_positions(dedupe_keep_last(landed.drop("run", "forecast_run_timestamp"))),
                            "plans-positioned")
    plans = {
        "pushdown": landed.filter(F.col("city") == "click").select("city", "timestamp", "pm25"),
        "dedupe": dedupe_keep_last(landed.select("city", "timestamp", "ingestion_timestamp", "pm25")),
        "series": series_features(positioned, fill_cols=fill,
                                  clip_bounds={c: S.CLIP_BOUNDS[c] for c in fill}, rolls=ROLLS),
        "horizon": horizon_rows(landed.select("city", "timestamp", "pm25"), 72),
    }
    for name, df in plans.items():
        if only and name not in only:
            continue
        print(f"==================== {name} ====================")
        df.explain("formatted")


if __name__ == "__main__":
    main()
