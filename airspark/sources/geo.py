"""Geocode candidate resolution and city slugs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def city_slug(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.replace(F.lower(c), F.lit(" "), F.lit("_"))


def geo_resolve(requests: DataFrame, candidates: DataFrame, request_key: str = "request_id") -> DataFrame:
    """Pick one candidate per request.

    A candidate matches when name, country and, if the candidates have that
    column, ``admin1`` equal the request's (case-insensitive; a missing value
    matches nothing).  The first match in candidate order wins; with none, the
    first candidate.  Coordinates configured on the request win over both, if
    both are set and not 0.  A request with neither is an error.  Written
    as a grouped ``min_by`` so a request with very many candidates is
    combined map-side rather than ranked in one task.
    """
    j = candidates.join(requests.select(request_key, F.col("name").alias("_rname"),
                                        F.col("country").alias("_rcountry"),
                                        F.col("admin1").alias("_radmin1")), request_key)
    match = (F.lower("name") == F.lower("_rname")) & (F.lower("country") == F.lower("_rcountry"))
    if "admin1" in candidates.columns:
        match = match & (F.lower("admin1") == F.lower("_radmin1"))
    match = F.coalesce(match, F.lit(False))
    ordering = F.struct(F.when(match, 0).otherwise(1).alias("m"), F.col("position"))
    best = j.groupBy(request_key).agg(F.min_by(F.struct(F.col("latitude"), F.col("longitude"),
                                                        match.alias("matched")), ordering).alias("_b"))
    out = requests.join(best, request_key, "left")
    own = F.coalesce((F.col("latitude") != 0) & (F.col("longitude") != 0), F.lit(False))
    if not out.filter(~own & F.col("_b").isNull()).isEmpty():
        raise ValueError("No location found for a request.")
    return out.select(
        request_key, "name", "country", city_slug("name").alias("city"),
        F.when(own, F.col("latitude")).otherwise(F.col("_b.latitude")).alias("latitude"),
        F.when(own, F.col("longitude")).otherwise(F.col("_b.longitude")).alias("longitude"),
        F.coalesce(F.col("_b.matched"), F.lit(False)).alias("matched"))
