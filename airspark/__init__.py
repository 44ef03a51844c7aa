"""airspark: hourly air-quality feature, training and forecast analytics on Spark.

Every transformation is a function ``DataFrame -> DataFrame`` built from
DataFrame / Spark SQL / Spark ML built-ins.  Wall-clock inputs are explicit
``as_of`` parameters, so every result is reproducible.
"""

__version__ = "0.1.0"
