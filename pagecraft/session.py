"""A session with the settings the engine expects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: The size to which the JVM compiles a method. Wider expressions than that then run as several methods, not as one that is interpreted.
METHOD_BYTES = 8000


def session(master: str | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew joins; anything else, and the master on a cluster, is the caller's."""
    builder = SparkSession.builder.appName("pagecraft")
    if master:
        builder = builder.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.codegen.hugeMethodLimit": str(METHOD_BYTES),
    }
    return builder.config(map=base | conf).getOrCreate()


def small_methods(df: DataFrame) -> DataFrame:
    """df, with the session's generated methods bounded to what the JVM compiles, whoever made the session."""
    conf = df.sparkSession.conf
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(conf.get(name)) > METHOD_BYTES:
        conf.set(name, str(METHOD_BYTES))
    return df
