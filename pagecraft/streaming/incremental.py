"""Incremental ingest: new targets only, each micro-batch appended, repeated urls dropped by state or by the table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pagecraft.operators.structural import difference
from pagecraft.sources.readers import existing


def new_targets(targets: DataFrame, seen: DataFrame) -> DataFrame:
    """Targets whose url the library does not have."""
    return difference(targets, seen)


def ingest(spark: SparkSession, stream: DataFrame, out: str, checkpoint: str, process: Callable[[DataFrame], DataFrame], until_done: bool = True, rebuild: Callable[[DataFrame], None] | None = None) -> StreamingQuery:
    """Run process over each micro-batch's urls that out does not have, append, and then rebuild what is made of the whole table. A batch that
    is run again after a failure finds its urls there already, so it adds nothing twice. until_done ends with what there is to read."""

    def batch(df: DataFrame, _: int) -> None:
        fresh = df.dropDuplicates(["url"])
        if existing(spark, [out]):
            fresh = new_targets(fresh, spark.read.parquet(out))
        process(fresh).write.mode("append").parquet(out)
        if rebuild is not None:
            rebuild(spark.read.parquet(out))

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if until_done else writer).start()
