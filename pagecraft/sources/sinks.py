"""Sinks: the library, skipped rows, matrices, the review queue, and cleaned source lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagecraft.functions.scalars import base64_of
from pagecraft.operators.structural import file_name


def write_library(tables: dict[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def write_skipped(df: DataFrame, path: str, append: bool = False) -> bool:
    """Write if there are rows; an incremental run appends to what is there."""
    if df.isEmpty():
        return False
    df.write.mode("append" if append else "overwrite").parquet(path)
    return True


def write_all_and_success(df: DataFrame, folder: str) -> None:
    """All rows, and of what was written the successful ones: the plan runs once."""
    df.write.mode("overwrite").parquet(f"{folder}/all")
    df.sparkSession.read.schema(df.schema).parquet(f"{folder}/all").where("success").write.mode("overwrite").parquet(f"{folder}/success")


def write_pdp_matrix(matrix: DataFrame, must_have: DataFrame, folder: str) -> None:
    """The matrix and each vertical's must-have and expected elements."""
    matrix.write.mode("overwrite").parquet(f"{folder}/matrix")
    must_have.write.mode("overwrite").parquet(f"{folder}/must_have")


def write_named(df: DataFrame, folder: str) -> None:
    """One folder of JSON for each store, by the file name of its url."""
    df.withColumn("name", file_name(F.col("url"))).write.mode("overwrite").partitionBy("name").json(folder)


def write_review_queue(df: DataFrame, path: str) -> None:
    """One folder for each composition; a screenshot goes along as base64 text."""
    if "screenshot" in df.columns:
        df = df.withColumn("screenshot", base64_of(F.col("screenshot")))
    df.write.mode("overwrite").partitionBy("comp_id").json(path)


def write_matrix(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_targets(df: DataFrame, path: str, version: str) -> None:
    """A cleaned list goes to a new version; what was read stays."""
    df.write.mode("errorifexists").json(f"{path}/version={version}")
