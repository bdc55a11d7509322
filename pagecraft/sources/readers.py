"""Readers: target lists, scrape results, review files, event-stream bodies, and pixels."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TARGET = "url string, source string, vertical string, sub_vertical string, theme_name string, preset_name string, needs_password boolean"
PDP_TARGET = "url string, vertical string, sub_vertical string, brand string, note string"


PDP_RESULT = "url string, brand string, vertical string, sub_vertical string, success boolean, elements array<struct<type:string,present:string,details:string>>"
HEALTH = "url string, status string, finalUrl string, title string, hasShopifySections int, bodyHeight int"
REVIEW = (
    "composition struct<id:string,source:struct<url:string>,sections:array<struct<type:string>>>, "
    "vision_result struct<detected_sections:array<string>,detected_vibe:array<string>,detected_vertical:string,disagreements:array<struct<position:long,dom_said:string,vision_says:string>>>"
)


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths that exist in whatever store they name."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    out = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(conf).exists(p):
            out.append(path)
    return out


def targets(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All rows of the lists that exist, repeats included; none gives an empty table."""
    found = existing(spark, paths)
    return spark.read.schema(TARGET).json(found, multiLine=True) if found else spark.createDataFrame([], TARGET)


def pdp_targets(spark: SparkSession, path: str) -> DataFrame:
    """Product-page targets; a missing file or a broken row is an error."""
    return spark.read.schema(PDP_TARGET).option("mode", "FAILFAST").json(path, multiLine=True)


def pdp_results(spark: SparkSession, path: str) -> DataFrame:
    """Successful product-page results, one row for each element, with its place; present and details stay JSON text."""
    rows = spark.read.schema(PDP_RESULT).json(path, multiLine=True).where("success")
    return rows.select("url", "brand", "vertical", "sub_vertical", F.posexplode("elements").alias("pos", "e")).select("url", "brand", "vertical", "sub_vertical", "pos", F.col("e.type").alias("element"), "e.present", "e.details")


def url_health(spark: SparkSession, path: str) -> DataFrame:
    """Checked urls; a missing file is an error."""
    return spark.read.schema(HEALTH).json(path, multiLine=True)


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Flagged compositions of a review queue, one for each file; the schema is given, so files are read once."""
    return spark.read.schema(REVIEW).option("pathGlobFilter", "*_review.json").json(folder, multiLine=True)


def theme_demos(spark: SparkSession, themes: dict[str, list[str]]) -> DataFrame:
    """theme_name, preset, url: a table of themes and their demos, one row for each demo."""
    rows = spark.createDataFrame(list(themes.items()), "theme_name string, demos array<string>")
    return rows.select("theme_name", F.posexplode("demos").alias("preset", "url"))


#: Pictures are reduced to this width.
PIXEL_WIDTH = 100


def _decoded(data: bytes) -> np.ndarray:
    """height x width x 3 of a PNG with eight bits a channel, not interlaced; what follows red, green and blue is ignored."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, packed, width, height, channels = 8, b"", 0, 0, 0
    while at < len(data):
        size, kind = int.from_bytes(data[at : at + 4], "big"), data[at + 4 : at + 8]
        body = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            width, height = int.from_bytes(body[:4], "big"), int.from_bytes(body[4:8], "big")
            channels = {0: 1, 2: 3, 4: 2, 6: 4}.get(body[9], 0)
            if body[8] != 8 or body[12] or not channels:
                raise ValueError("PNG with another depth, a palette or interlacing")
        elif kind == b"IDAT":
            packed += body
        at += 12 + size
    rows = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(height, 1 + width * channels)
    out = np.zeros((height, width * channels), np.uint8)
    above = np.zeros(width * channels, np.uint8)
    for y in range(height):
        filter_, line = rows[y, 0], rows[y, 1:].reshape(width, channels)
        if filter_ in (0, 2):
            out[y] = rows[y, 1:] + (above if filter_ == 2 else np.uint8(0))
        elif filter_ == 1:
            out[y] = np.cumsum(line, axis=0, dtype=np.uint8).reshape(-1)
        else:
            now, up = np.zeros((width, channels), np.int64), above.reshape(width, channels).astype(np.int64)
            left = corner = np.zeros(channels, np.int64)
            for x in range(width):
                if filter_ == 3:
                    guess = (left + up[x]) // 2
                else:
                    far = np.abs(up[x] - corner), np.abs(left - corner), np.abs(left + up[x] - 2 * corner)
                    guess = np.where((far[0] <= far[1]) & (far[0] <= far[2]), left, np.where(far[1] <= far[2], up[x], corner))
                now[x] = (line[x] + guess) % 256
                left, corner = now[x], up[x]
            out[y] = now.reshape(-1)
        above = out[y]
    picture = out.reshape(height, width, channels)
    return picture[:, :, :3] if channels > 2 else np.repeat(picture[:, :, :1], 3, axis=2)


def pixels(spark: SparkSession, folder: str, width: int = PIXEL_WIDTH) -> DataFrame:
    """path, ord, r, g, b: the pixels of the PNG files of a folder, row by row, reduced to a width by the mean of what falls together."""

    def run(batches):
        for pdf in batches:
            for path, data in zip(pdf["path"], pdf["content"], strict=True):
                x = _decoded(data).astype(float)
                if x.shape[1] > width:
                    w, h = width, max(1, round(x.shape[0] * width / x.shape[1]))
                    for axis, n in ((1, w), (0, h)):
                        cuts = np.arange(n) * x.shape[axis] // n
                        sizes = np.diff(np.append(cuts, x.shape[axis]))
                        x = np.add.reduceat(x, cuts, axis=axis) / sizes.reshape((-1, 1) if axis == 1 else (-1, 1, 1))
                flat = np.floor(x.reshape(-1, 3) + 0.5).astype(int)
                yield pd.DataFrame({"path": path, "ord": range(len(flat)), "r": flat[:, 0], "g": flat[:, 1], "b": flat[:, 2]})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.png").load(folder).select("path", "content")
    return files.mapInPandas(run, "path string, ord long, r int, g int, b int")


def library(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}") for name in ("archetypes", "templates", "stats")}


def events(bodies: DataFrame) -> DataFrame:
    """url, pos, event (variant) of each data line of bodies (url, body) that parses."""
    lines = bodies.select("url", F.posexplode(F.split("body", "\n")).alias("pos", "line")).where(F.col("line").startswith("data: "))
    return lines.withColumn("event", F.try_parse_json(F.substring("line", 7, 1 << 30))).where(F.col("event").isNotNull()).drop("line")


def first_complete(bodies: DataFrame) -> DataFrame:
    """url, result (JSON text) of the first completed event with a result; a result that is text is parsed again."""
    get = lambda path: F.try_variant_get("event", path, "string")
    done = events(bodies).withColumns({"kind": get("$.type"), "status": get("$.status"), "result": get("$.resultJson")})
    done = done.where((F.col("kind") == "COMPLETE") & (F.col("status") == "COMPLETED") & (F.coalesce("result", F.lit("")) != ""))
    rank = F.row_number().over(Window.partitionBy("url").orderBy("pos"))
    return done.withColumn("rank", rank).where("rank = 1").select("url", F.to_json(F.try_parse_json("result")).alias("result"))
