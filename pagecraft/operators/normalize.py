"""Raw extractions to normalised compositions: sections with content hints, palette and font roles, tags, vertical and id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagecraft.operators import quality, sections


def composition_id(url: Column, now: Column) -> Column:
    """A short name of an extraction. 32 bits: rows are told apart by url."""
    millis = F.floor(F.unix_micros(now.cast("timestamp")) / F.lit(1000))
    return F.concat(F.lit("comp_"), F.substring(F.sha2(F.concat(url, millis.cast("string")), 256), 1, 8))


def first_of_type(raw: DataFrame) -> DataFrame:
    """Each composition's first section of each type."""
    own = Window.partitionBy("comp_id", "type").orderBy("pos")
    return raw.withColumn("_n", F.row_number().over(own)).where("_n = 1").drop("_n")


def with_raw(rows: DataFrame, desktop: DataFrame, mobile: DataFrame) -> DataFrame:
    """rows (comp_id, type, ...) with raw, a struct of the first mobile section of their type, else of the first desktop one, else null.
    That is not always the section which the row was made of."""
    facts = F.struct("heading", "images", "carousel", "cols", "ratio", "background")
    m = first_of_type(mobile).select("comp_id", "type", facts.alias("_m"))
    d = first_of_type(desktop).select("comp_id", "type", facts.alias("_d"))
    out = rows.join(m, ["comp_id", "type"], "left").join(d, ["comp_id", "type"], "left")
    return out.withColumn("raw", F.coalesce("_m", "_d")).drop("_m", "_d")


def hints(raw: Column) -> Column:
    """heading, product_count (more than three images only), has_carousel and grid_columns of a raw section."""
    return F.struct(
        F.nullif(raw["heading"], F.lit("")).alias("heading"), F.when(raw["images"] > 3, raw["images"]).alias("product_count"),
        F.coalesce(raw["carousel"], F.lit(False)).alias("has_carousel"), F.coalesce(raw["cols"], F.lit(1)).alias("grid_columns"),
    )


def normalized_sections(desktop: DataFrame, mobile: DataFrame) -> DataFrame:
    """comp_id, pos, type, variant, confidence, is_dark, height_ratio, content_hints: the reconciled sections that are known and sure, or the
    desktop ones of a composition that has no reconciled section."""
    rec = sections.reconciled(desktop, mobile)
    ratio = F.when(F.col("ratio_mobile") != 0, F.col("ratio_mobile")).otherwise(F.col("ratio_desktop"))
    rows = sections.confident(with_raw(rec.select("comp_id", "pos", "type", "confidence", "is_dark", ratio.alias("height_ratio")), desktop, mobile))
    raw = F.col("raw")
    variant = sections.variant(F.col("type"), raw["cols"], raw["images"], raw["carousel"], raw["ratio"] >= 0.95, raw["background"])
    return rows.select("comp_id", "pos", "type", F.when(raw.isNotNull(), variant).alias("variant"), "confidence", "is_dark", "height_ratio", hints(raw).alias("content_hints"))


def normalized(targets: DataFrame, desktop: DataFrame, mobile: DataFrame, palettes: DataFrame, fonts: DataFrame, now: Column) -> DataFrame:
    """One row for each target with sections. targets: comp_id, url, source_type, vertical, sub_vertical, crawled_at. palettes: comp_id, the
    roles, is_dark_theme, has_<tone> and the proportions gold and maroon. fonts: comp_id, heading_font, body_font, pairing_id."""
    rows = normalized_sections(desktop, mobile)
    h = F.col("content_hints")
    flat = rows.select(
        "comp_id", "pos", "type", "confidence", "is_dark", F.col("height_ratio").alias("ratio"), h["grid_columns"].alias("cols"), h["has_carousel"].alias("carousel"),
        F.coalesce(h["product_count"], F.lit(0)).alias("images"), h["heading"].alias("heading"), "variant",
    )
    s = F.array_sort(F.collect_list(F.struct("pos", *sections.FIELDS, "variant")))
    out = targets.join(flat.groupBy("comp_id").agg(s.alias("s")), "comp_id").join(palettes, "comp_id", "left").join(fonts, "comp_id", "left")
    out = out.withColumns({"n": F.size("s"), "is_dark_theme": F.coalesce("is_dark_theme", F.lit(False))} | {c: F.coalesce(c, F.lit(False)) for c in ("has_gold", "has_maroon", "has_saffron")})
    tags = quality.tags(F.col("s"), F.col("n"), F.col("is_dark_theme"), F.col("has_gold"), F.col("has_maroon"), F.col("has_saffron"))
    inferred = quality.vertical(quality.headings(F.col("s")), F.coalesce("gold", F.lit(0.0)), F.coalesce("maroon", F.lit(0.0)))
    vertical = F.coalesce(F.nullif(F.col("vertical"), F.lit("")), inferred)
    return out.withColumns({"tags": tags, "vertical": vertical, "id": composition_id(F.col("url"), now), "rhythm": quality.rhythm(F.col("s")), "quality_score": quality.heuristic()})
