"""Palettes: weights by area and depth, top colours, tones, roles, and k-means on pixels."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagecraft.functions import vocab
from pagecraft.functions.scalars import TONES, gap, hsl_of, parsed, rgb_number, shifted, split_number, to_hex


def with_channels(rows: DataFrame) -> DataFrame:
    """rows with rgb, the number of hex, and r, g, b as columns, so that expressions on them parse it once."""
    rows = rows if "rgb" in rows.columns else rows.withColumn("rgb", rgb_number(F.col("hex")))
    return rows.withColumns(dict(zip(("r", "g", "b"), split_number(F.col("rgb")), strict=True)))


def visual_weight(area: Column, depth: Column, *rgb: Column) -> Column:
    _, s, light = hsl_of(*rgb)
    return area * F.when(depth < 5, 1.0).when(depth < 10, 0.5).otherwise(0.2) * (1 + s - F.abs(0.5 - light))


#: Elements with a shorter side than this are not painted.
LEAST_SIDE = 10


def painted(elements: DataFrame) -> DataFrame:
    """Elements (w, h, hex) with a background and sides of at least LEAST_SIDE pixels, with their area."""
    return elements.where(F.col("hex").isNotNull() & (F.col("w") >= LEAST_SIDE) & (F.col("h") >= LEAST_SIDE)).withColumn("area", F.col("w") * F.col("h"))


def top_colours(elements: DataFrame, k: int = 15) -> DataFrame:
    """comp_id, hex, rgb, rank, proportion: each composition's k heaviest colours, as shares of all its weight; ties by hex."""
    weight = visual_weight(F.col("area"), F.col("depth"), F.col("r"), F.col("g"), F.col("b"))
    sums = with_channels(elements).groupBy("comp_id", "hex", "rgb").agg(F.sum(weight).alias("w"))
    own = Window.partitionBy("comp_id")
    share = F.coalesce(F.try_divide(F.col("w"), F.sum("w").over(own)), F.lit(0.0))
    ranked = sums.withColumns({"proportion": share, "rank": F.row_number().over(own.orderBy(F.round("w", 6).desc(), "hex"))})
    return ranked.where(F.col("rank") <= k).select("comp_id", "hex", "rgb", "rank", "proportion")


def frequencies(elements: DataFrame, weight: Column, k: int) -> DataFrame:
    """comp_id, hex, rank, frequency: the k most frequent colours, pure black and white apart where the caller dropped them."""
    sums = elements.groupBy("comp_id", "hex").agg(F.sum(weight).alias("frequency"))
    rank = F.row_number().over(Window.partitionBy("comp_id").orderBy(F.col("frequency").desc(), "hex"))
    return sums.withColumn("rank", rank).where(F.col("rank") <= k)


def accents(elements: DataFrame, k: int = 5) -> DataFrame:
    """Backgrounds weigh 1 and borders 0.5; elements have hex and border."""
    both = elements.select("comp_id", "hex", F.lit(1.0).alias("w")).unionByName(elements.select("comp_id", F.col("border").alias("hex"), F.lit(0.5).alias("w")))
    return frequencies(both.where(~F.col("hex").isin("#000000", "#ffffff")), F.col("w"), k)


# The share above which a tone counts as present.
TONE_LEAST = {"gold": 0.03, "maroon": 0.05, "saffron": 0.03, "green": 0.03}


def signals(top: DataFrame) -> DataFrame:
    """comp_id with has_<tone> and <tone>_proportion over its top colours."""
    aggs = []
    for name, least in TONE_LEAST.items():
        hit = TONES[name](F.col("r"), F.col("g"), F.col("b"))
        aggs += [F.bool_or(hit & (F.col("proportion") > least)).alias(f"has_{name}"), F.sum(F.when(hit, F.col("proportion")).otherwise(0.0)).alias(f"{name}_proportion")]
    return with_channels(top).groupBy("comp_id").agg(*aggs)


def _first(arr: Column, test) -> Column:
    return F.get(F.filter(arr, test), F.lit(0))["hex"]


def _most_saturated(arr: Column) -> Column:
    """struct(s, i, hex): minus the saturation, place and hex of the first of the most saturated."""
    return F.array_min(F.transform(arr, lambda x, i: F.struct((-F.round(x["sat"], 9)).alias("s"), i.alias("i"), x["hex"].alias("hex"))))


def _parsed(arr: Column) -> Column:
    return F.transform(arr, parsed)


def roles(palettes: DataFrame) -> DataFrame:
    """palettes with background, surface, text, accent and dark colours, and colour_roles of the first eight colours.

    palettes: comp_id, colours (hexes, heaviest first), texts, accents (hexes, most frequent first), dark_perceived (or null). Each hex is
    parsed once, into a struct of its numbers, before anything compares it."""
    dark = lambda x: x["luma"] < 128
    p = palettes.withColumns({"_c": _parsed(F.col("colours")), "_t": _parsed(F.col("texts")), "_a": _parsed(F.col("accents"))})
    c, t = F.col("_c"), F.col("_t")
    first = F.get(c, F.lit(0))
    p = p.withColumns({"is_dark_theme": F.coalesce("dark_perceived", F.coalesce(dark(first), F.lit(False))), "background": F.coalesce(first["hex"], F.lit(vocab.DEFAULT_BACKGROUND))})
    theme = F.col("is_dark_theme")
    text = F.coalesce(F.get("texts", F.lit(0)), F.when(theme, "#FFFFFF").otherwise("#1A1A1A"))
    p = p.withColumns({"_bg": parsed(F.col("background")), "text_primary": text}).withColumn("_main", parsed(F.col("text_primary")))
    bg, main = F.col("_bg"), F.col("_main")
    rest = F.slice(c, F.lit(2), F.greatest(F.size(c), F.lit(1)))
    near = _first(rest, lambda x: (F.abs(x["luma"] - bg["luma"]) / F.lit(255.0) < 0.3) & (gap(x, bg) > 20))
    best = _most_saturated(F.filter(c, lambda x: (x["hex"] != bg["hex"]) & (gap(x, bg) > 40)))
    p = p.withColumns(
        {
            "_near": near,
            "_other": _first(t, lambda x: gap(x, main) > 30),
            "_best": best,
            "_vivid": _most_saturated(F.col("_a"))["hex"],
            "_dark": _first(c, lambda x: dark(x) & (x["hex"] != bg["hex"])),
        }
    )
    b, m = F.col("background"), F.col("text_primary")
    p = p.withColumns(
        {
            "surface": F.coalesce("_near", F.when(theme, shifted(b, 0.05)).otherwise(shifted(b, -0.05))),
            "text_secondary": F.coalesce("_other", F.when(theme, shifted(m, -0.2)).otherwise(shifted(m, 0.2))),
            "accent": F.when(F.size("accents") > 0, F.col("_vivid")).when(-F.col("_best.s") > 0.2, F.col("_best.hex")).otherwise(vocab.DEFAULT_ACCENT),
            "dark_bg": F.coalesce("_dark", F.when(theme, "#000000").otherwise("#1A1A1A")),
        }
    )
    # The roles in order; the first that a colour equals is its own.
    named = {"background": "background", "surface": "surface", "accent": "accent", "text_primary": "text", "dark_bg": "dark_sections"}

    def role(x: Column) -> Column:
        out = None
        for column, name in named.items():
            hit = x["hex"] == F.col(column)
            out = F.when(hit, name) if out is None else out.when(hit, name)
        return out.when(dark(x), "dark_element").otherwise("decorative")

    return p.withColumn("colour_roles", F.transform(F.slice(c, 1, 8), role)).drop("_c", "_t", "_a", "_bg", "_main", "_near", "_other", "_best", "_vivid", "_dark")


def kmeans(pixels: DataFrame, k: int = 8, steps: int = 20) -> DataFrame:
    """img_id, cluster, r, g, b, n, proportion of pixels (img_id, ord, r, g, b): evenly spaced pixels as seeds, the lowest index on
    ties, empty clusters kept, until nothing moves. One image is one group; its size is bounded by the sampling ahead."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values("ord")[["r", "g", "b"]].to_numpy(float)
        centre, label = x[np.minimum(np.arange(k) * max(1, len(x) // k), len(x) - 1)].copy(), np.zeros(len(x), np.int64)
        for _ in range(steps):
            new = ((x[:, None, :] - centre[None]) ** 2).sum(axis=2).argmin(axis=1)
            if (new == label).all():
                break
            label = new
            n = np.bincount(label, minlength=k)
            sums = np.stack([np.bincount(label, x[:, i], k) for i in range(3)], axis=1)
            centre = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centre)
        n = np.bincount(label, minlength=k)
        order = np.argsort(-n, kind="stable")
        out = pd.DataFrame(np.floor(centre[order] + 0.5).astype(int), columns=["r", "g", "b"])
        return out.assign(img_id=pdf["img_id"].iloc[0], cluster=range(k), n=n[order], proportion=n[order] / len(x))[["img_id", "cluster", "r", "g", "b", "n", "proportion"]]

    return pixels.groupBy("img_id").applyInPandas(run, "img_id long, cluster int, r int, g int, b int, n long, proportion double")


def perceived(clusters: DataFrame) -> DataFrame:
    """img_id, colours (structs of hex, proportion, r, g, b, most frequent first) and is_dark_perceived, the darkness of the first, of
    kmeans() rows."""
    r, g, b = F.col("r"), F.col("g"), F.col("b")
    rows = clusters.groupBy("img_id").agg(F.array_sort(F.collect_list(F.struct("cluster", to_hex(r, g, b).alias("hex"), "proportion", "r", "g", "b"))).alias("_c"))
    first = F.get("_c", F.lit(0))
    luma = first["r"] * 0.299 + first["g"] * 0.587 + first["b"] * 0.114
    return rows.select("img_id", F.transform("_c", lambda c: c.dropFields("cluster")).alias("colours"), F.coalesce(luma < 128, F.lit(False)).alias("is_dark_perceived"))


#: The share above which a perceived colour counts, and what is left of a gold that is not perceived.
PERCEIVED_LEAST, UNSEEN_GOLD = 0.02, 0.3


def checked_gold(rows: DataFrame) -> DataFrame:
    """rows (has_gold, gold_proportion, perceived: structs of r, g, b, proportion, or null) with gold taken back where the page claims it and
    the perceived colours do not show it."""
    seen = F.exists("perceived", lambda c: TONES["gold"](c["r"], c["g"], c["b"]) & (c["proportion"] > PERCEIVED_LEAST))
    unseen = F.col("perceived").isNotNull() & F.col("has_gold") & ~F.coalesce(seen, F.lit(False))
    return rows.withColumns({"gold_proportion": F.when(unseen, F.col("gold_proportion") * UNSEEN_GOLD).otherwise(F.col("gold_proportion")), "has_gold": F.col("has_gold") & ~unseen})
