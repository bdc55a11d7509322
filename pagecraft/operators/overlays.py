"""Rendered elements: overlays, popups, visibility, page builders in frames, and the choice of section elements."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagecraft.functions.scalars import half_up

# Parts of class names, of ids, and attributes that overlays carry; and those of backdrops.
CLASS_PARTS = (
    "popup", "modal", "overlay", "klaviyo", "privy", "omnisend", "justuno", "wheelio", "spin-wheel", "cookie", "consent", "gdpr", "newsletter-popup", "exit-intent",
    "notification-bar", "announcement-popup",
)
ID_PARTS = ("popup", "modal", "overlay", "klaviyo", "cookie", "consent")
ATTRIBUTES = ("data-popup", "data-modal")
BACKDROP_PARTS = ("backdrop", "underlay")
POPUP_ID_PARTS = ("popup", "modal", "overlay")
POPUP_CLASS_PARTS = ("popup", "modal", "overlay", "klaviyo", "privy", "omnisend")
# Page builders in the order in which they are looked for, with the part that tells each by frame source or class.
BUILDERS = (("maker", "maker.co", "maker"), ("shogun", "shogun", "shogun"), ("gempages", "gempages", "gempages"), ("pagefly", "pagefly", "pagefly"), ("zipify", "zipify", "zipify"), ("replo", "replo", "replo"))


def _holds(text: Column, parts: tuple[str, ...]) -> Column:
    return F.rlike(F.coalesce(text, F.lit("")), F.lit("|".join(parts)))


def _share() -> Column:
    """The element's part of the viewport."""
    return F.col("w") * F.col("h") / (F.col("vp_w") * F.col("vp_h"))


def overlay_reason() -> Column:
    """Why an element (class, id, attributes, z, position, w, h, y, vp_w, vp_h) is taken for an overlay: its name, its size, a bar low in
    the viewport, or a backdrop; null if it is none. Names are compared as they are written."""
    named = _holds(F.col("class"), CLASS_PARTS) | _holds(F.col("id"), ID_PARTS) | F.arrays_overlap("attributes", F.array(*[F.lit(a) for a in ATTRIBUTES]))
    above = (F.col("z") > 100) & (F.col("position") != "static")
    bar = above & (F.col("position") == "fixed") & (F.col("h") < 200) & (F.col("y") > F.col("vp_h") * 0.7)
    return F.when(named, "name").when(above & (_share() > 0.3), "size").when(bar, "bar").when(_holds(F.col("class"), BACKDROP_PARTS), "backdrop")


def without_overlays(elements: DataFrame) -> DataFrame:
    return elements.where(overlay_reason().isNull())


def shown() -> Column:
    return ~((F.col("display") == "none") | (F.col("visibility") == "hidden") | (F.col("opacity") == 0) | (F.col("h") < 10))


def popup() -> Column:
    """High above the page, out of its flow, and either large or named as a popup."""
    named = _holds(F.lower("id"), POPUP_ID_PARTS) | _holds(F.lower("class"), POPUP_CLASS_PARTS)
    return (F.col("z") > 100) & F.col("position").isin("fixed", "absolute") & ((_share() > 0.5) | named)


def frame_builders(sections: DataFrame) -> DataFrame:
    """page, builder, iframe_src, section_id, section_height of each page's first section at least twice as high as the viewport that
    holds a frame. sections: page, pos, id, class, h, vp_h, iframe_src (null without a frame)."""
    src, cls = F.lower("iframe_src"), F.lower(F.coalesce("class", F.lit("")))
    builder = reduce(lambda out, b: out.when(src.contains(b[1]) | cls.contains(b[2]), b[0]), BUILDERS[1:], F.when(src.contains(BUILDERS[0][1]) | cls.contains(BUILDERS[0][2]), BUILDERS[0][0]))
    tall = sections.where((F.col("h") >= F.col("vp_h") * 2) & F.col("iframe_src").isNotNull())
    first = tall.withColumn("_n", F.row_number().over(Window.partitionBy("page").orderBy("pos"))).where("_n = 1")
    return first.select("page", builder.otherwise("unknown").alias("builder"), F.substring(src, 1, 200).alias("iframe_src"), F.col("id").alias("section_id"), half_up(F.col("h")).alias("section_height"))


def section_roots(children: DataFrame) -> DataFrame:
    """The elements that stand for a page's sections, numbered anew: those marked as sections, or if a page has none, the visible
    children that are higher than 50 pixels and wider than half the viewport. children: page, pos, marked, display, visibility, w, h, vp_w."""
    any_marked = F.max(F.col("marked").cast("int")).over(Window.partitionBy("page")) == 1
    large = (F.col("display") != "none") & (F.col("visibility") != "hidden") & (F.col("h") > 50) & (F.col("w") > F.col("vp_w") * 0.5)
    kept = children.withColumn("method", F.when(any_marked, "shopify").otherwise("heuristic")).where(F.when(F.col("method") == "shopify", F.col("marked")).otherwise(large))
    return kept.withColumn("index", F.row_number().over(Window.partitionBy("page").orderBy("pos")) - 1)


def innermost(candidates: DataFrame) -> DataFrame:
    """Candidates (page, path, ...) that hold no other candidate of their page; all of them where fewer than two would be left.
    path: the steps from the page's root, joined by slashes. Only the ancestors of candidates are compared."""
    steps = F.split("path", "/")
    ancestors = F.transform(F.sequence(F.lit(1), F.size(steps) - 1), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/"))
    above = candidates.where(F.size(steps) > 1).select("page", F.explode(ancestors).alias("path")).distinct()
    inner = candidates.join(above.withColumn("_holds", F.lit(True)), ["page", "path"], "left").withColumn("_free", F.col("_holds").isNull())
    free = F.count_if("_free").over(Window.partitionBy("page"))
    return inner.withColumn("_n", free).where("_free OR _n < 2").drop("_holds", "_free", "_n")


# The custom properties that a palette takes from the page's style.
PROPERTIES = ("--color-primary", "--color-secondary", "--color-accent", "--color-background", "--color-foreground", "--color-base", "--primary", "--secondary", "--accent")


def custom_properties(styles: Column) -> Column:
    """A map of styles cut to the known colour properties that are not blank, trimmed."""
    trimmed = F.transform_values(styles, lambda _, v: F.trim(v))
    return F.map_filter(trimmed, lambda k, v: k.isin(*PROPERTIES) & (F.coalesce(v, F.lit("")) != ""))
