"""Quality scores, tags, verticals and gates over nested sections (comp_id, n, s)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagecraft.functions import vocab
from pagecraft.functions.scalars import decayed, first_index, half_up, is_hero, rhythm, transitions


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda a, x: a + x)


def heuristic(mobile_share: Column | None = None, hero_first: Column | None = None) -> Column:
    """The layout score 0..100 of the columns n and s; the mobile view adds its share of sections and its hero."""
    s, n = F.col("s"), F.col("n")
    some = F.greatest(n, F.lit(1))
    kind = lambda test: (lambda x: test(x["type"]))
    hero = first_index(s, kind(is_hero))
    product = first_index(s, kind(lambda t: t.isin(*vocab.PRODUCT_TYPES)))
    trust = first_index(s, kind(lambda t: t == "trust_bar"))
    praise = first_index(s, kind(lambda t: t.contains("testimonial")))
    cta = F.size(F.filter(s, lambda x: x["type"].isin(*vocab.CTA_TYPES))) / some
    changes = transitions(rhythm(s))
    half = F.ceil(n / 2).cast("int")
    heights = F.transform(s, lambda x: F.coalesce(x["ratio"], F.lit(0.0)))
    share = F.round(F.try_divide(_sum(F.slice(heights, F.lit(1), half)), _sum(heights)), 9)
    parts = [
        F.when(n.between(5, 15), 10).when(n >= 3, 3).otherwise(-20),
        F.coalesce(F.try_divide(_sum(F.transform(s, lambda x: x["confidence"])), n), F.lit(0.0)) * 10,
        F.least(F.size(F.array_distinct(F.transform(s, lambda x: x["type"]))) / some * 10, F.lit(10.0)),
        F.when(hero.isin(0, 1), 10).when(hero == 2, 3).when(hero < 0, -10).otherwise(0),
        F.when((product >= 0) & (product <= half), 8).when(product >= 0, 2).otherwise(0),
        F.when((trust >= 0) & (trust < praise), 5).when(trust >= 0, 2).otherwise(0),
        F.when(cta.between(0.2, 0.5), 7).when(cta > 0, 3).otherwise(0),
        F.when(changes >= 2, 5).when(changes >= 1, 2).otherwise(0),
        F.when(n < 4, 0).when(share.between(0.35, 0.7), 10).when(share.between(0.25, 0.8), 5).otherwise(0),
    ]
    if mobile_share is not None:
        parts += [mobile_share * 10, F.when(hero_first, 3).otherwise(0)]
    total = F.lit(50.0)
    for p in parts:
        total = total + p
    return F.greatest(F.lit(0), F.least(F.lit(100), half_up(total))).cast("int")


def boosted(score: Column, boost: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(100), score + F.coalesce(boost, F.lit(0)))).cast("int")


def scored(nested: DataFrame) -> DataFrame:
    return nested.withColumns({"quality_score": heuristic(), "rhythm": rhythm(F.col("s"))})


def tags(s: Column, n: Column, dark_theme: Column, gold: Column, maroon: Column, saffron: Column) -> Column:
    """The layout's tags in their fixed order, without repeats."""
    hero = F.get(F.filter(s, lambda x: is_hero(x["type"])), F.lit(0))
    has = lambda t: F.exists(s, lambda x: x["type"] == t)
    share = F.try_divide(F.size(F.filter(s, lambda x: x["is_dark"])), n)
    # The tags in order.
    rules = [
        ("full-bleed-hero", hero["type"] == "hero_full_bleed"), ("split-hero", hero["type"] == "hero_split"), ("slideshow", hero["type"] == "hero_slideshow"),
        ("minimal-hero", hero["type"] == "hero_minimal"), ("dark-hero", hero["is_dark"]), ("tall-hero", hero["ratio"] > 0.8), ("marquee", has("marquee")),
        ("carousel", F.exists(s, lambda x: x["type"].contains("carousel") | x["carousel"])), ("video", has("video_section")), ("ugc", has("ugc_gallery")),
        ("lookbook", has("lookbook")), ("urgency", has("countdown_timer")), ("minimal", n <= 5), ("content-rich", n >= 10), ("dark-theme", dark_theme),
        ("gold-accent", gold), ("maroon", maroon), ("saffron", saffron), ("dark-sections", share > 0.3), ("editorial", F.exists(s, lambda x: x["ratio"] > 0.9)),
    ]
    return F.array_distinct(F.array_compact(F.array(*[F.when(test, F.lit(tag)) for tag, test in rules])))


def headings(s: Column) -> Column:
    return F.lower(F.array_join(F.transform(s, lambda x: F.coalesce(x["heading"], F.lit(""))), " "))


def vertical(text: Column, gold: Column, maroon: Column) -> Column:
    """The vertical that the palette or the headings tell, else general."""
    out = F.when(gold > 0.1, "jewellery").when(maroon > 0.1, "fashion")
    for name, words in vocab.VERTICAL_WORDS:
        out = out.when(F.rlike(text, F.lit(words)), name)
    return out.otherwise("general")


def with_effective(df: DataFrame, as_of: Column) -> DataFrame:
    return df.withColumn("effective_score", decayed(F.col("quality_score").cast("double"), F.col("crawled_at"), as_of))


def gated(df: DataFrame, as_of: Column, least: float = 50.0) -> DataFrame:
    return with_effective(df, as_of).where(F.col("effective_score") >= least)


def vision_wanted(rows: DataFrame, enabled: bool = True, above: int = 40) -> DataFrame:
    """Rows (quality_score, screenshot) that go to the vision check: it is on, the score is above, and there is a picture."""
    return rows.where(F.lit(enabled) & (F.col("quality_score") > above) & (F.coalesce(F.octet_length("screenshot"), F.lit(0)) > 0))


def vision(replies: DataFrame) -> DataFrame:
    """comp_id, agrees, vertical, disagreements, boost, flagged, seen, vibe, details of replies (comp_id, reply): fences are stripped, and
    what does not parse agrees without a boost. details: structs of position, dom_said, vision_says."""
    bare = F.trim(F.regexp_replace("reply", r"```json\s*|```\s*", ""))
    v = F.try_parse_json(bare)
    get = lambda path, kind: F.try_variant_get("v", path, kind)
    count = F.coalesce(F.size(F.try_variant_get("v", "$.disagreements", "array<variant>")), F.lit(0))
    agrees = F.coalesce(get("$.agrees", "boolean"), F.lit(False))
    broken = F.col("v").isNull()
    out = replies.withColumn("v", v).withColumns({"_n": F.greatest(count, F.lit(0)), "_agrees": agrees})
    texts = lambda path: F.coalesce(F.array_compact(get(path, "array<string>")), F.array().cast("array<string>"))
    part = lambda x, path, kind, default: F.coalesce(F.try_variant_get(x, path, kind), F.lit(default))
    each = F.transform(
        F.coalesce(get("$.disagreements", "array<variant>"), F.array().cast("array<variant>")),
        lambda x: F.struct(part(x, "$.position", "long", 0).alias("position"), part(x, "$.dom_said", "string", "").alias("dom_said"), part(x, "$.you_see", "string", "").alias("vision_says")),
    )
    return out.select(
        "comp_id",
        (broken | F.col("_agrees")).alias("agrees"),
        F.coalesce(F.when(~broken, get("$.vertical", "string")), F.lit("general")).alias("vertical"),
        F.when(broken, 0).otherwise(F.col("_n")).alias("disagreements"),
        F.when(broken, 0).when(F.col("_agrees"), 15).when(F.col("_n") <= 2, 5).otherwise(-15).alias("boost"),
        (~broken & ~F.col("_agrees") & (F.col("_n") > 2)).alias("flagged"),
        texts("$.sections_you_see").alias("seen"),
        texts("$.vibe").alias("vibe"),
        each.alias("details"),
    )


def with_vision(rows: DataFrame, replies: DataFrame) -> DataFrame:
    """rows (comp_id, vertical, tags, quality_score) after the vision check of those that have a reply: the score is boosted, a vertical
    other than general replaces the own one, and what the picture suggests joins the tags."""
    v = vision(replies).select("comp_id", F.col("vertical").alias("_vertical"), "boost", "flagged", "vibe")
    out = rows.join(v, "comp_id", "left")
    return out.withColumns(
        {
            "quality_score": boosted(F.col("quality_score"), F.col("boost")),
            "vertical": F.when(F.col("_vertical") != "general", F.col("_vertical")).otherwise(F.col("vertical")),
            "tags": F.array_distinct(F.concat("tags", F.coalesce("vibe", F.array().cast("array<string>")))),
            "flagged": F.coalesce("flagged", F.lit(False)),
        }
    ).drop("_vertical", "boost", "vibe")


def review_queue(rows: DataFrame, replies: DataFrame) -> DataFrame:
    """comp_id, url, dom_sections, seen, vibe, vertical, disagreements, lines of the flagged rows (comp_id, url, s)."""
    v = vision(replies).where("flagged")
    line = F.transform("details", lambda d: F.concat(F.lit("pos "), d["position"], F.lit(': DOM="'), d["dom_said"], F.lit('", picture="'), d["vision_says"], F.lit('"')))
    kinds = F.array_join(F.transform("s", lambda x: x["type"]), ", ")
    return rows.join(v, "comp_id").select("comp_id", "url", kinds.alias("dom_sections"), F.array_join("seen", ", ").alias("seen"), F.array_join("vibe", ", ").alias("vibe"), v["vertical"], "disagreements", F.array_join(line, "\n").alias("lines"))


def skipped(df: DataFrame) -> DataFrame:
    """comp_id, reason of rows (comp_id, iframe_builder, locked, n) that no further step takes."""
    reason = F.when(F.col("iframe_builder").isNotNull(), F.concat(F.lit("iframe_page_builder:"), "iframe_builder"))
    reason = reason.when(F.col("locked"), "password_locked").when(F.col("n") < 2, F.concat(F.lit("too_few_sections:"), F.col("n")))
    return df.withColumn("reason", reason).where(F.col("reason").isNotNull()).select("comp_id", "reason")


def skipped_by_builder(df: DataFrame) -> DataFrame:
    """builder, n of rows (iframe_builder) that were skipped; those without a builder are other."""
    return df.groupBy(F.coalesce("iframe_builder", F.lit("other")).alias("builder")).agg(F.count("*").alias("n"))
