"""Sections: thresholds and numbering, classification, variants, types from ids, and the two viewports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagecraft.functions import vocab
from pagecraft.session import small_methods

FIELDS = ("type", "confidence", "is_dark", "ratio", "cols", "carousel", "images", "heading")

# Each type's points by condition, in the order that decides ties. Conditions are SQL that holds in any dialect but
# for {re:...}, a pattern found anywhere in the lower-cased text.
HERO = (
    ("si <= 1", 30), ("si IN (2, 3)", 10), ("si > 3", -20), ("h > vh * 0.5", 25), ("h > vh * 0.3 AND h <= vh * 0.5", 15), ("h > 300", 10),
    ("btn BETWEEN 1 AND 3", 15), ("btn > 3", 5), ("hd > 0", 10), ("h < 200", -40),
)
PRICE = r"₹|rs\.|inr|\$|price|add to cart|buy now"
POINTS: tuple[tuple[str, tuple[tuple[str, int], ...]], ...] = (
    ("announcement_bar", (("h < 80", 30), ("si = 0", 25), ("si = 1", 10), ("len < 200 AND len > 5", 20), ("inhead", 20), ("hd > 0", -15))),
    ("hero_full_bleed", (*HERO, ("bgimg OR fit", 15), ("gc > 2", -10))),
    ("hero_split", (*HERO, ("gc = 2", 20), ("img = 0", -15))),
    ("hero_slideshow", (*HERO, ("hc", 25))),
    ("hero_bento", (*HERO, ("img >= 3", 15), ("gc >= 2", 10))),
    ("hero_minimal", (*HERO, ("NOT bgimg", 5), ("len > 100", 5), ("img > 2", -10))),
    ("marquee", (("anim", 40), ("h < 100", 25), ("h >= 100 AND h < 150", 10), ("h >= 150", -20), ("len < 300", 10))),
    ("trust_bar", (("small >= 3", 30), ("small = 2", 15), ("h < 200", 20), ("len < 500", 15), ("{re:free.?ship|deliver|return|secure|payment|guarantee|cod}", 20))),
    ("logo_bar", (("img BETWEEN 3 AND 10", 20), ("imgw > 30 AND imgw < 150", 25), ("h < 150", 15), ("{re:featured|seen|press|trusted|mentioned|partner|as seen}", 25))),
    ("featured_products", (("pc >= 3", 25), ("pc = 2", 10), ("gc >= 2", 15), (f"{{re:{PRICE}}}", 20), ("NOT hc", 10), ("pc < 2", -30))),
    ("product_carousel", (("pc >= 3", 20), ("hc", 30), (f"{{re:{PRICE}}}", 20))),
    ("category_grid", (("cl >= 2", 25), ("img >= 2", 15), ("gc >= 2", 15), ("{re:shop by|categor|collection}", 15))),
    ("category_pills", (("cl >= 3", 20), ("h < 200", 20), ("gc >= 3", 15), ("{re:shop by|browse|categor}", 10))),
    ("collection_banner", (("h > 200 AND h < vh * 0.6", 20), ("bgimg OR dark", 25), ("btn BETWEEN 1 AND 2", 15), ("hd BETWEEN 1 AND 2", 10), ("si > 2", 10), ("si <= 2", -5))),
    ("testimonial_cards", ((r"{re:review|testimonial|customer|★|⭐|rating|said|loved}", 35), ("hc", 15), ("pc >= 2", 10), (r"quote OR {re:[\x22“].*[\x22”]}", 15))),
    ("stats_bar", ((r"{re:\d+[,.]?\d*\s*\+?\s*(customer|order|cities|store|review|rating|happy|product)}", 40), ("h < 200", 20), ("hd <= 4", 10))),
    ("ugc_gallery", (("{re:instagram|#|ugc|gallery|community|tagged|real customer}", 30), ("ugc", 25), ("img >= 4", 15))),
    ("image_with_text", (("gc = 2", 20), ("img BETWEEN 1 AND 2", 15), ("len > 100", 15), ("hd >= 1", 10), ("img > 3", -20))),
    ("about_brand", ((r"{re:about|our story|founded|mission|heritage|journey|since \d{4}|crafted|handmade}", 35), ("hd >= 1", 15), ("len > 200", 10))),
    ("video_section", (("video", 50), ("h > 200", 10))),
    ("quote_block", (("quote", 35), (r"{re:^[\x22“].*[\x22”]$}", 25), ("len < 500", 10))),
    ("newsletter", (("mail", 40), ("{re:subscribe|newsletter|email.*updates|stay.*touch|join.*list|whatsapp}", 25), ("h < 400", 10))),
    ("countdown_timer", ((r"{re:days?\s*:\s*hours?|countdown|ends in|hurry|limited}", 40), (r"{re:\d+\s*:\s*\d+}", 20))),
    ("rich_text", (("len > 200 AND img = 0", 25), ("hd >= 1", 10), ("TRUE", -10))),
    ("lookbook", (("img >= 4", 20), ("len < 100", 15), ("look", 25))),
)
LEAST_POINTS = 25


def _pieces(condition: str) -> list[str]:
    """A condition cut at its patterns: text, pattern, text, pattern, ..., text."""
    out, at = [], 0
    while (a := condition.find("{re:", at)) >= 0:
        depth, b = 1, a + 4
        while True:
            depth += {"{": 1, "}": -1}.get(condition[b], 0)
            if not depth:
                break
            b += 1
        out += [condition[at:a], condition[a + 4 : b]]
        at = b + 1
    return [*out, condition[at:]]


def points_sql(rules: tuple[tuple[str, int], ...], found) -> str:
    """The sum of a type's points as SQL. found(pattern) is the SQL that tells whether a pattern occurs in the text."""
    parts = lambda c: "".join(found(x) if i % 2 else x for i, x in enumerate(_pieces(c)))
    return " + ".join(f"CASE WHEN {parts(condition)} THEN {points} ELSE 0 END" for condition, points in rules)


def _alternatives(pattern: str) -> list[str]:
    """A pattern cut at its outermost bars."""
    out, depth, at = [""], 0, 0
    while at < len(pattern):
        c = pattern[at : at + 2] if pattern[at] == "\\" else pattern[at]
        depth += {"(": 1, "[": 1, ")": -1, "]": -1}.get(c, 0)
        if c == "|" and not depth:
            out.append("")
        else:
            out[-1] += c
        at += len(c)
    return out


def _words(alternative: str) -> tuple[list[str], bool]:
    """Words that whatever an alternative matches has in it, and whether the alternative is just one such word."""
    out, depth, at, plain = [""], 0, 0, True
    while at < len(alternative):
        c = alternative[at : at + 2] if alternative[at] == "\\" else alternative[at]
        at += len(c)
        literal = c[-1] if len(c) == 1 or not c[1].isalnum() else ""
        if len(c) == 1 and c in "()[]":
            depth += 1 if c in "([" else -1
            literal = ""
        elif len(c) == 1 and c in ".^$?*+{":
            if c in "?*{":
                out[-1] = out[-1][:-1]
            if c == "{":
                at = alternative.index("}", at) + 1
            literal = ""
        if literal and not depth:
            out[-1] += literal
        else:
            plain = False
            out.append("")
    return [w for w in out if w], plain


def occurs(text: Column, pattern: str) -> Column:
    """Whether a pattern is found anywhere in a text. Its plain words are looked for as such, and the rest only where the words that it
    needs occur, as a search for one word takes far less time than a pattern."""
    tests = []
    for alternative in _alternatives(pattern):
        words, plain = _words(alternative)
        needed = [text.contains(w) for w in words]
        tests.append(reduce(lambda a, b: a & b, needed if plain else [*needed, F.rlike(text, F.lit(alternative))]))
    return reduce(lambda a, b: a | b, tests)


def classified(features: DataFrame) -> DataFrame:
    """features with type and confidence: the most points win, the first declared on ties, under LEAST_POINTS none does. What several
    types ask (patterns, the points of any hero) is a column of its own before the points are added up."""
    patterns = list(dict.fromkeys(x for _, rules in POINTS for condition, _ in rules for x in _pieces(condition)[1::2]))
    names = {x: f"_p{i}" for i, x in enumerate(patterns)}
    asked = small_methods(features).withColumns({n: occurs(F.col("t"), x) for x, n in names.items()} | {"_hero": F.expr(points_sql(HERO, names.get))})
    columns = {}
    for name, rules in POINTS:
        own = rules[len(HERO) :] if rules[: len(HERO)] == HERO else rules
        columns[f"_k_{name}"] = F.expr(points_sql(own, names.get)) + (F.col("_hero") if own is not rules else 0)
    counted = asked.withColumns(columns).drop(*names.values())
    each = [F.struct(F.col(f"_k_{name}").alias("points"), F.lit(-i).alias("ord"), F.lit(name).alias("type")) for i, (name, _) in enumerate(POINTS)]
    best = counted.withColumn("_best", F.array_max(F.array(*each))).drop("_hero", *columns)
    won = F.col("_best.points") >= LEAST_POINTS
    return best.withColumns(
        {"type": F.when(won, F.col("_best.type")).otherwise("unknown"), "confidence": F.when(won, F.least(F.col("_best.points") / 100.0, F.lit(1.0))).otherwise(0.0)}
    ).drop("_best")


def confident(sections: DataFrame, least: float = 0.4) -> DataFrame:
    """Sections of a known type above the threshold, their positions numbered anew."""
    order = Window.partitionBy("comp_id").orderBy("pos")
    return sections.where((F.col("type") != "unknown") & (F.col("confidence") > least)).withColumn("pos", F.row_number().over(order) - 1)


def nested(sections: DataFrame) -> DataFrame:
    """comp_id, n and s, the sections in order as an array of structs."""
    rows = F.array_sort(F.collect_list(F.struct("pos", *FIELDS)))
    return sections.groupBy("comp_id").agg(rows.alias("s")).withColumn("n", F.size("s"))


def variant(kind: Column, cols: Column, images: Column, carousel: Column, full_width: Column, background: Column) -> Column:
    """The variant of a normalised section, or null."""
    two = cols >= 2
    # Each type's variants.
    return (
        F.when(kind == "hero_full_bleed", F.when(background, "gradient_texture").otherwise("solid_overlay"))
        .when(kind == "hero_split", F.when(cols != 2, "asymmetric").when(images > 0, "image_right").otherwise("image_left"))
        .when(kind == "hero_slideshow", "slide")
        .when(kind == "hero_bento", F.when(images >= 4, "asymmetric").when(two, "2x2").otherwise("3_panel"))
        .when(kind == "hero_minimal", F.when(two, "left_aligned").otherwise("centered"))
        .when(kind == "featured_products", F.when(cols >= 4, "grid_editorial").when(cols <= 2, "grid_minimal").otherwise("grid_compact"))
        .when(kind == "product_carousel", F.when(full_width, "full_width").otherwise("standard"))
        .when(kind == "testimonial_cards", F.when(carousel, "carousel").when(cols >= 3, "masonry").otherwise("grid"))
        .when(kind == "category_grid", F.when(cols >= 4, "4col").when(cols == 3, "3col").otherwise("2col"))
        .when(kind == "image_with_text", F.when(two, "image_left").otherwise("overlapping"))
    )


def variant_hint(kind: Column, cols: Column, carousel: Column, background: Column) -> Column:
    """The variant of a section as one viewport shows it, or null; narrower than variant()."""
    # Each type's hints.
    return (
        F.when(kind == "hero_full_bleed", F.when(background, "gradient_texture").otherwise("solid_overlay"))
        .when((kind == "hero_split") & (cols == 2), "image_right")
        .when((kind == "hero_slideshow") & carousel, "slide")
        .when(kind == "featured_products", F.when(cols >= 4, "grid_editorial").when(cols <= 2, "grid_minimal"))
        .when((kind == "product_carousel") & carousel, "standard")
        .when(kind == "testimonial_cards", F.when(carousel, "carousel").otherwise("grid"))
        .when(kind == "category_grid", F.when(cols >= 4, "4col").when(cols == 3, "3col").when(cols <= 2, "2col"))
        .when((kind == "image_with_text") & (cols == 2), "image_left")
    )


def type_from_id(section_id: Column, height: Column) -> Column:
    """A section's type from its element id, by ordered words; without a match, a zero or missing height tells an embed."""
    bare = F.lower(section_id)
    first = F.instr(bare, F.lit("shopify-section-"))
    bare = F.when(first > 0, F.concat(F.substring(bare, F.lit(1), first - 1), F.substring(bare, first + 16, F.length(bare)))).otherwise(bare)
    for pattern in (r"^(.*?)sections--\d+__", r"^(.*?)template--\d+__"):
        bare = F.regexp_replace(bare, pattern, "$1")
    bare = F.regexp_replace(bare, r"_[a-z0-9]{6,}$", "")
    out = None
    for kind, *alternatives in vocab.ID_RULES:
        hit = reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [bare.contains(w) for w in alt.split("+")]) for alt in alternatives])
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    out = out.when((bare == "main") | bare.endswith("__main"), "main_content")
    return out.when(F.coalesce(height, F.lit(0)) == 0, "app_embed").otherwise("unknown")


def reconciled(desktop: DataFrame, mobile: DataFrame) -> DataFrame:
    """The two viewports' sections (comp_id, pos, FIELDS) as one list: each desktop section, in order, takes the unclaimed mobile
    section of its type that is nearest in relative position, the first on ties; the mobile ones left over follow. Both may have
    background, which the variant hints ask for.

    Claims cross types nowhere, so every (composition, type) is folded by itself over its two short arrays."""
    parts = []
    for side, df in (("d", desktop), ("m", mobile)):
        total = F.count("*").over(Window.partitionBy("comp_id")).alias("total")
        df = df if "background" in df.columns else df.withColumn("background", F.lit(False))
        parts.append(df.select("comp_id", "type", F.lit(side).alias("side"), F.struct("pos", *[f for f in FIELDS if f not in ("type", "heading", "images")], "background", total).alias("x")))
    per = parts[0].unionByName(parts[1]).groupBy("comp_id", "type").agg(
        *[F.array_sort(F.collect_list(F.when(F.col("side") == s, F.col("x")))).alias(s) for s in ("d", "m")]
    )
    none = F.array().cast("array<bigint>")

    def take(claims: Column, d: Column) -> Column:
        free = F.filter(F.col("m"), lambda m: ~F.array_contains(claims, m["pos"].cast("bigint")))
        far = F.transform(free, lambda m: F.struct((F.abs(d["pos"] / d["total"] - m["pos"] / m["total"]) - F.lit(1.0)).alias("far"), m["pos"].cast("bigint").alias("pos")))
        return F.concat(claims, F.array(F.coalesce(F.array_min(far)["pos"], F.lit(-1).cast("bigint"))))

    per = per.withColumn("claims", F.aggregate("d", none, take))
    pair = F.transform("d", lambda d, i: F.struct(d.alias("d"), F.get(F.filter(F.col("m"), lambda m: m["pos"] == F.get(F.col("claims"), i)), F.lit(0)).alias("m")))
    rest = F.transform(F.filter("m", lambda m: ~F.array_contains(F.col("claims"), m["pos"].cast("bigint"))), lambda m: F.struct(F.lit(None).cast(per.schema["d"].dataType.elementType).alias("d"), m.alias("m")))
    rows = per.select("comp_id", "type", F.explode(F.concat(pair, rest)).alias("r")).select("comp_id", "type", "r.d", "r.m")
    prominence = F.coalesce(F.col("m.ratio"), F.lit(0.0)) / (1 + F.col("m.pos") * F.lit(0.5))
    rows = rows.withColumn("prominence", F.when(F.col("m").isNotNull(), prominence))
    top = Window.partitionBy("comp_id").orderBy(F.col("prominence").desc_nulls_last(), F.col("m.pos").asc_nulls_last())
    order = Window.partitionBy("comp_id").orderBy(F.col("d.pos").asc_nulls_last(), F.col("m.pos"))
    both = F.col("d").isNotNull() & F.col("m").isNotNull()
    # A missing or zero column count, and a carousel only the desktop has, do not differ.
    wider = (F.col("m.cols") != 0) & (F.col("m.cols") != F.col("d.cols"))
    differs = both & (wider | (F.col("m.carousel") & ~F.col("d.carousel")) | (F.abs(F.col("d.ratio") - F.col("m.ratio")) > 0.3))
    layout_of = lambda side: F.struct(F.col(f"{side}.cols").alias("grid_columns"), F.col(f"{side}.carousel").alias("has_carousel"), F.col(f"{side}.ratio").alias("height_ratio"))
    hint = lambda side: F.when(F.col(side).isNotNull(), variant_hint(F.col("type"), F.col(f"{side}.cols"), F.col(f"{side}.carousel"), F.col(f"{side}.background")))
    sure = F.greatest(F.coalesce("d.confidence", F.lit(0.0)), F.coalesce("m.confidence", F.lit(0.0)))
    return rows.withColumn("rank", F.row_number().over(top)).select(
        "comp_id",
        (F.row_number().over(order) - 1).alias("pos"),
        "type",
        sure.alias("confidence"),
        F.col("d").isNotNull().alias("on_desktop"),
        F.col("m").isNotNull().alias("on_mobile"),
        F.col("d.pos").alias("desktop_pos"),
        F.col("m.pos").alias("mobile_pos"),
        (F.col("m").isNotNull() & (sure > 0.7)).alias("required"),
        (F.coalesce("d.is_dark", F.lit(False)) | F.coalesce("m.is_dark", F.lit(False))).alias("is_dark"),
        F.coalesce("d.ratio", F.lit(0.0)).alias("ratio_desktop"),
        F.coalesce("m.ratio", F.lit(0.0)).alias("ratio_mobile"),
        (F.col("m").isNotNull() & (F.col("rank") == 1) & (F.col("prominence") > 0.4)).alias("primary_hero"),
        F.coalesce("prominence", F.lit(0.0)).alias("prominence"),
        F.coalesce(differs, F.lit(False)).alias("differs"),
        F.when(differs, F.struct(layout_of("d").alias("desktop_layout"), layout_of("m").alias("mobile_layout"))).alias("responsive_variant"),
        hint("d").alias("desktop_variant_hint"),
        hint("m").alias("mobile_variant_hint"),
    )


def layout(sections: DataFrame) -> DataFrame:
    """comp_id, n, rhythm and the share of full-width sections."""
    rhythm = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "is_dark"))), lambda x: F.when(x["is_dark"], "D").otherwise("L")), "")
    return sections.groupBy("comp_id").agg(F.count("*").alias("n"), rhythm.alias("rhythm"), F.avg((F.col("ratio") >= 0.95).cast("double")).alias("full_width_ratio"))
