"""Further queries, each with the SQL that must give its rows: rendered elements, vision replies, product pages, reports, orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagecraft.functions import scalars as sc
from pagecraft.operators import fonts, library, normalize, overlays, palette, quality, sections, structural
from pagecraft.plans import fixtures as fx
from pagecraft.plans import oracle
from pagecraft.plans import queries as q

CLASSES = ("Newsletter-Popup", "main", "nav klaviyo-form", "page backdrop", "shopify-section hero", "cookie-consent", "hero OMNISEND")
ELEMENT_IDS = ("a1", "cookie-bar", "PopUp1", "site-modal")
SOURCES = ("https://app.Maker.co/x", "https://cdn.shogun.io/p", "https://x.gempages.net", "https://pagefly.io/f", "https://zipify.com/z", "https://replo.app/r", "https://other.example/y")


def elements(spark: SparkSession, d: str) -> DataFrame:
    p, s, n = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_quantity")
    return fx.table(spark, d, "lineitem").select(
        (p % 300).alias("z"), (n * 30).alias("w"), (n * 15).alias("h"), F.lit(1440.0).alias("vp_w"), F.lit(900.0).alias("vp_h"), (p % 900).alias("y"), fx.pick(("fixed", "absolute", "static"), s % 3).alias("position"),
        fx.pick(("block", "none"), F.when(p % 11 == 0, 1).otherwise(0)).alias("display"), fx.pick(("visible", "hidden"), F.when(p % 13 == 0, 1).otherwise(0)).alias("visibility"), F.lit(1.0).alias("opacity"),
        F.when(p % 8 < 7, fx.pick(CLASSES, p % 8)).alias("class"), fx.pick(ELEMENT_IDS, F.when(s % 9 < 4, s % 9).otherwise(0)).alias("id"),
        F.when(p % 17 == 0, F.array(F.lit("data-modal"))).otherwise(F.array().cast("array<string>")).alias("attributes"),
    )


ELEMENTS_SQL = f"""e AS (SELECT l_partkey % 300 AS z, l_quantity * 30 AS w, l_quantity * 15 AS h, l_partkey % 900 AS y, {fx.sql_pick(('fixed', 'absolute', 'static'), 'l_suppkey % 3')} AS position,
    l_partkey % 11 = 0 AS gone, l_partkey % 13 = 0 AS hid, CASE WHEN l_partkey % 8 < 7 THEN {fx.sql_pick(CLASSES, 'l_partkey % 8')} ELSE '' END AS cls,
    {fx.sql_pick(ELEMENT_IDS, 'CASE WHEN l_suppkey % 9 < 4 THEN l_suppkey % 9 ELSE 0 END')} AS id, l_partkey % 17 = 0 AS attr, (l_quantity * 30) * (l_quantity * 15) / (1440.0::DOUBLE * 900.0) AS area FROM lineitem)"""


def element_filters(spark: SparkSession, d: str) -> DataFrame:
    e = elements(spark, d)
    return e.groupBy(F.coalesce(overlays.overlay_reason(), F.lit("none")).alias("overlay"), overlays.shown().alias("shown"), overlays.popup().alias("popup")).agg(F.count("*").alias("n"))


#: The SQL repeats the names that the page's own code lists, literally.
ELEMENT_FILTERS = f"""WITH {ELEMENTS_SQL} SELECT CASE WHEN regexp_matches(cls, 'popup|modal|overlay|klaviyo|privy|omnisend|justuno|wheelio|spin-wheel|cookie|consent|gdpr|exit-intent|notification-bar')
        OR regexp_matches(id, 'popup|modal|overlay|klaviyo|cookie|consent') OR attr THEN 'name' WHEN z > 100 AND position <> 'static' AND area > 0.3 THEN 'size'
        WHEN z > 100 AND position = 'fixed' AND h < 200 AND y > 630 THEN 'bar' WHEN regexp_matches(cls, 'backdrop|underlay') THEN 'backdrop' ELSE 'none' END AS overlay, NOT (gone OR hid OR h < 10) AS shown,
        z > 100 AND position IN ('fixed', 'absolute') AND (area > 0.5 OR regexp_matches(lower(id), 'popup|modal|overlay') OR regexp_matches(lower(cls), 'popup|modal|overlay|klaviyo|privy|omnisend')) AS popup, count(*) AS n FROM e GROUP BY ALL"""


def frame_builders(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("l_partkey")
    rows = fx.lines(spark, d).select(
        F.col("l_orderkey").alias("page"), "pos", F.concat(F.lit("S"), p % 5).alias("id"), F.when(p % 6 == 0, "Custom-SHOGUN").otherwise("plain").alias("class"), (F.col("l_quantity") * 60.5).alias("h"),
        F.lit(900.0).alias("vp_h"), F.when(F.col("l_suppkey") % 3 == 0, fx.pick(SOURCES, p % 7)).alias("iframe_src"),
    )
    return overlays.frame_builders(rows)


FRAME_BUILDERS = f"""WITH {fx.LINES_SQL}, r AS (SELECT l_orderkey AS page, pos, 'S' || (l_partkey % 5) AS section_id, l_partkey % 6 = 0 AS shogun, l_quantity * 60.5 AS h, lower({fx.sql_pick(SOURCES, 'l_partkey % 7')}) AS src FROM lines WHERE l_suppkey % 3 = 0),
    f AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY pos) AS k FROM r WHERE h >= 1800)
    SELECT page, CASE WHEN contains(src, 'maker.co') THEN 'maker' WHEN shogun OR contains(src, 'shogun') THEN 'shogun' WHEN contains(src, 'gempages') THEN 'gempages' WHEN contains(src, 'pagefly') THEN 'pagefly'
        WHEN contains(src, 'zipify') THEN 'zipify' WHEN contains(src, 'replo') THEN 'replo' ELSE 'unknown' END AS builder, src[1:200] AS iframe_src, section_id, CAST(floor(round(h, 9) + 0.5) AS BIGINT) AS section_height FROM f WHERE k = 1"""


def section_roots(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("l_partkey")
    rows = fx.lines(spark, d).select(
        F.col("l_orderkey").alias("page"), "pos", ((F.col("l_orderkey") % 3 == 0) & (p % 2 == 0)).alias("marked"), fx.pick(("block", "none"), F.when(p % 11 == 0, 1).otherwise(0)).alias("display"),
        fx.pick(("visible", "hidden"), F.when(p % 13 == 0, 1).otherwise(0)).alias("visibility"), (F.col("l_quantity") * 30).alias("w"), (F.col("l_quantity") * 5).alias("h"), F.lit(1440.0).alias("vp_w"),
    )
    return overlays.section_roots(rows).select("page", "pos", "method", "index")


SECTION_ROOTS = f"""WITH {fx.LINES_SQL}, r AS (SELECT l_orderkey AS page, pos, l_orderkey % 3 = 0 AND l_partkey % 2 = 0 AS marked, l_partkey % 11 <> 0 AND l_partkey % 13 <> 0 AND l_quantity * 5 > 50 AND l_quantity * 30 > 720 AS large FROM lines),
    m AS (SELECT *, bool_or(marked) OVER (PARTITION BY page) AS has FROM r), k AS (SELECT page, pos, CASE WHEN has THEN 'shopify' ELSE 'heuristic' END AS method FROM m WHERE CASE WHEN has THEN marked ELSE large END)
    SELECT *, row_number() OVER (PARTITION BY page ORDER BY pos) - 1 AS index FROM k"""


def innermost_sections(spark: SparkSession, d: str) -> DataFrame:
    """Paths of one to three steps; those of one step hold those that begin with them."""
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    steps = F.array(F.lit("0"), (p % 2).cast("string"), (s % 3).cast("string"))
    rows = fx.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), F.array_join(F.slice(steps, F.lit(1), (F.col("l_linenumber") % 3 + 1).cast("int")), "/").alias("path")).distinct()
    return overlays.innermost(rows)


INNERMOST = """WITH r AS (SELECT DISTINCT l_orderkey AS page, CASE l_linenumber % 3 WHEN 0 THEN '0' WHEN 1 THEN '0/' || (l_partkey % 2) ELSE '0/' || (l_partkey % 2) || '/' || (l_suppkey % 3) END AS path FROM lineitem),
    f AS (SELECT *, NOT EXISTS (SELECT 1 FROM r o WHERE o.page = r.page AND starts_with(o.path, r.path || '/')) AS free FROM r), n AS (SELECT *, count(*) FILTER (free) OVER (PARTITION BY page) AS k FROM f)
    SELECT page, path FROM n WHERE free OR k < 2"""


def styles(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    names = F.array(F.lit("--primary"), F.lit("--color-base"), F.lit("--spacing"), F.lit("--accent"))
    values = F.array(F.concat(F.lit(" #"), k % 10, F.lit("0a0b0 ")), F.when(k % 2 == 0, " ").otherwise("#fff"), F.lit("4px"), F.when(k % 3 == 0, "red").otherwise(""))
    return fx.table(spark, d, "orders").select(k.alias("comp_id"), F.map_from_arrays(names, values).alias("styles"))


def custom_properties(spark: SparkSession, d: str) -> DataFrame:
    kept = overlays.custom_properties(F.col("styles"))
    return styles(spark, d).select("comp_id", F.array_join(F.transform(F.array_sort(F.map_entries(kept)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("properties"))


CUSTOM_PROPERTIES = """SELECT o_orderkey AS comp_id, concat_ws(';', CASE WHEN o_orderkey % 3 = 0 THEN '--accent=red' END, CASE WHEN o_orderkey % 2 <> 0 THEN '--color-base=#fff' END, '--primary=#' || (o_orderkey % 10) || '0a0b0') AS properties FROM orders"""


# Vision.


def replies(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    each = F.transform(F.sequence(F.lit(1).cast("long"), F.greatest(k % 5, F.lit(1))), lambda i: F.concat(F.lit('{"position":'), i, F.when(k % 2 == 0, F.lit(',"dom_said":"a"')).otherwise(""), F.lit(',"you_see":"b"}')))
    listed = F.array_join(F.when(k % 5 == 0, F.array().cast("array<string>")).otherwise(each), ",")
    vibe = F.when(k % 4 == 0, '"vibe":["modern","dark-hero"],').otherwise("")
    seen = F.when(k % 3 != 1, '"sections_you_see":["hero","grid"],').otherwise("")
    body = F.concat(F.lit("{"), vibe, seen, F.lit('"agrees":'), F.when(k % 3 == 0, "true").otherwise("false"), F.lit(',"vertical":"'), F.when(k % 6 < 4, "general").otherwise("beauty"), F.lit('","disagreements":['), listed, F.lit("]}"))
    reply = F.when(k % 7 == 0, "sorry, no").when(k % 2 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(body)
    return fx.table(spark, d, "orders").select(k.alias("comp_id"), reply.alias("reply"))


REPLIES_SQL = """reply AS (SELECT o_orderkey AS comp_id, o_orderkey % 7 = 0 AS broken, o_orderkey % 3 = 0 AS agreed, CASE WHEN o_orderkey % 6 < 4 THEN 'general' ELSE 'beauty' END AS said, o_orderkey % 5 AS k, o_orderkey % 4 = 0 AS vibes,
    o_orderkey % 3 <> 1 AS sees, CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE '' END AS dom FROM orders),
    told AS (SELECT *, CASE WHEN broken THEN 0 WHEN agreed THEN 15 WHEN k <= 2 THEN 5 ELSE -15 END AS boost, NOT broken AND NOT agreed AND k > 2 AS flag, CASE WHEN broken THEN 'general' ELSE said END AS seen_vertical FROM reply)"""


def vision_gate(spark: SparkSession, d: str) -> DataFrame:
    rows = quality.scored(q.nested(spark, d)).withColumn("screenshot", F.when(F.col("comp_id") % 5 == 0, F.lit("").cast("binary")).when(F.col("comp_id") % 5 < 4, F.lit("png").cast("binary")))
    return quality.vision_wanted(rows).select("comp_id", "quality_score")


def vision_override(spark: SparkSession, d: str) -> DataFrame:
    out = quality.with_vision(q.full_compositions(spark, d).select("comp_id", "vertical", "tags", "quality_score"), replies(spark, d))
    return out.select("comp_id", "vertical", F.array_join("tags", ",").alias("tags"), "quality_score", "flagged")


def vision_details(spark: SparkSession, d: str) -> DataFrame:
    v = quality.vision(replies(spark, d))
    line = F.transform("details", lambda x: F.concat_ws(":", x["position"].cast("string"), x["dom_said"], x["vision_says"]))
    return v.select("comp_id", F.array_join("seen", ",").alias("seen"), F.array_join("vibe", ",").alias("vibe"), F.array_join(line, ",").alias("details"))


_LINES = "array_to_string(list_transform(CASE WHEN k = 0 THEN [] ELSE range(1, k + 1) END, lambda i: {}), '{}')"


def review_report(spark: SparkSession, d: str) -> DataFrame:
    rows = q.nested(spark, d).withColumn("url", F.concat(F.lit("http://s"), "comp_id"))
    return quality.review_queue(rows, replies(spark, d))


REVIEW_REPORT = f"""WITH {fx.KEPT_SQL}, {REPLIES_SQL} SELECT comp_id, 'http://s' || comp_id AS url, array_to_string(list_transform(s, lambda x: x.type), ', ') AS dom_sections, CASE WHEN sees THEN 'hero, grid' ELSE '' END AS seen,
    CASE WHEN vibes THEN 'modern, dark-hero' ELSE '' END AS vibe, seen_vertical AS vertical, CAST(k AS INTEGER) AS disagreements,
    {_LINES.format("'pos ' || i || ': DOM=\"' || dom || '\", picture=\"b\"'", chr(10))} AS lines FROM nested JOIN told USING (comp_id) WHERE flag"""


def screenshot_base64(spark: SparkSession, d: str) -> DataFrame:
    return fx.table(spark, d, "pages").select("page_id", sc.base64_of(F.col("html").cast("binary")).alias("screenshot"))


def composition_ids(spark: SparkSession, d: str) -> DataFrame:
    return fx.compositions(spark, d).select("comp_id", normalize.composition_id(F.col("url"), q.as_of()).alias("id"))


def raw_hints(spark: SparkSession, d: str) -> DataFrame:
    """Every desktop section with the hints of the first section of its type, the mobile one before the desktop one."""
    back = F.col("seed") % 6 == 0
    desktop, mobile = (x.withColumn("background", back) for x in q.two_viewports(spark, d))
    rows = normalize.with_raw(desktop.select("comp_id", "pos", "type"), desktop, mobile)
    h = normalize.hints(F.col("raw"))
    return rows.select("comp_id", "pos", "type", h["heading"].alias("heading"), h["product_count"].alias("product_count"), h["has_carousel"].alias("has_carousel"), h["grid_columns"].alias("grid_columns"))


RAW_HINTS = f"""WITH {fx.SECTIONS_SQL}, one AS (SELECT *, row_number() OVER (PARTITION BY comp_id, type ORDER BY pos) AS k FROM section), d AS (SELECT * FROM one WHERE k = 1),
    mob AS (SELECT *, row_number() OVER (PARTITION BY comp_id, type ORDER BY pos) AS k FROM section WHERE seed % 5 <> 0), m AS (SELECT * FROM mob WHERE k = 1)
    SELECT s.comp_id, s.pos, s.type, CASE WHEN m.comp_id IS NULL THEN d.heading ELSE m.heading END AS heading, nullif(greatest(coalesce(m.images, d.images), 3), 3) AS product_count, coalesce(m.carousel, d.carousel) AS has_carousel,
        CASE WHEN m.comp_id IS NULL THEN d.cols ELSE 1 END AS grid_columns FROM section s LEFT JOIN m ON m.comp_id = s.comp_id AND m.type = s.type LEFT JOIN d ON d.comp_id = s.comp_id AND d.type = s.type"""


def inferred_verticals(spark: SparkSession, d: str) -> DataFrame:
    """A target's own vertical wins, also over what its palette tells; a blank one does not."""
    c = q.full_compositions(spark, d).withColumn("vertical", F.when(F.col("comp_id") % 3 == 0, F.col("vertical")).when(F.col("comp_id") % 3 == 1, ""))
    return c.select("comp_id", F.coalesce(F.nullif(F.col("vertical"), F.lit("")), quality.vertical(quality.headings(F.col("s")), F.col("gold"), F.col("maroon"))).alias("vertical"))


# Colours and fonts.


def clusters(spark: SparkSession, d: str) -> DataFrame:
    e = fx.table(spark, d, "embeddings")
    rank = F.row_number().over(sections.Window.partitionBy("label").orderBy("vec_id"))
    return e.withColumn("cluster", rank - 1).where("cluster < 8").select(F.col("label").alias("img_id"), "cluster", *[(F.col("vec_id") * k % 256).cast("int").alias(c) for c, k in (("r", 37), ("g", 91), ("b", 53))], ((F.col("vec_id") % 10) / 100.0).alias("proportion"))


CLUSTERS_SQL = """c AS (SELECT * FROM (SELECT label AS img_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS cluster, vec_id * 37 % 256 AS r, vec_id * 91 % 256 AS g, vec_id * 53 % 256 AS b, vec_id % 10 / 100.0::DOUBLE AS proportion FROM embeddings) WHERE cluster < 8)"""


def perceived_palette(spark: SparkSession, d: str) -> DataFrame:
    p = palette.perceived(clusters(spark, d))
    return p.select("img_id", F.array_join(F.transform("colours", lambda c: c["hex"]), ",").alias("colours"), "is_dark_perceived")


def gold_check(spark: SparkSession, d: str) -> DataFrame:
    """Pages that claim gold, against the colours perceived in a picture; some have none."""
    seen = palette.perceived(clusters(spark, d)).select("img_id", F.col("colours").alias("perceived"))
    claims = palette.signals(palette.top_colours(fx.colours(spark, d))).select("comp_id", "has_gold", "gold_proportion", (F.col("comp_id") % 20).cast("int").alias("img_id"))
    out = palette.checked_gold(claims.join(seen, "img_id", "left"))
    return out.select("comp_id", "has_gold", q.r6("gold_proportion", "gold_proportion"))


GOLD_CHECK = f"""WITH {oracle.TOP_SQL}, {oracle.SIGNALS_SQL}, {CLUSTERS_SQL}, p AS (SELECT img_id, bool_or(r > 170 AND g > 140 AND g < 220 AND b < 120 AND r > g AND proportion > 0.02) AS gold FROM c GROUP BY img_id),
    x AS (SELECT comp_id, has_gold, gold_proportion, coalesce(has_gold AND NOT gold, false) AS unseen FROM signals LEFT JOIN p ON img_id = comp_id % 20)
    SELECT comp_id, has_gold AND NOT unseen AS has_gold, round(gold_proportion * CASE WHEN unseen THEN 0.3 ELSE 1 END, 6) AS gold_proportion FROM x"""


def painted_colours(spark: SparkSession, d: str) -> DataFrame:
    """Top colours where elements without a background or under ten pixels are left out."""
    rows = fx.colours(spark, d).withColumns({"w": F.col("area") / 100, "h": (F.col("ord") + 6) * 1.5, "hex": F.when(F.col("ord") % 7 != 3, F.col("hex"))}).drop("area")
    return palette.top_colours(palette.painted(rows), 5).select("comp_id", "hex", "rank")


PAINTED_COLOURS = oracle.TOP_SQL.replace(oracle.HSL_SQL, oracle.HSL_SQL.replace("FROM rgb)", "FROM (SELECT * REPLACE (area / 100 * ((ord + 6) * 1.5::DOUBLE) AS area) FROM rgb WHERE ord % 7 <> 3 AND area / 100 >= 10 AND (ord + 6) * 1.5 >= 10))"))
PAINTED_COLOURS = f"WITH {PAINTED_COLOURS} SELECT comp_id, hex, rank FROM top WHERE rank <= 5"


def font_lists(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.fonts(spark, d).withColumn("weight", F.when(F.col("heading"), "700").otherwise("400"))
    out = fonts.usage_lists(rows)
    return out.select("comp_id", "font", F.array_join(F.transform("sizes", lambda x: x.cast("int").cast("string")), ",").alias("sizes"), F.array_join("weights", ",").alias("weights"))


FONT_LISTS = f"WITH {fx.FONTS_SQL} SELECT comp_id, font, string_agg(size::INTEGER::VARCHAR, ',' ORDER BY ord) AS sizes, string_agg(CASE WHEN heading THEN '700' ELSE '400' END, ',' ORDER BY ord) AS weights FROM font GROUP BY ALL"


def variant_hints(spark: SparkSession, d: str) -> DataFrame:
    """Each pair of viewports as both layouts and hints, where every section is claimed by the mobile one in its own place."""
    desktop = fx.sections(spark, d).withColumns({"background": F.col("seed") % 6 == 0, "type": F.concat("type", F.lit(""))})
    one = sections.Window.partitionBy("comp_id", "type").orderBy("pos")
    desktop = desktop.withColumn("_n", F.row_number().over(one)).where("_n = 1").drop("_n")
    mobile = desktop.withColumns({"cols": F.when(F.col("seed") % 4 == 0, 0).otherwise(1), "ratio": F.col("ratio") * 0.7, "carousel": F.col("images") > 3})
    out = sections.reconciled(desktop, mobile)
    v = F.col("responsive_variant")
    show = lambda x: F.concat_ws("/", x["grid_columns"].cast("string"), x["has_carousel"].cast("string"), F.round(x["height_ratio"], 6).cast("decimal(12,6)").cast("string"))
    return out.select("comp_id", "type", F.when(v.isNotNull(), F.concat(show(v["desktop_layout"]), F.lit(" "), show(v["mobile_layout"]))).alias("variant"), "desktop_variant_hint", "mobile_variant_hint")


_HINT = """CASE WHEN type = 'hero_full_bleed' THEN CASE WHEN seed % 6 = 0 THEN 'gradient_texture' ELSE 'solid_overlay' END WHEN type = 'hero_split' AND {c} = 2 THEN 'image_right' WHEN type = 'hero_slideshow' AND {k} THEN 'slide'
    WHEN type = 'featured_products' AND {c} >= 4 THEN 'grid_editorial' WHEN type = 'featured_products' AND {c} <= 2 THEN 'grid_minimal' WHEN type = 'product_carousel' AND {k} THEN 'standard'
    WHEN type = 'testimonial_cards' THEN CASE WHEN {k} THEN 'carousel' ELSE 'grid' END WHEN type = 'category_grid' THEN CASE WHEN {c} >= 4 THEN '4col' WHEN {c} = 3 THEN '3col' ELSE '2col' END
    WHEN type = 'image_with_text' AND {c} = 2 THEN 'image_left' END"""
VARIANT_HINTS = f"""WITH {fx.SECTIONS_SQL}, o AS (SELECT *, row_number() OVER (PARTITION BY comp_id, type ORDER BY pos) AS rn, CASE WHEN seed % 4 = 0 THEN 0 ELSE 1 END AS mc, images > 3 AS mk, ratio * 0.7::DOUBLE AS mr FROM section), f AS (SELECT *, (mc <> 0 AND mc <> cols) OR (mk AND NOT carousel) OR abs(ratio - mr) > 0.3 AS differs FROM o WHERE rn = 1)
    SELECT comp_id, type, CASE WHEN differs THEN cols || '/' || carousel || '/' || round(ratio, 6)::DECIMAL(12,6) || ' ' || mc || '/' || mk || '/' || round(mr, 6)::DECIMAL(12,6) END AS variant, {_HINT.format(c='cols', k='carousel')} AS desktop_variant_hint, {_HINT.format(c='mc', k='mk')} AS mobile_variant_hint FROM f"""


# Product pages and matrices.


def pdp_rich(spark: SparkSession, d: str) -> DataFrame:
    """Elements whose details hold texts, booleans, whole and decimal numbers, negative ones, lists (some empty), nulls and objects."""
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    tags = F.when(p % 11 == 0, "[]").otherwise(F.concat(F.lit('["t'), p % 5, F.lit('","t'), s % 3, F.lit('"]')))
    details = F.concat(
        F.lit('{"style":"style'), p % 7, F.lit('","sticky":'), F.when(F.col("l_returnflag") == "R", "true").otherwise("false"), F.lit(',"count":'), s % 9, F.lit(',"price":'), p % 7 - 3, F.lit('.25,"tags":'), tags,
        F.lit(',"more":{"a":1},"none":null}'),
    )
    comps = fx.compositions(spark, d).select("comp_id", "url", "vertical", "sub_vertical")
    own = fx.lines(spark, d).select(F.col("l_orderkey").alias("comp_id"), "pos", F.concat(F.lit("el"), p % 12).alias("element"), (F.col("l_quantity") > 15).alias("present"), details.alias("details"))
    return own.join(comps, "comp_id")


PDP_RICH_SQL = f"""{fx.LINES_SQL}, rich AS (SELECT 'http://s' || l_orderkey AS url, pos, 'el' || (l_partkey % 12) AS element, l_quantity > 15 AS present, '{{"style":"style' || (l_partkey % 7) || '","sticky":' || CASE WHEN l_returnflag = 'R' THEN 'true' ELSE 'false' END ||
    ',"count":' || (l_suppkey % 9) || ',"price":' || (l_partkey % 7 - 3) || '.25,"tags":' || CASE WHEN l_partkey % 11 = 0 THEN '[]' ELSE '["t' || (l_partkey % 5) || '","t' || (l_suppkey % 3) || '"]' END || ',"more":{{"a":1}},"none":null}}' AS details FROM lines),
    fe AS (SELECT element, url, pos, details FROM (SELECT *, row_number() OVER (PARTITION BY url, element ORDER BY pos) AS rn FROM rich) WHERE rn = 1 AND present)"""


def pdp_details(spark: SparkSession, d: str) -> DataFrame:
    return structural.detail_summary(structural.detail_values(pdp_rich(spark, d)))


PDP_DETAILS = f"""WITH {PDP_RICH_SQL}, e AS (SELECT element, url, pos, details, unnest(json_keys(details)) AS field FROM fe), j AS (SELECT element, url, pos, field, json_extract(details, '$.' || field) AS jv FROM e),
    t AS (SELECT *, CASE json_type(jv) WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array' WHEN 'UBIGINT' THEN 'number' WHEN 'BIGINT' THEN 'number' WHEN 'DOUBLE' THEN 'number' ELSE 'other' END AS kind FROM j),
    g AS (SELECT element, field, count(*) AS n FROM t GROUP BY ALL), k AS (SELECT element, field, first(kind ORDER BY url, pos) AS kind FROM t GROUP BY ALL),
    flat AS (SELECT element, field, url, pos, 0 AS i, json_extract_string(jv, '$') AS value FROM t WHERE kind <> 'array' UNION ALL SELECT element, field, url, pos, i, json_extract_string(jv, '$[' || i || ']') FROM (SELECT *, unnest(range(json_array_length(jv)::BIGINT)) AS i FROM t WHERE kind = 'array')),
    c AS (SELECT element, field, value, count(*) AS c, row_number() OVER (PARTITION BY element, field ORDER BY count(*) DESC, min(url || lpad(pos::VARCHAR, 6, '0') || lpad(i::VARCHAR, 6, '0'))) AS r FROM (SELECT f.*, FROM flat f) GROUP BY element, field, value),
    top AS (SELECT element, field, string_agg(value, ',' ORDER BY r) FILTER (r <= 5) AS names, string_agg(value || ':' || c, ',' ORDER BY r) FILTER (r <= 5) AS counts, first(value ORDER BY r) AS mode,
        sum(c) FILTER (value = 'true') AS trues, sum(try_cast(value AS DOUBLE) * c) AS total, min(try_cast(value AS DOUBLE)) AS low, max(try_cast(value AS DOUBLE)) AS high FROM c GROUP BY ALL)
    SELECT element, field, kind, n, CASE kind WHEN 'string' THEN mode WHEN 'array' THEN coalesce(names, '') END AS most_common, CASE WHEN kind = 'string' THEN counts END AS distribution,
        CASE WHEN kind = 'boolean' THEN CAST(floor(round(coalesce(trues, 0) * 100.0::DOUBLE / n, 9) + 0.5) AS INTEGER) END AS true_pct, CASE WHEN kind = 'number' THEN floor(round(total / n * 10, 9) + 0.5) / 10.0 END AS average,
        CASE WHEN kind = 'number' THEN low END AS low, CASE WHEN kind = 'number' THEN high END AS high FROM g JOIN k USING (element, field) LEFT JOIN top USING (element, field)"""


def pdp_coercion(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = fx.table(spark, d, "orders").select(
        F.concat(F.lit("http://s"), k).alias("url"), fx.pick(("true", '"true"', "1", "false", "null"), k % 5).alias("present"), F.when(k % 3 == 0, '{"a":1}').when(k % 3 == 1, "[1]").alias("details"),
        F.when(k % 2 == 0, F.concat(F.lit("http://p"), k)).alias("product_url"),
    )
    return structural.coerced(rows).groupBy("present", "details", F.col("product_url").startswith("http://p").alias("own")).agg(F.count("*").alias("n"), F.max("product_url").alias("last"))


PDP_COERCION = """SELECT o_orderkey % 5 = 0 AS present, CASE WHEN o_orderkey % 3 = 0 THEN '{"a":1}' ELSE '{}' END AS details, o_orderkey % 2 = 0 AS own, count(*) AS n,
    max(CASE WHEN o_orderkey % 2 = 0 THEN 'http://p' ELSE 'http://s' END || o_orderkey) AS last FROM orders GROUP BY ALL"""


def matrix_order(spark: SparkSession, d: str) -> DataFrame:
    return structural.matrix_order(structural.pdp_matrix(fx.pdp(spark, d))).select("scope", "key", "place", "element", "pct")


MATRIX_ORDER = f"WITH {oracle.PDP_MATRIX.replace('pdp_in', 'pdp')} SELECT scope, key, row_number() OVER (PARTITION BY scope, key ORDER BY pct DESC, n DESC, element) AS place, element, pct FROM matrix"


def key_order(spark: SparkSession, d: str) -> DataFrame:
    c = fx.compositions(spark, d)
    both = [structural.keys_in_order(c, k).select(F.lit(k).alias("kind"), F.col(k).alias("key"), "place") for k in ("vertical", "sub_vertical")]
    return both[0].unionByName(both[1])


KEY_ORDER = f"""WITH {fx.COMPS_SQL} SELECT 'vertical' AS kind, vertical AS key, row_number() OVER (ORDER BY vertical) AS place FROM (SELECT DISTINCT vertical FROM comps)
    UNION ALL SELECT 'sub_vertical', sub_vertical, row_number() OVER (ORDER BY sub_vertical) FROM (SELECT DISTINCT sub_vertical FROM comps)"""


def skipped_by_builder(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.compositions(spark, d).select("comp_id", F.when(F.col("comp_id") % 17 == 0, F.concat(F.lit("builder"), F.col("comp_id") % 3)).alias("iframe_builder"))
    return quality.skipped_by_builder(rows)


# The library.


def planted(spark: SparkSession, d: str) -> DataFrame:
    """Archetype rows of which some break each invariant."""
    k = F.col("o_orderkey")
    kinds = F.array(F.lit("hero_split"), F.when(k % 5 == 0, "no_such_type").otherwise("marquee"))
    return fx.table(spark, d, "orders").select(
        F.concat(F.lit("archetype_"), k).alias("archetype_id"), F.array_repeat(F.lit(0.0), F.when(k % 7 == 0, 41).otherwise(42)).alias("vec"), (k % 3).alias("cluster_size"), (k % 20).cast("int").alias("rank"),
        F.transform(kinds, lambda t: F.struct(t.alias("type"))).alias("s"), F.when(k % 2 == 0, "food").otherwise("beauty").alias("vertical"), F.lit("a layout").alias("name"), (k % 100).cast("int").alias("quality_score"),
        F.array(F.lit("minimal"), F.concat(F.lit("t"), k % 2)).alias("tags"), ((k % 8) / 100.0).alias("avg_gold"), ((k % 4) / 8.0).alias("avg_maroon"), ((k % 3) / 8.0).alias("dark_ratio"), F.concat(F.lit("http://s"), k).alias("representative_source"),
    )


def planted_violations(spark: SparkSession, d: str) -> DataFrame:
    return library.violations(planted(spark, d))


PLANTED_VIOLATIONS = """WITH o AS (SELECT o_orderkey AS k, 'archetype_' || o_orderkey AS archetype_id FROM orders) SELECT 'vector_size' AS "check", archetype_id FROM o WHERE k % 7 = 0 UNION ALL SELECT 'empty_cluster', archetype_id FROM o WHERE k % 3 = 0
    UNION ALL SELECT 'too_many', archetype_id FROM o WHERE k % 20 > 15 UNION ALL SELECT 'unknown_type', archetype_id FROM o WHERE k % 5 = 0"""


def header_violations(spark: SparkSession, d: str) -> DataFrame:
    header = spark.createDataFrame([("3.0.0", None), ("2.0.0", "2001-08-01"), ("3.0.0", "2001-08-01")], "version string, generated_at string")
    some, none = planted(spark, d), planted(spark, d).where("rank < 0")
    full = library.header_violations(header, some, some).select(F.lit("full").alias("library"), "check")
    return full.unionByName(library.header_violations(header, none, some).select(F.lit("bare").alias("library"), "check"))


HEADER_VIOLATIONS = """SELECT * FROM (VALUES ('full', 'generated_at'), ('full', 'version'), ('bare', 'generated_at'), ('bare', 'version'), ('bare', 'no_archetypes'), ('bare', 'no_archetypes'), ('bare', 'no_archetypes')) v(library, "check")"""


def inspection_report(spark: SparkSession, d: str) -> DataFrame:
    return library.inspection(planted(spark, d), "food")


INSPECTION = """SELECT 'food' AS vertical, CAST(o_orderkey % 20 AS INTEGER) AS rank, 'archetype_' || o_orderkey AS archetype_id, 'a layout' AS name, o_orderkey % 3 AS cluster_size, CAST(o_orderkey % 100 AS INTEGER) AS quality_score,
    'hero_split → ' || CASE WHEN o_orderkey % 5 = 0 THEN 'no_such_type' ELSE 'marquee' END AS sections, 'minimal, t' || (o_orderkey % 2) AS tags, 'gold=0.0' || (o_orderkey % 8) || ' maroon=' || ['0.00', '0.13', '0.25', '0.38'][o_orderkey % 4 + 1] || ' dark=' || ['0', '13', '25'][o_orderkey % 3 + 1] || '%' AS palette,
    'http://s' || o_orderkey AS representative_source FROM orders WHERE o_orderkey % 2 = 0"""


def template_order(spark: SparkSession, d: str) -> DataFrame:
    comps = quality.with_effective(q.full_compositions(spark, d), q.as_of()).withColumn("effective_score", F.round("effective_score", 6))
    none = spark.createDataFrame([], "archetype_id string, comp_id long")
    return library.templates(comps, none).select("vertical", "place", "comp_id", "name")


TEMPLATE_ORDER = f"WITH {oracle.COMP_SQL} SELECT vertical, row_number() OVER (PARTITION BY vertical ORDER BY round(effective_score, 6) DESC, comp_id) AS place, comp_id, {oracle.NAME} AS name FROM comp"

SQL: dict[str, str] = {
    "element_filters": ELEMENT_FILTERS,
    "frame_builders": FRAME_BUILDERS,
    "section_roots": SECTION_ROOTS,
    "innermost_sections": INNERMOST,
    "custom_properties": CUSTOM_PROPERTIES,
    "vision_gate": f"WITH {oracle.QUALITY_SQL} SELECT comp_id, quality_score FROM scored WHERE quality_score > 40 AND comp_id % 5 BETWEEN 1 AND 3",
    "vision_override": f"""WITH {oracle.COMP_SQL}, {REPLIES_SQL} SELECT comp_id, CASE WHEN seen_vertical <> 'general' THEN seen_vertical ELSE vertical END AS vertical,
        array_to_string(tags || list_filter(CASE WHEN vibes AND NOT broken THEN ['modern', 'dark-hero'] ELSE [] END, lambda v: NOT list_contains(tags, v)), ',') AS tags, greatest(0, least(100, quality_score + boost)) AS quality_score, flag AS flagged FROM comp JOIN told USING (comp_id)""",
    "vision_details": f"""WITH {REPLIES_SQL} SELECT comp_id, CASE WHEN sees AND NOT broken THEN 'hero,grid' ELSE '' END AS seen, CASE WHEN vibes AND NOT broken THEN 'modern,dark-hero' ELSE '' END AS vibe,
        CASE WHEN broken THEN '' ELSE {_LINES.format("i || ':' || dom || ':b'", ',')} END AS details FROM told""",
    "review_report": REVIEW_REPORT,
    "screenshot_base64": "SELECT page_id, base64(encode(html)) AS screenshot FROM pages",
    "composition_ids": f"WITH {fx.COMPS_SQL} SELECT comp_id, 'comp_' || sha256(url || epoch_ms(TIMESTAMP '{fx.AS_OF}'))[1:8] AS id FROM comps",
    "raw_hints": RAW_HINTS,
    "inferred_verticals": f"WITH {oracle.COMP_SQL} SELECT comp_id, CASE WHEN comp_id % 3 = 0 THEN vertical ELSE {oracle._vertical()} END AS vertical FROM comp",
    "perceived_palette": f"""WITH {CLUSTERS_SQL} SELECT img_id, string_agg('#' || lpad(printf('%x', r), 2, '0') || lpad(printf('%x', g), 2, '0') || lpad(printf('%x', b), 2, '0'), ',' ORDER BY cluster) AS colours, first(0.299 * r + 0.587 * g + 0.114 * b < 128 ORDER BY cluster) AS is_dark_perceived FROM c GROUP BY img_id""",
    "gold_check": GOLD_CHECK,
    "painted_colours": PAINTED_COLOURS,
    "font_lists": FONT_LISTS,
    "variant_hints": VARIANT_HINTS,
    "pdp_details": PDP_DETAILS,
    "pdp_coercion": PDP_COERCION,
    "matrix_order": MATRIX_ORDER,
    "key_order": KEY_ORDER,
    "skipped_by_builder": f"WITH {fx.COMPS_SQL} SELECT CASE WHEN comp_id % 17 = 0 THEN 'builder' || (comp_id % 3) ELSE 'other' END AS builder, count(*) AS n FROM comps GROUP BY ALL",
    "planted_violations": PLANTED_VIOLATIONS,
    "header_violations": HEADER_VIOLATIONS,
    "inspection_report": INSPECTION,
    "template_order": TEMPLATE_ORDER,
}
