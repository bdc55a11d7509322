"""Views over the shared tables in the shapes the operators take, and the same views as SQL for the oracle.

A composition is an order, its sections are the order's line items; colours, fonts, targets and scrape results derive from the
same rows. Each view is made of column expressions only, so scans stay pruned and filters are pushed down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagecraft.functions import vocab

AS_OF = "2001-08-01 00:00:00"
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
SEGMENTS = {"AUTOMOBILE": "jewellery", "BUILDING": "fashion", "FURNITURE": "food", "HOUSEHOLD": "beauty", "MACHINERY": "general"}
SOURCES = {"P": "shopify_theme_demo", "O": "live_store", "F": "curated_d2c"}
TEXTS = (
    "free shipping and easy return on orders", "customer review: they said it is loved", "subscribe to our newsletter", "shop by category and collection",
    "our story: handmade and crafted since 1998", "as seen in the press", "price rs. 499 add to cart", "follow us on instagram #community",
    "hurry, ends in 10 : 20", "\"a quoted line\"", "120+ happy customers", "plain words",
)
HEADINGS = ("Gold rings", "Summer dress edit", "Glow serum", "Organic tea", "Home living", "Phone cases", "Yoga and wellness", "Bestsellers")
FONTS = ("Arial", "Playfair Display", "Poppins", "inter", "Lorra", "Georgia", "EuclidFlex", "Open Sans", "Helvetica Neue", "dm sans")
IDS = (
    "shopify-section-header", "sections--123__announcement_bar", "template--99__featured_products_4vcgqr", "main", "shopify-section-hero-banner",
    "product-carousel", "collection-list", "rich-text", "x__main", "trust-badges", "ig-feed", "random-thing", "newsletter_signup1", "image-with-text",
)


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def pick(values: tuple, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def sql_pick(values: tuple, index: str) -> str:
    quoted = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"[{quoted}][CAST({index} AS INTEGER) + 1]"


def mapped(column: Column, values: dict[str, str]) -> Column:
    out = None
    for k, v in values.items():
        out = F.when(column == k, v) if out is None else out.when(column == k, v)
    return out


def sql_mapped(column: str, values: dict[str, str]) -> str:
    return "CASE " + column + "".join(f" WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


#: Bytes of files whose line items make one partition: some 250,000 rows, which sorts and arrays of structs hold without spilling.
PART_BYTES = 4 << 20


def by_order(items: DataFrame) -> DataFrame:
    """Line items, the ones of an order together, in as many partitions as their files ask. A few rows shuffled are many once they are
    nested or sorted, so partitions that are merged by their shuffled size would spill. Small inputs are left to the session."""
    count = int(str(items._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) // PART_BYTES
    return items.repartition(count, "l_orderkey") if count > items.sparkSession.sparkContext.defaultParallelism else items


def lines(spark: SparkSession, d: str) -> DataFrame:
    """Line items with pos, their place in the order."""
    w = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
    return by_order(table(spark, d, "lineitem")).withColumn("pos", F.row_number().over(w) - 1)


def sections(spark: SparkSession, d: str) -> DataFrame:
    """comp_id, pos, type, confidence, is_dark, ratio, cols, carousel, images, heading."""
    return lines(spark, d).select(
        F.col("l_orderkey").alias("comp_id"),
        "pos",
        pick(vocab.SECTION_TYPES, F.col("l_partkey") % 28).alias("type"),
        (F.lit(0.3) + F.col("l_discount") * 7).alias("confidence"),
        (F.col("l_returnflag") == "R").alias("is_dark"),
        (F.col("l_quantity") / 50).alias("ratio"),
        (F.col("l_suppkey") % 4 + 1).cast("int").alias("cols"),
        (F.col("l_linestatus") == "O").alias("carousel"),
        (F.col("l_partkey") % 7).cast("int").alias("images"),
        F.when(F.col("l_partkey") % 3 == 0, pick(HEADINGS, F.col("l_suppkey") % 8)).alias("heading"),
        F.col("l_suppkey").alias("seed"),
    )


LINES_SQL = f"lines AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) - 1 AS pos FROM lineitem)"
SECTIONS_SQL = f"""{LINES_SQL},
    section AS (SELECT l_orderkey AS comp_id, pos, {sql_pick(vocab.SECTION_TYPES, 'l_partkey % 28')} AS type, CAST(0.3 AS DOUBLE) + l_discount * 7 AS confidence,
        l_returnflag = 'R' AS is_dark, l_quantity / 50 AS ratio, CAST(l_suppkey % 4 + 1 AS INTEGER) AS cols, l_linestatus = 'O' AS carousel,
        CAST(l_partkey % 7 AS INTEGER) AS images, CASE WHEN l_partkey % 3 = 0 THEN {sql_pick(HEADINGS, 'l_suppkey % 8')} END AS heading, l_suppkey AS seed FROM lines)"""
#: Sections above the confidence threshold, numbered anew, and nested by composition.
KEPT_SQL = f"""{SECTIONS_SQL},
    kept AS (SELECT * REPLACE (row_number() OVER (PARTITION BY comp_id ORDER BY pos) - 1 AS pos) FROM section WHERE type <> 'unknown' AND confidence > 0.4),
    nested AS (SELECT comp_id, count(*) AS n, list({{'type': type, 'confidence': confidence, 'is_dark': is_dark, 'ratio': ratio, 'cols': cols, 'carousel': carousel, 'images': images, 'heading': heading}} ORDER BY pos) AS s
        FROM kept GROUP BY comp_id)"""


def compositions(spark: SparkSession, d: str) -> DataFrame:
    """comp_id, url, source_type, vertical, sub_vertical, crawled_at."""
    orders, customer, nation = (table(spark, d, n) for n in ("orders", "customer", "nation"))
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        F.col("o_orderkey").alias("comp_id"),
        F.concat(F.lit("http://s"), F.col("o_orderkey")).alias("url"),
        mapped(F.col("o_orderstatus"), SOURCES).alias("source_type"),
        mapped(F.col("c_mktsegment"), SEGMENTS).alias("vertical"),
        F.col("n_name").alias("sub_vertical"),
        F.col("o_orderdate").alias("crawled_at"),
    )


COMPS_SQL = f"""comps AS (SELECT o_orderkey AS comp_id, 'http://s' || o_orderkey AS url, {sql_mapped('o_orderstatus', SOURCES)} AS source_type,
        {sql_mapped('c_mktsegment', SEGMENTS)} AS vertical, n_name AS sub_vertical, o_orderdate AS crawled_at
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def _two(n: Column) -> Column:
    return F.lpad(F.lower(F.hex(n.cast("long"))), 2, "0")


def colours(spark: SparkSession, d: str) -> DataFrame:
    """comp_id, ord, hex, area, depth: one painted element for each line item."""
    hex_ = F.concat(F.lit("#"), _two(F.col("l_partkey") * 37 % 256), _two(F.col("l_suppkey") * 91 % 256), _two(F.floor(F.col("l_quantity") * 5) % 256))
    return lines(spark, d).select(
        F.col("l_orderkey").alias("comp_id"), F.col("pos").alias("ord"), hex_.alias("hex"), F.col("l_extendedprice").alias("area"), (F.col("l_linenumber") * 2).alias("depth")
    )


COLOURS_SQL = f"""{LINES_SQL},
    colour AS (SELECT l_orderkey AS comp_id, pos AS ord, '#' || lpad(lower(printf('%x', l_partkey * 37 % 256)), 2, '0') || lpad(lower(printf('%x', l_suppkey * 91 % 256)), 2, '0')
        || lpad(lower(printf('%x', CAST(floor(l_quantity * 5) AS BIGINT) % 256)), 2, '0') AS hex, l_extendedprice AS area, l_linenumber * 2 AS depth FROM lines),
    rgb AS (SELECT *, ('0x' || hex[2:3])::INTEGER AS r, ('0x' || hex[4:5])::INTEGER AS g, ('0x' || hex[6:7])::INTEGER AS b FROM colour)"""


def features(spark: SparkSession, d: str) -> DataFrame:
    """One rendered section's probes for each line item, as the classifier takes them."""
    p, s, q = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_quantity")
    return lines(spark, d).select(
        F.col("l_orderkey").alias("comp_id"), F.col("pos").alias("si"), (q * 20).alias("h"), F.lit(900.0).alias("vh"), F.lower(pick(TEXTS, p % 12)).alias("t"),
        (F.length(pick(TEXTS, p % 12)) * (s % 5 + 1)).cast("int").alias("len"), (s % 4).cast("int").alias("hd"), (p % 6).cast("int").alias("btn"), (p % 9).cast("int").alias("img"),
        (s % 5).cast("int").alias("small"), (p % 200).cast("double").alias("imgw"), (s % 5).cast("int").alias("gc"), (F.col("l_linestatus") == "O").alias("hc"),
        (p % 5).cast("int").alias("pc"), (s % 5).cast("int").alias("cl"), (p % 11 == 0).alias("inhead"), (s % 6 == 0).alias("bgimg"), (s % 7 == 0).alias("fit"), (p % 3 == 0).alias("dark"),
        (p % 13 == 0).alias("anim"), (p % 17 == 0).alias("video"), (p % 19 == 0).alias("quote"), (s % 8 == 0).alias("mail"), (s % 9 == 0).alias("ugc"), (s % 10 == 0).alias("look"),
    )


FEATURES_SQL = f"""{LINES_SQL},
    feature AS (SELECT l_orderkey AS comp_id, pos AS si, l_quantity * 20 AS h, 900.0 AS vh, lower({sql_pick(TEXTS, 'l_partkey % 12')}) AS t,
        length({sql_pick(TEXTS, 'l_partkey % 12')}) * (l_suppkey % 5 + 1) AS len, l_suppkey % 4 AS hd, l_partkey % 6 AS btn, l_partkey % 9 AS img, l_suppkey % 5 AS small,
        l_partkey % 200 AS imgw, l_suppkey % 5 AS gc, l_linestatus = 'O' AS hc, l_partkey % 5 AS pc, l_suppkey % 5 AS cl, l_partkey % 11 = 0 AS inhead, l_suppkey % 6 = 0 AS bgimg,
        l_suppkey % 7 = 0 AS fit, l_partkey % 3 = 0 AS dark, l_partkey % 13 = 0 AS anim, l_partkey % 17 = 0 AS video, l_partkey % 19 = 0 AS quote, l_suppkey % 8 = 0 AS mail,
        l_suppkey % 9 = 0 AS ugc, l_suppkey % 10 = 0 AS look FROM lines)"""


def fonts(spark: SparkSession, d: str) -> DataFrame:
    """comp_id, ord, font, heading, body, size: one text element for each line item."""
    p = F.col("l_partkey")
    return lines(spark, d).select(
        F.col("l_orderkey").alias("comp_id"), F.col("pos").alias("ord"), pick(FONTS, p % 10).alias("font"), (p % 2 == 0).alias("heading"), (p % 2 == 1).alias("body"), F.col("l_quantity").alias("size")
    )


FONTS_SQL = f"""{LINES_SQL},
    font AS (SELECT l_orderkey AS comp_id, pos AS ord, {sql_pick(FONTS, 'l_partkey % 10')} AS font, l_partkey % 2 = 0 AS heading, l_partkey % 2 = 1 AS body, l_quantity AS size FROM lines)"""


def scrapes(spark: SparkSession, d: str) -> DataFrame:
    """url, theme, section_id, height: one scraped section for each line item."""
    p = F.col("l_partkey")
    return table(spark, d, "lineitem").select(
        F.concat(F.lit("http://s"), F.col("l_orderkey"), F.lit("/")).alias("url"), F.concat(F.lit("theme"), F.col("l_suppkey") % 6).alias("theme"), pick(IDS, p % 14).alias("section_id"),
        F.when(F.col("l_quantity") > 10, F.col("l_quantity") * 10).alias("height"),
    )


SCRAPES_SQL = f"""scrape AS (SELECT 'http://s' || l_orderkey || '/' AS url, 'theme' || (l_suppkey % 6) AS theme, {sql_pick(IDS, 'l_partkey % 14')} AS section_id,
        CASE WHEN l_quantity > 10 THEN l_quantity * 10 END AS height FROM lineitem)"""


def pdp(spark: SparkSession, d: str) -> DataFrame:
    """url, vertical, sub_vertical, pos, element, present, details (JSON text): one product-page element for each line item."""
    comps = compositions(spark, d).select("comp_id", "url", "vertical", "sub_vertical")
    p = F.col("l_partkey")
    details = F.concat(
        F.lit('{"style":"style'), p % 4, F.lit('","sticky":'), F.when(F.col("l_returnflag") == "R", "true").otherwise("false"), F.lit(',"count":'), F.col("l_suppkey") % 9, F.lit("}")
    )
    own = lines(spark, d).select(F.col("l_orderkey").alias("comp_id"), "pos", F.concat(F.lit("el"), F.lpad((p % 12).cast("string"), 2, "0")).alias("element"), (F.col("l_quantity") > 15).alias("present"), details.alias("details"))
    return own.join(comps, "comp_id")


PDP_SQL = f"""{LINES_SQL}, {COMPS_SQL},
    pdp AS (SELECT url, vertical, sub_vertical, pos, 'el' || lpad((l_partkey % 12)::VARCHAR, 2, '0') AS element, l_quantity > 15 AS present,
        '{{"style":"style' || (l_partkey % 4) || '","sticky":' || CASE WHEN l_returnflag = 'R' THEN 'true' ELSE 'false' END || ',"count":' || (l_suppkey % 9) || '}}' AS details
        FROM lines JOIN comps ON comp_id = l_orderkey)"""


def health(spark: SparkSession, d: str) -> DataFrame:
    """url, final_url, http_status, n_sections, body_height, locked, error: one checked url for each order."""
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(
        F.concat(F.lit("http://s"), k).alias("url"), F.concat(F.lit("http://s"), k, F.when(k % 29 == 0, "/password").otherwise("/")).alias("final_url"),
        F.when(k % 13 == 0, 404).otherwise(200).alias("http_status"), (k % 7).cast("int").alias("n_sections"), (k % 40 * 50).cast("int").alias("body_height"),
        (k % 31 == 0).alias("locked"), F.when(k % 37 == 0, F.lit("timeout")).alias("error"),
    )


HEALTH_SQL = """health AS (SELECT 'http://s' || o_orderkey AS url, 'http://s' || o_orderkey || CASE WHEN o_orderkey % 29 = 0 THEN '/password' ELSE '/' END AS final_url,
        CASE WHEN o_orderkey % 13 = 0 THEN 404 ELSE 200 END AS http_status, o_orderkey % 7 AS n_sections, o_orderkey % 40 * 50 AS body_height, o_orderkey % 31 = 0 AS locked,
        CASE WHEN o_orderkey % 37 = 0 THEN 'timeout' END AS error FROM orders)"""
