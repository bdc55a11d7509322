"""Structural and product-page analytics: frequencies, matrices, tiers, url health and incremental differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagecraft.functions import vocab
from pagecraft.functions.scalars import half_up
from pagecraft.operators.sections import type_from_id

HIDDEN = ("popup", "cart", "cart_drawer", "geofencing")


def percent(part: Column, whole: Column) -> Column:
    return half_up(F.try_divide(part * 100.0, whole)).cast("int")


def tier(share: Column) -> Column:
    return F.when(share >= 80, "must-have").when(share >= 50, "expected").when(share >= 30, "optional").otherwise("rare")


def without_slash(url: Column) -> Column:
    return F.regexp_replace(url, "/$", "")


def theme_hint(url: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(url, r"//([^.]+)", 1), "-theme.*$", "")


def source_kind(url: Column) -> Column:
    return F.when(url.contains("myshopify.com"), "shopify_theme_demo").otherwise("curated_d2c")


def file_name(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(url, "^https?://", ""), "[^a-zA-Z0-9]", "_")


def visible(scraped: DataFrame) -> DataFrame:
    """Scraped sections with their type, without hidden kinds and those without height."""
    return scraped.withColumn("type", type_from_id(F.col("section_id"), F.col("height"))).where(~F.col("type").isin(*HIDDEN) & (F.col("height") > 0))


def matrix_order(matrix: DataFrame) -> DataFrame:
    """pdp_matrix() rows with place: within a scope and key, the most frequent first, ties by element; keys and scopes are alphabetical."""
    return matrix.withColumn("place", F.row_number().over(Window.partitionBy("scope", "key").orderBy(F.col("pct").desc(), F.col("n").desc(), "element")))


def keys_in_order(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column with their alphabetical place. One row for each value goes to one task."""
    return df.select(column).distinct().withColumn("place", F.row_number().over(Window.orderBy(column)))


def top_counts(df: DataFrame, column: str, k: int = 20) -> DataFrame:
    """The k most frequent values with their counts, ties by value."""
    return df.groupBy(column).count().orderBy(F.col("count").desc(), column).limit(k)


def sub_verticals(comps: DataFrame, lookup: DataFrame) -> DataFrame:
    """comps with sub_vertical filled: its own, else the last of lookup (url, sub_vertical, ord), else <vertical>_general."""
    last = lookup.groupBy("url").agg(F.max(F.struct("ord", "sub_vertical"))["sub_vertical"].alias("_found"))
    own = F.nullif(F.col("sub_vertical"), F.lit(""))
    return comps.join(last, "url", "left").withColumn("sub_vertical", F.coalesce(own, F.nullif(F.col("_found"), F.lit("")), F.concat("vertical", F.lit("_general")))).drop("_found")


def section_matrix(comps: DataFrame, sections: DataFrame) -> DataFrame:
    """sub_vertical, type, n (occurrences, 0 included), stores: every type for every sub-vertical of comps."""
    stores = comps.groupBy("sub_vertical").agg(F.count("*").alias("stores"))
    counts = sections.join(comps.select("comp_id", "sub_vertical"), "comp_id").groupBy("sub_vertical", "type").agg(F.count("*").alias("n"))
    types = F.explode(F.array(*[F.lit(t) for t in vocab.SECTION_TYPES]))
    return stores.withColumn("type", types).join(counts, ["sub_vertical", "type"], "left").fillna(0, ["n"])


def essential(matrix: DataFrame, least: float = 0.7, stores: int = 2) -> DataFrame:
    return matrix.withColumn("share", F.col("n") / F.col("stores")).where((F.col("stores") >= stores) & (F.col("share") >= least))


def first_elements(pdp: DataFrame) -> DataFrame:
    """The first element of each kind on each page."""
    rank = F.row_number().over(Window.partitionBy("url", "element").orderBy("pos"))
    return pdp.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def pdp_matrix(pdp: DataFrame) -> DataFrame:
    """element, scope (overall, vertical, sub_vertical), key, n, pages, pct of pages where the element is present; pages without it count,
    cells of absent elements do not exist."""
    pages = pdp.select("url", "vertical", "sub_vertical").distinct().groupingSets([[], ["vertical"], ["sub_vertical"]], "vertical", "sub_vertical")
    level = F.grouping_id("vertical", "sub_vertical")
    pages = pages.agg(level.alias("g"), F.count("*").alias("pages")).select("g", F.coalesce("vertical", "sub_vertical", F.lit("")).alias("key"), "pages")
    sets = [["element"], ["element", "vertical"], ["element", "sub_vertical"]]
    found = first_elements(pdp).where("present").groupingSets(sets, "element", "vertical", "sub_vertical")
    found = found.agg(F.grouping_id("element", "vertical", "sub_vertical").alias("g"), F.count("*").alias("n"))
    found = found.select("element", "g", F.coalesce("vertical", "sub_vertical", F.lit("")).alias("key"), "n")
    scope = F.when(F.col("g") == 3, "overall").when(F.col("g") == 1, "vertical").otherwise("sub_vertical")
    return found.join(pages, ["g", "key"]).select("element", scope.alias("scope"), "key", "n", "pages", percent(F.col("n"), F.col("pages")).alias("pct"))


def must_have(matrix: DataFrame) -> DataFrame:
    """vertical, must_have and expected elements, the most frequent first."""
    rows = matrix.where(F.col("scope") == "vertical")
    listed = lambda test: F.transform(F.array_sort(F.collect_list(F.when(test, F.struct(-F.col("pct"), "element")))), lambda x: x["element"])
    return rows.groupBy(F.col("key").alias("vertical")).agg(listed(F.col("pct") >= 80).alias("must_have"), listed(F.col("pct").between(50, 79)).alias("expected"))


def coerced(pdp: DataFrame) -> DataFrame:
    """Elements with present as true only if it is the boolean true, details as an object (empty without one), and product_url with the
    page's own as its default. present and details are JSON texts."""
    v = F.try_parse_json("present")
    strict = F.coalesce((F.schema_of_variant(v) == "BOOLEAN") & F.try_variant_get(v, "$", "boolean"), F.lit(False))
    d = F.try_parse_json("details")
    object_ = F.when(F.coalesce(F.schema_of_variant(d).startswith("OBJECT"), F.lit(False)), F.col("details")).otherwise("{}")
    return pdp.withColumns({"present": strict, "details": object_, "product_url": F.coalesce(F.nullif(F.col("product_url"), F.lit("")), F.col("url"))})


def detail_values(pdp: DataFrame) -> DataFrame:
    """element, field, at (of the value in its list), kind, value as text, x (its number), c (pages), place and earliest (of the first
    page, as text and as url and pos), of present first elements. A list gives one row for each of its values, and one without a value
    if it is empty.

    Equal details of an element are counted first, so each is parsed once. They are counted apart by the length of their urls: of places
    of one length, the least stays the least whatever is added at the end."""
    place = F.concat("url", _six("pos"))
    texts = first_elements(pdp.select("url", "element", "pos", "present", "details")).where("present").groupBy("element", "details", F.length("url").alias("_length")).agg(F.count("*").alias("c"), F.min(place).alias("place"))
    earliest = F.struct(F.substring("place", F.lit(1), F.col("_length")).alias("url"), F.substring("place", F.col("_length") + 1, F.lit(6)).alias("pos"))
    rows = texts.select("element", "c", "place", earliest.alias("earliest"), F.coalesce(F.try_parse_json("details"), F.parse_json(F.lit("{}"))).alias("v"))
    fields = rows.select("element", "c", "place", "earliest", F.explode(F.map_entries(F.try_variant_get("v", "$", "map<string,variant>"))).alias("f"))
    each = fields.select("element", "c", "place", "earliest", F.col("f.key").alias("field"), F.col("f.value").alias("v"))
    schema = F.schema_of_variant("v")
    kind = F.when(schema == "STRING", "string").when(schema == "BOOLEAN", "boolean").when(schema.startswith("ARRAY"), "array").when(F.rlike(schema, F.lit("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")), "number")
    listed = F.when(kind == "array", F.try_variant_get("v", "$", "array<variant>")).otherwise(F.array("v"))
    flat = each.withColumn("kind", kind).select("element", "field", "c", "place", "earliest", "kind", F.posexplode_outer(listed).alias("at", "w")).withColumn("at", F.coalesce("at", F.lit(0)))
    as_ = lambda t: F.try_variant_get("w", "$", t)
    return flat.select(
        "element", "field", "at", F.coalesce("kind", F.lit("other")).alias("kind"), as_("string").alias("value"), F.when(F.col("kind") == "number", as_("double")).alias("x"), "c", F.concat("place", _six("at")).alias("place"), F.struct("earliest", "at").alias("earliest")
    )


def _six(c: str) -> Column:
    return F.lpad(F.col(c).cast("string"), 6, "0")


def detail_summary(values: DataFrame, k: int = 5) -> DataFrame:
    """element, field, kind, n (pages), most_common, distribution, true_pct, average, low, high: as the kind of the field's first value asks.
    most_common has the mode of texts or the k most frequent values of lists, distribution the k most frequent texts with counts, ties by
    the least place, which is a text: the url, then the position and the place in the list in six digits."""
    per = values.groupBy("element", "field", "value").agg(
        F.sum("c").alias("c"), F.min("place").alias("first"), F.min("earliest").alias("earliest"), F.min_by("kind", "earliest").alias("kind"), F.min("x").alias("x"), F.sum(F.when(F.col("kind") == "boolean", F.col("c")).otherwise(0)).alias("booleans"),
        F.sum(F.when(F.col("at") == 0, F.col("c")).otherwise(0)).alias("pages"),
    )
    rank = F.row_number().over(Window.partitionBy("element", "field").orderBy(F.col("value").isNull(), F.col("c").desc(), "first"))
    top = F.transform(F.array_sort(F.collect_list(F.when((F.col("rank") <= k) & F.col("value").isNotNull(), F.struct("rank", "value", "c")))), lambda t: F.concat(t["value"], F.lit(":"), t["c"]))
    names = F.transform(F.array_sort(F.collect_list(F.when((F.col("rank") <= k) & F.col("value").isNotNull(), F.struct("rank", "value")))), lambda t: t["value"])
    agg = per.withColumn("rank", rank).groupBy("element", "field").agg(
        F.min_by("kind", "earliest").alias("kind"), top.alias("top"), names.alias("names"), F.sum(F.when((F.col("value") == "true") & (F.col("booleans") > 0), F.col("booleans")).otherwise(0)).alias("trues"),
        F.sum(F.col("x") * F.col("c")).alias("total"), F.min("x").alias("low"), F.max("x").alias("high"), F.sum("pages").alias("n"),
    )
    is_ = lambda name, value: F.when(F.col("kind") == name, value)
    return agg.select(
        "element", "field", "kind", "n", is_("string", F.get("names", F.lit(0))).when(F.col("kind") == "array", F.array_join("names", ",")).alias("most_common"), is_("string", F.array_join("top", ",")).alias("distribution"),
        is_("boolean", percent(F.col("trues"), F.col("n"))).alias("true_pct"), is_("number", half_up(F.col("total") / F.col("n") * 10) / 10.0).alias("average"), is_("number", F.col("low")).alias("low"), is_("number", F.col("high")).alias("high"),
    )


def url_status(h: DataFrame) -> DataFrame:
    """Checked urls with their status, and whether they work."""
    status = (
        F.when(F.col("error").isNotNull(), "error").when(F.col("locked") | F.col("final_url").contains("/password"), "locked").when(F.col("http_status") >= 400, "http_error")
        .when((F.col("n_sections") >= 3) & (F.col("body_height") > 1000), "ok").when(F.col("n_sections") > 0, "partial").when(F.col("body_height") > 500, "no_sections").otherwise("empty")
    )
    return h.withColumn("status", status).withColumn("works", F.col("status").isin("ok", "partial"))


def demo_status(h: DataFrame) -> DataFrame:
    """Theme demos: dead, locked (kept with a flag) or live."""
    live = (F.col("n_sections") >= 3) | (F.col("body_height") > 1000)
    return h.withColumn("demo", F.when(F.col("error").isNotNull() | (F.col("http_status") >= 400), "dead").when(F.col("locked"), "locked").when(live, "live").otherwise("dead"))


def page_signals(pages: DataFrame) -> DataFrame:
    """page_id, title, h1, locked, challenge, blocked, products: facts that a page's html tells."""
    low = F.lower("html")
    return pages.select(
        "page_id", F.regexp_extract("html", r"(?i)<title>([^<]*)</title>", 1).alias("title"), F.regexp_extract("html", r"(?i)<h1[^>]*>([^<]*)</h1>", 1).alias("h1"),
        (F.col("url").contains("/password") | (low.contains("<form") & low.contains('type="password"'))).alias("locked"), F.rlike(low, F.lit("captcha|cf-challenge|are you human")).alias("challenge"),
        F.rlike(low, F.lit("access denied|not available in your country|geo-?block")).alias("blocked"), F.regexp_count(low, F.lit("<img")).alias("images"), F.regexp_count(low, F.lit("<a ")).alias("links"),
    )


def difference(left: DataFrame, right: DataFrame, on: str = "url") -> DataFrame:
    """Rows of left, repeats included, whose key is not in right; keys are compared exactly."""
    return left.join(right.select(on), on, "left_anti")
