"""The queries: each operator on whole tables. Floats are rounded to six places after all thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagecraft.functions import scalars as sc
from pagecraft.functions import vocab
from pagecraft.operators import fonts, library, palette, quality, sections, structural, vectors
from pagecraft.plans import fixtures as fx
from pagecraft.sources import readers


def r6(c: Column | str, name: str | None = None) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6).alias(name) if name else F.round(c, 6)


def as_of() -> Column:
    return F.lit(fx.AS_OF).cast("timestamp")


def nested(spark: SparkSession, d: str) -> DataFrame:
    return sections.nested(sections.confident(fx.sections(spark, d)))


def full_compositions(spark: SparkSession, d: str) -> DataFrame:
    """Everything a library needs, one row for each composition with sections."""
    signals = palette.signals(palette.top_colours(fx.colours(spark, d))).select("comp_id", "has_gold", "has_maroon", "has_saffron", F.col("gold_proportion").alias("gold"), F.col("maroon_proportion").alias("maroon"))
    rows = fx.compositions(spark, d).join(nested(spark, d), "comp_id").join(signals, "comp_id")
    dark = F.size(F.filter("s", lambda x: x["is_dark"])) * 2 > F.col("n")
    rows = rows.withColumns({"dark_theme": dark, "quality_score": quality.heuristic(), "ord": F.col("comp_id")})
    rows = rows.withColumn("tags", quality.tags(F.col("s"), F.col("n"), F.col("dark_theme"), F.col("has_gold"), F.col("has_maroon"), F.col("has_saffron")))
    vec = vectors.vector(F.col("s"), F.col("dark_theme"), F.col("gold"), F.col("maroon"), F.lit(None).cast("string"))
    return rows.withColumns({"vec": vec, "fingerprint": vectors.fingerprint(F.col("s"))})


# Sections.


def section_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.scored(nested(spark, d)).select("comp_id", F.col("n").alias("section_count"), "rhythm", "quality_score")


def section_renumber(spark: SparkSession, d: str) -> DataFrame:
    return sections.confident(fx.sections(spark, d)).select("comp_id", "pos", "type", r6("confidence", "confidence"), "is_dark")


def rhythm_transitions(spark: SparkSession, d: str) -> DataFrame:
    return sections.layout(fx.sections(spark, d)).select("comp_id", "n", "rhythm", sc.transitions(F.col("rhythm")).alias("transitions"), r6("full_width_ratio", "full_width_ratio"))


def section_tags(spark: SparkSession, d: str) -> DataFrame:
    c = full_compositions(spark, d)
    return c.select("comp_id", F.array_join("tags", ",").alias("tags"), library.name_of(F.col("tags"), F.col("vertical"), F.lit("layout")).alias("template_name"))


def vertical_inference(spark: SparkSession, d: str) -> DataFrame:
    c = full_compositions(spark, d)
    return c.select("comp_id", quality.vertical(quality.headings(F.col("s")), F.col("gold"), F.col("maroon")).alias("vertical"))


def quality_decay_gate(spark: SparkSession, d: str) -> DataFrame:
    rows = quality.scored(nested(spark, d)).join(fx.compositions(spark, d), "comp_id")
    return quality.gated(rows, as_of()).select("comp_id", "quality_score", r6("effective_score", "effective_score"))


def section_classify(spark: SparkSession, d: str) -> DataFrame:
    return sections.classified(fx.features(spark, d)).select("comp_id", "si", "type", r6("confidence", "confidence"))


def variant_infer(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    s = fx.sections(spark, d)
    full = sections.variant(c("type"), c("cols"), c("images"), c("carousel"), c("ratio") >= 0.95, c("seed") % 6 == 0)
    hint = sections.variant_hint(c("type"), c("cols"), c("carousel"), c("seed") % 6 == 0)
    return s.groupBy("type", full.alias("variant"), hint.alias("hint")).agg(F.count("*").alias("n"))


def type_from_id(spark: SparkSession, d: str) -> DataFrame:
    s = fx.scrapes(spark, d)
    return s.groupBy("section_id", sections.type_from_id(F.col("section_id"), F.col("height")).alias("type")).agg(F.count("*").alias("n"))


def two_viewports(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    desktop = fx.sections(spark, d)
    order = F.row_number().over(sections.Window.partitionBy("comp_id").orderBy("pos")) - 1
    mobile = desktop.where("seed % 5 <> 0").withColumns({"pos": order, "ratio": F.col("ratio") * 0.8, "cols": F.lit(1)})
    return desktop, mobile


def viewport_reconcile(spark: SparkSession, d: str) -> DataFrame:
    out = sections.reconciled(*two_viewports(spark, d))
    return out.select("comp_id", "pos", "type", "desktop_pos", "mobile_pos", "on_desktop", "on_mobile", "required", "is_dark", "primary_hero", "differs", r6("confidence", "confidence"), r6("prominence", "prominence"))


def reconciled_quality(spark: SparkSession, d: str) -> DataFrame:
    rec = sections.reconciled(*two_viewports(spark, d))
    hero = F.coalesce(F.bool_or(F.col("primary_hero") & F.col("type").startswith("hero")), F.lit(False))
    share = rec.groupBy("comp_id").agg(F.avg(F.col("on_mobile").cast("double")).alias("mobile_share"), hero.alias("hero_first"))
    rows = nested(spark, d).join(share, "comp_id")
    return rows.select("comp_id", quality.heuristic(F.col("mobile_share"), F.col("hero_first")).alias("quality_score"))


# Colours and fonts.


def color_scalars(spark: SparkSession, d: str) -> DataFrame:
    h = F.col("hex")
    hue, sat, light = sc.hsl(h)
    return fx.colours(spark, d).select("hex").distinct().select(
        "hex", r6(hue, "hue"), r6(sat, "saturation"), r6(light, "lightness"), sc.is_dark(h).alias("dark"), r6(sc.luminance(h), "luminance"),
        r6(sc.contrast(h, F.lit("#ffffff")), "contrast_white"), r6(sc.distance(h, F.lit("#102030")), "distance"), sc.shifted(h, -0.05).alias("darker"),
        sc.rgb_text_to_hex(F.concat(F.lit("rgb("), F.array_join(F.array(*[c.cast("string") for c in sc.channels(h)]), ", "), F.lit(")"))).alias("again"),
    )


def tone_flags(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.colours(spark, d)
    return rows.groupBy(*[sc.tone(F.col("hex"), t).alias(t) for t in sc.TONES]).agg(F.count("*").alias("n"))


def palette_topk(spark: SparkSession, d: str) -> DataFrame:
    return palette.top_colours(fx.colours(spark, d)).select("comp_id", "hex", "rank", r6("proportion", "proportion"))


def palette_signals(spark: SparkSession, d: str) -> DataFrame:
    out = palette.signals(palette.top_colours(fx.colours(spark, d)))
    return out.select("comp_id", *[f"has_{t}" for t in sc.TONES], *[r6(f"{t}_proportion", f"{t}_proportion") for t in sc.TONES])


def color_frequency(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.colours(spark, d)
    text = palette.frequencies(rows, F.lit(1.0), 10).select("comp_id", F.lit("text").alias("kind"), "hex", "rank", "frequency")
    border = rows.withColumn("border", F.when(F.col("ord") % 3 == 0, "#000000").otherwise(F.col("hex")))
    return text.unionByName(palette.accents(border).select("comp_id", F.lit("accent").alias("kind"), "hex", "rank", "frequency"))


def palettes(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.colours(spark, d)
    listed = lambda df, name: df.groupBy("comp_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "hex"))), lambda x: x["hex"]).alias(name))
    top = listed(palette.top_colours(rows), "colours")
    texts = listed(palette.frequencies(rows.where("ord % 2 = 0"), F.lit(1.0), 10), "texts")
    accents = listed(palette.frequencies(rows.where("ord % 3 = 1"), F.lit(1.0), 5), "accents")
    none = F.array().cast("array<string>")
    out = top.join(texts, "comp_id", "left").join(accents, "comp_id", "left")
    return out.select("comp_id", "colours", F.coalesce("texts", none).alias("texts"), F.coalesce("accents", none).alias("accents"), F.when(F.col("comp_id") % 5 == 0, F.col("comp_id") % 2 == 0).alias("dark_perceived"))


def palette_roles(spark: SparkSession, d: str) -> DataFrame:
    names = ["background", "surface", "text_primary", "text_secondary", "accent", "dark_bg", "is_dark_theme"]
    return palette.roles(palettes(spark, d)).select("comp_id", *names, F.array_join("colour_roles", ",").alias("roles"))


def font_usage(spark: SparkSession, d: str) -> DataFrame:
    return fonts.usage(fx.fonts(spark, d))


def font_pairing(spark: SparkSession, d: str) -> DataFrame:
    main = fonts.main_fonts(fonts.usage(fx.fonts(spark, d)))
    loaded = fonts.web_fonts(F.array(F.lit("https://fonts.googleapis.com/css?family=EuclidFlex:400,700|Open+Sans")))
    return fonts.matched(main.withColumn("loaded", loaded)).select("comp_id", "heading_font", "body_font", "pairing_id")


def kmeans_palette(spark: SparkSession, d: str) -> DataFrame:
    e = fx.table(spark, d, "embeddings")
    channel = lambda i: F.least(F.lit(255), F.greatest(F.lit(0), F.floor((F.get("embedding", F.lit(i)) + 1) * 127.5))).cast("int")
    return palette.kmeans(e.select(F.col("label").cast("long").alias("img_id"), F.col("vec_id").alias("ord"), channel(0).alias("r"), channel(1).alias("g"), channel(2).alias("b")))


# Vectors, dedup and the library.


def composition_vector(spark: SparkSession, d: str) -> DataFrame:
    vec = F.array_join(F.transform("vec", lambda x: F.round(x, 6).cast("decimal(12,6)").cast("string")), ",")
    return full_compositions(spark, d).select("comp_id", vec.alias("vec"))


def weighted_cosine_contexts(spark: SparkSession, d: str) -> DataFrame:
    c = full_compositions(spark, d)
    target = F.array(*[F.lit(1.0 if i in (1, 13, 24) else 0.5 if i > 27 else 0.0) for i in range(42)])
    return c.select("comp_id", r6(sc.weighted_cosine(F.col("vec"), target, F.col("vertical")), "similarity"), r6(sc.cosine(F.col("vec"), target), "plain"))


def fingerprint_dedup(spark: SparkSession, d: str) -> DataFrame:
    return vectors.fingerprint_dedup(full_compositions(spark, d)).select("comp_id", "ord", "fingerprint", "quality_score")


def vector_dedup(spark: SparkSession, d: str) -> DataFrame:
    first = vectors.fingerprint_dedup(quality.gated(full_compositions(spark, d), as_of()))
    return vectors.vector_dedup(first)


def build(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return library.assembled(full_compositions(spark, d), as_of())


def archetypes(spark: SparkSession, d: str) -> DataFrame:
    a = build(spark, d)["archetypes"]
    return a.select("archetype_id", "name", "vertical", "cluster_size", r6("confidence", "confidence"), "representative", F.array_join("tags", ",").alias("tags"), r6("avg_gold", "avg_gold"), r6("dark_ratio", "dark_ratio"))


def template_projection(spark: SparkSession, d: str) -> DataFrame:
    c = quality.with_effective(full_compositions(spark, d), as_of())
    t = F.explode(library.pattern(F.col("s"))).alias("t")
    return c.select("comp_id", t).select("comp_id", "t.type", "t.required", "t.background", "t.position")


def template_inverse(spark: SparkSession, d: str) -> DataFrame:
    c = full_compositions(spark, d).withColumn("sections", library.pattern(F.col("s"))).drop("s")
    back = library.from_templates(c)
    return back.select("comp_id", F.size("s").alias("n"), r6(F.aggregate("s", F.lit(0.0), lambda a, x: a + x["confidence"]), "confidence_sum"), sc.rhythm(F.col("s")).alias("rhythm"))


def library_stats(spark: SparkSession, d: str) -> DataFrame:
    c = full_compositions(spark, d)
    q = vectors.fingerprint_dedup(quality.gated(c, as_of()))
    by = q.groupingSets([["vertical"], ["source_type"]], "vertical", "source_type").agg(F.count("*").alias("n"))
    return by.select(F.coalesce("vertical", "source_type").alias("key"), "n").unionByName(c.agg(F.count("*").alias("n")).select(F.lit("all").alias("key"), "n"))


def contexts(spark: SparkSession) -> DataFrame:
    rows = [
        (1, "jewellery", "luxury", ["traditional", "dark-hero"], 40, True, False, True), (2, "fashion", "mid", ["minimal", "carousel"], 5, False, True, False),
        (3, "general", "premium", ["modern"], 12, True, True, True), (4, "food", "budget", [], 80, False, False, True),
    ]
    return spark.createDataFrame(rows, "context_id int, vertical string, price string, vibes array<string>, product_count int, has_reviews boolean, has_video boolean, many_categories boolean")


def select_topk(spark: SparkSession, d: str) -> DataFrame:
    return library.selected(build(spark, d)["archetypes"], contexts(spark))


def archetype_relevance(spark: SparkSession, d: str) -> DataFrame:
    """Compositions stand in for archetypes of one store, so that SQL can check the score."""
    c = full_compositions(spark, d).select(
        F.col("comp_id").alias("archetype_id"), "vertical", "tags", "vec", "s", "quality_score", F.col("gold").alias("avg_gold"), F.col("maroon").alias("avg_maroon"), F.col("n").alias("cluster_size")
    )
    return library.ranked(c, contexts(spark)).groupBy("context_id", "archetype_id", r6("relevance").alias("relevance")).agg(F.count("*").alias("listed"))


def library_violations(spark: SparkSession, d: str) -> DataFrame:
    return library.violations(build(spark, d)["archetypes"])


# Matrices and structural analytics.


def section_freq_matrix(spark: SparkSession, d: str) -> DataFrame:
    return structural.section_matrix(fx.compositions(spark, d), sections.confident(fx.sections(spark, d))).select("sub_vertical", "type", "n", "stores")


def few_types(sections_: DataFrame) -> DataFrame:
    """Sections folded to six types of unlike frequency, so that some are essential by the default share and others are not."""
    known = F.array(*[F.lit(t) for t in vocab.SECTION_TYPES])
    return sections_.withColumn("type", F.get(known, F.floor(F.sqrt(F.array_position(known, F.col("type")) - 1)).cast("int")))


def essential_sections(spark: SparkSession, d: str) -> DataFrame:
    c = fx.compositions(spark, d).withColumn("sub_vertical", F.concat("sub_vertical", F.col("comp_id") % 50))
    return structural.essential(structural.section_matrix(c, few_types(sections.confident(fx.sections(spark, d))))).select("sub_vertical", "type", r6("share", "share"))


def pdp_freq_matrix(spark: SparkSession, d: str) -> DataFrame:
    return structural.pdp_matrix(fx.pdp(spark, d)).withColumn("tier", structural.tier(F.col("pct")))


def supplier_pages(spark: SparkSession, d: str) -> DataFrame:
    """A product page for each supplier, with an element for each of its line items; of twelve kinds each is present on fewer pages."""
    p, k = F.col("l_partkey") % 12, F.col("l_suppkey")
    order = F.row_number().over(sections.Window.partitionBy("l_suppkey").orderBy("l_orderkey", *fx.LINE_ORDER)) - 1
    return fx.table(spark, d, "lineitem").select(
        F.concat(F.lit("http://p"), k).alias("url"), F.concat(F.lit("v"), k % 5).alias("vertical"), F.concat(F.lit("s"), k % 7).alias("sub_vertical"), order.alias("pos"), F.concat(F.lit("el"), F.lpad(p.cast("string"), 2, "0")).alias("element"), (k * 7 % 12 >= p).alias("present")
    )


def pdp_must_have(spark: SparkSession, d: str) -> DataFrame:
    m = structural.must_have(structural.pdp_matrix(supplier_pages(spark, d)))
    return m.select("vertical", F.array_join("must_have", ",").alias("must_have"), F.array_join("expected", ",").alias("expected"))


def url_health(spark: SparkSession, d: str) -> DataFrame:
    h = structural.demo_status(structural.url_status(fx.health(spark, d)))
    return h.groupBy("status", "works", "demo").agg(F.count("*").alias("n"))


def uncrawled_anti_join(spark: SparkSession, d: str) -> DataFrame:
    c = fx.compositions(spark, d)
    seen = sections.confident(fx.sections(spark, d), 0.9).select(F.concat(F.lit("http://s"), "comp_id").alias("url")).distinct()
    return structural.difference(c.select("url", "source_type"), seen)


def dead_url_removal(spark: SparkSession, d: str) -> DataFrame:
    dead = structural.url_status(fx.health(spark, d)).where("NOT works")
    return structural.difference(fx.compositions(spark, d).select("url", "vertical"), dead)


def sub_vertical_lookup(spark: SparkSession, d: str) -> DataFrame:
    c = fx.compositions(spark, d).withColumn("sub_vertical", F.when(F.col("comp_id") % 3 == 0, F.col("sub_vertical")))
    look = fx.lines(spark, d).select(F.concat(F.lit("http://s"), "l_orderkey").alias("url"), F.concat(F.lit("sv"), F.col("l_suppkey") % 7).alias("sub_vertical"), F.col("pos").alias("ord"))
    return structural.sub_verticals(c, look).select("comp_id", "sub_vertical")


def hit_rate(spark: SparkSession, d: str) -> DataFrame:
    h = structural.url_status(fx.health(spark, d))
    works, locked = F.count_if("works"), F.count_if(F.col("status") == "locked")
    return h.agg(F.count("*").alias("total"), works.alias("works"), locked.alias("locked"), structural.percent(works, F.count("*")).alias("pct"))


def theme_counts(spark: SparkSession, d: str) -> DataFrame:
    s = fx.scrapes(spark, d)
    seen = structural.visible(s).groupBy("theme", "type").agg(F.count("*").alias("n"), F.countDistinct("url").alias("stores"))
    return seen.withColumn("short", structural.without_slash(F.concat("theme", F.lit("/"))))


def skipped_gates(spark: SparkSession, d: str) -> DataFrame:
    n = sections.confident(fx.sections(spark, d)).groupBy("comp_id").agg(F.count("*").alias("n"))
    rows = fx.compositions(spark, d).join(n, "comp_id", "left").fillna(0, ["n"]).select(
        "comp_id", "n", F.when(F.col("comp_id") % 17 == 0, F.concat(F.lit("builder"), F.col("comp_id") % 3)).alias("iframe_builder"), (F.col("comp_id") % 23 == 0).alias("locked")
    )
    return quality.skipped(rows).groupBy("reason").agg(F.count("*").alias("n"))


def url_parts(spark: SparkSession, d: str) -> DataFrame:
    p = fx.table(spark, d, "pages")
    u = F.col("url")
    return p.select("page_id", structural.theme_hint(u).alias("theme"), structural.source_kind(u).alias("kind"), structural.without_slash(u).alias("bare"), structural.file_name(u).alias("file"))


def page_signals(spark: SparkSession, d: str) -> DataFrame:
    return structural.page_signals(fx.table(spark, d, "pages"))


def vision_replies(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    item = F.lit('{"position":1,"dom_said":"a","you_see":"b"}')
    body = F.concat(F.lit('{"agrees":'), F.when(k % 3 == 0, "true").otherwise("false"), F.lit(',"vertical":"food","disagreements":['), F.array_join(F.array_repeat(item, (k % 5).cast("int")), ","), F.lit("]}"))
    reply = F.when(k % 7 == 0, "sorry, no").when(k % 2 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(body)
    return fx.table(spark, d, "orders").select(k.alias("comp_id"), reply.alias("reply"))


def vision_boost(spark: SparkSession, d: str) -> DataFrame:
    v = quality.vision(vision_replies(spark, d))
    rows = quality.scored(nested(spark, d)).select("comp_id", "quality_score").join(v, "comp_id", "left")
    return rows.select("comp_id", "agrees", "vertical", "disagreements", "boost", "flagged", quality.boosted(F.col("quality_score"), F.col("boost")).alias("boosted"))


def sse_bodies(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    inner = F.concat(F.lit('{\\"k\\":'), k, F.lit("}"))
    done = F.concat(F.lit('data: {"type":"COMPLETE","status":"COMPLETED","resultJson":"'), inner, F.lit('"}'))
    late = F.lit('data: {"type":"COMPLETE","status":"COMPLETED","resultJson":"{\\"k\\":-1}"}')
    body = F.concat_ws("\n", F.lit("event: x"), F.lit('data: {"type":"PROGRESS"}'), F.lit("data: {broken"), F.when(k % 4 != 0, done), F.when(k % 6 != 0, late))
    return fx.table(spark, d, "orders").select(F.concat(F.lit("http://s"), k).alias("url"), body.alias("body"))


def sse_first_complete(spark: SparkSession, d: str) -> DataFrame:
    return readers.first_complete(sse_bodies(spark, d))


def sse_events(spark: SparkSession, d: str) -> DataFrame:
    e = readers.events(sse_bodies(spark, d))
    return e.groupBy(F.try_variant_get("event", "$.type", "string").alias("kind")).agg(F.count("*").alias("n"))


def vision_prompt(spark: SparkSession, d: str) -> DataFrame:
    line = F.transform("s", lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x["type"], F.lit(" (confidence: "), sc.half_up(x["confidence"] * 100).cast("string"), F.lit("%)")))
    return nested(spark, d).select("comp_id", F.array_join(line, "\n").alias("prompt"))


def doc_fingerprint_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs = fx.table(spark, d, "documents").select(F.col("doc_id").alias("ord"), F.col("n_chars").alias("quality_score"), F.sha2("text", 256).alias("fingerprint"), "doc_id")
    return vectors.fingerprint_dedup(docs).select("doc_id", "ord", "fingerprint")


def event_decay(spark: SparkSession, d: str) -> DataFrame:
    e = fx.table(spark, d, "events")
    value = sc.decayed(F.col("value"), F.col("ts"), F.lit("2024-07-01 00:00:00").cast("timestamp"))
    key = F.try_variant_get(F.try_parse_json("props"), "$.k", "int")
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum(value), 3).alias("decayed"), F.sum(key).alias("keys"))


def embedding_cosine_topk(spark: SparkSession, d: str) -> DataFrame:
    """Each label's three vectors that are most like its mean."""
    e = fx.table(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    mean = e.select("label", F.posexplode("v").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("x")).groupBy("label")
    mean = mean.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda t: t["x"]).alias("c"))
    rows = e.join(mean, "label").withColumn("similarity", F.round(sc.cosine(F.col("v"), F.col("c")), 6))
    rank = F.row_number().over(sections.Window.partitionBy("label").orderBy(F.col("similarity").desc(), "vec_id"))
    return rows.withColumn("rank", rank).where("rank <= 3").select("label", "rank", "vec_id", "similarity")


def visible_top_types(spark: SparkSession, d: str) -> DataFrame:
    """A report of the twenty most frequent visible types."""
    return structural.top_counts(structural.visible(fx.scrapes(spark, d)), "type").withColumnRenamed("count", "n")
