"""The pattern library: archetypes, templates, statistics, validation, and the ranked look-up over it."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagecraft.functions import vocab
from pagecraft.functions.scalars import dot, half_up, let, weights
from pagecraft.operators import quality, vectors


def name_of(tags: Column, *rest: Column) -> Column:
    return F.trim(F.concat_ws(" ", F.slice(tags, 1, 2), *rest))


def deduplicated(comps: DataFrame, threshold: float = 0.92) -> DataFrame:
    """comps without those like others. What both steps leave is written to the executors' disks once, as it is read more than once."""
    first = vectors.fingerprint_dedup(comps).localCheckpoint(storageLevel=StorageLevel.DISK_ONLY)
    return first.drop("ord").join(vectors.vector_dedup(first, threshold), "comp_id").localCheckpoint(storageLevel=StorageLevel.DISK_ONLY)


def archetypes(comps: DataFrame, per_vertical: int = 15, threshold: float = 0.80) -> tuple[DataFrame, DataFrame]:
    """(archetypes, members). comps: comp_id, ord, url, vertical, tags, s, quality_score, vec, gold, maroon, dark_theme."""
    labels = vectors.clustered(comps, threshold).select("comp_id", F.col("vertical").alias("group"), "cluster")
    rows = comps.join(labels, "comp_id")
    own = Window.partitionBy("group", "cluster")
    rows = rows.withColumn("place", F.row_number().over(own.orderBy(F.col("quality_score").desc(), "ord")))
    listed = lambda *c: F.array_sort(F.collect_list(F.struct("place", *c)))
    one = lambda c: F.max(F.when(F.col("place") == 1, F.col(c)))
    sums = rows.groupBy("group", "cluster").agg(
        F.count("*").alias("cluster_size"),
        one("comp_id").alias("representative"), one("url").alias("representative_source"), one("quality_score").alias("quality_score"), one("vec").alias("vec"),
        F.max(F.when(F.col("place") == 1, F.struct("s"))).alias("_s"), one("tags").alias("_own_tags"),
        F.slice(F.array_distinct(F.flatten(F.transform(listed("tags"), lambda x: x["tags"]))), 1, 10).alias("tags"),
        F.transform(listed("comp_id"), lambda x: x["comp_id"]).alias("member_ids"),
        F.avg("gold").alias("avg_gold"), F.avg("maroon").alias("avg_maroon"), F.avg(F.col("dark_theme").cast("double")).alias("dark_ratio"),
    )
    group = Window.partitionBy("group")
    rank = F.row_number().over(group.orderBy(F.col("cluster_size").desc(), "cluster"))
    sums = sums.withColumns({"rank": rank, "confidence": F.col("cluster_size") / F.sum("cluster_size").over(group)}).where(F.col("rank") <= per_vertical)
    out = sums.select(
        F.concat(F.lit("archetype_"), "group", F.lit("_"), F.col("rank") - 1).alias("archetype_id"),
        name_of(F.col("_own_tags"), F.col("group"), F.concat(F.lit("("), F.col("cluster_size"), F.lit(" stores)"))).alias("name"),
        F.col("group").alias("vertical"), "rank", "cluster_size", "confidence", "representative", "representative_source", F.col("_s.s").alias("s"), "tags", "quality_score", "vec",
        "member_ids", "avg_gold", "avg_maroon", "dark_ratio",
    )
    return out, out.select("archetype_id", F.explode("member_ids").alias("comp_id"))


def pattern(s: Column) -> Column:
    return F.transform(s, lambda x, i: F.struct(x["type"].alias("type"), (x["confidence"] > 0.7).alias("required"), F.when(x["is_dark"], "dark").otherwise("light").alias("background"), i.alias("position")))


def templates(comps: DataFrame, members: DataFrame) -> DataFrame:
    """Compositions as templates with place, the best first; those in no listed archetype have none."""
    joined = comps.join(members, "comp_id", "left")
    place = F.row_number().over(Window.partitionBy("vertical").orderBy(F.col("effective_score").desc(), "comp_id"))
    return joined.withColumn("place", place).select("place", "comp_id", name_of(F.col("tags"), F.col("vertical"), F.lit("layout")).alias("name"), "url", "source_type", "vertical", "sub_vertical", "tags", "quality_score", "effective_score", "archetype_id", pattern(F.col("s")).alias("sections"))


def from_templates(rows: DataFrame) -> DataFrame:
    """Compositions rebuilt from templates, with defaults where a template does not say."""
    back = F.transform(
        "sections",
        lambda x: F.struct(
            x["type"].alias("type"), F.when(x["required"], 0.8).otherwise(0.5).alias("confidence"), (x["background"] == "dark").alias("is_dark"), F.lit(0.15).alias("ratio"),
            F.lit(1).alias("cols"), F.lit(False).alias("carousel"), F.lit(0).alias("images"), F.lit(None).cast("string").alias("heading"),
        ),
    )
    return rows.withColumn("s", back)


def stats(comps: DataFrame, qualified: DataFrame, kept: DataFrame, archs: DataFrame) -> DataFrame:
    """name, key, n: the stages' counts, and the templates' by vertical and by source."""
    total = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), F.lit("").alias("key"), "n")
    by = kept.groupingSets([["vertical"], ["source_type"]], "vertical", "source_type").agg(F.grouping("vertical").alias("g"), F.count("*").alias("n"))
    by = by.select(F.when(F.col("g") == 0, "by_vertical").otherwise("by_source").alias("name"), F.coalesce("vertical", "source_type", F.lit("general")).alias("key"), "n")
    parts = [total(comps, "compositions"), total(qualified, "after_quality_filter"), total(kept, "after_dedup"), total(archs, "archetypes")]
    out = by
    for p in parts:
        out = out.unionByName(p)
    return out


def assembled(comps: DataFrame, as_of: Column, least: float = 50.0) -> dict[str, DataFrame]:
    """comps (with s, tags, quality_score, vec, fingerprint, ...) to the library's tables."""
    qualified = quality.gated(comps, as_of, least)
    kept = deduplicated(qualified)
    archs, members = archetypes(kept)
    return {"archetypes": archs, "templates": templates(kept, members), "stats": stats(comps, qualified, kept, archs)}


VERSION = "3.0.0"


def violations(archs: DataFrame, per_vertical: int = 15) -> DataFrame:
    """check, archetype_id of what breaks an invariant of the library."""
    known = F.array(*[F.lit(t) for t in vocab.SECTION_TYPES])
    checks = {
        "vector_size": F.size("vec") != 42,
        "empty_cluster": F.col("cluster_size") <= 0,
        "too_many": F.col("rank") > per_vertical,
        "unknown_type": F.exists("s", lambda x: ~F.array_contains(known, x["type"])),
    }
    found = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in checks.items()]))
    return archs.select(F.explode(found).alias("check"), "archetype_id")


def header_violations(header: DataFrame, archs: DataFrame, templates: DataFrame) -> DataFrame:
    """check of what breaks the library as a whole. header: version, generated_at."""
    counts = archs.agg(F.count("*").alias("a")).crossJoin(templates.agg(F.count("*").alias("t")))  # one row each
    checks = {
        "version": F.coalesce(F.col("version"), F.lit("")) != VERSION,
        "generated_at": F.coalesce(F.col("generated_at").cast("string"), F.lit("")) == "",
        "no_archetypes": (F.col("a") == 0) & (F.col("t") > 0),
    }
    found = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in checks.items()]))
    return header.crossJoin(counts).select(F.explode(found).alias("check"))


def inspection(archs: DataFrame, vertical: str | None = None) -> DataFrame:
    """A report of the archetypes, of one vertical or of all: names, sizes, sections, tags and palette as text, in order."""
    rows = archs if vertical is None else archs.where(F.col("vertical") == vertical)
    two = lambda c: F.format_string("%.2f", F.round(F.coalesce(c, F.lit(0.0)), 9))
    palette = F.concat(F.lit("gold="), two("avg_gold"), F.lit(" maroon="), two("avg_maroon"), F.lit(" dark="), half_up(F.col("dark_ratio") * 100).cast("string"), F.lit("%"))
    kinds = F.array_join(F.transform("s", lambda x: x["type"]), " → ")
    return rows.select("vertical", "rank", "archetype_id", "name", "cluster_size", "quality_score", kinds.alias("sections"), F.array_join("tags", ", ").alias("tags"), palette.alias("palette"), "representative_source")


# The look-up.


def target_vector() -> Column:
    """The 42 dimensions that a context (vertical, price, vibes, product_count, has_reviews, has_video, many_categories) asks for."""
    dear = F.col("price").isin("luxury", "premium")
    festive = F.arrays_overlap("vibes", F.array(*[F.lit(v) for v in ("traditional", "ethnic", "festive", "bridal")]))
    # Dimensions by number.
    at = {
        1: F.lit(1.0), 13: F.lit(1.0), 24: F.lit(1.0), 16: _one(F.col("many_categories")), 17: _one(F.col("many_categories")), 9: _one(F.col("has_reviews")), 22: _one(F.col("has_video")),
        7: _one(dear), 8: _one(dear), 18: _one(dear), 33: F.least(F.col("product_count") / F.lit(15.0), F.lit(1.0)), 34: F.when(F.col("price") == "luxury", 0.9).otherwise(0.6),
        39: F.when(festive, 0.3).otherwise(0.0), 40: F.when(festive, 0.2).otherwise(0.0),
    }
    return F.array(*[at.get(i, F.lit(0.0)) for i in range(42)])


def _one(test: Column) -> Column:
    return F.when(test, 1.0).otherwise(0.0)


#: So many contexts are sent to every task, which then reads the archetypes as they lie; more are joined by shuffling.
CONTEXTS = 10_000


def candidates(archs: DataFrame, contexts: DataFrame) -> DataFrame:
    """Each context with its vertical's archetypes and the general ones; both if they are the same. Archetypes are read once."""
    asked = contexts.withColumn("_asked", F.explode(F.array("vertical", F.lit("general"))))
    if contexts.limit(CONTEXTS + 1).count() <= CONTEXTS:
        asked = F.broadcast(asked)
    a = archs.withColumnRenamed("vertical", "arch_vertical")
    return a.join(asked, F.col("arch_vertical") == F.col("_asked")).select(*contexts.columns, *a.columns)


def relevance() -> Column:
    overlap = F.size(F.filter("tags", lambda t: F.exists("vibes", lambda v: t.contains(v) | v.contains(t))))
    vibe = lambda *names: F.arrays_overlap("vibes", F.array(*[F.lit(n) for n in names]))
    has = lambda test: F.exists("s", lambda x: test(x["type"]))
    old, new = vibe("traditional", "ethnic"), vibe("minimal", "modern")
    points = lambda test, n: F.when(test, n).otherwise(0)
    similarity = let(F.zip_with("vec", "weights", lambda x, w: x * w), lambda v: dot(v, F.col("target")) / (F.sqrt(dot(v, v)) * F.col("target_length") + F.lit(1e-8)))
    return (
        points(F.col("arch_vertical") == F.col("vertical"), 40) + points(F.col("arch_vertical") == "general", 5) + overlap * 12
        + similarity * 30 + F.least("cluster_size", F.lit(50)) * 0.3 + F.col("quality_score") * 0.15
        + points(old & (F.col("avg_gold") > 0.05), 8) + points(old & (F.col("avg_maroon") > 0.05), 8) + points(new & (F.col("avg_gold") > 0.1), -5)
        + points(has(lambda t: t.contains("testimonial")) & ~F.col("has_reviews"), -10) + points(has(lambda t: t == "video_section") & ~F.col("has_video"), -10)
        + points(has(lambda t: t.contains("category")) & ~F.col("many_categories"), -5)
    )


def ranked(archs: DataFrame, contexts: DataFrame) -> DataFrame:
    """candidates() with relevance. A context's weights, its weighted target and that one's length are computed once for the context."""
    weighed = contexts.withColumn("weights", weights(F.col("vertical"))).withColumn("target", F.zip_with(target_vector(), "weights", lambda x, w: x * w))
    return candidates(archs, weighed.withColumn("target_length", F.sqrt(dot(F.col("target"), F.col("target"))))).withColumn("relevance", relevance()).drop("weights", "target_length")


def selected(archs: DataFrame, contexts: DataFrame, count: int = 3, most: float = 0.85) -> DataFrame:
    """context_id, place, archetype_id, relevance: the most relevant, without those too like one chosen before. A context has at most
    thirty candidates."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(r=-pdf["relevance"].round(9)).sort_values(["r", "own", "rank"])
        v, length = vectors._weighted(np.stack(pdf["vec"].to_list()), pdf["vertical"].iloc[0])
        chosen: list[int] = []
        for i in range(len(pdf)):
            if len(chosen) < count and not (vectors._cosines(v[chosen], length[chosen], v[i], length[i]) > most).any():
                chosen.append(i)
        out = pdf.iloc[chosen][["context_id", "archetype_id", "relevance"]]
        return out.assign(place=range(1, len(out) + 1))[["context_id", "place", "archetype_id", "relevance"]]

    rows = ranked(archs, contexts).withColumn("own", (F.col("arch_vertical") != F.col("vertical")).cast("int"))
    return rows.select("context_id", "vertical", "archetype_id", "rank", "own", "vec", "relevance").groupBy("context_id").applyInPandas(run, "context_id long, place long, archetype_id string, relevance double")
