"""Fonts: usage, resolution to known fonts, and the closest pairing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagecraft.functions import vocab
from pagecraft.functions.scalars import let


def usage(elements: DataFrame) -> DataFrame:
    """comp_id, font, heading, body, n_sizes, ord of elements (comp_id, ord, font, heading, body, size)."""
    return elements.groupBy("comp_id", "font").agg(F.bool_or("heading").alias("heading"), F.bool_or("body").alias("body"), F.count("size").alias("n_sizes"), F.min("ord").alias("ord"))


def usage_lists(elements: DataFrame) -> DataFrame:
    """comp_id, font, sizes and weights of each font's elements in their order. A font's elements are bounded by its page."""
    listed = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("ord", c))), lambda x: x[c]).alias(f"{c}s")
    return elements.groupBy("comp_id", "font").agg(listed("size"), listed("weight"))


def main_fonts(used: DataFrame) -> DataFrame:
    """comp_id, heading_raw, body_raw: the font with the most sizes of each kind, the first met on ties; null if there is none."""
    best = lambda flag: F.min(F.when(F.col(flag), F.struct(-F.col("n_sizes"), F.col("ord"), F.col("font").alias("font"))))["font"]
    return used.groupBy("comp_id").agg(best("heading").alias("heading_raw"), best("body").alias("body_raw"))


def _known() -> list[str]:
    return [f for p in vocab.FONT_PAIRINGS for f in (p[1], p[2])]


#: Edits within which a name stands for a known font.
EDITS = 3


def resolved(font: Column, loaded: Column) -> Column:
    """The font that a name stands for: an alias, a loaded web font, a known font, a known font within three edits, else itself."""

    def named(x: Column) -> Column:
        bare, low = x["bare"], x["low"]
        alias = reduce(lambda out, a: out.when(bare == a[0], a[1]), vocab.FONT_ALIASES[1:], F.when(bare == vocab.FONT_ALIASES[0][0], vocab.FONT_ALIASES[0][1]))
        web = F.get(F.filter(loaded, lambda y: F.lower(y) == low), F.lit(0))
        # Distances above the threshold are -1.
        each = [F.struct(F.levenshtein(F.lit(f.lower()), low, EDITS).alias("d"), F.lit(i).alias("i"), F.lit(f).alias("font")) for i, f in enumerate(_known())]
        near = F.array_min(F.filter(F.array(*each), lambda y: y["d"] >= 0))["font"]
        return F.coalesce(alias, web, near, F.when(bare == "", "Inter").otherwise(bare))

    bare = F.regexp_replace(F.trim(font), "['\"]", "")
    return F.when(font.isNull(), "Inter").otherwise(let(let(bare, lambda x: F.struct(x.alias("bare"), F.lower(x).alias("low"))), named))


def pairing(heading: Column, body: Column) -> Column:
    """The id of the closest pairing: both fonts equal, then the heading, then the body, then the least sum of edits."""
    known = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(id_).alias("id"), F.lit(h.lower()).alias("h"), F.lit(b.lower()).alias("b")) for i, (id_, h, b, _, _) in enumerate(vocab.FONT_PAIRINGS)])

    def closest(x: Column) -> Column:
        far = F.transform(known, lambda k: F.struct(F.levenshtein(k["h"], x["h"]).alias("dh"), F.levenshtein(k["b"], x["b"]).alias("db"), k.alias("k")))
        tier = lambda y: F.when((y["dh"] == 0) & (y["db"] == 0), 0).when(y["dh"] == 0, 1).when(y["db"] == 0, 2).otherwise(3)
        each = F.transform(far, lambda y: F.struct(tier(y).alias("tier"), F.when((y["dh"] != 0) & (y["db"] != 0), y["dh"] + y["db"]).otherwise(0).alias("d"), y["k"]["i"].alias("i"), y["k"]["id"].alias("id")))
        return F.array_min(each)["id"]

    return let(F.struct(F.lower(heading).alias("h"), F.lower(body).alias("b")), closest)


def web_fonts(hrefs: Column) -> Column:
    """The families that web-font links load: the first family parameter, split at bars, without styles, decoded."""
    one = lambda h: F.transform(F.filter(F.split(F.regexp_extract(h, "family=([^&]+)", 1), r"\|"), lambda x: x != ""), lambda x: F.try_url_decode(F.substring_index(x, ":", 1)))
    return F.flatten(F.transform(hrefs, one))


def matched(main: DataFrame) -> DataFrame:
    """main_fonts() rows with heading_font, body_font and pairing_id; loaded web fonts come as an array column."""
    out = main.withColumns({"heading_font": resolved(F.col("heading_raw"), F.col("loaded")), "body_font": resolved(F.col("body_raw"), F.col("loaded"))})
    return out.withColumn("pairing_id", pairing(F.col("heading_font"), F.col("body_font")))
