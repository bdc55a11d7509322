"""The shape of plans: what is computed once, and what meets the same rows by a cheaper way."""

import random
import re

from pyspark.sql import functions as F

from pagecraft.functions.scalars import weighted_cosine
from pagecraft.operators import library, sections
from pagecraft.plans import queries

CONTEXT = "context_id int, vertical string, price string, vibes array<string>, product_count int, has_reviews boolean, has_video boolean, many_categories boolean"


def archetypes(spark):
    rows = [(i, v, [float((i * k) % 7) / 7 for k in range(42)]) for i, v in enumerate(["fashion", "general", "food", "general", "fashion", None])]
    return spark.createDataFrame(rows, "archetype_id int, vertical string, vec array<double>")


def contexts(spark):
    rows = [(1, "fashion", "luxury", ["festive"], 4, True, False, True), (2, "general", "mid", [], 30, False, True, False), (3, None, "premium", None, 9, True, True, True)]
    return spark.createDataFrame(rows, CONTEXT)


def test_contexts_meet_their_vertical_and_the_general_archetypes(spark, monkeypatch):
    want = sorted([(1, 0), (1, 4), (1, 1), (1, 3), (2, 1), (2, 3), (2, 1), (2, 3), (3, 1), (3, 3)])
    for most in (library.CONTEXTS, 0):
        monkeypatch.setattr(library, "CONTEXTS", most)
        got = library.candidates(archetypes(spark), contexts(spark))
        assert got.columns == [*contexts(spark).columns, "archetype_id", "arch_vertical", "vec"]
        assert sorted(tuple(r) for r in got.select("context_id", "archetype_id").collect()) == want


def test_archetypes_are_computed_once_for_all_contexts(spark):
    """A join of all partitions with all computed them once for each partition of the contexts, and a union once more."""
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    a = archetypes(spark)
    counted = a.repartition(2).mapInArrow(passed, a.schema)
    assert library.candidates(counted, contexts(spark).repartition(4)).count() == 10
    assert seen.value == 6


def test_weights_of_a_context_give_the_weighted_cosine(spark):
    facts = {"tags": F.array(F.lit("x")), "s": F.array(F.struct(F.lit("marquee").alias("type"))), "quality_score": F.lit(0), "avg_gold": F.lit(0.0), "avg_maroon": F.lit(0.0), "cluster_size": F.lit(0)}
    three = contexts(spark).withColumns({"vibes": F.array().cast("array<string>")})
    got = library.ranked(archetypes(spark).withColumns(facts), three)
    points = F.when(F.col("arch_vertical") == F.col("vertical"), 40).otherwise(0) + F.when(F.col("arch_vertical") == "general", 5).otherwise(0)
    got = got.select((F.col("relevance") - points).alias("ours"), (weighted_cosine(F.col("vec"), library.target_vector(), F.col("vertical")) * 30).alias("theirs")).collect()
    assert len(got) == 10 and all(abs(r["ours"] - r["theirs"]) < 1e-9 for r in got)


def test_relevance_joins_no_partition_with_all(spark):
    from .conftest import DATA

    plan = queries.archetype_relevance(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan


def test_classifier_runs_compiled_in_any_session(spark):
    """Its methods are wider than the JVM compiles, and a session of another's making does not split them."""
    from .conftest import DATA

    other = spark.newSession()
    other.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    queries.section_classify(other, DATA)
    assert int(other.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_words_of_patterns_find_what_the_patterns_find(spark):
    patterns = list(dict.fromkeys(x for _, rules in sections.POINTS for c, _ in rules for x in sections._pieces(c)[1::2]))
    more = [r"ab?c|d{0,2}ef", r"a(b|c)+d|[x|y]z", r"colou?rs|\.\|"]
    bits = [w for p in patterns + more for a in sections._alternatives(p) for w in sections._words(a)[0]]
    bits += ["12", "3,4", " + ", " : ", "days", "hours", '"', "“", "”", "1998", " ", "x", "abcd", "ac", "ef", "yz", "color", ".|", "order", "fre", "ee shipping", "rs", "\n"]
    rng = random.Random(7)
    texts = ["", None, "ends 10 : 20", "12, + orders", "“quoted” \n", '"a quoted line"', "days : hours", "since 1998", *("".join(rng.choices(bits, k=rng.randint(1, 5))) for _ in range(3000))]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select("t", *[sections.occurs(F.col("t"), p).alias(f"p{i}") for i, p in enumerate(patterns + more)]).collect()
    # Every pattern is found somewhere and missed somewhere; $ may stand before a last line break in both.
    for i, p in enumerate(patterns + more):
        assert [r[f"p{i}"] for r in got] == [None if r["t"] is None else bool(re.search(p, r["t"])) for r in got], p
        assert len({r[f"p{i}"] for r in got if r["t"] is not None}) == 2, p


def test_plain_words_need_no_pattern(spark):
    plan = spark.range(1).select(sections.occurs(F.col("id").cast("string"), sections.PRICE).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan.upper()
