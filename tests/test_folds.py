"""Folds and iterations against plain brute force, and stored samples of the layout score."""

import hashlib
import json
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagecraft.functions import scalars as sc
from pagecraft.functions import vocab
from pagecraft.operators import fonts, normalize, palette, quality, sections, structural, vectors
from pagecraft.plans import fixtures
from pagecraft.plans import queries as q
from pagecraft.sources import readers, sinks
from pagecraft.streaming import incremental

from .conftest import DATA


def walk(desktop, mobile):
    """The viewport claims of one composition, one desktop section after another."""
    claimed, out = set(), []
    for d in desktop:
        best = None
        for m in mobile:
            if m["pos"] in claimed or m["type"] != d["type"]:
                continue
            score = 1 - abs(d["pos"] / len(desktop) - m["pos"] / len(mobile))
            if best is None or score > best[0]:
                best = (score, m["pos"])
        if best:
            claimed.add(best[1])
        out.append((d["pos"], best[1] if best else None))
    return out + [(None, m["pos"]) for m in mobile if m["pos"] not in claimed]


def test_reconcile_equals_walk(spark):
    desktop, mobile = q.two_viewports(spark, DATA)
    # Few types, so that claims compete.
    few = F.concat(F.lit("t"), F.abs(F.hash("type")) % 3)
    desktop, mobile = desktop.withColumn("type", few), mobile.withColumn("type", few)
    got = {}
    for r in sections.reconciled(desktop, mobile).collect():
        got.setdefault(r["comp_id"], []).append((r["pos"], r["desktop_pos"], r["mobile_pos"]))
    sides = {}
    for k, df in (("d", desktop), ("m", mobile)):
        for r in df.select("comp_id", "pos", "type").collect():
            sides.setdefault(r["comp_id"], {"d": [], "m": []})[k].append(r.asDict())
    for comp, s in sides.items():
        want = walk(sorted(s["d"], key=lambda r: r["pos"]), sorted(s["m"], key=lambda r: r["pos"]))
        assert [(d, m) for _, d, m in sorted(got[comp])] == want


def test_partitions_of_line_items_follow_the_files(spark, monkeypatch):
    """More files make more partitions, and nothing moves the rows again before they are reconciled; small ones are left to the session."""
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert fixtures.lines(spark, DATA).rdd.getNumPartitions() == 4
        monkeypatch.setattr(fixtures, "PART_BYTES", 10_000)
        many = fixtures.lines(spark, DATA).rdd.getNumPartitions()
        assert many > 4
        assert sections.reconciled(*q.two_viewports(spark, DATA)).rdd.getNumPartitions() in (many, 2 * many)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def cosine(a, b, vertical):
    w = np.array(vocab.weights(vertical))
    return (a * w) @ (b * w) / (np.linalg.norm(a * w) * np.linalg.norm(b * w) + 1e-8)


def test_greedy_dedup_equals_brute_force():
    rng = np.random.default_rng(1)
    x = (rng.random((400, 42)) < 0.3).astype(float) + 0.05
    verticals, quality_ = rng.choice(["jewellery", "fashion", "general"], 400).tolist(), rng.integers(0, 100, 400)
    kept = []
    for i in range(400):
        hit = next((k for k, j in enumerate(kept) if cosine(x[i], x[j], verticals[i]) > 0.7), None)
        if hit is None:
            kept.append(i)
        elif quality_[i] > quality_[kept[hit]]:
            kept[hit] = i
    assert vectors.greedy_kept(x, verticals, quality_, 0.7) == kept
    assert 10 < len(kept) < 390


@pytest.mark.parametrize("threshold", [0.92, 0.7])
def test_vector_dedup_equals_the_plain_fold(spark, threshold):
    """Few and many types, weights that shift lengths, equal vectors and equal scores; the keys lie in several tasks."""
    rng = np.random.default_rng(4)
    n = 400
    types = rng.random((n, 28)) < rng.choice([0.05, 0.15, 0.35], (n, 1)) * (np.arange(28) < 12)
    x = np.concatenate([types, rng.random((n, 14)) * rng.integers(0, 2, (n, 14))], axis=1)
    x[300:340] = x[rng.integers(0, 300, 40)]
    x[340:370, 28:] = x[:30, 28:] * 1.02
    x[340:370, :28] = x[:30, :28]
    x[0] = 0
    names = rng.choice(["jewellery", "fashion", "food", "beauty", "general", ""], n).tolist()
    quality_ = rng.integers(0, 20, n)
    want = vectors.greedy_kept(x, [v or "default" for v in names], quality_, threshold)
    rows = [(i * 7 % 1009, i, names[i] or None, int(quality_[i]), x[i].tolist()) for i in rng.permutation(n).tolist()]
    got = vectors.vector_dedup(spark.createDataFrame(rows, "comp_id long, ord long, vertical string, quality_score int, vec array<double>"), threshold).orderBy("ord").collect()
    assert [(r["comp_id"], r["ord"]) for r in got] == [(i * 7 % 1009, at) for at, i in enumerate(want)]
    assert 10 < len(want) < n - 10
    assert want != sorted(want)


def test_the_dedup_fold_compares_no_vectors(spark):
    """The step in one task gets ids and scores; the vectors are compared where their keys lie."""
    rows = spark.createDataFrame([(1, 1, "food", 1, [1.0] * 42)], "comp_id long, ord long, vertical string, quality_score int, vec array<double>")
    plan = vectors.vector_dedup(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "vec" not in plan[: plan.index("RepartitionByExpression [key")].split("MapInArrow")[1]
    assert "FlatMapGroups" not in plan


def test_greedy_clusters_equal_brute_force():
    rng = np.random.default_rng(2)
    x = (rng.random((300, 42)) < 0.4).astype(float) + 0.05
    sums, label = [], []
    for v in x:
        sims = [cosine(v, s / n, "beauty") for s, n in sums]
        at = int(np.argmax(sims)) if sims and max(sims) > 0.75 else len(sums)
        if at == len(sums):
            sums.append((np.zeros(42), 0))
        sums[at] = (sums[at][0] + v, sums[at][1] + 1)
        label.append(at)
    assert vectors.greedy_clusters(x, "beauty", 0.75).tolist() == label


def lloyd(pixels, k, steps):
    """Evenly spaced pixels as seeds, labels at first 0, the lowest cluster on ties, empty clusters stay where they are."""
    step = max(1, len(pixels) // k)
    centres = [list(map(float, pixels[min(i * step, len(pixels) - 1)])) for i in range(k)]
    label = [0] * len(pixels)
    for _ in range(steps):
        new = [min(range(k), key=lambda c: (sum((x - y) ** 2 for x, y in zip(p, centres[c], strict=True)), c)) for p in pixels]
        if new == label:
            break
        label = new
        for c in range(k):
            own = [p for p, q in zip(pixels, label, strict=True) if q == c]
            if own:
                centres[c] = [sum(x[i] for x in own) / len(own) for i in range(3)]
    n = [label.count(c) for c in range(k)]
    order = sorted(range(k), key=lambda c: -n[c])
    return [(*[int(x + 0.5) for x in centres[c]], n[c]) for c in order]


def test_kmeans_equals_a_plain_loop(spark):
    rng = np.random.default_rng(3)
    images = {1: [(10, 10, 10)] * 6 + [(200, 0, 0)], 2: [tuple(map(int, p)) for p in rng.integers(0, 256, (90, 3))], 3: [(0, 0, 0), (255, 255, 255)]}
    rows = [(i, o, *p) for i, ps in images.items() for o, p in enumerate(ps)]
    out = palette.kmeans(spark.createDataFrame(rows, "img_id long, ord long, r int, g int, b int"), k=3).collect()
    for i, ps in images.items():
        got = [(r["r"], r["g"], r["b"], r["n"]) for r in sorted((r for r in out if r["img_id"] == i), key=lambda r: r["cluster"])]
        assert got == lloyd(ps, 3, 20)


def _nested(spark, rows):
    schema = "comp_id long, pos int, type string, confidence double, is_dark boolean, ratio double, cols int, carousel boolean, images int, heading string"
    return sections.nested(sections.confident(spark.createDataFrame(rows, schema)))


def test_score_of_a_six_section_page(spark):
    types = ["announcement_bar", "hero_slideshow", "newsletter", "featured_products", "newsletter", "rich_text"]
    rows = [(1, i, t, 0.9, False, 0.5, 1, False, 0, None) for i, t in enumerate(types)]
    score = quality.scored(_nested(spark, rows)).first()["quality_score"]
    want = 50 + 10 + 9 + 5 / 6 * 10 + 10 + 8 + 3 + 10
    assert score == min(100, int(want + 0.5))


def _page(spark, rows):
    """One nested page of (type, confidence, ratio, carousel, images); also a page without sections."""
    fields = "pos int, type string, confidence double, is_dark boolean, ratio double, cols int, carousel boolean, images int, heading string"
    s = [(i, t, c, False, r, 1, k, n, None) for i, (t, c, r, k, n) in enumerate(rows)]
    return spark.createDataFrame([(1, s)], f"comp_id long, s array<struct<{fields.replace(' ', ':').replace(',:', ',')}>>").withColumn("n", F.size("s"))


def test_stored_samples(spark):
    """The two stored extractions: a shop's page with all sections on the phone too, and a locked demo without sections."""
    shop = [("trust_bar", 0.7, 0.03694581280788178, True, 4), ("newsletter", 0.75, 0.0, False, 5), ("product_carousel", 0.5, 0.0, True, 0), ("newsletter", 0.75, 0.0, False, 5), ("about_brand", 0.6, 0.0, False, 0), ("trust_bar", 0.5, 0.0, True, 4)]
    no, gold = F.lit(False), F.lit(True)
    page = _page(spark, shop).select(quality.heuristic(F.lit(1.0), no).alias("q"), quality.rhythm(F.col("s")).alias("r"), quality.tags(F.col("s"), F.col("n"), no, gold, no, no).alias("t")).first()
    assert (page["q"], page["r"], page["t"]) == (90, "LLLLLL", ["carousel", "gold-accent"])
    bare = _page(spark, []).select(quality.heuristic().alias("q"), quality.tags(F.col("s"), F.col("n"), no, no, no, no).alias("t"), quality.vertical(quality.headings(F.col("s")), F.lit(0.0), F.lit(0.0)).alias("v")).first()
    assert (bare["q"], bare["t"], bare["v"]) == (20, ["minimal"], "general")
    none = spark.createDataFrame([(1, [], [], [], None)], "comp_id long, colours array<string>, texts array<string>, accents array<string>, dark_perceived boolean")
    r = palette.roles(none).first()
    assert [r[c] for c in ("background", "surface", "text_primary", "text_secondary", "accent", "dark_bg", "is_dark_theme")] == ["#FFFFFF", "#f2f2f2", "#1A1A1A", "#4d4d4d", "#C5A455", "#1A1A1A", False]
    f = fonts.matched(spark.createDataFrame([(1, None, None, [])], "comp_id long, heading_raw string, body_raw string, loaded array<string>")).first()
    assert (f["heading_font"], f["body_font"], f["pairing_id"]) == ("Inter", "Inter", "fp_20")


def test_score_of_a_page_with_one_section(spark):
    """A password page: too few sections, no hero, nothing else; and a hero first on a phone adds its points."""
    one = _nested(spark, [(1, 0, "newsletter", 0.6, False, 0.5, 1, False, 0, None)])
    want = 50 - 20 + 6 + 10 - 10 + 3
    assert quality.scored(one).first()["quality_score"] == want
    shared = one.select("comp_id", quality.heuristic(F.lit(1.0), F.lit(True)).alias("q")).first()["q"]
    assert shared == want + 13


def test_halves_and_rhythm(spark):
    r = spark.range(1).select(
        sc.half_up(F.lit(-12.5)).alias("a"), sc.half_up(F.lit(2.5)).alias("b"), sc.transitions(F.lit("LDL")).alias("c"), sc.shifted(F.lit("#FFFFFF"), -0.05).alias("d"), sc.shifted(F.lit("#1A1A1A"), 0.2).alias("e")
    ).first()
    assert tuple(r) == (-12, 3, 1, "#f2f2f2", "#4d4d4d")


def test_library_invariants(spark):
    parts = q.build(spark, DATA)
    archs = parts["archetypes"].toPandas()
    assert len(archs) and (archs["cluster_size"] > 0).all() and (archs.groupby("vertical").size() <= 15).all()
    assert all(len(v) == 42 for v in archs["vec"])
    assert q.library_violations(spark, DATA).isEmpty()
    members = [m for ms in archs["member_ids"] for m in ms]
    assert len(members) == len(set(members))
    chosen = q.select_topk(spark, DATA).toPandas()
    assert (chosen.groupby("context_id").size() <= 3).all()


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"url": "http://a", "source": "live_store"}, {"url": "http://b", "vertical": "food"}]')
    (tmp_path / "b.json").write_text('[{"url": "http://a"}]')
    t = readers.targets(spark, [f"{tmp_path}/a.json", f"{tmp_path}/b.json", f"{tmp_path}/none.json"])
    assert t.count() == 3 and readers.targets(spark, [f"{tmp_path}/none.json"]).count() == 0
    assert not sinks.write_skipped(t.limit(0), f"{tmp_path}/s")
    assert sinks.write_skipped(t, f"{tmp_path}/s") and sinks.write_skipped(t, f"{tmp_path}/s", append=True)
    assert spark.read.parquet(f"{tmp_path}/s").count() == 6
    sinks.write_library(q.build(spark, DATA), f"{tmp_path}/lib")
    assert readers.library(spark, f"{tmp_path}/lib")["stats"].count() > 4


def test_incremental_ingest_adds_each_url_once(spark, tmp_path):
    src, out = tmp_path / "in", f"{tmp_path}/out"
    src.mkdir()
    for i, rows in enumerate((["http://a", "http://b"], ["http://b", "http://c", "http://c"])):
        (src / f"{i}.json").write_text("\n".join(f'{{"url": "{u}"}}' for u in rows))
        stream = spark.readStream.schema(readers.TARGET).json(str(src))
        incremental.ingest(spark, stream, out, f"{tmp_path}/cp", lambda df: df.select("url")).awaitTermination()
    assert sorted(r["url"] for r in spark.read.parquet(out).collect()) == ["http://a", "http://b", "http://c"]


def test_missing_values_stay_defined(spark):
    h = spark.createDataFrame([("http://a", None, None, None, None, None, None)], "url string, final_url string, http_status int, n_sections int, body_height int, locked boolean, error string")
    assert structural.url_status(h).first()["status"] == "empty"
    v = quality.vision(spark.createDataFrame([(1, None), (2, "```json\n{\"agrees\": false}\n```")], "comp_id long, reply string")).orderBy("comp_id").collect()
    assert (v[0]["boost"], v[0]["agrees"]) == (0, True) and v[1]["boost"] == 5


def _png(rows, filters):
    """A PNG of rows of pixels, each row under its filter, by the format's definition."""
    channels = len(rows[0][0])
    packed, above = b"", [0] * (len(rows[0]) * channels)
    for row, kind in zip(rows, filters, strict=True):
        flat, line = [v for p in row for v in p], []
        for i, v in enumerate(flat):
            left = flat[i - channels] if i >= channels else 0
            up, corner = above[i], above[i - channels] if i >= channels else 0
            p = left + up - corner
            near = min(((abs(p - left), 0, left), (abs(p - up), 1, up), (abs(p - corner), 2, corner)))[2]
            line.append((v - (0, left, up, (left + up) // 2, near)[kind]) % 256)
        packed += bytes([kind, *line])
        above = flat
    chunk = lambda kind, body: len(body).to_bytes(4, "big") + kind + body + zlib.crc32(kind + body).to_bytes(4, "big")
    head = len(rows[0]).to_bytes(4, "big") + len(rows).to_bytes(4, "big") + bytes([8, 2 if channels == 3 else 6, 0, 0, 0])
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(packed)) + chunk(b"IEND", b"")


def test_pixels_of_pictures(spark, tmp_path):
    rng = np.random.default_rng(4)
    small = [[tuple(map(int, rng.integers(0, 256, 3))) for _ in range(4)] for _ in range(5)]
    wide = [[(int(x), 0, 255, 128) for x in np.repeat(rng.integers(0, 256, 100), 2)] for _ in range(4)]
    (tmp_path / "a.png").write_bytes(_png(small, (0, 1, 2, 3, 4)))
    (tmp_path / "b.png").write_bytes(_png(wide, (4, 3, 2, 1)))
    (tmp_path / "c.txt").write_text("no picture")
    out = readers.pixels(spark, str(tmp_path)).collect()
    a = [(r["r"], r["g"], r["b"]) for r in sorted((r for r in out if r["path"].endswith("a.png")), key=lambda r: r["ord"])]
    b = [(r["r"], r["g"], r["b"]) for r in sorted((r for r in out if r["path"].endswith("b.png")), key=lambda r: r["ord"])]
    assert a == [p for row in small for p in row] and len(b) == 200
    means = [int((wide[y][x][0] + wide[y + 1][x][0]) / 2 + 0.5) for y in (0, 2) for x in range(0, 200, 2)]
    assert b == [(m, 0, 255) for m in means]


def test_result_readers(spark, tmp_path):
    page = {"url": "u", "brand": "b", "vertical": "v", "sub_vertical": "s", "success": True, "elements": [{"type": "badge", "present": "true", "details": '{"a":1}'}, {"type": "sticky", "present": "yes", "details": None}]}
    (tmp_path / "pdp.json").write_text(json.dumps([page, {"url": "w", "success": False, "elements": []}]))
    got = structural.coerced(readers.pdp_results(spark, f"{tmp_path}/pdp.json").withColumn("product_url", F.lit(None).cast("string"))).orderBy("pos").collect()
    assert [(r["element"], r["present"], r["details"], r["product_url"]) for r in got] == [("badge", True, '{"a":1}', "u"), ("sticky", False, "{}", "u")]
    (tmp_path / "health.json").write_text('[{"url": "u", "status": "ok", "hasShopifySections": 4, "bodyHeight": 900}]')
    assert readers.url_health(spark, f"{tmp_path}/health.json").first()["hasShopifySections"] == 4
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.url_health(spark, f"{tmp_path}/none.json").count()
    (tmp_path / "targets.json").write_text('[{"url": 5, "brand": {"no": "text"}}, {"url": [}]')
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|parse"):
        readers.pdp_targets(spark, f"{tmp_path}/targets.json").collect()
    demos = readers.theme_demos(spark, {"Dawn": ["http://d1", "http://d2"], "Craft": ["http://c1"]}).collect()
    assert sorted((r["theme_name"], r["preset"], r["url"]) for r in demos) == [("Craft", 0, "http://c1"), ("Dawn", 0, "http://d1"), ("Dawn", 1, "http://d2")]


def test_more_sinks(spark, tmp_path):
    df = spark.createDataFrame([("http://a.b/c", True, b"png"), ("http://d", False, b"")], "url string, success boolean, screenshot binary")
    sinks.write_all_and_success(df, f"{tmp_path}/r")
    assert spark.read.parquet(f"{tmp_path}/r/all").count() == 2 and spark.read.parquet(f"{tmp_path}/r/success").count() == 1
    sinks.write_named(df.drop("screenshot"), f"{tmp_path}/n")
    assert {r["name"] for r in spark.read.json(f"{tmp_path}/n").collect()} == {"a_b_c", "d"}
    sinks.write_review_queue(df.withColumnRenamed("url", "comp_id"), f"{tmp_path}/q")
    assert {r["screenshot"] for r in spark.read.json(f"{tmp_path}/q").collect()} == {"cG5n", ""}
    m = structural.pdp_matrix(q.fx.pdp(spark, DATA))
    sinks.write_pdp_matrix(m, structural.must_have(m), f"{tmp_path}/m")
    assert spark.read.parquet(f"{tmp_path}/m/must_have").count() == 5


def test_ingest_rebuilds_what_is_made_of_the_table(spark, tmp_path):
    src, seen = tmp_path / "in", []
    src.mkdir()
    (src / "0.json").write_text('{"url": "http://a"}\n{"url": "http://b"}')
    stream = spark.readStream.schema(readers.TARGET).json(str(src))
    incremental.ingest(spark, stream, f"{tmp_path}/out", f"{tmp_path}/cp", lambda df: df.select("url"), rebuild=lambda df: seen.append(df.count())).awaitTermination()
    assert seen == [2]


def test_normalised_end_to_end(spark):
    """Sections, hints, variants, tags, vertical and id of a page against what its rows say."""
    schema = "comp_id long, pos int, type string, confidence double, is_dark boolean, ratio double, cols int, carousel boolean, images int, heading string, background boolean"
    desktop = [
        (1, 0, "hero_split", 0.9, True, 0.7, 2, False, 1, "Gold rings", False), (1, 1, "featured_products", 0.8, False, 0.6, 4, False, 8, "Shop", False), (1, 2, "featured_products", 0.6, False, 0.5, 2, False, 2, None, False),
        (1, 3, "unknown", 0.9, False, 0.5, 1, False, 0, None, False), (1, 4, "newsletter", 0.3, False, 0.2, 1, False, 0, None, False),
    ]
    mobile = [(1, 0, "featured_products", 0.7, False, 0.4, 1, True, 5, None, False), (1, 1, "marquee", 0.5, True, 0.1, 1, False, 0, None, False)]
    d, m = spark.createDataFrame(desktop, schema), spark.createDataFrame(mobile, schema)
    rows = {r["pos"]: r for r in normalize.normalized_sections(d, m).collect()}
    assert [rows[i]["type"] for i in sorted(rows)] == ["hero_split", "featured_products", "featured_products", "marquee"]
    assert rows[0]["content_hints"].asDict() == {"heading": "Gold rings", "product_count": None, "has_carousel": False, "grid_columns": 2} and rows[0]["variant"] == "image_right"
    # Both product rows take the hints of the first mobile section of their type, claimed or not; that one has no heading.
    assert all(rows[i]["content_hints"].asDict() == {"heading": None, "product_count": 5, "has_carousel": True, "grid_columns": 1} for i in (1, 2))
    assert rows[1]["confidence"] == 0.8 and rows[1]["height_ratio"] == 0.4 and rows[2]["height_ratio"] == 0.5 and rows[3]["height_ratio"] == 0.1
    targets = spark.createDataFrame([(1, "http://x", "live_store", "", None)], "comp_id long, url string, source_type string, vertical string, sub_vertical string").withColumn("crawled_at", F.lit("2001-01-01").cast("timestamp"))
    palettes = spark.createDataFrame([(1, True, False, False, False, 0.0, 0.0)], "comp_id long, is_dark_theme boolean, has_gold boolean, has_maroon boolean, has_saffron boolean, gold double, maroon double")
    typed = spark.createDataFrame([(1, "Inter", "Inter", "p")], "comp_id long, heading_font string, body_font string, pairing_id string")
    out = normalize.normalized(targets, d, m, palettes, typed, F.lit("2001-08-01 00:00:00")).first()
    assert out["rhythm"] == "DLLD" and out["n"] == 4 and out["vertical"] == "jewellery" and out["tags"][:3] == ["split-hero", "dark-hero", "marquee"]
    millis = 996624000000
    assert out["id"] == "comp_" + hashlib.sha256(f"http://x{millis}".encode()).hexdigest()[:8]


def test_equally_frequent_details_go_by_their_place_as_text(spark):
    """As text, page s10 at 0 comes before page s1 at 3, though s1 is the lesser url; for texts and for the values of lists."""
    rows = [("http://s1", 3, '{"style":"a","tags":["x","p"]}'), ("http://s10", 0, '{"style":"b","tags":["y"]}'), ("http://s2", 0, '{"style":"c","tags":["x","x","y"]}')]
    pages = spark.createDataFrame([(u, "e", pos, True, x) for u, pos, x in rows], "url string, element string, pos int, present boolean, details string")
    got = {r["field"]: r for r in structural.detail_summary(structural.detail_values(pages)).collect()}
    assert (got["style"]["most_common"], got["style"]["distribution"], got["style"]["n"]) == ("b", "b:1,a:1,c:1", 3)
    assert (got["tags"]["most_common"], got["tags"]["n"]) == ("x,y,p", 3)


def test_equal_details_are_counted_before_they_are_parsed(spark):
    pages = spark.createDataFrame([(u, "e", 0, True, '{"tags":["x","p"]}') for u in ("http://s1", "http://s2", "http://s3")], "url string, element string, pos int, present boolean, details string")
    got = [(r["at"], r["value"], r["c"], r["place"]) for r in structural.detail_values(pages).orderBy("at").collect()]
    assert got == [(0, "x", 3, "http://s1000000000000"), (1, "p", 3, "http://s1000000000001")]
