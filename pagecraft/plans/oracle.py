"""SQL for an independent engine that must give the rows of each query."""

from __future__ import annotations

from pagecraft.functions import vocab
from pagecraft.operators import sections
from pagecraft.plans import fixtures as fx

R6 = lambda x, name: f"round({x}, 6) AS {name}"
TYPES = "[" + ", ".join(f"'{t}'" for t in vocab.SECTION_TYPES) + "]"


def _in(values: tuple) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _first(test: str) -> str:
    """0-based index of the first section x that passes, or -1."""
    return f"coalesce(list_position(list_transform(s, lambda x: {test}), true) - 1, -1)"


HALF_UP = lambda x: f"CAST(floor(round({x}, 9) + 0.5) AS INTEGER)"
RHYTHM = "array_to_string(list_transform(s, lambda x: CASE WHEN x.is_dark THEN 'D' ELSE 'L' END), '')"
_HEIGHTS = "list_transform(s, lambda x: x.ratio)"
SCORE = f"""50.0 + CASE WHEN n BETWEEN 5 AND 15 THEN 10 WHEN n >= 3 THEN 3 ELSE -20 END + list_avg(list_transform(s, lambda x: x.confidence)) * 10
    + least(len(list_distinct(list_transform(s, lambda x: x.type)))::DOUBLE / n * 10, 10.0)
    + CASE WHEN hero IN (0, 1) THEN 10 WHEN hero = 2 THEN 3 WHEN hero < 0 THEN -10 ELSE 0 END
    + CASE WHEN product >= 0 AND product <= ceil(n / 2) THEN 8 WHEN product >= 0 THEN 2 ELSE 0 END
    + CASE WHEN trust >= 0 AND praise >= 0 AND trust < praise THEN 5 WHEN trust >= 0 THEN 2 ELSE 0 END
    + CASE WHEN cta BETWEEN 0.2 AND 0.5 THEN 7 WHEN cta > 0 THEN 3 ELSE 0 END
    + CASE WHEN len(regexp_extract_all(rhythm, 'LD|DL')) >= 2 THEN 5 WHEN len(regexp_extract_all(rhythm, 'LD|DL')) = 1 THEN 2 ELSE 0 END
    + CASE WHEN n < 4 OR share IS NULL THEN 0 WHEN share BETWEEN 0.35 AND 0.7 THEN 10 WHEN share BETWEEN 0.25 AND 0.8 THEN 5 ELSE 0 END"""
FACTS_SQL = f"""facts AS (SELECT *, {RHYTHM} AS rhythm, {_first("starts_with(x.type, 'hero')")} AS hero, {_first(f'x.type IN {_in(vocab.PRODUCT_TYPES)}')} AS product,
        {_first("x.type = 'trust_bar'")} AS trust, {_first("contains(x.type, 'testimonial')")} AS praise, len(list_filter(s, lambda x: x.type IN {_in(vocab.CTA_TYPES)}))::DOUBLE / n AS cta,
        round(list_sum({_HEIGHTS}[1:CAST(ceil(n / 2) AS INTEGER)]) / nullif(list_sum({_HEIGHTS}), 0), 9) AS share FROM nested)"""
QUALITY_SQL = f"{fx.KEPT_SQL}, {FACTS_SQL}, scored AS (SELECT *, greatest(0, least(100, {HALF_UP(SCORE)})) AS quality_score FROM facts)"

HSL_SQL = """hsl AS (SELECT *, (hi + lo) / 510.0::DOUBLE AS light,
        CASE WHEN hi = lo THEN 0.0 WHEN hi + lo > 255 THEN (hi - lo)::DOUBLE / (510 - hi - lo) ELSE (hi - lo)::DOUBLE / (hi + lo) END AS sat,
        CASE WHEN hi = lo THEN 0.0 WHEN r = hi AND g >= b THEN (g - b)::DOUBLE / (6 * (hi - lo)) WHEN r = hi THEN (g - b + 6 * (hi - lo))::DOUBLE / (6 * (hi - lo))
            WHEN g = hi THEN (b - r + 2 * (hi - lo))::DOUBLE / (6 * (hi - lo)) ELSE (r - g + 4 * (hi - lo))::DOUBLE / (6 * (hi - lo)) END AS hue,
        (0.299::DOUBLE * r + 0.587::DOUBLE * g + 0.114::DOUBLE * b) AS luma FROM (SELECT *, greatest(r, g, b) AS hi, least(r, g, b) AS lo FROM rgb))"""
COLOUR_SQL = f"{fx.COLOURS_SQL}, {HSL_SQL}"
TOP_SQL = f"""{COLOUR_SQL},
    weighed AS (SELECT comp_id, hex, any_value(r) AS r, any_value(g) AS g, any_value(b) AS b, any_value(sat) AS sat, any_value(luma) AS luma,
        sum(area * CASE WHEN depth < 5 THEN 1.0 WHEN depth < 10 THEN 0.5 ELSE 0.2 END * (1 + sat - abs(0.5 - light))) AS w FROM hsl GROUP BY comp_id, hex),
    top AS (SELECT * FROM (SELECT *, w / sum(w) OVER (PARTITION BY comp_id) AS proportion, row_number() OVER (PARTITION BY comp_id ORDER BY round(w, 6) DESC, hex) AS rank FROM weighed) WHERE rank <= 15)"""
TONE = {
    "gold": "(r > 170 AND g > 140 AND g < 220 AND b < 120 AND r > g)", "maroon": "(r > 100 AND r < 180 AND g < 50 AND b < 50)",
    "saffron": "(r > 200 AND g > 100 AND g < 180 AND b < 80)", "green": "(r < 80 AND g > 80 AND g < 160 AND b < 80)",
}
LEAST = {"gold": 0.03, "maroon": 0.05, "saffron": 0.03, "green": 0.03}
SIGNALS_SQL = "signals AS (SELECT comp_id, " + ", ".join(f"bool_or({c} AND proportion > {LEAST[t]}) AS has_{t}, sum(CASE WHEN {c} THEN proportion ELSE 0.0 END) AS {t}_proportion" for t, c in TONE.items()) + " FROM top GROUP BY comp_id)"


def _tags() -> str:
    hero = "list_filter(s, lambda x: starts_with(x.type, 'hero'))[1]"
    has = lambda t: f"list_contains(types, '{t}')"
    rules = [
        ("full-bleed-hero", f"{hero}.type = 'hero_full_bleed'"), ("split-hero", f"{hero}.type = 'hero_split'"), ("slideshow", f"{hero}.type = 'hero_slideshow'"), ("minimal-hero", f"{hero}.type = 'hero_minimal'"),
        ("dark-hero", f"{hero}.is_dark"), ("tall-hero", f"{hero}.ratio > 0.8"), ("marquee", has("marquee")), ("carousel", "len(list_filter(s, lambda x: contains(x.type, 'carousel') OR x.carousel)) > 0"),
        ("video", has("video_section")), ("ugc", has("ugc_gallery")), ("lookbook", has("lookbook")), ("urgency", has("countdown_timer")), ("minimal", "n <= 5"), ("content-rich", "n >= 10"), ("dark-theme", "dark * 2 > n"),
        ("gold-accent", "has_gold"), ("maroon", "has_maroon"), ("saffron", "has_saffron"), ("dark-sections", "dark::DOUBLE / n > 0.3"), ("editorial", "len(list_filter(s, lambda x: x.ratio > 0.9)) > 0"),
    ]
    return "list_filter([" + ", ".join(f"CASE WHEN {test} THEN '{tag}' END" for tag, test in rules) + "], lambda t: t IS NOT NULL)"


_VEC = (
    "list_transform(" + TYPES + ", lambda t: CASE WHEN list_contains(types, t) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) || ["
    "list_sum(list_transform(s, lambda x: CASE WHEN x.images > 3 THEN x.images ELSE 0 END))::DOUBLE / n / 10, list_sum(list_transform(s, lambda x: coalesce(length(x.heading), 0)))::DOUBLE / n / 100, "
    "len(list_filter(s, lambda x: x.carousel))::DOUBLE / n, (0.2::DOUBLE * dark + 0.8::DOUBLE * (n - dark)) / n, dark::DOUBLE / n, least(n / 15.0::DOUBLE, 1.0::DOUBLE), "
    "coalesce(list_filter(s, lambda x: starts_with(x.type, 'hero'))[1].ratio, 0.0), CASE WHEN len(list_filter(s, lambda x: x.carousel)) > 0 THEN 1.0 ELSE 0.0 END, "
    "CASE WHEN list_contains(types, 'marquee') THEN 1.0 ELSE 0.0 END, least(list_max(list_transform(s, lambda x: x.cols)) / 4.0::DOUBLE, 1.0::DOUBLE), CASE WHEN dark * 2 > n THEN 1.0 ELSE 0.0 END, gold_proportion, maroon_proportion, 0.5]"
)
_CTA10 = f"len(list_filter(s, lambda x: x.type IN {_in(vocab.FINGERPRINT_CTA)}))::DOUBLE / n * 10"
COMP_SQL = f"""{QUALITY_SQL}, {TOP_SQL.replace(fx.LINES_SQL + ',', '', 1)}, {SIGNALS_SQL}, {fx.COMPS_SQL},
    typed AS (SELECT *, list_transform(s, lambda x: x.type) AS types, len(list_filter(s, lambda x: x.is_dark)) AS dark FROM scored JOIN comps USING (comp_id) JOIN signals USING (comp_id)),
    comp AS (SELECT *, {_tags()} AS tags, {_VEC} AS vec, array_to_string(types, '→') || '|' || rhythm || '|' || {HALF_UP(_CTA10)} AS fingerprint,
        quality_score * pow(0.5, date_diff('microsecond', crawled_at, TIMESTAMP '{fx.AS_OF}') / 86400000000.0::DOUBLE / 180.0) AS effective_score FROM typed)"""
NAME = "trim(concat_ws(' ', array_to_string(tags[1:2], ' '), vertical, 'layout'))"


def _vertical() -> str:
    text = "lower(array_to_string(list_transform(s, lambda x: coalesce(x.heading, '')), ' '))"
    words = " ".join(f"WHEN regexp_matches({text}, '{w}') THEN '{v}'" for v, w in vocab.VERTICAL_WORDS)
    return f"CASE WHEN gold_proportion > 0.1 THEN 'jewellery' WHEN maroon_proportion > 0.1 THEN 'fashion' {words} ELSE 'general' END"


def _weights() -> str:
    lists = {v: "[" + ", ".join(f"{w}::DOUBLE" for w in vocab.weights(v)) + "]" for v in (*vocab.VERTICAL_WEIGHTS, "default")}
    return "CASE vertical " + " ".join(f"WHEN '{v}' THEN {lists[v]}" for v in vocab.VERTICAL_WEIGHTS) + f" ELSE {lists['default']} END"


def _cos(a: str, b: str) -> str:
    dot = lambda x, y: f"list_sum(list_transform(range(1, 43), lambda i: {x}[i] * {y}[i]))"
    return f"{dot(a, b)} / (sqrt({dot(a, a)}) * sqrt({dot(b, b)}) + 1e-8)"


def _wcos(a: str, b: str) -> str:
    dot = lambda x, y: f"list_sum(list_transform(range(1, 43), lambda i: {x}[i] * w[i] * {y}[i] * w[i]))"
    return f"{dot(a, b)} / (sqrt({dot(a, a)}) * sqrt({dot(b, b)}) + 1e-8)"


def _classify() -> str:
    best = ", ".join(f"{{'points': {sections.points_sql(rules, lambda p: f"regexp_matches(t, '{p}')")}, 'ord': {-i}, 'type': '{name}'}}" for i, (name, rules) in enumerate(sections.POINTS))
    return f"""WITH {fx.FEATURES_SQL}, b AS (SELECT comp_id, si, list_max([{best}]) AS best FROM feature)
        SELECT comp_id, si, CASE WHEN best.points >= 25 THEN best.type ELSE 'unknown' END AS type, CASE WHEN best.points >= 25 THEN least(best.points / 100.0::DOUBLE, 1.0) ELSE 0.0 END AS confidence FROM b"""


def _id_type() -> str:
    rules = []
    for kind, *alts in vocab.ID_RULES:
        test = " OR ".join("(" + " AND ".join(f"contains(c, '{w}')" for w in a.split("+")) + ")" for a in alts)
        rules.append(f"WHEN {test} THEN '{kind}'")
    return "CASE " + " ".join(rules) + " WHEN c = 'main' OR ends_with(c, '__main') THEN 'main_content' WHEN coalesce(height, 0) = 0 THEN 'app_embed' ELSE 'unknown' END"


ID_SQL = f"""{fx.SCRAPES_SQL}, bare AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(section_id), 'shopify-section-', ''), 'sections--\\d+__', ''), 'template--\\d+__', ''),
        '_[a-z0-9]{{6,}}$', '') AS c FROM scrape), typed_id AS (SELECT *, {_id_type()} AS type FROM bare)"""

VARIANT = """CASE type WHEN 'hero_full_bleed' THEN CASE WHEN bg THEN 'gradient_texture' ELSE 'solid_overlay' END WHEN 'hero_split' THEN CASE WHEN cols <> 2 THEN 'asymmetric' WHEN images > 0 THEN 'image_right' ELSE 'image_left' END
    WHEN 'hero_slideshow' THEN 'slide' WHEN 'hero_bento' THEN CASE WHEN images >= 4 THEN 'asymmetric' WHEN cols >= 2 THEN '2x2' ELSE '3_panel' END WHEN 'hero_minimal' THEN CASE WHEN cols >= 2 THEN 'left_aligned' ELSE 'centered' END
    WHEN 'featured_products' THEN CASE WHEN cols >= 4 THEN 'grid_editorial' WHEN cols <= 2 THEN 'grid_minimal' ELSE 'grid_compact' END WHEN 'product_carousel' THEN CASE WHEN ratio >= 0.95 THEN 'full_width' ELSE 'standard' END
    WHEN 'testimonial_cards' THEN CASE WHEN carousel THEN 'carousel' WHEN cols >= 3 THEN 'masonry' ELSE 'grid' END WHEN 'category_grid' THEN CASE WHEN cols >= 4 THEN '4col' WHEN cols = 3 THEN '3col' ELSE '2col' END
    WHEN 'image_with_text' THEN CASE WHEN cols >= 2 THEN 'image_left' ELSE 'overlapping' END END"""
HINT = """CASE WHEN type = 'hero_full_bleed' AND bg THEN 'gradient_texture' WHEN type = 'hero_full_bleed' THEN 'solid_overlay' WHEN type = 'hero_split' AND cols = 2 THEN 'image_right' WHEN type = 'hero_slideshow' AND carousel THEN 'slide'
    WHEN type = 'featured_products' AND cols >= 4 THEN 'grid_editorial' WHEN type = 'featured_products' AND cols <= 2 THEN 'grid_minimal' WHEN type = 'product_carousel' AND carousel THEN 'standard'
    WHEN type = 'testimonial_cards' THEN CASE WHEN carousel THEN 'carousel' ELSE 'grid' END WHEN type = 'category_grid' THEN CASE WHEN cols >= 4 THEN '4col' WHEN cols = 3 THEN '3col' ELSE '2col' END
    WHEN type = 'image_with_text' AND cols = 2 THEN 'image_left' END"""

_LIN = lambda c: f"CASE WHEN {c} / 255.0::DOUBLE <= 0.03928 THEN {c} / 255.0::DOUBLE / 12.92 ELSE pow(({c} / 255.0::DOUBLE + 0.055) / 1.055, 2.4) END"
_REL = f"(0.2126 * ({_LIN('r')}) + 0.7152 * ({_LIN('g')}) + 0.0722 * ({_LIN('b')}))"
_HEX = lambda r, g, b: "'#' || " + " || ".join(f"lpad(printf('%x', CAST({c} AS BIGINT)), 2, '0')" for c in (r, g, b))
_SHIFT = lambda h, n: "'#' || " + " || ".join(f"lpad(printf('%x', CAST(greatest(0, least(255, ('0x' || {h}[{i}:{i + 1}])::INTEGER + ({n}))) AS BIGINT)), 2, '0')" for i in (2, 4, 6))


def _ch(h: str) -> tuple[str, str, str]:
    return tuple(f"('0x' || {h}[{i}:{i + 1}])::INTEGER" for i in (2, 4, 6))


def _dist(a: str, b: str) -> str:
    return "sqrt(" + " + ".join(f"pow({x} - {y}, 2)" for x, y in zip(_ch(a), _ch(b), strict=True)) + ")"


def _luma(h: str) -> str:
    r, g, b = _ch(h)
    return f"(0.299::DOUBLE * {r} + 0.587::DOUBLE * {g} + 0.114::DOUBLE * {b})"


def _sat(h: str) -> str:
    r, g, b = (f"{c} / 255.0::DOUBLE" for c in _ch(h))
    hi, lo = f"greatest({r}, {g}, {b})", f"least({r}, {g}, {b})"
    return f"round(CASE WHEN {hi} = {lo} THEN 0 WHEN ({hi} + {lo}) / 2 > 0.5 THEN ({hi} - {lo}) / (2 - {hi} - {lo}) ELSE ({hi} - {lo}) / ({hi} + {lo}) END, 9)"


def _ranked(name: str, where: str, k: int) -> str:
    return f"""{name} AS (SELECT comp_id, list(hex ORDER BY rank) AS {name} FROM (SELECT comp_id, hex, row_number() OVER (PARTITION BY comp_id ORDER BY count(*) DESC, hex) AS rank FROM colour WHERE {where} GROUP BY comp_id, hex)
        WHERE rank <= {k} GROUP BY comp_id)"""


def _best(arr: str) -> str:
    return f"list_sort(list_transform({arr}, lambda x, i: {{'s': -{_sat('x')}, 'i': i, 'hex': x}}))[1]"


ROLES = f"""WITH {TOP_SQL}, cs AS (SELECT comp_id, list(hex ORDER BY rank) AS c FROM top GROUP BY comp_id), {_ranked('texts', 'ord % 2 = 0', 10)}, {_ranked('accents', 'ord % 3 = 1', 5)},
    a AS (SELECT comp_id, c, coalesce(texts, []) AS t, coalesce(accents, []) AS acc, CASE WHEN comp_id % 5 = 0 THEN comp_id % 2 = 0 ELSE {_luma('c[1]')} < 128 END AS is_dark_theme, c[1] AS background FROM cs LEFT JOIN texts USING (comp_id) LEFT JOIN accents USING (comp_id)),
    b AS (SELECT *, coalesce(list_filter(c[2:], lambda x: abs({_luma('x')} - {_luma('background')}) / 255.0 < 0.3 AND {_dist('x', 'background')} > 20)[1], CASE WHEN is_dark_theme THEN {_SHIFT('background', 13)} ELSE {_SHIFT('background', -13)} END) AS surface,
        coalesce(t[1], CASE WHEN is_dark_theme THEN '#FFFFFF' ELSE '#1A1A1A' END) AS text_primary, {_best(f"list_filter(c, lambda x: x <> background AND {_dist('x', 'background')} > 40)")} AS best FROM a),
    d AS (SELECT *, coalesce(list_filter(t, lambda x: {_dist('x', 'text_primary')} > 30)[1], CASE WHEN is_dark_theme THEN {_SHIFT('text_primary', -51)} ELSE {_SHIFT('text_primary', 51)} END) AS text_secondary,
        CASE WHEN len(acc) > 0 THEN {_best('acc')}.hex WHEN -best.s > 0.2 THEN best.hex ELSE '#C5A455' END AS accent,
        coalesce(list_filter(c, lambda x: {_luma('x')} < 128 AND x <> background)[1], CASE WHEN is_dark_theme THEN '#000000' ELSE '#1A1A1A' END) AS dark_bg FROM b)
    SELECT comp_id, background, surface, text_primary, text_secondary, accent, dark_bg, is_dark_theme, array_to_string(list_transform(c[1:8], lambda x: CASE WHEN x = background THEN 'background' WHEN x = surface THEN 'surface'
        WHEN x = accent THEN 'accent' WHEN x = text_primary THEN 'text' WHEN x = dark_bg THEN 'dark_sections' WHEN {_luma('x')} < 128 THEN 'dark_element' ELSE 'decorative' END), ',') AS roles FROM d"""

_FONT_LIST = "[" + ", ".join(f"'{f}'" for p in vocab.FONT_PAIRINGS for f in (p[1], p[2])) + "]"
_PAIRS = "(VALUES " + ", ".join(f"({i}, '{p[0]}', '{p[1].lower()}', '{p[2].lower()}')" for i, p in enumerate(vocab.FONT_PAIRINGS)) + ") AS p(i, id, h, b)"


def _resolve(c: str) -> str:
    alias = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in vocab.FONT_ALIASES)
    near = f"list_min(list_transform({_FONT_LIST}, lambda f, i: {{'d': levenshtein(lower(f), lower({c})), 'i': i, 'f': f}}))"
    return f"CASE WHEN {c} IS NULL THEN 'Inter' ELSE coalesce(CASE {c} {alias} END, list_filter(['EuclidFlex', 'Open Sans'], lambda x: lower(x) = lower({c}))[1], CASE WHEN {near}.d <= 3 THEN {near}.f END, {c}) END"


FONT_PAIRING = f"""WITH {fx.FONTS_SQL}, used AS (SELECT comp_id, font, bool_or(heading) AS heading, bool_or(body) AS body, count(size) AS n_sizes, min(ord) AS ord FROM font GROUP BY comp_id, font),
    main AS (SELECT comp_id, arg_min(font, -n_sizes * 1000 + ord) FILTER (heading) AS hr, arg_min(font, -n_sizes * 1000 + ord) FILTER (body) AS br FROM used GROUP BY comp_id),
    res AS (SELECT comp_id, {_resolve('hr')} AS heading_font, {_resolve('br')} AS body_font FROM main),
    pairs AS (SELECT DISTINCT heading_font, body_font FROM res),
    ids AS (SELECT heading_font, body_font, arg_min(id, CASE WHEN h = lower(heading_font) AND b = lower(body_font) THEN i WHEN h = lower(heading_font) THEN 100 + i WHEN b = lower(body_font) THEN 200 + i
        ELSE 1000 + 100 * (levenshtein(h, lower(heading_font)) + levenshtein(b, lower(body_font))) + i END) AS pairing_id FROM pairs, {_PAIRS} GROUP BY ALL)
    SELECT comp_id, heading_font, body_font, pairing_id FROM res JOIN ids USING (heading_font, body_font)"""

STATUS = "CASE WHEN error IS NOT NULL THEN 'error' WHEN locked OR contains(final_url, '/password') THEN 'locked' WHEN http_status >= 400 THEN 'http_error' WHEN n_sections >= 3 AND body_height > 1000 THEN 'ok' WHEN n_sections > 0 THEN 'partial' WHEN body_height > 500 THEN 'no_sections' ELSE 'empty' END"
_PCT = lambda a, b: f"CAST(floor(100.0::DOUBLE * ({a}) / ({b}) + 0.5) AS INTEGER)"
PDP_MATRIX = f"""{fx.PDP_SQL}, fe AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url, element ORDER BY pos) AS rn FROM pdp_in) WHERE rn = 1),
    pages AS (SELECT 'overall' AS scope, '' AS key, count(DISTINCT url) AS pages FROM pdp_in UNION ALL SELECT 'vertical', vertical, count(DISTINCT url) FROM pdp_in GROUP BY vertical UNION ALL SELECT 'sub_vertical', sub_vertical, count(DISTINCT url) FROM pdp_in GROUP BY sub_vertical),
    cells AS (SELECT element, 'overall' AS scope, '' AS key, count(*) AS n FROM fe WHERE present GROUP BY element UNION ALL SELECT element, 'vertical', vertical, count(*) FROM fe WHERE present GROUP BY ALL UNION ALL SELECT element, 'sub_vertical', sub_vertical, count(*) FROM fe WHERE present GROUP BY ALL),
    matrix AS (SELECT element, scope, key, n, pages, {_PCT('n', 'pages')} AS pct FROM cells JOIN pages USING (scope, key))"""
_CONTEXT = """ctx(context_id, vertical, price, vibes, product_count, has_reviews, has_video, many) AS (VALUES (1, 'jewellery', 'luxury', ['traditional', 'dark-hero'], 40, true, false, true),
    (2, 'fashion', 'mid', ['minimal', 'carousel'], 5, false, true, false), (3, 'general', 'premium', ['modern'], 12, true, true, true), (4, 'food', 'budget', []::VARCHAR[], 80, false, false, true))"""
_AT = {1: "1", 13: "1", 24: "1", 16: "many::INT", 17: "many::INT", 9: "has_reviews::INT", 22: "has_video::INT", 7: "dear::INT", 8: "dear::INT", 18: "dear::INT", 33: "least(product_count / 15.0::DOUBLE, 1)",
       34: "CASE WHEN price = 'luxury' THEN 0.9 ELSE 0.6 END", 39: "CASE WHEN festive THEN 0.3 ELSE 0 END", 40: "CASE WHEN festive THEN 0.2 ELSE 0 END"}
RELEVANCE = f"""WITH {COMP_SQL}, {_CONTEXT}, c2 AS (SELECT *, price IN ('luxury', 'premium') AS dear, list_has_any(vibes, ['traditional', 'ethnic', 'festive', 'bridal']) AS festive FROM ctx),
    c3 AS (SELECT *, [{', '.join(f'({_AT.get(i, "0")})::DOUBLE' for i in range(42))}] AS target, {_weights()} AS w FROM c2),
    cand AS (SELECT c3.*, comp.* RENAME (vertical AS av) FROM c3 JOIN comp ON comp.vertical = c3.vertical UNION ALL SELECT c3.*, comp.* RENAME (vertical AS av) FROM c3 JOIN comp ON comp.vertical = 'general')
    SELECT context_id, comp_id AS archetype_id, round(CASE WHEN av = vertical THEN 40 ELSE 0 END + CASE WHEN av = 'general' THEN 5 ELSE 0 END
        + 12 * len(list_filter(tags, lambda t: len(list_filter(vibes, lambda v: contains(t, v) OR contains(v, t))) > 0)) + 30 * ({_wcos('vec', 'target')}) + least(n, 50) * 0.3::DOUBLE + quality_score * 0.15::DOUBLE
        + CASE WHEN list_has_any(vibes, ['traditional', 'ethnic']) THEN CASE WHEN gold_proportion > 0.05 THEN 8 ELSE 0 END + CASE WHEN maroon_proportion > 0.05 THEN 8 ELSE 0 END ELSE 0 END
        + CASE WHEN list_has_any(vibes, ['minimal', 'modern']) AND gold_proportion > 0.1 THEN -5 ELSE 0 END
        + CASE WHEN NOT has_reviews AND len(list_filter(types, lambda t: contains(t, 'testimonial'))) > 0 THEN -10 ELSE 0 END + CASE WHEN NOT has_video AND list_contains(types, 'video_section') THEN -10 ELSE 0 END
        + CASE WHEN NOT many AND len(list_filter(types, lambda t: contains(t, 'category'))) > 0 THEN -5 ELSE 0 END, 6) AS relevance, count(*) AS listed FROM cand GROUP BY ALL"""

SQL: dict[str, str] = {
    "section_quality": f"WITH {QUALITY_SQL} SELECT comp_id, CAST(n AS INTEGER) AS section_count, rhythm, quality_score FROM scored",
    "section_renumber": f"WITH {fx.KEPT_SQL} SELECT comp_id, pos, type, {R6('confidence', 'confidence')}, is_dark FROM kept",
    "rhythm_transitions": f"""WITH {fx.SECTIONS_SQL}, g AS (SELECT comp_id, count(*) AS n, string_agg(CASE WHEN is_dark THEN 'D' ELSE 'L' END, '' ORDER BY pos) AS rhythm, avg(CASE WHEN ratio >= 0.95 THEN 1.0 ELSE 0.0 END) AS f FROM section GROUP BY comp_id)
        SELECT comp_id, n, rhythm, len(regexp_extract_all(rhythm, 'LD|DL')) AS transitions, {R6('f', 'full_width_ratio')} FROM g""",
    "section_tags": f"WITH {COMP_SQL} SELECT comp_id, array_to_string(tags, ',') AS tags, {NAME} AS template_name FROM comp",
    "vertical_inference": f"WITH {COMP_SQL} SELECT comp_id, {_vertical()} AS vertical FROM comp",
    "quality_decay_gate": f"WITH {COMP_SQL} SELECT comp_id, quality_score, {R6('effective_score', 'effective_score')} FROM comp WHERE effective_score >= 50",
    "section_classify": _classify(),
    "variant_infer": f"WITH {fx.SECTIONS_SQL}, v AS (SELECT *, seed % 6 = 0 AS bg FROM section) SELECT type, {VARIANT} AS variant, {HINT} AS hint, count(*) AS n FROM v GROUP BY ALL",
    "type_from_id": f"WITH {ID_SQL} SELECT section_id, type, count(*) AS n FROM typed_id GROUP BY ALL",
    "color_scalars": f"""WITH {COLOUR_SQL} SELECT DISTINCT hex, {R6('hue', 'hue')}, {R6('sat', 'saturation')}, {R6('light', 'lightness')}, luma < 128 AS dark, {R6('luma / 255.0', 'luminance')},
        {R6(f'1.05 / ({_REL} + 0.05)', 'contrast_white')}, {R6('sqrt(pow(r - 16, 2) + pow(g - 32, 2) + pow(b - 48, 2))', 'distance')}, {_SHIFT('hex', -13)} AS darker, hex AS again FROM hsl""",
    "tone_flags": f"WITH {COLOUR_SQL} SELECT {', '.join(f'{c} AS {t}' for t, c in TONE.items())}, count(*) AS n FROM hsl GROUP BY ALL",
    "palette_topk": f"WITH {TOP_SQL} SELECT comp_id, hex, rank, {R6('proportion', 'proportion')} FROM top",
    "palette_signals": f"WITH {TOP_SQL}, {SIGNALS_SQL} SELECT comp_id, {', '.join(f'has_{t}' for t in TONE)}, {', '.join(R6(f'{t}_proportion', f'{t}_proportion') for t in TONE)} FROM signals",
    "color_frequency": f"""WITH {fx.COLOURS_SQL}, t AS (SELECT comp_id, 'text' AS kind, hex, count(*)::DOUBLE AS frequency FROM colour GROUP BY comp_id, hex),
        a AS (SELECT comp_id, 'accent' AS kind, hex, sum(w) AS frequency FROM (SELECT comp_id, hex, 1.0::DOUBLE AS w FROM colour UNION ALL SELECT comp_id, CASE WHEN ord % 3 = 0 THEN '#000000' ELSE hex END, 0.5 FROM colour) WHERE hex NOT IN ('#000000', '#ffffff') GROUP BY comp_id, hex),
        r AS (SELECT *, row_number() OVER (PARTITION BY comp_id, kind ORDER BY frequency DESC, hex) AS rank FROM (SELECT * FROM t UNION ALL SELECT * FROM a))
        SELECT comp_id, kind, hex, rank, frequency FROM r WHERE rank <= CASE kind WHEN 'text' THEN 10 ELSE 5 END""",
    "palette_roles": ROLES,
    "font_usage": f"WITH {fx.FONTS_SQL} SELECT comp_id, font, bool_or(heading) AS heading, bool_or(body) AS body, count(size) AS n_sizes, min(ord) AS ord FROM font GROUP BY comp_id, font",
    "font_pairing": FONT_PAIRING,
    "composition_vector": f"WITH {COMP_SQL} SELECT comp_id, array_to_string(list_transform(vec, lambda x: round(x, 6)::DECIMAL(12,6)::VARCHAR), ',') AS vec FROM comp",
    "weighted_cosine_contexts": f"""WITH {COMP_SQL}, v AS (SELECT *, {_weights()} AS w, [{', '.join('1.0::DOUBLE' if i in (1, 13, 24) else '0.5::DOUBLE' if i > 27 else '0.0::DOUBLE' for i in range(42))}] AS t FROM comp)
        SELECT comp_id, {R6(_wcos('vec', 't'), 'similarity')}, {R6(_cos('vec', 't'), 'plain')} FROM v""",
    "fingerprint_dedup": f"""WITH {COMP_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY fingerprint ORDER BY quality_score DESC, comp_id) AS rn, min(comp_id) OVER (PARTITION BY fingerprint) AS o FROM comp)
        SELECT comp_id, o AS ord, fingerprint, quality_score FROM r WHERE rn = 1""",
    "template_projection": f"WITH {fx.KEPT_SQL}, {fx.COMPS_SQL} SELECT comp_id, type, confidence > 0.7 AS required, CASE WHEN is_dark THEN 'dark' ELSE 'light' END AS background, pos AS position FROM kept JOIN comps USING (comp_id)",
    "template_inverse": f"""WITH {fx.KEPT_SQL}, {fx.COMPS_SQL} SELECT comp_id, CAST(count(*) AS INTEGER) AS n, round(sum(CASE WHEN confidence > 0.7 THEN 0.8 ELSE 0.5 END)::DOUBLE, 6) AS confidence_sum,
        string_agg(CASE WHEN is_dark THEN 'D' ELSE 'L' END, '' ORDER BY pos) AS rhythm FROM kept JOIN comps USING (comp_id) GROUP BY comp_id""",
    "library_stats": f"""WITH {COMP_SQL}, q AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fingerprint ORDER BY quality_score DESC, comp_id) AS rn FROM comp WHERE effective_score >= 50) WHERE rn = 1)
        SELECT vertical AS key, count(*) AS n FROM q GROUP BY ALL UNION ALL SELECT source_type, count(*) FROM q GROUP BY ALL UNION ALL SELECT 'all', count(*) FROM comp""",
    "archetype_relevance": RELEVANCE,
    "section_freq_matrix": f"""WITH {fx.KEPT_SQL}, {fx.COMPS_SQL}, st AS (SELECT sub_vertical, count(*) AS stores FROM comps GROUP BY ALL), n AS (SELECT sub_vertical, type, count(*) AS n FROM kept JOIN comps USING (comp_id) GROUP BY ALL)
        SELECT st.sub_vertical, t.type, coalesce(n, 0) AS n, stores FROM st CROSS JOIN (SELECT unnest({TYPES}) AS type) t LEFT JOIN n ON n.sub_vertical = st.sub_vertical AND n.type = t.type""",
    "essential_sections": f"""WITH {fx.KEPT_SQL}, {fx.COMPS_SQL}, few AS (SELECT comp_id, {TYPES}[CAST(floor(sqrt(list_position({TYPES}, type) - 1)) AS INTEGER) + 1] AS type FROM kept), c AS (SELECT comp_id, sub_vertical || (comp_id % 50) AS sub_vertical FROM comps), st AS (SELECT sub_vertical, count(*) AS stores FROM c GROUP BY ALL),
        n AS (SELECT sub_vertical, type, count(*) AS n FROM few JOIN c USING (comp_id) GROUP BY ALL) SELECT sub_vertical, type, round(n / stores, 6) AS share FROM n JOIN st USING (sub_vertical) WHERE stores >= 2 AND n / stores >= 0.7""",
    "pdp_must_have": f"""WITH pages AS (SELECT 'v' || (l_suppkey % 5) AS vertical, l_suppkey, 'el' || lpad((l_partkey % 12)::VARCHAR, 2, '0') AS element, bool_or(l_suppkey * 7 % 12 >= l_partkey % 12) AS present FROM lineitem GROUP BY ALL),
        t AS (SELECT vertical, count(DISTINCT l_suppkey) AS pages FROM pages GROUP BY ALL), m AS (SELECT vertical, element, {_PCT('count(*)', 'any_value(pages)')} AS pct FROM pages JOIN t USING (vertical) WHERE present GROUP BY ALL)
        SELECT vertical, coalesce(string_agg(element, ',' ORDER BY pct DESC, element) FILTER (pct >= 80), '') AS must_have, coalesce(string_agg(element, ',' ORDER BY pct DESC, element) FILTER (pct BETWEEN 50 AND 79), '') AS expected FROM m GROUP BY vertical""",
    "url_health": f"""WITH {fx.HEALTH_SQL}, h AS (SELECT *, {STATUS} AS status FROM health) SELECT status, status IN ('ok', 'partial') AS works,
        CASE WHEN error IS NOT NULL OR http_status >= 400 THEN 'dead' WHEN locked THEN 'locked' WHEN n_sections >= 3 OR body_height > 1000 THEN 'live' ELSE 'dead' END AS demo, count(*) AS n FROM h GROUP BY ALL""",
    "uncrawled_anti_join": f"WITH {fx.SECTIONS_SQL}, {fx.COMPS_SQL} SELECT url, source_type FROM comps WHERE comp_id NOT IN (SELECT comp_id FROM section WHERE type <> 'unknown' AND confidence > 0.9)",
    "dead_url_removal": f"WITH {fx.HEALTH_SQL}, {fx.COMPS_SQL} SELECT url, vertical FROM comps WHERE url NOT IN (SELECT url FROM health WHERE {STATUS} NOT IN ('ok', 'partial'))",
    "sub_vertical_lookup": f"""WITH {fx.LINES_SQL}, {fx.COMPS_SQL}, f AS (SELECT l_orderkey AS comp_id, arg_max('sv' || (l_suppkey % 7), pos) AS found FROM lines GROUP BY l_orderkey)
        SELECT comp_id, coalesce(CASE WHEN comp_id % 3 = 0 THEN sub_vertical END, found, vertical || '_general') AS sub_vertical FROM comps LEFT JOIN f USING (comp_id)""",
    "hit_rate": f"WITH {fx.HEALTH_SQL}, h AS (SELECT {STATUS} AS status FROM health) SELECT count(*) AS total, count(*) FILTER (status IN ('ok', 'partial')) AS works, count(*) FILTER (status = 'locked') AS locked, {_PCT("count(*) FILTER (status IN ('ok', 'partial'))", 'count(*)')} AS pct FROM h",
    "theme_counts": f"WITH {ID_SQL} SELECT theme, type, count(*) AS n, count(DISTINCT url) AS stores, theme AS short FROM typed_id WHERE type NOT IN ('popup', 'cart', 'cart_drawer', 'geofencing') AND height > 0 GROUP BY ALL",
    "skipped_gates": f"""WITH {fx.KEPT_SQL}, {fx.COMPS_SQL}, j AS (SELECT c.comp_id, coalesce(k.n, 0) AS n FROM comps c LEFT JOIN nested k ON k.comp_id = c.comp_id),
        r AS (SELECT CASE WHEN comp_id % 17 = 0 THEN 'iframe_page_builder:builder' || (comp_id % 3) WHEN comp_id % 23 = 0 THEN 'password_locked' WHEN n < 2 THEN 'too_few_sections:' || n END AS reason FROM j) SELECT reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY ALL""",
    "url_parts": r"""SELECT page_id, regexp_replace(regexp_extract(url, '//([^.]+)', 1), '-theme.*$', '') AS theme, CASE WHEN contains(url, 'myshopify.com') THEN 'shopify_theme_demo' ELSE 'curated_d2c' END AS kind,
        regexp_replace(url, '/$', '') AS bare, regexp_replace(regexp_replace(url, '^https?://', ''), '[^a-zA-Z0-9]', '_', 'g') AS file FROM pages""",
    "page_signals": r"""SELECT page_id, regexp_extract(html, '(?i)<title>([^<]*)</title>', 1) AS title, regexp_extract(html, '(?i)<h1[^>]*>([^<]*)</h1>', 1) AS h1, contains(url, '/password') OR (contains(lower(html), '<form') AND contains(lower(html), 'type="password"')) AS locked,
        regexp_matches(lower(html), 'captcha|cf-challenge|are you human') AS challenge, regexp_matches(lower(html), 'access denied|not available in your country|geo-?block') AS blocked,
        len(regexp_extract_all(lower(html), '<img')) AS images, len(regexp_extract_all(lower(html), '<a ')) AS links FROM pages""",
    "vision_boost": f"""WITH {QUALITY_SQL}, v AS (SELECT o_orderkey AS comp_id, o_orderkey % 7 = 0 AS broken, o_orderkey % 3 = 0 AS agrees, o_orderkey % 5 AS k FROM orders),
        b AS (SELECT comp_id, broken OR agrees AS agrees, CASE WHEN broken THEN 'general' ELSE 'food' END AS vertical, CASE WHEN broken THEN 0 ELSE k END AS disagreements, CASE WHEN broken THEN 0 WHEN agrees THEN 15 WHEN k <= 2 THEN 5 ELSE -15 END AS boost, NOT broken AND NOT agrees AND k > 2 AS flagged FROM v)
        SELECT comp_id, agrees, vertical, disagreements, boost, flagged, greatest(0, least(100, quality_score + coalesce(boost, 0))) AS boosted FROM scored LEFT JOIN b USING (comp_id)""",
    "sse_first_complete": "SELECT 'http://s' || o_orderkey AS url, CASE WHEN o_orderkey % 4 <> 0 THEN '{\"k\":' || o_orderkey || '}' ELSE '{\"k\":-1}' END AS result FROM orders WHERE o_orderkey % 4 <> 0 OR o_orderkey % 6 <> 0",
    "sse_events": "SELECT 'PROGRESS' AS kind, count(*) AS n FROM orders UNION ALL SELECT 'COMPLETE', count(*) FILTER (o_orderkey % 4 <> 0) + count(*) FILTER (o_orderkey % 6 <> 0) FROM orders",
    "vision_prompt": f"WITH {fx.KEPT_SQL} SELECT comp_id, string_agg((pos + 1) || '. ' || type || ' (confidence: ' || {HALF_UP('confidence * 100')} || '%)', chr(10) ORDER BY pos) AS prompt FROM kept GROUP BY comp_id",
    "doc_fingerprint_dedup": """WITH r AS (SELECT doc_id, sha256(text) AS fingerprint, row_number() OVER (PARTITION BY text ORDER BY n_chars DESC, doc_id) AS rn, min(doc_id) OVER (PARTITION BY text) AS ord FROM documents)
        SELECT doc_id, ord, fingerprint FROM r WHERE rn = 1""",
    "event_decay": """SELECT event_type, count(*) AS n, round(sum(value * pow(0.5, date_diff('microsecond', ts, TIMESTAMP '2024-07-01 00:00:00') / 86400000000.0::DOUBLE / 180.0)), 3) AS decayed, sum((props->>'k')::INT) AS keys FROM events GROUP BY ALL""",
    "embedding_cosine_topk": """WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), m AS (SELECT label, list(x ORDER BY i) AS c FROM (SELECT label, i, avg(v[i]) AS x FROM (SELECT label, v, unnest(range(1, 65)) AS i FROM e) GROUP BY label, i) GROUP BY label),
        s AS (SELECT label, vec_id, round(list_sum(list_transform(range(1, 65), lambda i: v[i] * c[i])) / (sqrt(list_sum(list_transform(v, lambda x: x * x))) * sqrt(list_sum(list_transform(c, lambda x: x * x))) + 1e-8), 6) AS similarity FROM e JOIN m USING (label)),
        r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY similarity DESC, vec_id) AS rank FROM s) SELECT label, rank, vec_id, similarity FROM r WHERE rank <= 3""",
    "visible_top_types": f"WITH {ID_SQL} SELECT type, count(*) AS n FROM typed_id WHERE type NOT IN ('popup', 'cart', 'cart_drawer', 'geofencing') AND height > 0 GROUP BY ALL ORDER BY n DESC, type LIMIT 20",
}
