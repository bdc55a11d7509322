"""SQL for queries that fold over ordered rows: the claims of the two viewports by recursion, k-means by one step after another."""

from __future__ import annotations

from pagecraft.plans import fixtures as fx
from pagecraft.plans import oracle

#: The walk over the desktop sections: each takes the nearest unclaimed mobile section of its type.
RECONCILED_SQL = f"""{fx.SECTIONS_SQL}, d AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY comp_id) AS total FROM section),
    m AS MATERIALIZED (SELECT * REPLACE (row_number() OVER (PARTITION BY comp_id ORDER BY pos) - 1 AS pos, ratio * 0.8::DOUBLE AS ratio, 1 AS cols), count(*) OVER (PARTITION BY comp_id) AS total FROM section WHERE seed % 5 <> 0),
    ml AS MATERIALIZED (SELECT comp_id, list({{'pos': pos, 'type': type, 'total': total}} ORDER BY pos) AS ms FROM m GROUP BY comp_id),
    walk(comp_id, k, claimed) AS (
        SELECT DISTINCT comp_id, 0::BIGINT, []::BIGINT[] FROM d
        UNION ALL
        SELECT w.comp_id, w.k + 1, list_append(w.claimed, coalesce(list_sort(list_transform(list_filter(ml.ms, lambda x: x.type = d.type AND NOT list_contains(w.claimed, x.pos)),
            lambda x: {{'far': abs(d.pos::DOUBLE / d.total - x.pos::DOUBLE / x.total) - 1.0, 'pos': x.pos}}))[1].pos, -1))
        FROM walk w JOIN d ON d.comp_id = w.comp_id AND d.pos = w.k LEFT JOIN ml ON ml.comp_id = w.comp_id),
    claims AS (SELECT w.comp_id, w.claimed FROM walk w JOIN (SELECT comp_id, max(total) AS t FROM d GROUP BY comp_id) e ON e.comp_id = w.comp_id AND w.k = e.t),
    pairs AS (SELECT d.comp_id, d.type, d.pos AS dp, nullif(c.claimed[d.pos + 1], -1) AS mp FROM d JOIN claims c USING (comp_id)
        UNION ALL SELECT m.comp_id, m.type, NULL, m.pos FROM m JOIN claims c USING (comp_id) WHERE NOT list_contains(c.claimed, m.pos)),
    sides AS (SELECT p.comp_id, p.type, dp, mp, d.confidence AS dc, m.confidence AS mc, d.is_dark AS dd, m.is_dark AS md, d.cols AS dcols, m.cols AS mcols, d.carousel AS dk, m.carousel AS mk, d.ratio AS dr, m.ratio AS mr,
        m.ratio / (1 + m.pos * 0.5::DOUBLE) AS seen, greatest(coalesce(d.confidence, 0.0), coalesce(m.confidence, 0.0)) AS sure
        FROM pairs p LEFT JOIN d ON d.comp_id = p.comp_id AND d.pos = p.dp LEFT JOIN m ON m.comp_id = p.comp_id AND m.pos = p.mp),
    rec AS (SELECT comp_id, row_number() OVER (PARTITION BY comp_id ORDER BY dp NULLS LAST, mp) - 1 AS pos, type, dp AS desktop_pos, mp AS mobile_pos, dp IS NOT NULL AS on_desktop, mp IS NOT NULL AS on_mobile, mp IS NOT NULL AND sure > 0.7 AS required,
        coalesce(dd, false) OR coalesce(md, false) AS is_dark, coalesce(row_number() OVER (PARTITION BY comp_id ORDER BY seen DESC NULLS LAST, mp NULLS LAST) = 1 AND seen > 0.4, false) AS primary_hero,
        dp IS NOT NULL AND mp IS NOT NULL AND ((mcols <> 0 AND mcols <> dcols) OR (mk AND NOT dk) OR abs(dr - mr) > 0.3) AS differs, sure AS confidence, coalesce(seen, 0.0) AS prominence FROM sides)"""

K, STEPS = 8, 20


def _kmeans() -> str:
    """Evenly spaced seeds; each step labels all pixels and moves the centres that have some. Images whose first labels are all 0 do not move."""
    channel = lambda i: f"CAST(least(255, greatest(0, floor((embedding[{i}] + 1) * 127.5))) AS INTEGER)"
    parts = [
        f"px AS MATERIALIZED (SELECT label AS img_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i, count(*) OVER (PARTITION BY label) AS n, {channel(1)} AS r, {channel(2)} AS g, {channel(3)} AS b FROM embeddings)",
        f"c0 AS MATERIALIZED (SELECT img_id, c, r::DOUBLE AS r, g::DOUBLE AS g, b::DOUBLE AS b FROM px JOIN (SELECT unnest(range({K})) AS c) s ON i = least(c * greatest(1, n // {K}), n - 1))",
    ]
    for t in range(1, STEPS + 1):
        far = "(p.r - c.r) * (p.r - c.r) + (p.g - c.g) * (p.g - c.g) + (p.b - c.b) * (p.b - c.b)"
        parts.append(f"a{t} AS MATERIALIZED (SELECT p.img_id, p.i, first(c.c ORDER BY {far}, c.c) AS c FROM px p JOIN c{t - 1} c USING (img_id) GROUP BY p.img_id, p.i)")
        if t == 1:
            parts.append("still AS MATERIALIZED (SELECT img_id FROM a1 GROUP BY img_id HAVING max(c) = 0)")
        parts.append(
            f"c{t} AS MATERIALIZED (SELECT o.img_id, o.c, coalesce(s.r, o.r) AS r, coalesce(s.g, o.g) AS g, coalesce(s.b, o.b) AS b FROM c{t - 1} o LEFT JOIN (SELECT a.img_id, a.c, sum(r)::DOUBLE / count(*) AS r, sum(g)::DOUBLE / count(*) AS g, sum(b)::DOUBLE / count(*) AS b "
            f"FROM a{t} a JOIN px USING (img_id, i) WHERE a.img_id NOT IN (SELECT img_id FROM still) GROUP BY a.img_id, a.c) s ON s.img_id = o.img_id AND s.c = o.c)"
        )
    whole = lambda x: f"CAST(floor({x} + 0.5) AS INTEGER) AS {x}"
    return f"""WITH {', '.join(parts)}, k AS (SELECT img_id, c, count(*) AS n FROM a{STEPS} GROUP BY ALL), t AS (SELECT img_id, count(*) AS total FROM px GROUP BY ALL), o AS (SELECT c.*, coalesce(k.n, 0) AS n FROM c{STEPS} c LEFT JOIN k USING (img_id, c))
        SELECT img_id, CAST(row_number() OVER (PARTITION BY img_id ORDER BY n DESC, c) - 1 AS INTEGER) AS cluster, {whole('r')}, {whole('g')}, {whole('b')}, n, n::DOUBLE / total AS proportion FROM o JOIN t USING (img_id)"""


SQL: dict[str, str] = {
    "viewport_reconcile": f"WITH RECURSIVE {RECONCILED_SQL} SELECT comp_id, pos, type, desktop_pos, mobile_pos, on_desktop, on_mobile, required, is_dark, primary_hero, differs, {oracle.R6('confidence', 'confidence')}, {oracle.R6('prominence', 'prominence')} FROM rec",
    "reconciled_quality": f"""WITH RECURSIVE {RECONCILED_SQL}, {fx.KEPT_SQL.replace(fx.SECTIONS_SQL + ',', '', 1)}, {oracle.FACTS_SQL}, phone AS (SELECT comp_id, avg(on_mobile::INT::DOUBLE) AS mobile_share, bool_or(primary_hero AND starts_with(type, 'hero')) AS hero_first FROM rec GROUP BY comp_id)
        SELECT comp_id, greatest(0, least(100, {oracle.HALF_UP(oracle.SCORE + ' + mobile_share * 10 + CASE WHEN hero_first THEN 3 ELSE 0 END')})) AS quality_score FROM facts JOIN phone USING (comp_id)""",
    "kmeans_palette": _kmeans(),
}
