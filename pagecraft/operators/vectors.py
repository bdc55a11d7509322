"""Composition vectors, structural fingerprints and the two steps of dedup."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagecraft.functions import vocab
from pagecraft.functions.scalars import half_up, is_hero, let, rhythm, saturation


def _mean(arr: Column) -> Column:
    return F.coalesce(F.try_divide(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x), F.size(arr)), F.lit(0.0))


def _flag(test: Column) -> Column:
    return F.when(test, 1.0).otherwise(0.0)


def vector(s: Column, dark_theme: Column, gold: Column, maroon: Column, accent: Column) -> Column:
    """The 42 dimensions of nested sections and palette facts; a null accent counts as half saturated."""
    n = F.greatest(F.size(s), F.lit(1))
    share = lambda test: F.size(F.filter(s, test)) / n
    some = lambda test: _flag(F.exists(s, test))
    hero = F.coalesce(F.get(F.filter(s, lambda x: is_hero(x["type"])), F.lit(0))["ratio"], F.lit(0.0))
    cols = F.array_max(F.concat(F.transform(s, lambda x: F.when(x["cols"] > 0, x["cols"]).otherwise(1)), F.array(F.lit(1))))
    features = [
        _mean(F.transform(s, lambda x: F.when(x["images"] > 3, x["images"]).otherwise(0).cast("double"))) / 10,
        _mean(F.transform(s, lambda x: F.coalesce(F.length(x["heading"]), F.lit(0)).cast("double"))) / 100,
        share(lambda x: x["carousel"]),
        _mean(F.transform(s, lambda x: F.when(x["is_dark"], 0.2).otherwise(0.8))),
        share(lambda x: x["is_dark"]),
        F.least(F.size(s) / F.lit(15.0), F.lit(1.0)),
        hero,
        some(lambda x: x["carousel"]),
        some(lambda x: x["type"] == "marquee"),
        F.least(cols / F.lit(4.0), F.lit(1.0)),
        _flag(dark_theme),
        F.coalesce(gold, F.lit(0.0)),
        F.coalesce(maroon, F.lit(0.0)),
        F.when(accent.isNull(), 0.5).otherwise(saturation(accent)),
    ]
    # One pass over a composition's distinct types, not one for each flag.
    known = F.array(*[F.lit(t) for t in vocab.SECTION_TYPES])
    flags = let(F.array_distinct(F.transform(s, lambda x: x["type"])), lambda types: F.transform(known, lambda t: _flag(F.array_contains(types, t))))
    return F.concat(flags, F.array(*features))


def fingerprint(s: Column) -> Column:
    types = F.array_join(F.transform(s, lambda x: x["type"]), "→")
    cta = F.size(F.filter(s, lambda x: x["type"].isin(*vocab.FINGERPRINT_CTA))) / F.greatest(F.size(s), F.lit(1))
    return F.concat_ws("|", types, rhythm(s), half_up(cta * 10).cast("string"))


def fingerprint_dedup(df: DataFrame, key: str = "fingerprint") -> DataFrame:
    """Of rows with equal fingerprints the best one (quality, then the first), at the place of the group's first (ord)."""
    own = Window.partitionBy(key)
    best = F.row_number().over(own.orderBy(F.col("quality_score").desc(), "ord"))
    return df.withColumns({"_rank": best, "_first": F.min("ord").over(own)}).where("_rank = 1").withColumn("ord", F.col("_first")).drop("_rank", "_first")


def _weighted(vectors: np.ndarray, vertical: str) -> tuple[np.ndarray, np.ndarray]:
    """Vectors under a vertical's weights, and their lengths."""
    w = vectors * np.array(vocab.weights(vertical))
    return w, np.sqrt((w * w).sum(axis=-1))


def _cosines(rows: np.ndarray, lengths: np.ndarray, x: np.ndarray, length: float) -> np.ndarray:
    """cosine() of each row with x, with the same small term below."""
    return (rows @ x) / (lengths * length + 1e-8)


def greedy_kept(vectors: np.ndarray, verticals: list[str], quality: np.ndarray, threshold: float) -> list[int]:
    """Rows that stay: a row like a kept one (under its own vertical's weights) takes that one's place if it is better, and goes
    otherwise. Kept rows are compared in the order of their places."""
    kept: list[int] = []
    size = min(1024, max(1, len(vectors)))
    ready = {v: _weighted(vectors, v) for v in set(verticals)}
    slots = {v: (np.zeros((size, vectors.shape[1])), np.zeros(size)) for v in ready}
    for i, v in enumerate(verticals):
        n = len(kept)
        hit = np.flatnonzero(_cosines(slots[v][0][:n], slots[v][1][:n], ready[v][0][i], ready[v][1][i]) > threshold)
        if len(hit):
            at = int(hit[0])
            if quality[i] <= quality[kept[at]]:
                continue
            kept[at] = i
        else:
            at = n
            kept.append(i)
            if at >= len(slots[v][0]):
                slots = {k: (np.concatenate([m, np.zeros_like(m)]), np.concatenate([l, np.zeros_like(l)])) for k, (m, l) in slots.items()}
        for k, (m, lengths) in slots.items():
            m[at], lengths[at] = ready[k][0][i], ready[k][1][i]
    return kept


TYPES = len(vocab.SECTION_TYPES)
_WEIGHTED = ("default", *vocab.VERTICAL_WEIGHTS)
#: Rows that pairs are looked for at once.
BLOCK = 2048


def _lengths(x: np.ndarray) -> np.ndarray:
    """Each row's squared lengths under the weights of each of _WEIGHTED."""
    w = np.array([vocab.weights(v) for v in _WEIGHTED])
    return (x * x) @ (w * w).T


def _masks(x: np.ndarray) -> np.ndarray:
    return (x[:, :TYPES] != 0) @ (1 << np.arange(TYPES))


def _keyed(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Every row once for each set of types that a row like it may share with it.

    What the one has of types and the other has not, p of the one's squared length a and q of the other's b, is lost to their product, so
    it is at most sqrt((a - p) * (b - q)): of rows like each other p is under (1 - threshold ** 2) * a, and q likewise. Types weigh 1."""
    for batch in batches:
        x = np.stack(batch["vec"].to_numpy(zero_copy_only=False)) if batch.num_rows else np.zeros((0, TYPES + len(vocab.FEATURE_DIMS)))
        masks, types = _masks(x), x[:, :TYPES] ** 2
        least = np.where(types > 0, types, np.inf).min(axis=1, initial=np.inf)
        may = ((1 - max(threshold, 0.0) ** 2) * _lengths(x).max(axis=1) + 1e-9) / least
        keys, rows = [], []
        for i, (mask, n) in enumerate(zip(masks.tolist(), may.tolist(), strict=True)):
            bits = [1 << b for b in range(TYPES) if mask >> b & 1]
            own = [mask - sum(gone) for k in range(min(int(n), len(bits)) + 1) for gone in combinations(bits, k)]
            keys += own
            rows += [i] * len(own)
        out = batch.take(pa.array(rows, pa.int64()))
        packed = pa.array([v.tobytes() for v in x], pa.binary()).take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *(out[c] for c in ("comp_id", "ord", "vertical", "quality_score")), packed], names=["key", "comp_id", "ord", "vertical", "quality_score", "vec"])


def _alike(key: int, ids: np.ndarray, ords: np.ndarray, verticals: np.ndarray, x: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions (later, earlier) of the rows that are alike under the later one's weights and share the types of key, and no others."""
    masks, lengths = _masks(x), _lengths(x)
    free = 1 - (x[:, :TYPES] ** 2 * ((masks ^ key)[:, None] >> np.arange(TYPES) & 1)).sum(axis=1) / np.maximum(lengths.max(axis=1), 1e-300)
    full = np.flatnonzero(masks == key)
    part = np.flatnonzero(masks != key)
    # Of two rows that both have more types than key, what is free must suffice together.
    wide = part[free[part] * free[part].max(initial=0.0) > max(threshold, 0.0) ** 2 - 1e-9]
    later, earlier = [], []
    for rows, others in ((full, np.arange(len(x))), (part, full), (wide, wide)):
        for v, name in enumerate(_WEIGHTED):
            own = rows[verticals[rows] == v]
            if not len(own) or not len(others):
                continue
            b, b_length = _weighted(x[others], name)
            for at in range(0, len(own), BLOCK):
                i = own[at : at + BLOCK]
                a, a_length = _weighted(x[i], name)
                hit = (a @ b.T) / (a_length[:, None] * b_length + 1e-8) > threshold
                hit &= (masks[i][:, None] & masks[others]) == key
                hit &= (ords[i][:, None] > ords[others]) | ((ords[i][:, None] == ords[others]) & (ids[i][:, None] > ids[others]))
                r, c = np.nonzero(hit)
                later.append(i[r])
                earlier.append(others[c])
    return tuple(np.concatenate(p) if p else np.zeros(0, np.int64) for p in (later, earlier))


def _pairs(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """comp_id, ord, quality_score, earlier of _keyed() rows in the order of their keys: each row once without an earlier one, and once for
    each earlier row that it is like."""
    kept: pa.Table | None = None
    code = {v: i for i, v in enumerate(_WEIGHTED)}

    def found(t: pa.Table) -> Iterator[pa.RecordBatch]:
        keys, ids, ords, quality = (t[c].to_numpy() for c in ("key", "comp_id", "ord", "quality_score"))
        x = np.frombuffer(b"".join(t["vec"].to_pylist()), np.float64).reshape(len(keys), -1)
        verticals = np.array([code.get(v, 0) for v in t["vertical"].to_pylist()])
        at = np.append(np.flatnonzero(np.diff(keys, prepend=-1)), len(keys))
        own = np.flatnonzero(_masks(x) == keys)
        later, earlier = [own], [np.full(len(own), -1)]
        for a, b in zip(at[:-1], at[1:], strict=True):
            if b - a > 1:
                i, j = _alike(int(keys[a]), ids[a:b], ords[a:b], verticals[a:b], x[a:b], threshold)
                later.append(i + a)
                earlier.append(j + a)
        i, j = np.concatenate(later), np.concatenate(earlier)
        near = pa.array(ids[j], pa.int64(), mask=j < 0)
        yield from pa.table([pa.array(ids[i]), pa.array(ords[i]), pa.array(quality[i].astype(np.float64)), near], names=["comp_id", "ord", "quality_score", "earlier"]).to_batches(max_chunksize=10_000)

    for batch in batches:
        new = pa.Table.from_batches([batch])
        kept = new if kept is None else pa.concat_tables([kept, new])
        # The last key may go on in the next batch.
        keys = kept["key"].to_numpy()
        whole = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
        if whole:
            yield from found(kept.slice(0, whole))
            kept = kept.slice(whole)
    if kept is not None and kept.num_rows:
        yield from found(kept)


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """greedy_kept() of rows in order that name the earlier rows they are like."""
    place: dict[int, int] = {}
    kept: list[int] = []
    quality: list[float] = []
    for batch in batches:
        for i, q, near in zip(*(batch[c].to_pylist() for c in ("comp_id", "quality_score", "near")), strict=True):
            at = min((place[j] for j in near if j in place), default=None)
            if at is None:
                place[i] = len(kept)
                kept.append(i)
                quality.append(q)
            elif q > quality[at]:
                del place[kept[at]]
                place[i], kept[at], quality[at] = at, i, q
    for at in range(0, len(kept), 10_000):
        part = kept[at : at + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(range(at, at + len(part)), pa.int64())], names=["comp_id", "ord"])


def vector_dedup(df: DataFrame, threshold: float = 0.92) -> DataFrame:
    """(comp_id, ord) of df (comp_id, ord, vertical, quality_score, vec) that stay, as greedy_kept() keeps them.

    Rows like each other differ in few types, so each row meets those that share a set of types with it, in as many tasks as there are
    keys. The order decides, so the fold over the pairs runs in one task; it holds the ids of the rows that stay and compares no vectors."""
    row = "comp_id long, ord long, vertical string, quality_score double, vec"
    rows = df.select(F.col("comp_id").cast("long").alias("comp_id"), F.col("ord").cast("long").alias("ord"), "vertical", F.col("quality_score").cast("double").alias("quality_score"), "vec")
    keyed = rows.mapInArrow(lambda b: _keyed(b, threshold), f"key long, {row} binary").repartition("key").sortWithinPartitions("key")
    pairs = keyed.mapInArrow(lambda b: _pairs(b, threshold), "comp_id long, ord long, quality_score double, earlier long")
    near = pairs.groupBy("ord", "comp_id", "quality_score").agg(F.collect_list("earlier").alias("near"))
    return near.repartition(1).sortWithinPartitions("ord", "comp_id").mapInArrow(_folded, "comp_id long, ord long")


def greedy_clusters(vectors: np.ndarray, vertical: str, threshold: float) -> np.ndarray:
    """Each row's cluster: the most similar centroid above the threshold, the first on ties; else a new one. Centroids are running means."""
    w = np.array(vocab.weights(vertical))
    sums, sizes, out = np.zeros((64, vectors.shape[1])), np.zeros(64), np.zeros(len(vectors), np.int64)
    centres, lengths, n = np.zeros_like(sums), np.zeros(64), 0
    for i, x in enumerate(vectors):
        v = x * w
        sim = _cosines(centres[:n], lengths[:n], v, np.sqrt(v @ v)) if n else np.zeros(0)
        at = int(sim.argmax()) if n and sim.max() > threshold else n
        if at == n:
            n += 1
            if n > len(sums):
                sums, centres, sizes, lengths = (np.concatenate([a, np.zeros_like(a)]) for a in (sums, centres, sizes, lengths))
        sums[at] += x
        sizes[at] += 1
        centres[at] = sums[at] / sizes[at] * w
        lengths[at] = np.sqrt(centres[at] @ centres[at])
        out[i] = at
    return out


def clustered(df: DataFrame, threshold: float = 0.80) -> DataFrame:
    """comp_id, vertical, ord, cluster (numbered by creation in each vertical)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ord")
        label = greedy_clusters(np.stack(pdf["vec"].to_list()), pdf["vertical"].iloc[0], threshold)
        return pdf[["comp_id", "vertical", "ord"]].assign(cluster=label)

    own = df.withColumn("vertical", F.coalesce(F.nullif(F.col("vertical"), F.lit("")), F.lit("general"))).select("comp_id", "vertical", "ord", "vec")
    return own.groupBy("vertical").applyInPandas(run, "comp_id long, vertical string, ord long, cluster long")
