"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features: densities of a lexicon of words and stems, its hits next to second-person words, hits that were
obfuscated (digits and signs for letters), capitals, punctuation, repeats and lengths. The lexicon, the trees and the
calibration are fitted on separate parts of a bounded sample of labelled rows (at most FIT_ROWS, chosen by a hash of
the id); every row's whole text is scored.

Defined results: null text counts as empty and is scored like all others; a row without label is scored; a label that
is null counts as none; with several labels for one id the highest counts; without both classes to learn from all scores
are the share of label 1 (0 without labels); repeated rows each give a row, and in the sample an id counts once, with its first text
by hash; of lexicon words with equal weight the lesser hash comes first, equal gains go to the first feature and bin; long texts are
scored whole; an empty table gives no rows; extra columns are ignored. Words are told apart by 64-bit hashes: of n distinct words,
two merge with probability n**2 / 2**65.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagecraft.llm.common import crc_mod, materialize, small_batches
from pagecraft.llm.textkernel import BYTE, LOWER, SPACE, chunks, prefix_hash, runs, span_hash

#: Labelled rows that the fit may use.
FIT_ROWS = 12_000
LEXICON = 400
STEMS = (4, 5, 6)
LEAST_DOCS, LEAST_ODDS = 6, 2.5
TREES, DEPTH, RATE, BINS = 60, 3, 0.2, 32
NEAR = 5
# Second-person words of the four languages, and the letters that signs stand for.
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre tú ti tus usted ustedes vos".split()
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "*"}

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_SIGN = np.zeros(256, bool)
_UNSIGNED = LOWER.copy()
for _c, _l in SIGNS.items():
    _SIGN[ord(_c)], _UNSIGNED[ord(_c)] = True, ord(_l)
FEATURES = (
    "weight_density", "hits", "largest_weight", "near_second_person", "second_person", "capitals", "capital_words", "exclamations", "questions",
    "punctuation", "signed_words", "signed_hits", "digits", "log_words", "repeats", "hit_share",
)


def _hashes(words: list[str]) -> np.ndarray:
    flat = np.frombuffer("".join(words).encode(), np.uint8)
    stop = np.cumsum([len(w.encode()) for w in words])
    return span_hash(prefix_hash(flat, BYTE[LOWER]), stop - np.array([len(w.encode()) for w in words]), stop)


def _stems(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(token, hash) of each token's whole and of its first bytes, the latter told from whole words by a bit."""
    out = [(np.arange(len(start)), span_hash(prefix, start, end))]
    for n in STEMS:
        at = np.flatnonzero(end - start > n)
        out.append((at, span_hash(prefix, start[at], start[at] + n) ^ np.uint64(n)))
    return out


def _weights(lexicon: tuple[np.ndarray, np.ndarray], prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Each token's largest weight in the lexicon, 0 if it is not there."""
    key, weight = lexicon
    out = np.zeros(len(start))
    if len(key):
        for at, h in _stems(prefix, start, end):
            place = np.minimum(np.searchsorted(key, h), len(key) - 1)
            out[at] = np.maximum(out[at], np.where(key[place] == h, weight[place], 0.0))
    return out


def features(buf: np.ndarray, ends: np.ndarray, lexicon: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """rows x FEATURES."""
    rows = len(ends)
    begins = np.concatenate([[0], ends[:-1]])

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[ends] - total[begins]).astype(float)

    size = np.maximum(ends - begins, 1)
    row, start, end = runs(buf, ends, _LETTER)
    prefix = prefix_hash(buf, BYTE[LOWER])
    weight = _weights(lexicon, prefix, start, end)
    whole = span_hash(prefix, start, end)
    second = np.isin(whole, _hashes(SECOND_PERSON))
    n = np.maximum(np.bincount(row, minlength=rows), 1)
    hit = weight > 0
    # A hit is near if a second-person word of its row stands within NEAR words.
    at = np.flatnonzero(second)
    near = np.zeros(len(row), bool)
    if len(at):
        here = np.flatnonzero(hit)
        right = np.searchsorted(at, here)
        for side in (np.minimum(right, len(at) - 1), np.maximum(right - 1, 0)):
            near[here] |= (np.abs(at[side] - here) <= NEAR) & (row[at[side]] == row[here])
    upper = np.concatenate([[0], np.cumsum((buf >= 65) & (buf <= 90))])
    shouted = (end - start >= 3) & (upper[end] - upper[start] == end - start)
    mrow, mstart, mend = runs(buf, ends, _LETTER | _SIGN)
    signs = np.concatenate([[0], np.cumsum(_SIGN[buf])])
    n_signs = signs[mend] - signs[mstart]
    inner = np.concatenate([[0], np.cumsum(_LETTER[buf])])
    odd = (n_signs > 0) & (inner[mend] - inner[mstart] >= 2) & _LETTER[buf[mend - 1]] if len(mend) else np.zeros(0, bool)
    orow, ostart, oend = mrow[odd], mstart[odd], mend[odd]
    signed = _weights(lexicon, prefix_hash(buf, BYTE[_UNSIGNED]), ostart, oend)
    same = np.zeros(len(buf), bool)
    same[2:] = (buf[2:] == buf[1:-1]) & (buf[2:] == buf[:-2]) & ~SPACE[buf[2:]]
    add = lambda r, v: np.bincount(r, v, rows)
    largest = np.zeros(rows)
    np.maximum.at(largest, row[hit], weight[hit])
    np.maximum.at(largest, orow, signed)
    printable = (buf > 32) & (buf < 128) & ~_LETTER[buf] & ~((buf >= 48) & (buf <= 57))
    out = [
        add(row, weight) / n, np.log1p(add(row, hit.astype(float)) + add(orow, (signed > 0).astype(float))), largest, np.log1p(add(row, near.astype(float))),
        add(row, second.astype(float)) / n, share((buf >= 65) & (buf <= 90)) / size, add(row, shouted.astype(float)) / n, share(buf == 33) / size,
        share(buf == 63) / size, share(printable) / size, add(mrow, odd.astype(float)) / n, add(orow, signed), share((buf >= 48) & (buf <= 57)) / size,
        np.log1p(n), share(same) / size, add(row, hit.astype(float)) / n,
    ]
    return np.stack(out, axis=1)


class Trees:
    """Boosted regression trees on the logistic loss, over quantile bins."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE):
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start, self.trees, self.depth = np.log(share / (1 - share)), [], depth
        binned, f = self._binned(x), np.full(len(y), self.start)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-f))
            tree = self._grow(binned, y - p, p * (1 - p), depth, rate)
            self.trees.append(tree)
            f += self._leaf(tree, binned)

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, "right") for e, c in zip(self.edges, x.T, strict=True)], axis=1)

    @staticmethod
    def _grow(b: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, rate: float):
        """(feature, bin) of each inner node and the leaves' values, as a full binary tree."""
        node, split = np.zeros(len(g), np.int64), np.zeros((2**depth - 1, 2), np.int64)
        for d in range(depth):
            for k in range(2**d):
                own = node == k
                best = (1e-9, 0, BINS)
                if own.sum() >= 20:
                    for c in range(b.shape[1]):
                        gs = np.cumsum(np.bincount(b[own, c], g[own], BINS + 1))
                        hs = np.cumsum(np.bincount(b[own, c], h[own], BINS + 1))
                        gain = gs**2 / (hs + 1) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1) - gs[-1] ** 2 / (hs[-1] + 1)
                        i = int(gain.argmax())
                        if gain[i] > best[0]:
                            best = (gain[i], c, i)
                split[2**d - 1 + k] = best[1:]
            at = split[2**d - 1 + node]
            node = node * 2 + (b[np.arange(len(g)), at[:, 0]] > at[:, 1])
        value = rate * np.bincount(node, g, 2**depth) / (np.bincount(node, h, 2**depth) + 1)
        return split, value

    def _leaf(self, tree, b: np.ndarray) -> np.ndarray:
        split, value = tree
        node = np.zeros(len(b), np.int64)
        for d in range(self.depth):
            at = split[2**d - 1 + node]
            node = node * 2 + (b[np.arange(len(b)), at[:, 0]] > at[:, 1])
        return value[node]

    def margin(self, x: np.ndarray) -> np.ndarray:
        b = self._binned(x)
        return self.start + sum(self._leaf(t, b) for t in self.trees)


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing fit, by pooling adjacent violators; between knots the fit is linear."""
    order = np.argsort(margin, kind="stable")
    pools: list[list[float]] = []
    for m, v in zip(margin[order], y[order], strict=True):
        pools.append([v, 1.0, m, m])
        while len(pools) > 1 and (pools[-2][0] >= pools[-1][0] or pools[-2][3] == pools[-1][2]):
            b = pools.pop()
            a = pools[-1]
            pools[-1] = [(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2], b[3]]
    xs = np.array([e for p in pools for e in (p[2], p[3])])
    ys = np.array([(p[0] * p[1] + s) / (p[1] + 1) for p in pools for s in (p[0], p[0])])
    return xs, np.maximum.accumulate(ys)


def _counting(batches):
    schema = pa.schema([("key", pa.int64()), ("toxic", pa.int64()), ("docs", pa.int64())])
    for batch in batches:
        label = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
        for lo, _, buf, ends in chunks(batch.column("text")):
            row, start, end = runs(buf, ends, _LETTER)
            pairs = [(row[at], h) for at, h in _stems(prefix_hash(buf, BYTE[LOWER]), start, end)]
            r, h = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
            order = np.lexsort((h, r))
            r, h = r[order], h[order]
            new = np.ones(len(r), bool)
            new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
            key, inverse = np.unique(h[new], return_inverse=True)
            toxic = np.bincount(inverse, label[lo + r[new]], len(key))
            docs = np.bincount(inverse, minlength=len(key))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(toxic.astype(np.int64)), pa.array(docs.astype(np.int64))], schema=schema)


def _measured(lexicon):
    schema = pa.schema([("toxic", pa.int32()), ("part", pa.int32()), ("x", pa.list_(pa.float64()))])

    def run(batches):
        for batch in batches:
            for lo, hi, buf, ends in chunks(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                x = pa.FixedSizeListArray.from_arrays(pa.array(features(buf, ends, lexicon).reshape(-1)), len(FEATURES)).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("toxic"), part.column("part"), x], schema=schema)

    return run


def _scoring(lexicon, model, knots, share: float):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches):
        for batch in batches:
            for lo, hi, buf, ends in chunks(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                score = np.full(hi - lo, share) if model is None else np.interp(model.margin(features(buf, ends, lexicon)), *knots)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], schema=schema)

    return run


def fitted(docs: DataFrame, labels: DataFrame, learn: Column, fit_rows: int = FIT_ROWS):
    """(lexicon, trees, knots, share of label 1) from the labelled rows where learn (a Column over doc_id) holds."""
    per = labels.where(F.col("toxic").isNotNull() & learn).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    order = F.xxhash64(F.lit("toxicity"), "doc_id")
    chosen = per.orderBy(order, "doc_id").limit(fit_rows).withColumn("part", (F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(5))).cast("int"))
    chosen = materialize(chosen, "toxicity-sample")
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # One row for each id, so that repeated ids do not outgrow the sample. FIT_ROWS bounds what is broadcast, 16 bytes a row.
    sample = text.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic", "part").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sample = materialize(sample, "toxicity-texts")
    lexicon_rows = sample.where("part < 2")
    n = chosen.where("part < 2").agg(F.sum("toxic"), F.count("*")).first()
    pos, neg = n[0] or 0, (n[1] or 0) - (n[0] or 0)
    keys = lexicon_rows.select("toxic", "text").mapInArrow(_counting, "key long, toxic long, docs long").groupBy("key").agg(F.sum("toxic").alias("pos"), F.sum("docs").alias("docs"))
    odds = F.log((F.col("pos") + 0.5) / (pos + 1)) - F.log((F.col("docs") - F.col("pos") + 0.5) / (neg + 1))
    keys = keys.withColumn("odds", odds).where((F.col("pos") >= min(LEAST_DOCS, max(2, pos // 20))) & (F.col("odds") >= LEAST_ODDS))
    top = sorted((r["key"] % (1 << 64), r["odds"]) for r in keys.orderBy((F.col("odds") * F.col("pos")).desc(), "key").limit(LEXICON).collect())
    lexicon = (np.array([k for k, _ in top], np.uint64), np.array([w for _, w in top], float))
    rest = sample.where("part >= 2").select("toxic", "part", "text").mapInArrow(_measured(lexicon), "toxic int, part int, x array<double>").toArrow()
    y, part = rest.column("toxic").to_numpy().astype(float), rest.column("part").to_numpy()
    share = float(y.mean()) if len(y) else 0.0
    fit, cal = part < 4, part == 4
    if not len(y) or len(set(y[fit])) < 2 or not cal.any():
        return lexicon, None, None, share
    x = rest.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    model = Trees(x[fit], y[fit])
    return lexicon, model, isotonic(model.margin(x[cal]), y[cal]), share


def scored(docs: DataFrame, labels: DataFrame, learn: Column, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out (learn does not hold), score, predicted for every row of docs."""
    model = fitted(docs, labels, learn, fit_rows)
    src = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), (~learn).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    return src.mapInArrow(_scoring(*model), "doc_id long, held_out boolean, score double, predicted int")


def _keeping(lexicon, model, knots, share: float, columns: list[str], at: int):
    def run(batches):
        for batch in batches:
            keep = []
            for lo, hi, buf, ends in chunks(batch.column(at)):
                keep.append(np.full(hi - lo, share) < 0.5 if model is None else np.interp(model.margin(features(buf, ends, lexicon)), *knots) < 0.5)
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return run


def clean(docs: DataFrame, labels: DataFrame, learn: Column, fit_rows: int = FIT_ROWS) -> DataFrame:
    """docs without the rows that are predicted toxic, all columns as they are."""
    return small_batches(docs).mapInArrow(_keeping(*fitted(docs, labels, learn, fit_rows), docs.columns, docs.columns.index("text")), docs.schema)


def learn_rule(doc_id: Column) -> Column:
    return crc_mod(doc_id, 5) != 0
