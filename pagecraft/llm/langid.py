"""Language identification by segmentation-marginalised unigrams.

For each language, pieces of a fixed public vocabulary have probabilities. A word's probability is the sum over all its
segmentations, by the forward algorithm; a text's is the product over its words, with the language's prior. The
probabilities are fitted by expectation maximisation (expected piece counts by forward and backward sums) on words
of a bounded sample of labelled rows: at most FIT_ROWS of each language, chosen by a hash of the id, of any length, and the FIT_WORDS
most frequent words in them. Words are counted where the rows are; only those counts reach the driver. Priors count all learnable rows.

Words are told apart by 64-bit hashes when a run of texts is predicted: of n distinct words, two merge with probability n**2 / 2**65.

Defined results: null texts and texts without a letter give `und` with score 0; ties go to the language that comes
first by code point; repeated rows each give a row, and in the sample count once; without any learnable row all texts are `und`; long
texts are predicted whole; an empty table gives no rows; extra columns are ignored, and lang, source and doc_id are never inputs of a
prediction.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagecraft.llm import lattice
from pagecraft.llm.common import checked_broadcast, crc_mod, materialize, small_batches
from pagecraft.llm.textkernel import chunks, tokens

#: Labelled rows that the fit may use, for each language, and their most frequent words.
FIT_ROWS, FIT_WORDS = 300, 50_000
#: The fit reads a longer word in stretches of this many bytes.
STRETCH = 64
RUN_BYTES = 512 << 10
EM_STEPS = 4
SMOOTHING = 0.05
UNKNOWN = "und"


def _marked(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words with the word mark (a space byte) ahead of each, as one buffer."""
    n = end - start + 1
    stop = np.cumsum(n)
    at = np.arange(stop[-1] if len(stop) else 0) - np.repeat(stop - n, n) - 1 + np.repeat(start, n)
    out = buf[np.maximum(at, 0)].copy() if len(at) else np.zeros(0, np.uint8)
    out[stop - n] = 32
    return out, stop - n, stop


def forward(voc, prob: np.ndarray, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Log probability of each string (in by_length order) under each column of prob, summed over segmentations."""
    langs = prob.shape[1]
    base = start + np.arange(len(start))
    alpha = np.zeros((len(buf) + len(start) + 1, langs))
    alpha[base] = 1.0
    logs = np.zeros((len(start), langs))
    last = 0
    for j, size, at, ids in lattice.edges(voc, buf, start, end):
        if j != last and j % 8 == 0:
            # Rescale what later sums can reach, so that long strings do not underflow.
            live = int(np.searchsorted(-(end - start), -(j - 1), "right"))
            recent = base[:live, None] + np.arange(max(0, j - voc.longest), j)
            top = alpha[recent].max(axis=1)
            alpha[recent] /= top[:, None, :]
            logs[:live] += np.log(top)
        last = j
        alpha[base[at] + j] += alpha[base[at] + j - size] * prob[ids]
    return logs + np.log(alpha[base + (end - start)])


def _counts(text: str) -> dict[bytes, int]:
    counts: dict[bytes, int] = {}
    for w in text.encode().lower().split():
        counts[w] = counts.get(w, 0) + 1
    return counts


def fit(voc, counted: list[dict[bytes, int]], steps: int = EM_STEPS, smoothing: float = SMOOTHING) -> np.ndarray:
    """Piece probabilities (pieces x languages) from the counts of each language's words."""
    stretched: list[dict[bytes, int]] = []
    for counts in counted:
        stretched.append({})
        for w, n in counts.items():
            for i in range(0, len(w), STRETCH):
                part = w[i : i + STRETCH]
                stretched[-1][part] = stretched[-1].get(part, 0) + n
    counted = stretched
    words = sorted({w for c in counted for w in c}, key=lambda w: (-len(w), w))
    langs = len(counted)
    weight = np.array([[c.get(w, 0) for c in counted] for w in words], float).reshape(len(words), langs)
    raw = np.frombuffer(b"".join(words), np.uint8)
    stop = np.cumsum([len(w) for w in words]).astype(np.int64)
    buf, start, end = _marked(raw, stop - np.array([len(w) for w in words], np.int64), stop)
    arcs = list(lattice.edges(voc, buf, start, end))
    base = start + np.arange(len(start))
    prob = np.full((voc.size, langs), 1.0 / voc.size)
    for _ in range(steps):
        alpha = np.zeros((len(buf) + len(start) + 1, langs))
        beta = np.zeros_like(alpha)
        alpha[base], beta[base + (end - start)] = 1.0, 1.0
        for j, size, at, ids in arcs:
            alpha[base[at] + j] += alpha[base[at] + j - size] * prob[ids]
        for j, size, at, ids in reversed(arcs):
            beta[base[at] + j - size] += beta[base[at] + j] * prob[ids]
        scale = weight / np.maximum(alpha[base + (end - start)], 1e-300)
        total = np.full((voc.size, langs), smoothing)
        for j, size, at, ids in arcs:
            gain = alpha[base[at] + j - size] * prob[ids] * beta[base[at] + j] * scale[at]
            for k in range(langs):
                total[:, k] += np.bincount(ids, gain[:, k], voc.size)
        prob = total / total.sum(axis=0)
    return prob


def _counting(batches):
    schema = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("c", pa.int64())])
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            counts = _counts(text.as_py())
            if counts:
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts)), pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], schema=schema)


def _has_letter(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    lower = buf | 32
    ascii_letter = np.concatenate([[0], np.cumsum((lower >= 97) & (lower <= 122) & (buf < 128))])
    found = ascii_letter[ends] > ascii_letter[starts]
    for i in np.flatnonzero(~found & (ends > starts)):
        found[i] = any(c.isalpha() for c in bytes(buf[starts[i] : ends[i]]).decode(errors="replace"))
    return found


def _predict(names: list[str], prob: np.ndarray, prior: np.ndarray, path: str):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])
    labels = np.array([*names, UNKNOWN], object)

    def run(batches):
        voc = lattice.vocabulary(path, True)
        for batch in batches:
            for lo, hi, buf, ends in chunks(batch.column("text"), RUN_BYTES):
                rows = hi - lo
                row, start, end, h = tokens(buf, ends)
                total = np.tile(prior, (rows, 1)) if names else np.zeros((rows, 1))
                if names and len(row):
                    first, place = lattice.unique_spans(buf, start, end, h)
                    logs = forward(voc, prob, *_marked(buf, start[first], end[first]))
                    for k in range(len(names)):
                        total[:, k] += np.bincount(row, logs[place, k], rows)
                best = total.argmax(axis=1)
                score = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                ok = _has_letter(buf, np.concatenate([[0], ends[:-1]]), ends) & bool(names)
                best, score = np.where(ok, best, len(names)), np.where(ok, score, 0.0)
                part = batch.slice(lo, rows)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(labels[best], pa.string()), pa.array(score)], schema=schema)

    return run


def predicted(docs: DataFrame, learn, fit_rows: int = FIT_ROWS, path: str | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; rows where learn (a Column) holds may be learned from."""
    path = lattice.model_path(path)
    src = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", (~learn).alias("held_out"))
    labelled = src.where(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull()).withColumn("h", F.xxhash64("text"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64(F.lit("langid"), "doc_id"), "doc_id", "h")
    # A group of repeated rows counts once; the rank by rows is then one by distinct rows.
    ids = labelled.select("lang", "doc_id", "h").withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= fit_rows).distinct()
    ids = materialize(ids.select("lang", F.col("doc_id").alias("id"), "h"), "langid-sample")
    kept = labelled.alias("t").join(checked_broadcast(ids, 64).alias("l"), (F.col("t.lang") == F.col("l.lang")) & F.col("t.doc_id").eqNullSafe(F.col("l.id")) & (F.col("t.h") == F.col("l.h")), "left_semi")
    rows = kept.select("t.lang", "t.doc_id", "t.h", "t.text").dropDuplicates(["lang", "doc_id", "h"])
    words = rows.select("lang", "text").mapInArrow(_counting, "lang string, word binary, c long").groupBy("lang", "word").agg(F.sum("c").alias("c"))
    often = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("c").desc(), "word"))
    counted: dict[str, dict[bytes, int]] = {}
    for lang, word, c in words.withColumn("r", often).where(F.col("r") <= FIT_WORDS).select("lang", "word", "c").collect():
        counted.setdefault(lang, {})[bytes(word)] = c
    counts = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    names = sorted(counts)  # a language whose rows hold no word has its prior alone
    prob, prior = np.zeros((0, 0)), np.zeros(0)
    if names:
        prior = np.log(np.array([counts[n] for n in names], float) / sum(counts.values()))
        prob = fit(lattice.vocabulary(path, True), [counted.get(n, {}) for n in names])
    return src.select("doc_id", "held_out", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_predict(names, prob, prior, path), "doc_id long, held_out boolean, lang_pred string, score double")


def learn_rule(doc_id):
    return crc_mod(doc_id, 4) != 2
