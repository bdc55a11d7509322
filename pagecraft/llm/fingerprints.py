"""Document fingerprints by winnowing.

Tokens are runs of `[^\\x20\\x09-\\x0D]`, cut after 16 characters. k-gram hashes are rolled up by doubling (a 2k-gram's
hash comes from its two halves), each window of w of them gives its minimum, the rightmost on ties, and
positions stay with the hashes: any run of w + k - 1 tokens that two texts share leaves a common hash.
A fingerprint is an array of longs: a 32-bit hash above 31 bits of (2**31 - 1 - position).

Defined results: null text counts as empty and has an empty fingerprint; fewer tokens than k make one gram;
two empty fingerprints are alike (1.0), an empty and another one are not (0.0); a null doc_id comes after all
others; rows that repeat a doc_id follow each other by text; the only row is its own next document; equal minima of a window
go to the rightmost; long texts are fingerprinted whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagecraft.llm.common import let, materialize

K_DOUBLINGS = 2
W_DOUBLINGS = 2
POSITION = (1 << 31) - 1
#: doc_ids that share all but this many low bits are laid side by side.
RUN_BITS = 6
STEP_BITS = 12
NO_ID = (1 << 63) - 1


def _neighbours(arr: Column, gap: int, f) -> Column:
    """f(x[i], x[i + gap]) for all i that have both."""
    return let(arr, lambda x: F.slice(F.zip_with(x, F.slice(x, F.lit(gap + 1), F.greatest(F.size(x), F.lit(1))), f), F.lit(1), F.greatest(F.size(x) - gap, F.lit(0))))


def fingerprint(text: Column, k_doublings: int = K_DOUBLINGS, w_doublings: int = W_DOUBLINGS) -> Column:
    none = F.array().cast("array<bigint>")
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]{1,16}"), F.lit(0))

    def grams(hashes: Column) -> Column:
        out = hashes
        for i in range(k_doublings):
            out = _neighbours(out, 1 << i, lambda a, b: F.xxhash64(a, b))
        return F.when(F.size(hashes) >= 1 << k_doublings, out).when(F.size(hashes) > 0, F.array(F.xxhash64(hashes))).otherwise(none)

    def minima(keys: Column) -> Column:
        least = keys
        for i in range(w_doublings):
            least = _neighbours(least, 1 << i, lambda a, b: F.least(a, b))
        return F.when(F.size(keys) >= 1 << w_doublings, least).when(F.size(keys) > 0, F.array(F.array_min(keys))).otherwise(none)

    keyed = F.transform(let(F.transform(words, lambda x: F.xxhash64(x)), grams), lambda h, i: F.shiftleft(F.shiftrightunsigned(h, 32), 31).bitwiseOR(F.lit(POSITION) - i))
    return F.array_distinct(let(keyed, minima))


def hashes(fp: Column) -> Column:
    return F.array_distinct(F.transform(fp, lambda x: F.shiftright(x, 31)))


def positions(fp: Column) -> Column:
    return F.transform(fp, lambda x: F.lit(POSITION) - x.bitwiseAND(F.lit(POSITION)))


def located(docs: DataFrame) -> DataFrame:
    """doc_id, hash, position (of the gram's first token, from 0) of every kept hash: where matches between documents are looked up."""
    fp = fingerprint(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(fp).alias("f"))
    return rows.select("doc_id", F.shiftright("f", 31).alias("hash"), (F.lit(POSITION) - F.col("f").bitwiseAND(F.lit(POSITION))).alias("position"))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two fingerprints' hashes."""

    def jaccard(x: Column, y: Column) -> Column:
        share = lambda common: F.when(F.size(x) + F.size(y) == 0, F.lit(1.0)).otherwise(common / (F.size(x) + F.size(y) - common))
        return let(F.size(F.array_intersect(x, y)), share)

    return let(hashes(a), lambda x: let(hashes(b), lambda y: jaccard(x, y)))


def _digest(fp: Column) -> Column:
    return F.sha2(fp.cast("string"), 256)


def _following(keys: DataFrame) -> DataFrame:
    """(key, next) for distinct long keys, ascending; the last is followed by the first. By ranges of 2**STEP_BITS keys."""
    if keys.count() <= 1 << STEP_BITS:
        w = Window.orderBy("key")
        return keys.select("key", F.coalesce(F.lead("key").over(w), F.min("key").over(w)).alias("next"))
    ranges = keys.withColumn("range", F.shiftright("key", STEP_BITS))
    heads = ranges.groupBy("range").agg(F.min("key").alias("head"))
    after = _following(heads.select(F.col("range").alias("key"))).withColumnsRenamed({"key": "range", "next": "next_range"})
    after = after.join(heads.withColumnsRenamed({"range": "next_range", "head": "next_head"}), "next_range").select("range", "next_head")
    within = ranges.withColumn("next", F.lead("key").over(Window.partitionBy("range").orderBy("key")))
    return within.join(after, "range").select("key", F.coalesce("next", "next_head").alias("next"))


def compared_with_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_hashes for each row."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    run = F.shiftright(F.coalesce("doc_id", F.lit(NO_ID)), RUN_BITS)
    src = src.withColumn("run", run)
    w = Window.partitionBy("run").orderBy(F.col("doc_id").asc_nulls_last(), "text")
    laid = src.withColumns({"next": F.lead("text").over(w), "place": F.row_number().over(w)})
    own = laid.withColumn("fp", fingerprint(F.col("text"))).withColumn("next_fp", F.lead("fp").over(w))
    done = _edited(own).withColumns(
        {
            "head": F.when(F.col("place") == 1, F.col("text")),
            "tail": F.when(F.col("next").isNull(), F.col("text")),
        }
    )
    done = materialize(done.drop("text", "next", "next_fp", "fp", "place"), "winnowed")
    inner = done.where(F.col("tail").isNull())
    ends = done.where(F.col("tail").isNotNull())
    after = _following(materialize(done.select(F.col("run").alias("key")).distinct(), "runs"))
    heads = done.where(F.col("head").isNotNull()).select(F.col("run").alias("next_run"), F.col("head").alias("next"))
    last = ends.select("doc_id", "run", F.col("tail").alias("text")).join(after.withColumnsRenamed({"key": "run", "next": "next_run"}), "run").join(heads, "next_run")
    last = _edited(last.withColumn("fp", fingerprint(F.col("text"))).withColumn("next_fp", fingerprint(F.col("next"))))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_hashes"]
    return inner.select(*names).unionByName(last.select(*names))


def _edited(rows: DataFrame) -> DataFrame:
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next", F.lit(1), half)))
    rows = rows.withColumn("edited_fp", fingerprint(F.col("edited")))
    return rows.withColumns(
        {
            "edited_sha256": F.sha2("edited", 256),
            "fingerprint": _digest(F.col("fp")),
            "edited_fingerprint": _digest(F.col("edited_fp")),
            "near_edited": likeness(F.col("fp"), F.col("edited_fp")),
            "near_next": likeness(F.col("fp"), F.col("next_fp")),
            "n_hashes": F.size("fp"),
        }
    ).drop("edited", "edited_fp")
