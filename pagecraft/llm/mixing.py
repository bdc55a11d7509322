"""Mixing sources to target weights.

Each source's documents, in the order of (hash bucket of doc_id, doc_id), are one stream of words, packed into blocks of
a fixed length. A source's target in words becomes slots: whole epochs over its blocks, then a part of one, whose last
slot is cut so that the words fit the target exactly. Every slot falls into a uniformly drawn output
shard, so a shard's source counts are a multinomial draw given the totals. Slot k of an epoch maps to a block by
the source's own pseudorandom permutation (swap-or-not rounds, a bijection on any range), and blocks are joined
to documents by index.

Running offsets come from sums by bucket, whose number follows the number of rows, so no source is ordered in one task, and slots
are made from ranges of slots that are dealt out by index. Only the targets, one row for each source, are made in one task.

The rows themselves (remixed) come as whole documents, rounded along each source without bias.

Defined results: null text has size 0; a null source is a source of its own, last; rows of size 0 take 0;
repeated rows are separate stretches of the stream; ties in a bucket go by doc_id, then size; a long text is taken by its
words like all others, in parts; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagecraft.llm.common import checked_broadcast, discard, materialize

BLOCK = 64
SHARD_SLOTS = 4096
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
#: Rows of a bucket, about, if all were of one source, and the least number of buckets.
BUCKET_ROWS, BUCKETS = 4096, 1 << 10
ROUNDS = 10
#: Slots are made in ranges of this many, and so many ranges to a task.
CHUNK, TASK_CHUNKS = 2048, 32
#: Rounding to whole documents: classes of sizes to a doubling, buckets of a class, and the unit of a copy's fractions.
CLASSES, CLASS_BUCKETS, UNIT = 8, 64, 1 << 32


def buckets_for(rows: int) -> int:
    return max(BUCKETS, -(-rows // BUCKET_ROWS))


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) of (source, source_size), one row for each source: shares by weight up to a multiple
    of the size, the excess shared again until none is above."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    by = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(most))
    level = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    prior = level.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    by = by.withColumns(
        {
            "full": F.coalesce(F.sum("cap").over(prior), F.lit(0.0)),
            "open": F.sum("w").over(level.rowsBetween(0, Window.unboundedFollowing)),
            "all": F.sum("source_size").over(whole) * F.lit(share),
        }
    )
    by = by.withColumn("rate", (F.col("all") - F.col("full")) / F.col("open"))
    by = by.withColumn("below", F.when(F.col("rate") * F.col("w") <= F.col("cap"), F.col("rate")))
    rate = F.first("below", ignorenulls=True).over(level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return by.select("source", "source_size", F.least(F.col("cap"), F.coalesce(rate * F.col("w"), F.col("cap"))).alias("target"))


def permuted(index: Column, n: Column, *key: Column, rounds: int = ROUNDS, inverse: bool = False) -> Column:
    """A keyed bijection on 0..n-1: in each round an index may change places with its mirror, as a hash of the
    pair's larger member tells. Each round undoes itself, so the inverse takes them in reverse."""
    start = F.struct(index.alias("x"))

    def step(acc: Column, r: Column) -> Column:
        turn = F.pmod(F.xxhash64(F.lit("turn"), r, n, *key), n)
        other = F.pmod(turn - acc["x"], n)
        swap = F.xxhash64(F.lit("swap"), r, F.greatest(acc["x"], other), n, *key) % 2 == 0
        return F.struct(F.when(swap, other).otherwise(acc["x"]).alias("x"))

    order = F.sequence(F.lit(rounds), F.lit(1)) if inverse else F.sequence(F.lit(1), F.lit(rounds))
    return F.aggregate(order, start, step, lambda acc: acc["x"])


def streams(docs: DataFrame, *also: Column) -> DataFrame:
    """(doc_id, source, size, also, sid, off, source_size, target): where each row lies in its source's stream."""
    rows = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), *also)
    more = rows.columns[3:]
    rows = materialize(rows.withColumn("sid", F.xxhash64(F.lit("source"), F.coalesce("source", F.lit("")), F.col("source").isNull())), "mix-sizes")
    # By size too, so that rows that repeat an id, or have none, do not meet in one bucket.
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit("bucket"), "doc_id", "size", *more), F.lit(buckets_for(rows.count()))))
    sums = rows.groupBy("sid", "source", "bucket").agg(F.sum("size").alias("in_bucket"))
    sums = materialize(sums, "mix-buckets")
    ahead = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("sid", "bucket", F.coalesce(F.sum("in_bucket").over(ahead), F.lit(0).cast("long")).alias("base"))
    aim = materialize(targets(sums.groupBy("source").agg(F.sum("in_bucket").alias("source_size"))), "mix-targets")
    aim = aim.withColumn("sid", F.xxhash64(F.lit("source"), F.coalesce("source", F.lit("")), F.col("source").isNull())).drop("source")
    within = Window.partitionBy("sid", "bucket").orderBy("doc_id", "size", *more).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("off", F.coalesce(F.sum("size").over(within), F.lit(0).cast("long")))
    return rows.join(base, ["sid", "bucket"]).withColumn("off", F.col("off") + F.col("base")).drop("base", "bucket").join(checked_broadcast(aim, 64), "sid")


def slots(aim: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(shard, sid, slot, block, words) for every slot of the mix, from one row (sid, source_size, target) for each source."""
    n = F.ceil(F.col("source_size") / F.lit(block)).cast("long")
    budget = F.floor(F.col("target") + F.lit(0.5)).cast("long")
    per = aim.where("source_size > 0").withColumns({"n": n, "budget": budget, "tail": F.col("source_size") - (n - 1) * block})
    per = per.withColumns({"epochs": F.floor(F.col("budget") / F.col("source_size")).cast("long"), "rest": F.col("budget") % F.col("source_size")})
    # The stream's last block may be short; where its place among the part's slots falls decides how many slots fill the rest.
    per = per.withColumn("count", F.col("epochs") * F.col("n") + F.ceil((F.col("rest") + (F.lit(block) - F.col("tail"))) / F.lit(block)).cast("long"))
    per = per.withColumn("count", F.least("count", (F.col("epochs") + 1) * F.col("n"))).where("count > 0")
    per = per.withColumn("short_place", permuted(F.col("n") - 1, F.col("n"), F.col("sid"), F.col("epochs"), inverse=True))
    shards = F.greatest(F.lit(1).cast("long"), F.ceil(F.sum("count").over(Window.partitionBy()) / F.lit(shard_slots)).cast("long"))
    per = per.withColumn("shards", shards)
    parts = per.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("count") - 1) / F.lit(CHUNK)).cast("long"))))
    # A number of partitions of its own, as adaptive execution would put these few small rows into one task.
    ranges = per.agg(F.sum(F.ceil(F.col("count") / F.lit(CHUNK)))).first()[0] or 0
    parts = parts.repartition(max(1, -(-ranges // TASK_CHUNKS)), "sid", "part")
    low = F.col("part") * CHUNK
    each = parts.withColumn("slot", F.explode(F.sequence(low, F.least(low + CHUNK, F.col("count")) - 1)))
    each = each.withColumns({"epoch": F.floor(F.col("slot") / F.col("n")).cast("long"), "place": F.col("slot") % F.col("n")})
    each = each.withColumn("block", permuted(F.col("place"), F.col("n"), F.col("sid"), F.col("epoch")))
    each = each.withColumn("length", F.when(F.col("block") == F.col("n") - 1, F.col("tail")).otherwise(F.lit(block).cast("long")))
    # Words before a slot of the last, partial epoch: whole blocks, less what the short block lacks if it came before.
    lack = F.when(F.col("short_place") < F.col("place"), F.lit(block) - F.col("tail")).otherwise(F.lit(0))
    left = F.col("rest") - (F.col("place") * block - lack)
    words = F.when(F.col("epoch") < F.col("epochs"), F.col("length")).otherwise(F.greatest(F.lit(0).cast("long"), F.least("length", left)))
    shard = F.pmod(F.xxhash64(F.lit("shard"), "sid", "slot"), F.col("shards"))
    return each.select(shard.alias("shard"), "sid", "slot", "block", words.alias("words")).where("words > 0")


def shard_counts(picked: DataFrame) -> DataFrame:
    return picked.groupBy("shard", "sid").agg(F.count("*").alias("slots"), F.sum("words").alias("words"))


def mixed(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every row of docs."""
    return _taken(docs, block).select("doc_id", "source", "size", "source_size", "target", "taken")


def _taken(docs: DataFrame, block: int, *also: Column) -> DataFrame:
    """The rows of streams() with the words taken of each."""
    rows = materialize(streams(docs, *also), "mix-streams")
    aim = rows.select("sid", "source_size", "target").distinct()
    picked = slots(aim, block)
    use = picked.groupBy("sid", "block").agg(F.count_if(F.col("words") > 0).alias("times"), F.sum("words").alias("words"), F.collect_list("words").alias("each"))
    low, high = F.floor(F.col("off") / block), F.floor((F.col("off") + F.col("size") - 1) / block)
    pieces = rows.where("size > 0").select("sid", "off", "size", F.explode(F.sequence(low, high)).alias("block"))
    begin = F.greatest(F.col("off") - F.col("block") * block, F.lit(0).cast("long"))
    end = F.least(F.col("off") + F.col("size") - F.col("block") * block, F.lit(block).cast("long"))
    pieces = pieces.withColumns({"begin": begin, "end": end})
    got = pieces.join(use.select("sid", "block", "each"), ["sid", "block"])
    zero = F.lit(0).cast("long")
    got = got.withColumn("got", F.aggregate("each", zero, lambda s, w: s + F.greatest(zero, F.least(w, F.col("end")) - F.col("begin"))))
    got = got.groupBy("sid", "off", "size").agg(F.sum("got").alias("taken"))
    return rows.join(got, ["sid", "off", "size"], "left").withColumn("taken", F.coalesce("taken", zero))


def packed(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """shard, slot, source, n_words, text: the mix itself, one row for each slot with the words that it takes, in their order. A block
    has at most block words, so what is gathered for a slot is bounded."""
    rows = materialize(streams(docs, F.col("text")), "mix-texts")
    aim = rows.select("sid", "source_size", "target").distinct()
    low, high = F.floor(F.col("off") / block), F.floor((F.col("off") + F.col("size") - 1) / block)
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    cut = rows.where("size > 0").withColumn("words", words).select("sid", "source", "off", "size", "words", F.explode(F.sequence(low, high)).alias("block"))
    first = F.greatest(F.col("block") * block - F.col("off"), F.lit(0).cast("long"))
    part = F.slice("words", (first + 1).cast("int"), F.least(F.col("size"), (F.col("block") + 1) * block - F.col("off")).cast("int") - first.cast("int"))
    pieces = cut.select("sid", "block", F.struct("off", part.alias("words")).alias("piece"), "source")
    found = slots(aim, block).join(pieces, ["sid", "block"]).groupBy("shard", "sid", "slot", "words").agg(F.array_sort(F.collect_list("piece")).alias("pieces"), F.first("source").alias("source"))
    taken = F.slice(F.flatten(F.transform("pieces", lambda p: p["words"])), F.lit(1), F.col("words").cast("int"))
    return found.select("shard", "slot", "source", F.col("words").alias("n_words"), F.array_join(taken, " ").alias("text"))


def with_copies(rows: DataFrame) -> DataFrame:
    """rows (sid, off, size > 0, taken, ...) with copies: taken / size, rounded so that each row's expectation is exact.

    Each source's rows, by size, are laid end to end by their fractions, from a start drawn by the source; a row gets one
    copy more if a whole number falls into it. Counts never run ahead or behind by one copy, and as neighbours are of like
    size, a source's words stay within some of its largest documents of those taken. The running sums come from sums by bucket."""
    part = F.floor((F.col("taken") % F.col("size")) * F.lit(UNIT) / F.col("size")).cast("long")
    rows = rows.withColumns({"part": part, "class": F.floor(F.log2(F.col("size")) * CLASSES).cast("int"), "bucket": F.pmod(F.xxhash64(F.lit("copies"), "off"), F.lit(CLASS_BUCKETS))})
    keys = ["sid", "class", "bucket"]
    sums = rows.groupBy(*keys).agg(F.sum("part").alias("in_bucket"))
    before = Window.partitionBy("sid").orderBy("class", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    start = F.pmod(F.xxhash64(F.lit("start"), "sid"), F.lit(UNIT))
    base = sums.select(*keys, (start + F.coalesce(F.sum("in_bucket").over(before), F.lit(0))).alias("base"))
    within = Window.partitionBy(*keys).orderBy("size", "off").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("stop", F.sum("part").over(within)).join(base, keys).withColumn("stop", F.col("stop") + F.col("base"))
    passed = lambda x: F.shiftright(x, UNIT.bit_length() - 1)
    copies = F.floor(F.col("taken") / F.col("size")) + passed(F.col("stop")) - passed(F.col("stop") - F.col("part"))
    return rows.withColumn("copies", copies.cast("int")).drop("part", "class", "bucket", "stop", "base")


def remixed(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """docs, each row as often as the mix takes its words, rounded without bias. Rows of size 0 are not taken."""
    digest = F.xxhash64("text")
    names = {"doc_id": "_id", "source": "_source", "size": "_size", "_digest": "_digest"}
    rows = with_copies(_taken(docs, block, digest.alias("_digest")).where("size > 0"))
    # Rows that repeat id, source and text share their copies.
    times = rows.groupBy(*[F.col(c).alias(n) for c, n in names.items()]).agg(F.count("*").alias("_n"), F.sum("copies").alias("_sum"))
    times = materialize(times.where("_sum > 0"), "mix-copies")

    def joined(some: DataFrame) -> DataFrame:
        on = docs["doc_id"].eqNullSafe(some["_id"]) & docs["source"].eqNullSafe(some["_source"]) & (size_of(docs["text"]) == some["_size"]) & (digest_of == some["_digest"])
        return docs.join(some, on)

    def repeated(rows: DataFrame, n: Column) -> DataFrame:
        each = F.explode(F.sequence(F.lit(1).cast("long"), n)).alias("_copy_of_row")
        return rows.select(*[F.col(f"`{c}`") for c in docs.columns], each).drop("_copy_of_row")

    digest_of = F.xxhash64(docs["text"])
    whole = F.floor(F.col("_sum") / F.col("_n"))
    out = repeated(joined(times.where(whole > 0)), whole)
    rest = times.where((F.col("_n") > 1) & (F.col("_sum") % F.col("_n") > 0))
    if rest.isEmpty():
        return out
    one = joined(rest).groupBy("_id", "_source", "_size", "_digest").agg(F.first(F.struct(*[docs[c] for c in docs.columns])).alias("_r"), F.first(F.col("_sum") % F.col("_n")).alias("_more"))
    return out.unionByName(repeated(one.select("_r.*", "_more"), F.col("_more")))
