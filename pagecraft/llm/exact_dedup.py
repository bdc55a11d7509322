"""Exact dedup by deterministic block naming.

A text, without the characters `[\\x20\\x09-\\x0D]`, is cut into blocks of a fixed size. Distinct blocks are
sorted into integer names; adjacent names are paired and the distinct pairs are named in turn, until every
row has one integer. Two rows have equal (level, name) exactly if their normalised texts are equal.

Blocks travel by content once, pre-aggregated per task, so a group of copies costs one row per task. Elsewhere a
128-bit key stands for a block; that no two distinct blocks share a key is verified on the contents, and
another salt is taken if any do, so the result never rests on a hash. Blocks, pairs and groups are counted, and the rows of a
frequent one meet its name by broadcast, in whatever task they are.

Defined results: null text counts as empty; empty texts are equal; repeated rows are members of their group, one of
which stays; a null doc_id loses ties; long texts are compared whole, a level of names for each doubling of their length; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagecraft.llm.common import checked_broadcast, discard, joined_by_size, materialize

BLOCK = 1024
#: Keys of a bucket, about, and the least number of buckets.
BUCKET_KEYS, NAME_BUCKETS = 4096, 1 << 14


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def blocks_of(norm: Column, size: int) -> Column:
    cut = F.regexp_extract_all(norm, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(F.size(cut) > 0, cut).otherwise(F.array(F.lit("")))


def block_key(block: Column, salt: int) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(F.lit(f"{salt}:"), block), 256), 1, 32))


def named(keys: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct keys (a written table: cols, uses) with a collision-free positive integer: the rank in the sorted bucket, and the bucket."""
    buckets = max(NAME_BUCKETS, -(-keys.count() // BUCKET_KEYS))
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(*cols)).cast("long")
    placed = keys.withColumn("bucket", F.pmod(F.xxhash64(*cols), F.lit(buckets)))
    return placed.select(*cols, "uses", (rank * buckets + F.col("bucket")).alias("name"))


def identities(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows (rid, doc_id, n_chars, text_sha256, level, name), one for each row of docs."""
    salt = 0
    base = docs.select("doc_id", "text").withColumn("norm", normalised(F.col("text")))
    while True:
        cut = base.withColumn("blocks", blocks_of(F.col("norm"), block))
        contents = cut.select(F.explode("blocks").alias("b")).select(block_key(F.col("b"), salt).alias("key"), "b").groupBy("key", "b").agg(F.count("*").alias("n"))
        keys = materialize(contents.groupBy("key").agg(F.count("*").alias("contents"), F.sum("n").alias("uses")), "block-keys")
        if keys.where("contents > 1").isEmpty():
            break
        discard(keys)
        salt += 1
    rows = materialize(
        cut.select(
            "doc_id",
            F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
            F.sha2("norm", 256).alias("text_sha256"),
            F.transform("blocks", lambda b: block_key(b, salt)).alias("keys"),
        ).withColumn("rid", F.monotonically_increasing_id()),
        "block-rows",
    )
    places = rows.select("rid", F.posexplode("keys").alias("pos", "key"))
    joined = joined_by_size(places, named(keys.select("key", "uses"), ["key"]), ["key"], "uses", 96)
    active, level, done = materialize(_gathered(joined), "names-0"), 0, None
    discard(keys)
    while True:
        ended = active.where(F.size("names") == 1).select("rid", F.lit(level).alias("level"), F.col("names")[0].alias("name"))
        done = ended if done is None else done.unionByName(ended)
        longer = active.where(F.size("names") > 1)
        if longer.isEmpty():
            break
        level += 1
        name = F.col("names")
        steps = F.sequence(F.lit(0), F.floor((F.size(name) - 1) / 2).cast("int"))
        pairs = longer.select(
            "rid",
            F.posexplode(F.transform(steps, lambda i: F.struct(F.get(name, i * 2).alias("a"), F.coalesce(F.get(name, i * 2 + 1), F.lit(0).cast("long")).alias("b")))).alias("pos", "p"),
        ).select("rid", "pos", "p.a", "p.b")
        distinct = materialize(pairs.groupBy("a", "b").agg(F.count("*").alias("uses")), f"pairs-{level}")
        active = materialize(_gathered(joined_by_size(pairs, named(distinct, ["a", "b"]), ["a", "b"], "uses", 96)), f"names-{level}")
        discard(distinct)
    return rows.drop("keys").join(done, "rid")


def _gathered(items: DataFrame) -> DataFrame:
    """A row's names in order; their number is bounded by the document's own length."""
    listed = F.array_sort(F.collect_list(F.struct("pos", "name")))
    return items.groupBy("rid").agg(F.transform(listed, lambda x: x["name"]).alias("names"))


def decisions(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of docs."""
    ids = materialize(identities(docs, block), "identities")
    best = F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("rid").alias("rid"))
    groups = ids.groupBy("level", "name").agg(F.min(best).alias("best"), F.count("*").alias("group_size"))
    groups = materialize(groups, "groups")
    return joined_by_size(ids, groups, ["level", "name"], "group_size", 128).select(
        "doc_id", F.col("best.id").alias("keep_id"), "group_size", (F.col("rid") == F.col("best.rid")).alias("kept"), "text_sha256"
    )


def deduplicated(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """docs without the rows that are dropped; of rows that repeat both id and text, one stays."""
    per = materialize(
        decisions(docs, block).groupBy("doc_id", "text_sha256").agg(F.count_if("kept").alias("stay"), F.count("*").alias("n")).where("n > stay"), "exact-dropped"
    ).withColumnRenamed("doc_id", "_id").withColumnRenamed("text_sha256", "_sha")
    sha = F.sha2(normalised(docs["text"]), 256)
    on = docs["doc_id"].eqNullSafe(per["_id"]) & (sha == per["_sha"])
    n = per.count()
    if not n:
        return docs
    rest = docs.join(checked_broadcast(per, 120, n), on, "left_anti")
    again = per.where("stay > 0")
    if again.isEmpty():
        return rest
    # Rows that repeat an id and a normalised text: the longest original text stays.
    twice = docs.join(checked_broadcast(again, 120), docs["doc_id"].eqNullSafe(again["_id"]) & (sha == again["_sha"]), "left_semi")
    order = F.struct(F.char_length(F.coalesce("text", F.lit(""))), F.coalesce("text", F.lit("")))
    one = twice.groupBy(F.col("doc_id").alias("_id"), sha.alias("_sha")).agg(F.max_by(F.struct(*docs.columns), order).alias("r")).select("r.*")
    return rest.unionByName(one)
