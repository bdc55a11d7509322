"""Shared helpers: tables, scratch tables in the shared folder, size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only if it was counted and is below this many bytes.
BROADCAST_BYTES = 8 << 20
#: Arrow batches between the JVM and Python hold about this many bytes; a longer row makes a batch of its own.
BATCH_BYTES = 2 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """df, with the session's Arrow batches bounded in bytes, as a batch of rows of any length is held several times over."""
    conf = df.sparkSession.conf
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(conf.get(name).rstrip("b") or 0) <= BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it; in local mode a folder of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="pagecraft-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back, which cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table that materialize() wrote and that no later plan reads."""
    path = getattr(df, "_scratch_path", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def checked_broadcast(df: DataFrame, row_bytes: int, n: int | None = None) -> DataFrame:
    """Hint a broadcast if the counted rows fit BROADCAST_BYTES; otherwise leave the join to shuffle."""
    n = df.count() if n is None else n
    return F.broadcast(df) if n * row_bytes <= BROADCAST_BYTES else df


#: At most this many keys can each have more than one in this many of all rows.
HOT_KEYS = 50_000


def joined_by_size(big: DataFrame, small: DataFrame, on: list[str], uses: str, row_bytes: int, least: int = 1000) -> DataFrame:
    """big (a written table) joined with small, which has one row for each key with the number of its rows in big. Keys with more than one in
    HOT_KEYS of big's rows, at most HOT_KEYS by that, are broadcast, so no task receives all rows of such a key; the rest shuffle."""
    hot = F.col(uses) > max(least, big.count() // HOT_KEYS)
    heavy = small.where(hot)
    n = heavy.count()
    if not n:
        return big.join(small, on)
    light = big.join(checked_broadcast(heavy.select(*on), row_bytes, n), on, "left_anti")
    out = big.join(checked_broadcast(heavy, row_bytes, n), on)
    return out.unionByName(light.join(small.where(~hot), on).select(*out.columns))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32(doc_id as text) mod n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def let(value: Column, use) -> Column:
    """use(value) with value computed once for a row. An expression that is named twice in array functions is otherwise
    computed twice, and again in each step that builds on it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def prefix_sums(arr: Column, group: int = 64, levels: int = 2) -> Column:
    """Exclusive prefix sums of an array of longs, by groups so that no step copies the whole array; the groups' own sums likewise, levels
    deep, so that the work is in proportion to the array until it has far more than group**levels items."""
    zero = F.lit(0).cast("long")
    total = lambda a: F.aggregate(a, zero, lambda s, x: s + x)

    def grouped(a: Column) -> Column:
        n_groups = F.ceil(F.size(a) / F.lit(group)).cast("int")
        groups = F.when(n_groups > 0, F.sequence(F.lit(0), n_groups - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(groups, lambda k: total(F.slice(a, k * group + 1, F.lit(group))))

    def running(sums: Column) -> Column:
        return F.transform(sums, lambda _, k: total(F.slice(sums, F.lit(1), k)))

    def all_(a: Column) -> Column:
        inner = lambda i: total(F.slice(a, (i - i % group + 1).cast("int"), (i % group).cast("int")))
        ahead = let(grouped(a), running) if levels == 1 else prefix_sums(grouped(a), group, levels - 1)
        return let(ahead, lambda before: F.transform(a, lambda _, i: F.get(before, F.floor(i / F.lit(group)).cast("int")) + inner(i)))

    return let(arr, all_)
