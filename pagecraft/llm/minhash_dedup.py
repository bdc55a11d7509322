"""Near-dedup: one-permutation hashing with optimal densification, banded buckets, star-shaped candidate edges.

Each row's set of word shingles is hashed once; the hash space has K bins, each bin's minimum is the signature and an
empty bin borrows from the bin that its own sequence of universal hashes reaches first. Bands of R bins are buckets.
Rows with equal sets form one node, so copies never multiply. A bucket's most central node is linked to all others, and
each such edge is confirmed on the full sets. Those of a star that stay in other components than its centre make a star
of their own, around a member of the component that most of them share, while more than RARE share one.

What is left is searched exactly, star by star, among pairs of different components. Of an item that occurs once in a star
beyond its centre nothing can be shared, so a member with too few items that others have is done. Else two members share at
most what both share with the centre, what both have of the frequent other items, and their common rare items. A rare item
occurs at most RARE times in its star, so the join on rare items grows in proportion to the input. Members look up the
rarest of theirs only, as many as the bound needs. Pairs that the bounds leave are confirmed on the full sets. Nothing is capped.

Words are 64-bit hashes, and a shingle is a hash of its words': two texts of n shingles have a false match with probability
n**2 / 2**64, about 5e-12 for 10,000 shingles. A pair at similarity 0.8 shares no bucket with probability 5e-8.

Defined results: null and empty texts have an empty set and are linked with nothing; fewer words than a shingle has
give one shingle of all words; repeated rows are linked; a null doc_id never names a component while another member has
an id; ties between centres go to the larger identifier; long texts are worked on whole; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagecraft.llm.common import checked_broadcast, discard, materialize, small_batches
from pagecraft.llm.textkernel import chunks, mix, tokens

BANDS, ROWS = 32, 4
#: An item that occurs more often than this among the members of a star is bounded by counts, not joined; and so many
#: members of one component, beside the centre's, may meet in the last of a star's searches.
RARE = 32
#: Rows that repeat no id come after all ids.
NO_ID = (1 << 63) - 1


def shingle_sets(text: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, offsets, sorted distinct shingle hashes of each row) of each chunk of texts."""
    for lo, hi, buf, ends in chunks(text):
        doc, _, _, h = tokens(buf, ends, lower=True)
        rows = hi - lo
        n = np.bincount(doc, minlength=rows)
        first = np.concatenate([[0], np.cumsum(n)])
        take = np.where(n == 0, 0, np.maximum(n - width + 1, 1))
        starts = np.concatenate([[0], np.cumsum(take)])
        which = np.repeat(np.arange(rows), take)
        at = np.arange(starts[-1]) - np.repeat(starts[:-1], take) + np.repeat(first[:-1], take)
        key = np.zeros(len(at), np.uint64)
        for k in range(width):
            inside = at + k < np.repeat(first[1:], take)
            part = h[np.minimum(at + k, max(len(h) - 1, 0))] if len(h) else h
            key = np.where(inside, mix(key * np.uint64(0x9E3779B97F4A7C15) + part + np.uint64(k + 1)), key)
        if rows == 1:
            key = np.unique(key)
            yield lo, 1, np.array([0, len(key)], np.int64), key
            continue
        order = np.lexsort((key, which))
        key, which = key[order], which[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (which[1:] != which[:-1])
        key, which = key[new], which[new]
        yield lo, rows, np.concatenate([[0], np.cumsum(np.bincount(which, minlength=rows))]).astype(np.int64), key


def signatures(offsets: np.ndarray, key: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation minima (rows x bins) with optimal densification; rows with an empty set stay all ones."""
    rows = len(offsets) - 1
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    sig = np.full(rows * bins, none, np.uint64)
    which = np.repeat(np.arange(rows), np.diff(offsets))
    mixed = mix(key ^ np.uint64(0x5851F42D4C957F2D))
    cell = which * bins + (mixed >> np.uint64(40)).astype(np.int64) % bins
    value = mix(mixed + np.uint64(1)) >> np.uint64(1)
    order = np.lexsort((value, cell))
    cell, value = cell[order], value[order]
    head = np.ones(len(cell), bool)
    head[1:] = cell[1:] != cell[:-1]
    sig[cell[head]] = value[head]
    sig = sig.reshape(rows, bins)
    full = sig != none
    live = full.any(axis=1)
    row, col = np.nonzero(~full & live[:, None])
    attempt = 0
    while len(row):
        attempt += 1
        other = (mix(col.astype(np.uint64) * np.uint64(1_000_003) + np.uint64(attempt << 20)) >> np.uint64(33)).astype(np.int64) % bins
        ok = full[row, other]
        sig[row[ok], col[ok]] = mix(sig[row[ok], other[ok]] + np.uint64(attempt))
        row, col = row[~ok], col[~ok]
    return sig


def _digest(key: np.ndarray) -> bytes:
    return hashlib.blake2b(key.tobytes(), digest_size=16).digest()


def _signed(width: int, bands: int, rows_per_band: int):
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("n_shingles", pa.int64()), ("node", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            ids, digests = batch.column(0), batch.column(2)
            for lo, rows, offsets, key in shingle_sets(batch.column(1), width):
                sig = signatures(offsets, key, bands * rows_per_band).reshape(rows, bands, rows_per_band)
                band = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (rows, bands)).copy()
                for k in range(rows_per_band):
                    band = mix(band * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, k])
                n = np.diff(offsets)
                some = n > 0
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(np.where(some, bands, 0))]).astype(np.int32)), pa.array(band[some].reshape(-1).view(np.int64))
                )
                node = [_digest(key[offsets[i] : offsets[i + 1]]) if some[i] else None for i in range(rows)]
                yield pa.RecordBatch.from_arrays([ids.slice(lo, rows), digests.slice(lo, rows), pa.array(n.astype(np.int64)), pa.array(node, pa.binary()), lists], schema=schema)

    return run


def _sets(width: int):
    schema = pa.schema([("node", pa.binary()), ("items", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            for _, rows, offsets, key in shingle_sets(batch.column(0), width):
                node = [_digest(key[offsets[i] : offsets[i + 1]]) for i in range(rows)]
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(key.view(np.int64)))], schema=schema)

    return run


#: Edges that a task of the components' iterations writes.
PART_EDGES = 200_000


def connected(edges: DataFrame) -> DataFrame:
    """(v, root) for every node of edges (u, v) but the roots, the least nodes: alternating large and small stars until nothing changes."""
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            out = now.select(F.col("u").alias("v"), F.col("v").alias("root"))
            out._scratch_path = now._scratch_path
            return out
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        new = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        after = materialize(new.distinct().coalesce(1 + state[0] // PART_EDGES), "cc")
        discard(now)
        now = after


def _similar(common, n, m, percent: int):
    return common * 100 >= (n + m - common) * percent


def _rooted(df: DataFrame, root: DataFrame, node: str, name: str) -> DataFrame:
    """df with the component of a node column; a node without links is its own."""
    return df.join(root.select(F.col("v").alias(node), F.col("root").alias(name)), node, "left").withColumn(name, F.coalesce(name, node))


def _merged(root: DataFrame, links: DataFrame) -> DataFrame:
    """root after links (root_u, root_v) between components."""
    more = connected(links.select(F.col("root_u").alias("u"), F.col("root_v").alias("v")))
    onward = more.select(F.col("v").alias("root"), F.col("root").alias("onward"))
    out = materialize(root.join(onward, "root", "left").select("v", F.coalesce("onward", "root").alias("root")).unionByName(more), "roots")
    discard(root)
    discard(more)
    return out


def near_groups(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row; links have 100 * intersection >= percent * union."""
    out = _grouped(docs, F.lit(None).cast("binary"), width, percent, bands, rows)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _grouped(docs: DataFrame, digest: Column, width: int, percent: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, digest, n_shingles, root, component_id for every row; root names the component, and is null for an empty set."""
    src = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), digest.alias("digest"))
    signed = src.mapInArrow(_signed(width, bands, rows), "doc_id long, digest binary, n_shingles long, node binary, bands array<bigint>")
    signed = materialize(signed, "signed")
    # A node is named by its least id, so that a component's least node names the component, and by a number of its own.
    nodes = signed.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    key = F.struct(F.coalesce("first_id", F.lit(NO_ID)).alias("id"), F.monotonically_increasing_id().alias("k"))
    nodes = materialize(nodes.select("node", key.alias("v"), "n", "bands"), "nodes")
    root = _linked(src.select("doc_id", "text"), nodes, width, percent)
    of = _rooted(nodes.select("node", "v"), root, "v", "root")
    out = signed.select("doc_id", "digest", "n_shingles", "node").join(of.select("node", "root"), "node", "left")
    named = F.when(F.col("root.id") < NO_ID, F.col("root.id"))
    return out.select("doc_id", "digest", "n_shingles", "root", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(named).alias("component_id"))


def _linked(src: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """(v, root) for all nodes (node, v, n, bands) that are linked to a lesser one."""
    member = nodes.select(F.explode("bands").alias("bucket"), "v", "n")
    crowded = member.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    member = materialize(member.join(crowded, "bucket"), "crowded")
    # The more company a node has over all its buckets, the more central it is: the most central is its buckets' centre.
    weight = member.groupBy("v").agg(F.sum("size").alias("w_v"))
    placed = materialize(member.drop("size").join(weight, "v"), "buckets")
    discard(member)
    heads = placed.groupBy("bucket").agg(F.max(F.struct("w_v", "v", "n")).alias("c")).select("bucket", F.col("c.v").alias("u"), F.col("c.n").alias("n_u"))
    group = placed.join(heads, "bucket").where("v <> u").select(F.col("u").alias("star"), "u", "n_u", "v", F.col("n").alias("n_v"), "w_v").distinct()
    group = materialize(group, "star-0")
    discard(placed)
    sets = _sets_of(src, nodes.join(group.select("v").unionByName(group.select(F.col("u").alias("v"))).distinct(), "v", "left_semi"), width)
    levels, root = [], None
    while True:
        level = materialize(_compared(sets, group, extra=True), "star-compared")
        levels.append(level)
        discard(group)
        links = level.where(_similar(F.col("common"), F.col("n_u"), F.col("n_v"), percent))
        root = connected(links.select("u", "v")) if root is None else _merged(root, _rooted(_rooted(links.select("u", "v"), root, "u", "root_u"), root, "v", "root_v").where("root_u <> root_v"))
        out = materialize(_rooted(_rooted(level.select("star", "u", "v", "n_v", "w_v"), root, "u", "root_u"), root, "v", "root_v").where("root_u <> root_v"), "star-out")
        shared = out.groupBy("star", "root_v").agg(F.count("*").alias("c"), F.max(F.struct("w_v", "v", "n_v")).alias("best"))
        next_ = shared.groupBy("star").agg(F.max(F.struct("c", "best")).alias("m")).where(F.col("m.c") > RARE).select("star", F.col("m.best.v").alias("u"), F.col("m.best.n_v").alias("n_u"))
        group = materialize(out.drop("u", "root_u", "root_v").join(next_, "star").where("v <> u"), f"star-{len(levels)}")
        discard(out)
        if group.isEmpty():
            discard(group)
            break
    rows = reduce(DataFrame.unionByName, [x.withColumn("level", F.lit(i)) for i, x in enumerate(levels)])
    pairs = materialize(_remaining(_rooted(_rooted(rows, root, "u", "root_u"), root, "v", "root_v"), percent), "candidates")
    for level in levels:
        discard(level)
    found = _compared(sets, pairs).where(_similar(F.col("common"), F.col("n_u"), F.col("n_v"), percent)).select("root_u", "root_v").distinct()
    found = materialize(found, "links")
    root = root if found.isEmpty() else _merged(root, found)
    for gone in (sets, pairs, found):
        discard(gone)
    return root


def _least_common(n: Column, m: Column, percent: int) -> Column:
    """The least intersection with which sets of these sizes are similar."""
    return F.ceil((n + m) * percent / F.lit(100.0 + percent) - 1e-9).cast("long")


def _remaining(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v, n_u, n_v, root_u, root_v) of a star's members, of different components, that can still be similar. rows are the stars'
    members with what they share with the centre and what they have beyond it. Members that left for a later star are compared there:
    in an earlier one with those of the centre's component only, in the last one with all."""
    star = ["level", "star"]
    out = F.col("root_u") != F.col("root_v")
    rows = rows.select(*star, "v", "n_v", F.col("common").alias("a"), "extra", F.col("root_v").alias("root"), out.alias("out"))
    sums = rows.groupBy(*star).agg(F.count("*").alias("members"), F.count_if("out").alias("outer"), F.min("n_v").alias("n_min"))
    last = sums.groupBy("star").agg(F.max("level").alias("last"))
    sums = sums.where("outer > 0 AND members > 1").join(last, "star").select(*star, "n_min", (F.col("level") == F.col("last")).alias("last"))
    rows = materialize(rows.join(sums, star), "open")
    items = rows.select(*star, "v", F.explode("extra").alias("item"))
    often = items.groupBy(*star, "item").agg(F.count("*").alias("df")).where("df > 1")
    per = items.join(often, [*star, "item"]).groupBy(*star, "v")
    per = per.agg(F.count_if(F.col("df") > RARE).alias("f"), F.array_sort(F.collect_list(F.when(F.col("df") <= RARE, F.struct("df", "item")))).alias("rare"))
    rows = rows.drop("extra").join(per, [*star, "v"], "left").withColumns({"f": F.coalesce("f", F.lit(0)), "r": F.coalesce(F.size("rare"), F.lit(0))})
    need = _least_common(F.col("n_v"), F.greatest(F.col("n_min"), F.ceil(F.col("n_v") * percent / 100.0 - 1e-9).cast("long")), percent)
    rows = rows.withColumn("need", need).where("a + f + r >= need")
    bounded = materialize(rows, "bounded")
    names = ["v", "n_v", "a", "f", "r", "root", "out"]
    side = lambda df, s: df.select(*star, "last", *[F.col(c).alias(f"{c}_{s}") for c in names], *[c for c in df.columns if c == "item"])
    # At least one of a pair lies outside the centre's component, and looks the other up; both do in the last star only, where the lesser does.
    seeking, sought = bounded.where("out"), bounded.where("last OR NOT out")
    once = (F.col("root_x") != F.col("root_y")) & (~F.col("out_y") | (F.col("v_x") < F.col("v_y")))
    within = F.least("a_x", "a_y") + F.least("f_x", "f_y")
    most = _least_common(F.col("n_v_x"), F.col("n_v_y"), percent)
    inside = side(seeking.where("a + f >= need"), "x").join(side(sought.where("a + f >= need"), "y").drop("last"), star).where(once & (within >= most))
    # Of k rare items that must be shared, all but k - 1 of the rarest hold one.
    first = F.slice("rare", F.lit(1), F.greatest(F.lit(0), F.col("r") - F.greatest(F.lit(1), F.col("need") - F.col("a") - F.col("f")) + 1).cast("int"))
    items_x = side(seeking.where("r > 0").withColumn("item", F.explode(F.transform(first, lambda s: s["item"]))), "x")
    items_y = side(sought.where("r > 0").withColumn("item", F.explode(F.transform("rare", lambda s: s["item"]))), "y")
    shared = items_x.join(items_y.drop("last"), [*star, "item"]).where(once & (within + F.least("r_x", "r_y") >= most))
    lesser = F.col("v_x") < F.col("v_y")
    pick = lambda c, name: [F.when(lesser, F.col(f"{c}_x")).otherwise(F.col(f"{c}_y")).alias(f"{name}_u"), F.when(lesser, F.col(f"{c}_y")).otherwise(F.col(f"{c}_x")).alias(f"{name}_v")]
    ends = [F.least("v_x", "v_y").alias("u"), F.greatest("v_x", "v_y").alias("v"), *pick("n_v", "n"), *pick("root", "root")]
    return inside.select(*ends).unionByName(shared.select(*ends)).distinct()


def _sets_of(src: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(v, items) of the wanted nodes (node, v): the texts of one row of each are read again."""
    wanted = materialize(wanted.select("node", "v"), "wanted")
    ids = wanted.select(F.when(F.col("v.id") < NO_ID, F.col("v.id")).alias("wanted")).distinct()
    read = src.join(checked_broadcast(ids, 64), F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi").select("text")
    sets = read.mapInArrow(_sets(width), "node binary, items array<bigint>").join(wanted, "node")
    out = materialize(sets.groupBy("v").agg(F.first("items").alias("items")), "sets")
    discard(wanted)
    return out


def _compared(sets: DataFrame, pairs: DataFrame, extra: bool = False) -> DataFrame:
    """pairs (u, v, ...) with the size of the intersection of their full sets, and with what v has beyond u."""
    both = pairs.join(sets, "v").join(sets.select(F.col("v").alias("u"), F.col("items").alias("items_u")), "u")
    more = [F.array_except("items", "items_u").alias("extra")] if extra else []
    return both.select(*pairs.columns, F.size(F.array_intersect("items", "items_u")).cast("long").alias("common"), *more)


def _digest_of(text: Column) -> Column:
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """docs with exactly one row of each component: one of its least id, or without an id if no member has one. Rows are told
    apart by id and text, so that neither null nor repeated ids take others with them; of rows that repeat both, one stays."""
    sides = _grouped(docs, _digest_of(F.col("text")), width, percent).where("root IS NOT NULL").groupBy("root", "doc_id", "digest").agg(F.count("*").alias("n"))
    sides = materialize(sides, "near-members")
    best = sides.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("digest").alias("digest"))).alias("best"), F.count("*").alias("members"), F.max("n").alias("most"))
    some = sides.join(best.where("members > 1 OR most > 1").select("root", "best"), "root")
    stays = F.col("doc_id").eqNullSafe(F.col("best.id")) & (F.col("digest") == F.col("best.digest"))
    out = some.where(~stays | (F.col("n") > 1)).select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), stays.alias("_stays"))
    out = materialize(out, "near-dropped")
    digest = _digest_of(docs["text"])

    def on(gone: DataFrame) -> Column:
        return docs["doc_id"].eqNullSafe(gone["_id"]) & (digest == gone["_digest"])

    rest = docs.join(checked_broadcast(out, 64), on(out), "left_anti")
    again = out.where("_stays")
    if again.isEmpty():
        return rest
    twice = docs.join(checked_broadcast(again, 64), on(again), "left_semi")
    one = twice.groupBy(F.col("doc_id").alias("_id"), _digest_of(F.col("text")).alias("_digest")).agg(F.first(F.struct(*docs.columns)).alias("_r")).select("_r.*")
    return rest.unionByName(one)
