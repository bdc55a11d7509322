"""Language-model scoring: bigrams with Dirichlet smoothing, in Elias-Fano tries that are built where they are asked.

A probability is P(w | v) = (c(v, w) + K * p(w)) / (c(v) + K), with p(w) = (c(w) + A) / (N + A * (V + 1)), all from the training
rows; the text's start is a context and its end a token. The logarithm is a sum of log10(c(v, w) + K * p(w)), which
needs w's counts, and of -log10(c(v) + K), which needs v's. Hence a chunk of documents sends each of its distinct pairs once, with
the number of its training tokens, to the shard of the pair's word. A shard sums what is counted of its words, builds its trie
(first level: words; second: the words before them; quantised smoothed values), finds the pairs in it by successor search
within the word's range, and sends a value back for each pair and a count for each word, in the order of asking. Where each
pair stands in the chunk's documents travels beside, and the sums are made there. No model is collected or broadcast, and shards grow
in number, not in size; what travels does not depend on their number. Words with more than their share of all tokens
are dealt out by the word before, with their known count; a frequent pair is one entry of each chunk.

Words are 64-bit hashes. While they are counted, a second hash is compared; if two words share the first, another salt is taken, so
counts are exact. The words before a word are told apart by 40 bits within it, which touches score alone: of n of them, about
n**2 / 2**41 merge.

Defined results: null text counts as empty and consists of its end alone; a null doc_id's remainder is that of the empty
text; repeated rows each give a row and count each in training; long texts are scored whole; values have no ties to break;
without training rows c, N and V are 0; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagecraft.llm.common import crc_mod, discard, materialize, small_batches
from pagecraft.llm.eliasfano import Trie
from pagecraft.llm.textkernel import LOWER, SPACE, chunks, disjoint_hash, mix, runs

ADD = 0.1
PRIOR = 16.0
SHARD_TOKENS = 1_000_000
#: At most this many words are dealt out by the word before, 16 bytes each. Others have less than one in this many of all tokens.
HEAVY_WORDS = 500_000
#: Distinct pairs are sought in chunks of about this many bytes of text, and at most so many rows.
CHUNK_BYTES, CHUNK_ROWS = 4 << 20, 1 << 16
#: The words before a word, packed.
BEFORE_BITS = 40
END = np.uint64(0x123456789ABCDE1)
START = np.uint64(0x0FEDCBA98765432)
_CODES = 65535
_MAP = pa.schema([("shard", pa.int64()), ("chunk", pa.int64()), ("blob", pa.binary())])
_KINDS = "shard long, chunk long, blob binary"
_OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, base_sum double, score double"


def _table(salt: int) -> np.ndarray:
    """The bytes' random values of a hash."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))[LOWER]


def _words(buf: np.ndarray, ends: np.ndarray, salt: int = 0, check: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """(row, hash, 32 bits of another hash if asked) of each token of each row, its end included, in order."""
    row, start, end = runs(buf, ends, ~SPACE)
    h = disjoint_hash(buf, start, end, _table(salt))
    rows = len(ends)
    which = np.repeat(np.arange(rows), np.bincount(row, minlength=rows) + 1)
    out, place = np.full(len(h) + rows, END, np.uint64), np.arange(len(h)) + row
    out[place] = np.where(h == END, END + np.uint64(1), h)
    if not check:
        return which, out, None
    other = np.zeros(len(out), np.int64)
    other[place] = (disjoint_hash(buf, start, end, _table(~salt & 0xFFFFFFFF)) >> np.uint64(32)).astype(np.int64)
    return which, out, other


def _summed(key: np.ndarray, c: np.ndarray, least: np.ndarray, most: np.ndarray):
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.flatnonzero(np.diff(key, prepend=~key[:1]))
    return key[head], np.add.reduceat(c[order], head), np.minimum.reduceat(least[order], head), np.maximum.reduceat(most[order], head)


def _counting(salt: int):
    schema = pa.schema([("word", pa.int64()), ("c", pa.int64()), ("least", pa.int64()), ("most", pa.int64())])

    def run(batches):
        held, size = [], 0

        def flush():
            key, *rest = _summed(*[np.concatenate(x) for x in zip(*held, strict=True)])
            for i in range(0, len(key), 1 << 16):
                j = i + (1 << 16)
                yield pa.RecordBatch.from_arrays([pa.array(key[i:j].view(np.int64)), *[pa.array(x[i:j]) for x in rest]], schema=schema)

        for batch in batches:
            for _, _, buf, ends in chunks(batch.column(0), CHUNK_BYTES):
                _, word, other = _words(buf, ends, salt, True)
                held.append(_summed(word, np.ones(len(word), np.int64), other, other))
                size += len(held[-1][0])
                if size > 1_000_000:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return run


def _shard_of(word: np.ndarray, before: np.ndarray, heavy: np.ndarray, shards: int) -> np.ndarray:
    out = (mix(word + np.uint64(77)) >> np.uint64(20)) % np.uint64(shards)
    if len(heavy):
        hit = np.isin(word, heavy)
        out[hit] = (mix(word[hit] ^ mix(before[hit])) >> np.uint64(20)) % np.uint64(shards)
    return out.astype(np.int64)


def _gathered(batches):
    """(doc_id, held_out, bytes, end of each row in them) of runs of rows of about CHUNK_BYTES, across batches."""
    parts, size, rows = [], 0, 0

    def joined():
        shift = np.cumsum([0, *[len(p[2]) for p in parts[:-1]]])
        ends = np.concatenate([p[3] + s for p, s in zip(parts, shift, strict=True)])
        return pa.concat_arrays([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts]), ends

    for batch in batches:
        held = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for lo, hi, buf, ends in chunks(batch.column(2), CHUNK_BYTES):
            if parts and (size + len(buf) > CHUNK_BYTES or rows + hi - lo > CHUNK_ROWS):
                yield joined()
                parts, size, rows = [], 0, 0
            parts.append((pa.concat_arrays([batch.column(0).slice(lo, hi - lo)]), held[lo:hi], buf.copy(), ends))
            size, rows = size + len(buf), rows + hi - lo
    if parts:
        yield joined()


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Whether each place differs from the one before in any key."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def _small(n: np.ndarray) -> list[np.ndarray]:
    """Counts as bytes, with those of 255 and more apart."""
    return [np.minimum(n, 255).astype(np.uint8), n[n >= 255].astype(np.int64)]


def _restored(small: np.ndarray, large: np.ndarray) -> np.ndarray:
    n = small.astype(np.int64)
    n[small == 255] = large
    return n


def _bytes(*arrays: np.ndarray) -> bytes:
    """Arrays, each after its type's letter, width and length."""
    return b"".join(x for a in arrays for x in (a.dtype.str[1:].encode(), np.array([len(a)], "<i8").tobytes(), np.ascontiguousarray(a).tobytes()))


def _arrays(blob: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(blob):
        kind, n = np.dtype("<" + blob[at : at + 2].decode()), int(np.frombuffer(blob, "<i8", 1, at + 2)[0])
        out.append(np.frombuffer(blob, kind, n, at + 10))
        at += 10 + n * kind.itemsize
    return out


def _cut(a: np.ndarray) -> np.ndarray:
    return a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : BEFORE_BITS // 8].reshape(-1)


def _wide(a: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a) * 8 // BEFORE_BITS, 8), np.uint8)
    out[:, : BEFORE_BITS // 8] = a.reshape(-1, BEFORE_BITS // 8)
    return out.reshape(-1).view("<u8")


def _packed(word: np.ndarray, before: np.ndarray, trained: np.ndarray) -> bytes:
    """Distinct pairs in the order of (word, before), with their training tokens; each word once with its number of pairs."""
    head = np.flatnonzero(_heads(word))
    return _bytes(word[head], *_small(np.diff(np.append(head, len(word)))), _cut(before), *_small(trained))


def _dealing(heavy: np.ndarray, shards: int, salt: int):
    def run(batches):
        from pyspark import TaskContext

        chunk = (TaskContext.get().partitionId() << 32) - 1
        for ids, held, buf, ends in _gathered(batches):
            chunk += 1
            row, word, _ = _words(buf, ends, salt)
            before = np.empty_like(word)
            before[1:] = word[:-1]
            before[_heads(row)] = START
            shard = _shard_of(word, before, heavy, shards)
            before = mix(before) >> np.uint64(64 - BEFORE_BITS)
            order = np.lexsort((before, word, shard))
            shard, word, before, row = shard[order], word[order], before[order], row[order]
            first = np.flatnonzero(_heads(shard, word, before))
            times = np.diff(np.append(first, len(word)))
            trained = np.add.reduceat((~held[row]).astype(np.int64), first)
            shard, word, before = shard[first], word[first], before[first]
            at = np.append(np.flatnonzero(_heads(shard)), len(shard))
            blobs = [_packed(word[i:j], before[i:j], trained[i:j]) for i, j in zip(at[:-1], at[1:], strict=True)]
            docs = pa.RecordBatch.from_arrays([ids, pa.array(held)], names=["d", "h"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, docs.schema) as w:
                w.write_batch(docs)
            beside = _bytes(np.frombuffer(sink.getvalue(), np.uint8), *_small(times), row.astype(np.uint16), np.array([len(ends)]))
            yield pa.RecordBatch.from_arrays([pa.array([-1 - chunk]), pa.array([chunk]), pa.array([beside], pa.binary())], schema=_MAP)
            yield pa.RecordBatch.from_arrays([pa.array(shard[at[:-1]]), pa.array(np.full(len(blobs), chunk)), pa.array(blobs, pa.binary())], schema=_MAP)

    return run


def _answering(total: int, distinct: int, heavy: np.ndarray, heavy_c: np.ndarray, prior: float):
    """One shard: build the trie of its training pairs, and answer every chunk's pairs and words in their order."""
    order = np.argsort(heavy)
    heavy_key, heavy_n = heavy[order], heavy_c[order]
    base = total + ADD * (distinct + 1)

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        if table.column("shard")[0].as_py() < 0:
            return table
        shard, chunk = table.column("shard"), table.column("chunk")
        asked = [_arrays(b.as_py()) for b in table.column("blob")]
        del table
        each = [_restored(a[1], a[2]) for a in asked]  # pairs of each word of a chunk
        word = np.concatenate([np.repeat(a[0], n) for a, n in zip(asked, each, strict=True)])
        before = np.concatenate([_wide(a[3]) for a in asked])
        c = np.concatenate([_restored(a[4], a[5]) for a in asked])
        n_words, n_pairs = [len(a[0]) for a in asked], [len(a[4]) for a in asked]
        asked_words = np.concatenate([a[0] for a in asked])
        del asked
        by = np.lexsort((before, word))
        word, before, c = word[by], before[by], c[by]
        new_w = _heads(word)
        head = np.flatnonzero(_heads(word, before))
        keys, pair_word, pair_before = word[new_w], word[head], before[head]
        c_pair = np.add.reduceat(c, head)
        pair_of = np.empty(len(by), np.int32)
        pair_of[by] = np.repeat(np.arange(len(head), dtype=np.int32), np.diff(np.append(head, len(by))))
        of = (np.cumsum(new_w) - 1)[head]
        c_word = np.bincount(of, c_pair, len(keys)).astype(np.int64)
        del word, before, c, by, new_w, head
        if len(heavy_key):
            place = np.minimum(np.searchsorted(heavy_key, keys), len(heavy_key) - 1)
            c_word = np.where(heavy_key[place] == keys, heavy_n[place], c_word)
        p_word = (c_word + ADD) / base
        known = c_pair > 0
        trie = Trie(
            keys, np.bincount(of[known], minlength=len(keys)), pair_before[known],
            np.log10(prior * p_word), np.log10(c_pair[known] + prior * p_word[of[known]]), 1 << BEFORE_BITS,
        )
        _, found, single = trie.find(pair_word, pair_before)
        value = np.where(np.isnan(found), single, found)
        trie.close()
        low = value.min()
        step = (value.max() - low) / _CODES or 1.0
        codes = np.round((value - low) / step).astype(np.uint16)[pair_of]
        counts = c_word[np.searchsorted(keys, asked_words)]
        counts = counts.astype(np.uint32) if counts.max(initial=0) < 1 << 32 else counts
        p, w = np.cumsum([0, *n_pairs]), np.cumsum([0, *n_words])
        scale = np.array([low, step])
        out = [_bytes(scale, counts[w[i] : w[i + 1]], *_small(each[i]), codes[p[i] : p[i + 1]], (asked_words[w[i] : w[i + 1]] == END).nonzero()[0]) for i in range(len(n_pairs))]
        return pa.table([shard, chunk, pa.array(out, pa.binary())], schema=_MAP)

    return run


def _summing(total: int, distinct: int, starts: int, prior: float):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_sum", pa.float64()), ("score", pa.float64())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("shard")  # the documents first, then the shards in the order of asking
        beside, *answers = [_arrays(b.as_py()) for b in table.column("blob")]
        docs, times, row, rows = pa.ipc.open_stream(beside[0].tobytes()).read_all(), _restored(beside[1], beside[2]), beside[3], int(beside[4][0])
        c, ended, value, size = [], [], [], []
        for scale, counts, small, large, codes, end in answers:
            last = np.zeros(len(counts), bool)
            last[end] = True
            c.append(counts.astype(float))
            ended.append(last)
            size.append(_restored(small, large))
            value.append(scale[0] + codes * scale[1])
        c, ended, size, value = (np.concatenate(x) for x in (c, ended, size, value))
        context = np.where(ended, 0.0, np.log10(c + prior))
        token = np.repeat(np.repeat(np.arange(len(c)), size), times)
        score = np.bincount(row, np.repeat(value, times) - context[token], rows) - np.log10(starts + prior)
        n = np.bincount(row, minlength=rows)
        known = np.bincount(row, (c > 0)[token], rows).astype(np.int64)
        plain = np.bincount(row, np.log10(c + ADD)[token], rows) - n * np.log10(total + ADD * (distinct + 1))
        return pa.table([docs.column("d"), docs.column("h"), pa.array(n), pa.array(known), pa.array(plain), pa.array(score)], schema=schema)

    return run


def counted(src: DataFrame) -> tuple[DataFrame, int]:
    """((word, c) of the rows' tokens, the salt with which no two words share a hash)."""
    salt = 0
    while True:
        words = src.mapInArrow(_counting(salt), "word long, c long, least long, most long")
        words = materialize(words.groupBy("word").agg(F.sum("c").alias("c"), (F.min("least") < F.max("most")).alias("shared")), "lm-words")
        if words.where("shared").isEmpty():
            return words.drop("shared"), salt
        discard(words)
        salt += 1


def scored(docs: DataFrame, learn: Column, prior: float = PRIOR, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """doc_id, held_out (learn does not hold), n_tokens, n_known, train_tokens, base_score, score for every row."""
    src = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), (~learn).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    words, salt = counted(src.where(~F.col("held_out")).select("text"))
    end = F.col("word") == int(np.array([END]).view(np.int64)[0])
    n, distinct, starts = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(end, F.col("c"))), F.lit(0))).first()
    shards = max(16, -(-n // shard_tokens))
    # No more than 4 * shards, nor HEAVY_WORDS, words can be this frequent.
    top = words.where(F.col("c") >= max(1000, n / (4 * shards), n / HEAVY_WORDS)).collect()
    heavy, heavy_c = np.array([r["word"] for r in top], np.int64).view(np.uint64), np.array([r["c"] for r in top], np.int64)
    dealt = src.mapInArrow(_dealing(heavy, shards, salt), _KINDS)
    sums = dealt.groupBy("shard").applyInArrow(_answering(n, distinct, heavy, heavy_c, prior), _KINDS)
    out = sums.groupBy("chunk").applyInArrow(_summing(n, distinct, starts, prior), _OUT)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), F.col("base_sum").alias("base_score"), "score")


def learn_rule(doc_id: Column) -> Column:
    return crc_mod(doc_id, 10) != 0
