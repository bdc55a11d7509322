"""SentencePiece encoding and decoding over a fixed public vocabulary, by max-plus (Viterbi) segmentation.

A text's segmentation has the largest sum of piece scores. No piece holds a space after another character, so a space that
follows one is a certain cut; strings between cuts are solved once for all their repeats in a run of texts. Characters
outside the vocabulary become byte pieces, so decoding gives the text back exactly, whatever it holds.

A text above GIANT_BYTES is split into chunks. A chunk's transfer matrix T[a, b] is the best score from a bytes into it to
b bytes into the next one; between two certain cuts it is an outer sum of two vectors. Matrices combine associatively
under (max, +): by blocks of chunks, then along the blocks, then within each, which gives the best score of every state at every
boundary. From these each chunk tells at which state it is entered for each state at which it is left; these maps compose
from the end, and every chunk is then traced back on its own.

Scores are whole numbers, so sums are exact, and the one rule for ties (at each place from the end, the longest piece of a
best path) gives the same ids whether or not, and wherever, a text is split.

Defined results: null and empty texts have no pieces; ties prefer the longer last piece; repeated rows each give a row; long texts
are encoded whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagecraft.llm import lattice
from pagecraft.llm.common import discard, materialize, small_batches
from pagecraft.llm.textkernel import BYTE, chunks, prefix_hash, span_hash

GIANT_BYTES = 32 << 10
CHUNK = 16 << 10
#: A byte piece's score lies this far below all scores of pieces in use.
BYTE_PENALTY = 10.0
RUN_BYTES = 512 << 10
#: Chunks whose matrices one task multiplies.
BLOCK_CHUNKS = 64


def scores(voc: lattice.Vocabulary) -> np.ndarray:
    out = voc.score.copy()
    usable = np.ones(voc.size, bool)
    usable[voc.byte_id] = False
    least = out[usable & (out > -1e8)].min()
    out[out < -1e8] = least - 1.0
    out[voc.byte_id] = least - 1.0 - BYTE_PENALTY
    if (out != np.round(out)).any():  # a vocabulary with fractions: to 2**-10, so that sums stay exact
        out = np.round(out * 1024) / 1024
    return out


def solve(voc, score: np.ndarray, buf: np.ndarray, start: np.ndarray, end: np.ndarray, into: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(base, best, back, piece) for strings in by_length() order: at base[i] + j the best score of the first j bytes of
    string i, and its last piece with that piece's length. into: scores with which each string's first places are entered from
    before it; a place that keeps its own has no last piece, as the piece that enters is the longer one."""
    base = np.cumsum(end - start + 1) - (end - start + 1)
    total = int(base[-1] + end[-1] - start[-1] + 1) if len(start) else 0
    best, back, piece = np.full(total, -np.inf), np.zeros(total, np.uint8), np.zeros(total, np.int32)
    if into is None:
        best[base] = 0.0
    else:
        for k in range(into.shape[1]):
            some = end - start >= k
            best[base[some] + k] = into[some, k]
    for j, size, at, ids in lattice.edges(voc, buf, start, end):
        to = base[at] + j
        value = best[to - size] + score[ids]
        up = value > best[to]
        to, ids = to[up], ids[up]
        best[to], back[to], piece[to] = value[up], size, ids
    return base, best, back, piece


def traced(base: np.ndarray, length: np.ndarray, back: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, ids): each string's pieces in order."""
    ends = np.zeros(len(back), bool)
    at, live = base + length, np.arange(len(base))
    live = live[length > 0]
    while len(live):
        ends[at[live]] = True
        at[live] -= back[at[live]]
        live = live[at[live] > base[live]]
    places = np.flatnonzero(ends)
    return np.searchsorted(places, np.append(base, len(back))), piece[places]


def cuts(buf: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Starts of the strings between certain cuts, heads (the texts' own starts) among them."""
    space = buf == 32
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    if len(buf):
        cut[heads[heads < len(buf)]] = True
    return np.flatnonzero(cut)


def encode_strings(voc, score: np.ndarray, buf: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ends, ids): the pieces of each of the texts that start at heads in buf."""
    start = cuts(buf, heads)
    end = np.append(start[1:], len(buf)).astype(np.int64)
    first, place = lattice.unique_spans(buf, start, end, span_hash(prefix_hash(buf, BYTE), start, end))
    base, _, back, piece = solve(voc, score, buf, start[first], end[first])
    offsets, ids = traced(base, end[first] - start[first], back, piece)
    index, stop = lattice.gather(offsets, place)
    upto = np.searchsorted(start, np.append(heads[1:], len(buf)), "left")
    return np.concatenate([[0], stop])[upto], ids[index]


def _with_mark(buf: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space ahead of each that is not empty, and where each starts."""
    size = np.diff(ends, prepend=0)
    some = (size > 0).astype(np.int64)
    shift = np.cumsum(some)
    out = np.full(len(buf) + int(some.sum()), 32, np.uint8)
    out[np.arange(len(buf)) + np.repeat(shift, size)] = buf
    return out, ends - size + shift - some


_IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def _encoding(path: str, check: bool):
    """Batches (doc_id, text) to rows of _IDS, or of _TRIP if check asks for the digest of what the ids decode to."""

    def run(batches):
        voc = lattice.vocabulary(path)
        score = scores(voc)
        for batch in batches:
            for lo, hi, buf, ends in chunks(batch.column(1), RUN_BYTES):
                stop, ids = encode_strings(voc, score, *_with_mark(buf, ends))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stop]).astype(np.int32)), pa.array(ids))
                out = pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), lists], schema=_IDS)
                yield from _digested(voc, out) if check else [out]

    return run


def _splitting(longest: int, size: int):
    schema = pa.schema([("rid", pa.int64()), ("chunk", pa.int32()), ("chunks", pa.int32()), ("core", pa.int32()), ("data", pa.binary())])

    def run(batches):
        for batch in batches:
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = b" " + text.as_py().encode()
                n = max(1, len(data) // size)
                for k in range(n):
                    stop = len(data) if k == n - 1 else (k + 1) * size
                    part = data[k * size : min(stop + longest - 1, len(data))]
                    yield pa.RecordBatch.from_arrays([pa.array([rid]), pa.array([k], pa.int32()), pa.array([n], pa.int32()), pa.array([stop - k * size], pa.int32()), pa.array([part], pa.binary())], schema=schema)

    return run


def transfer(voc, score: np.ndarray, parts: list[tuple[bytes, int]]) -> list[np.ndarray]:
    """The transfer matrix (longest x longest) of each chunk (bytes with what follows, length of its own)."""
    states = voc.longest
    strings: list[tuple[int, int]] = []
    plan, at, body = [], 0, []
    for data, core in parts:
        buf = np.frombuffer(data, np.uint8)
        inner = cuts(buf, np.zeros(0, np.int64))
        inner = inner[(inner >= states - 1) & (inner <= core)]
        tails = range(len(data) - core + 1) if len(data) > core else range(1)
        if len(inner) >= 2:
            a, b = int(inner[0]), int(inner[-1])
            plan.append((len(strings), states, len(tails), len(body)))
            strings += [(at + i, at + a) for i in range(states)] + [(at + b, at + core + t) for t in tails]
            body.append((at + a, at + b))
        else:
            plan.append((len(strings), min(states, len(data)), len(tails), -1))
            strings += [(at + i, at + len(data)) for i in range(min(states, len(data)))]
        at += len(data)
    flat = np.frombuffer(b"".join(d for d, _ in parts), np.uint8)
    start, end = np.array([s for s, _ in strings]), np.array([e for _, e in strings])
    order = lattice.by_length(start, end)
    base, best, _, _ = solve(voc, score, flat, start[order], end[order])
    place = np.empty(len(order), np.int64)
    place[order] = base
    middle = np.zeros(len(body))
    if body:
        begins, stops = np.array([a for a, _ in body]), np.array([b for _, b in body])
        inside = np.concatenate([flat[a:b] for a, b in body])
        heads = np.cumsum(stops - begins) - (stops - begins)
        s = cuts(inside, heads)
        e = np.append(s[1:], len(inside))
        first, which = lattice.unique_spans(inside, s, e, span_hash(prefix_hash(inside, BYTE), s, e))
        b2, v2, _, _ = solve(voc, score, inside, s[first], e[first])
        each = v2[b2 + e[first] - s[first]][which]
        middle = np.bincount(np.searchsorted(heads, s, "right") - 1, each, len(body))
    out = []
    for (data, core), (i, n_in, n_out, k) in zip(parts, plan, strict=True):
        m = np.full((states, states), -np.inf)
        if k >= 0:
            into = best[place[i : i + n_in] + end[i : i + n_in] - start[i : i + n_in]]
            outof = best[place[i + n_in : i + n_in + n_out] + end[i + n_in : i + n_in + n_out] - start[i + n_in : i + n_in + n_out]]
            m[:n_in, :n_out] = into[:, None] + middle[k] + outof[None, :]
        else:
            for a in range(n_in):
                for b in range(n_out):
                    if core + b >= a:
                        m[a, b] = best[place[i + a] + core + b - a]
        out.append(m)
    return out


def combined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product under (max, +)."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def moved(state: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A vector of the states' best scores, after a matrix."""
    return (state[:, None] + m).max(axis=0)


def entries(voc, score: np.ndarray, parts: list[tuple[bytes, int]], into: np.ndarray) -> np.ndarray:
    """chunks x states: where the best path that leaves a chunk at a state enters it, by the one rule for ties. into: the best score
    of each state at each chunk's start. Up to the first certain cut decides, if there is one that every path passes."""
    states = voc.longest
    start, end, cut, at = [], [], [], 0
    for data, core in parts:
        inner = cuts(np.frombuffer(data, np.uint8), np.zeros(0, np.int64))
        inner = inner[(inner >= states - 1) & (inner <= core)]
        start.append(at)
        end.append(at + (int(inner[0]) if len(inner) else len(data)))
        cut.append(len(inner) > 0)
        at += len(data)
    start, end, cut = np.array(start), np.array(end), np.array(cut)
    order = lattice.by_length(start, end)
    base, _, back, _ = solve(voc, score, np.frombuffer(b"".join(d for d, _ in parts), np.uint8), start[order], end[order], into[order])
    place = np.empty(len(order), np.int64)
    place[order] = base
    core = np.array([c for _, c in parts])
    leave = np.where(cut[:, None], (end - start)[:, None], np.minimum(core[:, None] + np.arange(states), (end - start)[:, None]))
    spot = (place[:, None] + leave).reshape(-1)
    live = np.flatnonzero(back[spot] > 0)
    while len(live):
        spot[live] -= back[spot[live]]
        live = live[back[spot[live]] > 0]
    return spot.reshape(len(parts), states) - place[:, None]


def _measuring(path: str):
    schema = pa.schema([("rid", pa.int64()), ("chunk", pa.int32()), ("matrix", pa.binary())])

    def run(batches):
        voc = lattice.vocabulary(path)
        score = scores(voc)
        for batch in batches:
            for lo in range(0, batch.num_rows, 16):
                part = batch.slice(lo, 16)
                mats = transfer(voc, score, list(zip(part.column("data").to_pylist(), part.column("core").to_pylist(), strict=True)))
                yield pa.RecordBatch.from_arrays([part.column("rid"), part.column("chunk"), pa.array([m.tobytes() for m in mats], pa.binary())], schema=schema)

    return run


def _multiplying(states: int):
    """A block's product, from its chunks' matrices."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        product = None
        for b in table.column("matrix").to_pylist():
            m = np.frombuffer(b, np.float64).reshape(states, states)
            product = m if product is None else combined(product, m)
        return pa.table([table.column("rid")[:1], table.column("block")[:1], pa.array([product.tobytes()], pa.binary())], names=["rid", "block", "matrix"])

    return run


def _starting(states: int):
    """The states' best scores at the start of each block of a text, from the blocks' products."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        at, out = np.full(states, -np.inf), []
        at[0] = 0.0
        for b in table.column("matrix").to_pylist():
            out.append(at.tobytes())
            at = moved(at, np.frombuffer(b, np.float64).reshape(states, states))
        return pa.table([table.column("rid"), table.column("block"), pa.array(np.full(len(out), -1), pa.int32()), pa.array(out, pa.binary())], names=["rid", "block", "chunk", "matrix"])

    return run


def _reaching(states: int):
    """The states' best scores at the start of each chunk of a block, from those at the block's start (chunk -1)."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        at, *mats = [np.frombuffer(b, np.float64) for b in table.column("matrix").to_pylist()]
        out = []
        for m in mats:
            out.append(at.tobytes())
            at = moved(at, m.reshape(states, states))
        return pa.table([table.column("rid")[1:], table.column("chunk")[1:], pa.array(out, pa.binary())], names=["rid", "chunk", "into"])

    return run


def _entering(path: str):
    schema = pa.schema([("rid", pa.int64()), ("chunk", pa.int32()), ("entry", pa.binary())])

    def run(batches):
        voc = lattice.vocabulary(path)
        score = scores(voc)
        for batch in batches:
            for lo in range(0, batch.num_rows, 32):
                part = batch.slice(lo, 32)
                into = np.stack([np.frombuffer(b, np.float64) for b in part.column("into").to_pylist()])
                found = entries(voc, score, list(zip(part.column("data").to_pylist(), part.column("core").to_pylist(), strict=True)), into)
                yield pa.RecordBatch.from_arrays([part.column("rid"), part.column("chunk"), pa.array([e.astype(np.uint8).tobytes() for e in found], pa.binary())], schema=schema)

    return run


def _choosing(table: pa.Table) -> pa.Table:
    """The states at both ends of each chunk of a text, from the chunks' maps (a byte for each state), from the end."""
    table = table.sort_by("chunk")
    state, leave, enter = 0, [], []
    for b in reversed(table.column("entry").to_pylist()):
        leave.append(state)
        state = b[state]
        enter.append(state)
    return pa.table([table.column("rid"), table.column("chunk"), pa.array(enter[::-1], pa.int32()), pa.array(leave[::-1], pa.int32())], names=["rid", "chunk", "enter", "leave"])


def _tracing(path: str):
    schema = pa.schema([("rid", pa.int64()), ("chunk", pa.int32()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        voc = lattice.vocabulary(path)
        score = scores(voc)
        for batch in batches:
            for lo in range(0, batch.num_rows, 32):
                part = batch.slice(lo, 32)
                data = [d[a : c + b] for d, c, a, b in zip(*[part.column(x).to_pylist() for x in ("data", "core", "enter", "leave")], strict=True)]
                size = np.array([len(d) for d in data])
                stop, ids = encode_strings(voc, score, np.frombuffer(b"".join(data), np.uint8), np.cumsum(size) - size)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stop]).astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([part.column("rid"), part.column("chunk"), lists], schema=schema)

    return run


def encoded(docs: DataFrame, path: str | None = None, giant: int = GIANT_BYTES, chunk: int = CHUNK) -> DataFrame:
    """doc_id and ids (array of int) for every row of docs."""
    return _encoded(docs, lattice.model_path(path), giant, chunk, False)


def _encoded(docs: DataFrame, path: str, giant: int, chunk: int, check: bool) -> DataFrame:
    kind = "doc_id long, n_pieces long, ids array<int>, decoded_sha256 string" if check else "doc_id long, ids array<int>"
    longest = lattice.vocabulary(path).longest
    src = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    big = F.octet_length("text") > giant
    usual = src.where(~big).mapInArrow(_encoding(path, check), kind)
    huge = materialize(src.where(big).withColumn("rid", F.monotonically_increasing_id()), "giant")
    if huge.isEmpty():
        return usual
    parts = huge.select("rid", "text").repartition("rid").mapInArrow(_splitting(longest, chunk), "rid long, chunk int, chunks int, core int, data binary")
    parts = materialize(parts.repartition("rid", "chunk"), "giant-chunks")
    mats = parts.mapInArrow(_measuring(path), "rid long, chunk int, matrix binary")
    mats = materialize(mats.select("rid", F.floor(F.col("chunk") / BLOCK_CHUNKS).cast("int").alias("block"), "chunk", "matrix"), "giant-matrices")
    starts = mats.groupBy("rid", "block").applyInArrow(_multiplying(longest), "rid long, block int, matrix binary")
    starts = starts.groupBy("rid").applyInArrow(_starting(longest), "rid long, block int, chunk int, matrix binary")
    reached = mats.unionByName(starts).groupBy("rid", "block").applyInArrow(_reaching(longest), "rid long, chunk int, into binary")
    entry = parts.join(reached, ["rid", "chunk"]).select("rid", "chunk", "core", "data", "into").mapInArrow(_entering(path), "rid long, chunk int, entry binary")
    states = materialize(entry.groupBy("rid").applyInArrow(_choosing, "rid long, chunk int, enter int, leave int"), "giant-states")
    discard(mats)
    traced_ = parts.join(states, ["rid", "chunk"]).mapInArrow(_tracing(path), "rid long, chunk int, ids array<int>")
    whole = traced_.groupBy("rid").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "ids"))), lambda x: x["ids"])).alias("ids"))
    whole = huge.select("rid", "doc_id").join(whole, "rid").select("doc_id", "ids")
    return usual.unionByName(whole.mapInArrow(_checking(path), kind) if check else whole)


def decode_lists(voc, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The bytes of each list of ids, without the space that encoding puts ahead."""
    size = np.array([len(b) for b in voc.bytes], np.int64)
    offsets = np.concatenate([[0], np.cumsum(size)])
    index, stop = lattice.gather(offsets, ids)
    data = np.frombuffer(b"".join(voc.bytes), np.uint8)[index].tobytes()
    at = np.concatenate([[0], stop])[np.concatenate([[0], ends])]
    return [data[a + 1 : b] for a, b in zip(at[:-1], at[1:], strict=True)]


def _lists(col: pa.Array):
    """(first row, end row, ids, ends) of runs of rows with a bounded number of ids."""
    off = np.asarray(col.offsets).astype(np.int64)
    values = np.asarray(col.values)
    lo, n = 0, len(col)
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(off, off[lo] + (1 << 19), "right")) - 1))
        yield lo, hi, values[off[lo] : off[hi]].astype(np.int64), off[lo + 1 : hi + 1] - off[lo]
        lo = hi


def _decoding(path: str):
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        voc = lattice.vocabulary(path)
        for batch in batches:
            for lo, hi, ids, ends in _lists(batch.column(1)):
                texts = [b.decode(errors="replace") for b in decode_lists(voc, ids, ends)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(texts, pa.string())], schema=schema)

    return run


def decoded(ids: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of rows (doc_id, ids)."""
    src = ids.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return src.mapInArrow(_decoding(lattice.model_path(path)), "doc_id long, text string")


_TRIP = pa.schema([("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded_sha256", pa.string())])


def _digested(voc, batch: pa.RecordBatch):
    """Rows of _IDS with their number of pieces and the digest of what they decode to."""
    for lo, hi, ids, ends in _lists(batch.column(1)):
        sha = [hashlib.sha256(b).hexdigest() for b in decode_lists(voc, ids, ends)]
        part = batch.slice(lo, hi - lo)
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(ends, prepend=0)), part.column(1), pa.array(sha, pa.string())], schema=_TRIP)


def _checking(path: str):
    def run(batches):
        voc = lattice.vocabulary(path)
        for batch in batches:
            yield from _digested(voc, batch)

    return run


def round_trip(docs: DataFrame, path: str | None = None, giant: int = GIANT_BYTES, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_pieces, ids, and the SHA-256 of the text that the ids decode to, for every row of docs. Usual texts are decoded in the
    worker that encodes them."""
    return _encoded(docs, lattice.model_path(path), giant, chunk, True)
