"""Vectorised work on Arrow text columns: chunks of bytes, words and their 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are worked on in runs of about this many bytes; one longer text makes a run of its own.
CHUNK_BYTES = 256 << 10
#: Spans are hashed in stretches of about this many bytes, so that the tables of powers stay small.
SEGMENT = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE**i and its inverse mod 2**64 for i < n; tables above SEGMENT are not kept."""
    if len(_powers["up"]) < n:
        size = max(n, min(1 << (n - 1).bit_length(), SEGMENT + 1))
        made = {}
        for name, by in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, by, np.uint64)
            steps[0] = 1
            made[name] = np.cumprod(steps, dtype=np.uint64)
        if size > SEGMENT + 1:
            return made["up"][:n], made["down"][:n]
        _powers.update(made)
    return _powers["up"][:n], _powers["down"][:n]


def chunks(text: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, end of each row in them); null texts are empty."""
    if pa.types.is_large_string(text.type):
        text = text.cast(pa.string())
    if text.null_count:
        text = text.fill_null("")
    n = len(text)
    if not n:
        return
    _, off, data = text.buffers()
    off = np.frombuffer(off, np.int32)[text.offset : text.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[off[lo] : off[hi]], off[lo + 1 : hi + 1] - off[lo]
        lo = hi


def prefix_hash(buf: np.ndarray, table: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = the sum of table[b] * base**position over buf[i:j]."""
    up, _ = powers(len(buf) + 1)
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(table[buf] * up[:-1], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def one_hash(buf: np.ndarray, table: np.ndarray) -> np.uint64:
    """span_hash of all of buf, by segments."""
    total, up = 0, powers(min(len(buf), SEGMENT))[0]
    for at in range(0, len(buf), SEGMENT):
        part = table[buf[at : at + SEGMENT]]
        total += int((part * up[: len(part)]).sum(dtype=np.uint64)) * pow(int(_BASE), at, 1 << 64)
    return mix(np.array([(total + len(buf)) % (1 << 64)], np.uint64))[0]


def disjoint_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray) -> np.ndarray:
    """span_hash of ascending spans that do not overlap, a segment of buf at a time."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + SEGMENT, "right")))
        a, b = start[i], end[j - 1]
        out[i:j] = one_hash(buf[a:b], table) if b - a > SEGMENT else span_hash(prefix_hash(buf[a:b], table), start[i:j] - a, end[i:j] - a)
        i = j
    return out


def tokens(buf: np.ndarray, ends: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end, hash) of the words `[^\\x20\\x09-\\x0D]+` of each row."""
    row, start, end = runs(buf, ends, ~SPACE)
    return row, start, end, disjoint_hash(buf, start, end, BYTE[LOWER] if lower else BYTE)


def runs(buf: np.ndarray, ends: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the maximal runs of bytes b with inside[b] in each row."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, z
    word = inside[buf]
    begin, stop = word.copy(), word.copy()
    begin[1:] &= ~word[:-1]
    stop[:-1] &= ~word[1:]
    heads = np.concatenate([[0], ends[:-1]])
    heads, tails = heads[heads < len(buf)], ends[ends > 0] - 1
    begin[heads] = word[heads]
    stop[tails] = word[tails]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return np.searchsorted(ends, start, "right"), start, end
