"""Segmentation lattices of many short byte strings at once, over a fixed public vocabulary of pieces.

A piece's leading mark stands for a space byte. Every byte also has a piece of its own, so any string has a segmentation.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from pagecraft.llm.textkernel import BYTE, LOWER, mix, prefix_hash, span_hash

MODEL = "piece_bpe_32k.model"
MARK = "▁"


def model_path(path: str | None = None) -> str:
    """The vocabulary file: a path, or the installed public one."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(MODEL)


class Vocabulary:
    """Pieces as bytes with scores; of pieces that fall together when lower-cased, the first counts."""

    def __init__(self, path: str, lower: bool = False, longest: int = 32):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.bytes: list[bytes] = []
        self.score = np.zeros(n)
        self.byte_id = np.zeros(256, np.int64)
        keys: dict[bytes, int] = {}
        for i in range(n):
            piece, self.score[i] = sp.id_to_piece(i), sp.get_score(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                self.bytes.append(bytes([value]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.bytes.append(b"")
            else:
                raw = piece.replace(MARK, " ").encode()
                self.bytes.append(raw)
                raw = raw.lower() if lower else raw
                if len(raw) <= longest:
                    keys.setdefault(raw, i)
        self.size, self.longest = n, max(map(len, keys))
        self.byte_table = BYTE[LOWER] if lower else BYTE
        flat = np.frombuffer(b"".join(keys), np.uint8)
        lens = np.array([len(k) for k in keys])
        ends = np.cumsum(lens)
        h = span_hash(prefix_hash(flat, self.byte_table), ends - lens, ends)
        bits = 17
        while True:
            self.shift, mask = np.uint64(64 - bits), (1 << bits) - 1
            self.slot_key, self.slot_id = np.zeros(mask + 1, np.uint64), np.full(mask + 1, -1, np.int64)
            self.probes, left, ids, step = 0, h, np.array(list(keys.values())), 0
            while len(left) and step < 8:
                at = ((left >> self.shift).astype(np.int64) + step) & mask
                free = self.slot_id[at] < 0
                first = np.zeros(len(left), bool)
                first[np.unique(at, return_index=True)[1]] = True
                put = free & first
                self.slot_key[at[put]], self.slot_id[at[put]] = left[put], ids[put]
                left, ids, step = left[~put], ids[~put], step + 1
            if not len(left):
                self.probes, self.mask = step, mask
                break
            bits += 1

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """The piece with each hash, or -1."""
        base = (h >> self.shift).astype(np.int64)
        out = np.full(len(h), -1, np.int64)
        for step in range(self.probes):
            at = (base + step) & self.mask
            hit = self.slot_key[at] == h
            out[hit] = self.slot_id[at[hit]]
        return out


@lru_cache(maxsize=4)
def vocabulary(path: str, lower: bool = False, longest: int = 32) -> Vocabulary:
    return Vocabulary(path, lower, longest)


def by_length(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """An order of the strings, longest first, as edges() asks for."""
    return np.argsort(start - end, kind="stable")


def edges(voc: Vocabulary, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(length so far, piece length, positions in start's order where such a piece ends, piece ids); lengths ascend, piece
    lengths descend. start and end are in by_length() order."""
    if not len(start):
        return
    length = end - start
    prefix = prefix_hash(buf, voc.byte_table)
    live = len(start)
    for j in range(1, int(length[0]) + 1):
        while live and length[live - 1] < j:
            live = int(np.searchsorted(-length[:live], -j, "right"))
        stop = start[:live] + j
        for size in range(min(j, voc.longest), 1, -1):
            ids = voc.lookup(span_hash(prefix, stop - size, stop))
            at = np.flatnonzero(ids >= 0)
            if len(at):
                yield j, size, at, ids[at]
        ids = voc.lookup(span_hash(prefix, stop - 1, stop))
        yield j, 1, np.arange(live), np.where(ids >= 0, ids, voc.byte_id[buf[stop - 1]])


def unique_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of a first span of each hash, longest spans first, and each span's place among those."""
    _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    order = by_length(start[first], end[first])
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return first[order], place[inverse]


def gather(offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the concatenated runs offsets[i]:offsets[i+1] for i in which, and the ends of the runs there."""
    n = np.diff(offsets)[which]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) - np.repeat(ends - n, n) + np.repeat(offsets[which], n), ends


__all__ = ["Vocabulary", "by_length", "edges", "gather", "mix", "model_path", "unique_spans", "vocabulary"]
