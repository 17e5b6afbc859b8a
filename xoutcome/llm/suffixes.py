"""Suffix order by two-stage sorting, and the adjacent common prefixes."""

from __future__ import annotations

import numpy as np


def _words(data: bytes, n: int) -> np.ndarray:
    """Eight bytes from every position as one big-endian number; ``data`` must be eight bytes longer than ``n``."""
    return np.ndarray((n,), ">u8", data, strides=(1,))


def smaller_than_next(codes: np.ndarray) -> np.ndarray:
    """For each suffix whether it is smaller than the one that begins a place later; the last is not."""
    n = len(codes)
    step = np.append(np.sign(np.diff(codes.astype(np.int16))), -1)
    at = np.where(step != 0, np.arange(n), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    return step[at] > 0


def _directly(data: bytes, positions: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by their next ``depth`` bytes: two number sorts, then string sorts inside what is still tied."""
    words = _words(data, len(data) - 8)
    first = words[positions].astype(np.uint64)
    second = words[positions + 8].astype(np.uint64)
    order = np.lexsort((second, first))
    positions, first, second = positions[order], first[order], second[order]
    cut = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1]), [True]]))
    sizes = np.diff(cut)
    for a, size in zip(cut[:-1][sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        positions[a:a + size] = sorted(positions[a:a + size].tolist(), key=lambda p: data[p + 16:p + depth])
    return positions


def suffix_order(text: bytes, depth: int) -> np.ndarray:
    """The start of every suffix in the order of the suffixes, of which ``depth`` bytes at least are compared.

    Only suffixes smaller than their successors are sorted directly. The others follow from a scan of the buckets
    from low to high: whenever suffix ``j`` is met, a greater ``j - 1`` takes the next free place of its byte's bucket.
    The scan goes bucket by bucket; a bucket that feeds itself (equal bytes in a row) takes several rounds.
    """
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    data = text + bytes(depth + 16)
    codes = np.frombuffer(text, np.uint8)
    small = smaller_than_next(codes)
    direct = _directly(data, np.flatnonzero(small), depth)
    bounds = np.searchsorted(codes[direct], np.arange(257))
    placed: list[list[np.ndarray]] = [[] for _ in range(256)]
    placed[codes[-1]].append(np.array([n - 1]))  # what the empty suffix, the least of all, induces
    out = []

    def induce(scanned: np.ndarray) -> np.ndarray:
        """Hand out the predecessors of scanned suffixes; returns those of the bucket that is being scanned."""
        before = scanned[scanned > 0] - 1
        before = before[~small[before]]
        byte = codes[before]
        order = np.argsort(byte, kind="stable")
        before, byte = before[order], byte[order]
        own = before[:0]
        cut = np.flatnonzero(np.concatenate([[True], byte[1:] != byte[:-1], [True]])) if len(byte) else np.zeros(1, np.int64)
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            if byte[a] == c:
                own = before[a:b]
            else:
                placed[byte[a]].append(before[a:b])
        return own

    for c in range(256):
        now = np.concatenate(placed[c]) if placed[c] else np.empty(0, np.int64)
        while len(now):
            out.append(now)
            now = induce(now)
        sorted_ones = direct[bounds[c]:bounds[c + 1]]
        if len(sorted_ones):
            out.append(sorted_ones)
            induce(sorted_ones)
    return np.concatenate(out)


def adjacent_equal(text: bytes, order: np.ndarray, length: int) -> np.ndarray:
    """For neighbours in suffix order whether their common prefix has ``length`` bytes or more (8 at least)."""
    words = _words(text + bytes(length + 16), len(text) + length)
    left, right = order[:-1], order[1:]
    alive = np.arange(len(left))
    for at in sorted({*range(0, length - 7, 8), length - 8}):
        alive = alive[words[left[alive] + at] == words[right[alive] + at]]
        if not len(alive):
            break
    same = np.zeros(len(left), bool)
    same[alive] = True
    same[np.maximum(left, right) + length > len(text)] = False
    return same


def repeated(parts: list[bytes], length: int) -> list[np.ndarray]:
    """For each part (without byte 0xFF) the starts of its ``length``-byte strings that also start elsewhere in the parts."""
    sizes = np.array([len(p) for p in parts], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    text = b"\xff".join(parts)
    order = suffix_order(text, length)
    whole = np.zeros(len(text) + 1, np.int64)  # starts whose string ends inside the part
    fits = sizes >= length
    np.add.at(whole, begin[fits], 1)
    np.add.at(whole, begin[fits] + sizes[fits] - length + 1, -1)
    order = order[np.cumsum(whole)[:-1][order] > 0]
    if len(order) < 2:
        return [np.empty(0, np.int64) for _ in parts]
    same = adjacent_equal(text, order, length)
    hit = np.zeros(len(text) + 1, bool)
    hit[order[:-1][same]] = hit[order[1:][same]] = True
    return [np.flatnonzero(hit[b:b + n]) for b, n in zip(begin, sizes)]
