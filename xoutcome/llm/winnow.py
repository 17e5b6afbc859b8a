"""Anchors of byte strings: which equal strings of ``LENGTH`` bytes are sure to share.

Every window of ``LENGTH`` bytes has one anchor, the place of its leftmost ``GRAM``-byte string of least hash. Equal
windows have equal strings at their anchors, at the same distance. Neighbouring windows with one anchor form a run,
so that a text of n bytes has about n / 150 runs. Both numbers are parameters; a shorter ``length`` makes more runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from xoutcome.llm.common import ragged
from xoutcome.llm.shingles import mixed

LENGTH = 400
GRAM = 100
PIECE = 1 << 18  # window starts that are handled at a time; each takes some 80 bytes meanwhile
_BASE = 0x2545F4914F6CDD1D
_ROOM = np.uint64((1 << 24) - 1)  # low bits that hold a position


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit polynomial hash of the ``gram`` bytes from every position, by doubling the width."""
    hashes, width = data.astype(np.uint64) + np.uint64(1), 1
    total = done = None
    rest = gram
    while rest:
        if rest & 1:
            if total is None:
                total, done = hashes, width
            else:
                n = len(data) - done - width + 1
                total = total[:n] * np.uint64(pow(_BASE, width, 1 << 64)) + hashes[done:done + n]
                done += width
        rest >>= 1
        if rest:
            hashes = hashes[:-width] * np.uint64(pow(_BASE, width, 1 << 64)) + hashes[width:]
            width *= 2
    return mixed(total)


def sliding_argmin(hashes: np.ndarray, window: int) -> np.ndarray:
    """The position of the leftmost least hash of every window, from block-wise running minima in both directions."""
    n = len(hashes)
    rows = -(-n // window)
    keys = np.full(rows * window, np.uint64(0xFFFFFFFFFFFFFFFF))
    keys[:n] = (hashes & ~_ROOM) | np.arange(n, dtype=np.uint64)
    grid = keys.reshape(rows, window)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    last = n - window + 1
    return (np.minimum(back[:last], ahead[window - 1:window - 1 + last]) & _ROOM).astype(np.int64)


def pieces(texts: list[bytes], length: int = LENGTH) -> Iterator[tuple[np.ndarray, bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts side by side in buffers: (text number, buffer, where its part begins, that part's offset in the text, window starts)."""
    held, size = [], 0

    def joined():
        lengths = np.array([len(d) for _, _, d in held], np.int64)
        return (np.array([k for k, _, _ in held]), b"".join(d for _, _, d in held), np.cumsum(lengths) - lengths,
                np.array([o for _, o, _ in held]), lengths - length + 1)

    for k, text in enumerate(texts):
        for at in range(0, len(text) - length + 1, PIECE):
            part = text[at:at + PIECE + length - 1]
            if held and size + len(part) > PIECE:
                yield joined()
                held, size = [], 0
            held.append((k, at, part))
            size += len(part)
    if held:
        yield joined()


def runs(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple]:
    """(buffer, text number, shift, first window, last window, anchor, anchor's hash) of all runs.

    Windows and anchors count in the buffer; adding the shift makes them count in the text.
    """
    for number, data, begin, offset, starts in pieces(texts, length):
        hashes = gram_hashes(np.frombuffer(data, np.uint8), gram)
        at = sliding_argmin(hashes, length - gram + 1)
        windows = ragged(begin, starts)
        part = np.repeat(np.arange(len(starts)), starts)
        anchor = at[windows]
        new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])]))
        last = np.concatenate([new[1:], [len(windows)]]) - 1
        own = part[new]
        yield data, number[own], offset[own] - begin[own], windows[new], windows[last], anchor[new], hashes[anchor[new]].view(np.int64)
