"""Stable 64-bit hashes of words and word windows, vectorised over many texts.

Words are runs of characters other than ASCII white space. The hashes are the
same in every process and on every machine.
"""

from __future__ import annotations

import numpy as np

BLOCK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_blank = np.zeros(256, bool)
_blank[[9, 10, 11, 12, 13, 32]] = True
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(0xD6E8FEB86659FD93) + b)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n."""
    if not _powers or len(_powers[0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        made = []
        for base in (_BASE, inverse):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            made.append(np.multiply.accumulate(steps))
        _powers[:] = made
    return _powers[0][:n], _powers[1][:n]


def _hash_block(block: bytes) -> np.ndarray:
    data = np.frombuffer(block, np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64)
    word = ~_blank[data]
    edges = np.diff(np.r_[False, word, False].view(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    power, inverse = _power_tables(len(data))
    sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power)]
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(h + (ends - starts).astype(np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """Hash of every word of one text, in order; works block by block on a long text."""
    if len(text) <= BLOCK_BYTES:
        return _hash_block(text)
    out, at = [], 0
    while at < len(text):
        end = at + BLOCK_BYTES
        if end < len(text):  # cut at a blank: the last one in the block, or the first one after it
            near = np.flatnonzero(_blank[np.frombuffer(text, np.uint8, end - at, at)])
            while not len(near) and end < len(text):
                more = np.flatnonzero(_blank[np.frombuffer(text, np.uint8, min(BLOCK_BYTES, len(text) - end), end)])
                if len(more):
                    near = more[:1] + (end - at)
                end += BLOCK_BYTES
            end = at + int(near[-1]) + 1 if len(near) else len(text)
        out.append(_hash_block(text[at:end]))
        at = end
    return np.concatenate(out)


def batch_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts end to end, and the number of words of each."""
    raw = [t.encode() for t in texts]
    if sum(map(len, raw)) <= 4 * BLOCK_BYTES and texts:
        joined = b"\n".join(raw) + b"\n"
        h = word_hashes(joined) if len(joined) <= BLOCK_BYTES else None
        if h is not None:
            data = np.frombuffer(joined, np.uint8)
            word = ~_blank[data]
            starts = np.flatnonzero(word & ~np.r_[False, word[:-1]])
            ends = np.cumsum(np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw)))
            upto = np.searchsorted(starts, ends)
            return h, np.diff(np.r_[0, upto])
    parts = [word_hashes(r) for r in raw]
    counts = np.fromiter(map(len, parts), np.int64, len(parts))
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), counts


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive word hashes, by doubling."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, offset, span, width = None, 0, h, 1
    while True:
        if size & width:
            part = span[offset:offset + n]
            out = part.copy() if out is None else combine(out, part)
            offset += width
        if width * 2 > size:
            return out
        span = combine(span[:-width], span[width:])
        width *= 2
