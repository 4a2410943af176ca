"""Word shingles of whole texts as sorted 64-bit hashes, computed on whole batches."""

from __future__ import annotations

import numpy as np

FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_RNG = np.random.default_rng(20240229)
BYTE_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
PLACES = _RNG.integers(1, 2**63, 8, dtype=np.uint64) | np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit values."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


POWERS = np.cumprod(np.full(1 << 10, BASE, np.uint64))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, text index of each word), A-Z folded; words are runs of non-space bytes.

    A word's hash sums its byte codes times powers of an odd number by place
    (places from 1024 on reuse the powers, times an odd number by the block's
    number); it depends on the word alone, whatever else is in ``texts``.
    """
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = IS_SPACE[raw]
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ends = np.flatnonzero(space & np.concatenate([[False], ~space[:-1]]))
    lengths = ends - starts
    at = np.flatnonzero(~space)
    place = np.arange(len(at)) - np.repeat(np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    code = BYTE_CODE[FOLD[raw[at]]] * POWERS[place & (len(POWERS) - 1)]
    far = np.flatnonzero(place >= len(POWERS))
    if len(far):
        code[far] *= PLACES[0] + np.uint64(2) * (place[far] >> 10).astype(np.uint64)
    sums = np.add.reduceat(code, np.concatenate([[0], np.cumsum(lengths)[:-1]]))
    owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
    return mix(sums + lengths.astype(np.uint64) * BASE), owner


def shingle_sets(texts: list[bytes], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, owner): each text's distinct shingles, by text; fewer words than ``width`` make one shingle."""
    words, owner = word_hashes(texts)
    count = np.bincount(owner, minlength=len(texts))
    parts, owners = [], []
    if len(words) >= width:
        n = len(words) - width + 1
        h = words[:n] * PLACES[0]
        for k in range(1, width):
            h = h + words[k : n + k] * PLACES[k]
        inside = owner[:n] == owner[width - 1 :]
        parts.append(mix(h[inside]))
        owners.append(owner[:n][inside])
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        first = np.concatenate([[0], np.cumsum(count)[:-1]])
        whole = count[short].astype(np.uint64) * BASE
        for k in range(width - 1):
            has = count[short] > k
            whole[has] += words[first[short[has]] + k] * PLACES[k]
        parts.append(mix(whole))
        owners.append(short)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h, o = np.concatenate(parts), np.concatenate(owners)
    order = np.argsort(o, kind="stable")  # two sorted runs
    h, o = h[order], o[order]
    bounds = np.flatnonzero(np.concatenate([[True], o[1:] != o[:-1], [True]]))
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        h[lo:hi].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    return h[new], o[new]
