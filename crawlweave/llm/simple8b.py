"""Simple-8b: unsigned integers in 64-bit words, a 4-bit selector above 60 bits of data.

A selector says how many values of which width the word holds.  Selector 15
is the escape: one value of up to 60 bits.  Values are coded in blocks, so
that a block is decoded on its own, selector by selector, without a loop
over words.
"""

from __future__ import annotations

import numpy as np

#: Fixed values of the format: (values in a word, bits of each), by selector.
SELECTORS = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8),
             (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
ESCAPE = 15
#: Values of a block.
BLOCK = 16_384

_COUNT = np.zeros(16, np.int64)
_COUNT[:len(SELECTORS)] = [c for c, _ in SELECTORS]
_COUNT[ESCAPE] = 1
_BITS = np.zeros(16, np.uint64)
_BITS[:len(SELECTORS)] = [b for _, b in SELECTORS]
_BITS[ESCAPE] = 60
_BY_COUNT = {c: s for s, (c, _) in enumerate(SELECTORS)}
_SELECTOR_OF = np.zeros(61, np.uint64)
for _c, _s in _BY_COUNT.items():
    _SELECTOR_OF[_c] = _s
_SELECTOR_OF[1] = ESCAPE
_BITS_OF = np.zeros(61, np.uint64)
for _c, _b in SELECTORS:
    _BITS_OF[_c] = _b


def _runs(fits: np.ndarray, length: int) -> np.ndarray:
    """Where ``length`` values in a row fit, by doubling."""
    run, have = fits, 1
    while have < length:
        step = min(have, length - have)
        run = run[:len(run) - step] & run[step:] if len(run) > step else run[:0]
        have += step
    return run


def encode_block(values: np.ndarray) -> np.ndarray:
    """Words of one block: each takes as many of the next values as some selector allows."""
    n = len(values)
    take = np.ones(n, np.uint8)
    for count, bits in reversed(SELECTORS[:-1]):  # few values first, many last
        if count > n:
            break
        run = _runs(values < (1 << bits), count)
        if not run.any():
            break  # a longer run of narrower values holds a shorter one of wider
        np.maximum(take[:len(run)], run.view(np.uint8) * np.uint8(count), out=take[:len(run)])
    starts, i, steps = [], 0, take.tolist()
    while i < n:
        starts.append(i)
        i += steps[i]
    starts = np.array(starts, np.int64)
    counts = take[starts]
    shifts = _shifts(counts, starts, _BITS_OF[counts])
    words = np.bitwise_or.reduceat(values.astype(np.uint64) << shifts, starts) if n else np.zeros(0, np.uint64)
    return words | (_SELECTOR_OF[counts] << np.uint64(60))


def _shifts(counts: np.ndarray, starts: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """By how many bits each value is shifted in its word."""
    place = np.arange(int(counts.sum(dtype=np.int64)), dtype=np.uint64) - np.repeat(starts.astype(np.uint64), counts)
    return place * np.repeat(bits, counts)


def decode_blocks(words: np.ndarray) -> np.ndarray:
    """Values of one or more whole blocks' words, in order."""
    selector = (words >> np.uint64(60)).astype(np.uint8)
    counts = _COUNT[selector]
    begin = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s in np.unique(selector).tolist():
        n, bits = (1, 60) if s == ESCAPE else SELECTORS[s]
        rows = np.flatnonzero(selector == s)
        data, at = words[rows], begin[rows]
        mask = np.uint64((1 << bits) - 1)
        for i in range(n):
            out[at + i] = (data >> np.uint64(i * bits)) & mask
    return out
