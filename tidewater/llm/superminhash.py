"""SuperMinHash signatures in numpy."""

from __future__ import annotations

import numpy as np

from tidewater.llm.text import mix64

# Elements looked at together; bounds the memory of a very large set.
_BLOCK = 4096
_LOW = np.uint64(0xFFFFFFFF)


def signature(elements: np.ndarray, slots: int) -> np.ndarray:
    """``slots`` values of a set of distinct 64-bit codes; two sets agree in a slot with the
    probability of their Jaccard similarity.

    Every element draws a random permutation of the slots, one rank after another, and
    offers rank plus a fraction to the slot drawn; each slot keeps its least offer. Offers of
    rank r are at least r, so ranks above the largest value kept need no drawing: large
    sets stop after a few. An empty set has infinite values.
    """
    values = np.full(slots, np.inf)
    for start in range(0, len(elements), _BLOCK):
        own = elements[start : start + _BLOCK]
        rows = np.arange(len(own))
        deck = None
        for rank in range(slots):
            if rank > values.max():
                break
            drawn = mix64(own ^ mix64(np.full(1, rank + 1, np.uint64)))
            offer = rank + (drawn >> np.uint64(32)).astype(np.float64) / 2.0**32
            pick = rank + (((drawn & _LOW) * np.uint64(slots - rank)) >> np.uint64(32)).astype(np.int64)
            if rank == 0:
                slot = pick
            else:
                if deck is None:  # the first draw swapped slot 0 with the one picked
                    deck = np.tile(np.arange(slots, dtype=np.int16), (len(own), 1))
                    deck[rows, first] = 0
                slot = deck[rows, pick]
                deck[rows, pick] = deck[:, rank]
            first = pick if rank == 0 else first
            np.minimum.at(values, slot, offer)
    return values


def slot_keys(values: np.ndarray, rows: int) -> np.ndarray:
    """One signed 64-bit key for every band of ``rows`` slots, different from band to band."""
    bits = values.view(np.uint64).reshape(-1, rows)
    keys = np.arange(len(bits), dtype=np.uint64)
    for i in range(rows):
        keys = mix64(keys ^ bits[:, i])
    return keys.view(np.int64)
