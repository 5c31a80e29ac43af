"""Fast similarity sketching: ``t`` coordinates from hashed bin placement.

In each of the first ``t`` rounds every element of a set is hashed to a bin and a value, and the bins that are still
empty take the smallest value that falls into them. In the next ``t`` rounds all elements go to the one bin of the round's number, so
every coordinate of a non-empty set is filled. A coordinate of two sets agrees with the probability of their Jaccard similarity, and the
number of agreeing ones is concentrated around it as if they were independent.
"""

import math

import numpy as np

from phenolith.llm.shingles import mix

ROWS = 5  # coordinates that must agree within a band
MISS = 1e-6  # chance that a pair just at the threshold agrees in no band


def bands_for(threshold: float, rows: int = ROWS, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log(1 - threshold**rows))


def sketches(values: np.ndarray, begins: np.ndarray, t: int) -> np.ndarray:
    """The sketches of some sets, given end to end: one row of ``t`` values per set. Rows of empty sets mean nothing."""
    count = len(begins) - 1
    owner = np.repeat(np.arange(count), np.diff(begins))
    filled = np.full(count * t, np.iinfo(np.uint64).max, dtype=np.uint64)
    filled.reshape(count, t)[np.diff(begins) == 0] = 0
    empty = np.ones(count * t, dtype=bool)
    empty.reshape(count, t)[np.diff(begins) == 0] = False
    left = values
    for i in range(2 * t):
        with np.errstate(over="ignore"):
            hashed = mix(left + np.uint64(i + 1) * np.uint64(0x9E3779B97F4A7C15))
        if i < t:
            bins = ((hashed >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64)
        else:
            bins = np.full(len(left), i - t, dtype=np.int64)
        place = owner * t + bins
        open_ = empty[place]
        np.minimum.at(filled, place[open_], mix(hashed[open_]))
        empty[place] = False
        waiting = empty.reshape(count, t).any(axis=1)
        if not waiting.any():
            break
        on = waiting[owner]
        left, owner = left[on], owner[on]
    return filled.reshape(count, t)


def band_keys(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each run of ``rows`` coordinates; the number of the band is part of it."""
    count, t = sketch.shape
    grouped = sketch.reshape(count, t // rows, rows)
    with np.errstate(over="ignore"):
        key = np.arange(1, t // rows + 1, dtype=np.uint64)[None, :] * np.uint64(0xA0761D6478BD642F)
        for k in range(rows):
            key = mix(key + grouped[:, :, k])
    return key
