"""Hashed words and word shingles of whole texts, a block of documents at a time in numpy."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 18  # texts are taken together up to this size; a longer text is a block by itself

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PLACES = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits whose every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: np.uint64, name: str, n: int) -> np.ndarray:
    held = _powers.get(name)
    if held is None or len(held) < n:
        size = max(n, BLOCK_BYTES + 2)
        factors = np.full(size, base, dtype=np.uint64)
        factors[0] = 1
        held = np.multiply.accumulate(factors)
        if size <= 4 * BLOCK_BYTES:  # a table for one very long text isn't kept
            _powers[name] = held
    return held


def hash_spans(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span: differences of one running polynomial, shifted back to place 0 and mixed."""
    with np.errstate(over="ignore"):
        terms = mix(data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, "up", len(data) + 1)[: len(data)]
        running = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(terms, out=running[1:])
        value = (running[stops] - running[starts]) * _power(_BASE_INVERSE, "down", len(data) + 1)[starts]
        return mix(value + (stops - starts).astype(np.uint64) * _PLACES[0])


def text_blocks(column: pa.Array) -> Iterator[tuple[int, int, list]]:
    """Consecutive ranges of a string column of about ``BLOCK_BYTES``, each with its texts as UTF-8 bytes (None for null)."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    begin, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        size += n + 1
        if size >= BLOCK_BYTES or i + 1 == len(sizes):
            yield begin, i + 1, column[begin : i + 1].cast(pa.binary() if column.type == pa.string() else pa.large_binary()).to_pylist()
            begin, size = i + 1, 0


def word_hashes(texts: list, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of some texts (bytes or None) and the number of the text each is in."""
    data = np.frombuffer(b"\n".join(t or b"" for t in texts), dtype=np.uint8)
    if lower:
        data = np.where((data >= 65) & (data <= 90), data | 32, data)
    inside = np.empty(len(data) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.diff(inside)
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    begins = np.cumsum([0] + [len(t or b"") + 1 for t in texts])
    return hash_spans(data, starts, stops), np.searchsorted(begins, starts, side="right") - 1


def shingle_sets(texts: list, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and where each text's begin (one more than texts).

    A shingle is ``width`` words in a row; a text with fewer words has one, all of them; one without words has none.
    """
    words, owner = word_hashes(texts)
    n = np.bincount(owner, minlength=len(texts))
    with np.errstate(over="ignore"):
        hashed = np.zeros(max(len(words) - width + 1, 0), dtype=np.uint64)
        for k in range(width):
            hashed += mix(words[k : len(words) - width + 1 + k] ^ _PLACES[k]) * _PLACES[k]
        whole = owner[: len(hashed)] == owner[width - 1 :] if len(hashed) else np.zeros(0, dtype=bool)
        few = np.flatnonzero((n > 0) & (n < width))
        first = np.concatenate([[0], np.cumsum(n)])
        rest = np.zeros(len(few), dtype=np.uint64)
        for k in range(width - 1):
            there = n[few] > k
            rest[there] += mix(words[first[few[there]] + k] ^ _PLACES[k]) * _PLACES[k]
        rest += n[few].astype(np.uint64)
    owners = np.concatenate([owner[: len(hashed)][whole], few])
    values = mix(np.concatenate([hashed[whole], rest]))
    order = np.lexsort((values, owners))
    owners, values = owners[order], values[order]
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = (owners[1:] != owners[:-1]) | (values[1:] != values[:-1])
    return values[fresh], np.concatenate([[0], np.cumsum(np.bincount(owners[fresh], minlength=len(texts)))])
