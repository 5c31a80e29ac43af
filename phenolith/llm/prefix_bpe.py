"""Byte-level BPE by dynamic programming over prefixes.

Every byte prefix of a piece has exactly one encoding, so exactly one last token. A token that ends at a place is the
last one of that prefix if it may follow the last token of the prefix before it: if the merges leave the two as they are. The table
of last tokens is all that is kept: the encoding of any prefix is read backwards from it, an append adds rows at its end, and an
edit recomputes rows until a stretch as long as the longest token agrees with the old table.
"""

import base64
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenolith.llm.shingles import text_blocks

MEMO = 300_000  # pieces and token pairs remembered in a worker; what is forgotten is computed again


class Vocabulary:
    """Tokens with their ranks, and which of them may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {r: t for t, r in ranks.items()}
        self.longest = max(map(len, ranks))
        self._pairs: dict[int, bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._pieces: dict[str, bytes] = {}  # the ids as 32-bit numbers end to end

    @classmethod
    def parse(cls, lines: bytes) -> "Vocabulary":
        """From the text of a rank file: base64 of a token, a space, its rank."""
        return cls({base64.b64decode(t): int(r) for t, r in (line.split() for line in lines.splitlines() if line)})

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge gives ``token``, the last one when its bytes are encoded; None for a single byte."""
        known = self._halves.get(token, 0)
        if known == 0:
            data, none = self.token[token], 1 << 60
            parts = [data[i : i + 1] for i in range(len(data))]
            while len(parts) > 2:
                costs = [self.ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
                at = costs.index(min(costs))
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            known = self._halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return known

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the merges of both tokens' bytes end in just these two; with ``left`` -1: ``right`` begins the bytes and always may.

        Seen backwards from the end: the part of each token at the seam was made by a merge. Taking the later one apart again and again shows every
        pair that lay at the seam at some time. If such a pair is a token that comes before the merge that has made one of its
        sides vanish, the merges would have joined it.
        """
        known = self._pairs.get(left << 32 | right)
        if known is None:
            if len(self._pairs) >= MEMO:
                self._pairs.clear()
            known = self._pairs[left << 32 | right] = left < 0 or self._apart(left, right)
        return known

    def _apart(self, left: int, right: int) -> bool:
        # until_left and until_right: the rank of the merge that ends the life of the part at the seam on that side.
        until_left = until_right = 1 << 60
        while True:
            joined = self.ranks.get(self.token[left] + self.token[right])
            # On equal ranks the leftmost merge comes first: the left part is gone, the right part still there.
            if joined is not None and joined < until_left and joined <= until_right:
                return False
            a, b = self.halves(left), self.halves(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and left > right):
                until_left, left = left, a[1]
            else:
                until_right, right = right, b[0]

    def piece(self, text: str) -> array:
        """The ids of one piece of split text."""
        if text not in self._pieces:
            self.learn({text})
        return array("i", self._pieces[text])

    def learn(self, pieces: set[str]) -> None:
        """Encode pieces that aren't known; in sorted order, so that each keeps the rows of the prefix it shares with the one before."""
        table = PrefixTable(self)
        for text in sorted(pieces):
            data, shared, last = text.encode(), 0, table.data
            while shared < len(last) and shared < len(data) and last[shared] == data[shared]:
                shared += 1
            table.cut(shared)
            table.append(data[shared:])
            self._pieces[text] = array("i", table.tokens()).tobytes()


class PrefixTable:
    """The last token of every non-empty prefix of some bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def _row(self, stop: int) -> int:
        """The token that ends the prefix of ``stop`` bytes; exactly one fits."""
        rank, data, last = self.vocabulary.ranks.get, self.data, self.last
        known, may_follow = self.vocabulary._pairs.get, self.vocabulary.may_follow
        for start in range(stop - 1, max(0, stop - self.vocabulary.longest) - 1, -1):
            token = rank(data[start:stop])
            if token is not None:
                fits = known(last[start] << 32 | token)
                if fits or (fits is None and may_follow(last[start], token)):
                    return token
        raise ValueError("the vocabulary lacks a byte")

    def append(self, more: bytes) -> None:
        # The loop of _row, written out: most of the work on new words is here.
        begin, self.data = len(self.data), self.data + more
        rank, data, last, longest = self.vocabulary.ranks.get, self.data, self.last, self.vocabulary.longest
        known, may_follow = self.vocabulary._pairs.get, self.vocabulary.may_follow
        for stop in range(begin + 1, len(data) + 1):
            for start in range(stop - 1, stop - longest - 1 if stop > longest else -1, -1):
                token = rank(data[start:stop])
                if token is not None:
                    fits = known(last[start] << 32 | token)
                    if fits or (fits is None and may_follow(last[start], token)):
                        last.append(token)
                        break
            else:
                raise ValueError("the vocabulary lacks a byte")

    def cut(self, stop: int) -> None:
        """Keep the first ``stop`` bytes; their rows don't depend on what follows."""
        del self.last[stop + 1 :]
        self.data = self.data[:stop]

    def edit(self, start: int, stop: int, new: bytes) -> int:
        """Replace ``data[start:stop]``; returns the number of rows that were computed."""
        old, tail, shift = self.last, len(self.data) - stop, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last, same, done = old[: start + 1], 0, 0
        for at in range(start + 1, len(self.data) + 1):
            row = self._row(at)
            self.last.append(row)
            done += 1
            # A row depends on the rows and bytes of the longest token's length before it and on nothing else.
            same = same + 1 if at > start + len(new) and row == old[at - shift] else 0
            if same >= self.vocabulary.longest and at < len(self.data):
                self.last.extend(old[at - shift + 1 :])
                break
        assert len(self.last) == len(self.data) + 1 and tail >= 0
        return done

    def tokens(self, stop: int | None = None) -> list[int]:
        """The encoding of the first ``stop`` bytes."""
        at, found = len(self.data) if stop is None else stop, []
        while at:
            found.append(self.last[at])
            at -= len(self.vocabulary.token[found[-1]])
        return found[::-1]


class TextEncoder:
    """Encoding of one text that grows and changes: pieces are split and encoded again only near a change."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, text: str = ""):
        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        self.text, self.starts = text, [m.start() for m in self.pattern.finditer(text)]

    def append(self, more: str) -> None:
        self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, stop: int, new: str) -> None:
        """Replace ``text[start:stop]``. Splitting starts two pieces earlier and ends where a piece begins as before."""
        keep = max(0, bisect_left(self.starts, start) - 2)
        old, shift = self.starts, len(new) - (stop - start)
        begin = old[keep] if keep < len(old) else 0
        self.text = self.text[:start] + new + self.text[stop:]
        found = old[:keep]
        for m in self.pattern.finditer(self.text, begin):
            at = bisect_left(old, m.start() - shift)
            if m.start() > start + len(new) and at < len(old) and old[at] == m.start() - shift:
                found.extend(s + shift for s in old[at:])
                break
            found.append(m.start())
        self.starts = found

    def tokens(self) -> list[int]:
        stops = [*self.starts[1:], len(self.text)]
        return list(chain.from_iterable(self.vocabulary.piece(self.text[a:b]) for a, b in zip(self.starts, stops, strict=True)))


_loaded: dict[int, Vocabulary] = {}


def _vocabulary(lines: bytes) -> Vocabulary:
    """One vocabulary per worker process."""
    if hash(lines) not in _loaded:
        _loaded.clear()
        _loaded[hash(lines)] = Vocabulary.parse(lines)
    return _loaded[hash(lines)]


def _lists(arrays: list, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) // 4 for a in arrays])]).astype(np.int32)
    flat = np.frombuffer(b"".join(arrays), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def encode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids`` (array of ints) for each row; each match of ``pattern`` is encoded by itself, without special tokens.

    ``path`` is a rank file that the driver can read; its bytes (about 1 MB for 50,000 tokens) go to the tasks. Null and empty texts have no
    ids. Rows are encoded one by one: ties and repeated rows need no rule, an empty table gives an empty one, null keys stay, and
    other columns are left out.
    """
    with open(path, "rb") as file:
        lines = file.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, split = _vocabulary(lines), regex.compile(pattern).findall
        known = vocabulary._pieces
        for batch in batches:
            for lo, hi, texts in text_blocks(batch.column("text")):
                parts = [split(t.decode()) if t else [] for t in texts]
                if len(known) > MEMO:
                    known.clear()
                vocabulary.learn(set(filterfalse(known.__contains__, chain.from_iterable(parts))))
                found = [b"".join(map(known.__getitem__, p)) for p in parts]
                yield pa.RecordBatch.from_arrays([batch.column("key")[lo:hi], _lists(found, pa.int32())], names=["key", "ids"])

    given = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return given.mapInArrow(run, f"key {given.schema['key'].dataType.simpleString()}, ids array<int>").withColumnRenamed("key", key)


def decode(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key``, ``ids`` and ``decoded`` (binary) for each row: the bytes of the tokens in a row. Null ids are no ids; an unknown id is an error."""
    with open(path, "rb") as file:
        lines = file.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = _vocabulary(lines).token
        for batch in batches:
            column = batch.column("ids").fill_null([])
            offsets, flat = column.offsets.to_numpy(), column.values.to_numpy()
            for lo in range(0, len(column), 256):
                some = range(lo, min(lo + 256, len(column)))
                out = [b"".join(map(token.__getitem__, flat[offsets[i] : offsets[i + 1]].tolist())) for i in some]
                yield pa.RecordBatch.from_arrays([batch.column("key")[lo : lo + 256], column[lo : lo + 256], pa.array(out, pa.binary())], names=["key", "ids", "decoded"])

    given = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{ids}`").cast("array<int>").alias("ids"))
    kind = given.schema["key"].dataType.simpleString()
    return given.mapInArrow(run, f"key {kind}, ids array<int>, decoded binary").withColumnRenamed("key", key)
