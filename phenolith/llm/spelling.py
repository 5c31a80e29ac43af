"""Spelling variants: near words of a counted vocabulary by sorted-list dynamic programming.

Two words one edit apart agree on their first or on their last half, whatever the edit. Words are therefore grouped by either half, and
what is left of them, the middle, is compared within a group: the middles lie in a sorted list, and the edit matrix of a query word is kept
as the three cells around its diagonal. Neighbours in the list share the rows of their common prefix, so a row is computed once for the range of
words that begin alike, and a range whose row has no cell of one edit or less is skipped whole. All queries of a block go down the list
together, a column of characters at a time.

A group with very many words is divided again by halves of its middle until it is small: nothing is capped, and no task holds more than one group.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenolith.llm.components import follow
from phenolith.session import write_once

RUN = r"[A-Za-zÀ-ÿ]"
#: Words of a group before it is divided, and words that look for their neighbours at the same time.
GROUP_WORDS, QUERY_BLOCK = 20_000, 4096
_FAR = 3  # any cell beyond one edit
_UPPER = "".join(chr(c) for c in range(65, 91))


def count_words(df: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 7, min_count: int = 2,
                change: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """``word, n``: the runs of letters of all whole texts with A-Z in lower case, of ``min_chars`` code points and ``min_count`` occurrences or more.

    ``change`` gets a run and its key as text (empty for null) and returns the run to count instead; it may shorten runs. Occurrences are counted
    in each task before the shuffle, so a word in every text is one row of each task. Null and empty texts have no words.
    """
    runs = df.select(
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"),
        F.explode(F.regexp_extract_all(F.col(f"`{text}`").cast("string"), F.lit(RUN + "{%d,}" % min_chars), F.lit(0))).alias("run"))
    low = runs.select("key", F.translate("run", _UPPER, _UPPER.lower()).alias("run"))
    words = low.select((F.col("run") if change is None else change(F.col("run"), F.col("key"))).alias("word")).where(F.length("word") >= min_chars)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


# --- the sorted list -----------------------------------------------------------------------------


class _Level:
    """The rows of the list that some query still reaches, in ranges of equal prefix."""

    def __init__(self, rows: np.ndarray, ranges: np.ndarray):
        self.rows, self.ranges = rows, ranges


def _repeat(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i the numbers first[i] .. first[i] + count[i] - 1, end to end, and the i of each."""
    who = np.repeat(np.arange(len(count)), count)
    start = np.cumsum(count) - count
    return who, first[who] + np.arange(len(who)) - start[who]


def scan_sorted(codes: np.ndarray, begin: np.ndarray, size: np.ndarray, group: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a query and a row of its group at most one edit apart, the row itself included.

    Row ``r`` is ``codes[begin[r] : begin[r] + size[r]]``; rows are sorted by ``group`` (numbers from 0, without a gap), then by their codes.
    """
    wanted = np.zeros(int(group[-1]) + 1 if len(group) else 0, dtype=bool)
    wanted[group[queries]] = True
    number = np.cumsum(wanted) - 1
    level = _Level(np.flatnonzero(wanted[group]), number[group[wanted[group]]])
    q, at = queries, number[group[queries]]  # a query and the range it has reached
    left, mid, right = np.full(len(q), _FAR, np.int8), np.zeros(len(q), np.int8), np.ones(len(q), np.int8)
    right[size[q] < 1] = _FAR
    found_q, found_row, depth = [], [], 0
    while len(q):
        n_ranges = int(level.ranges[-1]) + 1
        ends = size[level.rows] == depth
        if ends.any():  # words that end here: the cell below the query's last character decides
            behind = size[q] - depth
            cell = np.where(behind == 0, mid, np.where(behind == 1, right, np.where(behind == -1, left, _FAR)))
            near = np.flatnonzero(cell <= 1)
            ended, count = level.rows[ends], np.bincount(level.ranges[ends], minlength=n_ranges)
            who, place = _repeat((np.cumsum(count) - count)[at[near]], count[at[near]])
            found_q.append(q[near][who])
            found_row.append(ended[place])
        rows, ranges = level.rows[~ends], level.ranges[~ends]
        if not len(rows):
            break
        char = codes[begin[rows] + depth]
        fresh = np.ones(len(rows), dtype=bool)
        fresh[1:] = (ranges[1:] != ranges[:-1]) | (char[1:] != char[:-1])
        child = np.cumsum(fresh) - 1
        count = np.bincount(ranges[fresh], minlength=n_ranges)
        who, next_range = _repeat((np.cumsum(count) - count)[at], count[at])
        c, q = char[fresh][next_range], q[who]
        old_left, old_mid, old_right = left[who], mid[who], right[who]

        def differs(place: np.ndarray) -> np.ndarray:  # a place outside of the query never matches
            inside = (place >= 0) & (place < size[q])
            return ~inside | (codes[np.where(inside, begin[q] + place, 0)] != c)

        there = np.full(len(q), depth)
        left = np.minimum(old_left + differs(there - 1), old_mid + 1)
        mid = np.minimum(np.minimum(old_mid + differs(there), old_right + 1), left + 1)
        right = np.minimum(old_right + differs(there + 1), mid + 1)
        depth += 1
        left = np.where(depth - 1 <= size[q], left, _FAR)
        mid = np.where(depth <= size[q], mid, _FAR)
        right = np.where(depth + 1 <= size[q], right, _FAR)
        stay = np.minimum(np.minimum(left, mid), right) <= 1
        q, next_range, left, mid, right = q[stay], next_range[stay], *(np.minimum(x[stay], _FAR).astype(np.int8) for x in (left, mid, right))
        reached = np.zeros(int(fresh.sum()), dtype=bool)
        reached[next_range] = True
        number, held = np.cumsum(reached) - 1, reached[child]
        at, level = number[next_range], _Level(rows[held], number[child[held]])
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *found_q]), np.concatenate([none, *found_row])


def _pairs_of(table: pa.Table) -> pa.Table:
    """The pairs of whole groups: a word of ``m`` characters with one of as many, each pair once, or of one more."""
    words, m = table.column("word").to_pylist(), table.column("m").to_numpy()
    i, e, gid = (table.column(c).to_numpy() for c in ("i", "e", "gid"))
    chars = np.array([len(w) for w in words])
    codes = np.append(np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32), 0)
    begin, size = np.cumsum(chars) - chars + i, chars - i - e
    group = np.cumsum(np.append(False, gid[1:] != gid[:-1]))
    asking = np.flatnonzero(chars == m)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo in range(0, len(asking), QUERY_BLOCK):
        q, row = scan_sorted(codes, begin, size, group, asking[lo : lo + QUERY_BLOCK])
        once = (chars[row] > chars[q]) | (row > q)
        a.append(q[once])
        b.append(row[once])
    a, b = np.concatenate(a), np.concatenate(b)
    pick = lambda name, rows: table.column(name).take(pa.array(rows))
    return pa.table({
        "a": pick("word", a), "an": pick("n", a), "b": pick("word", b), "bn": pick("n", b), "i": pick("i", a), "e": pick("e", a), "differ": pick("differ", a)})


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole groups at a time; groups arrive one after the other, sorted by their middles."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        gid = batch.column("gid").to_numpy()
        if not len(gid):
            continue
        other = np.flatnonzero(gid != gid[-1])
        cut = int(other[-1]) + 1 if len(other) else 0  # where the last group of the batch begins
        if held and held[-1].column("gid")[-1].as_py() != gid[0] or cut:
            whole = pa.Table.from_batches([*held, batch.slice(0, cut)])
            yield from _pairs_of(whole).combine_chunks().to_batches(max_chunksize=20_000)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield from _pairs_of(pa.Table.from_batches(held)).combine_chunks().to_batches(max_chunksize=20_000)


# --- the groups ----------------------------------------------------------------------------------

_PLACED = "word, n, m, g.i as i, g.e as e, g.differ as differ, concat(left(word, g.i), right(word, g.e)) as key"
_FIRST = """inline(flatten(transform(array(length(word), length(word) - 1), m -> array(
    named_struct('m', m, 'i', m div 2, 'e', 0L, 'differ', 0L),
    named_struct('m', m, 'i', 0L, 'e', m - m div 2, 'differ', m div 2)))))"""
_HALVES = """explode(array(
    named_struct('i', i + (m - i - e) div 2, 'e', e, 'differ', differ),
    named_struct('i', i, 'e', m - i - (m - i - e) div 2, 'differ', i + (m - i - e) div 2))) as g"""
_KEYS = ["m", "i", "e", "key"]


def grouped(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """``words`` by group: words of ``m`` characters or one more that agree on the first ``i`` and the last ``e``.

    The words of a pair with one insertion between both halves agree on either; ``differ`` characters from the start must not agree
    in a group by endings, so that each pair is in one group only. Groups of more than ``group_words`` words are divided by halves of what
    their words don't share yet, which ends where that is a single character.
    """
    first = words.selectExpr("word", "n", _FIRST).where("m > 0 and (e = 0 or differ > 0)").selectExpr("word", "n", "m", "named_struct('i', i, 'e', e, 'differ', differ) as g")
    rows, done = first.selectExpr(*_expr(_PLACED)), None
    while True:
        sizes = rows.groupBy(*_KEYS).agg(F.count("*").alias("words")).where((F.col("words") > group_words) & (F.col("m") - F.col("i") - F.col("e") > 1))
        large = write_once(sizes.select(*_KEYS), "large-groups")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = rows.join(large, _KEYS, "left_anti").select(*rows.columns)
        done = small if done is None else done.unionByName(small)
        finer = rows.join(large, _KEYS, "left_semi").selectExpr("word", "n", "m", "i", "e", "differ").selectExpr("word", "n", "m", _HALVES)
        rows = write_once(finer.selectExpr(*_expr(_PLACED)), "finer-groups")


def _expr(text: str) -> list[str]:
    """Columns of a select list without commas inside of brackets being cut."""
    parts, depth, start = [], 0, 0
    for at, c in enumerate(text):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            parts.append(text[start:at])
            start = at + 1
    return [p.strip() for p in [*parts, text[start:]]]


def near_words(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """``a, an, b, bn``: every two different words one inserted, deleted or replaced code point apart, once, with their counts.

    ``words`` has the columns ``word`` and ``n``, each word once.
    """
    rows = grouped(words, group_words).withColumns({"gid": F.xxhash64(*_KEYS), "middle": F.expr("substring(word, int(i) + 1, int(length(word) - i - e))")})
    dealt = rows.repartition("gid").sortWithinPartitions("gid", "middle").selectExpr("gid", "word", "n", "int(m) m", "int(i) i", "int(e) e", "int(differ) differ")
    found = dealt.mapInArrow(_scan, "a string, an bigint, b string, bn bigint, i int, e int, differ int")
    # Two groups may have one hash; what their words have in common is checked on the words themselves.
    return found.where(
        "left(a, i) = left(b, i) and right(a, e) = right(b, e) and (differ = 0 or left(a, differ) <> left(b, differ))").select("a", "an", "b", "bn")


def spelling_variants(words: DataFrame, factor: int = 10, group_words: int = GROUP_WORDS) -> DataFrame:
    """One row per word of ``words`` (``word, n``): ``word, root, n, form, form_n, n_near``.

    ``n_near`` counts the near words, those one inserted, deleted or replaced code point away. ``form`` is the near word of the largest count, the
    smallest of several in code-point order, if its count is at least ``factor`` times that of the word, else null; ``form_n`` is its count. ``root``
    follows the forms to the last one and is the word itself where there is none. Null and empty words and null counts are left out, the counts of a
    repeated word are added up, an empty table gives an empty one, other columns are left out.
    """
    once = words.where("word <> '' and n is not null").groupBy("word").agg(F.sum("n").alias("n"))
    given = write_once(once, "vocabulary")
    pairs = near_words(given, group_words)
    # Both directions of a pair beside each word's own row: one shuffle, with partial results of each task before it.
    sides = pairs.selectExpr("inline(array(named_struct('word', a, 'near', b, 'near_n', bn), named_struct('word', b, 'near', a, 'near_n', an)))")
    every = sides.selectExpr("word", "cast(null as bigint) as own", "near", "near_n").unionByName(
        given.selectExpr("word", "n as own", "cast(null as string) as near", "cast(null as bigint) as near_n"))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))))
    judged = every.groupBy("word").agg(F.max("own").alias("n"), F.count("near").alias("n_near"), best.alias("best"))
    large = -F.col("best.minus") >= factor * F.col("n")
    formed = write_once(judged.select(
        "word", "n", "n_near", F.when(large, F.col("best.near")).alias("form"), F.when(large, -F.col("best.minus")).alias("form_n")), "forms")
    roots = follow(formed.where("form is not null").selectExpr("word as node", "form as root")).withColumnRenamed("node", "word")
    return formed.join(roots, "word", "left").select("word", F.coalesce("root", "word").alias("root"), "n", "form", "form_n", "n_near")
