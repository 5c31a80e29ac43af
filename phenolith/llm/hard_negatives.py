"""Hard-negative mining with bounds along a spanning tree of the anchors.

The anchors of one label are joined by a minimum spanning tree over their distances. All candidates are scored at the root. What is known of a
candidate at a parent, a score and how far it may be off, bounds its score at the child: the score of a candidate x changes by the inner
product of x with the edge, at most the length of the edge times the norm of x. A candidate whose interval misses what the child looks for is not scored
there and hands its wider interval down; one whose interval overlaps is rescored exactly and hands that down.

Anchors are a stated set and meet all candidates in blocks: a wave of at most ``WAVE`` anchors goes to all tasks, which stream their candidates
past its trees and give back only the best few of each anchor. Two passes: the positives of an anchor, then the negatives in their windows.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phenolith.operators.numbering import number_rows
from phenolith.session import scratch_path, write_once

WAVE, BLOCK_ROWS = 2048, 8192
#: Added to a bound in parts of it: more than what rounding of norms and distances in double precision can take away.
_SLACK = 1e-9


@dataclass
class Tree:
    """Anchors of one label in an order in which parents come first."""

    label: object
    numbers: np.ndarray
    ids: np.ndarray
    vectors: np.ndarray
    parent: np.ndarray  # place of the parent in this order, -1 for the root
    edge: np.ndarray  # distance from the parent
    last: np.ndarray  # place of the last child, after which the scores kept for a node are dropped


def spanning_tree(label, numbers: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> Tree:
    """A minimum spanning tree from the first anchor on, always adding the anchor nearest to the tree."""
    square = (vectors * vectors).sum(1)
    best, came, order = np.full(len(ids), np.inf), np.full(len(ids), -1), []
    left = np.ones(len(ids), dtype=bool)
    at = 0
    for _ in range(len(ids)):
        order.append(at)
        left[at] = False
        away = square + square[at] - 2 * (vectors @ vectors[at])
        nearer = left & (away < best)
        best[nearer], came[nearer] = away[nearer], at
        if left.any():
            at = int(np.argmin(np.where(left, best, np.inf)))
    order = np.array(order)
    place = np.empty(len(order), dtype=int)
    place[order] = np.arange(len(order))
    parent = np.where(came[order] >= 0, place[came[order]], -1)
    vectors = vectors[order]
    edge = np.where(parent >= 0, np.sqrt(((vectors - vectors[parent]) ** 2).sum(1)), 0.0)
    last = np.full(len(order), -1)
    np.maximum.at(last, parent[parent >= 0], np.flatnonzero(parent >= 0))
    return Tree(label, numbers[order], ids[order], vectors, parent, edge, last)


def _walk(tree: Tree, x: np.ndarray, norms: np.ndarray, wanted) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each anchor the candidates that ``wanted(anchor, low, high)`` asks for, from bounds of their scores, with exact scores."""
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for i in range(len(tree.ids)):
        if tree.parent[i] < 0:
            score, off = x @ tree.vectors[i], np.zeros(len(x))
            asked = np.flatnonzero(wanted(i, score, score))
        else:
            above, before = known[tree.parent[i]]
            off = before + tree.edge[i] * norms
            off += _SLACK * (off + np.abs(above))
            asked = np.flatnonzero(wanted(i, above - off, above + off))
            score = above.copy()
            score[asked], off[asked] = x[asked] @ tree.vectors[i], 0
        yield i, asked, score[asked]
        if tree.last[i] >= 0:
            known[i] = score, off
        if tree.parent[i] >= 0 and tree.last[tree.parent[i]] == i:
            del known[tree.parent[i]]


def _first(score: np.ndarray, key: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` highest scores, ties by the smaller key; rows of one key and score count once."""
    some = 4 * count
    while True:
        at = np.flatnonzero(score >= np.partition(score, len(score) - some)[len(score) - some]) if len(score) > some else np.arange(len(score))
        at = at[np.lexsort((key[at], -score[at]))]
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = (score[at][1:] != score[at][:-1]) | (key[at][1:] != key[at][:-1])
        if fresh.sum() >= count or len(at) == len(score):
            return score[at][fresh][:count], key[at][fresh][:count]
        some *= 8  # repeated rows hold the first places: look further


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Keys, labels and vectors of up to ``BLOCK_ROWS`` candidates; shorter vectors are filled up with zeros, longer ones are cut to ``width``."""
    held, rows = [], 0

    def block():
        table = pa.Table.from_batches(held)
        vector = table.column("vector").combine_chunks()
        sizes = np.diff(vector.offsets.to_numpy())
        flat = vector.flatten().to_numpy(zero_copy_only=False)
        if len(sizes) and (sizes == width).all():
            x = flat.reshape(len(sizes), width)
        else:
            x = np.zeros((len(sizes), width))
            start = np.cumsum(sizes) - sizes
            for d in range(width):
                there = sizes > d
                x[there, d] = flat[start[there] + d]
        return table.column("key").to_numpy(), table.column("label").to_numpy(zero_copy_only=False), x

    for batch in batches:
        for lo in range(0, len(batch), BLOCK_ROWS):
            held.append(batch.slice(lo, BLOCK_ROWS))
            rows += len(held[-1])
            if rows >= BLOCK_ROWS:
                yield block()
                held, rows = [], 0
    if rows:
        yield block()


def _positives(trees: list[Tree], width: int, count: int):
    """Per task and anchor the ``count`` best candidates of its label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[(np.zeros(0), np.zeros(0, np.int64)) for _ in t.ids] for t in trees]
        for key, label, x in _blocks(batches, width):
            for tree, found in zip(trees, best, strict=True):
                same = np.flatnonzero(label == tree.label)
                if not len(same):
                    continue
                keys, vectors = key[same], x[same]

                def wanted(i: int, low: np.ndarray, high: np.ndarray, keys=keys, tree=tree, found=found) -> np.ndarray:
                    floor = found[i][0][-1] if len(found[i][0]) == count else -np.inf
                    return (high >= floor) & (keys != tree.ids[i])

                for i, asked, score in _walk(tree, vectors, np.sqrt((vectors * vectors).sum(1)), wanted):
                    if len(asked):
                        found[i] = _first(np.append(found[i][0], score), np.append(found[i][1], keys[asked]), count)
        for tree, found in zip(trees, best, strict=True):
            sizes = [len(k) for _, k in found]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(tree.numbers, sizes), pa.int64()), pa.array(np.repeat(tree.ids, sizes), pa.int64()),
                pa.array(np.concatenate([k for _, k in found]).astype(np.int64)), pa.array(np.concatenate([s for s, _ in found]).astype(np.int64))],
                names=["anchor", "anchor_id", "positive_id", "positive_score"])

    return run


def _negatives(trees: list[Tree], positives: dict[int, list[tuple[int, int]]], width: int, count: int, low_percent: int, high_percent: int):
    """Per task, anchor and positive the ``count`` best candidates of another label in the positive's window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {(n, p): (np.zeros(0), np.zeros(0, np.int64)) for t in trees for n in t.numbers for p in positives.get(n, [])}
        for key, label, x in _blocks(batches, width):
            norms = np.sqrt((x * x).sum(1))
            for tree in trees:
                other = label != tree.label

                def wanted(i: int, low: np.ndarray, high: np.ndarray, tree=tree, other=other) -> np.ndarray:
                    asked = np.zeros(len(low), dtype=bool)
                    for p in positives.get(tree.numbers[i], []):
                        seen = best[tree.numbers[i], p][0]
                        floor = 100 * seen[-1] if len(seen) == count else -np.inf
                        asked |= (100 * high >= max(low_percent * p[1], floor)) & (100 * low <= high_percent * p[1])
                    return asked & other

                for i, asked, score in _walk(tree, x, norms, wanted):
                    if not len(asked):
                        continue
                    for p in positives.get(tree.numbers[i], []):
                        inside = (100 * score >= low_percent * p[1]) & (100 * score <= high_percent * p[1])
                        if inside.any():
                            held = best[tree.numbers[i], p]
                            best[tree.numbers[i], p] = _first(np.append(held[0], score[inside]), np.append(held[1], key[asked[inside]]), count)
        rows = [(n, p[0], p[1], k, s) for (n, p), (scores, keys) in best.items() for s, k in zip(scores.tolist(), keys.tolist(), strict=True)]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array([int(v) for v in c], pa.int64()) for c in columns], names=["anchor", "positive_id", "positive_score", "negative_id", "negative_score"])

    return run


def _ranked(rows: DataFrame, by: list[str], score: str, key: str, count: int) -> DataFrame:
    """The first ``count`` of each group in order of falling score, then key, with their ``rank``. Each task keeps as many before the shuffle."""
    order = Window.partitionBy(*by).orderBy(F.desc(score), key)
    return rows.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def usable(vector: Column) -> Column:
    """Neither null nor with a component that is null or not finite."""
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def mine_hard_negatives(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", anchors: str = "_key % 50 = 0",
                        positives: int = 5, negatives: int = 3, low_percent: int = 50, high_percent: int = 95, wave: int = WAVE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows of ``df`` that the condition ``anchors`` (on ``_key``) names.

    Scores are inner products of whole-numbered vectors, exact while their sums stay below 2^53; higher scores come first, ties by the smaller key. The
    positives of an anchor are its first ``positives`` rows of the same label and another key. For each of them the first ``negatives`` rows of
    other labels are returned whose score is between ``low_percent`` and ``high_percent`` of the positive's, ``rank`` counting from 1.

    Rows with a null key, a null label, a null vector or a component that is null or not finite take no part. Rows of one key that score alike
    with an anchor count once; rows of an anchor's key with different labels or vectors are anchors each, and each gives its own rows, equal ones once. Of vectors of different
    lengths the missing components count as zero. An anchor without positives or without negatives in a window gives no rows, nor does an empty table; other columns
    are left out, whatever their names.
    """
    spark = df.sparkSession
    given = df.select(
        F.col(f"`{key}`").cast("long").alias("_key"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    rows = write_once(given.where(F.col("_key").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector"))), "vectors")
    numbered = number_rows(rows.where(anchors).distinct(), ["_key", "label", "vector"], "anchor")
    chosen = write_once(numbered, "anchors")
    candidates = rows.withColumnRenamed("_key", "key")
    total = chosen.count()
    folder, columns = scratch_path(spark, "hard-negatives"), ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    for start in range(0, total, wave):
        some = chosen.where((F.col("anchor") >= start) & (F.col("anchor") < start + wave)).orderBy("anchor").toPandas()  # at most ``wave`` rows
        width = max(1, max(len(v) for v in some["vector"]))
        vectors = np.zeros((len(some), width))
        for i, v in enumerate(some["vector"]):
            vectors[i, : len(v)] = v
        trees = []
        for value in sorted(set(some["label"])):
            at = np.flatnonzero((some["label"] == value).to_numpy())
            trees.append(spanning_tree(value, some["anchor"].to_numpy()[at], some["_key"].to_numpy()[at], vectors[at]))
        near = candidates.mapInArrow(_positives(trees, width, positives), "anchor bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
        first = write_once(_ranked(near, ["anchor", "anchor_id"], "positive_score", "positive_id", positives).drop("rank"), "positives")
        windows: dict[int, list[tuple[int, int]]] = {}
        for r in first.collect():  # ``positives`` of each anchor of the wave
            windows.setdefault(r["anchor"], []).append((r["positive_id"], r["positive_score"]))
        found = candidates.mapInArrow(
            _negatives(trees, windows, width, negatives, low_percent, high_percent),
            "anchor bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint")
        ranked = _ranked(found, ["anchor", "positive_id", "positive_score"], "negative_score", "negative_id", negatives)
        named = ranked.join(F.broadcast(first.select("anchor", "anchor_id").distinct()), "anchor")  # one row per anchor of the wave
        named.select(*columns).write.parquet(f"{folder}/wave={start // wave}")
    if not total:
        return spark.range(0).selectExpr(*[f"cast(null as {'int' if c == 'rank' else 'bigint'}) as {c}" for c in columns])
    return spark.read.parquet(folder).select(*columns).distinct()
