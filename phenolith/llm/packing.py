"""Variable-capacity best-fit packing of texts into sequences.

Texts longer than the largest permitted length are cut into pieces. Pieces, longest first, go to the open bin they fill best; if none has
room, a bin of the size with the least cost per token it can expect is opened. In the end each bin shrinks to the smallest permitted length that
holds its contents. Bins are local to a block of pieces: blocks are packed in parallel and need memory for one block.
"""

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAPACITIES = (512, 1024, 2048, 4096)
BLOCK_PIECES = 50_000
#: A sequence costs its length, a fixed share for the step, and attention that grows with the square of the length.
STEP_COST, ATTENTION = 64.0, 1 / 16384


def cost(capacity: int) -> float:
    return STEP_COST + capacity + ATTENTION * capacity * capacity


def pack(lengths: list[int], capacities: tuple[int, ...] = CAPACITIES) -> list[tuple[int, int, int]]:
    """Bin, offset in the bin and final capacity of the bin for each length (1 to the largest capacity), in the order given."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])  # stable: ties stay in order
    ahead = sum(lengths)  # tokens not yet placed
    room: list[tuple[int, int]] = []  # (free tokens, bin) of the open bins, sorted
    filled: list[int] = []
    placed: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for i in order:
        need = lengths[i]
        at = bisect_left(room, (need, -1))
        if at < len(room):
            free, bin_ = room.pop(at)
        else:
            # What a new bin of each size can hold: this piece and what still follows.
            free = min((c for c in capacities if c >= need), key=lambda c: (cost(c) / min(c, ahead), c))
            bin_ = len(filled)
            filled.append(0)
        placed[i] = bin_, filled[bin_]
        filled[bin_] += need
        ahead -= need
        if free > need:
            insort(room, (free - need, bin_))
    final = [min(c for c in capacities if c >= n) for n in filled]
    return [(b, offset, final[b]) for b, offset in placed]


def _packer(capacities: tuple[int, ...], block: int):
    def packed(rows: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        done = pack(table.column("length").to_pylist(), capacities)
        bins, offsets, sizes = (np.array(c, dtype=np.int64) for c in zip(*done, strict=True))
        extra = [pa.array(np.full(len(done), number)), pa.array(bins), pa.array(offsets), pa.array(sizes)]
        return pa.RecordBatch.from_arrays([*table.columns, *extra], names=[*table.schema.names, "block", "bin", "bin_offset", "capacity"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context, held, count, blocks = TaskContext.get(), [], 0, 0
        for batch in batches:
            while len(batch):
                take = min(len(batch), block - count)
                held.append(batch.slice(0, take))
                count, batch = count + take, batch.slice(take)
                if count == block:
                    yield packed(held, (context.partitionId() << 20) + blocks)
                    held, count, blocks = [], 0, blocks + 1
        if held:
            yield packed(held, (context.partitionId() << 20) + blocks)

    return run


def words(text: Column) -> Column:
    """Length of a text in words between white space; 0 for null and blank texts."""
    bare = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(F.coalesce(bare, F.lit("")) == "", 0).otherwise(F.size(F.split(bare, r"[\x20\x09-\x0D]+")))


def pack_best_fit(df: DataFrame, key: str = "doc_id", length: Column | None = None, capacities: tuple[int, ...] = CAPACITIES,
                  block: int = BLOCK_PIECES) -> DataFrame:
    """One row per piece: ``key``, ``piece``, ``start`` and ``length`` (in tokens of the text), ``block``, ``bin``, ``bin_offset``, ``capacity``.

    ``length`` is the number of tokens of a row (by default the words of ``text``). A text of more than the largest capacity is cut into
    pieces of that capacity and a rest; nothing is left out but texts without tokens. (``block``, ``bin``) names a sequence: its pieces lie end to
    end from offset 0 and fit its ``capacity``, the smallest permitted one that holds them.

    Pieces are dealt by a hash of key, piece and length and of the row's number, so repeated rows and a key with very many pieces spread as well, and sorted within
    a task by key and piece. Null lengths and texts have no pieces; null keys are packed like others; an empty table gives an empty one;
    other columns are left out.
    """
    sizes, largest = tuple(sorted(set(capacities))), max(capacities)
    n = (words(F.col("text")) if length is None else length).cast("long")
    measured = df.select(F.col(f"`{key}`").alias("key"), n.alias("n")).where("n > 0").withColumn("row", F.monotonically_increasing_id())
    pieces = measured.withColumn("piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / largest))))
    start = F.col("piece") * largest
    cut = pieces.select("key", F.col("piece").cast("long").alias("piece"), start.cast("long").alias("start"), F.least(F.col("n") - start, F.lit(largest)).cast("long").alias("length"), "row")
    dealt = cut.repartition(F.xxhash64("key", "piece", "length", "row")).sortWithinPartitions("key", "piece", "row").drop("row")
    kind = dealt.schema["key"].dataType.simpleString()
    packed = dealt.mapInArrow(_packer(sizes, block), f"key {kind}, piece bigint, start bigint, length bigint, block bigint, bin bigint, bin_offset bigint, capacity bigint")
    return packed.withColumnRenamed("key", key)
