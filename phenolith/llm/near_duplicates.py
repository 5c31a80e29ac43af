"""Near-duplicates by fast similarity sketching, banding and exact verification.

1. Each text becomes its set of word shingles, a key of the whole set and a sketch cut into bands. Equal sets are one class.
2. Classes that share a band form a bucket with one pivot. A member is compared, on full sets, with one of its pivots, and with the
   others unless the links found so far put both into one component.
3. Members of a bucket that are still in different components are compared with more pivots, 32 times as many each round and in the end
   all of them; pairs whose sketches are too far apart are not compared. Pairs within a component are never formed, so a large group of copies costs a comparison or two per member and band.

Sets are only kept for classes in a bucket with another one. Everything between the steps is a table in the shared folder.
"""

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenolith.llm.components import components
from phenolith.llm.shingles import mix, shingle_sets, text_blocks
from phenolith.llm.similarity_sketch import ROWS, band_keys, bands_for, sketches
from phenolith.session import write_once

PIVOT_GROWTH = 32
_SEEN = 200_000  # keys of texts that a task remembers in order not to make their sets again
#: Coordinates of the sketch that estimates similarity before sets are compared, of which one bit each is kept, and how many standard
#: deviations below the threshold an estimate may lie: 4.5 turn away three in a million pairs that are just at it.
FINE, DEVIATIONS = 1024, 4.5


def _set_key(values: np.ndarray) -> bytes | None:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None


def _sketcher(width: int, bands: int, carried: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in text_blocks(batch.column("text")):
                values, begins = shingle_sets(texts, width)
                keys = band_keys(sketches(values, begins, bands * ROWS)).view(np.int64)
                sizes = np.diff(begins)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id")[lo:hi], pa.array([_set_key(values[begins[i] : begins[i + 1]]) for i in range(hi - lo)], pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1) * bands, pa.int32()), pa.array(keys.ravel(), pa.int64())),
                    *(batch.column(c)[lo:hi] for c in carried)], names=["id", "node", "n", "bands", *carried])

    return run


def _set_maker(width: int):
    """Set and fine sketch of each text, of equal texts in a row of batches once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for lo, hi, texts in text_blocks(batch.column("text")):
                if len(seen) > _SEEN:
                    seen = set()
                keys = [hashlib.blake2b(t or b"", digest_size=16).digest() for t in texts]
                texts = [t for t, k in zip(texts, keys, strict=True) if k not in seen and not seen.add(k)]
                if not texts:
                    continue
                lo, hi = 0, len(texts)
                values, begins = shingle_sets(texts, width)
                # Another sketch than that of the bands, for estimates: one bit of each coordinate.
                bits = mix(sketches(values ^ np.uint64(0x5851F42D4C957F2D), begins, FINE)) & np.uint64(1)
                fine = np.packbits(bits.astype(np.uint8), axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array([_set_key(values[begins[i] : begins[i + 1]]) for i in range(hi - lo)], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(values.view(np.int64), pa.int64())),
                    pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1) * (FINE // 64), pa.int32()), pa.array(fine.ravel(), pa.int64()))],
                    names=["node", "set", "fine"])

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets have ``percent`` of their union in common."""
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.select("a", "b", common.alias("c"), (F.size("sa") + F.size("sb")).alias("total")).where(
        100 * F.col("c") >= percent * (F.col("total") - F.col("c"))).select("a", "b")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends have different roots."""
    a = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    b = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    joined = pairs.join(a, "a", "left").join(b, "b", "left")
    return write_once(joined.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b"), "pairs-apart")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80, width: int = 5, row: str | None = None) -> DataFrame:
    """One row per row of ``df``: ``key``, ``n_shingles``, ``component_id`` (the smallest key reachable by links) and ``kept``.

    Two texts are linked if 100 times the intersection of their shingle sets is at least ``percent`` times the union. Bands are as
    many as it takes for a pair just at the threshold to share none in one of a million cases. ``kept`` is true for the row
    with the smallest key of a component. Null and blank texts have empty sets, are linked with nothing and kept.

    Rows of one key are rows of one document: all of them are kept if it is the smallest of its component. A row with a null key
    is linked with nothing and kept. An empty table gives an empty one; other columns are left out.

    ``row`` names a column of whole numbers, different in all rows and written down before. It is carried along, and each row is then judged by its own text:
    of each component, rows of a repeated key or not, the one with the smallest key and then the smallest number is kept and no other.
    """
    bands = bands_for(percent / 100)
    carried = [] if row is None else ["row"]
    given = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"), *[F.col(f"`{row}`").cast("long").alias(c) for c in carried])
    kind = given.schema["id"].dataType.simpleString()
    sketched = write_once(given.mapInArrow(
        _sketcher(width, bands, carried), f"id {kind}, node binary, n bigint, bands array<bigint>" + "".join(f", {c} bigint" for c in carried)).withColumn(
        "node", F.when(F.col("id").isNotNull(), F.col("node"))), "sketches")
    classes = sketched.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("id").alias("low"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    nodes = write_once(classes, "classes")

    placed = nodes.select("node", "n", F.explode("bands").alias("band"))
    shared = placed.groupBy("band").agg(F.count("*").alias("members"), F.min("node").alias("pivot")).where("members > 1")
    members = write_once(placed.join(shared, "band"), "buckets")
    met = members.select("node").distinct()
    of_interest = nodes.join(met, "node", "left_semi").select(F.col("low").alias("id"), "node").distinct()
    texts = given.join(of_interest.select("id").distinct(), "id", "left_semi").select("text")
    made = texts.mapInArrow(_set_maker(width), "node binary, set array<bigint>, fine array<bigint>").where(F.col("node").isNotNull())
    # One row per set: rows of one id, or ids of one text, would otherwise meet each other in every comparison.
    sets = write_once(made.groupBy("node").agg(F.first(F.struct("set", "fine")).alias("s")).select("node", "s.*"), "sets")

    near = lambda a, b: 100 * F.least(a, b) >= percent * F.greatest(a, b)  # noqa: E731  sizes too different for a link
    sizes = nodes.select(F.col("node").alias("pivot"), F.col("n").alias("pivot_n"))
    paired = write_once(members.where("node <> pivot").select("pivot", "node", "n").distinct().join(sizes, "pivot").where(
        near(F.col("n"), F.col("pivot_n"))).select(F.col("pivot").alias("a"), F.col("node").alias("b")), "pivot-pairs")
    # One pivot per member is enough where it proves a link; the pairs that this leaves apart follow.
    links = write_once(_verified(paired.groupBy("b").agg(F.min("a").alias("a")), sets, percent), "verified")
    roots = components(links)
    rest = _apart(paired, roots)
    if not rest.isEmpty():
        links = write_once(links.unionByName(_verified(rest, sets, percent)), "verified")
        roots = components(links)
    share = (1 + percent / 100) / 2  # of equal bits: those of equal coordinates and half of the others
    agreeing = math.floor(FINE * share - DEVIATIONS * math.sqrt(FINE * share * (1 - share)))
    equal = F.lit(FINE)
    for i in range(FINE // 64):
        equal = equal - F.bit_count(F.get("fine", F.lit(i)).bitwiseXOR(F.get("pfine", F.lit(i))))
    pivots, before = PIVOT_GROWTH, 0
    draw = lambda node, k: F.pmod(F.xxhash64(node), F.col("members")) < k  # noqa: E731  whether a member is a pivot
    while True:
        current = members.join(roots, "node", "left").select("band", "node", "n", "members", F.coalesce("root", "node").alias("root"))
        apart = current.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.first("members").alias("m")).where(
            (F.col("lo") != F.col("hi")) & (F.col("m") > before) & (F.col("m") > 2))
        open_ = write_once(current.join(apart.select("band"), "band", "left_semi"), "unresolved")
        if open_.isEmpty():
            break
        # A pair that shares several open buckets is formed in the first of them only.
        lists = open_.groupBy("node").agg(F.collect_list("band").alias("open"))
        listed = write_once(open_.join(lists, "node").join(sets.select("node", "fine"), "node"), "unresolved")
        pivot = listed.where(draw(F.col("node"), pivots)).select(
            "band", F.col("node").alias("p"), F.col("n").alias("pn"), F.col("root").alias("proot"), F.col("open").alias("popen"), F.col("fine").alias("pfine"), draw(F.col("node"), before).alias("old"))
        new = F.when(draw(F.col("node"), pivots), F.col("node") < F.col("p")).otherwise(True)  # two pivots meet once
        met = listed.join(pivot, "band").where(
            (F.col("root") != F.col("proot")) & ~(F.col("old") | draw(F.col("node"), before)) & near(F.col("n"), F.col("pn")) & new
            & (F.array_min(F.array_intersect("open", "popen")) == F.col("band")) & (equal >= agreeing))
        pairs = met.select(F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b"))
        fresh = write_once(_verified(pairs, sets, percent), "verified")
        if not fresh.isEmpty():
            links = links.unionByName(fresh)
            roots = components(links)
        before, pivots = pivots, pivots * PIVOT_GROWTH

    rooted = nodes.join(roots, "node", "left").select("node", "low", F.coalesce("root", "node").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    final = rooted.join(lows, "root").select("node", "root", "component_id")
    by_row = sketched.join(final, "node", "left")
    if row is not None:
        judged = write_once(by_row.select("row", "id", "node", "root", "n", "component_id"), "judged")
        first = judged.where(F.col("node").isNotNull()).groupBy("root").agg(F.min(F.struct("id", "row")).alias("first"))
        chosen = judged.join(first.select(F.col("first.row").alias("row"), F.lit(True).alias("first")), "row", "left")
        return chosen.select(
            F.col("id").alias(key), F.col("row").alias(row), F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
            (F.col("node").isNull() | F.coalesce("first", F.lit(False))).alias("kept"))
    return by_row.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        (F.col("node").isNull() | F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))).alias("kept"))
