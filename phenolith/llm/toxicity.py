"""Toxicity by two Kneser-Ney models, one of toxic and one of ordinary texts, that share their backoff counts.

The models predict the bytes of a word, one after the other, from up to five bytes before it in the word. Each class has counts of its own for the
longest contexts, the number of its texts that a gram is in; what a class has not seen enough of is left to one distribution for both, built from the continuation counts of shorter and shorter
contexts over the whole corpus. A rare form of an expression is thus judged by the part of it that a class knows, and the rest weighs nothing. A text is scored by
the difference of both log-likelihoods by its length, each different word once, over all of it and over its most toxic stretch of words, and a logistic curve fitted on texts that gave
no counts turns the two into a probability.

Grams are whole numbers (six bytes), so tables of them are exact. The corpus gives a table that grows with it; the classes come from a bounded sample of
labelled rows. Of their grams and contexts the ``MAX_GRAMS`` most frequent are looked up in the tasks' memory. The rest stays a table: what a text has of it is
found by joins and added to the sums of its stretches, so the score is that of the whole model.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from phenolith.llm.quality_model import learnable
from phenolith.llm.shingles import mix, text_blocks
from phenolith.session import write_once

ORDER = 6
#: Discount of the shared counts, and of the counts of a class: what a single text has says nothing about its class.
DISCOUNT, CLASS_DISCOUNT = 0.75, 1.0
FIT_ROWS = 20_000  # labelled rows of each class that the models are fitted on: those with the smallest hashes of their keys
MAX_GRAMS = 400_000  # of the labelled rows' grams, and of their contexts, that tasks hold in memory; the others are joined
STRETCH = 32  # words of the stretch that is judged beside the whole text
_END, _HELD = 1, 1 << 21
_FREE = np.uint64((1 << 64) - 1)
_CONTEXT = np.uint64(1 << 62)  # marks the key of a context


def mask(k: int) -> int:
    return (1 << (8 * k)) - 1


def grams(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of some texts (bytes or None) the gram at every byte of every word and at its end, where each word begins among them, and the text of each word.

    A word is a run of letters or of bytes outside ASCII, with A-Z in lower case. A gram is the byte and the ``ORDER - 1`` before it, 0 for those before the word.
    """
    data = np.frombuffer(b"".join((t or b"") + b"\n" for t in texts), dtype=np.uint8)
    data = np.where((data >= 65) & (data <= 90), data | 32, data)
    letter = (data >= 128) | ((data >= 97) & (data <= 122))
    end = np.zeros(len(data), dtype=bool)
    end[1:] = letter[:-1] & ~letter[1:]
    kept = np.flatnonzero(letter | end)
    s = np.where(end[kept], _END, data[kept]).astype(np.uint64)
    ends = np.flatnonzero(end[kept])
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else np.zeros(0, dtype=np.int64)
    offset = np.arange(len(s)) - np.repeat(starts, ends - starts + 1)
    out = s.copy()
    for k in range(1, ORDER):
        out[k:] |= np.where(offset[k:] >= k, s[:-k], 0).astype(np.uint64) << np.uint64(8 * k)
    begins = np.cumsum([0] + [len(t or b"") + 1 for t in texts])
    return out, starts, np.searchsorted(begins, kept[ends], side="right") - 1


def _batch(held: list[np.ndarray], toxic: list[np.ndarray], ordinary: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    g, t, o = np.concatenate(held), np.concatenate(toxic), np.concatenate(ordinary)
    g, inverse = np.unique(g, return_inverse=True)
    return g, np.bincount(inverse, t, len(g)), np.bincount(inverse, o, len(g))


def _counted(labelled: bool):
    """Distinct grams of a task's texts with the number of toxic and of ordinary ones that they are in (0 without labels)."""

    def out(g: np.ndarray, t: np.ndarray, o: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(t.astype(np.int64)), pa.array(o.astype(np.int64))], names=["gram", "toxic", "ordinary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = ([], [], []), 0
        for batch in batches:
            labels = batch.column("y").to_numpy() if labelled else None
            for lo, hi, texts in text_blocks(batch.column("text")):
                g, starts, owner = grams(texts)
                if labelled:  # a text counts once for a gram
                    text_of = np.repeat(owner, np.diff(np.append(starts, len(g))))
                    order = np.lexsort((g, text_of))
                    g, text_of = g[order], text_of[order]
                    fresh = np.ones(len(g), dtype=bool)
                    fresh[1:] = (g[1:] != g[:-1]) | (text_of[1:] != text_of[:-1])
                    y = labels[lo:hi][text_of[fresh]]
                    g, inverse = np.unique(g[fresh], return_inverse=True)
                    counts = np.bincount(inverse, y, len(g)), np.bincount(inverse, 1 - y, len(g))
                else:
                    g = np.unique(g)
                    counts = (np.zeros(len(g)),) * 2
                for some, more in zip(held, (g, *counts), strict=True):
                    some.append(more)
                rows += len(g)
                if rows > _HELD:
                    merged = _batch(*held)
                    if len(merged[0]) > _HELD // 2:
                        yield out(*merged)
                        held, rows = ([], [], []), 0
                    else:
                        held, rows = tuple([m] for m in merged), len(merged[0])
        if rows:
            yield out(*_batch(*held))

    return run


class Lookup:
    """Numbers by key in an open hash table of numpy arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(len(keys), 1)))) + 2)
        self.keys, self.values = np.full(1 << self.bits, _FREE), np.zeros(1 << self.bits, dtype=np.float32)
        waiting, step = np.arange(len(keys)), 0
        while len(waiting):
            slot = self._slot(keys[waiting], step)
            free = np.flatnonzero(self.keys[slot] == _FREE)
            first = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[first]], self.values[slot[first]] = keys[waiting[first]], values[waiting[first]]
            stays = np.ones(len(waiting), dtype=bool)
            stays[first] = False
            waiting, step = waiting[stays], step + 1
        self.steps = step

    def _slot(self, keys: np.ndarray, step: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64) + step) & ((1 << self.bits) - 1)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the keys (0 without one) and whether there was one."""
        out, there = np.zeros(len(keys), dtype=np.float32), np.zeros(len(keys), dtype=bool)
        waiting = np.arange(len(keys))
        for step in range(self.steps):
            slot = self._slot(keys[waiting], step)
            held = self.keys[slot]
            hit = held == keys[waiting]
            out[waiting[hit]], there[waiting[hit]] = self.values[slot[hit]], True
            waiting = waiting[~hit & (held != _FREE)]
            if not len(waiting):
                break
        return out, there


class Bits:
    """Marks of a set of keys in one array of bits: a key of the set has its mark, and about one in sixteen of the others, more if the largest array is small for the set."""

    def __init__(self, log_bits: int, words: np.ndarray):
        self.log_bits, self.words = log_bits, words

    @staticmethod
    def place(keys: np.ndarray, log_bits: int) -> np.ndarray:
        return (mix(keys) >> np.uint64(64 - log_bits)).astype(np.int64)

    @classmethod
    def of(cls, keys: DataFrame, count: int) -> "Bits":
        """Of the column ``key``; 2**21 words at most come to the driver."""
        log_bits = int(np.clip(np.ceil(np.log2(16 * max(count, 1))), 10, 27))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = np.unique(cls.place(batch.column("key").to_numpy().astype(np.uint64), log_bits))
                if len(at):
                    word, first = np.unique(at >> 6, return_index=True)
                    bits = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first)
                    yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bits.view(np.int64))], names=["word", "bits"])

        found = keys.select("key").mapInArrow(run, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
        words = np.zeros((1 << log_bits) >> 6, dtype=np.uint64)
        words[found["word"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.int64).view(np.uint64)
        return cls(log_bits, words)

    def marked(self, keys: np.ndarray) -> np.ndarray:
        at = self.place(keys, self.log_bits)
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


@dataclass
class Model:
    """What each gram, or a context followed by anything it isn't known with, adds to the difference of both log-likelihoods."""

    table: Lookup
    weights: np.ndarray  # of the two scores and of 1
    rest: DataFrame | None = None  # key and value of what isn't in the table; None if all is
    marks: Bits | None = None  # of the keys of the rest

    def per_gram(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The value of each gram by the table, and where it lacks: 0 if it is known, 1 if the rest may have the gram, 2 if it may have the gram or its context."""
        value, there = self.table.get(g)
        lacks = np.zeros(len(g), dtype=np.int8)
        rest = np.flatnonzero(~there)
        context = (g[rest] >> np.uint64(8)) | _CONTEXT
        value[rest], known = self.table.get(context)
        if self.marks is not None:
            beyond = ~known & self.marks.marked(context)
            lacks[rest] = np.where(beyond, 2, self.marks.marked(g[rest]))
        return value, lacks

    def parts(self, texts: list) -> dict | None:
        """What the scores of some texts are made of; None if they have no word."""
        g, starts, owner = grams(texts)
        if not len(starts):
            return None
        value, lacks = self.per_gram(g)
        words = np.add.reduceat(value.astype(np.float64), starts)
        # A word that comes again in its text adds nothing.
        word = np.add.reduceat(mix(g), starts)
        order = np.lexsort((np.arange(len(word)), word, owner))
        again = np.zeros(len(word), dtype=bool)
        again[order[1:]] = (word[order[1:]] == word[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
        words[again] = 0
        n = np.bincount(owner, minlength=len(texts))
        there = n > 0
        first = (np.cumsum(n) - n)[there]
        total, different = np.zeros(len(texts)), np.bincount(owner[~again], minlength=len(texts))
        total[there] = np.add.reduceat(words, first)
        # Stretches are two half ones side by side; a text of fewer words is one stretch.
        place = np.arange(len(words)) - np.repeat(first, n[there])
        begins = np.flatnonzero(place % (STRETCH // 2) == 0)
        at = np.flatnonzero(lacks)
        of = np.searchsorted(starts, at, side="right") - 1
        at, of = at[~again[of]], of[~again[of]]
        return {"n": n, "total": total, "different": different, "half": np.add.reduceat(words, begins), "text_of": owner[begins], "size": np.diff(np.append(begins, len(words))),
                "open_gram": g[at], "open_value": value[at], "open_context": lacks[at] == 2, "open_text": owner[of], "open_half": place[of] // (STRETCH // 2)}

    @staticmethod
    def judged(parts: dict) -> np.ndarray:
        """Per text the difference a word, over the whole text and over its highest stretch of ``STRETCH`` words or more, and its words."""
        n, text_of = parts["n"], parts["text_of"]
        out, there = np.zeros((len(n), 3)), n > 0
        out[there, 0] = parts["total"][there] / parts["different"][there]
        pair, pair_size = parts["half"].copy(), parts["size"].copy()
        joined = np.flatnonzero(text_of[1:] == text_of[:-1])
        pair[joined] += parts["half"][joined + 1]
        pair_size[joined] += parts["size"][joined + 1]
        best = np.full(len(n), -np.inf)
        np.maximum.at(best, text_of, pair / np.maximum(pair_size, STRETCH // 2))
        out[there, 1], out[:, 2] = best[there], n
        return out

    def scores(self, texts: list) -> np.ndarray:
        """``judged`` by what the table knows."""
        parts = self.parts(texts)
        return np.zeros((len(texts), 3)) if parts is None else self.judged(parts)

    def probability(self, scores: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(scores) @ self.weights, -30, 30)))

    @staticmethod
    def features(scores: np.ndarray) -> np.ndarray:
        return np.column_stack([scores[:, 0] * 10, scores[:, 1], np.log1p(scores[:, 2]), np.ones(len(scores))])


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, decay: float = 1e-3) -> np.ndarray:
    """Weighted logistic regression by Newton steps; its constant alone where there is one class or none."""
    w = np.zeros(x.shape[1])
    if len(set(y)) < 2:
        w[-1] = 0.0 if not len(y) else 3.0 if y[0] else -3.0
        return w
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + decay * np.eye(len(w)), x.T @ (weight * (y - p)) - decay * w)
        w = w + step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def sample_labels(labels: DataFrame, key: str, label: str, fit_rows: int) -> tuple[DataFrame, dict[int, int]]:
    """``key, y`` of at most ``fit_rows`` learnable keys of each class, and how many keys each class has. A key with both labels is toxic."""
    known = labels.where(learnable(key)).select(F.col(f"`{key}`").alias("key"), (F.col(f"`{label}`").cast("int") > 0).cast("int").alias("y")).where("key is not null and y is not null")
    once = known.groupBy("key").agg(F.max("y").alias("y"))
    of = lambda y: once.where(F.col("y") == y).orderBy(F.xxhash64("key"), "key").limit(fit_rows)
    totals = {r["y"]: r["n"] for r in once.groupBy("y").agg(F.count("*").alias("n")).collect()}
    return write_once(of(0).unionByName(of(1)), "label-rows"), totals


def gram_table(texts: DataFrame, chosen: DataFrame) -> DataFrame:
    """``gram, toxic, ordinary``: every gram of ``texts`` with the number of the ``chosen`` labelled ones (columns text, y) of each class that it is in."""
    schema = "gram bigint, toxic bigint, ordinary bigint"
    parts = texts.mapInArrow(_counted(False), schema).unionByName(chosen.select("text", "y").mapInArrow(_counted(True), schema))
    return parts.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def _continuations(types: DataFrame, needed: DataFrame):
    """For the endings ``needed`` (k, ending): in how many ways each is continued to the left, and the same of its context with the number of its endings."""
    longer = types.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col("gram").bitwiseAND(F.lit(mask(k + 1))).alias("longer")) for k in range(1, ORDER)])).alias("e")).select("e.*").distinct()
    ending = F.expr("case " + " ".join(f"when k = {k} then longer & {mask(k)}L" for k in range(1, ORDER)) + " end")
    ways = write_once(longer.groupBy("k", ending.alias("ending")).agg(F.count("*").alias("ways")), "continuations")
    contexts = ways.groupBy("k", F.shiftright("ending", 8).alias("context")).agg(F.sum("ways").alias("total"), F.count("*").alias("kinds"))
    found = needed.join(ways, ["k", "ending"]).withColumn("context", F.shiftright("ending", 8)).join(contexts, ["k", "context"])
    return write_once(found.select("k", "ending", "ways", "total", "kinds"), "endings")


def gram_values(table: DataFrame) -> DataFrame:
    """``key, n, value`` of every gram of the labelled rows of a gram table and of every context of them: how often it is there and what it adds."""
    own = table.where("toxic + ordinary > 0").withColumn("context", F.shiftright("gram", 8))
    contexts = write_once(own.groupBy("context").agg(
        F.sum("toxic").alias("t_total"), F.sum("ordinary").alias("o_total"), F.count_if(F.col("toxic") > 0).alias("t_kinds"), F.count_if(F.col("ordinary") > 0).alias("o_kinds")), "contexts")
    needed = own.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col("gram").bitwiseAND(F.lit(mask(k))).alias("ending")) for k in range(1, ORDER)])).alias("e")).select("e.*").distinct()
    endings = _continuations(table.select("gram"), needed)
    # The shared distribution from the shortest ending to the longest; an ending that very many grams have is one row.
    shared = None
    for k in range(1, ORDER):
        level = endings.where(F.col("k") == k).withColumn("shorter", F.col("ending").bitwiseAND(F.lit(mask(k - 1))))
        level = level.withColumn("p", F.lit(1 / 256)) if shared is None else level.join(shared.withColumnRenamed("ending", "shorter"), "shorter")
        shared = level.selectExpr("ending", f"(greatest(ways - {DISCOUNT}D, 0D) + {DISCOUNT}D * kinds * p) / total as p")
    own = own.withColumn("ending", F.col("gram").bitwiseAND(F.lit(mask(ORDER - 1))))
    log = lambda count, c: f"""ln(case when {c}_total > 0
        then (greatest({count} - {CLASS_DISCOUNT}D, 0D) + {CLASS_DISCOUNT}D * {c}_kinds * p) / greatest({c}_total, 1) else p end)"""  # noqa: E731
    found = own.join(contexts, "context").join(shared, "ending").selectExpr("gram as key", "toxic + ordinary as n", f"{log('toxic', 't')} - {log('ordinary', 'o')} as value")
    # A context followed by what no class has seen after it: the shared part is the same on both sides.
    weight = lambda c: f"case when {c}_total > 0 then ln(greatest({CLASS_DISCOUNT}D * {c}_kinds, 1e-9D) / greatest({c}_total, 1)) else 0D end"
    kept = contexts.selectExpr(f"context | {int(_CONTEXT)}L as key", "t_total + o_total as n", f"{weight('t')} - {weight('o')} as value")
    return write_once(found.unionByName(kept), "gram-values")


def divided_table(values: DataFrame, max_grams: int = MAX_GRAMS) -> tuple[Lookup, DataFrame | None]:
    """The ``max_grams`` most frequent grams and contexts in memory, and the other ``values`` as a table; None if there are none."""
    keys, found, rest = [], [], None
    for kind in (values.where(F.col("key") < F.lit(int(_CONTEXT))), values.where(F.col("key") >= F.lit(int(_CONTEXT)))):
        top = kind.orderBy(F.desc("n"), "key").limit(max_grams).toPandas()
        keys.append(top["key"].to_numpy(dtype=np.int64).astype(np.uint64))
        found.append(top["value"].to_numpy(dtype=float))
        if len(top) == max_grams:  # keys are distinct, so what comes after the last one is the rest
            n, key = (int(top[c].iloc[-1]) for c in ("n", "key")) if len(top) else (1 << 62, -1)
            more = kind.where((F.col("n") < n) | ((F.col("n") == n) & (F.col("key") > key))).select("key", F.col("value").cast("float").alias("value"))
            rest = more if rest is None else rest.unionByName(more)
    return Lookup(np.concatenate(keys), np.concatenate(found)), rest


def build_table(table: DataFrame, max_grams: int = MAX_GRAMS) -> Lookup:
    """What tasks hold of the model of a gram table: ``max_grams`` grams and as many contexts."""
    return divided_table(gram_values(table), max_grams)[0]


def build_model(table: DataFrame, max_grams: int = MAX_GRAMS) -> Model:
    """The whole model of a gram table, without its curve: ``max_grams`` bounds what comes to the driver and to the tasks, not what counts."""
    held, rest = divided_table(gram_values(table), max_grams)
    beyond = rest.count() if rest is not None else 0
    return Model(held, np.zeros(4), rest, Bits.of(rest, beyond)) if beyond else Model(held, np.zeros(4))


def _spare(key) -> bool:
    return zlib.crc32(b"%d" % zlib.crc32(str(key).encode())) % 5 == 0


def fit_toxicity(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", fit_rows: int = FIT_ROWS,
                 max_grams: int = MAX_GRAMS) -> Model:
    """The models of ``df`` and the curve, fitted to at most ``fit_rows`` labelled keys of each class.

    Of the keys of ``labels`` whose crc32 as text isn't divisible by 5 those with the smallest hashes are taken; a fifth of them gives no counts and fits the curve,
    with weights that restore how frequent the classes are. Of several rows of ``df`` with one key the one whose text has the smallest hash is taken. Labels of one
    class or none give one score for all texts.
    """
    given = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    wanted, totals = sample_labels(labels, key, label, fit_rows)
    one = given.join(F.broadcast(wanted), "key").groupBy("key").agg(  # at most 2 * fit_rows keys
        F.first("y").alias("y"), F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first"))
    spare = F.crc32(F.crc32(F.col("key").cast("string")).cast("string")) % 5 == 0
    chosen = write_once(one.select("key", "y", F.col("first.text").alias("text"), spare.alias("spare")), "label-texts")
    table = write_once(gram_table(given.select("text"), chosen.where(~F.col("spare"))), "gram-table")
    model = build_model(table, max_grams)
    kept = _scored(chosen.where("spare").select("key", "y", "text"), model).toPandas().sort_values("key")
    y = kept["y"].to_numpy().astype(float)
    share = {c: max((kept["y"] == c).sum(), 1) for c in (0, 1)}
    weight = np.array([totals[int(c)] / share[int(c)] for c in y])
    model.weights = fit_curve(model.features(kept[["whole", "stretch", "words"]].to_numpy(dtype=float)), y, weight / weight.mean() if len(y) else weight)
    return model


_SCORES = [StructField("whole", DoubleType()), StructField("stretch", DoubleType()), StructField("words", LongType()), StructField("score", DoubleType())]


def _scored(df: DataFrame, model: Model) -> DataFrame:
    """All columns of ``df`` but ``text``, and ``whole``, ``stretch``, ``words`` and ``score`` of each whole text."""
    if model.rest is not None:
        return _scored_with_rest(df, model)
    others = [c for c in df.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in text_blocks(batch.column("text")):
                s = model.scores(texts)
                yield _score_batch([batch.column(c).slice(lo, hi - lo) for c in others], others, s, model)

    return df.mapInArrow(run, StructType([*(df.schema[c] for c in others), *_SCORES]))


def _score_batch(columns: list, names: list[str], s: np.ndarray, model: Model) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        *columns, pa.array(s[:, 0]), pa.array(s[:, 1]), pa.array(s[:, 2].astype(np.int64)), pa.array(model.probability(s))], names=[*names, *(f.name for f in _SCORES)])


def _lists(values: np.ndarray, text_of: np.ndarray, n: int) -> pa.Array:
    """One list per text of the values that lie in order of their texts."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(text_of, np.arange(n + 1)).astype(np.int32)), pa.array(values))


_PARTS = {"total": DoubleType(), "n": LongType(), "different": LongType(), "half": ArrayType(DoubleType()), "size": ArrayType(LongType()),
          "open_gram": ArrayType(LongType()), "open_value": ArrayType(DoubleType()), "open_context": ArrayType(IntegerType()), "open_half": ArrayType(LongType())}


def _scored_with_rest(df: DataFrame, model: Model) -> DataFrame:
    """``_scored`` where a part of the model is a table. Texts are read once and become the sums of their half stretches with the grams that the rest may have; those meet the
    rest in two joins, and each half gets what it lacks. Only sums and such grams are moved, never the texts."""
    others = [c for c in df.columns if c != "text"]
    bare = replace(model, rest=None)

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in text_blocks(batch.column("text")):
                n, none = hi - lo, np.zeros(0, dtype=np.int64)
                p = bare.parts(texts) or {"total": np.zeros(n), "n": np.zeros(n, np.int64), "different": np.zeros(n, np.int64), "half": np.zeros(0), "size": none, "text_of": none,
                                          "open_gram": none, "open_value": np.zeros(0), "open_context": none, "open_half": none, "open_text": none}
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(lo, n) for c in others), pa.array(p["total"]), pa.array(p["n"].astype(np.int64)), pa.array(p["different"].astype(np.int64)),
                    _lists(p["half"], p["text_of"], n), _lists(p["size"].astype(np.int64), p["text_of"], n), _lists(p["open_gram"].astype(np.int64), p["open_text"], n),
                    _lists(p["open_value"].astype(np.float64), p["open_text"], n), _lists(p["open_context"].astype(np.int32), p["open_text"], n),
                    _lists(p["open_half"].astype(np.int64), p["open_text"], n)], names=[*others, *_PARTS])

    schema = StructType([*(df.schema[c] for c in others), *(StructField(c, t) for c, t in _PARTS.items())])
    held = write_once(df.mapInArrow(take, schema).withColumn("_row", F.monotonically_increasing_id()), "text-parts")  # written, so that a row keeps its number
    asked = held.select("_row", F.explode(F.arrays_zip("open_gram", "open_value", "open_context", "open_half")).alias("o")).select(
        "_row", "o.*", F.shiftright("o.open_gram", 8).bitwiseOR(F.lit(int(_CONTEXT))).alias("_context"))
    grams_of, contexts_of = model.rest.where(F.col("key") < F.lit(int(_CONTEXT))), model.rest.where(F.col("key") >= F.lit(int(_CONTEXT)))
    found = asked.join(grams_of.select(F.col("key").alias("open_gram"), F.col("value").alias("_own")), "open_gram", "left").join(
        contexts_of.select(F.col("key").alias("_context"), F.col("value").alias("_other")), "_context", "left")
    more = F.coalesce(F.col("_own") - F.col("open_value"), F.when(F.col("open_context") == 1, F.col("_other").cast("double")), F.lit(0.0))
    lacking = found.groupBy("_row", "open_half").agg(F.sum(more).alias("more")).groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("open_half", "more"))).alias("_more"))
    ready = held.drop("open_gram", "open_value", "open_context", "open_half").join(lacking, "_row", "left").select(
        *others, "total", "n", "different", "half", "size", F.col("_more.open_half").alias("more_half"), F.col("_more.more").alias("more"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            p = {c: batch.column(c).to_numpy(zero_copy_only=False).copy() for c in ("total", "n", "different")}
            flat = lambda c: batch.column(c).flatten().to_numpy(zero_copy_only=False).copy()
            lengths = lambda c: batch.column(c).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            halves = lengths("half")
            p |= {"half": flat("half"), "size": flat("size"), "text_of": np.repeat(np.arange(len(halves)), halves)}
            text = np.repeat(np.arange(len(halves)), lengths("more"))
            np.add.at(p["half"], (np.cumsum(halves) - halves)[text] + flat("more_half"), flat("more"))
            np.add.at(p["total"], text, flat("more"))
            yield _score_batch([batch.column(c) for c in others], others, bare.judged(p), bare)

    return ready.mapInArrow(judge, StructType([*(df.schema[c] for c in others), *_SCORES]))


def score_toxicity(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", cut: float = 0.5,
                   fit_rows: int = FIT_ROWS, max_grams: int = MAX_GRAMS) -> DataFrame:
    """One row per row of ``df``: ``key``, ``held_out``, ``score`` (probability of label 1) and ``predicted`` (1 from ``cut`` on).

    The score's only input is the text. ``held_out`` marks rows that ``fit_toxicity`` doesn't learn from. Null and empty texts and those without a letter have
    no words and get the curve's score for none. Repeated rows get the same score each, an empty table gives an empty one, null keys are scored like others and not held
    out, null labels are not learned from, and other columns are left out.
    """
    model = fit_toxicity(df, labels, key, text, label, fit_rows, max_grams)
    given = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return _scored(given, model).select(
        F.col("key").alias(key), F.coalesce(~learnable("key"), F.lit(False)).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
