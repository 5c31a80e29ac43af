"""Quality classifier: random-indexing word vectors, pooled per document, and a small calibrated network.

Every token has a sparse random index vector that follows from its hash. The vector of a word is the sum of the index vectors around
all its occurrences in the corpus; words share ``BUCKETS`` rows by hash, so the table has one size for any corpus and each task
sends one row per bucket to the sums. A document is the mean and the spread of its words' vectors and of the steps between them. A two-layer network in numpy is fitted
to labelled documents, and one temperature, fitted on rows the network has not seen, calibrates its probabilities.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructField, StructType

from phenolith.llm.shingles import hash_spans, mix, text_blocks
from phenolith.session import write_once

BUCKETS, SIZE, SPARSE, WINDOW = 1 << 15, 32, 4, 2
POOLED = 3 * SIZE
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 24, 40, 128, 3e-3, 1e-3
FIT_ROWS = 20_000  # labelled rows that the network is fitted on: those with the smallest hashes of their keys
_SPREAD = np.uint64(64 - 15)


def tokens(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of some texts, and the number of the text each is in.

    A token is a run of letters (or other characters outside ASCII), a run of digits (all runs are one token) or any other single
    character that isn't a space.
    """
    data = np.frombuffer(b"\n".join(t or b"" for t in texts), dtype=np.uint8)
    kind = np.zeros(256, dtype=np.int8)  # 0 space, 1 letter, 2 digit, 3 other
    kind[33:128] = 3
    kind[128:] = kind[65:91] = kind[97:123] = 1
    kind[48:58] = 2
    kinds = kind[data] if len(data) else np.zeros(0, dtype=np.int8)
    fresh = np.ones(len(kinds), dtype=bool)
    fresh[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == 3)
    starts = np.flatnonzero(fresh)
    stops = np.append(starts[1:], len(kinds))
    word = kinds[starts] != 0
    starts, stops = starts[word], stops[word]
    hashed = hash_spans(data, starts, stops)
    hashed[kinds[starts] == 2] = np.uint64(1)
    begins = np.cumsum([0] + [len(t or b"") + 1 for t in texts])
    return mix(hashed), np.searchsorted(begins, starts, side="right") - 1


def _index(hashed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and sign of the k-th entry of each token's index vector."""
    bits = hashed >> np.uint64(6 * k)
    return (bits & np.uint64(SIZE - 1)).astype(np.int64), np.where((bits >> np.uint64(5)) & np.uint64(1), 1, -1).astype(np.int32)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, counts = np.zeros(BUCKETS * SIZE, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for lo, hi, texts in text_blocks(batch.column("text")):
            hashed, owner = tokens(texts)
            bucket = (hashed >> _SPREAD).astype(np.int64)
            counts += np.bincount(bucket, minlength=BUCKETS)
            entries = [_index(hashed, k) for k in range(SPARSE)]
            for away in range(1, WINDOW + 1):
                near = np.flatnonzero(owner[away:] == owner[: len(owner) - away])
                for place, sign in entries:
                    np.add.at(table, bucket[near] * SIZE + place[near + away], sign[near + away])
                    np.add.at(table, bucket[near + away] * SIZE + place[near], sign[near])
    full = np.flatnonzero(counts)
    rows = table.reshape(BUCKETS, SIZE)[full]
    yield pa.RecordBatch.from_arrays(
        [pa.array(full, pa.int64()), pa.array(counts[full], pa.int64()), *[pa.array(rows[:, d], pa.int64()) for d in range(SIZE)]],
        names=["bucket", "n", *[f"v{d}" for d in range(SIZE)]])


def word_vectors(df: DataFrame, text: str = "text") -> np.ndarray:
    """The table of word vectors of a whole corpus, ``BUCKETS`` rows of ``SIZE``: unit length, weighted down for frequent words.

    ``BUCKETS`` sums come to the driver (8 MB), however large the corpus is. They are sums of whole numbers, the same in any order.
    """
    names = [f"v{d}" for d in range(SIZE)]
    rows = df.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(
        _gather, "bucket bigint, n bigint, " + ", ".join(f"{c} bigint" for c in names))
    sums = rows.groupBy("bucket").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names]).toPandas()
    vectors = np.zeros((BUCKETS, SIZE), dtype=np.float64)
    if len(sums):
        held, n = sums["bucket"].to_numpy(), sums["n"].to_numpy().astype(float)
        raw = sums[names].to_numpy().astype(float)
        raw /= np.maximum(np.linalg.norm(raw, axis=1, keepdims=True), 1e-9)
        vectors[held] = raw * (1e-2 / (1e-2 + n / n.sum()))[:, None]
    return vectors.astype(np.float32)


def pooled(texts: list, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the word vectors of each text, and the spread of the steps between neighbours; zeros without tokens."""
    hashed, owner = tokens(texts)
    rows = vectors[(hashed >> _SPREAD).astype(np.int64)]
    n = np.bincount(owner, minlength=len(texts))
    starts, there = np.concatenate([[0], np.cumsum(n)])[:-1], n > 0
    out = np.zeros((len(texts), POOLED))
    steps = np.zeros_like(rows)
    steps[1:] = np.where((owner[1:] == owner[:-1])[:, None], rows[1:] - rows[:-1], 0)
    if there.any():
        total = np.add.reduceat(rows, starts[there], axis=0, dtype=np.float64) / n[there, None]
        square = np.add.reduceat(rows * rows, starts[there], axis=0, dtype=np.float64) / n[there, None]
        step = np.add.reduceat(steps * steps, starts[there], axis=0, dtype=np.float64) / n[there, None]
        out[there] = np.hstack([total, np.sqrt(np.maximum(square - total**2, 0)), np.sqrt(step)])
    return out


@dataclass
class Network:
    """tanh layer and one logit, over standardised inputs; the logit is divided by the temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(np.clip((x - self.mean) / self.scale, -8, 8) @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def constant(share: float, size: int = POOLED) -> Network:
    """A network that gives every text one probability: for labels of a single class or none at all (then 0.5)."""
    p = min(max(share, 0.01), 0.99)
    return Network(np.zeros(size), np.ones(size), np.zeros((size, 1)), np.zeros(1), np.zeros(1), float(np.log(p / (1 - p))))


def fit_network(x: np.ndarray, y: np.ndarray, spare: np.ndarray, seed: int = 5) -> Network:
    """Adam on the rows that aren't ``spare``; the temperature minimises the log loss of the spare ones."""
    fit = ~spare
    if len(set(y[fit])) < 2:
        return constant(float(y.mean()) if len(y) else 0.5, x.shape[1])
    rng = np.random.default_rng(seed)
    mean, scale = x[fit].mean(0), x[fit].std(0) + 1e-6
    z, t = np.clip((x[fit] - mean) / scale, -8, 8), y[fit].astype(float)
    params = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(z))
        for at in range(0, len(z), BATCH):
            rows = order[at : at + BATCH]
            h = np.tanh(z[rows] @ params[0] + params[1])
            error = (1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -30, 30))) - t[rows]) / len(rows)
            back = np.outer(error, params[2]) * (1 - h * h)
            grads = [z[rows].T @ back + DECAY * params[0], back.sum(0), h.T @ error + DECAY * params[2], np.array([error.sum()])]
            step += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                params[i] = params[i] - RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, params[0], params[1], params[2], float(params[3][0]))
    if len(set(y[spare])) == 2:
        logit, truth = net.logit(x[spare]), y[spare].astype(float)
        loss = lambda temp: np.mean(np.logaddexp(0, logit / temp) - truth * logit / temp)
        net.temperature = float(min(np.geomspace(0.25, 8, 200), key=loss))
    return net


def document_vectors(df: DataFrame, vectors: np.ndarray, key: str = "doc_id", text: str = "text", more: list[str] | None = None) -> DataFrame:
    """``key``, the columns ``more`` and ``features`` (array of floats) of every whole text."""
    names = [key, *(more or [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in text_blocks(batch.column(text)):
                x = pooled(texts, vectors)
                features = pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1) * x.shape[1], pa.int32()), pa.array(x.ravel().astype(np.float32), pa.float32()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in names), features], names=[*names, "features"])

    given = df.select(*names, F.col(text).cast("string").alias(text))
    return given.mapInArrow(run, StructType([*(given.schema[c] for c in names), StructField("features", ArrayType(FloatType()))]))


def learnable(key: str) -> Column:
    """Rows whose crc32 of the key as text isn't divisible by 5."""
    return F.crc32(F.col(f"`{key}`").cast("string")) % 5 != 0


def fit_quality(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
                fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, Network]:
    """Word vectors of all texts of ``df`` and the network, fitted to at most ``fit_rows`` labelled rows.

    Of the rows of ``labels`` whose crc32 of the key as text isn't divisible by 5 those with the smallest hashes of their keys are taken; a
    fifth of them sets the temperature. Null labels and null keys are not learned from, a repeated key counts as often as it comes in ``labels``, and labels
    of one class or none give a network with one score for all texts. Of the rows of ``df`` with one key a label row takes the one whose text has the smallest hash.
    """
    vectors = word_vectors(df, text)
    known = labels.where(learnable(key)).select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("int").alias("y")).where("key is not null and y is not null")
    present = df.select(F.col(f"`{key}`").alias("key")).distinct()
    some = known.join(present, "key").orderBy(F.xxhash64("key"), "key", "y").limit(fit_rows)
    texts = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    wanted = write_once(some, "label-rows")  # at most fit_rows rows of a key and a number
    one = texts.join(F.broadcast(wanted.select("key").distinct()), "key", "left_semi").groupBy("key").agg(
        F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first")).select("key", F.col("first.text").alias("text"))
    chosen = one.join(F.broadcast(wanted), "key")  # a text for each of the label rows, however often its key comes in df
    rows = document_vectors(chosen, vectors, "key", "text", ["y"]).toPandas()
    if not len(rows):
        return vectors, constant(0.5)
    rows = rows.sort_values(["key", "y"], kind="stable")  # the order of fitting doesn't depend on that of tasks
    spare = np.array([zlib.crc32(b"%d" % zlib.crc32(str(k).encode())) % 5 == 0 for k in rows["key"]])
    return vectors, fit_network(np.array(rows["features"].tolist(), dtype=float), (rows["y"].to_numpy() > 0).astype(int), spare)


def with_scores(df: DataFrame, vectors: np.ndarray, net: Network, text: str = "text", score: str = "score") -> DataFrame:
    """``df`` with the score of each whole text; all columns pass through the tasks, and nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in text_blocks(batch.column(text).cast(pa.string())):
                p = pa.array(net.probability(pooled(texts, vectors)), pa.float64())
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, p], names=[*batch.schema.names, score])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(score, DoubleType())]))


def score_quality(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
                  cut: float = 0.3, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per row of ``df``: ``key``, ``held_out``, ``score`` (probability of label 1) and ``predicted`` (1 from ``cut`` on).

    The score's only input is the text. ``held_out`` marks rows that ``fit_quality`` doesn't learn from. Null and empty texts have the vector zero and get its
    score. Repeated rows get the same score each, an empty table gives an empty one, null keys are scored like others and not held out, and other columns
    are left out.
    """
    vectors, net = fit_quality(df, labels, key, text, label, fit_rows)
    given = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    scored = with_scores(given, vectors, net).drop("text")
    return scored.select(
        F.col("key").alias(key), F.coalesce(~learnable("key"), F.lit(False)).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
