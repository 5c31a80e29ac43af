"""The classifier on held-out rows, byte-level BPE against the library, packing and archives."""

import base64
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from phenolith.llm import archive, packing, prefix_bpe, quality_model

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as file:
        return prefix_bpe.Vocabulary.parse(file.read())


def test_ids_equal_the_library(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(300)
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "a" * 20_000), (-4, " \n" * 900 + "x"), (-5, "日本 don't 12 🙂\x00"), (-5, "again"), (None, "no key")], docs.schema)
    given = docs.unionByName(odd).withColumn("ids", F.lit("clash"))
    coded = prefix_bpe.decode(prefix_bpe.encode(given, PATH, public_tokenizers.PATTERN), PATH)
    got = sorted((r.doc_id or 0, list(r.ids), bytes(r.decoded)) for r in coded.collect())
    assert got == sorted((r.doc_id or 0, library.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in given.collect())
    assert prefix_bpe.encode(given.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_appends_and_edits_equal_a_new_encoding(vocabulary, library):
    rng, text = random.Random(3), "The thing isn't 123 there,  and\n\nthen éè it's over!! "
    for _ in range(60):
        e = prefix_bpe.TextEncoder(vocabulary, public_tokenizers.PATTERN, text)
        for _ in range(4):
            i = rng.randrange(len(e.text) + 1)
            e.edit(i, min(len(e.text), i + rng.choice([0, 1, 5])), rng.choice(["", " ", "'", "s", " the", "é", "\n", "x9"]))
            assert e.tokens() == library.encode_ordinary(e.text)
        e.append(rng.choice(["s", " ", "abc"]))
        assert e.tokens() == library.encode_ordinary(e.text)
    table = prefix_bpe.PrefixTable(vocabulary, b"abcdefgh" * 200)
    assert table.edit(3, 5, b"xyz") < 400
    assert table.last == prefix_bpe.PrefixTable(vocabulary, table.data).last


def test_held_out_quality(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = quality_model.score_quality(spark.read.parquet(f"{SF}/documents.parquet"), labels).join(labels, "doc_id").where("held_out").toPandas()
    good, bad = scored.score[scored.quality == 1], scored.score[scored.quality == 0]
    auc = sum((g > bad).mean() for g in good) / len(good)
    assert auc > 0.95 and ((scored.predicted == 1) == (scored.score >= 0.3)).all()


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, 9.0), (2, "", 9.0), (3, "w " * 200_000, 9.0), (3, "again", 9.0), (None, "no key", 9.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, quality int")
    for l in (labels, labels.limit(0)):
        rows = quality_model.score_quality(docs, l).collect()
        assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert quality_model.score_quality(docs.limit(0), labels).count() == 0


def test_packing_is_whole_and_fits(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice([1, 7, 300, 511, 512, 513, 4096, 4097, 20_000])) for i in range(400)] + [(3, 9), (3, 9), (None, 5), (900, None), (901, 0)]
    given = spark.createDataFrame(rows, "doc_id long, n long").withColumn("bin", F.lit("clash"))
    out = packing.pack_best_fit(given, length=F.col("n"), block=64).toPandas()
    assert out.length.sum() == sum(n or 0 for _, n in rows)
    assert (out.start == out.piece * 4096).all()
    for _, b in out.sort_values("bin_offset").groupby(["block", "bin"]):
        assert (b.length.cumsum() - b.length == b.bin_offset).all()
        assert b.capacity.nunique() == 1 and b.capacity.iloc[0] == min(c for c in packing.CAPACITIES if c >= b.length.sum())
    assert packing.pack_best_fit(given.limit(0), length=F.col("n")).count() == 0


def test_best_fit_equals_plain_search():
    rng = random.Random(9)
    for _ in range(30):
        lengths = [rng.randint(1, 100) for _ in range(60)]
        free, used, ahead, expected = [], [], sum(lengths), {}
        for i in sorted(range(60), key=lambda i: -lengths[i]):
            fit = [(f, j) for j, f in enumerate(free) if f >= lengths[i]]
            if fit:
                j = min(fit)[1]
            else:
                j = len(free)
                free.append(min((c for c in (32, 64, 128) if c >= lengths[i]), key=lambda c: (packing.cost(c) / min(c, ahead), c)))
                used.append(0)
            expected[i] = j, used[j]
            free[j] -= lengths[i]
            used[j] += lengths[i]
            ahead -= lengths[i]
        assert [p[:2] for p in packing.pack(lengths, (32, 64, 128))] == [expected[i] for i in range(60)]


PAGES = [(5, "http://a", "same"), (2, "http://b", "same"), (9, "http://c", "same"), (3, None, ""), (4, "http://d\r\nX: y", None), (7, "http://e", "é" * 70_000), (2, "http://b", "same"), (8, "u", "only")]


def test_archive_round_trip(spark, tmp_path):
    given = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("key", F.lit("clash"))
    manifest = archive.write_archive(given, str(tmp_path / "a"), roll=400, shard_bytes=2000)
    assert manifest.count() > 2
    rows = sorted((r.key, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in archive.read_archive(spark, str(tmp_path / "a")).collect())
    expected = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        least = min(p for p, _, h in PAGES if (h or "") == (html or ""))
        sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected.append((page, "response" if page == least else "revisit", None if page == least else least, len(data), sha))
    assert rows == sorted(expected, key=lambda r: (r[0], r[1]))
    again = archive.write_archive(given.repartition(3), str(tmp_path / "b"), roll=400, shard_bytes=2000)
    assert {(r.file, r.sha256) for r in manifest.collect()} == {(r.file, r.sha256) for r in again.collect()}
    kept = archive.write_archive(given, str(tmp_path / "c"), least=5)
    assert kept.count() == 1 and archive.read_archive(spark, str(tmp_path / "c")).where("record_type = 'revisit'").count() == 0


def test_empty_archive(spark, tmp_path):
    given = spark.createDataFrame([], "page_id long, url string, html string")
    assert archive.write_archive(given, str(tmp_path / "e")).count() == 0
    assert archive.read_archive(spark, str(tmp_path / "e")).count() == 0


@pytest.mark.parametrize("keys", [lambda i: i if i < 299 else 1 << 40, lambda i: -(1 << 50) if i == 0 else i, lambda i: 7, lambda i: i // 100])
def test_outlying_and_repeated_keys_leave_shards_of_one_size(spark, tmp_path, keys):
    rows = [(keys(i), f"u{i}", f"page {i} " + "x" * 300) for i in range(300)]
    given = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    manifest = archive.write_archive(given, str(tmp_path / "a"), shard_bytes=10_000).collect()
    records = [r.records for r in manifest]
    assert sum(records) == 300 and max(records) <= 30 and len(records) >= 20
    back = sorted((r.key, r.url, bytes(r.payload).decode()) for r in archive.read_archive(spark, str(tmp_path / "a")).collect())
    assert back == sorted(rows)
    assert {r.file for r in manifest} == {r.file for r in archive.write_archive(given.repartition(5), str(tmp_path / "b"), shard_bytes=10_000).collect()}


def _plain_tokens(text: str) -> list[int]:
    """Hashes of runs of letters, of numbers (all alike) and of single other characters, one token at a time."""
    found = re.findall(rb"[A-Za-z\x80-\xff]+|[0-9]+|[!-/:-@\[-`{-\x7f]", text.encode())
    return [1 if t.isdigit() else int(quality_model.tokens([t])[0][0]) for t in found]


def test_vectors_equal_plain_loops(spark):
    texts = ["The cat, the 12 cats & 7 dogs.", "a b a b a", "", None, "één woord", "x", "the cat the dog the cat 99"]
    one = int(quality_model.tokens([b"5"])[0][0])
    tokens = [[one if h == 1 else h for h in _plain_tokens(t or "")] for t in texts]
    bucket = lambda h: h >> (64 - 15)
    table, counts = {}, {}
    for row in tokens:
        for i, h in enumerate(row):
            counts[bucket(h)] = counts.get(bucket(h), 0) + 1
            for j in range(max(0, i - quality_model.WINDOW), min(len(row), i + quality_model.WINDOW + 1)):
                if j != i:
                    for k in range(quality_model.SPARSE):
                        bits = row[j] >> (6 * k)
                        vector = table.setdefault(bucket(h), [0] * quality_model.SIZE)
                        vector[bits & (quality_model.SIZE - 1)] += 1 if (bits >> 5) & 1 else -1
    total = sum(counts.values())
    want = np.zeros((quality_model.BUCKETS, quality_model.SIZE))
    for b, n in counts.items():
        raw = np.array(table.get(b, [0] * quality_model.SIZE), dtype=float)
        want[b] = raw / max(np.linalg.norm(raw), 1e-9) * (1e-2 / (1e-2 + n / total))
    got = quality_model.word_vectors(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    assert np.allclose(got, want, atol=1e-6) and len(counts) > 10
    pooled = quality_model.pooled([None if t is None else t.encode() for t in texts], got)
    for row, out in zip(tokens, pooled, strict=True):
        if not row:
            assert (out == 0).all()
            continue
        v = np.array([got[bucket(h)] for h in row], dtype=float)
        steps = [v[i] - v[i - 1] if i else v[0] * 0 for i in range(len(v))]
        plain = np.concatenate([v.mean(0), v.std(0), np.sqrt((np.array(steps) ** 2).mean(0))])
        assert np.allclose(out, plain, atol=1e-4)


def test_temperature_is_the_best_of_a_grid():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 6))
    y = (x[:, 0] + 0.8 * rng.normal(size=900) > 0).astype(int)
    spare = np.arange(900) % 3 == 0
    net = quality_model.fit_network(x, y, spare)
    logit = net.logit(x[spare])
    loss = lambda t: np.mean(np.log1p(np.exp(-np.where(y[spare] == 1, 1, -1) * logit / t)))
    assert loss(net.temperature) <= min(loss(t) for t in np.linspace(0.3, 7.5, 500)) + 1e-4
    assert abs(net.probability(x[spare]).mean() - y[spare].mean()) < 0.1
