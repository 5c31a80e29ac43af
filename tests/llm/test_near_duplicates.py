"""Near-duplicate texts and vectors against brute force, and the pipeline's stages."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from phenolith.llm import components, navigable_graph, near_duplicates, near_vectors, similarity_sketch
from phenolith.session import write_once


def smallest_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(7, 7)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = smallest_reachable({x for pair in links for x in pair}, links)
    assert all(got.get(n, n) == r for n, r in expected.items())
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    base = [[f"w{rng.randrange(400)}" for _ in range(n)] for n in (60, 60, 200, 12, 5, 4, 1)]
    rows = []
    for words in base:
        for changes in (0, 0, 1, 2, 4, 8):
            w = list(words)
            for _ in range(changes):
                w[rng.randrange(len(w))] = f"x{rng.randrange(999)}"
            rows.append(" ".join(w) if changes != 1 else "  ".join(w).upper())
    template = base[2]  # many different texts around one template: some linked, some not
    rows += [" ".join([*template[: 150 + k % 20], *[f"t{k}_{i}" for i in range(20 + k % 13)]]) for k in range(60)]
    return list(enumerate([*rows, None, "", " \n ", "é É"]))


def test_texts_equal_brute_force(spark, texts):
    for percent in (80, 85):
        given = spark.createDataFrame(texts, "doc_id long, text string").withColumn("node", F.lit("clash"))
        got = {r.doc_id: r for r in near_duplicates.near_duplicates(given, percent=percent).collect()}
        sets = {i: shingles(t) for i, t in texts}
        links = [(i, j) for i in sets for j in sets if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
        expected = smallest_reachable(sets, links)
        assert {i: r.component_id for i, r in got.items()} == expected
        assert all(r.n_shingles == len(sets[i]) and r.kept == (expected[i] == i) for i, r in got.items())


def test_text_edges(spark):
    schema = "doc_id long, text string"
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "other words"), (None, "a b c d e f"), (2, "A b\tc d e f"), (3, "y " * 30_000)]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates.near_duplicates(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(1, 1, True)] * 3 + [(None, None, True), (2, 1, False), (3, 3, True)], key=str)
    assert near_duplicates.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.9):
        common, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (int(400 * share), int(200 * (1 - share)), int(200 * (1 - share))))
        sets = [np.concatenate([common, a]), np.concatenate([common, b])]
        s = similarity_sketch.sketches(np.concatenate(sets), np.array([0, len(sets[0]), len(sets[0]) + len(sets[1])]), 500)
        true = len(common) / (len(common) + len(a) + len(b))
        assert abs((s[0] == s[1]).mean() - true) < 5 * math.sqrt(true * (1 - true) / 500)
    few = similarity_sketch.sketches(np.array([5], dtype=np.uint64), np.array([0, 1, 1]), 60)
    assert (few[0] != np.iinfo(np.uint64).max).all()


def brute_vectors(rows, threshold=0.9):
    good = {i: np.array(v, dtype=float) / np.linalg.norm(v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    links = [(i, j) for i in good for j in good if i < j and len(good[i]) == len(good[j]) and good[i] @ good[j] >= threshold]
    counts = {i: sum(i in link for link in links) for i, _ in rows}
    return counts, smallest_reachable([i for i, _ in rows], links)


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    rows = [(i, [float(x) for x in centres[i % 12] + rng.normal(size=16) * (0.05 if i % 3 else 0.9)]) for i in range(600)]
    rows += [(1000 + i, [float(x) for x in centres[0] + rng.normal(size=16) * 0.02]) for i in range(300)]  # a dense group
    rows += [(2000, rows[0][1]), (2001, None), (2002, [0.0] * 16), (2003, [float("nan")] * 16), (2004, [None] + [1.0] * 15), (2005, []), (2006, [1e30] * 16), (2007, [1e-30] * 16), (2008, [1.0, 2.0])]
    given = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("node", F.lit("clash"))
    got = {r.vec_id: r for r in near_vectors.near_vectors(given).collect()}
    counts, component = brute_vectors(rows)
    assert all(got[i].n_links <= n for i, n in counts.items())
    assert sum(r.n_links for r in got.values()) >= 0.99 * sum(counts.values())
    assert np.mean([got[i].component_id == c for i, c in component.items()]) >= 0.99
    assert got[2006].component_id == 2006 and got[2007].component_id == 2006 and got[2008].n_links == 0
    assert near_vectors.near_vectors(given.limit(0)).count() == 0


def test_graph_recall():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1500, 24)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = navigable_graph.build(x)
    best = np.argsort(-(x[:200] @ x.T), axis=1)[:, :10]
    found = graph.search(x[:200], 64)[1]
    assert np.mean([len(set(a) & set(b.tolist())) / 10 for a, b in zip(best, found, strict=True)]) > 0.9


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def test_stages_keep_the_columns_and_decide(spark, documents):
    sf, secret = "/root/testdata/sf0.001", "0123456789abcdef0123456789abcdef01"
    prose = " ".join(f"word{i} goes to place{i}." for i in range(40))
    odd = spark.createDataFrame([
        (9001, prose + f' token = "{secret}" end.', "en", "s1", 1), (9002, prose + f' token = "{secret}" end.', "en", "s2", 1), (9003, "symbols### " * 80, "en", "s3", 1),
        (9004, None, None, None, None), (9005, "", "en", "s4", 0), (None, prose.upper() + f" and password: {secret}.", "en", "s5", 1)], documents.schema)
    docs, seen = documents.unionByName(odd), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = write_once(stage(spark, docs, sf), "stage")
        seen[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == documents.columns
    assert not seen["quality rules"] & {9003, 9004, 9005} and {9001, 9002} <= seen["quality rules"]
    assert 9001 in seen["minhash near-dedup"] and 9002 not in seen["minhash near-dedup"]
    assert len(corpus_pipeline.STAGES) == 5


def test_secrets_are_masked(spark, documents):
    secret = "0123456789abcdef0123456789abcdef01"
    rows = spark.createDataFrame([(1, f"say token={secret} now", "en", "a", 1), (None, f"hex {secret}", "en", "b", 1), (2, "clean", "en", "c", 5)], documents.schema)
    out = {r.doc_id: r for r in corpus_pipeline.secrets_stage(spark, rows, "").collect()}
    assert secret not in out[1].text and secret not in out[None].text and out[2].text == "clean"
    assert out[1].n_chars == len(out[1].text)
