"""Spelling variants, hard negatives and toxicity against plain Python, on planted rows and odd tables."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from phenolith.llm import hard_negatives as H
from phenolith.llm import spelling as S
from phenolith.llm import toxicity as T

# --- spelling ------------------------------------------------------------------------------------


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words: dict, factor: int = 10) -> set:
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        if others:
            first = min(others, key=lambda x: (-words[x], x))
            if words[first] >= factor * words[w]:
                form[w] = first

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, root(w), words[w], form.get(w), words.get(form.get(w)), len(near[w])) for w in words}


@pytest.mark.parametrize("group_words", [20_000, 4])
def test_variants_equal_plain_search(spark, group_words):
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))): rng.randint(1, 500) for _ in range(500)}
    words |= {"x" * 2000: 5, "x" * 2001: 70, "x" * 1999 + "y": 800}
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert {tuple(r) for r in S.spelling_variants(df, group_words=group_words).collect()} == plain_variants(words)


def test_variants_of_odd_tables(spark):
    schema = "word string, n bigint, root string, near string"
    empty = spark.createDataFrame([], schema)
    assert S.spelling_variants(empty).collect() == []
    rows = [("abcdefg", 30, "r", None), ("abcdefg", 20, "r", None), ("abcdefh", 5, None, "x"), (None, 3, None, None), ("", 9, None, None), ("zzz", None, None, None)]
    got = {tuple(r) for r in S.spelling_variants(spark.createDataFrame(rows, schema)).collect()}
    assert got == {("abcdefg", "abcdefg", 50, None, None, 1), ("abcdefh", "abcdefg", 5, "abcdefg", 50, 1)}


def test_ties_go_to_the_smaller_word(spark):
    rows = [("abcdefg", 1), ("abcdefz", 10), ("abcdefb", 10), ("abcdefgé", 10)]
    got = {r["word"]: r for r in S.spelling_variants(spark.createDataFrame(rows, "word string, n bigint")).collect()}
    assert (got["abcdefg"]["form"], got["abcdefg"]["n_near"], got["abcdefb"]["form"]) == ("abcdefb", 3, None)


def test_words_of_texts(spark):
    rows = [(1, "Strasse STRASSE straße! Ärzteräte Ärzteräte kurz kurz", "a"), (2, None, "b"), (None, "", "c"), (4, "x" * 300_000 + " strasse", "d")]
    got = {tuple(r) for r in S.count_words(spark.createDataFrame(rows, "doc_id bigint, text string, word string")).collect()}
    assert got == {("strasse", 3), ("Ärzteräte", 2)}


# --- hard negatives ------------------------------------------------------------------------------


def plain_negatives(rows: list, every: int, positives: int = 5, negatives: int = 3) -> set:
    usable = [(k, y, v) for k, y, v in rows if k is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for k, y, v in usable:
        if k % every:
            continue
        score = lambda w: int(sum(a * b for a, b in zip(v, w)))  # noqa: E731,B023,B905
        same = sorted({(-score(w), i) for i, z, w in usable if z == y and i != k})[:positives]
        others = sorted({(-score(w), i) for i, z, w in usable if z != y})
        for minus, positive in same:
            inside = [(s, i) for s, i in others if 50 * -minus <= 100 * -s <= 95 * -minus][:negatives]
            out |= {(k, positive, rank, i, -minus, -s) for rank, (s, i) in enumerate(inside, 1)}
    return out


@pytest.mark.parametrize("wave", [2048, 7])
def test_negatives_equal_plain_search(spark, wave, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(4)
    centres = rng.integers(-40, 40, (6, 8))
    rows = [(i, int(i % 3), [float(x) for x in centres[i % 6] + rng.integers(-6, 6, 8)]) for i in range(400)]
    rows += [(401, 1, rows[10][2]), (402, 1, rows[10][2]), (10, 1, rows[10][2]), (10, 1, rows[10][2]), (20, 0, rows[11][2])]  # ties, a repeated row, an id with two vectors
    rows += [(None, 1, [1.0] * 8), (500, None, [1.0] * 8), (510, 2, None), (520, 2, [1.0, None] * 4), (530, 2, [float("nan")] * 8), (540, 0, [float("inf")] * 8)]
    rows += [(550, 0, []), (551, 1, [30.0, 2.0]), (560, 2, [0.0] * 8), (570, 0, [5.0] * 11)]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>").repartition(5)
    got = [tuple(r) for r in H.mine_hard_negatives(df, anchors="_key % 10 = 0", wave=wave).collect()]
    assert set(got) == plain_negatives(rows, 10) and len(got) == len(set(got))


def test_bounds_spare_scores():
    """Anchors close together: the tree's bounds leave out most candidates, and none that matter."""
    rng = np.random.default_rng(5)
    anchors = np.array([100.0, 0, 0, 0]) + rng.integers(-1, 2, (50, 4))
    x = rng.integers(-200, 200, (2000, 4)).astype(float)
    tree = H.spanning_tree(0, np.arange(50), np.arange(50), anchors)
    norms = np.sqrt((x * x).sum(1))
    asked = 0
    for i, at, score in H._walk(tree, x, norms, lambda i, low, high: high >= 15_000):
        want = np.flatnonzero(x @ tree.vectors[i] >= 15_000)
        assert set(want) <= set(at) and (score == x[at] @ tree.vectors[i]).all()
        asked += len(at)
    assert asked < 0.5 * 50 * len(x)


def test_negatives_of_odd_tables(spark):
    schema = "vec_id bigint, label int, embedding array<float>, anchor string, key string, rank int"
    assert H.mine_hard_negatives(spark.createDataFrame([], schema)).collect() == []
    alone = spark.createDataFrame([(0, 1, [1.0, 2.0], "x", "y", 3), (1, 2, [1.0, 1.0], None, None, None)], schema)
    assert H.mine_hard_negatives(alone).collect() == []
    three = spark.createDataFrame([(0, 1, [4.0, 0.0], "x", "y", 3), (1, 1, [5.0, 0.0], None, None, None), (2, 2, [4.0, 9.0], None, None, None)], schema)
    assert [tuple(r) for r in H.mine_hard_negatives(three).collect()] == [(0, 1, 1, 2, 20, 16)]


# --- toxicity ------------------------------------------------------------------------------------


def plain_model(every: list, toxic: list, ordinary: list) -> dict:
    """What each gram, and each context, adds, by the definitions one gram at a time."""

    def of(text):
        for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
            s = word.encode() + b"\1"
            for i in range(len(s)):
                yield (b"\0" * T.ORDER + s[: i + 1])[-T.ORDER :]

    types = {g for t in every for g in of(t)}
    longer = {k: {g[-k - 1 :] for g in types} for k in range(1, T.ORDER)}
    ways = {k: Counter(e[1:] for e in longer[k]) for k in longer}
    total, kinds = defaultdict(int), Counter()
    for k in ways:
        for e, n in ways[k].items():
            total[k, e[:-1]] += n
            kinds[k, e[:-1]] += 1

    def shared(e):
        k = len(e)
        if not k:
            return 1 / 256
        return (max(ways[k][e] - T.DISCOUNT, 0) + T.DISCOUNT * kinds[k, e[:-1]] * shared(e[1:])) / total[k, e[:-1]]

    counts = [Counter(g for t in texts for g in set(of(t))) for texts in (toxic, ordinary)]

    def p(c, g):
        n = sum(v for x, v in c.items() if x[:-1] == g[:-1])
        m = sum(1 for x in c if x[:-1] == g[:-1])
        return (max(c[g] - T.CLASS_DISCOUNT, 0) + T.CLASS_DISCOUNT * m * shared(g[1:])) / n if n else shared(g[1:])

    return {g: math.log(p(counts[0], g)) - math.log(p(counts[1], g)) for g in counts[0] | counts[1]}


def test_model_equals_the_definitions(spark):
    toxic, ordinary, more = ["you Moron moron", "morons and clowns"], ["you and mornings", "clear and calm"], ["clowning around", "Mörser"]
    texts = spark.createDataFrame([(t,) for t in toxic + ordinary + more + [None, ""]], "text string")
    chosen = spark.createDataFrame([(t, 1) for t in toxic] + [(t, 0) for t in ordinary], "text string, y int")
    table = T.build_table(T.gram_table(texts, chosen))
    want = plain_model(toxic + ordinary + more, toxic, ordinary)
    keys = np.array([int.from_bytes(g, "big") for g in want], dtype=np.uint64)
    got, there = table.get(keys)
    assert there.all() and np.allclose(got, list(want.values()), atol=1e-5)
    rare = T.Model(table, np.zeros(4)).scores([b"moronic", b"morning", b"", None, b"12 !"])
    assert rare[0, 0] > max(0, rare[1, 0]) and (rare[2:] == 0).all()


def test_stretches_and_lookup():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 48, 5000).astype(np.uint64))
    table = T.Lookup(keys, np.arange(len(keys)))
    got, there = table.get(np.append(keys, keys + np.uint64(1 << 50)))
    assert (got[: len(keys)] == np.arange(len(keys))).all() and there[: len(keys)].all() and not there[len(keys) :].any()
    g = T.grams([b"bad"])[0]
    model = T.Model(T.Lookup(g, np.ones(len(g))), np.zeros(4))
    dull = b" zz" * 500
    whole = model.scores([b"bad" + dull, dull + b" bad", dull])
    assert np.allclose(whole[:, 0], [2, 2, 0]) and (whole[:2, 1] > 0.1).all() and whole[2, 1] == 0


def test_toxic_documents_are_found_and_odd_rows_scored(spark):
    rng = random.Random(2)
    dull = ["".join(rng.choice(["ba", "de", "lo", "ri", "tu"]) for _ in range(rng.randint(1, 3))) for _ in range(200)]
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(dull) for _ in range(rng.randint(5, 120))]
        if i % 4 == 0:
            words += ["krunk" + rng.choice(["", "el", "ish", "ox", "ov"]) for _ in range(1 + len(words) // 50)]
            rng.shuffle(words)
        rows.append((i, " ".join(words), "x"))
        if i < 450:
            labels.append((i, int(i % 4 == 0), 9))
    rows += [(1000, None, "x"), (1001, "", "x"), (None, "krunk krunkish", "x"), (4, rows[4][1], "x")]
    labels += [(None, 1, 9), (3, None, 9), (8, 1, 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    got = T.score_toxicity(df, spark.createDataFrame(labels, "doc_id bigint, toxic int, text int")).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    wrong = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 600 and r["predicted"] != (r["doc_id"] % 4 == 0)]
    assert len(wrong) <= 6
    assert {r["held_out"] for r in got if r["doc_id"] is None} == {False}


def test_grams_beyond_the_tasks_memory_count_too(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["ba", "de", "lo", "ri", "tu", "n", "s"]) for _ in range(rng.randint(1, 4)))
    rows = [(i, " ".join([word() for _ in range(rng.randint(1, 90))] + ["krunk" + word()] * (i % 4 == 0))) for i in range(300)]
    rows += [(400, None), (401, ""), (402, "12 !"), (None, "krunk lori lori"), (7, "krunkba de")]
    df, labels = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id bigint, toxic int")
    scored = [sorted((r["doc_id"] is None, r["doc_id"], r["score"]) for r in T.score_toxicity(df, labels, max_grams=m).collect()) for m in (T.MAX_GRAMS, 40, 0)]
    for some in scored[1:]:
        assert [r[:2] for r in some] == [r[:2] for r in scored[0]]
        assert np.allclose([r[2] for r in some], [r[2] for r in scored[0]], atol=1e-9)


def test_toxicity_without_labels_or_rows(spark):
    schema = "doc_id bigint, text string"
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id bigint, toxic int")
    df = spark.createDataFrame([(1, "some words"), (2, None)], schema)
    assert {r["score"] for r in T.score_toxicity(df, none).collect()} == {0.5}
    assert len({r["score"] for r in T.score_toxicity(df, one).collect()}) == 1
    assert T.score_toxicity(spark.createDataFrame([], schema), one).collect() == []
