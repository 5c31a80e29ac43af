"""Repeated keys, copies within one source and hot groups."""

import time

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from phenolith.llm import navigable_graph, near_duplicates, near_vectors, packing, prefix_bpe, quality_model, running, secret_scan

SECRET_ROWS = "doc_id long, text string, source string"


def test_many_repositories_of_one_owner_are_copies(spark):
    copied, few, own = "Tutorial0123456789abcXYZ", "Zq9x8w7v6u5t4s3r2q1p0Aab", "Kj8h7g6f5d4s3a2q1w0eRtYu"
    rows = [(i, f"key {copied} and password={copied}", "hot") for i in range(12)]
    rows += [(100 + i, f"password={few}", "hot") for i in range(5)] + [(200, f"key {own}", "hot")]
    out = {r.doc_id: r.spans for r in secret_scan.scan_secrets(spark.createDataFrame(rows, SECRET_ROWS)).collect()}
    assert all([(s.kind, s.verdict, s.n_owners, s.n_repositories) for s in out[i]] == [("assign", "example", 1, 12)] for i in range(12))
    assert all([s.verdict for s in out[100 + i]] == ["unclear"] for i in range(5))
    assert [(s.kind, s.verdict) for s in out[200]] == [("live", "live")]


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_rows_of_one_id_are_judged_by_their_own_texts(spark):
    texts = [" ".join(f"w{k}x{i}" for i in range(40)) for k in range(6)]
    rows = [(7, texts[0]), (7, texts[1]), (7, texts[1].upper()), (7, texts[2]), (3, texts[2]), (9, texts[0] + " end"), (9, texts[3]), (11, texts[3]), (None, texts[0]), (12, ""), (12, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS).repartition(3)
    kept = corpus_pipeline.near_duplicates_stage(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text.lower()) for r in kept.collect()), key=str)
    assert got == sorted([(7, texts[0]), (7, texts[1]), (3, texts[2]), (9, texts[3]), (None, texts[0]), (12, ""), (12, "")], key=str)


def test_secrets_are_masked_in_their_own_row(spark):
    secrets = ["0123456789abcdef0123456789abcdef01", "fedcba9876543210fedcba9876543210fe", "00112233445566778899aabbccddeeff00"]
    texts = [f"say token={secrets[0]} now", f"much longer words first, then token={secrets[1]} and the end of it", f"hex {secrets[2]}", "clean words only in this one, and many of them", None]
    docs = spark.createDataFrame([(5, t, "en", "s", 1) for t in texts] + [(None, texts[0], "en", "s", 1)], DOCS).repartition(3)
    out = corpus_pipeline.secrets_stage(spark, docs, "")
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    bare = "say [secret] now"
    assert got == sorted([(5, bare), (5, "much longer words first, then [secret] and the end of it"), (5, "hex [secret]"), (5, texts[3]), (5, None), (None, bare)], key=str)


def test_a_repeated_document_is_fitted_once_for_each_label(spark, monkeypatch):
    rows = [(i, f"words number{i} of text{i % 7}") for i in range(60)] + [(i, f"copy {k} of {i}") for i in (1, 2) for k in range(300)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, 1)], "doc_id long, quality int")
    fitted, fit = [], quality_model.fit_network

    def watched(x, y, spare):
        fitted.append((x, y))
        return fit(x, y, spare)

    monkeypatch.setattr(quality_model, "fit_network", watched)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    learnable = labels.where(quality_model.learnable("doc_id")).count()
    for partitions in (2, 5):
        quality_model.fit_quality(docs.repartition(partitions), labels)
    assert [len(y) for _, y in fitted] == [learnable] * 2 and (fitted[0][0] == fitted[1][0]).all()
    quality_model.fit_quality(docs, labels, fit_rows=20)
    assert len(fitted[2][1]) == 20


def _two_islands():
    """One large group, and pairs of nodes, far from it and each other, that no link of the graph leads to."""
    rng = np.random.default_rng(3)
    large = rng.normal(size=16) + rng.normal(size=(300, 16)) * 0.02
    pairs = np.repeat(rng.normal(size=(20, 16)), 2, axis=0) + rng.normal(size=(40, 16)) * 0.01
    x = np.concatenate([large, pairs])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    whole = navigable_graph.build(x[:300].astype(np.float32))
    layers = [np.concatenate([layer, np.full((40, layer.shape[1]), -1, dtype=layer.dtype)]) for layer in whole.layers]
    return x, navigable_graph.Graph(x.astype(np.float32), layers, whole.entry)


def test_nodes_that_the_graph_does_not_reach_are_found():
    x, cut = _two_islands()
    truth = x @ x.T >= 0.9
    np.fill_diagonal(truth, False)
    found = [f[f != i] for i, f in enumerate(near_vectors.find(cut, x, x, np.arange(len(x)), 0.9))]
    assert all(sorted(f) == np.flatnonzero(t).tolist() for f, t in zip(found, truth, strict=True))


def test_links_found_from_one_side_count_on_both(monkeypatch):
    x, _ = _two_islands()
    one, two = (x[::2], x[1::2])
    finders = [[np.flatnonzero(row >= 0.9) for row in two @ one.T], [np.zeros(0, dtype=int)] * len(one)]
    monkeypatch.setattr(near_vectors, "find", lambda *_: finders.pop(0))
    bits = near_vectors.both_ways((None, one), (None, two), 0.9)
    finders[:] = [[np.zeros(0, dtype=int)] * len(two), [np.flatnonzero(row >= 0.9) for row in one @ two.T]]
    assert (bits == near_vectors.both_ways((None, one), (None, two), 0.9)).all()
    assert (np.unpackbits(bits, axis=1, count=len(one)).astype(bool) == (two @ one.T >= 0.9)).all()


def test_copies_under_one_id_meet_once(spark, monkeypatch):
    """Two similar texts with 1,000 rows of one id each: sets and comparisons are counted by text, not by row."""
    one = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([(1, one)] * 1000 + [(2, one + " end")] * 1000 + [(1, "another text that is like no other one at all")], "doc_id long, text string").repartition(6)
    written, write = {}, near_duplicates.write_once

    def counted(df, name):
        out = write(df, name)
        written.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(near_duplicates, "write_once", counted)
    got = near_duplicates.near_duplicates(docs).groupBy("doc_id", "component_id", "kept").count().collect()
    assert {tuple(r) for r in got} == {(1, 1, True, 1001), (2, 1, False, 1000)}
    assert max(written["sets"]) == 3 and max(written["verified"]) <= 1


def test_very_many_matches_in_one_text(spark):
    values = [f"{i:032x}" for i in range(50_000)]
    rows = [(1, "say " + " and ".join(values) + " é Zq9x8w7v6u5t4s3r2q1p0Aab", "a"), (2, "x", "a")]
    docs = spark.createDataFrame([(*r, "en", len(r[1])) for r in rows], "doc_id long, text string, source string, lang string, n_chars long").cache()
    docs.count()
    start = time.time()
    out = {r.doc_id: r.spans for r in secret_scan.scan_secrets(docs).collect()}
    took = time.time() - start
    text = rows[0][1]
    assert out[2] == [] and len(out[1]) == 50_001 and all(text[s.start : s.stop] == s.value for s in out[1]) and out[1][-1].kind == "live"
    start = time.time()
    masked = {r.doc_id: r.text for r in corpus_pipeline.secrets_stage(spark, docs, "").collect()}
    assert masked == {1: "say " + " and ".join(["[secret]"] * 50_000) + " é [secret]", 2: "x"}
    assert took < 20 and time.time() - start < 30


def test_a_candidate_that_meets_a_base_span_is_none(spark):
    rows = [(1, "token=Zq9x8w7v6u5t4s3r2q1p0Aab-Zq9x8w7v6u5t4s3r2q1p0Aab rest Kj8h7g6f5d4s3a2q1w0eRtYu", "a")]
    spans = secret_scan.scan_secrets(spark.createDataFrame(rows, SECRET_ROWS)).first().spans
    assert [(s.kind, s.start) for s in spans] == [("assign", 0), ("live", 61)]


def test_redacting_overlapping_and_touching_spans(spark):
    df = spark.range(1).selectExpr("'äbcdefghij' as t", "array(named_struct('start', 1, 'stop', 5), named_struct('start', 2, 'stop', 3), named_struct('start', 4, 'stop', 6), named_struct('start', 6, 'stop', 7)) as s")
    assert df.select(secret_scan.redact(F.col("t"), F.col("s"), "#")).first()[0] == "ä##hij"


def test_running_sums_and_maxima(spark):
    rng = np.random.default_rng(1)
    rows = [([int(v) for v in rng.integers(0, 100, n)],) for n in (0, 1, 2, 3, 7, 100, 1001)]
    got = spark.createDataFrame(rows, "a array<int>").select("a", running.running_sum(F.col("a")).alias("s"), running.running_max(F.col("a")).alias("m")).collect()
    assert all(r.s == np.cumsum(r.a).tolist() and r.m == np.maximum.accumulate(r.a).tolist() if r.a else r.s == r.m == [] for r in got) and len(got) == 7


def test_stages_keep_columns_whatever_their_names(spark, tmp_path):
    """Names that the stages use inside, as columns of the documents."""
    texts = ["\n".join("Some " + " ".join(f"{a}{b}{k}" for a in "abcdef" for b in ("ra", "lo")) + f" line {i} it is." for i, _ in enumerate("abcdef")) for k in "ghijklmn"]
    texts = [t.replace("line", f"l{k}") for k, t in enumerate(texts)]
    texts = [" ".join(w if w in ("Some", "it", "is.") else f"{w}{i}" for i, w in enumerate(t.split(" "))) for t in texts]
    texts += [None, "", "token=0123456789abcdef0123456789abcdef " + texts[0].upper()]
    names = ["_new", "_score", "rules", "_row", "_row_", "_text_", "score", "key", "row", "spans", "found", "node", "kept", "n"]
    rows = [(i, t, "en", "s", len(t or ""), *[f"{n}{i}" for n in names]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS + "".join(f", {n} string" for n in names))
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(8)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        kept = out.collect()
        assert kept and all(r[n] == f"{n}{r.doc_id}" for r in kept for n in names), name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
    assert corpus_pipeline.packing_stage(spark, docs, str(tmp_path)).count() == 9


def test_bins_of_model_tokens(spark):
    """With the tokens of a tokenizer as lengths no bin holds more of them than its capacity, also of texts without spaces."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = spark.createDataFrame([(1, "漢字" * 3000), (2, "words of a text " * 400), (3, "x1y2" * 5000)], "doc_id long, text string")
    coded = prefix_bpe.encode(docs, path, public_tokenizers.PATTERN)
    packed = packing.pack_best_fit(coded, length=F.size("ids"))
    total = {r.doc_id: r.n for r in coded.selectExpr("doc_id", "size(ids) n").collect()}
    assert {r.doc_id: r.n for r in packed.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()} == total
    assert packed.groupBy("block", "bin").agg(F.sum("length").alias("n"), F.max("capacity").alias("c")).where("n > c").count() == 0
