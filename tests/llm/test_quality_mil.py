import zlib

import numpy as np

from gridscan.llm import quality_mil, queries

from .conftest import SCHEMA


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    scored = queries.QUERIES["op3_quality_classifier"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert scored.count() == docs.count()
    rows = scored.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    fold = [r for r in rows if r.held_out]
    good = np.array([r.score for r in fold if r.quality == 1])
    bad = np.array([r.score for r in fold if r.quality == 0])
    auc = np.mean([(good > b).mean() + 0.5 * (good == b).mean() for b in bad])
    accuracy = np.mean([r.predicted == r.quality for r in fold])
    print("AUC", auc, "accuracy", accuracy, "kept", (good >= 0.7).mean(), "caught", (bad < 0.7).mean())
    assert auc > 0.97 and accuracy > 0.95


def test_held_out_labels_and_other_columns_do_not_matter(spark, odd_frame, odd_docs):
    labels = [(d[0], i % 2) for i, d in enumerate(odd_docs)]
    turned = [(k, 1 - q if zlib.crc32(str(k).encode()) % 4 == 2 else q) for k, q in labels]
    a, b = (quality_mil.quality_scores(odd_frame, spark.createDataFrame(x, "doc_id long, quality int")).collect() for x in (labels, turned))
    assert sorted(a) == sorted(b) and len(a) == len(odd_docs)


def test_no_labels_and_no_rows(spark, odd_frame, empty_frame):
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    assert {r.score for r in quality_mil.quality_scores(odd_frame, none).collect()} == {0.5}
    assert quality_mil.quality_scores(empty_frame, none).count() == 0


def test_null_ids(spark):
    frame = spark.createDataFrame([(None, "a b", "", "", 0, 0, ""), (1, None, "", "", 0, 0, "")], SCHEMA)
    rows = quality_mil.quality_scores(frame, spark.createDataFrame([(1, 1)], "doc_id long, quality int")).collect()
    assert len(rows) == 2 and all(0 <= r.score <= 1 for r in rows)


def test_long_texts_score_the_same_in_chunks(monkeypatch):
    r = np.random.default_rng(0)
    texts = [bytes(r.integers(32, 127, n, dtype=np.uint8)) for n in (0, 1, 511, 512, 513, 100_000)]
    bags = [quality_mil.bag_of(t) for t in texts]
    model = quality_mil.train(bags, np.array([0, 1, 0, 1, 0, 1]))
    whole = quality_mil.score_texts(model, texts)
    monkeypatch.setattr(quality_mil, "CHUNK", 1024)
    assert np.allclose(whole, quality_mil.score_texts(model, texts), atol=1e-5)
    assert [len(b) for b in bags] == [1, 1, 1, 1, 2, 196]


def small_model(r, dtype=np.float64):
    model = quality_mil.Model(np.zeros(quality_mil.WIDTH, dtype), np.ones(quality_mil.WIDTH, dtype))
    model.p = {k: r.standard_normal(v.shape) * 0.3 for k, v in model.p.items()}
    return model


def naive_score(model, text):
    """One document by plain loops over its passages."""
    passages = [text[k : k + 512] for k in range(0, max(1, len(text)), 512)]
    hidden, logits = [], []
    for passage in passages:
        x = quality_mil.passage_features([(passage, len(text))])[0][0]
        h = [np.tanh(sum(v * w for v, w in zip((x - model.mean) / model.scale, column)) + b) for column, b in zip(model.p["w"].T, model.p["wb"])]
        gate = [np.tanh(np.dot(h, v)) / (1 + np.exp(-np.dot(h, u))) for v, u in zip(model.p["v"].T, model.p["u"].T)]
        hidden.append(h)
        logits.append(np.dot(gate, model.p["a"][:, 0]))
    weights = [np.exp(v) for v in logits]
    mixed = [sum(a * h[k] for a, h in zip(weights, hidden)) / sum(weights) for k in range(quality_mil.HIDDEN)]
    return 1 / (1 + np.exp(-(np.dot(mixed, model.p["c"][:, 0]) + model.p["b"][0])))


def test_scores_by_plain_loops():
    r = np.random.default_rng(5)
    model = small_model(r)
    texts = [bytes(r.integers(32, 127, n, dtype=np.uint8)) for n in (0, 1, 512, 513, 1500, 4000)] + ["größe\n\n".encode() * 300]
    assert np.allclose(quality_mil.score_texts(model, texts), [naive_score(model, t) for t in texts], atol=1e-9)


def naive_features(passage, whole):
    k = quality_mil._K
    counts, grams = np.zeros(k * k), set()
    padded = passage + b"\0\0\0"
    for i in range(len(passage)):
        counts[int(quality_mil._CLASS[padded[i]]) * k + int(quality_mil._CLASS[padded[i + 1]])] += 1
        grams.add((int.from_bytes(padded[i : i + 4], "little") * 0x9E3779B1 & 0xFFFFFFFF) >> 22)
    n = max(1, len(passage))
    return [*np.sqrt(counts / n), len(grams) / (1024 * (1 - np.exp(-n / 1024))), np.log1p(len(passage)) / 6, np.log1p(whole) / 10]


def test_features_by_plain_loops():
    r = np.random.default_rng(6)
    pieces = [(bytes(r.integers(0, 256, n, dtype=np.uint8)), w) for n, w in ((0, 0), (1, 1), (512, 512), (1025, 5000))]
    got, counts = quality_mil.passage_features(pieces)
    want = [naive_features(p[k : k + 512], w) for p, w in pieces for k in range(0, max(1, len(p)), 512)]
    assert counts.tolist() == [1, 1, 1, 3] and np.allclose(got, want, atol=1e-5)


def test_gradients_against_differences():
    r = np.random.default_rng(1)
    model = small_model(r)
    bags = [r.standard_normal((n, quality_mil.WIDTH)) * 0.2 for n in (1, 3, 5, 2)]
    labels = np.array([0.0, 1.0, 1.0, 0.0])
    _, grads = model.gradients(bags, labels)
    step = 1e-6
    for k, g in grads.items():
        flat = model.p[k].reshape(-1)
        for i in r.choice(flat.size, min(12, flat.size), replace=False).tolist():
            old = flat[i]
            loss = []
            for x in (old + step, old - step):
                flat[i] = x
                loss.append(model.gradients(bags, labels)[0])
            flat[i] = old
            assert abs((loss[0] - loss[1]) / (2 * step) - g.reshape(-1)[i]) < 1e-6, k


def test_training_follows_its_labels():
    r = np.random.default_rng(1)
    bags = [r.standard_normal((n, quality_mil.WIDTH)).astype(np.float32) for n in (1, 3, 5, 2) * 20]
    labels = np.array([float(b[:, 0].max() > 0.5) for b in bags])
    model = quality_mil.train(bags, labels)
    right = [(model.score(*model.encode(b)) > 0.5) == y for b, y in zip(bags, labels)]
    assert np.mean(right) > 0.95


def test_training_takes_every_passage_of_a_long_text(spark, monkeypatch):
    """Two frames whose long texts differ in one passage teach different models."""
    r = np.random.default_rng(2)
    text = bytes(r.integers(97, 123, 100_000, dtype=np.uint8)).decode()
    other = text[:512] + "7" * 512 + text[1024:]
    ids = [i for i in range(20) if zlib.crc32(str(i).encode()) % 4 != 2][:2]
    labels = spark.createDataFrame([(i, k) for k, i in enumerate(ids)], "doc_id long, quality int")
    models = []
    for t in (text, other):
        docs = spark.createDataFrame([(ids[0], t, "", "", 0, 0, ""), (ids[1], "short", "", "", 0, 0, "")], SCHEMA)
        models.append(quality_mil.fit_model(docs, labels))
    assert models[0] != models[1]
    whole = quality_mil.bag_of(text.encode())
    monkeypatch.setattr(quality_mil, "CHUNK", 1024)
    assert len(whole) == 196 and np.array_equal(whole, quality_mil.bag_of(text.encode()))


def test_the_sample_is_bounded_by_rows_and_bytes(spark):
    """Repeated ids teach one text each, and texts beyond the bound of bytes none."""
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2][:20]
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, quality int")
    rows = [(i, f"text {i} " * 20, "", "", 0, 0, "") for i in ids]
    once, often = (spark.createDataFrame(x, SCHEMA) for x in (rows, rows * 30))
    assert quality_mil.fit_model(once, labels) == quality_mil.fit_model(often, labels)
    large = spark.createDataFrame([*rows, *[(i, "z" * 50_000, "", "", 0, 0, "") for i in range(100, 140)]], SCHEMA)
    more = labels.unionByName(spark.createDataFrame([(i, 1) for i in range(100, 140)], "doc_id long, quality int"))
    assert quality_mil.fit_model(large, more, sample_bytes=20_000) == quality_mil.fit_model(once, labels)
