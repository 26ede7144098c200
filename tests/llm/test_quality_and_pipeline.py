import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__
import corpus_pipeline
from starloom.llm.ngram_join import without_similar
from starloom.llm.quality import (
    BUCKETS,
    REACH,
    WIDTH,
    Network,
    calibrate,
    classify,
    context_vectors,
    fold_of,
    index_vectors,
    pooled,
    token_rows,
    train,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def documents(prose, count=500):
    rnd = random.Random(12)
    rows, labels = [], []
    for n in range(count):
        good = rnd.random() < 0.7
        text = prose(rnd.randrange(30, 200), rnd)
        if not good:
            text = rnd.choice([" | ".join(text.split()), text.upper() + "!!", " ".join(w + "%%%" for w in text.split()), (text.split()[0] + " ") * 50])
        rows.append((n, text, "en", f"s{n % 3}", len(text)))
        if n % 2:
            labels.append((n, int(good), 0))
    return rows, labels


def test_index_vectors_are_sparse_signs():
    vectors = index_vectors()
    assert vectors.shape == (BUCKETS, WIDTH)
    assert abs(vectors.mean()) < 0.01 and ((vectors != 0).sum(1) <= 4).all()


def test_tokens_do_not_depend_on_neighbours():
    texts = ["One two, two", "", None, "É! 12 x\n\ny " * 50, " \n"]
    together = [(t.tolist(), r.tolist()) for t, r in token_rows(pa.array(texts, pa.string()))]
    alone = [next(iter(token_rows(pa.array([x], pa.string())))) for x in texts]
    assert together == [(t.tolist(), r.tolist()) for t, r in alone]
    assert [len(t) for t, _ in together] == [3, 0, 0, 200, 0]


def test_context_vectors_like_plain_loops(make, prose):
    texts = [prose(n) for n in (1, 2, 3, 50, 400)] + [None, "", "a b a\nb", "tail " * 70_000]
    vectors = context_vectors(make([(t,) for t in texts], "text string", ()).repartition(4))
    indexes, sums = index_vectors().astype(np.float64), np.zeros((BUCKETS, WIDTH))
    for tokens, _ in token_rows(pa.array(texts, pa.string())):
        for k in range(len(tokens)):
            for other in range(max(0, k - REACH), min(len(tokens), k + REACH + 1)):
                if other != k:
                    sums[tokens[k]] += indexes[tokens[other]]
    want = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-6)
    assert np.abs(vectors - want).max() < 1e-5
    for tokens, rates in token_rows(pa.array(texts, pa.string())):
        got = pooled(tokens, rates, vectors, index_vectors())
        mean = sum(vectors[t].astype(np.float64) for t in tokens) / max(len(tokens), 1)
        assert np.abs(got[:WIDTH] - mean).max() < 1e-5 and (got[2 * WIDTH :] == rates).all()


def test_training_steps_and_temperature_like_plain_loops(monkeypatch):
    import starloom.llm.quality as quality

    monkeypatch.setattr(quality, "ROUNDS", 2)
    monkeypatch.setattr(quality, "BATCH", 8)
    monkeypatch.setattr(quality, "HIDDEN", 3)
    rnd = np.random.default_rng(5)
    x, y = rnd.normal(size=(20, 4)), (rnd.random(20) < 0.5).astype(float)
    got = train(x, y, np.ones(20))
    draw = np.random.default_rng(7)
    shift, scale = x.mean(0), x.std(0) + 1e-4
    w1, w2 = draw.normal(0, 0.5, (4, 3)), None
    w2 = draw.normal(0, 1 / np.sqrt(3), 3)
    flat = np.concatenate([w1.ravel(), np.zeros(3), w2, [0.0]])

    def loss(p, rows):  # weighted cross-entropy and the decay of both weights
        a, b, c, d = p[:12].reshape(4, 3), p[12:15], p[15:18], p[18]
        z = np.tanh((x[rows] - shift) / scale @ a + b) @ c + d
        return (np.log1p(np.exp(-z)) * y[rows] + np.log1p(np.exp(z)) * (1 - y[rows])).sum() / len(rows) + 0.5e-4 * ((a**2).sum() + (c**2).sum())

    m, v, step = np.zeros(19), np.zeros(19), 0
    for _ in range(2):
        order = draw.permutation(20)
        for begin in (0, 8, 16):
            rows, eye = order[begin : begin + 8], np.eye(19) * 1e-5
            slope = np.array([(loss(flat + e, rows) - loss(flat - e, rows)) / 2e-5 for e in eye])
            step += 1
            m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
            flat = flat - 3e-3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    assert np.abs(np.concatenate([got.w1.ravel(), got.b1, got.w2, [got.b2]]) - flat).max() < 1e-6
    calibrate(got, x, y)
    losses = {}
    for t in np.geomspace(0.25, 8, 61):
        p = 1 / (1 + np.exp(-got.logits(x) / t))
        losses[float(t)] = -sum(np.log(q) if mark else np.log(1 - q) for q, mark in zip(p, y, strict=True))
    assert got.temperature == min(losses, key=losses.get)


def test_stages_keep_columns_of_any_name(spark, make, prose, tmp_path):
    rows, labels = documents(prose, 60)
    names = ["score", "held_out", "predicted", "row", "id", "text_hash", "gone_id", "gone_hash", "its_id", "a.b", "a`b", "_row", "_null", "component_name"]
    from pyspark.sql import functions as F

    docs = make(rows + [(7000, None, None, None, None), (7001, "", "", "", 0)] + rows[:3], DOCS, ()).select("*", *[F.lit(f"kept {n}").alias(n) for n in names])
    make(labels, LABELS, ()).write.parquet(f"{tmp_path}/labels.parquet")
    make([(1, prose(30)), (2, None), (None, "x")], "item_id long, text string", ()).write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
        out = stage(spark, docs, str(tmp_path))
        got = out.collect()
        if name != "packing":
            assert out.columns == docs.columns
            assert got and all(r[n] == f"kept {n}" for r in got for n in names)
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []


def test_network_and_temperature():
    random_ = np.random.default_rng(1)
    x = random_.normal(size=(2000, 6))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (random_.random(2000) < 0.1)).astype(float)
    network = train(x[:1500], y[:1500], np.ones(1500))
    assert ((network.scores(x[1500:]) > 0.5) == y[1500:]).mean() > 0.7
    sharp = Network(**{**network.__dict__, "w2": network.w2 * 6, "b2": network.b2 * 6, "temperature": 1.0})
    calibrate(sharp, x[1500:], y[1500:])
    assert sharp.temperature > 2
    assert abs(sharp.scores(x[1500:]).mean() - y[1500:].mean()) < 0.05


def test_classifier(make, prose):
    rows, labels = documents(prose)
    odd = [(9000, None, None, None, None), (9001, "", "", "", 0), (None, "null id", "en", "s", 1), (4, rows[4][1], "en", "s", 2), (9002, "long " * 50_000, "en", "s", 3)]
    docs = make(rows + odd, DOCS, ("score", "held_out", "fold", "mark"))
    marks = labels + [(1, None, 1), (None, 0, 0), (77_777, 0, 0)]
    got = classify(docs, make(marks, LABELS)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows + odd)
    truth, hits, kept = dict((a, b) for a, b, _ in labels), [], []
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.held_out and r.doc_id in truth:
            hits.append(r.predicted == truth[r.doc_id])
            if truth[r.doc_id]:
                kept.append(r.predicted)
    assert np.mean(hits) > 0.9 and np.mean(kept) > 0.95
    # Labels of held-out rows and all other columns are no input.
    flipped = [(i, 1 - q if fold_of(i) == 0 else q, t) for i, q, t in labels]
    again = classify(make([(r[0], r[1], "xx", "other", 9) for r in rows + odd], DOCS), make(flipped, LABELS)).collect()
    scores = {r.doc_id: r.score for r in got}
    assert all(abs(scores[r.doc_id] - r.score) < 1e-3 for r in again)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)]])
def test_classifier_without_two_labels(make, labels):
    got = classify(make([(1, "a b", "", "", 1), (2, None, "", "", 1)], DOCS), make(labels, LABELS)).collect()
    assert {r.score for r in got} <= {0.5, 1.0} and len(got) == 2


def test_empty_table(make):
    assert classify(make([], DOCS), make([], LABELS)).collect() == []


def test_stages(spark, make, prose, tmp_path):
    rows, labels = documents(prose, 300)
    item = prose(30)
    good = [r for r in rows if dict((a, b) for a, b, _ in labels).get(r[0])]
    rows += [(1000, good[0][1], "en", "s", 1), (1001, f"{prose(90)} {item} {prose(60)}", "en", "s", 1)]
    rows += [(1002, f"{prose(90)} token = {'a1' * 20} {prose(60)}", "en", "s", 1)]
    make(rows, DOCS, ()).write.parquet(f"{tmp_path}/documents.parquet")
    make(labels, LABELS, ()).write.parquet(f"{tmp_path}/labels.parquet")
    make([(1, item)], "item_id long, text string", ()).write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
        if k < 4:
            assert docs.columns == columns, name
        if k == 3:
            text = docs.where("doc_id = 1002").first()
            assert "[secret]" in text.text and "a1a1" not in text.text and text.n_chars == len(text.text)
    truth = dict((a, b) for a, b, _ in labels)
    assert np.mean([i in seen[0] for i, q in truth.items() if q]) > 0.97 and np.mean([i in seen[0] for i, q in truth.items() if not q]) < 0.35
    assert seen[0] - seen[1] == {1000} and seen[1] - seen[2] == {1001} and seen[2] == seen[3] == seen[4]
    assert 1002 in seen[4]


def test_near_duplicate_stage_takes_pairs_between_the_thresholds(spark, make, tmp_path):
    rows = []
    for pair, edits in enumerate([3, 4, 5]):  # 4-grams: 0.885, 0.8498, 0.816; 5-grams: 0.858, 0.815, 0.774
        words = [f"p{pair}w{k}" for k in range(200)]
        copy = [f"{w}new" if k in range(20, 20 + 40 * edits, 40) else w for k, w in enumerate(words)]
        rows += [(2 * pair + k, " ".join(w), "en", "s", 1) for k, w in enumerate((words, copy))]
    docs = make(rows, DOCS, ())
    left = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in left.collect()) == [0, 2, 4, 5]
    apart = without_similar(docs)
    assert sorted(r.doc_id for r in apart.collect()) == [0, 2, 3, 4, 5]


def test_every_operator_is_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names
    for number in range(1, 14):
        assert sum(n.startswith(f"op{number}_") for n in names) == 1
