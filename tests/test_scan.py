"""Batch scoring: NumPy maths invariants and the Spark path."""

import numpy as np
import pytest

from wardflow.operators import scan


def test_forward_shape_range_and_determinism():
    w = scan.seeded_weights(7)
    ids = np.random.default_rng(0).integers(0, 20000, (6, 80))
    p = scan.forward(ids, w)
    assert p.shape == (6,) and np.all((p > 0) & (p < 1))
    assert np.array_equal(p, scan.forward(ids, scan.seeded_weights(7)))


def test_forward_is_batch_independent():
    w = scan.seeded_weights(7)
    ids = np.random.default_rng(1).integers(0, 20000, (5, 80))
    together = scan.forward(ids, w)
    alone = np.array([scan.forward(ids[i:i + 1], w)[0] for i in range(5)])
    assert np.allclose(together, alone, atol=1e-6)


def test_hard_sigmoid_keras2():
    assert np.allclose(scan.hard_sigmoid(np.array([-3.0, 0.0, 1.0, 3.0])), [0, 0.5, 0.7, 1])


def test_memory_scan_recurrence():
    w = scan.seeded_weights(3)
    x = np.random.default_rng(2).normal(size=(2, 4, 768)).astype(np.float32)
    s = scan.memory_scan(x, w)
    r1 = scan._softmax(x @ w["mem_r1"] + w["mem_b1"])
    r2 = scan._softmax(x @ w["mem_r2"] + w["mem_b2"])
    u = np.tanh(x @ w["mem_u"] + w["mem_bu"])
    ref = np.zeros((2, 32))
    for t in range(4):
        ref = r1[:, t] * ref + r2[:, t] * u[:, t]
    assert np.allclose(s, ref, atol=1e-5)


def test_spark_scoring_matches_numpy(spark):
    ids = np.random.default_rng(4).integers(0, 20000, (7, 80))
    df = spark.createDataFrame([(i, [int(x) for x in row]) for i, row in enumerate(ids)],
                               "doc_id long, ids array<int>").repartition(3)
    got = {r.doc_id: r.probability for r in scan.score_sequences(df, batch_rows=2).collect()}
    want = scan.forward(ids, scan.seeded_weights(7))
    assert [got[i] for i in range(7)] == pytest.approx(list(want), abs=1e-6)


def test_evaluate(spark):
    df = spark.createDataFrame([(0.9, 1), (0.2, 0), (0.6, 0), (0.5, 1)],
                               "probability double, label int")
    r = scan.evaluate(df).collect()[0]
    assert r.n == 4 and r.accuracy == pytest.approx(0.5)
    want = -np.mean([np.log(0.9), np.log(0.8), np.log(0.4), np.log(0.5)])
    assert r.bce == pytest.approx(want)


def test_folded_attention_equals_full():
    w = scan.seeded_weights(5)
    c = np.random.default_rng(6).normal(size=(3, 8, 128)).astype(np.float32)
    c3 = np.concatenate([c, c, c], -1)
    pairs = np.concatenate([c3[:, 0::2], c3[:, 1::2]], -1)
    small = np.concatenate([c[:, 0::2], c[:, 1::2]], -1)
    full = pairs @ w["att_w"]
    folded = small @ scan.folded_attention(w["att_w"], 128)
    assert np.allclose(full, folded, atol=1e-4)
