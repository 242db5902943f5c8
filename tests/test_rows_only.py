"""Brute-force checks, on the small data set, of the queries that have no
SQL oracle (SQL cannot express the model scan or Spark's hash split)."""

import hashlib
import os
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from wardflow.operators import scan
from wardflow.plans import catalogue

SF = "/root/testdata/sf0.001"


def _tokens(text):
    import regex
    if text is None:
        return []
    return [t for t in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if t]


def test_scan_score_matches_plain_python(spark):
    docs = pd.read_parquet(os.path.join(SF, "documents.parquet"), columns=["doc_id", "text"])
    toks = {d: _tokens(t) for d, t in zip(docs.doc_id, docs.text)}
    counts = Counter(t for ts in toks.values() for t in ts)
    ranked = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0].encode("utf-8")))
    vocab = {w: i + 4 for i, (w, _) in enumerate(ranked) if i + 4 < 20000}
    ids = {}
    for d, ts in toks.items():
        seq = [1] + [vocab.get(t, 2) for t in ts]
        seq = ([0] * max(80 - len(seq), 0) + seq)[-80:]
        ids[d] = seq
    keys = sorted(ids)
    want = dict(zip(keys, scan.forward(np.array([ids[k] for k in keys]), scan._weights(7))))
    got = {r.doc_id: r.probability for r in catalogue.QUERIES["scan_score"](spark, SF).collect()}
    assert set(got) == set(want)
    assert max(abs(got[k] - want[k]) for k in keys) < 1e-6


def test_load_sequences_matches_pandas(spark):
    docs = pd.read_parquet(os.path.join(SF, "documents.parquet"), columns=["doc_id"])
    labels = pd.read_parquet(os.path.join(SF, "labels.parquet"))
    j = docs.merge(labels, on="doc_id")
    want = {int(d): (int(q), "test" if int(hashlib.md5(str(d).encode()).hexdigest()[:8], 16) % 5 < 1 else "train")
            for d, q in zip(j.doc_id, j.quality)}
    got = {r.doc_id: (r.label, r.split)
           for r in catalogue.QUERIES["load_sequences"](spark, SF).collect()}
    assert got == want


def test_fit_head_matches_newton(spark):
    """With an L2 penalty the optimum is unique: Spark ML's fit equals a
    NumPy Newton solve of mean log-loss + reg/2 |w|^2 (intercept free)."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F
    emb = pd.read_parquet(os.path.join(SF, "embeddings.parquet"))
    x = np.stack(emb.embedding.to_numpy()).astype(np.float64)
    y = (emb.label.to_numpy() >= catalogue.BINARY_FROM_CLASS).astype(np.float64)
    reg = 0.1
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    pen = np.full(a.shape[1], reg)
    pen[-1] = 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ w))
        g = a.T @ (p - y) / len(y) + pen * w
        h = (a * (p * (1 - p))[:, None]).T @ a / len(y) + np.diag(pen)
        w -= np.linalg.solve(h, g)
    want = 1 / (1 + np.exp(-a @ w))
    df = spark.read.parquet(os.path.join(SF, "embeddings.parquet")).select(
        "vec_id", (F.col("label") >= catalogue.BINARY_FROM_CLASS).cast("double").alias("label"),
        array_to_vector(F.transform("embedding", lambda v: v.cast("double"))).alias("features"))
    model = scan.fit_head(df, max_iter=200, reg_param=reg, standardization=False)
    from pyspark.ml.functions import vector_to_array
    got = {r.vec_id: r.p for r in model.transform(df).select(
        "vec_id", vector_to_array("probability")[1].alias("p")).collect()}
    diffs = [abs(got[v] - p) for v, p in zip(emb.vec_id, want)]
    assert max(diffs) < 1e-4
