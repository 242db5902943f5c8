"""Batch scoring of padded token sequences with frozen weights (K7-K9,
K11) plus the distributed head fit and evaluation (K12, K13).

Training of the recurrent network is not rebuilt (single-machine
optimiser); scoring with given weights is.  Weights are either loaded from
an ``.npz`` file or generated from a seed; either way every Python worker
materialises them once and scores whole Arrow batches of rows with NumPy
matrix products (``mapInPandas``), so rows are never handled one by one.
Arithmetic is float32, the precision of the reference model.
The parameter size is fixed by the model shape (about 13 MB), not by data.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# FIXED VALUES (model shape of the reference script)
NUM_WORDS, MAX_LEN, EMB, DMEM = 20000, 80, 128, 32


@dataclass(frozen=True)
class ModelShape:
    num_words: int = NUM_WORDS
    max_len: int = MAX_LEN
    emb: int = EMB
    dmem: int = DMEM


def _glorot_normal(rng, fan_in, fan_out):
    return rng.normal(0.0, np.sqrt(2.0 / (fan_in + fan_out)), (fan_in, fan_out))


def _glorot_uniform(rng, fan_in, fan_out):
    lim = np.sqrt(6.0 / (fan_in + fan_out))
    return rng.uniform(-lim, lim, (fan_in, fan_out))


def seeded_weights(seed: int = 7, shape: ModelShape = ModelShape()) -> dict[str, np.ndarray]:
    """Deterministic weights with the script's initialisers' distributions."""
    rng = np.random.default_rng(seed)
    e, d = shape.emb, shape.dmem
    width = 6 * e                       # pairs of 3x-replicated c: 768 for emb 128
    w = {
        "embedding": rng.uniform(-0.05, 0.05, (shape.num_words, e)),
        "kernel": _glorot_normal(rng, e, 4 * e),
        "recurrent": _glorot_normal(rng, e, 4 * e),
        "att_w": _glorot_uniform(rng, width, width),
        "att_b": np.zeros(width),
        "mem_u": _glorot_normal(rng, width, d),
        "mem_r1": _glorot_normal(rng, width, d),
        "mem_r2": _glorot_normal(rng, width, d),
        "mem_bu": rng.normal(0.0, np.sqrt(2.0 / (d + d)), d),
        "mem_b1": rng.normal(0.0, np.sqrt(2.0 / (d + d)), d),
        "mem_b2": rng.normal(0.0, np.sqrt(2.0 / (d + d)), d),
        "head_w": _glorot_uniform(rng, 3 * e + d, 1)[:, 0],
        "head_b": np.zeros(1),
    }
    return {k: v.astype(np.float32) for k, v in w.items()}


def hard_sigmoid(x):
    """Keras-2 form: clip(0.2 x + 0.5, 0, 1)."""
    return np.clip(0.2 * x + 0.5, 0.0, 1.0)


def _softmax(x, axis=-1):
    z = x - x.max(axis=axis, keepdims=True)
    ez = np.exp(z)
    return ez / ez.sum(axis=axis, keepdims=True)


def lstm_scan(x, w):
    """K7: 4-gate cell without bias; m has no tanh; c = f c' + i m;
    h = o tanh(c).  x: (B, T, E) -> c, h: (B, T, E)."""
    b, t, e = x.shape
    k, r = w["kernel"], w["recurrent"]
    xk = x @ k                                  # (B, T, 4E), gates i, f, c, o
    h = np.zeros((b, e), dtype=x.dtype)
    c = np.zeros((b, e), dtype=x.dtype)
    cs, hs = np.empty((b, t, e), dtype=x.dtype), np.empty((b, t, e), dtype=x.dtype)
    for s in range(t):
        z = xk[:, s, :] + h @ r
        i = hard_sigmoid(z[:, :e])
        f = hard_sigmoid(z[:, e:2 * e])
        m = z[:, 2 * e:3 * e]
        o = hard_sigmoid(z[:, 3 * e:])
        c = f * c + i * m
        h = o * np.tanh(c)
        cs[:, s, :], hs[:, s, :] = c, h
    return cs, hs


def memory_scan(x, w):
    """K8: s = r1 * s' + r2 * tanh(u); gates depend on the input only.
    x: (B, T, D_in) -> last state (B, D)."""
    r1 = _softmax(x @ w["mem_r1"] + w["mem_b1"])
    r2 = _softmax(x @ w["mem_r2"] + w["mem_b2"])
    u = np.tanh(x @ w["mem_u"] + w["mem_bu"])
    s = np.zeros((x.shape[0], w["mem_u"].shape[1]), dtype=x.dtype)
    for t in range(x.shape[1]):
        s = r1[:, t, :] * s + r2[:, t, :] * u[:, t, :]
    return s


def folded_attention(att_w: np.ndarray, emb: int) -> np.ndarray:
    """The attention input is [c, c, c] of an even step next to [c, c, c] of
    the odd step, so ``pairs @ W == [c_even, c_odd] @ F`` where each block of
    F is the sum of the three matching row blocks of W (3x fewer flops)."""
    b = [att_w[i * emb:(i + 1) * emb] for i in range(6)]
    return np.concatenate([b[0] + b[1] + b[2], b[3] + b[4] + b[5]], axis=0)


def forward(ids: np.ndarray, w) -> np.ndarray:
    """Whole forward pass for a batch of padded id sequences (B, T)."""
    x = w["embedding"][ids]                                   # K9: (B, T, E)
    c, h = lstm_scan(x, w)                                    # K7
    e = c.shape[-1]
    c3 = np.concatenate([c, c, c], axis=-1)                   # K10: (B, T, 3E)
    pairs = np.concatenate([c3[:, 0::2], c3[:, 1::2]], -1)    # K5: (B, T/2, 6E)
    att_f = w.get("att_fold")
    if att_f is None:
        att_f = folded_attention(w["att_w"], e)
    small = np.concatenate([c[:, 0::2], c[:, 1::2]], -1)      # (B, T/2, 2E)
    a = _softmax(small @ att_f + w["att_b"])                  # K6
    mem = memory_scan(pairs * a, w)                           # K8: (B, D)
    h3 = np.concatenate([h, h, h], axis=-1)[:, -1, :]         # K10: (B, 3E)
    final = np.concatenate([h3, mem], axis=-1)                # (B, 3E + D)
    z = (final @ w["head_w"] + w["head_b"][0]).astype(np.float64)
    return 1.0 / (1.0 + np.exp(-z))                           # K11


def _ship_by_value() -> None:
    """Send this module's code with the task (pickled by value), so Python
    workers need NumPy and pandas but not this package on their path."""
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _weights(source) -> dict:
    """Weights for ``source`` (seed or .npz path), built once per Python
    worker process and kept across tasks in a process-wide registry (not in
    a module global, which would travel with every pickled task)."""
    import sys
    import types
    reg = sys.modules.setdefault("_wardflow_weights", types.ModuleType("_wardflow_weights"))
    cache = reg.__dict__.setdefault("cache", {})
    key = source if isinstance(source, (int, str)) else id(source)
    if key not in cache:
        if isinstance(source, int):
            w = seeded_weights(source)
        else:
            with np.load(source) as z:
                w = {k: z[k].astype(np.float32) for k in z.files}
        w["att_fold"] = folded_attention(w["att_w"], w["kernel"].shape[0])
        cache[key] = w
    return cache[key]


def score_sequences(seqs: DataFrame, key: str = "doc_id", ids: str = "ids",
                    weights: int | str = 7, batch_rows: int = 512) -> DataFrame:
    """(key, probability) for every padded sequence; ``weights`` is a seed
    or a path to an ``.npz`` file readable by every executor."""
    key_type = dict(seqs.dtypes)[key]
    _ship_by_value()

    def run(batches):
        w = _weights(weights)
        for pdf in batches:
            for lo in range(0, len(pdf), batch_rows):
                part = pdf.iloc[lo:lo + batch_rows]
                arr = np.stack([np.asarray(v, dtype=np.int64) for v in part[ids]])
                p = forward(arr, w)
                yield pd.DataFrame({key: part[key].to_numpy(), "probability": p})

    return seqs.select(key, ids).mapInPandas(run, f"{key} {key_type}, probability double")


def fit_head(df: DataFrame, features: str = "features", label: str = "label",
             max_iter: int = 50, reg_param: float = 0.0, standardization: bool = True):
    """Sigmoid output + binary cross-entropy = logistic regression,
    fitted distributed by Spark ML (tree-aggregated gradients).  The default
    is unregularised, like the reference's dense head.  A fit that stops at
    the iteration limit instead of converging is an error."""
    from pyspark.ml.classification import LogisticRegression
    model = LogisticRegression(featuresCol=features, labelCol=label, maxIter=max_iter,
                               regParam=reg_param, standardization=standardization,
                               tol=1e-10).fit(df)
    if model.summary.totalIterations >= max_iter:
        raise RuntimeError(f"the fit has not converged in {max_iter} iterations")
    return model


def head_gradient(model, df: DataFrame, reg_param: float, features: str = "features",
                  label: str = "label") -> DataFrame:
    """(feature, gradient) of the mean log-loss plus ``reg_param / 2 * |w|^2``
    at a fitted head's weights (feature -1: the intercept, not penalised);
    all zeros at the optimum.  One pass and one partial aggregate."""
    from pyspark.ml.functions import vector_to_array
    residual = vector_to_array("probability")[1] - F.col(label)
    rows = model.transform(df).select(residual.alias("r"), F.posexplode(
        F.concat(F.array(F.lit(1.0)), vector_to_array(features))).alias("pos", "x"))
    weights = [0.0, *[reg_param * w for w in model.coefficients.toArray().tolist()]]
    penalty = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("pos") + 1)
    return (rows.groupBy("pos").agg(F.avg(F.col("r") * F.col("x")).alias("g"))
            .select((F.col("pos") - 1).alias("feature"), (F.col("g") + penalty).alias("gradient")))


def evaluate(scored: DataFrame, prob: str = "probability", label: str = "label",
             eps: float = 1e-7) -> DataFrame:
    """Accuracy (p > 0.5 counts as 1, as rounding half to even does)
    and mean binary cross-entropy with p clipped to [eps, 1 - eps]."""
    p = F.least(F.greatest(F.col(prob), F.lit(eps)), F.lit(1.0 - eps))
    y = F.col(label).cast("double")
    hit = (F.when(F.col(prob) > 0.5, 1.0).otherwise(0.0) == y).cast("double")
    bce = -(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))
    return scored.agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy"),
                      F.avg(bce).alias("bce"))
