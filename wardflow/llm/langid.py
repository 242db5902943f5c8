"""Language identification by a bidirectional gated recurrent network over
bytes, in numpy.

Each direction runs a gated recurrent unit over the bytes of a text; every
position is labelled from both states, and a document's probabilities are
the mean over its positions.  Texts are read whole, as consecutive blocks of
``BLOCK`` bytes whose states start at zero.  The gates use the piecewise
linear sigmoid and the candidate the softsign, which cost a fraction of
their exponential counterparts.  The network is trained by backpropagation
through time on a bounded sample: at most ``docs_per_lang`` labelled
documents a language (smallest hash of the id first) and ``blocks_per_doc``
blocks of each.  Prediction runs in the tasks that read the texts.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wardflow.llm.common import cut, join_small, ship_by_value

BLOCK = 64
HIDDEN = 8
DOCS_PER_LANG = 600
BLOCKS_PER_DOC = 6
UNDETERMINED = "und"
#: Bytes a task labels at once, and blocks in one pass of the network.
BYTES_AT_ONCE = 1 << 20
BLOCKS_AT_ONCE = 2048
LETTER = regex.compile(r"\p{L}")


# ---------------------------------------------------------------------------
# the network
# ---------------------------------------------------------------------------

class Cell(NamedTuple):
    """One direction: input tables by byte, recurrent weights, biases; the
    two gates (update, reset) side by side, then the candidate."""
    x_gates: np.ndarray   # 256 x 2H
    x_cand: np.ndarray    # 256 x H
    u_gates: np.ndarray   # H x 2H
    u_cand: np.ndarray    # H x H
    b_cand: np.ndarray    # H, inside the reset


class Model(NamedTuple):
    langs: list[str]
    ahead: Cell
    back: Cell
    out: np.ndarray       # 2H x K
    bias: np.ndarray      # K


def new_model(langs: list[str], hidden: int, rnd: np.random.Generator) -> Model:
    def mat(*shape):
        return rnd.normal(0, shape[0] ** -0.5 if shape[0] < 256 else 0.3, shape).astype(np.float32)

    def cell():
        return Cell(mat(256, 2 * hidden), mat(256, hidden), mat(hidden, 2 * hidden), mat(hidden, hidden),
                    np.zeros(hidden, np.float32))
    return Model(list(langs), cell(), cell(), mat(2 * hidden, len(langs)), np.zeros(len(langs), np.float32))


def run_cell(c: Cell, x: np.ndarray, real: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (L, B, H) of one direction over the bytes x (L, B); where
    ``real`` is 0 (padding) the state is zero.  ``keep`` gets what the
    backward pass needs."""
    steps, n = x.shape
    size = c.u_cand.shape[0]
    h = np.zeros((n, size), np.float32)
    states = np.empty((steps, n, size), np.float32)
    for t in range(steps):
        g = c.x_gates.take(x[t], 0)
        g += h @ c.u_gates
        a = g * np.float32(0.25) + np.float32(0.5)
        np.clip(a, 0, 1, out=a)
        z, r = a[:, :size], a[:, size:]
        q = h @ c.u_cand
        q += c.b_cand
        m = c.x_cand.take(x[t], 0)
        m += r * q
        d = np.abs(m)
        d += 1
        cand = m / d
        new = h - cand
        new *= z
        new += cand
        new *= real[t, :, None]
        if keep is not None:
            keep.append((h, a, q, d, cand))
        h = states[t] = new
    return states


def back_cell(c: Cell, x: np.ndarray, real: np.ndarray, keep: list, d_states: np.ndarray) -> Cell:
    """Backpropagation through time: gradients of the cell's weights."""
    size = c.u_cand.shape[0]
    grads = [np.zeros_like(w) for w in c]
    dh = np.zeros_like(d_states[0])
    dg_all, dm_all = [], []
    for t in range(len(x) - 1, -1, -1):
        h, a, q, d, cand = keep[t]
        z, r = a[:, :size], a[:, size:]
        dh = (dh + d_states[t]) * real[t, :, None]
        dm = dh * (1 - z) / (d * d)
        da = np.concatenate((dh * (h - cand), dm * q), axis=1)
        dg = da * ((a > 0) & (a < 1)) * np.float32(0.25)
        dq = dm * r
        grads[2] += h.T @ dg
        grads[3] += h.T @ dq
        grads[4] += dq.sum(0)
        dg_all.append(dg)
        dm_all.append(dm)
        dh = dh * z + dg @ c.u_gates.T + dq @ c.u_cand.T
    at = x[::-1].ravel()
    for k, parts in ((0, dg_all), (1, dm_all)):
        part = np.concatenate(parts)
        for j in range(part.shape[1]):
            grads[k][:, j] = np.bincount(at, part[:, j], 256)
    return Cell(*grads)


def probabilities(m: Model, x: np.ndarray, real: np.ndarray, keep=(None, None)) -> tuple[np.ndarray, np.ndarray]:
    """(states (L, B, 2H), label probabilities (L, B, K)) of byte blocks."""
    states = np.concatenate((run_cell(m.ahead, x, real, keep[0]),
                             run_cell(m.back, x[::-1], real[::-1], keep[1])[::-1]), axis=2)
    logits = states.reshape(-1, states.shape[2]) @ m.out + m.bias
    logits -= logits.max(1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(1, keepdims=True)
    return states, logits.reshape(*x.shape, -1)


def gradients(m: Model, x: np.ndarray, real: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over real positions, and its gradients in the order
    ahead, back, out, bias."""
    keep = ([], [])
    states, p = probabilities(m, x, real, keep)
    n = max(real.sum(), 1)
    picked = np.take_along_axis(p, np.broadcast_to(y[None, :, None], (*x.shape, 1)), 2)[..., 0]
    loss = float(-(np.log(picked + 1e-12) * real).sum() / n)
    d = p.copy()
    np.put_along_axis(d, np.broadcast_to(y[None, :, None], (*x.shape, 1)), (picked - 1)[..., None], 2)
    d *= (real / n)[..., None]
    flat, d_flat = states.reshape(-1, states.shape[2]), d.reshape(-1, d.shape[2])
    d_states = (d_flat @ m.out.T).reshape(states.shape)
    size = m.ahead.u_cand.shape[0]
    g_ahead = back_cell(m.ahead, x, real, keep[0], d_states[:, :, :size])
    g_back = back_cell(m.back, x[::-1], real[::-1], keep[1], d_states[::-1, :, size:])
    return loss, [*g_ahead, *g_back, flat.T @ d_flat, d_flat.sum(0)]


def train(blocks: np.ndarray, real: np.ndarray, labels: np.ndarray, langs: list[str], steps: int = 250,
          batch: int = 256, rate: float = 0.02, hidden: int = HIDDEN, seed: int = 7) -> Model:
    """A model from byte blocks (N, BLOCK), their padding masks and label
    numbers, by Adam with a falling rate; languages are drawn evenly."""
    rnd = np.random.default_rng(seed)
    m = new_model(langs, hidden, rnd)
    params = [*m.ahead, *m.back, m.out, m.bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    by_lang = [np.flatnonzero(labels == k) for k in range(len(langs))]
    by_lang = [b for b in by_lang if len(b)]
    for step in range(1, steps + 1):
        pick = np.concatenate([rnd.choice(b, -(-batch // len(by_lang))) for b in by_lang])
        x, mask = np.ascontiguousarray(blocks[pick].T), np.ascontiguousarray(real[pick].T)
        _, grads = gradients(m, x, mask, labels[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        scale = min(1.0, 1.0 / max(norm, 1e-9))
        now = rate * (1 - step / (steps + 1))
        for p, g, a, b in zip(params, grads, first, second):
            g = g * scale
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= (now * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return m


# ---------------------------------------------------------------------------
# texts
# ---------------------------------------------------------------------------

def to_blocks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks (N, BLOCK), masks (N, BLOCK) and the text number of each block."""
    counts = np.array([-(-len(t) // BLOCK) for t in texts], np.int64)
    total = int(counts.sum())
    flat, mask = np.zeros(total * BLOCK, np.uint8), np.zeros(total * BLOCK, np.float32)
    at = 0
    for t, c in zip(texts, counts.tolist()):
        flat[at:at + len(t)] = np.frombuffer(t, np.uint8)
        mask[at:at + len(t)] = 1
        at += c * BLOCK
    return flat.reshape(-1, BLOCK), mask.reshape(-1, BLOCK), np.repeat(np.arange(len(texts)), counts)


def label(m: Model, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Per text: mean label probabilities (N, K) over all bytes, and the
    number of positions labelled with each language (N, K)."""
    blocks, mask, of = to_blocks(texts)
    k = len(m.langs)
    pooled, votes = np.zeros((len(texts), k)), np.zeros((len(texts), k), np.int64)
    for lo in range(0, len(blocks), BLOCKS_AT_ONCE):
        part = slice(lo, lo + BLOCKS_AT_ONCE)
        real = np.ascontiguousarray(mask[part].T)
        _, p = probabilities(m, np.ascontiguousarray(blocks[part].T), real)
        best = p.argmax(2)
        p *= real[..., None]
        sums = p.sum(0)
        for j in range(k):
            pooled[:, j] += np.bincount(of[part], sums[:, j], len(texts))
            votes[:, j] += np.bincount(of[part], ((best == j) * real).sum(0), len(texts)).astype(np.int64)
    return pooled / np.maximum([[len(t)] for t in texts], 1), votes


def training_sample(df: DataFrame, docs_per_lang: int, blocks_per_doc: int) -> list[tuple[str, bytes]]:
    """(lang, block) pairs of a bounded sample of ``df`` (id, text, lang): at
    most ``docs_per_lang`` documents with letters a language, spread blocks of each."""
    ship_by_value(__name__)
    rank = F.xxhash64(F.col("id").cast("string"))
    known = df.where(F.col("lang").isNotNull() & F.col("text").rlike(LETTER.pattern))
    # ids only, and rows that repeat an id are one document
    ids = cut(known.select("lang", "id").distinct())
    counts = cut(ids.groupBy("lang").agg(F.count("*").alias("n")))
    # a first cut by hash leaves about twice the sample, so that the ranking is over bounded rows
    share = F.least(F.lit(1.0), F.lit(2.0 * docs_per_lang) / F.col("n"))
    near = join_small(ids, counts, "lang").where(
        F.pmod(rank, F.lit(1 << 20)) < F.ceil(share * (1 << 20))).select("lang", "id")
    order = Window.partitionBy("lang").orderBy(rank, "id")
    chosen = cut(near.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= docs_per_lang)
                 .select("lang", "id").withColumnRenamed("lang", "chosen_lang"))
    kept = (join_small(known, chosen, "id").where("lang = chosen_lang")
            .groupBy("lang", "id").agg(F.min("text").alias("text")))

    def run(batches):
        for b in batches:
            langs, parts = [], []
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not LETTER.search(text):
                    continue
                data = text.encode()
                last = max(len(data) - BLOCK, 0)
                for at in dict.fromkeys(np.linspace(0, last, blocks_per_doc).astype(int).tolist()):
                    langs.append(lang)
                    parts.append(data[at:at + BLOCK])
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(parts, pa.binary())],
                                             names=["lang", "block"])

    rows = kept.select("lang", "text").mapInArrow(run, "lang string, block binary").collect()
    return sorted((r.lang, bytes(r.block)) for r in rows)


def learn(df: DataFrame, docs_per_lang: int = DOCS_PER_LANG, blocks_per_doc: int = BLOCKS_PER_DOC) -> Model | None:
    """A model from labelled rows (id, text, lang); None if there are none."""
    sample = training_sample(df, docs_per_lang, blocks_per_doc)
    if not sample:
        return None
    langs = sorted({s[0] for s in sample})
    blocks, real, of = to_blocks([s[1] for s in sample])
    number = {name: k for k, name in enumerate(langs)}
    return train(blocks, real, np.array([number[sample[i][0]] for i in of]), langs)


def predict(df: DataFrame, model: Model | None, text: Column | str) -> DataFrame:
    """``df`` plus ``__lang_pred``, ``__score`` (pooled probability of it) and
    ``__lang_share`` (share of positions labelled with it).  ``text`` is a
    column, or the name of one of ``df``, which is then sent to the workers once.

    Null texts and texts without a letter are ``und`` with score 0, and so
    is everything if there was nothing to learn from.  Ties go to the first
    language by code point.  Whole texts are read, whatever their length;
    repeated rows get equal results; other columns are carried along
    whatever their names.  An empty table gives an empty result.
    """
    ship_by_value(__name__)
    named = isinstance(text, str)
    inp = df if named else df.select("*", text.alias("__text"))
    n_cols = len(df.columns)
    at = df.columns.index(text) if named else n_cols
    out = T.StructType([*inp.schema.fields[:n_cols],
        T.StructField("__lang_pred", T.StringType()), T.StructField("__score", T.DoubleType()),
        T.StructField("__lang_share", T.DoubleType())])

    def run(batches):
        for b in batches:
            names, scores, shares = [UNDETERMINED] * b.num_rows, np.zeros(b.num_rows), np.zeros(b.num_rows)
            group, size = [], 0

            def flush():
                if group:
                    p, votes = label(model, [g[1] for g in group])
                    best = p.argmax(1)
                    for (r, data), k, probs, v in zip(group, best, p, votes):
                        names[r], scores[r], shares[r] = model.langs[k], min(probs[k], 1.0), v[k] / len(data)
                    group.clear()

            for r, t in enumerate(b.column(at)):
                t = t.as_py()
                if model is None or t is None or not LETTER.search(t):
                    continue
                group.append((r, t.encode()))
                size += len(group[-1][1])
                if size >= BYTES_AT_ONCE:
                    flush()
                    size = 0
            flush()
            yield pa.RecordBatch.from_arrays([*b.columns[:n_cols], pa.array(names, pa.string()), pa.array(scores),
                                              pa.array(shares)], names=out.names)
        pa.default_memory_pool().release_unused()  # the worker goes on to other stages

    return inp.mapInArrow(run, out)


def held_out(id_col: Column) -> Column:
    """Documents that nothing is learnt from: crc32 of the id's text is 2 modulo 4."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def learn_from_open(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """A model from the labelled rows of ``df`` that are not held out."""
    return learn(df.where(~held_out(F.col(id_col)) & F.col(id_col).isNotNull())
                 .select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")))
