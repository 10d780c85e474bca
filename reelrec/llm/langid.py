"""Language ID with a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a text in both directions, labels every byte position with a
probability per language, and the document's probabilities are the mean over its positions.  It is
trained in numpy, by backpropagation through time on windows of ``TRAIN_STEPS`` bytes with the loss
taken at every position.

Training data: of each language at most ``PER_LANGUAGE`` labelled documents outside the held-out fold
(by a hash of the id), one passage of ``PASSAGE`` characters each.  That bound is the only sample; every
position of every document is labelled.

A task handles windows of ``STEPS`` bytes of many documents as one batch; a text of any length is
taken ``BATCH`` windows at a time, so memory is bounded.  Nothing is shuffled but the sample, and what
is broadcast is the network (about 60 KB).

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every text if
there is no labelled document to learn from; ties go to the first language by code point; a null id is in no
fold, so it is never learnt from and not held out; repeated rows have the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelrec.llm.common import by_value, table, trimmed

by_value(__name__)

HIDDEN = 8
TRAIN_STEPS = 64
EPOCH_STEPS = 260            # gradient steps
TRAIN_BATCH = 192
RATE = 0.02
PER_LANGUAGE = 500
PASSAGE = 600
STEPS = 192
BATCH = 1024
SEED = 5
UND = "und"
HELD_OUT = 2


# --- the network -------------------------------------------------------------------------------

def new_network(languages: int, hidden: int = HIDDEN, seed: int = SEED) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    f = lambda *s, scale: (rng.standard_normal(s) * scale).astype(np.float32)
    net = {"out_bias": np.zeros(languages, dtype=np.float32)}
    for d in ("fwd", "bwd"):
        net |= {f"{d}_in": f(256, 3 * hidden, scale=0.3), f"{d}_rec": f(hidden, 3 * hidden, scale=hidden**-0.5),
                f"{d}_cand": np.zeros(hidden, dtype=np.float32), f"{d}_out": f(hidden, languages, scale=0.3)}
    return net


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _gru(net: dict, d: str, data: np.ndarray, keep: list | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """States of one direction over ``data`` (steps, batch); ``keep`` collects what the gradient needs."""
    hidden = len(net[f"{d}_cand"])
    table, rec, cand = net[f"{d}_in"], net[f"{d}_rec"], net[f"{d}_cand"]
    h = np.zeros((data.shape[1], hidden), dtype=np.float32)
    times = range(len(data)) if d == "fwd" else range(len(data) - 1, -1, -1)
    for t in times:
        x, u = table[data[t]], h @ rec
        gates = _sigmoid(x[:, :2 * hidden] + u[:, :2 * hidden])
        z, r = gates[:, :hidden], gates[:, hidden:]
        q = u[:, 2 * hidden:] + cand
        n = np.tanh(x[:, 2 * hidden:] + r * q)
        new = n + z * (h - n)
        if keep is not None:
            keep.append((t, h, z, r, q, n))
        h = new
        yield t, h


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def gradients(net: dict, data: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, dict]:
    """Loss and gradients by backpropagation through time; ``weight`` (steps, batch) is 0 beyond a text."""
    steps, batch = data.shape
    hidden = len(net["fwd_cand"])
    states, kept = {}, {"fwd": [], "bwd": []}
    for d in kept:
        states[d] = np.zeros((steps, batch, hidden), dtype=np.float32)
        for t, h in _gru(net, d, data, kept[d]):
            states[d][t] = h
    p = _softmax(states["fwd"] @ net["fwd_out"] + states["bwd"] @ net["bwd_out"] + net["out_bias"])
    total = weight.sum()
    loss = float(-(np.log(p[:, np.arange(batch), label] + 1e-9) * weight).sum() / total)
    p[:, np.arange(batch), label] -= 1
    p *= (weight / total)[:, :, None]
    grad = {"out_bias": p.sum(axis=(0, 1))}
    for d in kept:
        grad[f"{d}_out"] = np.einsum("tbh,tbk->hk", states[d], p)
        g_in, g_rec = np.zeros_like(net[f"{d}_in"]), np.zeros_like(net[f"{d}_rec"])
        g_cand = np.zeros_like(net[f"{d}_cand"])
        carry = np.zeros((batch, hidden), dtype=np.float32)
        dh_all = p @ net[f"{d}_out"].T
        for t, before, z, r, q, n in reversed(kept[d]):
            dh = dh_all[t] + carry
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (before - n) * z * (1 - z)
            dr = dn * q * r * (1 - r)
            dq = dn * r
            rec = np.concatenate([dz, dr, dq], axis=1)
            np.add.at(g_in, data[t], np.concatenate([dz, dr, dn], axis=1))
            g_rec += before.T @ rec
            g_cand += dq.sum(axis=0)
            carry = dh * z + rec @ net[f"{d}_rec"].T
        grad |= {f"{d}_in": g_in, f"{d}_rec": g_rec, f"{d}_cand": g_cand}
    return loss, grad


def train(passages: list[tuple[bytes, int]], languages: int, steps: int = EPOCH_STEPS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Adam on random windows of the passages, the languages in equal parts."""
    rng = np.random.default_rng(seed)
    net = new_network(languages, seed=seed)
    by = [[b for b, k in passages if k == lang and b] for lang in range(languages)]
    m = {k: np.zeros_like(v) for k, v in net.items()}
    v = {k: np.zeros_like(x) for k, x in net.items()}
    for step in range(1, steps + 1):
        label = ((step - 1) * TRAIN_BATCH + np.arange(TRAIN_BATCH)) % languages
        data = np.full((TRAIN_STEPS, TRAIN_BATCH), 32, dtype=np.uint8)
        weight = np.zeros((TRAIN_STEPS, TRAIN_BATCH), dtype=np.float32)
        for k, lang in enumerate(label):
            b = by[lang][rng.integers(len(by[lang]))]
            at = int(rng.integers(max(1, len(b) - TRAIN_STEPS + 1)))
            piece = np.frombuffer(b[at:at + TRAIN_STEPS], dtype=np.uint8)
            data[:len(piece), k], weight[:len(piece), k] = piece, 1
        _, grad = gradients(net, data, label, weight)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        rate = RATE * min(1.0, 2.0 - 2.0 * step / steps + 0.05) * min(1.0, 1.0 / max(norm, 1e-6))
        for k, g in grad.items():
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            net[k] = (net[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def _ready(net: dict) -> dict:
    """Weights with a row per unit (fast for large batches); the gates' are halved, as
    sigmoid(x) = tanh(x / 2) / 2 + 1 / 2."""
    hidden = len(net["fwd_cand"])
    half = np.where(np.arange(3 * hidden) < 2 * hidden, 0.5, 1.0).astype(np.float32)
    out = {"out_bias": net["out_bias"][:, None]}
    for d in ("fwd", "bwd"):
        out |= {f"{d}_in": np.ascontiguousarray((net[f"{d}_in"] * half).T), f"{d}_rec": np.ascontiguousarray((net[f"{d}_rec"] * half).T),
                f"{d}_cand": net[f"{d}_cand"][:, None], f"{d}_out": np.ascontiguousarray(net[f"{d}_out"].T)}
    return out


def _advance(net: dict, d: str, data: np.ndarray, h: np.ndarray) -> np.ndarray:
    """States (units, batch) one byte on."""
    hidden = len(h)
    x = np.take(net[f"{d}_in"], data, axis=1)
    u = net[f"{d}_rec"] @ h
    g = np.tanh(x[:2 * hidden] + u[:2 * hidden])
    g *= 0.5
    g += 0.5
    n = u[2 * hidden:] + net[f"{d}_cand"]
    n *= g[hidden:]
    n += x[2 * hidden:]
    np.tanh(n, out=n)
    out = h - n
    out *= g[:hidden]
    out += n
    return out


def position_probabilities(net: dict, data: np.ndarray, length: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``(step, probabilities)`` of the windows in the columns of ``data``, longest first; the
    probabilities (languages, windows) are those of the windows that reach this step.  ``net`` is
    made ready.  A window joins the backward pass at its own last byte, so padding has no effect."""
    hidden = len(net["fwd_cand"])
    live = np.searchsorted(-length, -np.arange(len(data)), "left")     # windows longer than t
    states = np.empty((len(data), hidden, data.shape[1]), dtype=np.float32)
    h = np.zeros((hidden, data.shape[1]), dtype=np.float32)
    for t in range(len(data)):
        h = states[t] = _advance(net, "fwd", data[t], h)
    h = np.zeros((hidden, 0), dtype=np.float32)
    for t in range(len(data) - 1, -1, -1):
        if live[t] > h.shape[1]:
            h = np.concatenate([h, np.zeros((hidden, live[t] - h.shape[1]), dtype=np.float32)], axis=1)
        h = _advance(net, "bwd", data[t, :live[t]], h)
        p = net["fwd_out"] @ states[t][:, :live[t]] + net["bwd_out"] @ h + net["out_bias"]
        p -= p.max(axis=0)
        np.exp(p, out=p)
        p /= p.sum(axis=0)
        yield t, p


def pooled(net: dict, texts: list[bytes]) -> np.ndarray:
    """Mean probabilities of each text over all its positions; zeros for an empty one."""
    k = len(net["out_bias"])
    ready = _ready(net)
    sums, sizes = np.zeros((len(texts), k)), np.array([len(b) for b in texts])
    todo = [(i, at) for i, n in enumerate(sizes) for at in range(0, n, STEPS)]
    todo.sort(key=lambda x: -min(STEPS, sizes[x[0]] - x[1]))
    for first in range(0, len(todo), BATCH):
        part = todo[first:first + BATCH]
        owner = np.array([i for i, _ in part])
        length = np.array([min(STEPS, sizes[i] - at) for i, at in part])
        data = np.zeros((len(part), int(length[0])), dtype=np.uint8)
        for row, ((i, at), n) in enumerate(zip(part, length)):
            data[row, :n] = np.frombuffer(texts[i], dtype=np.uint8, count=n, offset=at)
        window = np.zeros((k, len(part)), dtype=np.float64)
        for _, p in position_probabilities(ready, np.ascontiguousarray(data.T), length):
            window[:, :p.shape[1]] += p
        np.add.at(sums, owner, window.T)
    return sums / np.maximum(sizes, 1)[:, None]


# --- Spark ----------------------------------------------------------------------------------------

def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def training_passages(docs: DataFrame, per_language: int = PER_LANGUAGE) -> list[tuple[bytes, str]]:
    """A passage of up to ``per_language`` documents of each language outside the held-out fold."""
    d = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
                   & ~held_out(F.col("doc_id")))
    share = d.groupBy("lang").agg((F.lit(2.0 * per_language) / F.count(F.lit(1))).alias("_share"))
    key = F.xxhash64("doc_id", F.lit(SEED))
    d = d.join(F.broadcast(share), "lang").withColumn("_k", key)            # a row per language
    d = d.where(F.pmod("_k", F.lit(1 << 30)) < F.col("_share") * (1 << 30))
    room = F.greatest(F.length("text") - PASSAGE, F.lit(0)) + 1
    d = d.select("lang", "_k", F.substr("text", (F.pmod(F.xxhash64("_k"), room) + 1).cast("int"), F.lit(PASSAGE)).alias("_t"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_k", "_t"))
    rows = d.withColumn("_r", rank).where(F.col("_r") <= per_language).orderBy("lang", "_k", "_t").collect()
    return [(r["_t"].encode(), r["lang"]) for r in rows]


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[dict, list[str]] | None:
    """The network and its languages, in code point order; None if there is nothing to learn from."""
    found = [(b, lang) for b, lang in training_passages(docs.select("doc_id", "text", "lang"), per_language) if b]
    names = sorted({lang for _, lang in found})
    if not names:
        return None
    return train([(b, names.index(lang)) for b, lang in found], len(names)), names


def _judged(net, names, batch: pa.RecordBatch) -> tuple[list[str], list[float]]:
    """Language and score of each row of a batch with ``text`` and ``lettered``."""
    text, lettered = batch.column("text"), batch.column("lettered").to_pylist()
    best, score, group, size = [UND] * len(text), [0.0] * len(text), [], 0

    def flush():
        p = pooled(net, [b for _, b in group])
        for (i, _), row in zip(group, p):
            k = int(row.argmax())
            best[i], score[i] = names[k], min(1.0, max(0.0, float(row[k])))

    for i, value in enumerate(text):
        if not lettered[i]:
            continue
        group.append((i, value.as_buffer().to_pybytes()))
        size += len(group[-1][1])
        if size >= 4 * STEPS * BATCH:
            flush()
            group, size = [], 0
    if group:
        flush()
    return best, score


def _label_task(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score = _judged(*model.value, batch)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(best, pa.string()), pa.array(score, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])
    return run


def _keep_task(model, clear: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score = _judged(*model.value, batch)
            keep = [b != UND and s >= clear for b, s in zip(best, score)]
            yield batch.drop_columns(["lettered"]).filter(pa.array(keep, pa.bool_()))
    return run


def _lettered(docs: DataFrame):
    return F.coalesce(docs["text"].rlike(r"\p{L}"), F.lit(False)).alias("lettered")


def keep(docs: DataFrame, model: tuple[dict, list[str]] | None, clear: float) -> DataFrame:
    """The rows of ``docs`` whose language is not ``und`` and has a score of at least ``clear``."""
    if model is None:
        return docs.where(F.lit(False))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("*", _lettered(docs)).mapInArrow(trimmed(_keep_task(sent, clear)), docs.schema)


def classify(docs: DataFrame, model: tuple[dict, list[str]] | None) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, lang_pred, score`` for every row."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _lettered(docs), "text")
    if model is None:
        return d.select("doc_id", F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return d.mapInArrow(trimmed(_label_task(sent)), "doc_id long, lang_pred string, score double")


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = classify(docs, fit(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
