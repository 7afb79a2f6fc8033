"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages, windows of a fixed number of bytes over its whole text. Each passage is described by shares of
byte classes and of adjacent class pairs, the diversity of its byte 4-grams and its length, and encoded by one tanh layer.
Gated attention, softmax over w . (tanh(V h) * sigmoid(U h)), weighs the passages, and a logistic unit scores the weighted
representation. All weights are learned together from document labels, by Adam, on at most `sample` labelled documents (those
with the smallest hash of their id, one text of each) and a bounded number of passages of each; scoring reads every text whole. Labels,
language, source and id never enter a score.

Defined results: null text counts as empty; an empty text is one passage without bytes and gets a score like any other. Labels
that are null, other than 0 and 1 or contradictory for one id are not learned from. Without labels of both classes every score
is the share of label 1 among those learned from (0.5 without any). Other columns of the input are not read. An empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import arrow, raw_texts, table

PASSAGE_BYTES = 512
#: Labelled documents that the classifier is fitted on, at most.
SAMPLE = 6000
#: Passages of a document that it is fitted on, at most.
FIT_PASSAGES = 64
THRESHOLD = 0.3
HIDDEN, ATTENTION = 24, 12
EPOCHS, RATE, BATCH_BAGS, SEED = 40, 0.01, 256, 7

# Byte classes: lower, upper, digit, blank, line end, sentence mark, comma, quote or bracket, beyond ASCII, and single symbols.
_GROUPS = [
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\r\n", b".?;:", b",", b"'\"()[]{}-/@_=+",
    bytes(range(128, 256)), b"!", b"|", b"#$%&*",
]
CLASSES = len(_GROUPS) + 1
_CLASS_OF = np.full(256, CLASSES - 1, np.int64)
for _number, _group in enumerate(_GROUPS):
    _CLASS_OF[list(_group)] = _number
_BUCKETS = 256
FEATURES = CLASSES + CLASSES * CLASSES + 2


def passages(texts: list[bytes], size: int = PASSAGE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, in order, and the number of passages of each text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = np.maximum(1, -(-lengths // size))
    spans = np.full(counts.sum(), size, np.int64)
    last = np.cumsum(counts) - 1
    spans[last] = lengths - (counts - 1) * size
    total, n = len(spans), np.maximum(spans, 1)[:, None]
    data = np.frombuffer(b"".join(texts), np.uint8)
    owner, kind = np.repeat(np.arange(total), spans), _CLASS_OF[data]
    shares = np.bincount(owner * CLASSES + kind, minlength=total * CLASSES).reshape(total, CLASSES) / n
    inside = np.flatnonzero(owner[:-1] == owner[1:])
    pairs = owner[inside] * CLASSES * CLASSES + kind[inside] * CLASSES + kind[inside + 1]
    pairs = np.bincount(pairs, minlength=total * CLASSES * CLASSES).reshape(total, -1) / n
    grams, place = np.zeros(max(len(data) - 3, 0), np.uint32), data.astype(np.uint32)
    for shift in range(4 if len(data) > 3 else 0):
        grams |= place[shift : len(data) - 3 + shift] << np.uint32(8 * shift)
    within = np.flatnonzero(owner[: len(grams)] == owner[3:]) if len(grams) else np.array([], np.int64)
    bucket = ((grams[within] * np.uint32(2654435761)) >> np.uint32(24)).astype(np.int64)
    seen = np.bincount(owner[within] * _BUCKETS + bucket, minlength=total * _BUCKETS).reshape(total, _BUCKETS) > 0
    diversity = seen.sum(1)[:, None] / np.minimum(n, _BUCKETS)
    return np.hstack([shares, pairs, diversity, np.log1p(spans)[:, None] / 6]).astype(np.float32), counts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _forward(model: dict, x: np.ndarray, counts: np.ndarray) -> dict:
    starts, bag = np.cumsum(counts) - counts, np.repeat(np.arange(len(counts)), counts)
    h = np.tanh(((x - model["mean"]) / model["scale"]) @ model["W"] + model["b"])
    t, g = np.tanh(h @ model["V"]), _sigmoid(h @ model["U"])
    e = (t * g) @ model["w"]
    e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
    a = e / np.add.reduceat(e, starts)[bag]
    z = np.add.reduceat(a[:, None] * h, starts)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "bag": bag, "starts": starts, "p": _sigmoid(z @ model["c"] + model["d"])}


def _gradients(model: dict, x: np.ndarray, counts: np.ndarray, y: np.ndarray) -> dict:
    f = _forward(model, x, counts)
    h, t, g, a, bag = f["h"], f["t"], f["g"], f["a"], f["bag"]
    ds = (f["p"] - y) / len(y)
    dz = (ds[:, None] * model["c"])[bag]
    da = (dz * h).sum(1)
    de = a * (da - np.add.reduceat(a * da, f["starts"])[bag])
    dtg = de[:, None] * model["w"]
    dt, dg = dtg * g * (1 - t * t), dtg * t * g * (1 - g)
    dh = (a[:, None] * dz + dt @ model["V"].T + dg @ model["U"].T) * (1 - h * h)
    scaled = (x - model["mean"]) / model["scale"]
    return {"W": scaled.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de, "c": f["z"].T @ ds, "d": ds.sum()}


def fit(bags: list[np.ndarray], labels: np.ndarray) -> dict:
    """Train on bags of passage features; a constant where labels do not have both classes."""
    if len(set(labels.tolist())) < 2:
        return {"constant": float(labels.mean()) if len(labels) else 0.5}
    rng = np.random.default_rng(SEED)
    everything = np.concatenate(bags)
    model = {"mean": everything.mean(0), "scale": everything.std(0) + 1e-3}
    shapes = {"W": (FEATURES, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, ATTENTION), "U": (HIDDEN, ATTENTION), "w": (ATTENTION,), "c": (HIDDEN,), "d": ()}
    for name, shape in shapes.items():
        model[name] = np.asarray(rng.normal(0, 1 / np.sqrt(shape[0] if shape else 1), shape) * (name not in "bd"), np.float64)
    first, second, step = {k: 0.0 for k in shapes}, {k: 0.0 for k in shapes}, 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(bags), BATCH_BAGS):
            chosen, step = order[at : at + BATCH_BAGS], step + 1
            some = [bags[i] for i in chosen]
            slopes = _gradients(model, np.concatenate(some), np.array([len(b) for b in some]), labels[chosen])
            rate = RATE * (1 - epoch / EPOCHS) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, slope in slopes.items():
                slope = slope + 1e-4 * model[k] * (k in "WVU")
                first[k], second[k] = 0.9 * first[k] + 0.1 * slope, 0.999 * second[k] + 0.001 * slope * slope
                model[k] = model[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-8)
    return model


def predict(model: dict, texts: list[bytes]) -> np.ndarray:
    if not texts:
        return np.array([])
    if "constant" in model:
        return np.full(len(texts), model["constant"])
    return _forward(model, *passages(texts))["p"]


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most_passages: int = FIT_PASSAGES) -> dict:
    """Fit on labelled documents that are not held out.

    Features of at most `sample` texts, and of at most `most_passages` passages of each, spread evenly over it, reach the driver. Of
    several texts of one id the one with the smallest hash is taken (of equal hashes the smallest text), so reruns fit on the same texts.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("y")).where("y in (0, 1)")
    known = known.where(~held_out(F.col("id"))).groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("most")).where("y = most")
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(sample).select("id", "y")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(chosen), "id")  # at most `sample` rows of two numbers
    rows = rows.groupBy("id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("one")).select("id", "y", "one.text")

    def make(batch: pa.RecordBatch) -> dict:
        x, counts = passages(raw_texts(batch))
        parts = [p[np.arange(min(len(p), most_passages)) * len(p) // min(len(p), most_passages)] for p in np.split(x, np.cumsum(counts)[:-1])]
        return {"id": batch.column("id"), "y": batch.column("y"), "x": [p.tobytes() for p in parts]}

    found = arrow(rows, make, "id long, y int, x binary").toPandas()
    found = found.sort_values("id") if len(found) else found
    return fit([np.frombuffer(x, np.float32).reshape(-1, FEATURES) for x in found.x], found.y.to_numpy(np.float64))


def scored(docs: DataFrame, model: dict) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, score."""

    def make(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "score": predict(model, raw_texts(batch))}

    return arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, "doc_id long, score double")


def keep_good(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that the classifier does not reject, with all their columns."""

    @F.pandas_udf("double")
    def score(texts):
        return _series(predict(model, [(x or "").encode() for x in texts]))

    rows = docs.select(F.struct("*").alias("row"), score(F.col("text").cast("string")).alias("score"))
    return rows.where(F.col("score") >= threshold).select("row.*")


def _series(values):
    import pandas as pd

    return pd.Series(values, dtype="float64")


def op2_quality(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = train(docs, table(spark, folder, "labels"))
    return scored(docs, model).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


QUERIES = {"op2_quality": op2_quality}
ORACLE: dict[str, str] = {}
