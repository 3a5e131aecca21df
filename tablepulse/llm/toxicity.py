"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (3 to 5 bytes of its lower-case
form, with a mark at its ends), hashed to ``BUCKETS``. Each bucket has an
embedding; a document is the average of the embeddings of all its different
n-grams (a repeated word counts once, so that junk of repeated words is no
louder than prose), and a linear layer with softmax on two classes reads it. Embeddings and layer are
trained together by gradient descent (Adam) in numpy, so a misspelling that was
never seen is judged by the n-grams that it shares with known words.

The fit uses a bounded sample of labelled rows: at most ``FIT_ROWS`` of each
class, chosen by hash among the rows that are not held out. Only the sample's
bags reach the driver. Every text is read whole. As an average followed
by a linear layer is linear in the bag, the trained layers are folded to one
weight for each bucket before scoring, which gives the same softmax.

Defined cases: a text without n-grams (null, empty) has the average 0 and the
score of the bias; without labels of both classes every score is the share of
class 1 (0 without labels). Null labels are not learned from; an id with several
labels counts as toxic if one of them says so; a null id counts as held out.
Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablepulse.llm.common import class_sample, held_out, small_batches

SHORTEST, LONGEST = 3, 5
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
DIMENSIONS = 8
FIT_ROWS = 2500
#: steps of training, whatever the size of the sample: small samples get more epochs
STEPS = 940
BATCH = 64
RATE = 0.01
DECAY = 1e-5
#: the averages are small numbers; the layer reads them times this
GAIN = 30.0
SEED = 17
SLICE = 1 << 20
#: ASCII white space
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray | None  # of each bucket; None: nothing to tell apart
    bias: float


def buckets(text: str) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of a text, in parts."""
    data = np.frombuffer(b" " + text.lower().encode("utf-8", "replace") + b" ", np.uint8)
    for start in range(0, len(data) - 1, SLICE):
        part = data[start : start + SLICE + LONGEST - 1]
        space = SPACES[part]
        code = np.where(space, np.uint32(32), part).astype(np.uint32)
        own = len(part) if start + len(part) >= len(data) else SLICE
        gram = code[:-1] * np.uint32(0x01000193) ^ code[1:]
        inside = np.ones(len(gram), bool)
        for n in range(3, LONGEST + 1):
            # an n-gram may begin or end with a word's end, but not run across it
            gram = gram[:-1] * np.uint32(0x01000193) ^ code[n - 1 :]
            inside = inside[: len(gram)] & ~space[n - 2 : n - 2 + len(gram)]
            if n >= SHORTEST:
                found = gram[:own][inside[:own]]
                yield ((found ^ (found >> np.uint32(15))) * np.uint32(2246822519)) >> np.uint32(32 - BUCKET_BITS)


def bag(text: str) -> np.ndarray:
    """The distinct buckets of a text."""
    seen = np.zeros(BUCKETS, bool)
    for part in buckets(text):
        seen[part] = True
    return np.flatnonzero(seen)


def fit(bags: list[np.ndarray], label: np.ndarray, steps: int = STEPS) -> ToxicityModel:
    """Train embeddings and softmax layer together."""
    if len(set(label.tolist())) < 2:
        return ToxicityModel(None, float(label.mean()) if len(label) else 0.0)
    rng = np.random.default_rng(SEED)
    layers = {
        "embedding": rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32),
        "layer": rng.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32),
        "bias": np.zeros(2, np.float32),
    }
    first = {k: np.zeros_like(v) for k, v in layers.items()}
    second = {k: np.zeros_like(v) for k, v in layers.items()}
    # the classes weigh the same in the sum of losses
    weight = np.where(label == 1, 0.5 / max(1, (label == 1).sum()), 0.5 / max(1, (label == 0).sum())) * len(label)
    step = 0
    x = np.zeros((BATCH, BUCKETS), np.float32)
    for _ in range(-(-steps // -(-len(bags) // BATCH))):
        order = rng.permutation(len(bags))
        for start in range(0, len(order), BATCH):
            rows = order[start : start + BATCH]
            x[:] = 0
            for k, i in enumerate(rows):
                x[k, bags[i]] = 1 / max(1, len(bags[i]))
            used = x[: len(rows)]
            hidden = used @ layers["embedding"] * GAIN
            logits = hidden @ layers["layer"] + layers["bias"]
            logits -= logits.max(axis=1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), label[rows]] -= 1
            off = (p * weight[rows, None] / len(rows)).astype(np.float32)
            slopes = {
                "embedding": GAIN * (used.T @ (off @ layers["layer"].T)) + DECAY * layers["embedding"],
                "layer": hidden.T @ off + DECAY * layers["layer"],
                "bias": off.sum(axis=0),
            }
            step += 1
            for k, g in slopes.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                layers[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    toward = layers["layer"][:, 1] - layers["layer"][:, 0]
    return ToxicityModel(GAIN * (layers["embedding"] @ toward), float(layers["bias"][1] - layers["bias"][0]))


def score(model: ToxicityModel, text: str) -> float:
    """Probability of class 1 by the folded softmax."""
    if model.weights is None:
        return model.bias
    found = bag(text)
    mean = float(model.weights[found].sum(dtype=np.float64)) / max(1, len(found))
    return float(1 / (1 + np.exp(-np.clip(mean + model.bias, -700, 700))))


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> ToxicityModel:
    """Learn from a bounded sample of the labelled rows that are not held out."""
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    picked = class_sample(known, "toxic", F.col("doc_id"), fit_rows).select(F.col("doc_id").alias("_id"), "toxic")
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_id"))
    # of an id's texts one, by an aggregation: a task brings one row of an id, however often it repeats
    one = F.min_by(F.coalesce("text", F.lit("")), F.xxhash64("text"))
    rows = rows.groupBy("doc_id", "toxic").agg(one.alias("text"))

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            found = [bag(t).astype(np.uint16).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(found, pa.binary())], ["doc_id", "toxic", "bag"])

    # bounded: 2 x fit_rows bags of at most BUCKETS entries
    sample = rows.mapInArrow(bags, f"doc_id {dict(docs.dtypes)['doc_id']}, toxic int, bag binary").collect()
    sample.sort(key=lambda r: r["doc_id"])
    return fit([np.frombuffer(r["bag"], np.uint16) for r in sample], np.array([r["toxic"] for r in sample], int))


def scored(docs: DataFrame, model: ToxicityModel, name: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text in column ``name`` added."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            values = [score(shared.value, t or "") for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], [*batch.schema.names, name])

    return docs.mapInArrow(run, ", ".join([*(f"`{n}` {t}" for n, t in docs.dtypes), f"`{name}` double"]))


def judged(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    found = scored(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The documents that are not rejected (score below 0.5), with all their columns."""
    found = scored(docs, model, "__toxic_score")
    return found.where(F.col("__toxic_score") < 0.5).select(*docs.columns)
