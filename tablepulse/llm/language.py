"""Language identification by string kernels.

A text is the set of its byte n-grams of 1 to 4 (a blended spectrum), hashed to
``FEATURES`` places. The kernel of two texts is the size of the intersection of
their sets over the geometric mean of the sizes. Landmark texts give the Nyström
features of a text: its kernel values with the landmarks times the inverse root
of the landmarks' own kernel matrix. On these features one ridge regression for
each language tells it from the rest; the largest of the outputs wins.

All of it is linear in the text's presence vector, so landmarks, whitening and
ridge weights are folded to one matrix, and a batch is scored by one product of
its presence matrix with it.

The fit uses a bounded sample: ``FIT_ROWS`` labelled rows in all, shared evenly
by the languages (but 8 of each at least), of which up to ``LANDMARKS`` are
landmarks. Every text is read whole, both in the fit and in the prediction;
there is no shuffle of texts.

Defined cases: a null text or one without a letter is ``und`` with score 0; so
is every text when there is nothing to learn from. Rows with null ``lang`` are
predicted but not learned from; a null id counts as held out. Ties between
languages go to the first by code point. Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablepulse.llm.common import class_sample, held_out, small_batches

ORDERS = 4
FEATURE_BITS = 14
FEATURES = 1 << FEATURE_BITS
FIT_ROWS = 1600
LANDMARKS = 256
RIDGE = 1e-2
#: odd multipliers that spread the n-grams of each order over the places
SPREAD = (2654435761, 2246822519, 3266489917, 668265263)
#: bytes of a text handled at once
SLICE = 1 << 20
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # FEATURES x languages


def presence(texts: list[str]) -> np.ndarray:
    """A row of zeros and ones for each text."""
    out = np.zeros((len(texts), FEATURES), np.uint8)
    for row, text in zip(out, texts, strict=True):
        data = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
        for start in range(0, len(data), SLICE):
            part = data[start : start + SLICE + ORDERS - 1].astype(np.uint32)
            gram = part
            for n in range(ORDERS):
                if n:
                    gram = (gram[:-1] << np.uint32(8)) | part[n:]
                row[(gram * np.uint32(SPREAD[n])) >> np.uint32(32 - FEATURE_BITS)] = 1
    return out


def fit(languages: list[str], label: np.ndarray, x: np.ndarray, rank: np.ndarray, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> LanguageModel:
    """Nyström features on landmarks and one-versus-rest kernel ridge regression, folded to one matrix."""
    x = x.astype(np.float32)
    x /= np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
    # the first by rank of each language in turn
    marks = x[np.lexsort((label, rank))[:landmarks]]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    held = values > 1e-6 * values.max()
    whiten = vectors[:, held] / np.sqrt(values[held])
    phi = (x @ marks.T).astype(np.float64) @ whiten
    wanted = np.where(label[:, None] == np.arange(len(languages)), 1.0, -1.0)
    beta = np.linalg.solve(phi.T @ phi + ridge * len(x) * np.eye(phi.shape[1]), phi.T @ wanted)
    return LanguageModel(languages, (marks.T.astype(np.float64) @ (whiten @ beta)).astype(np.float32))


def scores(model: LanguageModel, texts: list[str]) -> np.ndarray:
    x = presence(texts).astype(np.float32)
    sizes = np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
    return (x @ model.weights) / sizes


def train(docs: DataFrame, fit_rows: int = FIT_ROWS, landmarks: int = LANDMARKS) -> LanguageModel | None:
    """Learn from a bounded sample of the rows with text and lang that are not held out."""
    labelled = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    languages = sorted(r[0] for r in labelled.select("lang").distinct().collect())
    if not languages:
        return None
    per_class = max(8, fit_rows // len(languages))
    # rows are told apart by id and text, and equal ones count once: the sample is bounded however often an id repeats
    labelled = labelled.withColumn("_text", F.xxhash64("text"))
    keys = ["doc_id", "lang", "_text"]
    picked = class_sample(labelled.select(*keys).distinct(), "lang", F.struct("doc_id", "_text"), per_class)
    equal = labelled.join(F.broadcast(picked.select(*keys, "rank")), keys)
    sample = equal.groupBy(*keys, "rank").agg(F.first("text").alias("text"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                bits = np.packbits(presence(part.column("text").to_pylist()), axis=1)
                yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("rank"), pa.array([b.tobytes() for b in bits], pa.binary())], ["lang", "rank", "bits"])

    # at most max(fit_rows, 8 x languages) rows of 2 KB
    rows = sorted((r["lang"], r["rank"], bytes(r["bits"])) for r in sample.select("lang", "rank", "text").mapInArrow(packed, "lang string, rank int, bits binary").collect())
    x = np.unpackbits(np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(len(rows), -1), axis=1)
    place = {name: i for i, name in enumerate(languages)}
    return fit(languages, np.array([place[r[0]] for r in rows]), x, np.array([r[1] for r in rows]), landmarks)


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every whole text."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("text"))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in small_batches(batches, "text"):
            for i in range(0, whole.num_rows, 256):
                batch = whole.slice(i, 256)
                texts = batch.column("text").to_pylist()
                f = scores(model, [t or "" for t in texts])
                best = f.argmax(axis=1)
                sure = np.clip((f[np.arange(len(f)), best] + 1) / 2, 0, 1).astype(float)
                known = [t is not None for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("held_out"),
                        pa.array([model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], pa.string()),
                        pa.array(np.where(known, sure, 0.0)),
                    ],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    id_type = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {id_type}, held_out boolean, lang_pred string, score double")
