"""Documents dealt to shards of bounded size, and keys that shards count together.

A shard is a few megabytes of whole texts that one task holds as one byte buffer.
Shards are chosen by a hash of the id, and their rows are put in a fixed order, so
a recomputed task numbers the same rows alike and other tables can refer to a row
by ``(shard, row)``.

Keys (64-bit hashes) that all documents must count together go through buckets: a
shard sends each bucket one row with its different keys, so a key that a third of
all documents share is at most one entry per shard. A bucket answers with what it
knows of each shard's keys, by their place in what the shard sent.
"""

from __future__ import annotations

import gc
import time
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepulse.llm.common import filled, text_bytes

SHARD_BYTES = 4 << 20
#: text bytes whose keys share a bucket
BUCKET_BYTES = 8 << 20


def shard_of(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> tuple[Column, int]:
    """The shard of a document, and the bytes of all texts."""
    size = text_bytes(docs)
    return F.pmod(F.xxhash64("doc_id"), F.lit(max(1, -(-size // shard_bytes)))), size


def sharded(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, int]:
    """``shard, doc_id, text`` (bytes; null as empty) and the number of buckets for their keys."""
    shard, size = shard_of(docs, shard_bytes)
    return docs.select(shard.alias("shard"), "doc_id", filled("text").cast("binary").alias("text")), max(1, -(-size // BUCKET_BYTES))


def in_order(shard: pa.Table, text: str = "text") -> pa.Table:
    """The rows of a shard in their fixed order."""
    return shard.take(pc.sort_indices(shard, [("doc_id", "ascending"), (text, "ascending")]))


def buffer_of(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column one after the other, and where each row begins (one more than rows)."""
    array = pa.concat_arrays([c.cast(pa.large_binary()) for c in column.chunks]) if column.num_chunks else pa.array([], pa.large_binary())
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64, len(array) + 1, array.offset * 8) if len(array) else np.zeros(1, np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(at), np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (the finisher of a well-known 64-bit hash)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def by_bucket(keys: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of different sorted keys by (bucket, low 32 bits), the bounds of each bucket in it, and the low bits."""
    bucket, low = ((keys >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64), keys.astype(np.uint32)
    order = np.lexsort((low, bucket))
    return order, np.searchsorted(bucket[order], np.arange(n_buckets + 1)), low[order]


def shared_keys(texts: DataFrame, n_buckets: int, keys_of: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """shard, bucket, place, many: which of a shard's keys several documents have, and how many do.

    ``keys_of`` gives the different keys of each document of a byte buffer, and where each document's begin.
    """

    def send(shard: pa.Table) -> pa.Table:
        keys, _ = keys_of(*buffer_of(in_order(shard).column("text")))
        keys, many = np.unique(keys, return_counts=True)
        order, bounds, low = by_bucket(keys, n_buckets)
        many = many[order].astype(np.uint32)
        full = np.flatnonzero(np.diff(bounds))
        cut = [(bounds[b], bounds[b + 1]) for b in full]
        number = shard.column("shard")[0].as_py()
        return pa.table(
            {
                "bucket": pa.array(full, pa.int64()),
                "shard": pa.array([number] * len(full), pa.int64()),
                "low": pa.array([low[a:b].tobytes() for a, b in cut], pa.binary()),
                "many": pa.array([many[a:b].tobytes() for a, b in cut], pa.binary()),
            }
        )

    def count(bucket: pa.Table) -> pa.Table:
        shards = bucket.column("shard").to_pylist()
        lows = [np.frombuffer(x, np.uint32) for x in bucket.column("low").to_pylist()]
        keys, back = np.unique(np.concatenate(lows), return_inverse=True)
        each = np.concatenate([np.frombuffer(x, np.uint32) for x in bucket.column("many").to_pylist()])
        total = np.bincount(back, each, len(keys)).astype(np.uint32)[back]
        ends = np.cumsum([len(x) for x in lows])
        out = [(np.flatnonzero(part > 1).astype(np.uint32), part[part > 1]) for part in np.split(total, ends[:-1])]
        number = bucket.column("bucket")[0].as_py()
        return pa.table(
            {
                "shard": pa.array(shards, pa.int64()),
                "bucket": pa.array([number] * len(out), pa.int64()),
                "place": pa.array([p.tobytes() for p, _ in out], pa.binary()),
                "many": pa.array([m.tobytes() for _, m in out], pa.binary()),
            }
        )

    sent = texts.groupBy("shard").applyInArrow(send, "bucket long, shard long, low binary, many binary")
    return sent.groupBy("bucket").applyInArrow(count, "shard long, bucket long, place binary, many binary")


def key_counts(keys: np.ndarray, counts: pa.Table, n_buckets: int) -> np.ndarray:
    """For each of a shard's keys, in how many documents it is, from the shard's rows of ``shared_keys``. Keys whose
    buckets and low bits are the same count as one, which can only make a count too large."""
    different, back = np.unique(keys, return_inverse=True)
    order, bounds, _ = by_bucket(different, n_buckets)
    many = np.ones(len(different), np.int64)
    for bucket, place, total in zip(*(counts.column(c).to_pylist() for c in ("bucket", "place", "many")), strict=True):
        many[order[bounds[bucket] + np.frombuffer(place, np.uint32)]] = np.frombuffer(total, np.uint32)
    return many[back]


def release(spark: SparkSession) -> None:
    """Let Spark drop shuffle files of finished jobs now rather than at the driver's next full collection.

    Spark's cleaner works in the background: the pauses give it time before the next job writes.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(1)
