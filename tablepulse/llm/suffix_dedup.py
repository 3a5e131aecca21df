"""Suffix-array deduplication by external induced sorting of sampled suffixes.

Every byte is removed that is covered by a string of ``LENGTH`` bytes which also
starts in a document with a smaller id.

As in induced sorting, only a sample of the suffixes is sorted, and the others get
their place from the sampled suffix that follows them. The sample is chosen by the
text alone: of the suffixes that start in the first bytes of a string of ``LENGTH``
bytes, the one whose first ``GRAM`` bytes have the least hash. So equal strings have
their sampled suffix at the same offset, and about one suffix in fourteen is sampled.

1. Shards count the sampled grams of all documents through buckets. Where a gram is
   in one document only, none of the strings around it can repeat; what is left are
   the tuples of suffixes that may share a prefix.
2. The tuples (suffix, smallest document, the bytes that precede it) are pushed to
   buckets by gram: Spark's shuffle, which sorts and spills to disk, is the external
   priority queue, and a bucket pops all tuples of its range of grams. A bucket sorts
   its suffixes by their next ``LENGTH`` bytes and takes the common-prefix lengths of
   neighbours, and sorts the reversed preceding bytes likewise.
3. Induction: the strings that start 0, 1, 2, ... bytes before a sampled suffix are
   ranked by the pair of the prepended bytes' class and the suffix's class at the
   depth that is left; classes of any depth come from the common-prefix lengths, so
   each step only groups pairs of numbers. The smallest document of each class
   decides which of its strings are repeats.
4. The decisions return to the shards, which cut the bytes.

Contents are compared byte by byte; hashes only choose samples, candidates and
buckets. A full suffix array of all positions would need about five bytes and its
priority queues tens of bytes for each byte of text, more than the disk allowed; see
the README. A tuple that a shard repeats is sent once with its places, so the inside of
a passage of a third of all documents is one tuple per shard and sample. Tuples with
different bytes around stay apart, as at the edges of a passage or around a frequent
string of fewer than ``LENGTH`` bytes. So a gram of more than ``HOT`` documents is not
kept together: each of its strings is a tuple of its own, dealt to a bucket by all its
bytes, which decide it alone. A bucket then gets a string once from each shard.

Defined cases: a null text counts as empty; texts shorter than ``LENGTH`` bytes keep
all; null ids are larger than all others and equal to each other; rows that repeat
an id never remove from each other; an empty table gives no rows. Other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablepulse.llm.shards import buffer_of, in_order, key_counts, mixed_bits, sharded, shared_keys

LENGTH = 50
GRAM = 24
#: starts of grams in a string
STARTS = LENGTH - GRAM + 1
#: bytes before and after the start of a sampled suffix that its strings can reach
BEFORE, AFTER = STARTS - 1, LENGTH
#: strings whose samples are chosen at once, which bounds the memory that a very long text takes
SLICE = 4 << 20
#: a gram of more documents is hot: its strings are dealt one by one
HOT = 1 << 16
#: tuples whose bytes are gathered at once
TUPLES = 1 << 16
LAST_ID = np.iinfo(np.int64).max

_BYTE = mixed_bits(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEPS = mixed_bits(np.arange(11, 16, dtype=np.uint64)) | np.uint64(1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` = 24 bytes from each position."""
    x = _BYTE[data]
    x = x[:-1] * _STEPS[0] + x[1:]
    x = x[:-2] * _STEPS[1] + x[2:]
    eight = x[:-4] * _STEPS[2] + x[4:]
    x = eight[:-8] * _STEPS[3] + eight[8:]
    return mixed_bits(x[:-8] * _STEPS[4] + eight[16:])


def samples(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sampled suffixes: position, first and last start of the strings that they stand for, hash of the gram."""
    none = np.zeros(0, np.int64)
    whole = np.zeros(max(0, len(data) - LENGTH + 1), bool)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= LENGTH:
            whole[a : b - LENGTH + 1] = True
    if not whole.any():
        return none, none, none, np.zeros(0, np.uint64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for begin in range(0, len(whole), SLICE):
        on = np.flatnonzero(whole[begin : begin + SLICE])
        if not len(on):
            continue
        grams = gram_hashes(data[begin : begin + SLICE + LENGTH - 1])
        # the leftmost of the least hashes: position in the low half
        x = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        for step in (1, 2, 4, 8):
            x = np.minimum(x[:-step], x[step:])
        x = np.minimum(x[: -(STARTS - 16)], x[STARTS - 16 :])
        least = (x[on] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        found.append((on + begin, least + begin, grams[least]))
    starts, chosen, gram = (np.concatenate([f[i] for f in found]) for i in range(3))
    new = np.ones(len(starts), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(starts)) - 1
    return chosen[head], starts[head], starts[last], gram[head]


def _sample_keys(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different sampled grams of each document."""
    place, _, _, gram = samples(data, at)
    doc = np.searchsorted(at, place, "right") - 1
    order = np.lexsort((gram, doc))
    doc, gram = doc[order], gram[order]
    new = np.ones(len(gram), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1])
    return gram[new], np.searchsorted(doc[new], np.arange(len(at)))


def _around(data: np.ndarray, place: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The bytes that the strings of each sample reach, zero outside of them."""
    reach = place[:, None] + np.arange(-BEFORE, AFTER)
    inside = (reach >= first[:, None]) & (reach < last[:, None] + LENGTH)
    return np.where(inside, data[np.clip(reach, 0, max(0, len(data) - 1))], 0).astype(np.uint8)


def _tuples(shard: pa.Table, counts: pa.Table, n_buckets: int, hot: int) -> pa.Table:
    """A shard's suffix tuples: one row per bucket, with their fields as packed arrays."""
    shard = in_order(shard)
    data, at = buffer_of(shard.column("text"))
    place, first, last, gram = samples(data, at)
    many = key_counts(gram, counts, n_buckets)
    # all shards know the same number, so they agree on the hot grams
    alone, whole = np.flatnonzero(many > hot), np.flatnonzero((many > 1) & (many <= hot))
    each = last[alone] - first[alone] + 1
    start = np.arange(each.sum()) + np.repeat(first[alone] - np.cumsum(each) + each, each)
    take = np.concatenate([whole, np.repeat(alone, each)])
    place, gram = place[take], gram[take]
    first, last = np.concatenate([first[whole], start]), np.concatenate([last[whole], start])
    ids = pc.fill_null(shard.column("doc_id"), LAST_ID).to_numpy()
    doc = ids[np.searchsorted(at, place, "right") - 1]
    fewest, most = (place - last).astype(np.uint8), (place - first).astype(np.uint8)
    parts = [slice(k, k + TUPLES) for k in range(0, len(place), TUPLES)]
    # equal tuples of the shard are one, with their places; a hash finds them and the bytes confirm it
    weights = mixed_bits(np.arange(1, BEFORE + AFTER + 1, dtype=np.uint64))
    key = gram ^ (fewest.astype(np.uint64) << np.uint64(8)) ^ most.astype(np.uint64)
    for k in parts:
        key[k] ^= (_around(data, place[k], first[k], last[k]).astype(np.uint64) * weights).sum(axis=1)
    _, lead, back = np.unique(key, return_index=True, return_inverse=True)
    lead = lead[back]
    same = (fewest == fewest[lead]) & (most == most[lead]) & (gram == gram[lead])
    for k in parts:
        same[k] &= (_around(data, place[k], first[k], last[k]) == _around(data, place[lead[k]], first[lead[k]], last[lead[k]])).all(axis=1)
    lead = np.where(same, lead, np.arange(len(lead)))
    # a string alone has its bucket by all its bytes
    by = np.where(np.arange(len(key)) < len(whole), gram, mixed_bits(key))
    bucket = ((by >> np.uint64(32)) % np.uint64(n_buckets)).astype(np.int64)
    # by bucket, then tuple, then place: a tuple's places are in the order of their documents
    order = np.lexsort((place, lead, bucket))
    place_of = place
    lead, bucket, place, doc = lead[order], bucket[order], place[order], doc[order]
    head = np.flatnonzero(np.diff(lead, prepend=-1))
    total = np.diff(np.append(head, len(lead)))
    least = doc[head]
    own = np.add.reduceat((doc == np.repeat(least, total)).astype(np.int64), head) if len(head) else head
    of = lead[head]
    cut = np.searchsorted(bucket[head], np.arange(n_buckets + 1))
    full = np.flatnonzero(np.diff(cut))
    ends = np.append(head, len(lead))
    around = np.concatenate([np.zeros((0, BEFORE + AFTER), np.uint8), *(_around(data, place_of[k], first[k], last[k]) for k in (of[p] for p in parts))])

    def packed(values: np.ndarray) -> pa.Array:
        return pa.array([values[cut[b] : cut[b + 1]].tobytes() for b in full], pa.binary())

    return pa.table(
        {
            "bucket": pa.array(full, pa.int64()),
            "shard": pa.array(np.full(len(full), shard.column("shard")[0].as_py() if shard.num_rows else 0), pa.int64()),
            "doc": packed(least),
            "fewest": packed(fewest[of]),
            "most": packed(most[of]),
            "own": packed(own.astype(np.uint32)),
            "total": packed(total.astype(np.uint32)),
            "places": pa.array([place[ends[cut[b]] : ends[cut[b + 1]]].astype(np.uint32).tobytes() for b in full], pa.binary()),
            "around": packed(around),
        }
    )


def sorted_prefixes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte rows, and the length of the prefix that each shares with the one before it in that order."""
    width = -(-rows.shape[1] // 8) * 8
    words = np.zeros((len(rows), width), np.uint8)
    words[:, : rows.shape[1]] = rows
    words = words.view(">u8").astype(np.uint64)
    order = np.lexsort(words.T[::-1])
    same = rows[order[1:]] == rows[order[:-1]]
    common = np.where(same.all(axis=1), rows.shape[1], same.argmin(axis=1))
    return order, np.concatenate([[0], common])


def _classes(order: np.ndarray, common: np.ndarray, depth: int) -> np.ndarray:
    """For each row, a number that rows with an equal prefix of ``depth`` bytes share."""
    found = np.empty(len(order), np.int64)
    found[order] = np.cumsum(common < depth)
    return found


def _decide(bucket: pa.Table) -> pa.Table:
    """A bucket's tuples, popped in order: which strings also start in a smaller document. Replies to the shards."""

    def column(name: str, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(bucket.column(name).to_pylist()), kind)

    doc, fewest, most = column("doc", np.int64), column("fewest", np.uint8), column("most", np.uint8)
    around = column("around", np.uint8).reshape(len(doc), BEFORE + AFTER)
    suffix, suffix_common = sorted_prefixes(around[:, BEFORE:])
    before, before_common = sorted_prefixes(around[:, :BEFORE][:, ::-1])
    mask = np.zeros(len(doc), np.uint32)
    reach = np.zeros(len(doc), np.uint32)
    for back in range(STARTS):
        # strings that start ``back`` bytes before their sample: prepended bytes, and the suffix to the depth that is left
        on = np.flatnonzero((fewest <= back) & (back <= most))
        if not len(on):
            continue
        pair = _classes(suffix, suffix_common, LENGTH - back)[on] * (len(doc) + 1) + _classes(before, before_common, back)[on]
        order = np.argsort(pair, kind="stable")
        head = np.flatnonzero(np.diff(pair[order], prepend=-1))
        least = np.minimum.reduceat(doc[on][order], head)
        smaller = np.repeat(least, np.diff(np.append(head, len(on)))) < doc[on][order]
        mask[on[order][smaller]] |= np.uint32(1 << back)
        reach[on] |= np.uint32(1 << back)
    total, own = column("total", np.uint32).astype(np.int64), column("own", np.uint32).astype(np.int64)
    # beyond the smallest document's own places, all strings of a tuple repeat
    rank = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
    masks = np.where(rank < np.repeat(own, total), np.repeat(mask, total), np.repeat(reach, total))
    places = column("places", np.uint32)
    ends = np.cumsum([len(p) // 4 for p in bucket.column("places").to_pylist()])
    replies = [(p[m > 0], m[m > 0]) for p, m in zip(np.split(places, ends[:-1]), np.split(masks, ends[:-1]), strict=True)]
    return pa.table(
        {
            "shard": bucket.column("shard"),
            "places": pa.array([p.tobytes() for p, _ in replies], pa.binary()),
            "masks": pa.array([m.astype(np.uint32).tobytes() for _, m in replies], pa.binary()),
        }
    )


def _cut(shard: pa.Table, replies: pa.Table) -> pa.Table:
    """The shard's documents without their repeated bytes."""
    shard = in_order(shard)
    data, at = buffer_of(shard.column("text"))
    places = np.frombuffer(b"".join(replies.column("places").to_pylist()), np.uint32).astype(np.int64)
    masks = np.frombuffer(b"".join(replies.column("masks").to_pylist()), np.uint32)
    repeats = np.zeros(len(data) + 1, np.int32)
    for back in range(STARTS):
        on = places[(masks >> np.uint32(back)) & 1 == 1] - back
        # each string has one sample, so no start is there twice
        repeats[on] = 1
    before = np.concatenate([[0], np.cumsum(repeats)])
    here = np.arange(len(data))
    gone = before[here + 1] > before[np.maximum(here - LENGTH + 1, 0)]
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    heads = at[:-1][at[:-1] < at[1:]]
    begins[heads] = gone[heads]
    ends = gone.copy()
    ends[:-1] &= ~gone[1:]
    ends[heads - 1] = gone[heads - 1]
    spans, span_ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    cuts = np.searchsorted(spans, at)
    doc = np.searchsorted(at, spans, "right") - 1
    left = np.concatenate([[0], np.cumsum(~gone)])[at]
    kept = data[~gone]
    return pa.table(
        {
            "doc_id": shard.column("doc_id"),
            "n_bytes": pa.array(np.diff(at), pa.int64()),
            "span_starts": pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(spans - at[doc], pa.int64())),
            "span_lengths": pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(span_ends - spans, pa.int64())),
            "kept": pa.array([kept[a:b].tobytes() for a, b in zip(left[:-1].tolist(), left[1:].tolist(), strict=True)], pa.binary()),
        }
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, span_starts, span_lengths (removed runs), kept (the bytes that stay): one row per document."""
    texts, n_buckets = sharded(docs)
    counts = shared_keys(texts, n_buckets, _sample_keys)
    fields = "bucket long, shard long, doc binary, fewest binary, most binary, own binary, total binary, places binary, around binary"

    hot = HOT

    def send(shard: pa.Table, counts: pa.Table) -> pa.Table:
        return _tuples(shard, counts, n_buckets, hot)

    tuples = texts.groupBy("shard").cogroup(counts.groupBy("shard")).applyInArrow(send, fields)
    replies = tuples.groupBy("bucket").applyInArrow(_decide, "shard long, places binary, masks binary")
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, n_bytes long, span_starts array<long>, span_lengths array<long>, kept binary"
    return texts.groupBy("shard").cogroup(replies.groupBy("shard")).applyInArrow(_cut, schema)


def removal_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    found = without_repeats(docs)
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("span_starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
