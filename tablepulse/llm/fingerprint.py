"""Document fingerprints by a homomorphic multiset hash.

A document is the multiset of its paragraphs (the parts between line feeds).
Each paragraph is hashed to a wide vector, and the fingerprint is the sum of the
vectors, lane by lane, modulo powers of two. So the order of paragraphs doesn't
matter, and a paragraph is inserted or deleted by adding or subtracting its vector.

The vector of a paragraph has ``8`` lanes of 32 bits from its SHA-256, which
decide equality, one lane that counts its pieces, and ``64`` lanes of 32 bits that
count, for each bit of a 64-bit hash, in how many pieces that bit is set. Pieces
are the word triples that start at each word of the paragraph. Twice a count less
the number of pieces is a sum of random signs, so the cosine of two such vectors
estimates how much of their pieces two documents share (a standard deviation of
1/8 for documents that share nothing); below 0 it counts as 0.

Everything is DataFrame expressions: word counts go through one aggregation in
the partitions that the document order needs anyway. Documents are dealt to
ranges of ids of about ``RANGE_BYTES`` by quantiles of the ids, so each finds its
successor within its range or, at the end, at the start of the next one: a row
per range is all that crosses ranges.

Defined cases: a null text counts as empty; an empty text is one empty paragraph.
Null ids come last; rows that repeat an id are ordered by their text. A table of
one document has itself as next one. An empty table gives no rows. Extra columns
are not read. Fingerprints are equal when the multisets of paragraphs are.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablepulse.llm.common import SPACE_RUN, filled, text_bytes

RANGE_BYTES = 4 << 20
#: ranges are found by two look-ups among this many bounds
BOUNDS = 256
#: a bit of each half of a 64-bit number: two 32-bit lanes
LANES = 0x0000000100000001
SHIFTS = 32
LOW = 0xFFFFFFFF


def _range_of(docs: DataFrame, n_ranges: int) -> Column:
    """Number of the id range of a document; null ids are in the last one."""
    shares = [i / n_ranges for i in range(1, n_ranges)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 10 * n_ranges)).first()[0] if shares else None
    bounds = sorted(set(found or []))
    if not bounds:
        return F.lit(0)
    chunks = [bounds[i : i + BOUNDS] for i in range(0, len(bounds), BOUNDS)]
    first = F.from_json(F.lit(json.dumps([c[0] for c in chunks])), "array<bigint>")
    rest = F.from_json(F.lit(json.dumps(chunks)), "array<array<bigint>>")
    chunk = F.size(F.filter(first, lambda b: b <= F.col("doc_id")))
    within = F.size(F.filter(F.element_at(rest, chunk), lambda b: b <= F.col("doc_id")))
    place = F.when(chunk == 0, 0).otherwise((chunk - 1) * BOUNDS + within)
    return F.when(F.col("doc_id").isNull(), len(bounds)).otherwise(place)


def in_order(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, DataFrame]:
    """doc_id, text, next_text (null at the end of a range), with the unique ``_range, _place``; and
    ``_range, text`` of the document that follows the end of each range."""
    rows = docs.select("doc_id", filled("text").alias("text"))
    n_ranges = min(max(1, -(-text_bytes(docs) // range_bytes)), BOUNDS * BOUNDS)
    place = _range_of(docs, n_ranges)
    order = Window.partitionBy("_range").orderBy(F.col("doc_id").asc_nulls_last(), "text")
    rows = rows.withColumn("_range", place).withColumns({"_place": F.row_number().over(order), "next_text": F.lead("text").over(order)})
    # the ranges that have rows, in a ring: at most BOUNDS * BOUNDS pairs of numbers
    used = [r[0] for r in docs.select(place.alias("r")).distinct().orderBy("r").collect()]
    ring = F.from_json(F.lit(json.dumps([{"at": r, "before": used[i - 1]} for i, r in enumerate(used)])), "array<struct<at int, before int>>")
    ring = docs.sparkSession.range(1).select(F.inline(ring))
    heads = rows.where("_place = 1").join(F.broadcast(ring), F.col("_range") == F.col("at"))
    return rows, heads.select(F.col("before").alias("_range"), "text")


def edited(n: Column, text: Column, following: Column) -> Column:
    """The text with its last floor(n/2) code points replaced by the first as many of the next one."""
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), (n - half).cast("int")), F.substring(following, F.lit(1), half))


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` (unique) and ``vector`` (8 equality lanes, the count of pieces, 32 pairs of lanes) of column ``text``."""
    paragraphs = texts.select(*keys, F.explode(F.split("text", "\n", -1)).alias("_p"))
    words = F.split("_p", SPACE_RUN, -1)
    paragraphs = paragraphs.select(*keys, F.sha2("_p", 256).alias("_sha"), words.alias("_w"))
    pieces = F.transform("_w", lambda w, i: F.xxhash64(w, F.get("_w", i + 1), F.get("_w", i + 2)))
    pieces = paragraphs.select(*keys, "_sha", F.posexplode(pieces).alias("_i", "_h"))
    parts = [F.sum(F.when(F.col("_i") == 0, F.conv(F.substring("_sha", 8 * k + 1, 8), 16, 10).cast("long"))).bitwiseAND(LOW).alias(f"e{k}") for k in range(8)]
    lanes = [F.sum(F.shiftrightunsigned("_h", s).bitwiseAND(F.lit(LANES))).alias(f"l{s}") for s in range(SHIFTS)]
    sums = pieces.groupBy(*keys).agg(*parts, F.count(F.lit(1)).alias("n"), *lanes)
    return sums.select(*keys, F.array(*[f"e{k}" for k in range(8)], "n", *[f"l{s}" for s in range(SHIFTS)]).alias("vector"))


def as_text(vector: Column) -> Column:
    """Hexadecimal form of a vector: equality lanes, count, counting lanes."""
    equality = F.transform(F.slice(vector, 1, 8), lambda x: F.lpad(F.lower(F.hex(x)), 8, "0"))
    rest = F.transform(F.slice(vector, 9, 1 + SHIFTS), lambda x: F.lpad(F.lower(F.hex(x)), 16, "0"))
    return F.concat(F.array_join(equality, ""), F.array_join(rest, ""))


def _signed(vector: Column) -> Column:
    n = F.element_at(vector, 9)
    pairs = F.slice(vector, 10, SHIFTS)
    low = F.transform(pairs, lambda x: (x.bitwiseAND(LOW) * 2 - n).cast("double"))
    high = F.transform(pairs, lambda x: (F.shiftrightunsigned(x, 32) * 2 - n).cast("double"))
    return F.concat(low, high)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the cosine of two vectors' counting lanes; 1 for equal vectors."""
    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    x, y = _signed(a), _signed(b)
    size = F.sqrt(dot(x, x) * dot(y, y))
    cosine = F.when(size > 0, dot(x, y) / size).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(F.least(F.greatest(cosine, F.lit(0.0)), F.lit(1.0)))


def document_fingerprints(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows, heads = in_order(docs, range_bytes)
    rows = rows.join(heads.withColumnRenamed("text", "_head"), "_range")
    new = edited(F.length("text"), F.col("text"), F.coalesce("next_text", "_head"))
    rows = rows.select("_range", "_place", "doc_id", F.length("text").cast("long").alias("n_chars"), "text", new.alias("_new"))
    facts = ["_range", "_place", "doc_id", "n_chars", "edited_sha256"]
    both = F.array(F.struct(F.lit(0).alias("_k"), "text"), F.struct(F.lit(1).alias("_k"), F.col("_new").alias("text")))
    texts = rows.select("_range", "_place", "doc_id", "n_chars", F.sha2("_new", 256).alias("edited_sha256"), F.inline(both))
    vectors = fingerprints(texts, [*facts, "_k"]).groupBy(*facts).agg(
        F.max(F.when(F.col("_k") == 0, F.col("vector"))).alias("own"), F.max(F.when(F.col("_k") == 1, F.col("vector"))).alias("new")
    )
    after = fingerprints(heads, ["_range"]).withColumnRenamed("vector", "_after")
    order = Window.partitionBy("_range").orderBy("_place")
    pairs = vectors.withColumn("_next", F.lead("own").over(order)).join(after, "_range")
    following = F.coalesce("_next", "_after")
    return pairs.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("new")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("new")).alias("near_edited"),
        likeness(F.col("own"), following).alias("near_next"),
    )
