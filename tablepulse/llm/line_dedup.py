"""Line deduplication across documents.

Lines are exploded, normalised to keys (ASCII white space stripped at both ends,
A-Z lower-cased) and hashed; a key's distinct documents are counted, and a key
over the threshold keeps its lines in the document with the smallest id only.
The lines that stay are joined again by their positions.

Only hashes and positions are exploded and shuffled, never lines: a text moves
once, to meet the positions that it loses. Keys are 128-bit hashes (two 64-bit
hashes with different seeds) and so are the rows' own keys (id and text).
Everything is built-in expressions and aggregations with partial merge: a line
that a third of all documents hold is one row per task and document when it is
counted; the keys over the threshold and the lost positions are written out
before they are joined, so that both sides are plain exchanges and a hot key's
lines can be split over tasks.

Defined cases: a null or empty text is one empty line, which is too short to be
a key. Documents are ids: rows that repeat an id are one document when documents
are counted, and a null id is an id of its own that comes after all others.
Rows that repeat id and text get equal results. Very long texts are whole and
cost time in proportion to their length; lines of any length are keys. An empty
table gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepulse.llm.common import filled
from tablepulse.session import checkpointed

#: keys of fewer code points are never dropped
MIN_CHARS = 10
#: documents that must hold a key before it is dropped
MIN_DOCS = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII white space
SPACES = " \t\n\x0b\f\r"


def hash128(*columns: Column) -> list[Column]:
    """Two 64-bit hashes of different seeds."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)]


def line_keys(text: Column) -> Column:
    """The keys of a text's lines, in their order."""
    return F.transform(F.split(F.translate(text, UPPER, LOWER), "\n"), lambda line: F.btrim(line, F.lit(SPACES)))


def keyed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, r1, r2 (the row), pos, h1, h2 (the key) of every line whose key is long enough."""
    r1, r2 = hash128(F.col("doc_id"), filled("text"))
    lines = docs.select("doc_id", r1.alias("r1"), r2.alias("r2"), F.posexplode(line_keys(filled("text"))).alias("pos", "key"))
    h1, h2 = hash128(F.col("key"))
    return lines.where(F.length("key") >= min_chars).select("doc_id", "r1", "r2", "pos", h1.alias("h1"), h2.alias("h2"))


def repeated_keys(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """h1, h2, n_docs, first_id: keys in at least ``min_docs`` documents, with the smallest id."""
    holders = lines.select("h1", "h2", "doc_id").distinct()
    # one row per document by now; a null id is a document, too, but never the smallest if there is another
    counted = holders.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_id"))
    return counted.where(F.col("n_docs") >= min_docs)


def lost_positions(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """r1, r2, lost: positions of the lines that each row loses, for rows that lose any."""
    lines = keyed_lines(docs, min_chars)
    keys = checkpointed(repeated_keys(lines, min_docs))
    dropped = lines.join(keys, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("first_id")))
    return dropped.groupBy("r1", "r2").agg(F.collect_set("pos").alias("lost"))


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, text (the lines that stay), n_lines (before dropping), n_dropped: one row per document."""
    r1, r2 = hash128(F.col("doc_id"), filled("text"))
    # split below the join, so that an element is found in an array that is there already
    whole = docs.select("doc_id", r1.alias("r1"), r2.alias("r2"), F.split(filled("text"), "\n").alias("lines"))
    lost = checkpointed(lost_positions(docs, min_chars, min_docs))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "lost")
    left = F.when(F.col("lost").isNull(), F.col("lines")).otherwise(F.transform(kept, lambda i: F.get("lines", i)))
    return whole.join(lost, ["r1", "r2"], "left").select(
        "doc_id",
        F.array_join(left, "\n").alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("lost").isNull(), F.lit(0)).otherwise(F.size("lost")).cast("long").alias("n_dropped"),
    )


def line_digests(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256."""
    return without_repeated_lines(docs, min_chars, min_docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
