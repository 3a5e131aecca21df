"""Exact deduplication by deterministic block naming.

Every normalised text is cut into blocks of ``block_bytes``. Blocks are sorted
and get integer names: equal blocks have one name, different blocks have
different names. Then adjacent names are paired and each distinct pair gets a
name of the next level, until one name is left. Two documents are equal when
they end on the same level with the same name: an identity without
collisions, as names come from comparing contents, never from a hash alone.

Sorting is spread over 2**20 buckets chosen by a hash of the key; a name is
the bucket and the key's rank in it, so it depends on the data alone and a
recomputed task gives the same name. A key that is repeated in more than a
thousandth of the rows would fill its bucket with copies: those keys are found
by counting hashes, are at most a thousand by that definition, and are named
from a broadcast dictionary, so their rows are never shuffled.

Defined cases: a null text counts as empty; an empty text is one empty block;
an empty table gives no rows. ``doc_id`` null is an id of its own that comes
after all others (``keep_id`` is null when a group has no other). Rows that
repeat both id and text are separate members of their group, of which at most
one is kept; rows with one id and different texts are different documents.
Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablepulse.llm.common import SPACE_RUN, filled
from tablepulse.session import checkpointed

BLOCK_BYTES = 4096
BUCKETS = 1 << 20
#: a key with at least 1/HOT_KEYS of the rows is hot, so there are at most HOT_KEYS of them
HOT_KEYS = 1000


def normalised(text: Column | str) -> Column:
    """The text with each run of ASCII white space replaced by one space; null as empty."""
    return F.regexp_replace(filled(text), SPACE_RUN, " ")


def name_keys(rows: DataFrame, key: str, name: str, n_rows: int) -> DataFrame:
    """Replace column ``key`` by ``name``: equal keys get equal integers, different keys different ones."""
    rows = rows.withColumn("_h", F.xxhash64(key))
    limit = max(2, -(-n_rows // HOT_KEYS))
    hot = F.broadcast(rows.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= limit).select("_h"))
    bucket = F.pmod(F.col("_h"), F.lit(BUCKETS))
    in_bucket = Window.partitionBy("_bucket").orderBy(key)
    cold = (
        rows.join(hot, "_h", "left_anti")
        .withColumn("_bucket", bucket)
        .withColumn(name, F.col("_bucket") * (1 << 40) + F.dense_rank().over(in_bucket))
        .drop("_h", "_bucket", key)
    )
    # at most HOT_KEYS hashes: the dictionary's order can be made in one task
    hot_rows = rows.join(hot, "_h", "left_semi").drop("_h")
    names = hot_rows.select(key).distinct().select(key, (-F.row_number().over(Window.orderBy(key))).cast("long").alias(name))
    return cold.unionByName(hot_rows.join(F.broadcast(names), key).drop(key))


def document_names(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per distinct (doc_id, text): ``doc_id, sha`` (of the normalised text), ``copies``
    (rows that repeat both), and the identity ``level, name``."""
    text = docs.select("doc_id", normalised("text").cast("binary").alias("_text"))
    n = F.greatest(F.ceil(F.octet_length("_text") / block_bytes), F.lit(1)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.substring(F.col("_text"), i * block_bytes + 1, F.lit(block_bytes)))
    blocks = text.select("doc_id", F.unhex(F.sha2("_text", 256)).alias("sha"), n.alias("n"), "_text").select(
        "doc_id", "sha", "n", F.posexplode(cut).alias("pos", "key")
    )
    n_blocks = docs.select(F.greatest(F.ceil(F.octet_length(normalised("text")) / block_bytes), F.lit(1)).alias("n")).agg(F.sum("n")).first()[0] or 0
    rows = checkpointed(name_keys(blocks, "key", "name", n_blocks))
    base = rows.where("pos = 0").groupBy("doc_id", "sha", "n").agg(F.count(F.lit(1)).alias("copies"))
    done, level = [], 0
    while True:
        done.append(rows.where("n = 1").select("doc_id", "sha", F.lit(level).alias("level"), "name"))
        rows = rows.where("n > 1")
        pairs = (
            rows.groupBy("doc_id", "sha", "n", F.shiftright("pos", 1).alias("pos"))
            .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("l"), F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("r"))
            # names are never 0, which stands for "nothing on the right"
            .select("doc_id", "sha", F.ceil(F.col("n") / 2).cast("int").alias("n"), "pos", F.struct("l", F.coalesce("r", F.lit(0)).alias("r")).alias("key"))
        )
        pairs = checkpointed(pairs)
        n_pairs = pairs.count()
        if not n_pairs:
            break
        rows = checkpointed(name_keys(pairs, "key", "name", n_pairs))
        level += 1
    names = done[0]
    for more in done[1:]:
        names = names.unionByName(more)
    # rows that repeat id and text have equal names, so any of them will do
    names = names.groupBy("doc_id", "sha").agg(F.max("level").alias("level"), F.max("name").alias("name"))
    b, m = base.alias("b"), names.alias("m")
    both = b.join(m, F.col("b.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("b.sha") == F.col("m.sha")))
    return both.select("b.doc_id", "b.sha", "b.copies", "m.level", "m.name")


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    names = checkpointed(document_names(docs, block_bytes))
    # written out, so that both sides of the join are plain exchanges and a hot group's rows can be split
    groups = checkpointed(names.groupBy("level", "name").agg(F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")))
    rows = names.join(groups, ["level", "name"]).select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"))
    return rows.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that stay, with all their columns: one of each group of equal texts."""
    kept = exact_duplicates(docs, block_bytes).where("kept").select(F.col("doc_id").alias("__id"), F.unhex("text_sha256").alias("__sha"))
    keyed = docs.withColumn("__sha_of", F.unhex(F.sha2(normalised("text").cast("binary"), 256)))
    staying = keyed.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__sha_of") == F.col("__sha")), "left_semi")
    # rows that repeat an id and its text are one document
    return staying.withColumn("__id_of", F.col("doc_id")).dropDuplicates(["__id_of", "__sha_of"]).select(*[staying[c] for c in docs.columns])
