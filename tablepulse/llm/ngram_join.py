"""N-gram Jaccard self-join by a grouped prefix join.

A document is the set of its word shingles; two documents link when the
similarity of their sets is at least ``threshold``. All shingles are put in one
global order, the rarest first (by the number of documents that have them, then
by hash). Similar sets must then share a shingle in a short prefix: the first
n - ceil(t n) + 1 of the larger set, and even fewer of the smaller one. A shingle
that only one document has links nothing, so most documents have no candidate.

1. Shards count the shingles of all documents through buckets (``shards``).
2. Equal sets are one set, by size and a 128-bit digest.
3. Sets with the same size and prefix are one group. Groups that share a prefix
   shingle and have sizes that allow a link are candidates; instead of all pairs
   of a shingle's groups, each is tied to its nearest smaller one, which gives the
   same clusters of candidates with one row per group and shingle.
4. Clusters are expanded to their members and verified: blocks of at most
   ``BLOCK_SETS`` sets and about ``BLOCK_SHINGLES`` shingles (a larger set is a block
   of its own), in order of size, are compared with each block of their
   cluster whose sizes allow a link, by matrix products of the sets. Every pair of
   members is decided by its exact intersection; pairs are never written as rows.
5. Links, as spanning trees of each comparison, become components.

No step gathers a group: a hot shingle is one entry per shard, then one row per
group in a sorted window; a hot cluster is many pairs of blocks.

Defined cases: a null or empty text, or one of white space, has an empty set and
links with nothing; a text with fewer words than a shingle has its whole sequence
as its one shingle. Rows that repeat an id or a text are documents of their own
and link as equal sets do. ``component_id`` is the smallest id reachable (null ids
are the largest). An empty table gives no rows. Extra columns are not read.
Sets are compared by 64-bit hashes of their shingles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablepulse.llm.graph import components
from tablepulse.llm.shards import buffer_of, in_order, key_counts, mixed_bits, release, shard_of, sharded, shared_keys
from tablepulse.session import checkpointed

WORDS = 3
THRESHOLD = Fraction(9, 10)
BLOCK_SETS = 256
#: shingles after which a block is closed, however few its sets
BLOCK_SHINGLES = 1 << 20
#: shingles of small clusters that one verifying task takes
BIN_SHINGLES = 1 << 20
#: bytes whose words are hashed at once
SLICE = 4 << 20
#: columns of a verifying matrix at once
COLUMNS = 4096

_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)
_BYTE = mixed_bits(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = 0x5851F42D4C957F2D


def _slices(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of about ``SLICE`` bytes that begin after white space, which bounds the memory that a very long text takes."""
    begin = 0
    while begin < len(data):
        end = begin + SLICE
        while end < len(data) and not _SPACE[data[end - 1]]:
            end += 1
        yield begin, min(end, len(data))
        begin = end


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word (A-Z in lower case), and where each document's words begin."""
    hashes, heads = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for begin, end in _slices(data):
        low = _LOWER[data[begin:end]]
        inside = ~_SPACE[low]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begins = at[:-1][(at[:-1] < at[1:]) & (at[:-1] >= begin) & (at[:-1] < end)] - begin
        first[begins] = inside[begins]
        starts = np.flatnonzero(first)
        if not len(starts):
            continue
        place = np.arange(starts[0], len(low)) - np.repeat(starts, np.diff(np.append(starts, len(low))))
        inside = inside[starts[0] :]
        place[~inside] = 0
        powers = np.cumprod(np.full(int(place.max()) + 1, _STEP, np.uint64))
        terms = _BYTE[low[starts[0] :]] * powers[place]
        terms[~inside] = 0
        hashes.append(mixed_bits(np.add.reduceat(terms, starts - starts[0])))
        heads.append(starts + begin)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(heads), at)


def shingle_sets(data: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of each document, sorted, and where each document's begin."""
    words, begin = word_hashes(data, at)
    counts = np.diff(begin)
    own = np.maximum(counts - width + 1, 0)
    # positions whose shingle lies in one document
    heads = np.repeat(begin[:-1] - np.concatenate([[0], np.cumsum(own)[:-1]]), own) + np.arange(own.sum()) if len(own) else np.zeros(0, np.int64)
    factors = mixed_bits(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    full = np.zeros(len(heads), np.uint64)
    for k in range(width):
        full += words[heads + k] * factors[k]
    docs, found = [np.repeat(np.arange(len(own)), own)], [full]
    for short in range(1, width):
        few = np.flatnonzero(counts == short)
        whole = np.full(len(few), short, np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for k in range(short):
            whole += words[begin[few] + k] * factors[k]
        docs.append(few)
        found.append(whole)
    doc, key = np.concatenate(docs), mixed_bits(np.concatenate(found))
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    return key[new], np.searchsorted(doc[new], np.arange(len(counts) + 1))


def _described(texts: DataFrame, n_buckets: int, width: int, t: Fraction) -> DataFrame:
    """shard, row, doc_id, n, digest, tokens, places: each document's set by size and digest, and the shingles of
    its prefix that other documents have, with their places in the global order."""
    p, q = t.numerator, t.denominator

    def describe(shard: pa.Table, counts: pa.Table) -> pa.Table:
        if not shard.num_rows:
            return out_schema.empty_table()
        shard = in_order(shard)
        keys, begin = shingle_sets(*buffer_of(shard.column("text")), width)
        many = key_counts(keys, counts, n_buckets)
        n = np.diff(begin)
        digests, tokens, places = [], [], []
        for i in range(len(n)):
            own, df = keys[begin[i] : begin[i + 1]], many[begin[i] : begin[i + 1]]
            digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
            length = int(n[i]) - -(-p * int(n[i]) // q) + 1 if n[i] else 0
            shared = np.flatnonzero(df > 1)
            alone = int(n[i]) - len(shared)
            first = shared[np.lexsort((own[shared], df[shared]))[: max(0, length - alone)]]
            tokens.append(own[first].view(np.int64))
            places.append(np.arange(alone, alone + len(first), dtype=np.int32))
        return pa.table(
            {
                "shard": shard.column("shard"),
                "row": pa.array(np.arange(len(n)), pa.int64()),
                "doc_id": shard.column("doc_id"),
                "n": pa.array(n, pa.int64()),
                "digest": pa.array(digests, pa.binary()),
                "tokens": pa.array(tokens, pa.list_(pa.int64())),
                "places": pa.array(places, pa.list_(pa.int32())),
            }
        )

    out_schema = pa.schema(
        [("shard", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()),
         ("tokens", pa.list_(pa.int64())), ("places", pa.list_(pa.int32()))]
    )
    counts = shared_keys(texts, n_buckets, lambda data, at: shingle_sets(data, at, width))
    names = "shard long, row long, doc_id long, n long, digest binary, tokens array<long>, places array<int>"
    return texts.groupBy("shard").cogroup(counts.groupBy("shard")).applyInArrow(describe, names)


def _clusters(sets: DataFrame, t: Fraction) -> DataFrame:
    """set_id, cluster of the sets that have candidates."""
    p, q = t.numerator, t.denominator
    prefixed = sets.where(F.size("tokens") > 0)
    grouped = prefixed.groupBy("n", "tokens").agg(F.min("set_id").alias("group_id"), F.min("places").alias("places"), F.count(F.lit(1)).alias("sets"))
    groups = checkpointed(grouped)
    rows = groups.select("group_id", "n", F.explode(F.arrays_zip("tokens", "places")).alias("_z")).select("group_id", "n", "_z.tokens", "_z.places")
    # as the smaller set of a pair, a group needs the shingle early enough for the whole intersection to follow
    early = F.col("places") <= F.col("n") - F.ceil(2 * p * F.col("n") / F.lit(p + q))
    rows = rows.withColumn("early", early)
    order = Window.partitionBy("tokens").orderBy("n", F.desc("early"), "group_id")
    before = F.last(F.when(F.col("early"), F.struct("group_id", "n")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    ties = rows.withColumn("_b", before).where((q * F.col("_b.n") >= p * F.col("n")))
    tied = components(ties.select(F.col("group_id").alias("a"), F.col("_b.group_id").alias("b")))
    # a group of several sets is a cluster even if it is tied to no other
    own = groups.join(tied, groups["group_id"] == tied["node"], "left")
    own = own.where((F.col("sets") > 1) | F.col("node").isNotNull())
    own = own.select("n", "tokens", F.coalesce("component", "group_id").alias("cluster"))
    return prefixed.join(own, ["n", "tokens"]).select("set_id", "n", "cluster")


def _units(clusters: DataFrame, t: Fraction) -> DataFrame:
    """set_id, cluster, unit, left, right: each set with every comparison that it takes part in; ``unit`` is a task's work."""
    p, q = t.numerator, t.denominator
    order = Window.partitionBy("cluster").orderBy("n", "set_id")
    sets_before, shingles_before = F.row_number().over(order) - 1, F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    # either bound that is reached begins a block; numbers may be left out
    placed = clusters.withColumn("block", F.floor(sets_before / BLOCK_SETS) + F.floor(shingles_before / BLOCK_SHINGLES))
    placed = checkpointed(placed)
    blocks = checkpointed(placed.groupBy("cluster", "block").agg(F.min("n").alias("least"), F.max("n").alias("most")))
    a, b = blocks.alias("a"), blocks.alias("b")
    fits = (F.col("a.cluster") == F.col("b.cluster")) & (F.col("a.block") <= F.col("b.block")) & (q * F.col("a.most") >= p * F.col("b.least"))
    pairs = a.join(b, fits).select("a.cluster", F.col("a.block").alias("left"), F.col("b.block").alias("right"))
    several = blocks.where("block > 0").select("cluster").distinct().withColumn("_many", F.lit(True))
    pairs = pairs.join(several, "cluster", "left")
    n_bins = max(1, -(-(clusters.agg(F.sum("n")).first()[0] or 0) // BIN_SHINGLES))
    # small clusters share a task; a comparison of a large one is a task of its own
    unit = F.when(F.col("_many"), F.xxhash64("cluster", "left", "right")).otherwise(F.pmod(F.xxhash64("cluster"), F.lit(n_bins)))
    pairs = pairs.withColumn("unit", unit).withColumn("_block", F.explode(F.array_distinct(F.array("left", "right"))))
    both = placed.join(pairs.withColumnRenamed("cluster", "_c"), (F.col("cluster") == F.col("_c")) & (F.col("block") == F.col("_block")))
    return both.select("set_id", "cluster", "block", "unit", "left", "right")


def _overlaps(keys: list[np.ndarray], rows: range, columns: range) -> np.ndarray:
    """Sizes of the intersections of some sets with others."""
    used = [*rows, *(i for i in columns if i not in rows)]
    place = {i: k for k, i in enumerate(used)}
    different, back, many = np.unique(np.concatenate([keys[i] for i in used]), return_inverse=True, return_counts=True)
    shared = np.cumsum(many > 1) - 1
    owner = np.repeat(np.arange(len(used)), [len(keys[i]) for i in used])
    hold = (many > 1)[back]
    owner, column = owner[hold], shared[back[hold]]
    out = np.zeros((len(rows), len(columns)), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    left, right = [place[i] for i in rows], [place[i] for i in columns]
    n = int(shared[-1]) + 1 if len(shared) else 0
    for start in range(0, n, COLUMNS):
        lo, hi = np.searchsorted(column, [start, start + COLUMNS])
        has = np.zeros((len(used), min(COLUMNS, n - start)), np.float32)
        has[owner[lo:hi], column[lo:hi] - start] = 1
        out += has[left] @ has[right].T
    return out


def _verified(members: DataFrame, t: Fraction) -> DataFrame:
    """a, b, links: a row per set and comparison with the documents that it links to, and spanning ties of the links."""
    p, q = t.numerator, t.denominator

    def verify(unit: pa.Table) -> pa.Table:
        rows = unit.sort_by([("cluster", "ascending"), ("left", "ascending"), ("right", "ascending"), ("block", "ascending"), ("n", "ascending"), ("set_id", "ascending")])
        comparison = np.stack([rows.column(c).to_numpy() for c in ("cluster", "left", "right")], axis=1)
        cuts = np.flatnonzero((comparison[1:] != comparison[:-1]).any(axis=1)) + 1
        ids, n, copies = (rows.column(c).to_numpy() for c in ("set_id", "n", "copies"))
        block, tokens = rows.column("block").to_numpy(), rows.column("tokens")
        a, b, links = [], [], []
        for lo, hi in zip([0, *cuts], [*cuts, len(rows)], strict=True):
            keys = [np.frombuffer(tokens[int(i)].as_py(), np.uint64) for i in range(lo, hi)]
            inner = comparison[lo, 1] == comparison[lo, 2]
            split = hi - lo if inner else int((block[lo:hi] == comparison[lo, 1]).sum())
            left, right = range(split), range(hi - lo) if inner else range(split, hi - lo)
            common = _overlaps(keys, left, right).astype(np.int64)
            size = n[lo:hi]
            linked = (q * common >= p * (size[left][:, None] + size[right][None, :] - common)) & (common > 0)
            if inner:
                np.fill_diagonal(linked, False)
            degree = np.zeros(hi - lo, np.int64)
            degree[list(left)] += linked @ copies[lo:hi][list(right)]
            if not inner:
                degree[list(right)] += linked.T @ copies[lo:hi][list(left)]
            # a tie to the first set found on the way is enough for the components
            root = np.arange(hi - lo)

            def find(x: int, root: np.ndarray = root) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for x, y in zip(*np.nonzero(linked), strict=True):
                rx, ry = find(left[x]), find(right[y])
                if rx != ry:
                    root[max(rx, ry)] = min(rx, ry)
            for k in np.flatnonzero(degree):
                a.append(int(ids[lo + k]))
                b.append(int(ids[lo + find(int(k))]))
                links.append(int(degree[k]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "links": pa.array(links, pa.int64())})

    return members.groupBy("unit").applyInArrow(verify, "a long, b long, links long")


def jaccard_components(docs: DataFrame, words: int = WORDS, threshold: Fraction = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links, shard, row: one row per document."""
    spark = docs.sparkSession
    texts, n_buckets = sharded(docs)
    described = checkpointed(_described(texts, n_buckets, words, threshold).withColumn("node", F.col("shard") * (1 << 32) + F.col("row")))
    release(spark)
    least = F.min(F.struct("node", "tokens", "places")).alias("_first")
    sets = described.where("n > 0").groupBy("n", "digest").agg(least, F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
    sets = checkpointed(sets.select("n", "digest", F.col("_first.node").alias("set_id"), "_first.tokens", "_first.places", "least_id", "copies"))
    clusters = checkpointed(_clusters(sets, threshold))
    units = checkpointed(_units(clusters, threshold))
    # the sets of the clusters' members are made again from their texts, once for each member
    wanted = clusters.join(sets.select("set_id", "copies"), "set_id")
    wanted = wanted.select(F.floor(F.col("set_id") / (1 << 32)).cast("long").alias("shard"), (F.col("set_id") % (1 << 32)).alias("row"), "set_id", "n", "copies")

    def bring(shard: pa.Table, wanted: pa.Table) -> pa.Table:
        if not shard.num_rows or not wanted.num_rows:
            return pa.schema([("set_id", pa.int64()), ("n", pa.int64()), ("copies", pa.int64()), ("tokens", pa.binary())]).empty_table()
        rows = in_order(shard).column("text").take(wanted.column("row"))
        keys, begin = shingle_sets(*buffer_of(rows), words)
        sets = [keys[begin[i] : begin[i + 1]].tobytes() for i in range(len(rows))]
        return pa.table({"set_id": wanted.column("set_id"), "n": wanted.column("n"), "copies": wanted.column("copies"), "tokens": pa.array(sets, pa.binary())})

    brought = texts.groupBy("shard").cogroup(wanted.groupBy("shard")).applyInArrow(bring, "set_id long, n long, copies long, tokens binary")
    links = checkpointed(_verified(units.join(brought, "set_id"), threshold))
    release(spark)
    tied = components(links.select("a", "b"))
    linked = links.groupBy(F.col("a").alias("set_id")).agg(F.sum("links").alias("links")).join(tied.withColumnRenamed("node", "set_id"), "set_id")
    known = checkpointed(sets.select("n", "digest", "set_id", "least_id", "copies").join(linked, "set_id", "left").withColumn("component", F.coalesce("component", "set_id")))
    smallest = checkpointed(known.groupBy("component").agg(F.min("least_id").alias("component_id")))
    known = checkpointed(known.join(smallest, "component").select("n", "digest", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    rows = described.select("doc_id", "n", "digest", "shard", "row").join(known, ["n", "digest"], "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "shard", "row")


def keep_first(docs: DataFrame, words: int = WORDS, threshold: Fraction = THRESHOLD) -> DataFrame:
    """The documents that stay, with all their columns: the first of each component by id (then by shard and row),
    and every document without shingles."""
    found = checkpointed(jaccard_components(docs, words, threshold))
    first = found.where("n_shingles > 0").groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "shard", "row")).alias("_first"))
    first = first.select(F.col("_first.shard").alias("shard"), F.col("_first.row").alias("row"))
    kept = checkpointed(first.unionByName(found.where("n_shingles = 0").select("shard", "row")))
    # a row is found again by its place in its shard, so that rows that repeat an id differ, too
    names = docs.columns

    def pick(shard: pa.Table, kept: pa.Table) -> pa.Table:
        ordered = in_order(shard.append_column("__text", pc.fill_null(shard.column("text"), "").cast(pa.binary())), "__text")
        return ordered.take(kept.column("row")).select(names)

    keyed = docs.withColumn("__shard", shard_of(docs)[0])
    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return keyed.groupBy("__shard").cogroup(kept.groupBy("shard")).applyInArrow(pick, schema)
