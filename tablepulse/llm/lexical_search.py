"""Ranked lexical search: the documents with the highest scores for each query, by NRA.

``build_index`` makes an inverted index in shards of a few megabytes of whole texts:
a shard is one row with its documents' ids and lengths, its different terms, and
each term's postings (document and number of occurrences). It is built where the
texts are read, without a shuffle, written to the checkpoint folder, and read by
all later steps. Statistics of the whole corpus (documents, terms, documents of a
term) are sums over the shards.

Terms and postings are a few byte strings a shard, which the JVM passes on whole. A
row group holds one shard, and an Arrow batch ends after a few megabytes, so a task
holds a few shards or texts whatever the size of its partition. That setting of the
session holds while a step runs, so each step writes what it finds.

Queries are taken in blocks of bounded size, each broadcast with its terms' weights
and run against all shards. In a shard, the postings of a query's terms are sorted
by impact (their part of a score) and read in sequence, no random access: each
round reads the lists to a multiple of the depth. A document's score lies between the sum
of the impacts read and that sum plus the next impact of every list in which the
document was not seen yet. The least score that can still matter is the k-th of the
lower ends, or the k-th score that the task has found in earlier shards, whichever is
higher; documents whose upper end is below it are out. Reading goes on until
every document left has equal ends, so membership, ties and scores are exact. The
best k of a shard are merged into the best k of its task; a task hands on k rows a
query. The last ranking keeps k per query and group of tasks before it keeps k per
query, so no task gets more than a bounded number of rows for one query.

Defined cases: a null text has no terms; documents and queries without terms match
nothing; documents with score 0 are never listed; of equal scores the smallest id
comes first and a null id last. Rows that repeat an id are documents of their own;
queries that repeat an id are queries of their own. No documents, no terms or no
queries give no rows. Very long texts are a shard of their own. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablepulse.functions.sequence import with_sequence
from tablepulse.llm.common import arrow_batches, filled, small_batches
from tablepulse.llm.shards import buffer_of
from tablepulse.llm.words import byte_class, split_words
from tablepulse.session import work_path

SHARD_BYTES = 4 << 20
#: a shard is filled with batches of so many parts of its size
FILL_PARTS = 16
#: bytes after which an Arrow batch of texts or shards ends
BATCH_BYTES = 4 << 20
#: queries of a block, and bytes of their texts
BLOCK_QUERIES, BLOCK_BYTES = 1024, 4 << 20
TOP = 50
#: postings of a list that the first round reads, and how many times deeper each next round goes
FIRST_DEPTH, DEEPER = 64, 4
#: groups of tasks whose best are ranked before all
RANK_GROUPS = 64
#: a term's weight is LOG_SCALE * ln((2N + 2) / (2df + 1)), its saturation SCALE * tf / (1000 * tf + 20 * m)
LOG_SCALE, SCALE = 1000, 1_000_000_000

#: a term is a run of ASCII letters and digits and of characters beyond ASCII, with A-Z lower-cased
_TERM_BYTE = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


INDEX = (
    "doc_ids array<{id_type}>, lengths binary, n_docs long, n_terms long, "
    "terms binary, term_lengths binary, dfs binary, docs binary, tfs binary"
)


def _shard(ids: pa.Array, texts: pa.Array, schema: pa.Schema) -> pa.RecordBatch:
    """One row: the documents that have terms, the terms, and the postings term by term."""
    words, bounds = split_words(texts, _TERM_BYTE, _LOWER)
    lengths = np.diff(bounds)
    has = np.flatnonzero(lengths)
    encoded = words.dictionary_encode()
    n = max(1, len(has))
    term = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    letters, term_bounds = buffer_of(pa.chunked_array([encoded.dictionary]))
    pairs, tfs = np.unique(term * n + np.repeat(np.cumsum(lengths > 0) - 1, lengths), return_counts=True)
    values = {
        "doc_ids": [ids.take(pa.array(has)).to_pylist()],
        "lengths": [lengths[has].astype("<i8").tobytes()],
        "n_docs": [len(has)],
        "n_terms": [len(words)],
        "terms": [letters.tobytes()],
        "term_lengths": [np.diff(term_bounds).astype("<i4").tobytes()],
        "dfs": [np.bincount(pairs // n, minlength=len(encoded.dictionary)).astype("<i4").tobytes()],
        "docs": [(pairs % n).astype("<i4").tobytes()],
        "tfs": [tfs.astype("<i4").tobytes()],
    }
    return pa.RecordBatch.from_pydict(values, schema)


def build_index(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index of all documents, written to the checkpoint folder: a row per shard."""
    texts = docs.select("doc_id", filled("text").cast("binary").alias("text"))
    id_type = dict(texts.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, schema = [], 0, None
        for batch in small_batches(batches, "text", shard_bytes // FILL_PARTS):
            if schema is None:
                kinds = {"doc_ids": pa.list_(batch.schema.field("doc_id").type)} | dict.fromkeys(("n_docs", "n_terms"), pa.int64())
                names = ["doc_ids", "lengths", "n_docs", "n_terms", "terms", "term_lengths", "dfs", "docs", "tfs"]
                schema = pa.schema([(n, kinds.get(n, pa.binary())) for n in names])
            n = batch.column("text").nbytes
            if held and size + n > shard_bytes:
                yield _shard(*_joined(held), schema)
                held, size = [], 0
            held.append(batch)
            size += n
        if held:
            yield _shard(*_joined(held), schema)

    out = work_path(docs.sparkSession, "lexical_index")
    # rows are megabytes long, and a writer or reader holds a row group
    index = texts.mapInArrow(run, INDEX.format(id_type=id_type)).write.option("parquet.block.row.count.limit", 1)
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        index.parquet(out)
    return docs.sparkSession.read.parquet(out)


def _joined(batches: list[pa.RecordBatch]) -> tuple[pa.Array, pa.Array]:
    return (
        pa.concat_arrays([b.column("doc_id") for b in batches]),
        pa.concat_arrays([b.column("text").cast(pa.large_binary()) for b in batches]),
    )


class Best:
    """The highest ``k`` of (score, id) so far: scores descending, then ids ascending, null last."""

    def __init__(self, k: int):
        self.k = k
        self.rows: list[tuple[int, bool, object]] = []

    @property
    def least(self) -> int:
        """A score below this one is out."""
        return -self.rows[-1][0] if len(self.rows) == self.k else 1

    def add(self, scores: list[int], ids: list[object]) -> None:
        new = [(-s, i is None, 0 if i is None else i) for s, i in zip(scores, ids, strict=True)]
        self.rows = sorted(self.rows + new)[: self.k]


def nra(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and exact scores: the k highest of all scores of at least ``least`` (1 or more), and more if they tie.

    ``lists`` are (documents, impacts), impacts descending; a document is at most once in a list.
    """
    low = np.zeros(n_docs, np.int64)
    alive = np.ones(n_docs, bool)
    seen_docs: list[np.ndarray] = []
    seen_lists: list[np.ndarray] = []
    depth, read = FIRST_DEPTH, 0
    while True:
        new = [(t, docs[read:depth], impacts[read:depth]) for t, (docs, impacts) in enumerate(lists) if len(docs) > read]
        for t, docs, impacts in new:
            stay = alive[docs]
            docs, impacts = docs[stay], impacts[stay]
            low[docs] += impacts
            seen_docs.append(docs)
            seen_lists.append(np.full(len(docs), t))
        # the next impact of each list is the most that a document not seen in it can still get
        ahead = np.array([int(impacts[depth]) if len(impacts) > depth else 0 for _, impacts in lists], np.int64)
        high = low + ahead.sum()
        if ahead.any():
            for docs, of in zip(seen_docs, seen_lists, strict=True):
                if len(docs) and ahead[of[0]]:
                    high[docs] -= ahead[of[0]]
        if k < n_docs:
            least = max(least, int(np.partition(low, n_docs - k)[n_docs - k]))
        alive &= high >= least
        left = np.flatnonzero(alive)
        if (high[left] == low[left]).all():
            return left, low[left]
        read, depth = depth, DEEPER * depth


def _bounds(lengths: pa.Scalar) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.frombuffer(lengths.as_buffer(), "<i4"), dtype=np.int64)])


def _known(row: dict[str, pa.Scalar], terms: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which of a shard's terms are among ``terms``, where they are there, and where the postings of each of the shard's terms begin."""
    bounds = _bounds(row["term_lengths"])
    own = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), row["terms"].as_buffer()])
    at = pc.fill_null(pc.index_in(own, value_set=terms), -1).to_numpy(zero_copy_only=False)
    known = np.flatnonzero(at >= 0)
    return known, at[known], _bounds(row["dfs"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, pa.Scalar]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(c)[i] for c in batch.schema.names}


class Shard:
    """A row of the index, with the postings of some terms sorted by impact."""

    def __init__(self, row: dict[str, pa.Scalar], terms: pa.Array, weights: np.ndarray, n_docs: int, n_terms: int):
        self.ids = row["doc_ids"].values
        lengths = np.frombuffer(row["lengths"].as_buffer(), "<i8")
        m = 100 - 50 + (50 * lengths * n_docs) // n_terms
        known, at, bounds = _known(row, terms)
        docs, tfs = np.frombuffer(row["docs"].as_buffer(), "<i4"), np.frombuffer(row["tfs"].as_buffer(), "<i4")
        #: by a term's place in terms
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for i, term in zip(known.tolist(), at.tolist(), strict=True):
            if weight := int(weights[term]):
                part = slice(bounds[i], bounds[i + 1])
                tf = tfs[part].astype(np.int64)
                impacts = weight * ((SCALE * tf) // (1000 * tf + 20 * m[docs[part]]))
                order = np.argsort(-impacts, kind="stable")
                self.lists[term] = docs[part][order], impacts[order]

    def search(self, terms: list[int], best: Best) -> None:
        lists = [self.lists[t] for t in terms if t in self.lists]
        if lists:
            found, scores = nra(lists, len(self.ids), best.k, best.least)
            best.add(scores.tolist(), self.ids.take(pa.array(found)).to_pylist())


def query_terms(items: DataFrame) -> DataFrame:
    """query (a number), item_id, terms (each once, as bytes) of every row of items."""
    texts = items.select("item_id", filled("text").cast("binary").alias("text"))
    id_type = dict(texts.dtypes)["item_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            words, bounds = split_words(batch.column("text"), _TERM_BYTE, _LOWER)
            terms = [words.slice(a, b - a).unique().to_pylist() for a, b in zip(bounds, bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(terms, pa.list_(pa.binary()))], ["item_id", "terms"])

    found = texts.mapInArrow(run, f"item_id {id_type}, terms array<binary>")
    return with_sequence(found, [F.col("item_id"), F.col("terms")], "query")


def _blocks(queries: DataFrame, most_queries: int, most_bytes: int) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Queries of a block at a time (a query of more than ``most_bytes`` is a block of its own)."""
    block, size = [], 0
    for row in queries.select("query", "terms").toLocalIterator():
        terms = [bytes(t) for t in row["terms"]]
        n = sum(map(len, terms))
        if block and (len(block) == most_queries or size + n > most_bytes):
            yield block
            block, size = [], 0
        block.append((row["query"], terms))
        size += n
    if block:
        yield block


def search(
    index: DataFrame, items: DataFrame, top: int = TOP, most_queries: int = BLOCK_QUERIES, most_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` highest-scoring documents of each item."""
    spark = index.sparkSession
    queries = query_terms(items)
    id_type = dict(index.dtypes)["doc_ids"][len("array<") : -1]
    schema = f"query long, doc_id {id_type}, score long"
    totals = index.agg(F.sum("n_docs").alias("n_docs"), F.sum("n_terms").alias("n_terms")).first()
    n_docs, n_terms = totals["n_docs"] or 0, totals["n_terms"] or 0
    found = [_search_block(index, block, n_docs, n_terms, top, schema) for block in _blocks(queries, most_queries, most_bytes)]
    found = spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = Window.partitionBy("query", "_group").orderBy(*order)
    ranked = found.withColumn("_group", F.spark_partition_id() % RANK_GROUPS).withColumn("_rank", F.row_number().over(some)).where(F.col("_rank") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(queries.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")


def _search_block(index: DataFrame, block: list[tuple[int, list[bytes]]], n_docs: int, n_terms: int, top: int, schema: str) -> str:
    """Where query, doc_id, score are written: the ``top`` best of each task for each query of the block."""
    spark = index.sparkSession
    # a block's terms are bounded by the block's bytes
    terms = sorted({t for _, ts in block for t in ts})
    place = {t: i for i, t in enumerate(terms)}
    asked = [(query, [place[t] for t in ts]) for query, ts in block]
    shared_terms = spark.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = pa.array(shared_terms.value, pa.large_binary())
        total = np.zeros(len(values), np.int64)
        for row in _rows(batches):
            known, at, bounds = _known(row, values)
            total[at] += np.diff(bounds)[known]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["place", "df"])

    df = index.select("terms", "term_lengths", "dfs").mapInArrow(count, "place long, df long").groupBy("place").agg(F.sum("df").alias("df"))
    weight = F.floor(LOG_SCALE * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    weights = np.zeros(len(terms), np.int64)
    with arrow_batches(spark, BATCH_BYTES):
        for r in df.select("place", weight.alias("weight")).collect():
            weights[r["place"]] = r["weight"]
    shared = spark.sparkContext.broadcast((asked, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, (queries, weight_of) = pa.array(shared_terms.value, pa.large_binary()), shared.value
        best = {query: Best(top) for query, _ in queries}
        id_type = pa.int64()
        for row in _rows(batches):
            id_type = row["doc_ids"].type.value_type
            shard = Shard(row, values, weight_of, n_docs, n_terms)
            for query, ts in queries:
                shard.search(ts, best[query])
        out = [(q, None if null else i, -s) for q, b in best.items() for s, null, i in b.rows]
        columns = [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], id_type), pa.array([r[2] for r in out], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["query", "doc_id", "score"])

    out = work_path(spark, "lexical_found")
    found = index.select("doc_ids", "lengths", "terms", "term_lengths", "dfs", "docs", "tfs").mapInArrow(run, schema)
    with arrow_batches(spark, BATCH_BYTES):
        found.write.parquet(out)
    return out
