"""Runs: stretches of a document's words that repeat with a small period.

A dictionary of basic factors names every stretch of 1, 2, 4, 8, ... words by an
integer, so that equal stretches of one document have equal names: a stretch of
2m words is the pair of the names of its halves. At each length m the occurrences
of a name are in order, and each one's successor within 2m words proposes its
distance d as a period. Occurrences d apart form an arithmetic progression, and
the progressions of neighbouring first words lie side by side: together they are
one stretch of period d that reaches from the first occurrence to m + d words
after the last first word. Proposals that are long enough are extended as far as
the period goes to both sides; the same run is proposed at several lengths m and
kept once.

Nothing is missed: in a run of smallest period q and at least 3q words, at the
least m >= q (m < 2q), the successor of every factor that has one within the run
is exactly q words on, as a nearer one would give the run a smaller period. For
the same reason a proposal of at least 3d words has d as its smallest period.

Factors that occur once in a document are part of no longer factor that occurs
twice, so each length looks only at the words that begin a repeated factor of
half the length. Documents of a batch are named together; the document is part of
a name. A batch is a megabyte of whole texts (or one longer text); no rows move,
so there is no shuffle and no hot key, and a lost task is just run again.

Defined cases: a null or empty text, or one of white space only, has no words and
no runs; an empty table gives no rows; rows that repeat an id are documents of
their own, equal rows get equal results; a null id is an id like any other. Very
long texts take memory in proportion to their words. Of runs with equal
length/period the one of smallest start, then smallest period, is named. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablepulse.llm.common import WORD, filled, small_batches
from tablepulse.llm.words import byte_class, split_words

#: words of a run, at least
MIN_LENGTH = 24
#: times that a run repeats its period, at least
MIN_REPEATS = 3
BATCH_BYTES = 1 << 20
#: all bytes but ASCII white space
_WORD_BYTE = ~byte_class((0x20, 0x20), (0x09, 0x0D))


def _extended(ids: np.ndarray, low: int, high: int, start: int, end: int, d: int) -> tuple[int, int]:
    """The widest [start, end) of period d within [low, high) around one that has it."""
    step = 64
    while end < high:
        part = ids[end : min(end + step, high)] == ids[end - d : min(end + step, high) - d]
        n = len(part) if part.all() else int(part.argmin())
        end += n
        if n < len(part):
            break
        step *= 2
    step = 64
    while start > low:
        at = max(start - step, low)
        part = (ids[at:start] == ids[at + d : start + d])[::-1]
        n = len(part) if part.all() else int(part.argmin())
        start -= n
        if n < len(part):
            break
        step *= 2
    return start, end


def find_runs(ids: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs of the rows ``ids[bounds[k]:bounds[k + 1]]``, by row, start and period.

    ``min_repeats`` must be at least 3.
    """
    n = len(ids)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    room = bounds[row + 1] - np.arange(n)  # words from here to the end of the row
    found: set[tuple[int, int, int]] = set()
    at, keys, m = np.arange(n), row * (int(ids.max(initial=0)) + 1) + ids, 1
    name = np.full(n, -1, np.int64)
    while len(at):
        # ``at`` ascends, so a stable sort has the occurrences of a name in order
        order = np.argsort(keys, kind="stable")
        at, keys = at[order], keys[order]
        same = keys[1:] == keys[:-1]
        step = np.where(same, at[1:] - at[:-1], 0)
        near = np.flatnonzero((step > 0) & (step <= 2 * m))
        first, d = at[near], step[near]
        side = np.lexsort((first, d))
        first, d = first[side], d[side]
        # neighbouring first words with one distance are one stretch
        breaks = np.flatnonzero((np.diff(first) != 1) | (np.diff(d) != 0))
        a = np.concatenate([[0], breaks + 1])[: len(first)]
        b = np.concatenate([breaks, [len(first) - 1]])[: len(first)]
        starts, ends, periods = first[a], first[b] + m + d[a], d[a]
        for s, e, q in zip(*(x[ends - starts >= np.maximum(min_length, min_repeats * periods)].tolist() for x in (starts, ends, periods)), strict=True):
            k = row[s]
            found.add((*_extended(ids, int(bounds[k]), int(bounds[k + 1]), s, e, q), q))
        # names of the factors that occur again, and the factors of twice the length that two of them make
        again = np.zeros(len(at), bool)
        again[:-1] |= same
        again[1:] |= same
        name[:] = -1
        name[at[again]] = np.cumsum(np.concatenate([[0], ~same]))[again]
        at = np.sort(at[again])
        at = at[room[at] >= 2 * m]
        at = at[name[at + m] >= 0]
        keys = name[at] * n + name[at + m]
        m *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


SCHEMA = (
    "doc_id {id_type}, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs array<struct<start: long, length: long, period: long>>, text binary"
)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """One row per document: doc_id, n_runs; start, length, period and exponent_milli of the run with the greatest
    length/period; all runs; and the text (UTF-8) of the words that no run repeats, joined by one space."""
    texts = docs.select("doc_id", filled("text").cast("binary").alias("text"))
    schema = SCHEMA.format(id_type=dict(texts.dtypes)["doc_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BATCH_BYTES):
            words, bounds = split_words(batch.column("text"), _WORD_BYTE)
            ids = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            own: list[list[dict[str, int]]] = [[] for _ in range(batch.num_rows)]
            change = np.zeros(len(ids) + 1, np.int64)
            for s, e, q in find_runs(ids, bounds, min_length, min_repeats):
                k = int(np.searchsorted(bounds, s, "right")) - 1
                own[k].append({"start": s - int(bounds[k]), "length": e - s, "period": q})
                change[s + q] += 1
                change[e] -= 1
            kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
            lists = pa.LargeListArray.from_arrays(np.searchsorted(kept, bounds), words.take(pa.array(kept)))
            best = [max(r, key=lambda x: (Fraction(x["length"], x["period"]), -x["start"], -x["period"])) if r else None for r in own]
            columns = [
                batch.column("doc_id"),
                pa.array([len(r) for r in own], pa.int64()),
                *(pa.array([b and b[c] for b in best], pa.int64()) for c in ("start", "length", "period")),
                pa.array([b and 1000 * b["length"] // b["period"] for b in best], pa.int64()),
                pa.array(own, pa.list_(_RUN)),
                pc.binary_join(lists, pa.scalar(b" ", pa.large_binary())).cast(pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs", "text"])

    return texts.mapInArrow(run, schema)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text: in one of ten documents (by a hash of its id) the words from some place on repeat a stretch of
    their own, with the words joined by one space; the others stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    drawn = docs.select("doc_id", filled("text").alias("text"), h.alias("h"), g.alias("g"))
    words, n = F.regexp_extract_all("text", F.lit(WORD), 0), F.regexp_count("text", F.lit(WORD))
    a = F.col("g") % F.greatest(n, F.lit(1))
    p = 1 + F.floor((n - a) / (3 + F.col("g") % 8))
    head, unit = F.slice(words, 1, a.cast("int")), F.slice(words, (a + 1).cast("int"), p.cast("int"))
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil((n - a) / p).cast("int"))), 1, (n - a).cast("int"))
    planted = F.array_join(F.concat(head, tail), " ")
    # no word: nothing to repeat; a null id has no hash and stays
    return drawn.select("doc_id", F.when((F.col("h") % 10 == 0) & (n > 0), planted).otherwise(F.col("text")).alias("text"))


def run_digests(docs: DataFrame) -> DataFrame:
    """The documents' runs with digests: of all runs (``start,length,period`` and a line feed each) and of the kept words."""
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.concat(F.array_join(line, "\n"), F.when(F.col("n_runs") > 0, "\n").otherwise(""))
    found = periodic_runs(docs)
    return found.select(
        *("doc_id", "n_runs", "start", "length", "period", "exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )
