"""Line dedup, periodic runs and lexical search against brute force."""

import math
import random
import re
import uuid
import zlib
from fractions import Fraction

import fixtures as X
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tablepulse.llm import lexical_search, line_dedup, periodic_runs
from tablepulse.llm.words import byte_class, split_words

SPACE = " \t\n\x0b\f\r"


def frame(spark, texts):
    return X.docs(spark, [(i, t, None, None) for i, t in texts])


# ---------------------------------------------------------------- lines
LINES = [
    (3, "A shared line of text\nown line number three\nshort\n\n  a SHARED line of text\t"),
    (1, "\ta shared LINE of text \nshort\nfirst of its own"),
    (2, "first OF its own\nshort\nsomething else entirely"),
    (2, "first OF its own\nshort\nsomething else entirely"),
    (2, "a second text of the same id\nsomething else entirely"),
    (4, None),
    (5, ""),
    (6, "\n\n"),
    (None, "a shared line of text\nonly without an id"),
    (None, "only without an id\nrest of it here"),
    (7, "é" * 10 + "\n" + "É" * 10 + "\n" + "x" * 9 + "\n" + "x" * 9),
    (8, "é" * 10 + "\r\n" + "\x85" + "É" * 10 + "\n" + "x" * 9),
    (9, "\n".join(f"line {k % 4000} of a long text" for k in range(9000))),
    (10, "\n".join(f"line {k} of a long text" for k in range(3990, 4010))),
]


def lines_by_hand(texts, min_chars, min_docs):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line).strip(SPACE)
    holders = {}
    for i, t in texts:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs or i == X.least(holders[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), X.sha("\n".join(kept))))
    return out


@pytest.mark.parametrize(("min_chars", "min_docs"), [(10, 2), (1, 2), (10, 3)])
def test_line_dedup(spark, min_chars, min_docs):
    got = line_dedup.line_digests(frame(spark, LINES).repartition(5), min_chars, min_docs).collect()
    assert X.by_all(got) == X.by_all(lines_by_hand(LINES, min_chars, min_docs))


def test_line_dedup_random_and_hot(spark):
    r = random.Random(6)
    texts = [(k % 150, "\n".join(r.choice(["the line that all have", f"line number {r.randrange(60)}", " Mixed CASE line ", "tiny", ""]) for _ in range(r.randrange(6)))) for k in range(200)]
    got = line_dedup.line_digests(frame(spark, texts).repartition(4)).collect()
    assert X.by_all(got) == X.by_all(lines_by_hand(texts, 10, 2))


def test_line_dedup_shared_fixture_and_empty(spark):
    texts = [t[:2] for t in X.TEXTS]
    assert X.by_all(line_dedup.line_digests(X.docs(spark)).collect()) == X.by_all(lines_by_hand(texts, 10, 2))
    assert line_dedup.line_digests(X.empty(spark)).count() == 0


def test_line_dedup_has_no_python_and_splits_hot_lines(spark):
    found = line_dedup.line_digests(X.docs(spark))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|InArrow", plan)


# ---------------------------------------------------------------- runs
def runs_by_hand(words, min_length=24, min_repeats=3):
    n, found = len(words), {}
    for q in range(1, n // min_repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_length, min_repeats * q):
                # of the periods of the same stretch the smallest
                found.setdefault((i, length), q)
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def digests_by_hand(i, words):
    runs = runs_by_hand(words)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    return (
        i, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        X.sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), X.sha(" ".join(w for k, w in enumerate(words) if k not in gone)),
    )


def planted(i, words):
    if i is None or not words or zlib.crc32(str(i).encode()) % 10:
        return words
    n, g = len(words), zlib.crc32(str(i).encode()) // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[k if k < a else a + (k - a) % p] for k in range(n)]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_find_runs_in_random_rows():
    r = random.Random(11)
    rows = []
    for _ in range(400):
        out = []
        while len(out) < r.choice([0, 5, 30, 90, 200]):
            unit = [r.randrange(r.choice([1, 2, 3, 50])) for _ in range(r.randrange(1, 12))]
            out += (unit * r.randrange(1, 14))[: r.randrange(1, 80)]
        rows.append(out)
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
    for min_length in (24, 6):
        got = periodic_runs.find_runs(np.array([x for row in rows for x in row], np.int64), bounds, min_length)
        want = [(s + b, s + b + length, q) for row, b in zip(rows, bounds, strict=False) for s, length, q in runs_by_hand(row, min_length)]
        assert got == want


def test_find_runs_of_large_periods():
    r = random.Random(3)
    unit = [r.randrange(1000) for _ in range(777)]
    row = [r.randrange(1000) for _ in range(50)] + (unit * 4)[:2900] + [1001] * 40 + unit
    assert periodic_runs.find_runs(np.array(row), np.array([0, len(row)])) == [(s, s + length, q) for s, length, q in runs_by_hand(row)]
    assert periodic_runs.find_runs(np.zeros(0, np.int64), np.array([0, 0, 0])) == []


RUNS = [
    *[(k, " ".join(f"w{(k * 7 + j * j) % 23}" for j in range(k))) for k in range(0, 240, 3)],
    (500, "la " * 60 + "and more " * 20 + "end"),
    (500, "la " * 60 + "and more " * 20 + "end"),
    (None, "a b c " * 30),
    (None, None),
    (501, ""),
    (502, " \t\n"),
    (503, "x\x0by z " * 25),
    (504, "ab " * 23),
    (505, "ab " * 24),
    (506, "  lead and trail  "),
]


def test_run_digests(spark):
    docs = periodic_runs.with_planted_runs(frame(spark, RUNS).repartition(3))
    got = periodic_runs.run_digests(docs).collect()
    want = [digests_by_hand(i, planted(i, words_of(t))) for i, t in RUNS]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in RUNS) >= 5
    assert X.by_all(got) == X.by_all(want)


def test_runs_shared_fixture_and_empty(spark):
    got = periodic_runs.run_digests(X.docs(spark)).collect()
    short = {i for i, t, *_ in X.TEXTS if len(t or "") < 10_000}
    want = [digests_by_hand(i, words_of(t)) for i, t, *_ in X.TEXTS if i in short]
    assert X.by_all(r for r in got if r["doc_id"] in short) == X.by_all(want)
    assert len(got) == len(X.TEXTS)
    assert periodic_runs.run_digests(periodic_runs.with_planted_runs(X.empty(spark))).count() == 0


def test_runs_of_a_very_long_text(spark):
    unit = " ".join(f"u{k}" for k in range(5000))
    text = "head " + " ".join([unit] * 40) + " tail"
    (row,) = periodic_runs.periodic_runs(frame(spark, [(1, text)])).collect()
    assert (row["n_runs"], row["start"], row["length"], row["period"]) == (1, 1, 200_000, 5000)
    assert bytes(row["text"]).decode() == f"head {unit} tail"


def test_split_words():
    texts = [b"", b"ab c", b"d", b"  ", b"e", b"f\n\tg "]
    words, bounds = split_words(pa.array(texts, pa.binary()), ~byte_class((0x20, 0x20), (9, 13)))
    got = [words.slice(a, b - a).to_pylist() for a, b in zip(bounds, bounds[1:], strict=False)]
    assert got == [t.split() for t in texts]
    words, bounds = split_words(pa.array([], pa.binary()), byte_class((97, 122)))
    assert len(words) == 0 and bounds.tolist() == [0]


# ---------------------------------------------------------------- search
def terms_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def search_by_hand(texts, items, top):
    docs = [(i, terms_of(t)) for i, t in texts]
    docs = [(i, t) for i, t in docs if t]
    n_docs, n_terms = len(docs), sum(len(t) for _, t in docs)
    df = {}
    for _, t in docs:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for i, t in docs:
            m, score = 50 + 50 * len(t) * n_docs // n_terms, 0
            for x in set(terms_of(text)):
                tf = t.count(x)
                if tf:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (1_000_000_000 * tf // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, k, None if null else i, -s) for k, (s, null, i) in enumerate(sorted(scored)[:top], 1)]
    return out


def corpus(r, n):
    vocabulary = [f"t{k}" for k in range(40)] + ["Ünï", "漢字", "x1y", "İ"]
    texts = [(k, " ".join(r.choice(vocabulary[: r.choice([3, 12, 44])]) for _ in range(r.randrange(1, 30)))) for k in range(n)]
    texts += [(k, texts[5][1]) for k in range(n, n + 60)]  # ties
    return texts + [(3, "t1 t2"), (3, "t1 t2"), (None, "t1 t1 T3"), (None, None), (n + 100, ""), (n + 101, "-- !"), (n + 102, "t0 " * 5000)]


ITEMS = [(1, "t0 t1-t2"), (2, "T3 t3 t4_t5"), (3, "nothing here"), (4, None), (5, ""), (6, "ünï Ünï 漢字x 漢字"), (7, " ".join(f"t{k}" for k in range(40))), (8, "t1")]


@pytest.mark.parametrize(("top", "shard_bytes", "block"), [(50, 8 << 20, 1024), (3, 300, 2), (7, 900, 3)])
def test_search(spark, monkeypatch, top, shard_bytes, block):
    monkeypatch.setattr(lexical_search, "FIRST_DEPTH", 4)
    texts = corpus(random.Random(top), 300)
    docs = frame(spark, texts).repartition(3)
    items = spark.createDataFrame([(i, t, "x", 1) for i, t in ITEMS], "item_id long, text string, rank string, score int")
    found = lexical_search.search(lexical_search.build_index(docs, shard_bytes), items, top, block)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=lambda r: r[:2]) == search_by_hand(texts, ITEMS, top)


def test_search_repeated_queries_and_empty_tables(spark):
    texts = [(1, "a b"), (2, "a"), (3, "c")]
    index = lexical_search.build_index(frame(spark, texts))
    twice = spark.createDataFrame([(1, "a"), (1, "a"), (1, "c")], "item_id long, text string")
    got = sorted(map(tuple, lexical_search.search(index, twice).collect()))
    assert got == sorted(search_by_hand(texts, [(1, "a"), (1, "a"), (1, "c")], 50))
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert lexical_search.search(index, nothing).count() == 0
    assert lexical_search.search(lexical_search.build_index(X.empty(spark)), twice).count() == 0


def test_search_holds_a_few_shards_of_a_partition(spark, monkeypatch, tmp_path):
    """Whatever a partition holds, a task is sent and writes a bounded part of it at a time."""

    def noted(name, sizes):
        with open(tmp_path / f"{name}{uuid.uuid4().hex}", "w") as f:
            f.write("\n".join(map(str, sizes)))

    def batches_of(name):
        def batches(given, *_, cut=lexical_search.small_batches):
            sizes = []
            for batch in given:
                sizes.append(batch.nbytes)
                yield from cut(iter([batch]), "text", 3000) if name == "texts" else ({c: batch.column(c)[i] for c in batch.schema.names} for i in range(batch.num_rows))
            noted(name, sizes)

        return batches

    monkeypatch.setattr(lexical_search, "BATCH_BYTES", 50_000, raising=False)
    monkeypatch.setattr(lexical_search, "small_batches", batches_of("texts"))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    r = random.Random(6)
    texts = [(k, " ".join(f"t{r.randrange(3000)}" for _ in range(300))) for k in range(600)]
    index = lexical_search.build_index(frame(spark, texts).repartition(1), 30_000)
    groups = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in index.inputFiles()]
    assert index.count() > 20
    assert {m.row_group(g).num_rows for m in groups for g in range(m.num_row_groups)} == {1}
    monkeypatch.undo()
    monkeypatch.setattr(lexical_search, "BATCH_BYTES", 50_000, raising=False)
    monkeypatch.setattr(lexical_search, "_rows", batches_of("shards"), raising=False)
    items = spark.createDataFrame([(1, "t1 t2 t3"), (2, "t17")], "item_id long, text string")
    found = lexical_search.search(index, items, 5)
    assert sorted(map(tuple, found.collect())) == sorted(search_by_hand(texts, [(1, "t1 t2 t3"), (2, "t17")], 5))
    for name in ("texts", "shards"):
        sizes = [int(x) for f in tmp_path.glob(f"{name}*") for x in f.read_text().split()]
        assert len(sizes) > 10
        # a batch ends after the row that brings it over the limit
        assert max(sizes) < 120_000
    assert spark.conf.get(key) == before


def test_nra_gives_all_of_the_best_and_exact_scores():
    r = np.random.default_rng(2)
    for _ in range(200):
        n, k = int(r.integers(1, 400)), int(r.integers(1, 12))
        lists, total = [], np.zeros(n, np.int64)
        for _ in range(int(r.integers(1, 8))):
            docs = r.permutation(n)[: int(r.integers(0, n + 1))]
            impacts = np.sort(r.integers(1, 6, len(docs)))[::-1].astype(np.int64)
            lists.append((docs, impacts))
            total[docs] += impacts
        least = int(r.integers(1, 8))
        docs, scores = lexical_search.nra(lists, n, k, least)
        got = dict(zip(docs.tolist(), scores.tolist(), strict=True))
        assert all(total[d] == s for d, s in got.items())
        kth = max(least, int(np.sort(total)[::-1][k - 1]) if k < n else 0)
        assert {d for d in range(n) if total[d] >= kth} <= set(got)
