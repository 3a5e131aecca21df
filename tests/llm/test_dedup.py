"""Exact, suffix and near-duplicate operators against brute force."""

import random
from fractions import Fraction

import fixtures as X
import numpy as np
import pyarrow as pa
import pytest

from tablepulse.llm import exact_dedup, graph, ngram_join, shards, suffix_dedup


def exact_by_hand(texts):
    groups = {}
    for i, t in texts:
        groups.setdefault(X.normalised(t), []).append(i)
    out, done = [], set()
    for i, t in texts:
        n = X.normalised(t)
        keep = X.least(groups[n])
        out.append((i, keep, len(groups[n]), i == keep and n not in done, X.sha(n)))
        if i == keep:
            done.add(n)
    return out


@pytest.mark.parametrize("block", [4, 4096])
def test_exact_duplicates(spark, block):
    texts = [t[:2] for t in X.TEXTS]
    if block == 4:
        texts = [(i, t) for i, t in texts if len(t or "") < 200]
    frame = X.docs(spark, [(i, t, None, None) for i, t in texts]).repartition(3)
    got = exact_dedup.exact_duplicates(frame, block).collect()
    assert X.by_all(got) == X.by_all(exact_by_hand(texts))


def test_exact_blocks_differ_late(spark):
    same = "x" * 9000
    texts = [(1, same + "a"), (2, same + "b"), (3, same + "a"), (4, same), (5, same + "a" + same)]
    got = exact_dedup.exact_duplicates(X.docs(spark, [(i, t, None, None) for i, t in texts])).collect()
    assert X.by_all(got) == X.by_all(exact_by_hand(texts))


def test_hot_block_is_named_once(spark):
    texts = [(i, "hot" if i % 3 else f"cold {i}") for i in range(300)]
    got = exact_dedup.exact_duplicates(X.docs(spark, [(i, t, None, None) for i, t in texts]).repartition(7)).collect()
    assert X.by_all(got) == X.by_all(exact_by_hand(texts))


def test_exact_keep_first_keeps_columns(spark):
    frame = X.docs(spark)
    kept = exact_dedup.keep_first(frame)
    assert kept.columns == frame.columns
    texts = [t[:2] for t in X.TEXTS]
    want = [(r[0], r[4]) for r in exact_by_hand(texts) if r[3]]
    assert X.by_all((r["doc_id"], X.sha(X.normalised(r["text"]))) for r in kept.collect()) == X.by_all(want)


def test_empty_tables(spark):
    none = X.empty(spark)
    assert exact_dedup.exact_duplicates(none).count() == 0
    assert exact_dedup.keep_first(none).count() == 0
    assert suffix_dedup.removal_digests(none).count() == 0
    assert ngram_join.jaccard_components(none).count() == 0
    assert ngram_join.keep_first(none).count() == 0


def repeating_texts(seed, n=50):
    r = random.Random(seed)
    base = ["".join(r.choice("ab \x00é") for _ in range(300)), "".join(r.choice("abcdefgh ") for _ in range(500)), "x" * 400, "ab" * 200]
    out = []
    for k in range(n):
        t = ""
        for _ in range(r.randint(0, 4)):
            b = r.choice(base)
            a = r.randint(0, len(b))
            t += b[a : a + r.randint(0, 200)] + "".join(r.choice("abcxyz") for _ in range(r.randint(0, 60)))
        out.append((r.choice([k, k, k, 5, None]), t if r.random() > 0.05 else None))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_repeats_across_documents(spark, monkeypatch, small):
    if small:  # many shards and buckets
        monkeypatch.setattr(shards.sharded, "__defaults__", (2000,))
        monkeypatch.setattr(shards, "BUCKET_BYTES", 3000)
    texts = repeating_texts(1 + small)
    frame = spark.createDataFrame([(t, i) for i, t in texts], "text string, doc_id long").repartition(3)
    got = suffix_dedup.removal_digests(frame).collect()
    assert X.by_all(got) == X.by_all(X.removed([(i, (t or "").encode()) for i, t in texts], 50))


def test_repeats_of_awkward_documents(spark):
    texts = [(i, t if t is None or len(t) < 9000 else t[:3000]) for i, t, *_ in X.TEXTS]
    got = suffix_dedup.removal_digests(X.docs(spark, [(i, t, None, None) for i, t in texts])).collect()
    assert X.by_all(got) == X.by_all(X.removed([(i, (t or "").encode()) for i, t in texts], 50))


def test_spans_and_kept_bytes_agree(spark):
    texts = repeating_texts(9)
    for r in suffix_dedup.without_repeats(spark.createDataFrame(texts, "doc_id long, text string")).collect():
        assert r["n_bytes"] - len(r["kept"]) == sum(r["span_lengths"])
        assert all(a + n < b for a, n, b in zip(r["span_starts"], r["span_lengths"], r["span_starts"][1:], strict=False))


@pytest.mark.parametrize("hot", [1, 20])
def test_repeats_of_hot_grams(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "TUPLES", 64)
    monkeypatch.setattr(shards.sharded, "__defaults__", (2000,))
    monkeypatch.setattr(shards, "BUCKET_BYTES", 3000)
    r = random.Random(4)
    some = lambda n: "".join(r.choice("abcdefgh") for _ in range(n))
    line, passage = some(40), some(130)
    texts = [*repeating_texts(5, 30), *((i, some(r.randint(0, 40)) + r.choice([line, passage]) + r.choice(["", some(40)])) for i in range(100, 200))]
    got = suffix_dedup.removal_digests(spark.createDataFrame(texts, "doc_id long, text string").repartition(3)).collect()
    assert X.by_all(got) == X.by_all(X.removed([(i, (t or "").encode()) for i, t in texts], 50))


def test_a_hot_gram_is_dealt_to_many_buckets(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "key_counts", lambda keys, counts, n_buckets: np.full(len(keys), 1 << 20))
    r = random.Random(8)
    some = lambda n: "".join(r.choice("abcdefgh") for _ in range(n))
    line = some(40)
    shard = pa.table({"shard": [0] * 200, "doc_id": list(range(200)), "text": [(some(40) + line + some(40)).encode() for _ in range(200)]})
    dealt = {}
    for hot in (1 << 16, 1 << 30):
        out = suffix_dedup._tuples(shard, None, 16, hot)
        dealt[hot] = [sum(line[8:32].encode() in row[k : k + 76] for k in range(0, len(row), 76)) for row in out.column("around").to_pylist()]
    assert max(dealt[1 << 30]) > 3 * sum(dealt[1 << 30]) / 16
    assert len(dealt[1 << 16]) == 16 and max(dealt[1 << 16]) < 1.5 * sum(dealt[1 << 16]) / 16


def near_texts(seed, families=8):
    r = random.Random(seed)
    out, k = [], 0
    for _ in range(families):
        base = [f"w{r.randint(0, 300)}" for _ in range(r.choice([2, 3, 30, 80, 200]))]
        for _ in range(r.randint(1, 9)):
            words = list(base)
            for _ in range(r.randint(0, 4)):
                words[r.randrange(len(words))] = f"v{r.randint(0, 500)}"
            out.append((k if r.random() > 0.1 else r.choice([3, None]), " ".join(words).upper() if r.random() > 0.8 else "  ".join(words)))
            k += 1
    r.shuffle(out)
    return out


@pytest.mark.parametrize(("seed", "width", "threshold"), [(1, 3, Fraction(9, 10)), (2, 5, Fraction(8, 10)), (3, 1, Fraction(1, 2))])
def test_components_and_links(spark, monkeypatch, seed, width, threshold):
    if seed == 2:  # several blocks in a cluster, many shards and buckets
        monkeypatch.setattr(ngram_join, "BLOCK_SETS", 3)
        monkeypatch.setattr(shards.shard_of, "__defaults__", (2000,))
        monkeypatch.setattr(shards, "BUCKET_BYTES", 3000)
    texts = near_texts(seed, 12)
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = ngram_join.jaccard_components(frame, width, threshold).drop("shard", "row").collect()
    assert X.by_all(got) == X.by_all(X.linked_components(texts, width, threshold))


def test_blocks_are_closed_by_their_shingles(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 200)
    clusters = spark.createDataFrame([(i, 90 + i, 7) for i in range(9)] + [(20, 500, 7), (21, 501, 7), (30, 5, 8), (31, 5, 8)], "set_id long, n long, cluster long")
    blocks = {}
    for r in ngram_join._units(clusters, Fraction(1, 10)).select("cluster", "block", "set_id").distinct().collect():
        blocks.setdefault((r["cluster"], r["block"]), []).append(r["set_id"])
    size = {i: 90 + i for i in range(9)} | {20: 500, 21: 501, 30: 5, 31: 5}
    # without its last set, no block has as many shingles as the bound
    assert all(sum(size[i] for i in ids) - max(size[i] for i in ids) < 200 for ids in blocks.values())
    assert sorted(i for ids in blocks.values() for i in ids) == sorted(size) and sorted(blocks[8, 0]) == [30, 31]
    texts = near_texts(5, 12)
    got = ngram_join.jaccard_components(spark.createDataFrame(texts, "doc_id long, text string"), 3, Fraction(8, 10)).drop("shard", "row").collect()
    assert X.by_all(got) == X.by_all(X.linked_components(texts, 3, Fraction(8, 10)))


def test_awkward_documents_and_ties(spark):
    texts = [t[:2] for t in X.TEXTS]
    got = ngram_join.jaccard_components(X.docs(spark)).drop("shard", "row").collect()
    assert X.by_all(got) == X.by_all(X.linked_components(texts, 3, Fraction(9, 10)))


def test_near_copies_keep_one_of_each_group(spark):
    frame = X.docs(spark)
    kept = ngram_join.keep_first(frame, 5, Fraction(8, 10))
    assert kept.columns == frame.columns
    want = X.linked_components([t[:2] for t in X.TEXTS], 5, Fraction(8, 10))
    groups = {c for _, n, c, _ in want if n}
    assert kept.count() == len(groups) + sum(1 for w in want if not w[1])


@pytest.mark.parametrize("n", [1, 40])
def test_chains_and_stars_are_one_component(spark, n):
    chain = [(i, i + 1) for i in range(n)] + [(1000, 1000 + i) for i in range(1, n)] + [(5000, 5000)]
    got = dict(graph.components(spark.createDataFrame(chain, "a long, b long")).collect())
    want = {i: 0 for i in range(n + 1)} | ({1000 + i: 1000 for i in range(n)} if n > 1 else {})
    assert got == want


def test_slices_change_nothing(monkeypatch):
    r = random.Random(6)
    texts = ["".join(r.choice("abc \t\n") for _ in range(n)).encode() for n in (0, 3, 49, 50, 700, 120, 2000)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    at = np.cumsum([0, *(len(t) for t in texts)])
    whole = [x.tolist() for x in (*suffix_dedup.samples(data, at), *ngram_join.shingle_sets(data, at, 3))]
    monkeypatch.setattr(suffix_dedup, "SLICE", 64)
    monkeypatch.setattr(ngram_join, "SLICE", 64)
    assert [x.tolist() for x in (*suffix_dedup.samples(data, at), *ngram_join.shingle_sets(data, at, 3))] == whole
