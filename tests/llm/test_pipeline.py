"""The corpus pipeline, stage by stage, against brute force."""

import random
from collections import Counter
from fractions import Fraction

import corpus_pipeline
import fixtures as X
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tablepulse.llm import bpe, mixing, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus(seed=4):
    """Clean and toxic documents, exact copies (of other ids, with other white space), near copies, repeated and awkward rows."""
    r = random.Random(seed)
    plain = ["".join(r.choice("aeiou") + r.choice("rstlnd") for _ in range(r.randint(2, 4))) for _ in range(300)]
    rows, labels = [], []

    def add(i, text, source):
        rows.append((i, text, "en", source, len(text or "")))

    for i in range(260):
        words = [r.choice(plain) for _ in range(r.randint(40, 90))]
        if i % 4 == 0:
            for k in r.sample(range(len(words)), 6):
                words[k] = r.choice(["zorkface", "blimphead", "quuxwit"])
        labels.append((i, 1, int(i % 4 == 0)))
        add(i, " ".join(words), f"s{i % 5}" if i % 7 else None)
    clean = [x for x in rows if x[0] % 4]
    for k, x in enumerate(clean[:40]):
        add(1000 + k, x[1].replace(" ", "  \t", 2), "s1")
    for k, x in enumerate(clean[40:80]):
        words = x[1].split()
        words[k % len(words)] = "changed"
        add(2000 + k, " ".join(words), "s2")
    for i, text in ((3000, None), (3001, ""), (3002, " \n "), (3003, "three words only"), (3003, "three words only"), (3003, "three other words")):
        add(i, text, "s3")
    for text in ["no id here at all", "no id here at all", "another without an id", None]:
        add(None, text, None)
    return rows, labels


def as_rows(frame):
    return Counter(tuple(r[c] for c in COLUMNS) for r in frame.select(*COLUMNS).collect())


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    rows, labels = corpus()
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.fixture(scope="module")
def stages(spark, tables):
    """(what each stage got, what it wrote)."""
    docs, seen = spark.read.parquet(f"{tables}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, tables).write.parquet(f"{tables}/stage{k}")
        seen.append((docs, spark.read.parquet(f"{tables}/stage{k}")))
        docs = seen[-1][1]
    return seen


def test_stages_one_by_one(spark, tables, stages):
    seen = stages
    # toxicity: every text scored alone
    before, after = seen[0]
    model = toxicity.train(before, spark.read.parquet(f"{tables}/labels.parquet"))
    want = Counter({row: n for row, n in as_rows(before).items() if toxicity.score(model, row[1] or "") < 0.5})
    assert as_rows(after) == want
    ids = {row[0] for row in want}
    assert sum(i % 4 == 0 for i in ids if i is not None and i < 260) <= 6 and sum(i % 4 != 0 for i in ids if i is not None and i < 260) >= 185
    # exact copies: of equal normalised texts the smallest id
    before, after = map(as_rows, seen[1])
    groups = {}
    for row in before:
        groups.setdefault(X.normalised(row[1]), []).append(row[0])
    assert Counter((row[0], X.normalised(row[1])) for row in after.elements()) == Counter((X.least(found), text) for text, found in groups.items())
    assert set(after) <= set(before) and sum(after.values()) < sum(before.values()) - 35
    # near copies: of each component the smallest id, by comparing all pairs
    before, after = map(as_rows, seen[2])
    rows = list(before.elements())
    parts = X.linked_components([(row[0], row[1]) for row in rows], 5, Fraction(8, 10))
    want = Counter(row for row, (i, size, component, _) in zip(rows, parts, strict=True) if not size or component == i)
    assert after == want and sum(after.values()) < sum(before.values()) - 20
    # the mix: each document as often as the mix says
    before, after = seen[3]
    times = Counter()
    for row in mixing.mixed(before).collect():
        times[row["doc_id"], row["source"], row["size"]] += row["times"]
    got = Counter((row[0], row[3], len(X.normalised(row[1]).split())) for row in as_rows(after).elements())
    assert got == +times
    assert set(as_rows(after)) <= set(as_rows(before))
    # tokens: as the library has them
    before, after = seen[4]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    want = []
    for row in as_rows(before).elements():
        found = library.encode_ordinary(row[1] or "")
        want.append((row[0], len(found), X.sha(np.array(found, "<u4").tobytes()), X.sha(row[1] or "")))
    assert X.by_all(after.collect()) == X.by_all(want)


def test_run_is_its_stages(spark, tables, stages):
    assert X.by_all(corpus_pipeline.run(spark, tables).collect()) == X.by_all(stages[-1][1].collect())


def test_pipeline_of_nothing(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_mix_of_a_hot_key(spark):
    """Half of all rows have no id and equal sizes."""
    rows = [(None, f"text {k % 3} here", None, "a" if k % 2 else None, 1) for k in range(3000)] + [(k, "some words " * (k % 30 + 1), "en", f"s{k % 4}", 1) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(6)
    times = Counter()
    for row in mixing.mixed(docs).collect():
        times[row["doc_id"], row["source"], row["size"]] += row["times"]
    got = Counter((r["doc_id"], r["source"], len((r["text"] or "").split())) for r in mixing.mix_documents(docs).collect())
    assert got == +times
