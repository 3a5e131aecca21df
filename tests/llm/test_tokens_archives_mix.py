"""BPE against the tiktoken library, archives round trip, mixing, entry queries."""

import base64
import hashlib
import io
import random
import zipfile
from collections import Counter

import fixtures as X
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tablepulse.llm import bpe, mixing, registered, warc_zip
from tablepulse.session import work_path

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_tree_encoding_is_the_library_s(library):
    codec, r = bpe.Codec(RANKS, public_tokenizers.PATTERN), random.Random(4)
    alphabets = ["ab", "a", "abcdefghij", "the and ing tion", "aé漢字\U0001f600", "0123456789ab", " \n\t.!$%", "hello world"]
    for _ in range(600):
        text = "".join(r.choice(r.choice(alphabets)) for _ in range(r.choice([0, 1, 5, 40, 300])))
        ids = np.frombuffer(codec.encode(text), "<u4").tolist()
        assert ids == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()
        # the whole text as one piece: long pieces go through many joins
        assert codec.encode_piece(text.encode()) == (library._core_bpe.encode_single_piece(text.encode()) if text else [])


def test_token_digests(spark, library):
    got = bpe.token_digests(X.docs(spark), RANKS, public_tokenizers.PATTERN).collect()
    want = []
    for i, t, *_ in X.TEXTS:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), X.sha(np.array(ids, "<u4").tobytes()), X.sha(t or "")))
    assert X.by_all(got) == X.by_all(want)
    assert bpe.token_digests(X.empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


PAGES = [(1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (3, None, "<p>é other</p>"), (4, "http://a/ 4\r\n", None), (5, "http://a/5", ""),
         (None, "http://a/n", "<p>same</p>"), (2, "http://a/2b", "<p>same</p>"), (6, "http://a/6", "x" * 200_000)]


def pages_by_hand(pages, least=0):
    groups = {}
    for i, _, h in pages:
        groups.setdefault(h or "", []).append(i)
    out = []
    for i, _, h in pages:
        payload = (h or "").encode()
        first = max((k for k in groups[h or ""] if k is not None), default=None)
        revisit = first is not None and i != first and len(payload) >= least
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((i, len(payload), digest, "revisit" if revisit else "response", first if revisit else None))
    return out


@pytest.mark.parametrize("package_bytes", [1, 256 << 20])
def test_archives_round_trip(spark, package_bytes):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, payload string").repartition(3)
    packages = warc_zip.write_packages(pages, work_path(spark, "warc"), 0, package_bytes)
    back = warc_zip.read_records(packages).collect()
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in back]
    assert X.by_all(got) == X.by_all(pages_by_hand(PAGES))
    html = {(i, h or "") for i, _, h in PAGES}
    assert all((r["page_id"], r["payload"].decode()) in html for r in back if r["record_type"] == "response")
    if package_bytes == 1:
        assert packages.count() == len(PAGES)


def test_short_payloads_are_never_revisits(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    back = warc_zip.read_records(warc_zip.write_packages(pages, work_path(spark, "warc"), least_revisit_bytes=12)).collect()
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in back]
    assert X.by_all(got) == X.by_all(pages_by_hand(PAGES, 12))


def test_no_pages(spark):
    assert warc_zip.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("comment", [b"", b"PK\x05\x06 in a comment"])
def test_zip_directories(comment):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        with z.open(zipfile.ZipInfo("a"), "w", force_zip64=True) as f:
            f.write(b"abc" * 10)
        z.writestr("b.txt", b"hello")
        z.comment = comment
    found = {m.name: m for m in warc_zip.members(out, len(out.getvalue()))}
    assert set(found) == {"a", "b.txt"}
    assert warc_zip.read_at(out, warc_zip.data_start(out, found["a"]), found["a"].size) == b"abc" * 10
    assert warc_zip.read_at(out, warc_zip.data_start(out, found["b.txt"]), 5) == b"hello"


def test_zip64_directories(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 3)
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 50)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for k in range(6):
            with z.open(zipfile.ZipInfo(f"m{k}"), "w", force_zip64=True) as f:
                f.write(bytes([k]) * (40 + 10 * k))
    assert warc_zip.END_RECORD_64 in out.getvalue()
    for k, m in enumerate(warc_zip.members(out, len(out.getvalue()))):
        assert warc_zip.read_at(out, warc_zip.data_start(out, m), m.size) == bytes([k]) * (40 + 10 * k)


def test_damaged_and_compressed_packages_raise():
    with pytest.raises(ValueError, match="no end record"):
        warc_zip.members(io.BytesIO(b"x" * 100), 100)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"abc" * 100)
    with pytest.raises(ValueError, match="compressed"):
        warc_zip.data_start(out, warc_zip.members(out, len(out.getvalue()))[0])


def targets_by_hand(sizes, weights=(1, 2, 3), most=3):
    """Sources in order, capped one after the other."""
    per = {}
    for s, n in sizes:
        per[s] = per.get(s, 0) + n
    order = sorted(per, key=lambda s: (s is None, s.encode() if s else b""))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    total, full = sum(per.values()), set()
    while True:
        left = total - sum(most * per[s] for s in full)
        open_ = sum(weight[s] for s in per if s not in full)
        target = {s: most * per[s] if s in full else left * weight[s] / open_ for s in per}
        more = {s for s in per if s not in full and target[s] >= most * per[s]}
        if not more or not open_:
            return per, target
        full |= more
        if len(full) == len(per):
            return per, {s: most * per[s] for s in per}


def mix_case(n=400, seed=3):
    r = random.Random(seed)
    sources = ["a"] * 30 + ["b", "c", "\U0001f600", "é", None]
    return [(r.choice([i, i, i, 7, None]), " ".join(["w"] * r.choice([0, 1, 5, 50, r.randint(1, 400)])) or None, "en", r.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("cell", [16, 4096])
def test_mix_meets_its_targets(spark, cell):
    rows = mix_case()
    got = mixing.mixed(X.docs(spark, rows).repartition(3), cell_units=cell).collect()
    per, target = targets_by_hand([(s, len((t or "").split())) for _, t, _, s in rows])
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter((i, s, len((t or "").split())) for i, t, _, s in rows)
    taken = {}
    for r in got:
        assert r["source_size"] == per[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["times"] * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert all(abs(taken[s] - target[s]) <= max(0.03 * target[s], 60) for s in target)
    again = mixing.mixed(X.docs(spark, rows).repartition(5), cell_units=cell).collect()
    assert X.by_all(got) == X.by_all(again)


def test_flight_keeps_words_and_documents():
    rng = np.random.default_rng(1)
    size = [int(x) for x in rng.integers(1, 1000, 500)]
    p = [0.3] * 500
    q = mixing.flight(p, size, rng)
    assert sum(0 < x < 1 for x in q) < 3
    assert sum(q) == pytest.approx(150)
    assert sum(x * s for x, s in zip(q, size, strict=True)) == pytest.approx(0.3 * sum(size))


def test_mix_documents_repeats_rows(spark):
    rows = mix_case(150, 8)
    frame = X.docs(spark, rows)
    out = mixing.mix_documents(frame)
    assert out.columns == frame.columns
    want = Counter()
    for r in mixing.mixed(frame).collect():
        want[r["doc_id"], r["source"], r["size"]] += r["times"]
    got = Counter((r["doc_id"], r["source"], len((r["text"] or "").split())) for r in out.collect())
    assert got == +want


def test_mix_of_nothing(spark):
    assert mixing.mixed(X.empty(spark)).count() == 0
    assert mixing.mix_documents(X.empty(spark)).count() == 0
    got = mixing.mixed(X.docs(spark, [(1, None, "en", "a"), (2, "", "en", None)])).collect()
    assert [(r["target"], r["taken"]) for r in got] == [(0.0, 0), (0.0, 0)]


def test_registered_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in registered.QUERIES) == list(range(1, 14))
    assert set(registered.SQL) <= set(registered.QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "n-gram Jaccard join", "mixing sources to target weights", "byte-level BPE encoding and decoding"]
