"""The queries opN_<name>: thin digests of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepulse.llm import (
    bpe,
    fingerprint,
    language,
    lexical_search,
    line_dedup,
    mixing,
    ngram_join,
    periodic_runs,
    secrets,
    suffix_dedup,
    toxicity,
    warc_zip,
)
from tablepulse.llm.common import benchmark, documents, labels, pages
from tablepulse.llm.exact_dedup import exact_duplicates


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digests(documents(spark, sf_dir))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.identify(docs, language.train(docs))


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.document_fingerprints(documents(spark, sf_dir))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.judged(docs, toxicity.train(docs, labels(spark, sf_dir)))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.token_digests(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf_dir))
    return found.withColumn("secret_sha256", F.sha2("secret", 256)).drop("secret")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "n_links")


def op9_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.round_trip(pages(spark, sf_dir)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(periodic_runs.with_planted_runs(documents(spark, sf_dir)))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digests(documents(spark, sf_dir))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(lexical_search.build_index(documents(spark, sf_dir)), benchmark(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_language_id": op3_language_id,
    "op4_fingerprint": op4_fingerprint,
    "op5_toxicity": op5_toxicity,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_secret_scan": op7_secret_scan,
    "op8_ngram_join": op8_ngram_join,
    "op9_warc_zip": op9_warc_zip,
    "op10_mixing": op10_mixing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_line_dedup": op12_line_dedup,
    "op13_lexical_search": op13_lexical_search,
}

SQL: dict[str, str] = {
    "op1_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS x FROM documents
        )
        SELECT doc_id,
               min(doc_id) OVER (PARTITION BY x) AS keep_id,
               count(*) OVER (PARTITION BY x) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY x) AS kept,
               sha256(x) AS text_sha256
        FROM t
    """,
    "op8_ngram_join": r"""
        WITH RECURSIVE t AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                   ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g
            FROM t
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), p AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
        ), e AS (
            SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 90 * (nx.n + ny.n - k)
        ), r AS (
            SELECT doc_id AS x, doc_id AS y FROM documents
            UNION
            SELECT r.x, e.y FROM r JOIN e ON r.y = e.x
        )
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, coalesce(l.n_links, 0) AS n_links
        FROM documents d
        JOIN (SELECT x, min(y) AS component_id FROM r GROUP BY x) c ON c.x = d.doc_id
        LEFT JOIN n ON n.doc_id = d.doc_id
        LEFT JOIN (SELECT x, count(*) AS n_links FROM e GROUP BY x) l ON l.x = d.doc_id
    """,
    # each base-32 digit is five bits of the digest
    "op9_warc_zip": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS h FROM pages
        ), d AS (
            SELECT page_id, h, max(page_id) OVER (PARTITION BY h) AS first_id, unhex(sha1(h))::BIT::VARCHAR AS bits FROM p
        )
        SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
                   16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT + 4 * substr(bits, 5 * i + 3, 1)::INT +
                   2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT, 1)), '') AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM d
    """,
    "op2_suffix_dedup": r"""
        WITH t AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, ''))::BIGINT AS n FROM documents
        ), w AS (
            SELECT doc_id, p, substr(h, (2 * p + 1)::BIGINT, 100) AS s FROM (SELECT doc_id, h, unnest(range(n - 49)) AS p FROM t WHERE n >= 50)
        ), f AS (
            SELECT s, min(doc_id) AS first_id FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)
        ), r AS (
            SELECT w.doc_id, w.p, lag(w.p) OVER (PARTITION BY w.doc_id ORDER BY w.p) AS before FROM w JOIN f USING (s) WHERE f.first_id < w.doc_id
        ), g AS (
            SELECT doc_id, p, sum(CASE WHEN before IS NULL OR p > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM r
        ), runs AS (
            SELECT doc_id, run, min(p) AS a, max(p) + 50 AS b FROM g GROUP BY doc_id, run
        ), k AS (
            SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans, list(a ORDER BY a) AS starts, list(b ORDER BY a) AS ends
            FROM runs GROUP BY doc_id
        )
        SELECT t.doc_id, t.n AS n_bytes, coalesce(k.n_removed, 0) AS n_removed, coalesce(k.n_spans, 0) AS n_spans,
               sha256(unhex(CASE WHEN k.doc_id IS NULL THEN t.h ELSE array_to_string(list_transform(range(len(starts) + 1), lambda i: substr(t.h,
                   CASE WHEN i = 0 THEN 1 ELSE 2 * ends[i] + 1 END, CASE WHEN i = len(starts) THEN length(t.h) ELSE 2 * starts[i + 1] END -
                   CASE WHEN i = 0 THEN 0 ELSE 2 * ends[i] END)), '') END)) AS kept_sha256
        FROM t LEFT JOIN k ON k.doc_id = t.doc_id
    """,
    # pairs of equal words d apart, their stretches, and of the stretches that cover the same words the smallest d
    "op11_periodic_runs": r"""
        WITH t AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                   list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
                       lambda c: [ascii(c)::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))),
                       lambda x, y: xor(xor(x, y) >> 1, CASE WHEN xor(x, y) & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END)) AS c
            FROM documents
        ), u AS (
            SELECT *, len(w)::BIGINT AS n, xor(c, 4294967295::UBIGINT)::BIGINT AS h FROM t
        ), v AS (
            SELECT *, (h // 10) % greatest(n, 1) AS a, 1 + (n - (h // 10) % greatest(n, 1)) // (3 + (h // 10) % 8) AS p FROM u
        ), x AS (
            SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w
            FROM v
        ), e AS (
            SELECT r, unnest(range(n)) AS i, unnest(w) AS word FROM x
        ), g AS (
            SELECT r, list(i ORDER BY i) AS places FROM e GROUP BY r, word HAVING count(*) > 2
        ), o AS (
            SELECT r, unnest(places) AS i, places FROM g
        ), pairs AS (
            SELECT r, i, unnest(list_filter(places, lambda j: j > i)) - i AS d FROM o
        ), islands AS (
            SELECT r, d, i, i - row_number() OVER (PARTITION BY r, d ORDER BY i) AS k FROM pairs
        ), found AS (
            SELECT r, d, min(i) AS s, count(*) + d AS l FROM islands GROUP BY r, d, k HAVING count(*) + d >= greatest(24, 3 * d)
        ), runs AS (
            SELECT r, s, l, min(d) AS q FROM found GROUP BY r, s, l
        ), gone AS (
            SELECT DISTINCT r, unnest(range(s + q, s + l)) AS i FROM runs
        ), kept AS (
            SELECT e.r, string_agg(word, ' ' ORDER BY e.i) AS txt FROM e ANTI JOIN gone ON gone.r = e.r AND gone.i = e.i GROUP BY e.r
        ), listed AS (
            SELECT r, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS txt FROM runs GROUP BY r
        ), best AS (
            SELECT * FROM runs a WHERE NOT EXISTS (
                SELECT 1 FROM runs b WHERE b.r = a.r AND (b.l * a.q > a.l * b.q OR (b.l * a.q = a.l * b.q AND (b.s < a.s OR (b.s = a.s AND b.q < a.q))))
            )
        )
        SELECT x.doc_id, coalesce(listed.n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.q AS period,
               1000 * best.l // best.q AS exponent_milli, sha256(coalesce(listed.txt, '')) AS runs_sha256, sha256(coalesce(kept.txt, '')) AS collapsed_sha256
        FROM x LEFT JOIN listed ON listed.r = x.r LEFT JOIN best ON best.r = x.r LEFT JOIN kept ON kept.r = x.r
    """,
    "op12_line_dedup": r"""
        WITH t AS (
            SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
        ), l AS (
            SELECT r, doc_id, unnest(range(len(lines))) AS pos, unnest(lines) AS line FROM t
        ), k AS (
            SELECT r, doc_id, pos, line, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM l
        ), h AS (
            SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
        ), d AS (
            SELECT k.*, h.key IS NOT NULL AND k.doc_id <> h.first_id AS gone FROM k LEFT JOIN h ON h.key = k.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM d GROUP BY r, doc_id
    """,
    "op13_lexical_search": r"""
        WITH t AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL
        ), c AS (
            SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM t WHERE len(w) > 0
        ), q AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
        ), e AS (
            SELECT r, doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM t
        ), f AS (
            SELECT r, doc_id, n, term, count(*) AS tf FROM e WHERE term IN (SELECT term FROM q) GROUP BY r, doc_id, n, term
        ), z AS (
            SELECT term, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS weight FROM f, c GROUP BY term, n_docs
        ), s AS (
            SELECT q.item_id, f.r, f.doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
            FROM q JOIN f ON f.term = q.term JOIN z ON z.term = q.term, c GROUP BY q.item_id, f.r, f.doc_id
        )
        SELECT item_id, rank, doc_id, score FROM (
            SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s WHERE score > 0
        ) WHERE rank <= 50
    """,
}
