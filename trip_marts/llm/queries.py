"""The corpus operators as queries over the test tables, one for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trip_marts.llm import bpe, exact_dedup, html_main, imatch, minhash, mixing, quality, repair, secret_scan, token_files, toxicity, vector_dedup, whitening
from trip_marts.llm.shared import ship, table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secret_scan.digest(table(ship(spark), sf_dir, "documents"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of every vector to others with a cosine of 0.9 or more."""
    return vector_dedup.near_vectors(table(ship(spark), sf_dir, "embeddings"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate and copies of every document for the target weights of the languages."""
    return mixing.rates(table(ship(spark), sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(ship(spark), sf_dir, "pages")
    return html_main.extract(pages, html_main.train(pages))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(ship(spark), sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return _decided(toxicity.score(docs, model), 4, 2)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places and checksums of every document's ids, read back from the files."""
    return token_files.round_trip(table(ship(spark), sf_dir, "documents"), token_files.default_tokenizer())


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and their likeness."""
    return imatch.edit_digest(table(ship(spark), sf_dir, "documents"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by 0.8 on shingles of two words."""
    found = minhash.near_duplicates(table(ship(spark), sf_dir, "documents"), 2, 80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(ship(spark), sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return _decided(quality.score(docs, model), 5, 0)


def _decided(scored: DataFrame, modulus: int, held_out: int) -> DataFrame:
    """Scores with their fold and the decision at 0.3."""
    outside = F.coalesce(quality.fold(modulus) == held_out, F.lit(False)).alias("held_out")
    return scored.select("doc_id", outside, "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes of every document."""
    return bpe.digest(table(ship(spark), sf_dir, "documents"), bpe.default_ranks())


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document."""
    return exact_dedup.equal_texts(table(ship(spark), sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    return repair.repair_digest(table(ship(spark), sf_dir, "conversations"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every vector on the eight largest components."""
    return whitening.whiten(table(ship(spark), sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_embedding_near_dedup,
        op3_source_mixing,
        op4_html_extraction,
        op5_toxicity,
        op6_token_files,
        op7_document_fingerprints,
        op8_minhash_near_dedup,
        op9_quality_classifier,
        op10_byte_bpe,
        op11_exact_dedup,
        op12_conversation_repair,
        op13_embedding_whitening,
    )
}

#: The other operators learn, hash or merge in ways that SQL can't express, or not on
#: whole tables in reasonable time; tests/llm compares them with brute force.
ORACLE: dict[str, str] = {
    # rows are known by their numbers, as ids may be null or repeat
    "op2_embedding_near_dedup": """
        WITH RECURSIVE given AS (
            SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS v FROM embeddings
        ),
        fit AS (
            SELECT r, CASE WHEN len(v) > 0 AND len(list_filter(v, lambda x: x IS NOT NULL AND isfinite(x))) = len(v)
                AND len(list_filter(v, lambda x: x <> 0)) > 0 THEN list_transform(v, lambda x: coalesce(x, 0)) END AS v
            FROM given
        ),
        links AS (
            SELECT a.r AS a, b.r AS b FROM fit AS a JOIN fit AS b ON a.r <> b.r AND len(a.v) = len(b.v)
            WHERE list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))
                >= 0.9 * sqrt(list_sum(list_transform(a.v, lambda x: x * x)) * list_sum(list_transform(b.v, lambda x: x * x)))
        ),
        reached AS (
            SELECT a, b FROM links
            UNION
            SELECT x.a, l.b FROM reached AS x JOIN links AS l ON l.a = x.b
        )
        SELECT g.vec_id, (SELECT count(*) FROM links AS l WHERE l.a = g.r) AS n_links,
            least(g.vec_id, m.least) AS component_id, g.vec_id <= coalesce(m.least, g.vec_id) AS kept
        FROM given AS g LEFT JOIN (
            SELECT x.a, min(o.vec_id) AS least FROM reached AS x JOIN given AS o ON o.r = x.b GROUP BY x.a
        ) AS m ON m.a = g.r
    """,
    "op8_minhash_near_dedup": r"""
        WITH RECURSIVE worded AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ),
        sets AS (
            SELECT doc_id, list_sort(CASE WHEN len(w) < 2 THEN w
                ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END) AS s
            FROM worded
        ),
        classes AS (SELECT s, row_number() OVER () AS c, len(s) AS n FROM (SELECT DISTINCT s FROM sets WHERE len(s) > 0)),
        shingles AS (
            SELECT c, n, g, row_number() OVER (PARTITION BY c ORDER BY f, g) AS i
            FROM (SELECT c, n, g, count(*) OVER (PARTITION BY g) AS f FROM (SELECT c, n, unnest(s) AS g FROM classes))
        ),
        -- sets that share 0.8 share one of the rarest fifth of their shingles
        prefixes AS (SELECT c, n, g FROM shingles WHERE i <= n - ceil(0.8 * n) + 1),
        candidates AS (
            SELECT DISTINCT a.c AS a, b.c AS b FROM prefixes AS a JOIN prefixes AS b ON a.g = b.g AND a.c < b.c
            WHERE 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
        ),
        shared AS (
            SELECT a, b, x.n + y.n AS total, len(list_intersect(x.s, y.s)) AS common
            FROM candidates JOIN classes AS x ON x.c = a JOIN classes AS y ON y.c = b
        ),
        links AS (
            SELECT a, b FROM shared WHERE 100 * common >= 80 * (total - common)
            UNION ALL SELECT b, a FROM shared WHERE 100 * common >= 80 * (total - common)
        ),
        reached AS (
            SELECT c AS a, c AS b FROM classes
            UNION
            SELECT x.a, l.b FROM reached AS x JOIN links AS l ON l.a = x.b
        ),
        firsts AS (SELECT c, min(doc_id) AS least FROM sets JOIN classes USING (s) GROUP BY c),
        named AS (SELECT x.a AS c, min(least) AS component_id FROM reached AS x JOIN firsts AS f ON f.c = x.b GROUP BY x.a)
        SELECT doc_id, coalesce(len(s), 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id,
            coalesce(component_id, doc_id) = doc_id AS kept
        FROM sets LEFT JOIN classes USING (s) LEFT JOIN named USING (c)
    """,
    "op11_exact_dedup": r"""
        SELECT doc_id, first_value(doc_id) OVER best AS keep_id,
            count(*) OVER (PARTITION BY sha) AS group_size,
            row_number() OVER best = 1 AS kept, sha AS text_sha256
        FROM (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS sha
            FROM documents
        )
        WINDOW best AS (PARTITION BY sha ORDER BY n DESC, doc_id NULLS LAST)
    """,
    # CRC-32 by its polynomial; then, row by row, the cheapest and least audit of each state
    "op12_conversation_repair": r"""
        WITH RECURSIVE crc AS (
            SELECT list(list_reduce([n] || range(8), lambda c, k:
                CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS t
            FROM range(256) AS numbers(n)
        ),
        given AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(
                [4294967295] || list_transform(string_split(
                    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT),
                lambda c, b: xor(t[1 + (xor(c, b) & 255)], c >> 8))) % 20 AS damage
            FROM conversations, crc
        ),
        damaged AS (
            SELECT conv_id, turn, CASE damage WHEN 4 THEN 'user' ELSE role END AS role,
                CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM given, range(2) AS copies(copy)
            WHERE damage <> 0 AND (copy = 0 OR damage = 3)
        ),
        numbered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
                left(role, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said
            FROM damaged
        ),
        faulted AS (
            SELECT *, CASE WHEN said = '' THEN 'blank'
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
                lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
            FROM numbered
        ),
        inserts(s, t, price, letters, lines) AS (
            VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
                (0, 2, 3, 'I', chr(10) || 'user:'), (1, 2, 3, 'I', chr(10) || 'user:'),
                (2, 3, 3, 'I', chr(10) || 'assistant:'), (3, 2, 3, 'I', chr(10) || 'user:'),
                (0, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
                (1, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')
        ),
        edits(s, initial, letter, t, price, role) AS (
            VALUES (0, NULL, 'D', 0, 4, NULL), (1, NULL, 'D', 1, 4, NULL), (2, NULL, 'D', 2, 4, NULL), (3, NULL, 'D', 3, 4, NULL),
                (0, 's', 'K', 1, 0, NULL), (0, 'u', 'K', 2, 0, NULL), (1, 'u', 'K', 2, 0, NULL),
                (2, 'a', 'K', 3, 0, NULL), (3, 'u', 'K', 2, 0, NULL),
                (0, NULL, 'R', 2, 3, 'user'), (1, NULL, 'R', 2, 3, 'user'), (2, NULL, 'R', 3, 3, 'assistant'), (3, NULL, 'R', 2, 3, 'user')
        ),
        best AS (
            SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS s, 0::BIGINT AS cost, '' AS audit, '' AS body FROM faulted
            UNION ALL
            SELECT conv_id, i, s, cost, audit, body FROM (
                SELECT r.conv_id, r.i, e.t AS s,
                    b.cost + n.price + e.price + CASE WHEN e.letter <> 'D' AND r.fault = 'truncated' THEN 3 ELSE 0 END AS cost,
                    b.audit || n.letters || e.letter AS audit,
                    b.body || n.lines || CASE WHEN e.letter = 'D' THEN '' ELSE chr(10) || coalesce(e.role, r.role) || ':' || r.text END AS body
                FROM best AS b JOIN faulted AS r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i + 1
                    JOIN inserts AS n ON n.s = b.s JOIN edits AS e ON e.s = n.t
                WHERE (e.initial IS NULL OR e.initial = r.initial) AND (e.letter = 'D' OR r.fault NOT IN ('blank', 'duplicate'))
            ) QUALIFY row_number() OVER (PARTITION BY conv_id, i, s ORDER BY cost, audit) = 1
        ),
        facts AS (
            SELECT conv_id, count(*) AS size, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM faulted GROUP BY conv_id
        ),
        ended AS (
            SELECT f.*, b.cost + n.price AS cost, b.audit || n.letters AS audit, substr(b.body || n.lines, 2) AS body
            FROM facts AS f JOIN best AS b ON b.conv_id IS NOT DISTINCT FROM f.conv_id AND b.i = f.size
                JOIN inserts AS n ON n.s = b.s AND n.t IN (0, 3)
            QUALIFY row_number() OVER (PARTITION BY f.conv_id ORDER BY b.cost + n.price, b.audit || n.letters) = 1
        )
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
            coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
            coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) AS c
            LEFT JOIN ended AS e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
    """,
}
