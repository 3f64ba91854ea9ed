"""The registered queries: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann_forest import nearest
from .bottom_k import near_duplicates
from .bpe import encode_documents
from .common import read_table
from .conversation_trie import prefix_trie
from .exact_dedup import exact_groups
from .license_scan import license_notices
from .mixing import Mix, mixed
from .personal_data import personal_spans
from .phrases import collocations
from .quality import quality_scores
from .secret_scan import secret_spans
from .suffix_dedup import remove_repeats
from .token_counts import token_counts

#: The tokenizer of the registered queries; the operators take any path.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read_table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(read_table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read_table(spark, sf_dir, "documents"), TOKENIZER)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"), TOKENIZER)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(read_table(spark, sf_dir, "documents"), Mix())


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_notices(read_table(spark, sf_dir, "documents"))
    named = F.transform("found", lambda x: F.concat_ws(":", x["paragraph"], x["family"], x["confirmed"].cast("string")))
    return found.withColumn("found", F.array_join(named, ","))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents")).drop("spans")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each lang, from counts over all documents."""
    return collocations(read_table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all rebuilt conversations."""
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans by fixed expressions and those that the trained classifier adds, of every document."""
    return personal_spans(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_ann": op2_ann,
    "op3_mixing": op3_mixing,
    "op4_secret_scan": op4_secret_scan,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_bpe": op6_bpe,
    "op7_near_dedup": op7_near_dedup,
    "op8_license_scan": op8_license_scan,
    "op9_token_counts": op9_token_counts,
    "op10_quality": op10_quality,
    "op11_phrases": op11_phrases,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_personal_data": op13_personal_data,
}

ORACLE_SQL = {
    "op1_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
        )
        SELECT doc_id,
               min(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY t) AS kept,
               sha256(t) AS text_sha256
        FROM n
    """,
    "op5_suffix_dedup": r"""
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        windows AS (
            SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS w
            FROM d, LATERAL (SELECT unnest(range(0, length(h) // 2 - 49)) AS i)
        ),
        firsts AS (SELECT w, min(doc_id) AS first_id FROM windows GROUP BY w),
        gone AS (SELECT doc_id, i FROM windows JOIN firsts USING (w) WHERE first_id < doc_id),
        marked AS (
            SELECT *, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 50 AS apart FROM gone
        ),
        runs AS (
            SELECT *, count(*) FILTER (WHERE apart) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked
        ),
        spans AS (
            SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY doc_id, run
        ),
        pieces AS (
            SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM spans
        ),
        cut AS (
            SELECT p.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
                   string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a)
                   || substr(any_value(h), 2 * max(b) + 1) AS kept
            FROM pieces p JOIN d ON d.doc_id = p.doc_id GROUP BY p.doc_id
        )
        SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
               CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
        FROM d LEFT JOIN cut ON cut.doc_id = d.doc_id
    """,
    "op7_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ),
        sets AS (
            SELECT doc_id, list_distinct(CASE
                       WHEN len(words) = 0 THEN []
                       WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                       ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
                   END) AS shingles
            FROM w
        ),
        sizes AS (SELECT doc_id, len(shingles) AS n FROM sets),
        each AS (SELECT doc_id, unnest(shingles) AS shingle FROM sets),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
            FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
        ),
        links AS (
            SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * c >= 75 * (x.n + y.n - c)
        ),
        reached AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION
            SELECT doc_id, b FROM reached JOIN links ON a = other
        )
        SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, min(other) AS component_id, min(other) = doc_id AS kept
        FROM reached JOIN sizes USING (doc_id) GROUP BY doc_id, n
    """,
    "op11_phrases": r"""
        WITH texts AS (
            SELECT doc_id, coalesce(lang, 'und') AS lang,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        ),
        pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
        words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        grams AS (
            SELECT lang, s AS size, array_to_string(w[i:i + s - 1], ' ') AS phrase
            FROM words, LATERAL (SELECT unnest(range(1, len(w) + 1)) AS i), (SELECT unnest(range(1, 6)) AS s)
            WHERE i + s - 1 <= len(w)
        ),
        f AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
        totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
        candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size >= 2),
        cut AS (
            SELECT c.*, k, array_to_string(w[1:k], ' ') AS first_part, array_to_string(w[k + 1:], ' ') AS rest
            FROM candidates c, LATERAL (SELECT unnest(range(1, size)) AS k)
        ),
        scored AS (
            SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, CAST(t.n AS BIGINT) AS n,
                   CAST((1000 * CAST(c.a AS HUGEINT) * CAST(t.n AS HUGEINT)) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
            FROM cut c JOIN totals t ON t.lang = c.lang
            JOIN f x ON x.lang = c.lang AND x.phrase = c.first_part AND x.size = c.k
            JOIN f y ON y.lang = c.lang AND y.phrase = c.rest AND y.size = c.size - c.k
        ),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        alone AS (
            SELECT * FROM best b WHERE NOT EXISTS (
                SELECT 1 FROM candidates c
                WHERE c.lang = b.lang AND c.a >= b.a AND length(c.phrase) > length(b.phrase)
                  AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ')
            )
        ),
        ranked AS (
            SELECT *, row_number() OVER (
                       PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)
                   ) AS rank
            FROM alone
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
    """,
    "op12_prefix_trie": r"""
        WITH RECURSIVE turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations WHERE conv_id IS NOT NULL
        ),
        placed AS (
            SELECT *, row_number() OVER (
                       PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)
                   ) AS place
            FROM turns
        ),
        crc AS (
            SELECT conv_id, CAST(conv_id AS VARCHAR) AS s, 0 AS k, CAST(4294967295 AS BIGINT) AS c
            FROM (SELECT DISTINCT conv_id FROM turns)
            UNION ALL
            SELECT conv_id, s, k + 1, CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END
            FROM (
                SELECT *, CASE WHEN k % 8 = 0 THEN xor(c, CAST(ascii(substr(s, k // 8 + 1, 1)) AS BIGINT)) ELSE c END AS y
                FROM crc WHERE k < 8 * length(s)
            )
        ),
        heads AS (SELECT conv_id, xor(c, 4294967295) % 6 AS h FROM crc WHERE k = 8 * length(s)),
        parts AS (
            SELECT h.conv_id, 0 AS part, p.place, p.role, p.text
            FROM heads h JOIN placed p ON p.conv_id = h.conv_id - h.conv_id % 100 AND p.place <= h.h
            UNION ALL
            SELECT h.conv_id, 1, p.place, p.role, p.text FROM heads h JOIN placed p USING (conv_id) WHERE p.place > h.h
        ),
        rebuilt AS (
            SELECT conv_id, row_number() OVER w AS d, text,
                   md5(string_agg(length(role) || ':' || length(text) || ':' || role || text, '') OVER w) AS prefix
            FROM parts
            WINDOW w AS (PARTITION BY conv_id ORDER BY part, place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            UNION ALL
            SELECT conv_id, 0, '', '' FROM heads
        ),
        lines AS (SELECT *, max(d) OVER (PARTITION BY conv_id) AS n FROM rebuilt),
        nodes AS (
            SELECT d, prefix, min(conv_id) AS c, count(*) AS n_convs, any_value(length(text)) AS points,
                   string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = n) AS ends
            FROM lines GROUP BY d, prefix
        ),
        linked AS (
            SELECT n.*, p.c AS parent
            FROM nodes n LEFT JOIN lines l ON l.conv_id = n.c AND l.d = n.d - 1
            LEFT JOIN nodes p ON p.d = l.d AND p.prefix = l.prefix
        ),
        children AS (SELECT parent, d - 1 AS d, count(*) AS n FROM linked WHERE d > 0 GROUP BY ALL),
        sums AS (
            SELECT a.c, a.d, count(*) FILTER (WHERE k.n IS NULL) AS n_leaves, sum((b.n_convs - 1) * b.points) AS saved
            FROM nodes a JOIN lines l ON l.d = a.d AND l.prefix = a.prefix
            JOIN nodes b ON b.c = l.conv_id AND b.d >= a.d
            LEFT JOIN children k ON k.parent = b.c AND k.d = b.d
            GROUP BY a.c, a.d
        )
        SELECT l.c AS conv_id, CAST(l.d AS BIGINT) AS depth, l.parent AS parent_conv_id, l.n_convs,
               CAST(coalesce(k.n, 0) AS BIGINT) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
               CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(l.ends, '')) AS ends_sha256
        FROM linked l JOIN sums s ON s.c = l.c AND s.d = l.d LEFT JOIN children k ON k.parent = l.c AND k.d = l.d
    """,
}
