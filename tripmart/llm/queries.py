"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import align, backoff, chat, collisions, hnsw, language, packing, partenum, phrases, pieces, quality, urls, warc
from tripmart.llm.common import read


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
        capacity=4096, end_id=2,
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_digests(warc.round_trip(read(spark, sf_dir, "pages"), least_bytes=1000))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.preference_segments(chat.swapped_replies(read(spark, sf_dir, "conversations")))


def op5_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collisions.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op3_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicates(read(spark, sf_dir, "embeddings"), threshold=0.95)


def op10_partenum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.similar_groups(read(spark, sf_dir, "documents"), n=3, similarity=90)


def op2_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = backoff.scores(read(spark, sf_dir, "documents"), order=3, least=2)
    return scored.select(
        "doc_id", "n_words", F.round("log_score", 6).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score")
    )


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language.of_documents(docs, language.learn(docs))


def language_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.of_pages(read(spark, sf_dir, "pages"), language.learn(read(spark, sf_dir, "documents")))


def op1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode_digests(read(spark, sf_dir, "documents"), model)


# Host and path rules of the address filter.
URL_RULES = [
    urls.Rule("org", "/", "allow"),
    urls.Rule("example.org", "/es/", "block"),
    urls.Rule("example.org", "/en/1", "block"),
    urls.Rule("com", "/fr/", "allow"),
    urls.Rule("com", "/de/", "block"),
]


def op12_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"), URL_RULES, urls.JUNK).drop("terms")


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(
        read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"), top=2000, least=30, covered=80)


QUERIES = {
    "op13_phrases": op13_phrases,
    "op11_align": op11_align,
    "op12_urls": op12_urls,
    "op1_pieces": op1_pieces,
    "op4_language": op4_language,
    "language_of_pages": language_of_pages,
    "op2_backoff": op2_backoff,
    "op10_partenum": op10_partenum,
    "op3_hnsw": op3_hnsw,
    "op5_collisions": op5_collisions,
    "op7_chat": op7_chat,
    "op6_warc": op6_warc,
    "op8_packing": op8_packing,
    "op9_quality": op9_quality,
}


def _url_sql() -> str:
    """Rules and terms one by one: prefix tests and a regular expression per term."""
    rules = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in URL_RULES)
    terms = ", ".join([f"('{t}', 1)" for t in urls.JUNK.strict] + [f"('{t}', 0)" for t in urls.JUNK.soft])
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    return f"""
        WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {rules}),
        terms(term, hard) AS (VALUES {terms}),
        u AS (SELECT row_number() OVER () AS row_id, page_id, coalesce(url, '') AS url FROM pages),
        r AS (SELECT *, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM u),
        h AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw_host FROM r),
        p AS (
            SELECT *, translate(raw_host, {letters}) AS host,
              regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path
            FROM h
        ), ruled AS (
            SELECT row_id, rule_host || rule_path AS rule, rule_verdict, row_number() OVER (
                PARTITION BY row_id ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC, rule_verdict DESC) AS place
            FROM p JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        ), hits AS (
            SELECT row_id, sum(hard) AS strict_hits, sum(1 - hard) AS soft_hits
            FROM u JOIN terms ON regexp_matches(translate(url, {letters}), '(^|[^a-z0-9])' || term || '($|[^a-z0-9])')
            GROUP BY row_id
        )
        SELECT page_id, host, path, rule,
          CASE WHEN rule IS NOT NULL THEN rule_verdict
            WHEN coalesce(strict_hits, 0) >= 1 OR coalesce(soft_hits, 0) >= {urls.JUNK.soft_least} THEN 'block' ELSE 'allow' END AS verdict,
          CAST(coalesce(strict_hits, 0) AS BIGINT) AS strict_hits, CAST(coalesce(soft_hits, 0) AS BIGINT) AS soft_hits
        FROM p LEFT JOIN (SELECT * FROM ruled WHERE place = 1) AS best USING (row_id) LEFT JOIN hits USING (row_id)"""


ORACLE: dict[str, str] = {
    "op12_urls": _url_sql(),
    "op13_phrases": r"""
        WITH d AS (
            SELECT coalesce(lang, 'und') AS lang,
              string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\n\x0b\x0c\r]') AS pieces
            FROM documents
        ), p AS (SELECT lang, unnest(pieces) AS piece FROM d),
        w AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS words FROM p),
        g AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w),
        s AS (
            SELECT lang, 1 AS d, words[i:i] AS gram FROM g
            UNION ALL SELECT lang, 2, words[i:i+1] FROM g WHERE i + 1 <= len(words)
            UNION ALL SELECT lang, 3, words[i:i+2] FROM g WHERE i + 2 <= len(words)
            UNION ALL SELECT lang, 4, words[i:i+3] FROM g WHERE i + 3 <= len(words)
        ), f AS (
            SELECT lang, d, array_to_string(gram, ' ') AS phrase, any_value(gram) AS gram, count(*) AS f FROM s GROUP BY lang, d, array_to_string(gram, ' ')
        ), totals AS (SELECT lang, sum(f) AS n FROM f WHERE d = 1 GROUP BY lang),
        c AS (SELECT *, f AS a FROM f WHERE d > 1 AND f >= 30),
        parts AS (
            SELECT lang, phrase, d, gram, a, k, array_to_string(gram[1:k], ' ') AS head, array_to_string(gram[k+1:d], ' ') AS tail
            FROM (SELECT *, unnest(range(1, d)) AS k FROM c)
        ), cuts AS (
            SELECT x.lang, x.phrase, x.a, x.k, h.f AS l, t.f AS r, CAST(2000000 AS HUGEINT) * x.a // (h.f + t.f) AS score
            FROM parts x JOIN f h ON h.lang = x.lang AND h.phrase = x.head AND h.d = x.k
            JOIN f t ON t.lang = x.lang AND t.phrase = x.tail AND t.d = x.d - x.k
        ), best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM cuts),
        inner_ AS (
            SELECT lang, array_to_string(gram[i:i+m-1], ' ') AS phrase, max(a) AS longer
            FROM (SELECT *, unnest(range(1, d - m + 2)) AS i FROM (SELECT *, unnest(range(2, d)) AS m FROM c)) GROUP BY ALL
        ), ranked AS (
            SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank,
              b.phrase, a, l, r, score
            FROM best b LEFT JOIN inner_ o ON o.lang = b.lang AND o.phrase = b.phrase
            WHERE place = 1 AND (longer IS NULL OR CAST(100 AS HUGEINT) * longer < CAST(80 AS HUGEINT) * a)
        )
        SELECT ranked.lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
    "op2_backoff": r"""
        WITH w AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^ \t\n\x0b\f\r]+') AS words
            FROM documents
        ), p AS (
            SELECT doc_id, unnest(words) AS w3, unnest(list_prepend(NULL, words[:-2])) AS w2,
              unnest(list_prepend(NULL, list_prepend(NULL, words[:-3]))[:len(words)]) AS w1
            FROM w WHERE len(words) > 0
        ), n1 AS (SELECT w3 AS a, count(*) AS c FROM p GROUP BY ALL),
        n2 AS (SELECT w2 AS a, w3 AS b, count(*) AS c FROM p WHERE w2 IS NOT NULL GROUP BY ALL),
        n3 AS (SELECT w1 AS a, w2 AS b, w3 AS c3, count(*) AS c FROM p WHERE w1 IS NOT NULL GROUP BY ALL),
        s AS (
            SELECT doc_id, CASE
                WHEN n3.c >= 2 THEN ln(n3.c / h2.c)
                WHEN n2.c >= 2 THEN ln(n2.c / h1.c) + CASE WHEN w1 IS NULL THEN 0 ELSE ln(0.4) END
                ELSE ln(n1.c) - ln((SELECT count(*) FROM p))
                  + CASE WHEN w2 IS NULL THEN 0 WHEN w1 IS NULL THEN ln(0.4) ELSE 2 * ln(0.4) END
              END AS v
            FROM p JOIN n1 ON n1.a = w3
            LEFT JOIN n1 h1 ON h1.a = w2
            LEFT JOIN n2 ON n2.a = w2 AND n2.b = w3
            LEFT JOIN n2 h2 ON h2.a = w1 AND h2.b = w2
            LEFT JOIN n3 ON n3.a = w1 AND n3.b = w2 AND n3.c3 = w3
        ), d AS (SELECT doc_id, count(*) AS n, sum(v) AS v FROM s GROUP BY ALL)
        SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_words, round(coalesce(v, 0.0), 6) AS log_score,
          round(v / n, 6) AS mean_log_score
        FROM w LEFT JOIN d USING (doc_id)""",
    "op7_chat": """
        WITH t AS (
            SELECT conv_id AS pair_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        ), r AS (
            SELECT pair_id, max(turn) AS place, max_by(text, (turn, text)) AS reply
            FROM t WHERE role = 'assistant' GROUP BY pair_id
        ), both_sides AS (
            SELECT *, 1 AS c, 0 AS r FROM t
            UNION ALL
            SELECT t.pair_id, t.turn, t.role, CASE WHEN t.role = 'assistant' AND t.turn = r.place
                THEN coalesce(o.reply, '') ELSE t.text END, 0, 1
            FROM t LEFT JOIN r USING (pair_id) LEFT JOIN r o ON o.pair_id = xor(t.pair_id, 1)
        ), counted AS (
            SELECT pair_id, turn, role, text, sum(c) AS c, sum(r) AS r FROM both_sides GROUP BY ALL
        ), parted AS (
            SELECT *, min(CASE WHEN c <> r THEN turn END) OVER (PARTITION BY pair_id) AS parting FROM counted
        ), parts AS (
            SELECT *, 'prompt' AS part, c AS copies FROM parted WHERE parting IS NULL OR turn < parting
            UNION ALL SELECT *, 'chosen', c FROM parted WHERE turn >= parting AND c > 0
            UNION ALL SELECT *, 'rejected', r FROM parted WHERE turn >= parting AND r > 0
        ), pieces AS (
            SELECT *, '<|im_start|>' || replace(role, '<|', '< |') || chr(10) AS head,
              replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS body,
              part <> 'prompt' AND role = 'assistant' AS learned
            FROM parts
        )
        SELECT pair_id, part, turn, CAST(copies AS BIGINT) AS copies, role, head || body AS rendered,
          CAST(CASE WHEN learned THEN length(head) ELSE 0 END AS INTEGER) AS mask_start,
          CAST(CASE WHEN learned THEN length(body) ELSE 0 END AS INTEGER) AS mask_length
        FROM pieces""",
    "op6_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest FROM pages
        ), s AS (
            SELECT *, octet_length(encode(html)) AS size, max(page_id) OVER (PARTITION BY digest) AS response FROM p
        )
        SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, digest AS payload_digest,
          CASE WHEN size < 1000 OR page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
          CASE WHEN size >= 1000 AND page_id <> response THEN response END AS refers_to
        FROM s""",
}
