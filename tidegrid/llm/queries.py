"""The corpus operators' queries over the standard tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import crf_quality, hmm, license_scan, warc
from .bpe_tree import encode_documents
from .decontaminate import find_items
from .jaccard_join import near_duplicates
from .packing import pack_documents
from .phrases import collocations
from .quality_rules import judge
from .runs import periodic_runs
from .suffix_dedup import removal_report
from .training_order import order_report


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _remainder(column: str, divisor: int):
    """Of the CRC-32 of an id's text."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def op1_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = lambda column: _remainder(column, 4) == 2
    return crf_quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), held_out)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the table has no paths: a tree of source, language and hundred, with a licence file in each directory
    name = F.when(F.col("doc_id") % 100 == 0, F.lit("LICENSE")).otherwise(F.concat(F.lit("doc"), F.col("doc_id").cast("string")))
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 100).cast("string"), name)
    return license_scan.scan(_table(spark, sf_dir, "documents"), path)


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op4_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_report(_table(spark, sf_dir, "documents"), key=20240611, vocabulary=_vocabulary())


def op5_hidden_markov_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_texts(_table(spark, sf_dir, "documents"), _remainder("doc_id", 7) == 2)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_report(_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(_table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), _vocabulary())


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(_table(spark, sf_dir, "documents"), planted=True)


def op12_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_crf_quality": op1_crf_quality,
        "op2_license_scan": op2_license_scan,
        "op3_warc_revisits": op3_warc_revisits,
        "op4_training_order": op4_training_order,
        "op5_hidden_markov_scores": op5_hidden_markov_scores,
        "op6_suffix_dedup": op6_suffix_dedup,
        "op7_quality_rules": op7_quality_rules,
        "op8_best_fit_packing": op8_best_fit_packing,
        "op9_jaccard_join": op9_jaccard_join,
        "op10_decontamination": op10_decontamination,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_bpe_tree": op12_bpe_tree,
        "op13_phrase_collocations": op13_phrase_collocations,
        "pipeline": pipeline,
    }


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def oracle_sql() -> dict[str, str]:
    return ORACLE


ORACLE: dict[str, str] = {
    "op3_warc_revisits": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages WHERE page_id IS NOT NULL
        ), kept AS (
            SELECT page_id, octet_length(payload) AS n, sha1(payload) AS digest, max(page_id) OVER (PARTITION BY payload) AS last FROM p
        )
        SELECT page_id, n AS payload_bytes, digest AS payload_digest,
               CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
        FROM kept
    """,
    "op7_quality_rules": """
        WITH d AS (
            SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
        ), w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \t-\r]+'), lambda x: x <> '') AS words,
                   list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^ \t-\r]')) AS lines
            FROM d
        ), p AS (
            SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i, len(words) AS n FROM w
        ), g AS (
            SELECT doc_id, i, n, word || ' ' || string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING) AS gram FROM p
        ), twice AS (
            SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap
            FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS times FROM g WHERE i <= n - 7) WHERE times > 1
        ), r AS (
            SELECT doc_id, sum(least(8, coalesce(gap, 8)))::BIGINT AS n_repeat_words FROM twice GROUP BY doc_id
        ), c AS (
            SELECT d.doc_id, lang, source, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
                   length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                   len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines,
                   length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals, length(regexp_replace(text, '[^!]', '', 'g')) AS n_shouts
            FROM d JOIN w USING (doc_id) LEFT JOIN r USING (doc_id)
        ), b AS (
            SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
                   [{'rate': 'word_length', 'value': word_chars * 1000 // greatest(n_words, 1), 'events': 10, 'low': true},
                    {'rate': 'symbols', 'value': n_symbols * 10000 // greatest(n_words, 1), 'events': n_symbols, 'low': false},
                    {'rate': 'dup_lines', 'value': n_dup_lines * 1000 // greatest(n_lines, 1), 'events': n_dup_lines, 'low': false},
                    {'rate': 'repeats', 'value': n_repeat_words * 1000 // greatest(n_words, 1), 'events': n_repeat_words // 16, 'low': false},
                    {'rate': 'capitals', 'value': n_capitals * 10000 // greatest(word_chars, 1), 'events': n_capitals, 'low': false},
                    {'rate': 'shouts', 'value': n_shouts * 10000 // greatest(n_words, 1), 'events': n_shouts, 'low': false}] AS rates
            FROM c
        ), v AS (
            SELECT doc_id, lang, source, base_failed, unnest(rates, recursive := true) FROM b
        ), k AS (
            SELECT *, (value >> greatest(length(bin(value)) - 7, 0)) << greatest(length(bin(value)) - 7, 0) AS bucket FROM v WHERE NOT base_failed
        ), s AS (
            SELECT rate, low, lang, source, bucket, count(*) AS n FROM k GROUP BY ALL
            UNION ALL SELECT rate, low, lang, NULL, bucket, count(*) FROM k GROUP BY ALL
            UNION ALL SELECT rate, low, NULL, NULL, bucket, count(*) FROM k GROUP BY ALL
        ), u AS (
            SELECT *, sum(n) OVER (PARTITION BY rate, lang, source ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY rate, lang, source) AS total FROM s
        ), q AS (
            SELECT rate, low, lang, source, max(total) AS total,
                   min(bucket) FILTER (WHERE upto * 4 >= total) AS q1, min(bucket) FILTER (WHERE upto * 4 >= total * 3) AS q3
            FROM u GROUP BY ALL
        ), a AS (
            SELECT q.*, (SELECT sum(u.n * abs(u.bucket - q.q1)) FROM u WHERE u.rate = q.rate AND u.lang IS NOT DISTINCT FROM q.lang AND u.source IS NOT DISTINCT FROM q.source) AS apart FROM q
        ), z AS (
            SELECT *, greatest(CASE WHEN q3 > q1 THEN 5 * (q3 - q1) ELSE 5 * apart // total END, 5 * (1::BIGINT << greatest(length(bin(q3)) - 7, 0))) AS gap FROM a
        ), f AS (
            SELECT rate, lang, source, total, CASE WHEN low THEN q1 - gap END AS lowest, q3 + gap AS highest FROM z
        ), j AS (
            SELECT v.doc_id, bool_and(coalesce(
                CASE WHEN o.total >= 100 THEN v.value >= coalesce(o.lowest, 0) AND (v.events < 10 OR v.value <= o.highest)
                     WHEN l.total >= 100 THEN v.value >= coalesce(l.lowest, 0) AND (v.events < 10 OR v.value <= l.highest)
                     ELSE v.value >= coalesce(e.lowest, 0) AND (v.events < 10 OR v.value <= e.highest) END, true)) AS within
            FROM v
            LEFT JOIN f o ON o.rate = v.rate AND o.lang = v.lang AND o.source = v.source
            LEFT JOIN f l ON l.rate = v.rate AND l.lang = v.lang AND l.source IS NULL
            LEFT JOIN f e ON e.rate = v.rate AND e.lang IS NULL
            GROUP BY v.doc_id
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND within AS kept, n_lines, n_capitals, n_shouts
        FROM b JOIN j USING (doc_id)
    """,
    "op6_suffix_dedup": """
        WITH d AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents WHERE doc_id IS NOT NULL
        ), b AS (
            SELECT doc_id, n, unnest(range(0, n)) AS p, unnest(regexp_extract_all(h, '..')) AS byte FROM d WHERE n > 0
        ), t AS (
            SELECT doc_id, n, p, byte, byte || lead(byte, 1, '') OVER w || lead(byte, 2, '') OVER w || lead(byte, 3, '') OVER w || lead(byte, 4, '') OVER w || lead(byte, 5, '') OVER w || lead(byte, 6, '') OVER w || lead(byte, 7, '') OVER w || lead(byte, 8, '') OVER w || lead(byte, 9, '') OVER w AS ten
            FROM b WINDOW w AS (PARTITION BY doc_id ORDER BY p)
        ), f AS (
            SELECT doc_id, n, p, byte, ten || lead(ten, 10, '') OVER w || lead(ten, 20, '') OVER w || lead(ten, 30, '') OVER w || lead(ten, 40, '') OVER w || lead(ten, 50, '') OVER w || lead(ten, 60, '') OVER w || lead(ten, 70, '') OVER w || lead(ten, 80, '') OVER w || lead(ten, 90, '') OVER w AS hundred
            FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY p)
        ), g AS (
            SELECT doc_id, p, byte, CASE WHEN p <= n - 100 AND row_number() OVER (PARTITION BY p <= n - 100, hundred ORDER BY doc_id, p) > 1 THEN 1 ELSE 0 END AS later FROM f
        ), c AS (
            SELECT doc_id, p, byte, max(later) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM g
        ), e AS (
            SELECT *, lag(gone, 1, 0) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM c
        ), r AS (
            SELECT doc_id, count(*) FILTER (WHERE gone = 1) AS n_removed, count(*) FILTER (WHERE gone = 1 AND before = 0) AS n_spans,
                   string_agg(byte, '' ORDER BY p) FILTER (WHERE gone = 0) AS kept
            FROM e GROUP BY doc_id
        )
        SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
        FROM d LEFT JOIN r USING (doc_id)
    """,
    "op9_jaccard_join": """
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t-\r]+'), lambda x: x <> '') AS words
            FROM documents WHERE doc_id IS NOT NULL
        ), i AS (
            SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0
        ), s AS (
            SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS g FROM i
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), p AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
        ), l AS (
            SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)
        ), e AS (
            SELECT a, b FROM l UNION SELECT b, a FROM l
        ), t AS (
            SELECT doc_id, doc_id AS reached FROM w UNION SELECT t.doc_id, e.b FROM t JOIN e ON e.a = t.reached
        )
        SELECT doc_id, coalesce(n, 0) AS n_shingles, min(reached) AS component_id FROM t LEFT JOIN n USING (doc_id) GROUP BY ALL
    """,
    "op13_phrase_collocations": """
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece
            FROM documents
        ), w AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[ 	]+'), lambda x: x <> '') AS words FROM p
        ), g AS (
            SELECT lang, m, unnest(list_transform(range(1, len(words) - m + 2), lambda i: array_to_string(words[i:i + m - 1], ' '))) AS phrase
            FROM w, (VALUES (1), (2), (3), (4)) t(m) WHERE len(words) >= m
        ), t AS (
            SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang
        ), f AS (
            SELECT lang, m, phrase, count(*) AS f, string_split(phrase, ' ') AS words FROM g GROUP BY ALL HAVING count(*) >= 30
        ), k AS (
            SELECT lang, m, phrase, words, f, unnest(range(1, m)) AS k FROM f WHERE m >= 2
        ), c AS (
            SELECT k.lang, k.phrase, k.f AS a, k.k, x.f AS l, y.f AS r, (2000000::HUGEINT * k.f // (x.f + y.f))::BIGINT AS score
            FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.words[1:k.k], ' ')
            JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.words[k.k + 1:], ' ')
        ), s AS (
            SELECT lang, phrase, a, l, r, score FROM c QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), o AS (
            SELECT lang, array_to_string(words[i:i + z - 1], ' ') AS phrase, max(f) AS f
            FROM (SELECT *, unnest(range(1, m - z + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS z FROM f WHERE m >= 3)) GROUP BY ALL
        ), b AS (
            SELECT s.lang, s.phrase, a, l, r, score FROM s LEFT JOIN o ON o.lang = s.lang AND o.phrase = s.phrase WHERE o.f IS NULL OR 100 * o.f < 80 * a
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM b JOIN t USING (lang) QUALIFY rank <= 2000
    """,
}
