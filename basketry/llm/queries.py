"""The registered queries of the operators, and DuckDB SQL for those it can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    bpe,
    contamination,
    context_mixing,
    exact_dedup,
    language_crf,
    near_dedup,
    pseudonyms,
    quality_divergence,
    sharding,
    source_divergence,
    token_alignment,
    token_counts,
    warc,
)
from .common import ROW, shared_folder, stored, table


# A demonstration key.  In production the key comes from a secret store.
PSEUDONYM_KEY = b"basketry demonstration key"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymised(table(spark, sf_dir, "documents"), PSEUDONYM_KEY).drop(ROW)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_crf.identified(docs, language_crf.fitted(docs))
    return found.select(
        "doc_id",
        language_crf.held_out("doc_id").alias("held_out"),
        "lang_pred",
        "score",
        "n_words",
        "n_switches",
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.benchmark_hits(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ).drop(ROW)


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents")).drop(ROW)


def _byte_bpe() -> str:
    from public_tokenizers import path

    return path("byte_bpe_50k.json")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.Vocabulary(_byte_bpe())
    coded = bpe.encode(table(spark, sf_dir, "documents"), vocabulary)
    return bpe.decode(coded, vocabulary).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents")).drop(ROW)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        table(spark, sf_dir, "documents"), bpe.Vocabulary(_byte_bpe())
    ).drop(ROW)


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.scores(table(spark, sf_dir, "documents")).drop(ROW)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = shared_folder(spark)
    warc.write_archives(table(spark, sf_dir, "pages"), archives)
    read = warc.read_records(spark, archives).select(
        "record_id",
        "record_type",
        "concurrent",
        "refers_to",
        "head",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        warc.base32_sha1(F.col("payload")).alias("payload_digest"),
    )
    captures = warc.captures(stored(read)).select(
        "record_id",
        warc.metadata_field("page").cast("bigint").alias("page_id"),
        "capture",
    )
    full = captures.where("capture.record_type = 'response'").select(
        F.col("record_id").alias("_full"),
        F.col("page_id").alias("_page"),
        F.col("capture.payload_bytes").alias("_bytes"),
        F.col("capture.payload_digest").alias("_digest"),
    )
    # A response stands for itself, so that no key is NULL.
    pages = captures.select("page_id", "capture.*").withColumn(
        "_full", F.coalesce("refers_to", "record_id")
    )
    return pages.join(full, "_full", "left").select(
        "page_id",
        F.coalesce("_bytes", "payload_bytes").alias("payload_bytes"),
        F.coalesce("_digest", "payload_digest").alias("payload_digest"),
        "record_type",
        F.when(F.col("record_type") == "revisit", F.col("_page")).alias("refers_to"),
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents")).drop(ROW)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    pieces = token_alignment.Pieces.read(path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))
    found = token_alignment.aligned(table(spark, sf_dir, "documents"), pieces, digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence(table(spark, sf_dir, "documents"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_divergence.judged(docs, quality_divergence.references(docs)).drop(
        "class_distance", "word_distance"
    )


QUERIES = {
    "op1_pii": op1_pii,
    "op2_language_id": op2_language_id,
    "op3_decontamination": op3_decontamination,
    "op4_near_dedup": op4_near_dedup,
    "op5_bpe": op5_bpe,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_warc": op9_warc,
    "op10_sharding": op10_sharding,
    "op11_token_alignment": op11_token_alignment,
    "op12_source_divergence": op12_source_divergence,
    "op13_quality_rules": op13_quality_rules,
}

ORACLES = {
    "op3_decontamination": r"""
        WITH t AS (SELECT 'd' AS k, doc_id AS id, text FROM documents
                   UNION ALL SELECT 'b', item_id, text FROM benchmark),
        w AS (SELECT k, id, coalesce(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM t),
        win AS (SELECT DISTINCT id AS item_id, least(len(w), 10) AS n,
            unnest([array_to_string(w[i:i + 9], ' ') FOR i IN range(1, greatest(len(w) - 9, 1) + 1)]) AS p
            FROM w WHERE k = 'b' AND len(w) > 0),
        pos AS (SELECT id AS doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i
            FROM w, (SELECT DISTINCT n FROM win) WHERE k = 'd'),
        hit AS (SELECT doc_id, item_id, i, n FROM (
            SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS p FROM pos) JOIN win USING (n, p)),
        words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (
            SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s FROM (
            SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
        SELECT w.id AS doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit,
          coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
          coalesce(n_hit, 0) > 0 AS contaminated
        FROM w LEFT JOIN words ON words.doc_id = w.id LEFT JOIN items ON items.doc_id = w.id
        WHERE k = 'd'
    """,
    "op4_near_dedup": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE
            WHEN len(w) >= 3 THEN [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
              FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
              WHERE 100 * c >= 85 * (a.n + b.n - c)),
        r AS (SELECT doc_id, doc_id AS z FROM documents
              UNION SELECT r.doc_id, l.y FROM r JOIN l ON r.z = l.x)
        SELECT r.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles,
          min(z) AS component_id, r.doc_id = min(z) AS kept
        FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
    """,
    "op6_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
        FROM d JOIN g USING (t)
    """,
    "op9_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        g AS (SELECT h, max(page_id) AS best FROM p GROUP BY h),
        s AS (SELECT *, sha1(h) AS x FROM p JOIN g USING (h))
        SELECT page_id, strlen(h) AS payload_bytes,
          array_to_string([substr(
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + CAST((CAST('0x' || substr(x, CAST(1 + 10 * (i // 8) AS INTEGER), 10) AS BIGINT)
                      >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31 AS INTEGER), 1)
            FOR i IN range(0, 32)], '') AS payload_digest,
          CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
          CASE WHEN page_id <> best THEN best END AS refers_to
        FROM s
    """,
    "op12_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            unnest([''] || coalesce(regexp_extract_all(
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'), [])) AS term FROM documents),
        kept AS (SELECT lang, term FROM d WHERE term <> '' GROUP BY ALL HAVING count(DISTINCT id) >= 30),
        grp AS (SELECT DISTINCT lang, source FROM d),
        c AS (SELECT lang, source, term, count(*) AS c FROM d JOIN kept USING (lang, term) GROUP BY ALL),
        v AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL),
        n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL),
        p AS (SELECT lang, source, term, coalesce(c, 0) AS c,
            1 + (1000000000::HUGEINT * (coalesce(c, 0) + 5)) // (coalesce(n, 0) + 5 * v) AS p
            FROM grp JOIN kept USING (lang) JOIN v USING (lang)
            LEFT JOIN c USING (lang, source, term) LEFT JOIN n USING (lang, source)),
        q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(c) + 5)) // (any_value(n) + 5 * any_value(v)) AS q
            FROM c JOIN (SELECT lang, sum(n) AS n FROM n GROUP BY ALL) USING (lang) JOIN v USING (lang) GROUP BY ALL),
        pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
            FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
            LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
            WHERE x.term IS NULL OR y.term IS NOT NULL GROUP BY ALL),
        part AS (SELECT lang, source, 'pair' AS part, item, value FROM pair
            UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank FROM (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM part)
        WHERE part = 'pair' OR r <= 50
    """,
    "op13_quality_rules": r"""
        WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t FROM documents),
        b AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
            list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
            regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms,
            length(t) AS chars,
            [length(regexp_replace(t, c, '', 'g')) FOR c IN ['[^a-z]', '[^A-Z]', '[^0-9]', '[^\x20\x09-\x0D]',
              '[^.,;:!?''"()-]', '[a-zA-Z0-9\x20\x09-\x0D.,;:!?''"()-]|[^\x00-\x7F]', '[\x00-\x7F]']] AS cls FROM d),
        win AS (SELECT id, unnest(range(1, len(w) - 1)) AS i, unnest([w[k:k + 2] FOR k IN range(1, len(w) - 1)]) AS g
            FROM b WHERE len(w) >= 3),
        rep AS (SELECT id, count(DISTINCT j) AS n FROM (
            SELECT id, unnest([i, i + 1, i + 2]) AS j FROM win SEMI JOIN
              (SELECT id, g FROM win GROUP BY ALL HAVING count(*) > 1) USING (id, g)) GROUP BY id),
        tc AS (SELECT id, lang, unnest(terms) AS term FROM b),
        big AS (SELECT lang FROM d GROUP BY lang HAVING count(*) >= 30),
        tt AS (SELECT lang, term, count(*) AS n FROM tc SEMI JOIN big USING (lang) GROUP BY lang, term
            QUALIFY row_number() OVER (PARTITION BY lang ORDER BY count(DISTINCT id) DESC, term) <= 100),
        ref AS (SELECT lang, term, n / sum(n) OVER (PARTITION BY lang) AS q FROM (
            SELECT lang, term, n FROM tt
            UNION ALL SELECT lang, NULL, (SELECT count(*) FROM tc WHERE tc.lang = big.lang)
              - (SELECT coalesce(sum(n), 0) FROM tt WHERE tt.lang = big.lang) FROM big)),
        own AS (SELECT id, term, count(*) AS n FROM tc GROUP BY ALL),
        seen AS (SELECT own.id, tt.lang, tt.term, own.n FROM own JOIN tt USING (term)),
        hist AS (SELECT id, lang, term, n FROM seen
            UNION ALL SELECT b.id, big.lang, NULL, len(terms) - coalesce(s.n, 0) FROM b CROSS JOIN big
              LEFT JOIN (SELECT id, lang, sum(n) AS n FROM seen GROUP BY ALL) s ON s.id = b.id AND s.lang = big.lang),
        wd AS (SELECT id, sqrt(min(greatest(v, 0)) / 2) AS d FROM (
            SELECT id, lang, 1 + sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
              + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END - q) AS v FROM (
              SELECT hist.id, hist.lang, hist.n / len(b.terms) AS p, q FROM hist JOIN b USING (id)
              JOIN ref ON ref.lang = hist.lang AND ref.term IS NOT DISTINCT FROM hist.term WHERE len(b.terms) > 0)
            GROUP BY id, lang) GROUP BY id),
        cr AS (SELECT lang, k, sum(cls[k]) / sum(sum(cls[k])) OVER (PARTITION BY lang) AS q
            FROM b SEMI JOIN big USING (lang), range(1, 8) r(k) GROUP BY lang, k),
        cd AS (SELECT id, sqrt(min(greatest(v, 0)) / 2) AS d FROM (
            SELECT id, lang, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
              + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) AS v FROM (
              SELECT id, cr.lang, cls[k] / chars AS p, q FROM b, cr WHERE chars > 0) GROUP BY id, lang) GROUP BY id),
        j AS (SELECT doc_id, len(w) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
            CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
            len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
            len(w) < 50 OR 100 * coalesce(rep.n, 0) > 50 * len(w) AS base_failed,
            (chars >= 200 AND coalesce(cd.d, 0) > 0.28) OR (len(terms) >= 120 AND coalesce(wd.d, 0) > 0.42) AS far
            FROM b LEFT JOIN rep USING (id) LEFT JOIN wd USING (id) LEFT JOIN cd USING (id))
        SELECT * EXCLUDE (far), NOT base_failed AND NOT far AS kept FROM j
    """,
}
