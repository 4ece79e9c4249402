"""The registered queries of the training-data operators, one per operator.

Each applies its operator with production parameters to the whole table and
returns the full result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viewlog.llm import bpe, divergence, exact_dedup, licenses, line_dedup, mixing, ngram_join, passages, quality, ranked_search, token_files, toxicity, warc
from viewlog.llm.common import documents, table, tokenizer_path


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(documents(spark, sf_dir))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(documents(spark, sf_dir))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(documents(spark, sf_dir))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(documents(spark, sf_dir))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(documents(spark, sf_dir))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), tokenizer_path())


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.record_digests(warc.derivatives(table(spark, sf_dir, "pages")))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.digests(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_license_scan, op3_mixing, op4_toxicity, op5_exact_dedup, op6_ngram_jaccard, op7_substring_dedup,
    op8_line_dedup, op9_bpe, op10_warc, op11_source_divergence, op12_ranked_search, op13_token_files)}

ORACLE = {
    # Windows are unnested and counted; the prior is the method of moments written out.
    "op1_quality_rules": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
             w AS (SELECT r, doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
             win AS (SELECT r, unnest(range(1, len(words) - 6)) AS i, words FROM w WHERE len(words) > 8),
             grams AS (SELECT r, i, words[i:i + 7] AS g FROM win),
             twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
             hit AS (SELECT r, count(DISTINCT k) AS n_repeat_words
                     FROM (SELECT r, unnest(range(i, i + 8)) AS k FROM twice) GROUP BY r),
             lines AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
             dup AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
                     WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
             m AS (SELECT w.r, doc_id, source, len(words)::BIGINT AS n_words,
                          length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
                          (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                          coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
                   FROM w LEFT JOIN hit USING (r) LEFT JOIN dup USING (r)),
             f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
             h AS (SELECT source AS host, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS k FROM f WHERE source IS NOT NULL GROUP BY 1),
             s AS (SELECT sum(n) AS total, sum(k) / sum(n) AS mean, count(*) AS hosts, 1 - sum(n * n) / (sum(n) * sum(n)) AS share FROM h),
             v AS (SELECT any_value(total) AS total, any_value(mean) AS mean, any_value(share) AS share,
                          greatest(0, sum(n * pow(k / n - mean, 2)) / any_value(total)
                                      - any_value(mean) * (1 - any_value(mean)) * (any_value(hosts) - 1) / any_value(total)) AS extra
                   FROM h, s),
             p AS (SELECT mean, CASE WHEN share > 1e-12 AND extra > 0
                                     THEN least(greatest(mean * (1 - mean) / (extra / share) - 1, 2.0), 1e6) ELSE 1e6 END AS strength FROM v),
             bad AS (SELECT host FROM h, p WHERE (k + mean * strength) / (n + strength) > 0.5)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND (source IS NULL OR source NOT IN (SELECT host FROM bad)) AS kept
        FROM f""",
    # Every seat is written out and ranked by its quotient.
    "op3_mixing": r"""
        WITH d AS (SELECT doc_id, source, CASE WHEN source IS NULL THEN 'null' ELSE '=' || source END AS skey,
                          len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                          md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS place FROM documents),
             s0 AS (SELECT skey, source, sum(size)::BIGINT AS size FROM d GROUP BY ALL),
             s1 AS (SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight FROM s0),
             s2 AS (SELECT *, 3 * size AS cap, row_number() OVER (ORDER BY 3 * size / weight, source NULLS LAST) AS rank FROM s1),
             s3 AS (SELECT *, (sum(size) OVER () - coalesce(sum(cap) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                              / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM s2),
             s4 AS (SELECT *, (SELECT min_by(level, rank) FROM s3 WHERE level * weight <= cap) AS water FROM s3),
             s5 AS (SELECT *, coalesce(water * weight >= cap, true) AS capped,
                           CASE WHEN coalesce(water * weight >= cap, true) THEN cap::DOUBLE ELSE water * weight END AS target,
                           ceil(size / 16)::BIGINT AS blocks FROM s4),
             n AS (SELECT round(sum(target) / 16)::BIGINT AS seats FROM s5 WHERE NOT capped),
             seat AS (SELECT skey, source, target, unnest(range(1, seats + 1)) AS k FROM s5, n WHERE NOT capped),
             won AS (SELECT skey, count(*) AS won FROM
                       (SELECT skey, row_number() OVER (ORDER BY target / (k - 0.5) DESC, source NULLS LAST, k) AS place FROM seat), n
                     WHERE place <= seats GROUP BY skey),
             goal AS (SELECT s5.*, CASE WHEN capped THEN 3 * blocks ELSE least(coalesce(won, 0), 3 * blocks) END AS quota
                      FROM s5 LEFT JOIN won USING (skey)),
             goal2 AS (SELECT *, CASE WHEN blocks > 0 THEN quota // blocks ELSE 0 END AS whole FROM goal),
             place AS (SELECT *, sum(size) OVER (PARTITION BY skey ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS lo FROM d),
             sh0 AS (SELECT skey, substr(place, 1, 1) AS shard, min(lo) AS lo, sum(size) AS words FROM place GROUP BY ALL),
             sh1 AS (SELECT *, ceil(lo / 16)::BIGINT AS first, ceil((lo + words) / 16)::BIGINT - ceil(lo / 16)::BIGINT AS n_blocks FROM sh0),
             sh2 AS (SELECT sh1.*, quota - whole * blocks AS rest FROM sh1 JOIN goal2 USING (skey) WHERE n_blocks > 0),
             sh3 AS (SELECT skey, shard, first, n_blocks, rest, unnest(range(1, rest + 1)) AS k FROM sh2),
             sh4 AS (SELECT skey, shard, count(*) AS won FROM
                       (SELECT *, row_number() OVER (PARTITION BY skey ORDER BY n_blocks / (k - 0.5) DESC, shard, k) AS p FROM sh3)
                     WHERE p <= rest GROUP BY ALL),
             sh5 AS (SELECT skey, shard, first, n_blocks, least(coalesce(won, 0), n_blocks) AS won,
                            ('0x' || substr(md5('mix:' || skey || ':' || shard), 1, 8))::BIGINT % n_blocks AS start FROM sh2 LEFT JOIN sh4 USING (skey, shard)),
             runs AS (SELECT skey, (first + start) * 16 AS a, (first + least(start + won, n_blocks)) * 16 AS b FROM sh5
                      UNION ALL SELECT skey, first * 16, (first + greatest(start + won - n_blocks, 0)) * 16 FROM sh5),
             part AS (SELECT place.skey, place.place, doc_id, lo, sum(greatest(0, least(lo + size, b) - greatest(lo, a))) AS words
                      FROM place JOIN runs USING (skey) WHERE b > a GROUP BY ALL)
        SELECT p.doc_id, p.size, g.size AS source_size, g.target, (g.whole * p.size + coalesce(part.words, 0))::BIGINT AS taken
        FROM place p JOIN goal2 g USING (skey)
        LEFT JOIN part ON part.skey = p.skey AND part.lo = p.lo AND part.place = p.place AND part.doc_id IS NOT DISTINCT FROM p.doc_id""",
    "op5_exact_dedup": """
        WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
                   FROM documents),
             g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
        FROM n JOIN g USING (t)""",
    # Overlaps from a join on shingles, components by repeated union of neighbours.
    "op6_ngram_jaccard": r"""
        WITH RECURSIVE
             d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
             g AS (SELECT DISTINCT r, array_to_string(w[i:i + 3], ' ') AS g
                   FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
             n AS (SELECT r, count(*) AS n FROM g GROUP BY r),
             o AS (SELECT a.r AS x, b.r AS y, count(*) AS o FROM g a JOIN g b ON a.g = b.g AND a.r != b.r GROUP BY ALL),
             e AS (SELECT x, y FROM o JOIN n p ON p.r = x JOIN n q ON q.r = y WHERE 100 * o >= 85 * (p.n + q.n - o)),
             reach AS (SELECT r AS x, r AS y FROM d UNION SELECT reach.x, e.y FROM reach JOIN e ON e.x = reach.y)
        SELECT a.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(b.doc_id) AS component_id
        FROM reach JOIN d a ON a.r = reach.x JOIN d b ON b.r = reach.y LEFT JOIN n ON n.r = reach.x
        GROUP BY a.r, a.doc_id""",
    # Every kept term of every group, zero counts included.
    "op11_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
             g AS (SELECT DISTINCT lang, source FROM d),
             t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
             kept AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
             v AS (SELECT lang, count(*) AS terms, sum(lang_n)::BIGINT AS lang_total FROM kept GROUP BY lang),
             c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
             tot AS (SELECT lang, source, coalesce(sum(n), 0)::BIGINT AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
             p AS (SELECT tot.lang, tot.source, kept.term, coalesce(c.n, 0) AS n,
                          1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (total + terms) AS p, 1 + (1000000000 * (lang_n + 1)) // (lang_total + terms) AS q
                   FROM tot JOIN v ON v.lang = tot.lang JOIN kept ON kept.lang = tot.lang
                   LEFT JOIN c ON c.lang = tot.lang AND c.source = tot.source AND c.term = kept.term),
             f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::BIGINT AS value
                   FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
             pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
                      LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
             o AS (SELECT 'pair' AS part, * FROM pair
                   UNION ALL SELECT 'term', lang, source, term, ((p - q) * (p - q)) // q FROM p WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM (
            SELECT *, row_number() OVER (PARTITION BY part, lang, source ORDER BY value DESC, item) AS rank FROM o)
        WHERE part = 'pair' OR rank <= 200""",
    # Every document that shares a term with the item is scored.
    "op12_ranked_search": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
             b AS (SELECT row_number() OVER () AS i, item_id, list_distinct(regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM benchmark),
             s AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_words FROM d),
             m AS (SELECT r, doc_id, 100 - 90 + (90 * len(w)::BIGINT * n_docs) // n_words AS m FROM d, s WHERE len(w) > 0),
             tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL),
             wt AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY term),
             sc AS (SELECT i, item_id, m.r, doc_id, sum(wt.w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
                    FROM (SELECT i, item_id, unnest(w) AS term FROM b) q JOIN wt USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY ALL)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM sc WHERE score > 0)
        WHERE rank <= 10""",
}
