"""Registered queries of the corpus operators, and their SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from campaignlens.llm import kneser_ney, langid, merkle, mixing, packing, pii, pu_quality, quality, sharding, simhash, spelling, topk, toxicity
from campaignlens.llm.common import Workspace, in_fold, read_table


def op1_best_fit_packing(spark: SparkSession, directory: str) -> DataFrame:
    return packing.packed(read_table(spark, directory, "documents"))


def op7_external_shuffle(spark: SparkSession, directory: str) -> DataFrame:
    shuffled, rows = sharding.shuffled_records(read_table(spark, directory, "documents"))
    text = F.col("record.text")
    digest = shuffled.select(  # before places are joined, so that texts don't move again
        "bucket",
        "pos",
        F.col("record.doc_id").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    grown = F.lit(None).cast("int").alias("grown_shard")
    placed = sharding.assign_shards(digest, rows)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", grown)


def op8_source_mixing(spark: SparkSession, directory: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, directory, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_language_id(spark: SparkSession, directory: str) -> DataFrame:
    docs = read_table(spark, directory, "documents")
    training = docs.filter(F.col("doc_id").isNotNull() & ~in_fold(F.col("doc_id"), 4, 2))
    return langid.identify(docs, langid.train(training.select("doc_id", "text", "lang")))


def op4_simhash_near_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, directory, "documents"))


def op2_weakly_supervised_pii(spark: SparkSession, directory: str) -> DataFrame:
    found = pii.found(read_table(spark, directory, "documents"))
    base = F.filter("candidates", lambda c: c["base"])

    def number(kind: str) -> Column:
        return F.size(F.filter("candidates", lambda c: c["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(kind) for kind in pii.BASE_KINDS],
        F.sha2(pii.listing(base).cast("binary"), 256).alias("base_sha256"),
        pii.listing(F.col("spans")).alias("spans"),
    )



def op3_maxscore_top_k(spark: SparkSession, directory: str) -> DataFrame:
    vectors = read_table(spark, directory, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % topk.QUERY_STEP == 0)



def op9_kneser_ney_scoring(spark: SparkSession, directory: str) -> DataFrame:
    docs = read_table(spark, directory, "documents")
    held_out = in_fold(F.col("doc_id"), 5, 1)
    model = kneser_ney.train(docs.filter(~held_out), Workspace(spark))
    return kneser_ney.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score", "perplexity",
    )



def op5_perplexity_quality(spark: SparkSession, directory: str) -> DataFrame:
    judged = quality.judged(read_table(spark, directory, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_perplexity",
    )



def op6_recurrent_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    docs, labels = (read_table(spark, directory, name) for name in ("documents", "labels"))
    held_out = in_fold(F.col("doc_id"), 3, 1)
    network = toxicity.fit(*toxicity.training_sample(docs, labels.filter(~held_out)))
    predicted = (F.col("score") >= toxicity.TOXIC_AT).cast("int").alias("predicted")
    return toxicity.scored(docs, network).select("doc_id", held_out.alias("held_out"), "score", predicted)



def op11_spelling_variants(spark: SparkSession, directory: str) -> DataFrame:
    return spelling.variants(read_table(spark, directory, "documents"))


def op12_merkle_manifest(spark: SparkSession, directory: str) -> DataFrame:
    return merkle.audited(read_table(spark, directory, "documents"))


def op13_positive_unlabelled_quality(spark: SparkSession, directory: str) -> DataFrame:
    return pu_quality.quality_scores(read_table(spark, directory, "documents"), read_table(spark, directory, "labels"))


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op7_external_shuffle": op7_external_shuffle,
    "op8_source_mixing": op8_source_mixing,
    "op10_language_id": op10_language_id,
    "op2_weakly_supervised_pii": op2_weakly_supervised_pii,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op3_maxscore_top_k": op3_maxscore_top_k,
    "op9_kneser_ney_scoring": op9_kneser_ney_scoring,
    "op5_perplexity_quality": op5_perplexity_quality,
    "op6_recurrent_toxicity": op6_recurrent_toxicity,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_positive_unlabelled_quality": op13_positive_unlabelled_quality,
}

#: Searches by brute force over all pairs of a query and a row.
_TOP_K = """
WITH v AS (
    SELECT row_number() OVER () AS rid, vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS q FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND coalesce(list_sum([CASE WHEN x IS NULL OR isnan(x) OR abs(x) >= 1048576 THEN 1 ELSE 0 END for x in embedding]), 0) = 0
), scored AS (
    SELECT a.rid, a.vec_id AS query_id, b.vec_id AS vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

#: Ranks every quotient instead of the few that can be the last ones.
_MIXING = """
WITH d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
    SELECT source, source_size, place, CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
    FROM (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source)
), levels AS (
    SELECT *, (sum(source_size) OVER ())::BIGINT AS total,
        coalesce(sum(3 * source_size) OVER (ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
        (sum(weight) OVER (ORDER BY source_size / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS weight_left
    FROM s
), marked AS (
    SELECT *, 3 * source_size * weight_left < weight * (total - before) AS capped FROM levels
), targeted AS (
    SELECT source, source_size, place, total, CAST(ceil(source_size / 16) AS BIGINT) AS blocks,
        coalesce(CASE WHEN capped THEN 3.0::DOUBLE * source_size ELSE
            ((total - coalesce(sum(CASE WHEN capped THEN 3 * source_size END) OVER (), 0))::BIGINT * weight)::DOUBLE
            / (sum(CASE WHEN NOT capped THEN weight END) OVER ())::BIGINT END, 0.0::DOUBLE) AS target
    FROM marked
), quotients AS (
    SELECT place, total, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, place) AS nth
    FROM (SELECT place, total, target, unnest(range(0, 3 * blocks)) AS k FROM targeted)
), plan AS (
    SELECT t.*, coalesce(quota, 0) AS quota,
        coalesce(('0x' || md5(concat_ws('|', '42', t.source, 'start'))[1:8])::BIGINT % nullif(blocks, 0), 0) AS first
    FROM targeted t LEFT JOIN (
        SELECT place, count(*) AS quota FROM quotients WHERE nth <= (2 * total + 16) // 32 GROUP BY place
    ) q ON t.place = q.place
), spans AS (
    SELECT *, coalesce(quota // nullif(blocks, 0), 0) AS passes, coalesce(quota % nullif(blocks, 0), 0) AS run FROM plan
), placed AS (
    SELECT doc_id, source, size, coalesce(sum(size) OVER (
        PARTITION BY source ORDER BY md5(concat_ws('|', '42', source, doc_id, size)), doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins FROM d
)
SELECT p.doc_id, p.size, source_size, target,
    (passes * p.size
     + greatest(least(least((first + run) * 16, source_size), begins + p.size) - greatest(first * 16, begins), 0)
     + greatest(least(greatest(first + run - blocks, 0) * 16, begins + p.size) - begins, 0))::BIGINT AS taken
FROM placed p JOIN spans ON p.source IS NOT DISTINCT FROM spans.source
"""

#: CRC-32 of ids from its polynomial; trees and proofs by recursion over levels, row by row.
_MERKLE = """
WITH RECURSIVE crc_table AS (
    SELECT list(list_reduce(list_prepend(i::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) ORDER BY i) AS t
    FROM range(256) r(i)
), d AS (
    SELECT row_number() OVER () AS rid, *,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) % 7 = 0 AS tampered
    FROM documents, crc_table
), e AS (
    SELECT rid, doc_id, lang, coalesce(tampered, false) AS tampered,
        coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') AS head,
        coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS size,
        coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS other_size,
        coalesce(strlen(text) || ':' || text, '-') AS body
    FROM d
), leaves AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n
    FROM (SELECT rid, doc_id, coalesce('=' || lang, '-') AS lang, sha256(head || size || body) AS leaf,
        sha256(head || CASE WHEN tampered THEN other_size ELSE size END || body) AS second FROM e)
), nodes AS (
    SELECT 0 AS lvl, lang, place, n, leaf AS h FROM leaves
    UNION ALL
    SELECT lvl + 1, lang, place // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY place)) FROM nodes WHERE n > 1 GROUP BY lvl, lang, place // 2, n
), subroots AS MATERIALIZED (
    SELECT lang, h, row_number() OVER (ORDER BY lang) - 1 AS place, count(*) OVER () AS n FROM nodes WHERE n = 1
), top AS (
    SELECT 0 AS lvl, place, n, h FROM subroots
    UNION ALL
    SELECT lvl + 1, place // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY place)) FROM top WHERE n > 1 GROUP BY lvl, place // 2, n
), climbed AS (
    SELECT rid, 0 AS lvl, l.lang, l.place, l.n, second AS h, '' AS proof FROM leaves l
    UNION ALL
    SELECT rid, c.lvl + 1, c.lang, c.place // 2, (c.n + 1) // 2,
        sha256(CASE WHEN c.place % 2 = 0 THEN c.h || coalesce(s.h, '') ELSE s.h || c.h END), proof || coalesce(s.h, '')
    FROM climbed c LEFT JOIN nodes s ON s.lvl = c.lvl AND s.lang = c.lang AND s.place = xor(c.place, 1) WHERE c.n > 1
), over AS (
    SELECT rid, 0 AS lvl, s.place, s.n, c.h, proof FROM climbed c JOIN subroots s ON c.lang = s.lang WHERE c.n = 1
    UNION ALL
    SELECT rid, o.lvl + 1, o.place // 2, (o.n + 1) // 2,
        sha256(CASE WHEN o.place % 2 = 0 THEN o.h || coalesce(s.h, '') ELSE s.h || o.h END), proof || coalesce(s.h, '')
    FROM over o LEFT JOIN top s ON s.lvl = o.lvl AND s.place = xor(o.place, 1) WHERE o.n > 1
)
SELECT l.doc_id, l.leaf, s.h AS subroot, r.h AS root, sha256(o.proof) AS proof_sha256, o.h AS folded_root, o.h = r.h AS verified
FROM leaves l JOIN subroots s ON l.lang = s.lang JOIN over o ON o.rid = l.rid AND o.n = 1 CROSS JOIN (SELECT h FROM top WHERE n = 1) r
"""

#: Near words by wildcards: equal after one letter is masked or left out.
_SPELLING = """
WITH crc_table AS (
    SELECT list(list_reduce(list_prepend(i::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) ORDER BY i) AS t
    FROM range(256) r(i)
), runs AS (
    SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
    FROM (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)
    GROUP BY 1, 2
), bytes AS (
    SELECT *, list_transform(string_split(id || ':' || run, ''), lambda x: unicode(x)::BIGINT) AS points FROM runs WHERE length(run) >= 6
), hashed AS (
    SELECT run, times, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(points, lambda x:
            CASE WHEN x < 128 THEN [x] ELSE [192 + (x >> 6), 128 + (x & 63)] END))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS h FROM bytes, crc_table
), words AS MATERIALIZED (
    SELECT CASE WHEN h % 199 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, sum(times)::BIGINT AS n
    FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(times) >= 5
), cut AS MATERIALIZED (
    SELECT word, n, i, word[:i - 1] AS before, word[i + 1:] AS after FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
    SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.before = b.before AND a.after = b.after AND a.word <> b.word
    UNION
    SELECT c.word, c.n, w.word, w.n FROM cut c JOIN words w ON w.word = c.before || c.after
    UNION
    SELECT w.word, w.n, c.word, c.n FROM cut c JOIN words w ON w.word = c.before || c.after
), best AS MATERIALIZED (
    SELECT word, n, count(*) AS n_near, max(other_n) AS most, arg_min(other, (-other_n, other)) AS other FROM near GROUP BY word, n
), forms AS MATERIALIZED (
    SELECT word, n_near, CASE WHEN most >= 5 * n THEN other END AS form, CASE WHEN most >= 5 * n THEN most END AS form_n FROM best
), chain AS (
    WITH RECURSIVE up AS (
        SELECT word, form AS step FROM forms WHERE form IS NOT NULL
        UNION ALL
        SELECT up.word, f.form FROM up JOIN forms f ON f.word = up.step WHERE f.form IS NOT NULL
    )
    SELECT word, arg_max(step, n) AS root FROM (SELECT up.word, up.step, w.n FROM up JOIN words w ON w.word = up.step) GROUP BY word
)
SELECT w.word, form, coalesce(root, w.word) AS root, w.n, coalesce(n_near, 0)::BIGINT AS n_near, form_n
FROM words w LEFT JOIN forms f ON w.word = f.word LEFT JOIN chain c ON w.word = c.word
"""

ORACLE = {
    "op3_maxscore_top_k": _TOP_K,
    "op8_source_mixing": _MIXING,
    "op11_spelling_variants": _SPELLING,
    "op12_merkle_manifest": _MERKLE,
}
