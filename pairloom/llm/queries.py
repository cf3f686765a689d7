"""One query per operator, over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import (
    bpe, contamination, filter_audit, hard_negatives, language, packing, quality, sharding, similar_sets, surrogates,
    token_counts, toxicity, url_rules,
)
from pairloom.llm.shared import documents

TOKEN_LIMIT = 1024

# The rules every page is judged by.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def held_out(key: str, folds: int, fold: int) -> Column:
    """Whether the key is in the fold that nothing is learned from; a null key is not."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(folds)) == fold, F.lit(False))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    learned = language.learn(docs.where(~held_out("doc_id", 3, 1)))
    found = language.identify(docs, F.col("text"), learned).alias("found")
    return docs.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), found).select(
        "doc_id", "held_out", "found.*"
    )


#: In production the key comes from the job's secrets; without it surrogates cannot be told from originals.
SURROGATE_KEY = "example key"


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return surrogates.replaced(docs, SURROGATE_KEY).select("doc_id", "n_entities", "text")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = contamination.contamination(docs, items, ["doc_id"])
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.url_verdicts(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    return docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        token_counts.token_counts(docs, F.col("text"), path).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    tokens = packing.token_lengths(docs, F.col("text"), public_tokenizers.path("byte_bpe_50k.json"))
    packed = sharding.pack(docs, tokens=tokens)
    return packed.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = similar_sets.similar_groups(documents(spark, sf_dir))
    return groups.withColumnRenamed("id", "doc_id")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    coded = docs.select("doc_id", bpe.encode(docs, F.col("text"), path, public_tokenizers.PATTERN).alias("ids"))
    coded = coded.select("doc_id", "ids", bpe.decode(coded, F.col("ids"), path).alias("data"))
    return bpe_digests(coded)


def bpe_digests(coded: DataFrame, *more: str) -> DataFrame:
    return coded.select(
        "doc_id", *more,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    weights = toxicity.learn(toxicity.sampled(labels.where(~held_out("doc_id", 5, 0)), docs))
    scored = docs.select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"),
        toxicity.score(docs, F.col("text"), weights).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op10_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return quality.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")).select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"
    )
    # a sequence is one piece, so that no sequence crosses documents
    return packing.bucketed(found).withColumn("offset", F.lit(0).cast("bigint"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    return filter_audit.audit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = hard_negatives.usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    moved = F.coalesce(F.col("id") % 7 == 0, F.lit(False)) & (F.col("id") != hard_negatives.NO_ID)
    vectors = vectors.withColumn("label", F.when(moved, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(vectors, F.col("id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_surrogates": op2_surrogates,
    "op3_decontamination": op3_decontamination,
    "op4_url_rules": op4_url_rules,
    "op5_token_counts": op5_token_counts,
    "op6_sharding": op6_sharding,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_toxicity": op9_toxicity,
    "op10_quality_cascade": op10_quality_cascade,
    "op11_packing": op11_packing,
    "op12_filter_audit": op12_filter_audit,
    "op13_hard_negatives": op13_hard_negatives,
}

_RULES = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = r"[\x20\x09-\x0D]"

_WORDS = (
    "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

ORACLES: dict[str, str] = {
    "op3_decontamination": f"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
        items AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS words FROM benchmark WHERE item_id IS NOT NULL),
        cut AS (
            SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM items WHERE len(words) > 0
        ),
        wins AS (SELECT DISTINCT item, words[i:i + 9] AS win, len(words[i:i + 9]) AS size FROM cut),
        sizes AS (SELECT DISTINCT size FROM wins),
        places AS (
            SELECT r, size, unnest(range(1, len(words) - size + 2)) AS i, words FROM docs, sizes WHERE len(words) >= size
        ),
        hits AS (
            SELECT r, i, p.size, item FROM (SELECT r, i, size, words[i:i + size - 1] AS win FROM places) p
            JOIN wins ON p.win = wins.win
        ),
        spans AS (
            SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + size)) AS k FROM hits)
            GROUP BY r
        ),
        named AS (
            SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
        )
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
            coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN spans USING (r) LEFT JOIN named USING (r)
    """,
    "op4_url_rules": f"""
        WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULES}),
        places AS (
            SELECT page_id,
                {_LOWER.format("regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's')")} AS host,
                regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
            FROM pages
        ),
        judged AS (
            SELECT page_id, host, path, max_by(struct_pack(r := rule_host || rule_path, v := rule_verdict),
                length(rule_host || rule_path)) AS won
            FROM places LEFT JOIN rules
                ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY ALL
        )
        SELECT page_id, host, path, CASE WHEN won.r IS NOT NULL THEN won.r END AS rule,
            coalesce(won.v, 'allow') AS verdict
        FROM judged
    """,
    "op10_quality_cascade": rf"""
        WITH split AS (
            SELECT doc_id, coalesce(text, '') AS text,
                list_filter(string_split_regex(coalesce(text, ''), '{_SPACE}+'), lambda w: w <> '') AS words,
                list_filter(string_split(coalesce(text, ''), chr(10)),
                    lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
            FROM documents
        ),
        rows AS (SELECT row_number() OVER () AS r, * FROM split),
        grams AS (
            SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
            FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM rows)
        ),
        again AS (SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, gram) > 1),
        hit AS (
            SELECT r, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) AS t(k) GROUP BY r
        ),
        counts AS (
            SELECT doc_id, len(words)::BIGINT AS n_words,
                length(regexp_replace(text, '{_SPACE}', '', 'g'))::BIGINT AS word_chars,
                (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                coalesce(n, 0)::BIGINT AS n_repeat_words,
                len(list_filter(words, lambda w: NOT regexp_matches(w, '\p{{L}}'))) AS bare
            FROM rows LEFT JOIN hit USING (r)
        ),
        judged AS (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
                greatest(n_words, 1) AS n FROM counts
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT base_failed AND word_chars BETWEEN 2 * n AND 20 * n AND n_symbols <= n AND 2 * bare <= n
                AND 10 * n_dup_lines <= n AS kept
        FROM judged
    """,
    "op12_filter_audit": r"""
        WITH orders AS (
            SELECT a || b || c || d || e AS filter_order FROM (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) t1(a),
                (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) t2(b), (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) t3(c),
                (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) t4(d), (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) t5(e)
            WHERE len(list_distinct([a, b, c, d, e])) = 5
        ),
        steps AS (
            SELECT filter_order, step::INTEGER AS step, filter_order[step:step] AS own, filter_order[1:step - 1] AS before
            FROM orders, range(1, 6) r(step)
        ),
        texts AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
                min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
            FROM documents
        ),
        known AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
        fails AS (
            SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad,
                CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
                || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
                || CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text)
                    THEN 'C' ELSE '' END
                || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
                || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS failed
            FROM texts LEFT JOIN known USING (doc_id)
        ),
        counts AS (
            SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad
            FROM fails GROUP BY ALL
        )
        SELECT part, filter_order, step,
            coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0)::BIGINT AS kept,
            coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed,
            coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant,
            coalesce(sum(n) FILTER (failed = own), 0)::BIGINT AS unique_fails,
            coalesce(sum(good) FILTER (hit AND NOT gone), 0)::BIGINT AS good_lost,
            coalesce(sum(bad) FILTER (hit AND NOT gone), 0)::BIGINT AS toxic_lost,
            coalesce(sum(n * 120 // greatest(length(failed), 1)) FILTER (hit), 0)::BIGINT AS shapley
        FROM (
            SELECT counts.*, steps.*, contains(failed, own) AS hit,
                len(list_filter(string_split(before, ''), lambda f: f <> '' AND contains(failed, f))) > 0 AS gone
            FROM counts, steps
        )
        GROUP BY part, filter_order, step
    """,
    "op13_hard_negatives": """
        WITH rows AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
                list_dot_product(a.v, c.v)::BIGINT AS score
            FROM (SELECT DISTINCT * FROM rows WHERE vec_id % 100 = 0) a, rows c
        ),
        positives AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored
            WHERE same AND id IS DISTINCT FROM anchor_id
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id NULLS LAST) <= 5
        )
        SELECT p.anchor_id, positive_id,
            (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.id NULLS LAST))::INTEGER AS rank,
            n.id AS negative_id, positive_score, n.score AS negative_score
        FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
            AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score
        QUALIFY rank <= 10
    """,
}
