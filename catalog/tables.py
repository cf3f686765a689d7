"""Pair tables, listings and footers derived from the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.operators.cleaning import drop_lines

ALL_LANGUAGES = ("en", "fr", "de", "es")
JUNK = "[#%&*$]{3}"
NOTICE = "licen[sc]e|rights reserved|^the and attion"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(
        "doc_id", "lang", F.col("text").alias("raw"), F.trim(F.regexp_replace("text", F.lit(JUNK), "")).alias("clean")
    )


PAIRS = f"""pairs AS (
    SELECT doc_id, lang, text AS raw, trim(regexp_replace(text, '{JUNK}', '', 'g')) AS clean FROM documents
)"""


def furnished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with page furniture around and between their lines; French ones count as Indonesian here."""
    lang = F.when(F.col("lang") == "fr", "id").otherwise(F.col("lang"))
    raw = F.concat(
        F.lit("Home | Search\nBeranda\nHome and "), F.replace(F.col("text"), F.lit("\n"), F.lit("\nBack to top\nKembali ke atas\n")),
        F.lit(" All rights reserved.\n(c) 2001 | All rights reserved.\nHak cipta 2001"),
    )
    return documents(spark, sf_dir).select("doc_id", lang.alias("lang"), raw.alias("raw"))


FURNISHED = r"""furnished AS (
    SELECT doc_id, CASE lang WHEN 'fr' THEN 'id' ELSE lang END AS lang,
        'Home | Search' || chr(10) || 'Beranda' || chr(10) || 'Home and '
        || replace(text, chr(10), chr(10) || 'Back to top' || chr(10) || 'Kembali ke atas' || chr(10))
        || ' All rights reserved.' || chr(10) || '(c) 2001 | All rights reserved.' || chr(10) || 'Hak cipta 2001' AS text
    FROM documents
)"""


def broken_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with missing values: no language in German, no raw in Spanish, no clean from src0."""
    return documents(spark, sf_dir).select(
        "doc_id",
        F.nullif("lang", F.lit("de")).alias("lang"),
        F.when(F.col("lang") != "es", F.col("text")).alias("raw"),
        F.when(F.col("source") != "src0", F.col("text")).alias("clean"),
    )


BROKEN = """broken AS (
    SELECT doc_id, nullif(lang, 'de') AS lang,
        CASE WHEN lang <> 'es' THEN text END AS raw,
        CASE WHEN source <> 'src0' THEN text END AS clean
    FROM documents
)"""


def lossy_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs whose raw lines are list items, and a cleaning that drops notices, bars and bullets."""
    raw = F.replace(F.col("text"), F.lit("\n"), F.lit("\n- "))
    clean = F.regexp_replace(drop_lines(F.col("text"), NOTICE), F.lit(JUNK), "")
    return documents(spark, sf_dir).select(
        "doc_id",
        "lang",
        raw.alias("raw"),
        F.when(F.col("lang") == "de", F.replace(clean, F.lit("\n"), F.lit("\n- ")))
        .when(F.col("lang") == "en", F.replace(clean, F.lit(" | "), F.lit(" ")))
        .otherwise(clean)
        .alias("clean"),
    )


LOSSY = f"""cut AS (
    SELECT doc_id, lang, replace(text, chr(10), chr(10) || '- ') AS raw,
        regexp_replace(coalesce(array_to_string(list_filter(string_split(text, chr(10)),
            lambda l: NOT regexp_matches(l, '(?i){NOTICE}')), chr(10)), ''), '{JUNK}', '', 'g') AS kept
    FROM documents
), lossy AS (
    SELECT doc_id, lang, raw, CASE lang
        WHEN 'de' THEN replace(kept, chr(10), chr(10) || '- ')
        WHEN 'en' THEN replace(kept, ' | ', ' ')
        ELSE kept END AS clean
    FROM cut
)"""


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file listing with one sound dataset and, per language, one with faults of its own kind."""
    docs = documents(spark, sf_dir).select("doc_id", "lang", "source", "n_chars")
    total = docs.agg(F.count("*")).scalar()
    sound = docs.select(
        F.lit("all").alias("dataset"),
        F.format_string("train-%d-of-%d.parquet", F.col("doc_id"), total).alias("name"),
        F.lit(True).alias("top_level"),
        "*",
    )
    name = (
        F.when(F.col("lang") == "en", F.format_string("train-%d-of-%d.parquet", "n_chars", F.length("source")))
        .when(F.col("lang") == "de", F.format_string("train-%s-of-9.parquet", "source"))
        .when((F.col("lang") == "fr") & (F.col("source") > "src2"), F.format_string("train-%d-of-7.parquet", "doc_id"))
        .when(F.col("lang") == "fr", F.format_string("tmp-%d.parquet", "doc_id"))
        .otherwise(F.format_string("part-%d.parquet", "doc_id"))
    )
    faulty = docs.select(
        F.col("lang").alias("dataset"), name.alias("name"), (F.col("lang") == "es").alias("top_level"), "*"
    )
    path = F.concat(F.lit("/"), F.col("dataset"), F.lit("/"), F.col("doc_id"), F.lit("/"), F.col("name"))
    return sound.unionByName(faulty).withColumn("path", path)


LISTING = """named AS (
    SELECT 'all' AS dataset, 'train-' || doc_id || '-of-' || (SELECT count(*) FROM documents) || '.parquet' AS name,
        true AS top_level, doc_id, lang, source, n_chars
    FROM documents
    UNION ALL
    SELECT lang, CASE
        WHEN lang = 'en' THEN 'train-' || n_chars || '-of-' || length(source) || '.parquet'
        WHEN lang = 'de' THEN 'train-' || source || '-of-9.parquet'
        WHEN lang = 'fr' AND source > 'src2' THEN 'train-' || doc_id || '-of-7.parquet'
        WHEN lang = 'fr' THEN 'tmp-' || doc_id || '.parquet'
        ELSE 'part-' || doc_id || '.parquet' END,
        lang = 'es', doc_id, lang, source, n_chars
    FROM documents
), listing AS (
    SELECT *, '/' || dataset || '/' || doc_id || '/' || name AS path FROM named
), train AS (
    SELECT * FROM listing WHERE starts_with(name, 'train-')
), shards AS (
    SELECT *, try_cast(split_part(split_part(name, '-', 2), '-', 1) AS BIGINT) AS idx,
        try_cast(split_part(split_part(name, '-of-', 2), '.', 1) AS BIGINT) AS of_m,
        regexp_full_match(name, 'train-[0-9]+-of-[0-9]+[.]parquet') AS valid
    FROM train
)"""


def footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Footers of the listing's train files: French mixes kinds, English has broken files, German
    has the columns of both kinds or of none."""
    pair_cols = F.array(F.lit("lang"), F.lit("raw"), F.lit("clean"), F.lit("doc_id"))
    token_cols = F.array(F.lit("input_ids"), F.lit("labels"), F.lit("length"))
    cols = (
        F.when((F.col("dataset") == "fr") & (F.col("source") > "src5"), token_cols)
        .when((F.col("dataset") == "de") & (F.col("source") > "src5"), F.concat(pair_cols, token_cols))
        .when(F.col("dataset") == "de", F.array(F.lit("text"), F.lit("lang")))
        .otherwise(pair_cols)
    )
    broken = (F.col("dataset") == "en") & (F.col("source") == "src0")
    return listing(spark, sf_dir).filter(F.col("name").startswith("train-")).select(
        "dataset",
        "path",
        "name",
        F.when(~broken, F.col("n_chars")).alias("n_rows"),
        F.when(~broken, cols).alias("cols"),
        F.when(broken, F.concat(F.lit("no footer in "), F.col("name"))).alias("error"),
    )


FOOTERS = f"""{LISTING}, footers AS (
    SELECT dataset, path, name, CASE WHEN dataset = 'en' AND source = 'src0' THEN NULL ELSE n_chars END AS n_rows,
        CASE WHEN dataset = 'en' AND source = 'src0' THEN 'no footer in ' || name END AS error,
        CASE WHEN dataset = 'en' AND source = 'src0' THEN NULL
            WHEN dataset = 'fr' AND source > 'src5' THEN 'tok'
            WHEN dataset = 'de' AND source > 'src5' THEN 'tok'
            WHEN dataset = 'de' THEN 'unknown'
            ELSE 'raw' END AS kind
    FROM train
)"""


def lexicon(spark: SparkSession) -> DataFrame:
    """Terms to watch: a parameter of the check, like a pattern."""
    terms = [
        ("en", "negation", "not"), ("en", "negation", "of"), ("en", "hedge", "that"), ("en", "hedge", "the"),
        ("fr", "negation", "ne"), ("fr", "hedge", "que"), ("fr", "hedge", "pour"),
        ("de", "negation", "nicht"), ("de", "hedge", "auch"),
        ("es", "negation", "no"), ("es", "hedge", "ción"),
    ]
    return spark.createDataFrame(terms, "lang string, kind string, term string")


LEXICON = """lexicon(lang, kind, term) AS (VALUES
    ('en', 'negation', 'not'), ('en', 'negation', 'of'), ('en', 'hedge', 'that'), ('en', 'hedge', 'the'),
    ('fr', 'negation', 'ne'), ('fr', 'hedge', 'que'), ('fr', 'hedge', 'pour'),
    ('de', 'negation', 'nicht'), ('de', 'hedge', 'auch'),
    ('es', 'negation', 'no'), ('es', 'hedge', 'ción')
)"""
