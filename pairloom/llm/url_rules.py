"""URL rules by hash lists.

Every URL is expanded into host suffixes and path prefixes, the expressions are joined with the rules on a
short prefix of their digest, and a pair counts once the full digests agree. Of the rules that fit, the one
with the longest host and path wins; between equals the longer host, then `block`.

A rule fits its host and all subdomains if the path starts with the rule's path. Only suffixes of as many
labels and prefixes of as many characters as some rule has are made, so an expression is never missed and
long hosts or paths cost no more than short ones. Null urls and urls without `://` have an empty host and
path; no rule fits them, nor a url without a path if the rule has one. Rows, also equal ones, are kept one
for one with all their columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import ascii_lower, spare_name, written

#: Rules that are sent to every executor at most: about 200 bytes each, 40 MB. More are joined by a shuffle.
BROADCAST_RULES = 200_000
#: A host and path with more than this share of all rows meets its verdict by broadcast (there are 1 / HOT at most),
#: all others by a shuffle.
HOT = 1 / 1000
SHORT = 8  # hex digits of the joined digest prefix


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(found)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def url_verdicts(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``urls`` with `host`, `path`, `rule` (host and path of the winner, or null) and `verdict`.

    ``rules`` has `host`, `path` and `verdict`; rows with a null host or path are no rules. Columns of
    ``urls`` by these names are replaced.
    """
    rules = rules.select(ascii_lower(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
    rules = rules.where(F.col("rule_host").isNotNull() & F.col("rule_path").isNotNull())
    rules = rules.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("rule_verdict"))
    shapes = rules.agg(
        F.count(F.lit(1)).alias("n"),
        F.collect_set(F.size(F.split("rule_host", r"\."))).alias("labels"),
        F.collect_set(F.char_length("rule_path")).alias("chars"),
    ).first()
    out = urls.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    if not shapes["n"]:
        return out.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})

    full = _digest(F.col("rule_host"), F.col("rule_path"))
    listed = rules.select("*", full.alias("rule_digest"), F.substring(full, 1, SHORT).alias("short"))
    if shapes["n"] <= BROADCAST_RULES:
        listed = F.broadcast(listed)

    parts = F.split("host", r"\.")
    suffixes = F.filter(
        F.array(*[
            F.when(F.size(parts) >= k, F.substring_index("host", ".", -k)) for k in sorted(shapes["labels"])
        ]),
        lambda x: x.isNotNull(),
    )
    prefixes = F.filter(
        F.array(*[
            F.when(F.char_length("path") >= k, F.substring("path", 1, k)) for k in sorted(shapes["chars"])
        ]),
        lambda x: x.isNotNull(),
    )
    places = written(out.groupBy("host", "path").agg(F.count(F.lit(1)).alias("rows")), "places")
    n = places.agg(F.sum("rows")).first()[0] or 0
    expressions = (
        places.select("host", "path").withColumn("suffix", F.explode(suffixes))
        .withColumn("prefix", F.explode(prefixes))
        .withColumn("digest", _digest(F.col("suffix"), F.col("prefix")))
        .withColumn("short", F.substring("digest", 1, SHORT))
    )
    rank = F.struct(
        F.char_length("rule_host") + F.char_length("rule_path"), F.char_length("rule_host"), F.col("rule_verdict")
    )
    won = (
        expressions.join(listed, "short")
        .where(F.col("digest") == F.col("rule_digest"))
        .groupBy("host", "path")
        .agg(F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "rule_verdict"), rank).alias("won"))
    )
    won = written(won.select("host", "path", "won.*"), "won")
    hot = places.where(F.col("rows") > n * HOT).select("host", "path", F.lit(True).alias("hot"))
    hot = hot.join(won, ["host", "path"], "left")
    return _judged(out, won, hot, default)


def _judged(out: DataFrame, won: DataFrame, hot: DataFrame, default: str) -> DataFrame:
    """``out`` with the rule and verdict of its host and path; no frequent one is shuffled."""
    own = {c: spare_name(out, f"won_{c}") for c in ("host", "path", "hot", "rule", "rule_verdict")}

    def beside(table: DataFrame) -> DataFrame:
        return table.select(*[F.col(c).alias(own[c]) for c in table.columns])

    def met(rows: DataFrame, table: DataFrame) -> DataFrame:
        same = (rows["host"] == table[own["host"]]) & (rows["path"] == table[own["path"]])
        return rows.join(table, same, "left")

    def told(rows: DataFrame) -> DataFrame:
        rows = rows.withColumns({
            "rule": F.col(own["rule"]), "verdict": F.coalesce(F.col(own["rule_verdict"]), F.lit(default)),
        })
        return rows.select(*out.columns, *[c for c in ("rule", "verdict") if c not in out.columns])

    first = met(out, F.broadcast(beside(hot)))
    rest = first.where(F.col(own["hot"]).isNull()).select(*out.columns)
    return told(first.where(F.col(own["hot"]))).unionByName(told(met(rest, beside(won))))
