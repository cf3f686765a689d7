"""Quality rules as a short-circuit cascade.

Each rule is a condition under which a text fails. Its cost and its selectivity are estimated on a bounded sample:
SAMPLE_ROWS rows of the first files, of which those that pass the base counts, as only these reach the rules. The
cost is the time a rule takes on COPIES copies of them, beyond that of a job that does nothing; the selectivity is
the share it rejects. Rules then run in the order of rejection per cost, each only on rows that no earlier rule
rejected: one nested CASE, so a rejected row never reaches a dear rule. The order changes the time, never the verdict.

Words are runs without the ASCII white space characters. A null text has no words and counts zero
everywhere; so does an empty one. Rows, also equal ones, are kept one for one with all their columns; columns by
the names of the results are replaced. An empty table has no verdicts.
"""

from __future__ import annotations

import statistics
import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import let, spare_name

#: Rows of the sample on which cost and selectivity are estimated, and characters of a text in it.
SAMPLE_ROWS = 400
SAMPLE_TEXT = 20_000
#: Copies of the sample that a rule is timed on, so that its own work shows beside a job's start, and runs of it.
COPIES = 10
RUNS = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# The white space that parts words, and the symbols.
SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
SYMBOLS = r"[#*$%&|<>]"


def _text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words_of(text: Column) -> Column:
    """The words, in order."""
    trimmed = F.btrim(_text(text), F.lit("".join(SPACES)))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def word_chars(text: Column) -> Column:
    """Code points that are not white space."""
    bare = _text(text)
    for space in SPACES:
        bare = F.replace(bare, F.lit(space), F.lit(""))
    return F.char_length(bare).cast("long")


def n_symbols(text: Column) -> Column:
    return F.regexp_count(_text(text), F.lit(SYMBOLS)).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(_text(text), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def n_repeat_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more in the text.

    The windows are hashed and sorted with their positions, so equal ones are neighbours; the positions of
    those that have an equal neighbour, spread over three words each, are counted once.
    """
    n = F.size(words) - 2
    hashes = F.transform(
        F.sequence(F.lit(1), n), lambda i: F.xxhash64(words[i - 1], words[i], words[i + 1])
    )

    def spread(at: Column) -> Column:
        return F.size(F.array_distinct(F.concat(at, F.transform(at, lambda i: i + 1), F.transform(at, lambda i: i + 2))))

    def starts(placed: Column, h: Column) -> Column:
        return F.filter(placed, lambda x, k: (x["h"] == F.get(h, k - 1)) | (x["h"] == F.get(h, k + 1)))["i"]

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.arrays_zip(hashes.alias("h"), F.sequence(F.lit(0), F.size(hashes) - 1).alias("i")))
        return let(placed, lambda p: let(p["h"], lambda h: let(starts(p, h), spread)))

    def repeats(hashes: Column) -> Column:
        unique = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(unique, F.lit(0)).otherwise(covered(hashes))

    return F.when(n < 2, F.lit(0)).otherwise(let(hashes, repeats)).cast("long")


def base_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    words = spare_name(df, "words")
    out = df.withColumn(words, words_of(F.col(text)))
    out = out.withColumns({
        "n_words": F.size(words).cast("long"),
        "word_chars": word_chars(F.col(text)),
        "n_symbols": n_symbols(F.col(text)),
        "n_dup_lines": n_dup_lines(F.col(text)),
        "n_repeat_words": n_repeat_words(F.col(words)),
    }).drop(words)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return out.withColumn("base_failed", failed)


def default_rules(text: str = "text") -> dict[str, Column]:
    """Rules beyond the base counts, as conditions under which a text fails; they need `n_words`."""
    t, n = _text(F.col(text)), F.greatest(F.col("n_words"), F.lit(1))
    return {
        # words of 2 to 20 characters on average
        "word_length": ~F.col("word_chars").between(2 * n, 20 * n),
        # more than one symbol for each word
        "symbols": F.col("n_symbols") > n,
        # more than half of the words without any letter
        "letters": 2 * F.regexp_count(t, F.lit(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D\p{L}]++(?![^\x20\x09-\x0D])")) > n,
        # more repeated lines than a line for every ten words
        "lines": 10 * F.col("n_dup_lines") > n,
    }


def sampled(df: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` rows of ``df``, read from as few files as they take, with bounded texts."""
    first = df.withColumn(text, F.substring(text, 1, SAMPLE_TEXT)).take(rows)
    return df.sparkSession.createDataFrame(first, df.schema)


def estimate(sample: DataFrame, rules: dict[str, Column]) -> list[tuple[str, float, float]]:
    """(rule, seconds, share rejected) on the rows of ``sample`` that did not fail the base counts."""
    # kept before the filter, which would otherwise be pushed below the counts and make them anew for every word
    counted = sample.cache()
    many = counted.where(~F.col("base_failed")).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(COPIES)))).drop("_copy").cache()

    def timed(measure: Column) -> tuple[float, int]:
        seconds = []
        for _ in range(RUNS):
            start = time.perf_counter()
            found = many.agg(measure).first()[0]
            seconds.append(time.perf_counter() - start)
        return statistics.median(seconds), found

    try:
        n = many.count()
        idle, _ = timed(F.count(F.lit(1)))
        out = []
        for name, rule in rules.items():
            seconds, hits = timed(F.count_if(rule))
            out.append((name, max(seconds - idle, 0.0), hits / n if n else 0.0))
        return out
    finally:
        many.unpersist()
        counted.unpersist()


def by_yield(estimates: list[tuple[str, float, float]]) -> list[str]:
    """Rule names, the highest rejection per cost first; ties by name. Times under a millisecond count as one."""
    return [name for name, *_ in sorted(estimates, key=lambda e: (-e[2] / max(e[1], 1e-3), e[0]))]


def cascade(rules: dict[str, Column], order: list[str]) -> Column:
    """The name of the first rule that rejects the row, in ``order``; null if none does."""
    out = F.lit(None).cast("string")
    for name in reversed(order):
        out = F.when(rules[name], F.lit(name)).otherwise(out)
    return out


def judge(df: DataFrame, text: str = "text", rules: dict[str, Column] | None = None) -> DataFrame:
    """``df`` with the base counts, `failed_rule` (null: none) and `kept`."""
    rules = rules or default_rules(text)
    order = by_yield(estimate(base_counts(sampled(df, text), text), rules))
    out = base_counts(df, text)
    out = out.withColumn("failed_rule", F.when(~F.col("base_failed"), cascade(rules, order)))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("failed_rule").isNull())
