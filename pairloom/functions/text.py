"""Text expressions over whole strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes. SQL trim() removes only U+0020.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# possessive: Java matches a repeated group that may give back by recursion, which long texts overflow
NUMBER = r"[0-9]+(?:[.,][0-9]+)*+"
WORD = r"[\p{L}\p{N}]+"
# (?d): only a line feed ends a line, as in split(text, '\n')
LIST_ITEM = r"(?md)^[ \t]*([-*+•‣▪]|[0-9]{1,3}[.)])[ \t]+[^ \t\n]"
TABLE_ROW = r"(?md)^[^|\n]*\|[^|\n]*\|"


def strip_text(text: Column) -> Column:
    """Remove white space of every kind from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def preview_text(text: Column, limit: int, mark: str = "...") -> Column:
    """The first ``limit`` characters, with ``mark`` behind them only when something was cut."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit(mark))).otherwise(text)


def prefixed(lang: Column, text: Column) -> Column:
    """The form the model sees: the language tag, a space, the text."""
    return F.concat(F.lit("<"), lang, F.lit("> "), text)


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def last_line(text: Column) -> Column:
    """The last line that is not blank, stripped; empty for blank text."""
    body = F.rtrim(text, F.lit(WHITESPACE))
    return strip_text(F.substring_index(body, "\n", -1))


def numbers(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(NUMBER), 0)


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), 0)


def occurrences(text: Column, term: Column) -> Column:
    """How often ``term`` occurs in ``text`` without overlap; no regular expression involved."""
    removed = F.length(text) - F.length(F.replace(text, term, F.lit("")))
    return (removed / F.length(term)).cast("int")


def multiset_excess(items: Column, other: Column) -> Column:
    """How many items are left of ``items`` when each item of ``other`` cancels one equal item.

    Both arrays belong to one row, so this needs no shuffle. Where no item repeats it is a set
    difference. Else the two are sorted together, with ``other`` first among equals, and one fold over
    the result keeps a balance per value: the cost is that of the sort, however often one value repeats.
    """
    unique = F.size(F.array_distinct(items)) == F.size(items)
    return F.when(unique, F.size(F.array_except(items, other))).otherwise(_folded_excess(items, other))


def _folded_excess(items: Column, other: Column) -> Column:
    tagged = F.array_sort(
        F.concat(
            F.transform(other, lambda v: F.struct(v.alias("v"), F.lit(0).alias("side"))),
            F.transform(items, lambda v: F.struct(v.alias("v"), F.lit(1).alias("side"))),
        )
    )
    start = F.struct(
        F.lit(None).cast("string").alias("v"), F.lit(0).alias("balance"), F.lit(0).alias("excess")
    )

    def step(state: Column, item: Column) -> Column:
        held = F.when(state["v"] == item["v"], state["balance"]).otherwise(0)
        is_other = item["side"] == 0
        return F.struct(
            item["v"].alias("v"),
            F.when(is_other, held + 1).otherwise(F.greatest(held - 1, F.lit(0))).alias("balance"),
            (state["excess"] + F.when(~is_other & (held == 0), 1).otherwise(0)).alias("excess"),
        )

    return F.aggregate(tagged, start, step, lambda state: state["excess"])


def multiset_surplus(items: Column, other: Column) -> Column:
    """``v, n_items, n_other`` for each value that ``items`` has more often than ``other``.

    One fold over the sorted values, as in :func:`multiset_excess`; a null array has no values.
    """
    none = F.array().cast("array<string>")
    tagged = F.array_sort(
        F.concat(
            F.transform(F.coalesce(items, none), lambda v: F.struct(v.alias("v"), F.lit(1).alias("side"))),
            F.transform(F.coalesce(other, none), lambda v: F.struct(v.alias("v"), F.lit(0).alias("side"))),
        )
    )
    zero = F.lit(0).cast("bigint")
    start = F.struct(
        F.lit(None).cast("string").alias("v"), zero.alias("i"), zero.alias("o"),
        F.array().cast("array<struct<v: string, n_items: bigint, n_other: bigint>>").alias("found"),
    )

    def closed(state: Column) -> Column:
        entry = F.struct(state["v"].alias("v"), state["i"].alias("n_items"), state["o"].alias("n_other"))
        return F.when(state["i"] > state["o"], F.concat(state["found"], F.array(entry))).otherwise(state["found"])

    def step(state: Column, item: Column) -> Column:
        same, one = F.coalesce(state["v"] == item["v"], F.lit(False)), F.lit(1).cast("bigint")
        return F.struct(
            item["v"].alias("v"),
            (F.when(same, state["i"]).otherwise(zero) + F.when(item["side"] == 1, one).otherwise(zero)).alias("i"),
            (F.when(same, state["o"]).otherwise(zero) + F.when(item["side"] == 0, one).otherwise(zero)).alias("o"),
            F.when(same, state["found"]).otherwise(closed(state)).alias("found"),
        )

    return F.aggregate(tagged, start, step, closed)
