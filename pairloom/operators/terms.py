"""Terms of a lexicon in texts: one automaton per language, run inside the row.

An Aho-Corasick automaton finds all terms of a language in one pass over a text, whatever their number. The
lexicon is compiled once per Python worker. It is sent with the tasks as long as it is no larger than
``LEXICON_BYTES``; a larger one is cut by hash into parts of that size, each of which reads the texts once.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.session import ship_package

#: Bytes of a part of the lexicon, with 32 counted for each term besides its text.
LEXICON_BYTES = 16 << 20

_FOUND = pa.list_(
    pa.struct([("kind", pa.string()), ("n_raw", pa.int64()), ("n_clean", pa.int64()), ("lost", pa.int64())])
)
_FOUND_DDL = "array<struct<kind: string, n_raw: bigint, n_clean: bigint, lost: bigint>>"


class Finder:
    """Occurrences of one language's terms.

    ``whole``: a term counts only where no letter or digit touches it. No term overlaps with itself.
    """

    def __init__(self, terms: Iterable[str], whole: bool):
        import ahocorasick

        self.whole = whole
        self.automaton = ahocorasick.Automaton()
        for term in terms:
            self.automaton.add_word(term, term)
        self.automaton.make_automaton()

    def count(self, text: str) -> Counter[str]:
        found: Counter[str] = Counter()
        free: dict[str, int] = {}  # where a term may begin again
        last = len(text) - 1
        for end, term in self.automaton.iter(text):
            start = end - len(term) + 1
            if self.whole and (
                (start > 0 and text[start - 1].isalnum()) or (end < last and text[end + 1].isalnum())
            ):
                continue
            if start >= free.get(term, 0):
                found[term] += 1
                free[term] = end + 1
        return found


class Lexicon:
    """Finders and kinds by language. A term may be of several kinds."""

    def __init__(self, rows: Iterable[tuple[str, str, str]], unspaced: Sequence[str]):
        self.kinds: dict[str, dict[str, list[str]]] = {}
        for lang, kind, term in rows:
            self.kinds.setdefault(lang, {}).setdefault(term, []).append(kind)
        self.finders = {lang: Finder(terms, lang not in unspaced) for lang, terms in self.kinds.items()}

    def compare(self, lang: str, raw: str, clean: str) -> list[dict]:
        """Per kind that occurs: occurrences in both texts, and how many fewer clean has, term by term."""
        finder, kinds = self.finders[lang], self.kinds[lang]
        before, after = finder.count(raw), finder.count(clean)
        sums: dict[str, list[int]] = {}
        for term in before.keys() | after.keys():
            r, c = before[term], after[term]
            for kind in kinds[term]:
                total = sums.setdefault(kind, [0, 0, 0])
                total[0] += r
                total[1] += c
                total[2] += max(r - c, 0)
        return [{"kind": k, "n_raw": n[0], "n_clean": n[1], "lost": n[2]} for k, n in sorted(sums.items())]


def _compare(rows: list[tuple[str, str, str]], unspaced: Sequence[str]):
    """A column function of language, raw and clean (both in lower case)."""
    packed = pickle.dumps((rows, tuple(unspaced)))

    @F.arrow_udf(_FOUND_DDL)
    def compared(langs: pa.Array, raws: pa.Array, cleans: pa.Array) -> pa.Array:
        from pairloom.operators.terms import compare_batch

        return compare_batch(packed, langs, raws, cleans)

    return compared


_kept: tuple[bytes, Lexicon] | None = None


def compare_batch(packed: bytes, langs: pa.Array, raws: pa.Array, cleans: pa.Array) -> pa.Array:
    """The comparison of every row, null where the language has no terms; the last lexicon stays compiled."""
    global _kept
    if _kept is None or _kept[0] != packed:
        _kept = packed, Lexicon(*pickle.loads(packed))
    lexicon = _kept[1]
    found = (
        lexicon.compare(lang.as_py(), raw.as_py() or "", clean.as_py() or "") if lang.as_py() in lexicon.finders else None
        for lang, raw, clean in zip(langs, raws, cleans)
    )
    return pa.array(list(found), _FOUND)


def term_loss(df: DataFrame, key: str, lexicon: DataFrame, unspaced: Sequence[str] = ("zh",)) -> DataFrame:
    """``key, lang, kind, n_raw, n_clean, lost`` for pairs where a term of the lexicon occurs; ``key`` is unique.

    ``lexicon`` is ``lang, kind, term``: terms in lower case; repeated rows count once, rows with a null or an
    empty term not at all. A term counts where it stands as a whole word (or words); in languages that put no
    spaces between words (``unspaced``) wherever it occurs, without overlap with itself. ``lost`` counts term by
    term: one term's surplus does not make up for another's loss.

    Texts are read where they lie and no word of them is shuffled. Only of a lexicon in several parts the counts
    are added up by pair.
    """
    ship_package(df.sparkSession)
    listed = lexicon.select("lang", "kind", "term").where("term <> '' and lang is not null and kind is not null").distinct()
    size = listed.agg(F.sum(F.octet_length("term") + F.octet_length("kind") + 32)).first()[0] or 0
    parts = max(1, -(-size // LEXICON_BYTES))
    part = F.pmod(F.xxhash64("lang", "term"), F.lit(parts))
    found = None
    for number in range(parts):
        rows = sorted(tuple(r) for r in listed.where(part == number).collect())
        one = _found(df, key, rows, unspaced)
        found = one if found is None else found.unionByName(one)
    if parts == 1:
        return found
    sums = [F.sum(c).alias(c) for c in ("n_raw", "n_clean", "lost")]
    return found.groupBy(key, "lang", "kind").agg(*sums)


def _found(df: DataFrame, key: str, rows: list[tuple[str, str, str]], unspaced: Sequence[str]) -> DataFrame:
    listed = F.col("lang").isin(sorted({r[0] for r in rows})) if rows else F.lit(False)

    def wanted(column: str) -> Column:
        return F.when(listed, F.lower(column))  # other rows send no text

    found = _compare(rows, unspaced)(F.when(listed, F.col("lang")), wanted("raw"), wanted("clean"))
    return df.select(key, "lang", F.inline(found))
