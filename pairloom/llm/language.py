"""Language identification by compression.

Each language has a zstandard raw-content dictionary: real text of that language. A text is compressed once
with every dictionary; the language whose dictionary gives the fewest bytes is chosen. Texts and dictionaries are in lower case with only
letters and line ends, so that case, digits and symbols count for no language. Texts are compressed in blocks, so that every part of a long text meets the dictionary and not only its beginning.

The score is the chosen language's share under the code lengths: 1 / sum of 2^(-8 * extra bytes). A choice is
`rejected` if the runner-up needs less than MARGIN more bytes per byte of the best, or if nothing was chosen.
Null texts and texts without any letter are `und` with score 0. Equal sizes go to the language with more
learned rows, then to the first in sorted order. Rows are kept one for one with all their columns.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import give_back, let, with_workers, worker_table

#: Bytes of learned text per language, and labelled rows looked at for them: the bounds of the sample.
DICTIONARY_BYTES = 96 * 1024
SAMPLE_ROWS = 200
#: Of texts of more bytes the sample takes its start, middle and end, so that one text cannot fill a dictionary.
SAMPLE_TEXT_BYTES = 8 * 1024
#: Bytes of all dictionaries; with more languages than fill it each dictionary is smaller, to LEAST_BYTES.
ALL_BYTES = 64 * DICTIONARY_BYTES
LEAST_BYTES = 2 * 1024
BLOCK = 4 * 1024
LEVEL = 6
MARGIN = 0.002
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_NO_LETTERS = regex.compile(r"[^\p{L}\n]+")


def normal(text: str) -> str:
    """``text`` in lower case, its runs of anything but letters and line ends as one blank."""
    return _NO_LETTERS.sub(" ", text.lower())


def _pieces(text: Column) -> Column:
    """``text`` alone; of one over SAMPLE_TEXT_BYTES start, middle and end of its letters."""
    letters = F.regexp_replace(F.regexp_replace(text, r"[^\p{L}\n]++", " "), r" ?\n[ \n]*+", "\n")
    size = F.lit(SAMPLE_TEXT_BYTES // 3)

    def cut(body: Column) -> Column:
        n = F.char_length(body)
        starts = (F.lit(1), F.floor((n - size) / 2).cast("int"), n - size + 1)
        return F.array(*[F.substring(body, F.greatest(F.lit(1), start), size) for start in starts])

    return F.when(F.octet_length(text) <= SAMPLE_TEXT_BYTES, F.array(text)).otherwise(let(letters, cut))


def _piece(text: str) -> str:
    """At most SAMPLE_TEXT_BYTES / 3 bytes of ``text``."""
    return text.encode()[: SAMPLE_TEXT_BYTES // 3].decode(errors="ignore")


def learn(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """A dictionary per language from a bounded sample of ``labelled``, the most frequent language first.

    The sample takes the rows whose hash lies under a limit set by the language's row count, about SAMPLE_ROWS
    rows a language and one at least, so it is the same for any partitioning; equal rows count as one. Every
    language with a letter in its sample is learned. Rows with a null in any of the three columns, or without any
    letter, are not learned from.
    """
    rows = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(F.col("key").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("place", F.pmod(F.xxhash64("key", "text"), F.lit(1 << 40)))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("least")).collect()
    if not sizes:
        return {}
    sizes.sort(key=lambda r: (-r["n"], r["lang"]))
    limits = [(r["lang"], max(r["least"] + 1, -(-(SAMPLE_ROWS << 40) // r["n"]))) for r in sizes]
    limits = labelled.sparkSession.createDataFrame(limits, "lang string, below bigint")
    sample = rows.join(F.broadcast(limits), "lang").where(F.col("place") < F.col("below"))
    sample = sample.select("lang", "place", "key", _pieces(F.col("text")).alias("pieces")).distinct()
    most = min(DICTIONARY_BYTES, max(LEAST_BYTES, ALL_BYTES // len(sizes)))
    bodies: dict[str, dict[bytes, None]] = {r["lang"]: {} for r in sizes}
    filled = dict.fromkeys(bodies, 0)
    for row in sample.orderBy("lang", "place", "key", "pieces").toLocalIterator():
        pieces = row["pieces"] if len(row["pieces"]) == 1 else map(_piece, row["pieces"])
        body = normal("\n".join(pieces)).encode()
        if filled[row["lang"]] < most and body not in bodies[row["lang"]] and not body.isspace():
            bodies[row["lang"]][body] = None
            filled[row["lang"]] += len(body) + 1
    learned = {name: b"\n".join(parts)[:most] for name, parts in bodies.items() if parts}
    # the library asks for 8 bytes
    return {name: body if len(body) >= 8 else b"\n".join([body] * 8) for name, body in learned.items()}


def _compressors(learned: tuple[tuple[str, bytes], ...]) -> list[zstandard.ZstdCompressor]:
    out = []
    for _, body in learned:
        content = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(level=LEVEL)
        out.append(
            zstandard.ZstdCompressor(
                dict_data=content, write_checksum=False, write_content_size=False, write_dict_id=False
            )
        )
    return out


def code_lengths(text: bytes, compressors: list[zstandard.ZstdCompressor]) -> np.ndarray:
    """Compressed bytes of ``text`` under each dictionary, summed over its blocks."""
    blocks = [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)]
    return np.array([sum(len(c.compress(b)) for b in blocks) for c in compressors], np.int64)


def identify_batch(texts: pa.Array, learned: tuple[tuple[str, bytes], ...]) -> pa.Array:
    names, compressors = [name for name, _ in learned], worker_table("language", _compressors, learned)
    lang, score, margin, rejected = [], [], [], []
    for text in texts.to_pylist():
        if not names or not text or not _LETTER.search(text):
            lang.append(UNKNOWN), score.append(0.0), margin.append(0.0), rejected.append(True)
            continue
        sizes = code_lengths(normal(text).encode(), compressors)
        best = int(sizes.argmin())
        others = np.delete(sizes, best)
        gap = (int(others.min()) - int(sizes[best])) / int(sizes[best]) if len(others) else 1.0
        lang.append(names[best])
        score.append(float(1 / np.exp2(-8.0 * np.minimum(sizes - sizes[best], 100)).sum()))
        margin.append(gap)
        rejected.append(gap < MARGIN)
    give_back()
    return pa.StructArray.from_arrays(
        [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(margin, pa.float64()),
         pa.array(rejected, pa.bool_())],
        ["lang_pred", "score", "margin", "rejected"],
    )


def identify(df: DataFrame, text: Column, learned: dict[str, bytes]) -> Column:
    """A struct of lang_pred, score, margin and rejected for ``text``; the dictionaries go to the workers."""
    with_workers(df)
    fixed = tuple(learned.items())

    @F.arrow_udf("lang_pred string, score double, margin double, rejected boolean")
    def chosen(texts: pa.Array) -> pa.Array:
        return identify_batch(texts, fixed)

    return chosen(text)
