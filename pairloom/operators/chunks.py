"""Cutting pairs into chunks that fit the budgets, at places where both texts match."""

from __future__ import annotations

from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.config import MAX_INPUT, MAX_TARGET
from pairloom.functions.align import matched_lines
from pairloom.functions.text import prefixed
from pairloom.operators.tokenizers import ByteTokenizer, count_batch, worker_object
from pairloom.session import ready_workers

CHUNKS = pa.list_(pa.struct([("status", pa.string()), ("raw", pa.string()), ("clean", pa.string())]))
CHUNKS_DDL = "array<struct<status: string, raw: string, clean: string>>"


def chunk_pairs(
    df: DataFrame, key: str, max_input: int = MAX_INPUT, max_target: int = MAX_TARGET, tokenizer=ByteTokenizer()
) -> DataFrame:
    """``key, lang, chunk_no, status, raw, clean``: chunks of whole lines, as many as fit.

    A pair that fits both budgets is one ``ok`` chunk. Of others the lines of raw and clean are matched (see
    ``functions/align.py``); a chunk begins at a matched pair of lines, so lines that cleaning dropped or added
    stay with the matched line before them. ``ok`` chunks fit both budgets, with the language tag and the end
    marker counted in; what cannot be cut further is ``over_budget``. A pair without any matched lines stays
    whole, ``unaligned``; so does one with a null text or language, ``null``. Joining a pair's chunks with line
    feeds gives its texts back.

    All work is inside the row. The tokenizer is asked for whole batches: first for the lines, then for the
    chunks as they came out, as tokens need not add up over lines; a chunk that turns out too long is halved.
    """
    ready_workers(df.sparkSession)
    fits = (tokenizer.count(prefixed(F.col("lang"), F.col("raw"))) <= max_input) & (
        tokenizer.count(F.col("clean")) <= max_target
    )
    whole = df.select(key, "lang", "raw", "clean", fits.alias("_fits"))

    def stays(status: str) -> Column:
        return F.array(F.struct(F.lit(status).alias("status"), "raw", "clean"))

    cut = _cutter(tokenizer.worker(), max_input, max_target)
    # only pairs that need cutting go to the workers
    long = [F.when(~F.col("_fits"), F.col(c)) for c in ("lang", "raw", "clean")]
    missing = F.col("lang").isNull() | F.col("raw").isNull() | F.col("clean").isNull()
    chunks = F.when(missing, stays("null")).when(F.col("_fits"), stays("ok")).otherwise(cut(*long))
    return whole.select(key, "lang", F.posexplode(chunks).alias("chunk_no", "_chunk")).select(
        key, "lang", "chunk_no", "_chunk.status", "_chunk.raw", "_chunk.clean"
    )


def _cutter(factory: bytes, max_input: int, max_target: int):
    @F.arrow_udf(CHUNKS_DDL)
    def cut(langs: pa.Array, raws: pa.Array, cleans: pa.Array) -> pa.Array:
        from pairloom.operators.chunks import cut_batch

        return cut_batch(worker_object(factory), langs, raws, cleans, max_input, max_target)

    return cut


def cut_batch(
    library: Any, langs: pa.Array, raws: pa.Array, cleans: pa.Array, max_input: int, max_target: int
) -> pa.Array:
    """Chunks of every row, null where a side is null."""
    rows = list(zip(langs.to_pylist(), raws.to_pylist(), cleans.to_pylist()))
    pairs = [_Pair(*row) for row in rows if None not in row]
    tags = sorted({p.tag for p in pairs})
    tag_size = dict(zip(tags, count_batch(library, tags)))
    sizes = iter(count_batch(library, [line + "\n" for p in pairs for side in (p.raw, p.clean) for line in side]))
    for p in pairs:
        p.fold([next(sizes) for _ in p.raw], [next(sizes) for _ in p.clean], max_input - 1 - tag_size[p.tag], max_target - 1)
    open_pairs = pairs
    while open_pairs:
        fresh = [c for p in open_pairs for c in p.chunks if c not in p.fit]
        owners = [p for p in open_pairs for c in p.chunks if c not in p.fit]
        n_raw = count_batch(library, [p.tag + p.text(p.raw, c, 0) for p, c in zip(owners, fresh)])
        n_clean = count_batch(library, [p.text(p.clean, c, 1) for p, c in zip(owners, fresh)])
        for p, chunk, r, c in zip(owners, fresh, n_raw, n_clean):
            p.fit[chunk] = r < max_input and c < max_target  # the end marker is one more
        open_pairs = [p for p in open_pairs if p.halve()]
    done = iter(pairs)
    return pa.array([None if None in row else next(done).result() for row in rows], CHUNKS)


class _Pair:
    """A pair's lines, its units (runs of lines that must stay together), and its chunks (runs of units)."""

    def __init__(self, lang: str, raw: str, clean: str):
        self.tag = f"<{lang}> "
        self.raw, self.clean = raw.split("\n"), clean.split("\n")
        matched = matched_lines(self.raw, self.clean)
        #: first lines of the units on both sides, and the ends
        self.borders = [(0, 0), *matched[1:], (len(self.raw), len(self.clean))]
        self.aligned = bool(matched)
        self.chunks: list[tuple[int, int]] = []
        self.fit: dict[tuple[int, int], bool] = {}

    def text(self, lines: list[str], chunk: tuple[int, int], side: int) -> str:
        first, last = self.borders[chunk[0]][side], self.borders[chunk[1]][side]
        return "\n".join(lines[first:last])

    def fold(self, raw_sizes: list[int], clean_sizes: list[int], room_raw: int, room_clean: int) -> None:
        """Unit after unit goes to the chunk as long as their lines' tokens fit; the last line feed does not count."""
        first = r = c = 0
        for unit, ((i, j), (k, m)) in enumerate(zip(self.borders, self.borders[1:])):
            more_r, more_c = sum(raw_sizes[i:k]), sum(clean_sizes[j:m])
            if unit > first and (r + more_r - 1 > room_raw or c + more_c - 1 > room_clean):
                self.chunks.append((first, unit))
                first, r, c = unit, 0, 0
            r, c = r + more_r, c + more_c
        self.chunks.append((first, len(self.borders) - 1))

    def halve(self) -> bool:
        """Cut the chunks that do not fit, where they can be cut; whether there were any."""
        cut = [c for c in self.chunks if not self.fit[c] and c[1] - c[0] > 1]
        for chunk in cut:
            at = self.chunks.index(chunk)
            middle = (chunk[0] + chunk[1]) // 2
            self.chunks[at : at + 1] = [(chunk[0], middle), (middle, chunk[1])]
        return bool(cut)

    def result(self) -> list[dict[str, str]]:
        def status(chunk: tuple[int, int]) -> str:
            return "ok" if self.fit[chunk] else "over_budget" if self.aligned else "unaligned"

        return [
            {"status": status(c), "raw": self.text(self.raw, c, 0), "clean": self.text(self.clean, c, 1)} for c in self.chunks
        ]
