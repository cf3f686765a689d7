"""Sharding by vector bin packing: rows, bytes and tokens are balanced together.

Equal texts form a group that stays together. Groups above 1/LARGE of a shard (in rows or in bytes) are few, however
large the table is; they are packed first, over the whole table: the largest first, each into the shard where
the dot product of its sizes with the shard's residual capacity is highest among those it fits into. Only a group
that fits nowhere and is above 1/PIECES of a shard is cut, into pieces of that size, so that a text with a third of
all rows fills no shard.

All other groups are dealt by hash to zones of about ZONE_ROWS rows, and so are the rows of the large ones, each on
its own. A zone packs its groups by the same rule, into what its rows of large groups leave of its shards, so every
zone is balanced, and the sum is; no task sees more than a zone. A last pass over the zone moves small groups until
bytes are near equal (`bytes` is the law), choosing among them those that bring rows and tokens nearer, too.

Slots number the rows of a shard without gaps: zones by number, within a zone by order of the rows. The row
table (without texts) is written once, so repeated tasks see the same rows. Null texts are groups of empty text
of size 8 like empty ones; null and repeated ids are rows like others. An empty table has no rows in any shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.shared import with_workers, written

SHARDS = 24
ROW_BYTES = 8
ZONE_ROWS = 40_000
#: A group above 1/LARGE of a shard is packed before the others: of 24 shards, 4,800 groups at most.
LARGE = 100
#: No group up to 1/PIECES of a shard is cut.
PIECES = 10
#: Zones at most; beyond it zones grow.
MOST_ZONES = 16_384
#: Groups of about the right size that are compared by rows and tokens before one is moved.
NEAR = 16
#: Dimensions of a group's size.
ROWS, BYTES, TOKENS = range(3)


def token_estimate(text: Column) -> Column:
    """Runs of characters that are not blanks: a cheap stand-in where no token counts are at hand."""
    return F.regexp_count(text, F.lit(r"[^ \n]++")).cast("long")


def place(items: np.ndarray, shards: int, load: np.ndarray | None = None) -> np.ndarray:
    """A shard for each row of ``items`` (sizes by dimension), by dot products with the residual capacity.

    ``load`` is what the shards hold already. An item goes to a shard it fits into, if there is one.
    """
    load = np.zeros((shards, items.shape[1])) if load is None else load
    scale = _scale(items, shards, load)
    sizes, residual = items / scale, 1 - load / scale
    out = np.empty(len(items), np.int64)
    for i in _largest_first(sizes):
        out[i] = _best(sizes[i], residual)[0]
        residual[out[i]] -= sizes[i]
    return out


def _scale(items: np.ndarray, shards: int, load: np.ndarray) -> np.ndarray:
    total = items.sum(0) + load.sum(0)
    return np.where(total > 0, total / shards, 1.0)


def _largest_first(sizes: np.ndarray) -> np.ndarray:
    return np.argsort(-sizes.max(1, initial=0), kind="stable")


def _best(size: np.ndarray, residual: np.ndarray) -> tuple[int, bool]:
    """The shard with the highest dot product, of those with room if there are any, and whether it has room."""
    gain = residual @ size
    fits = (residual >= size).all(1)
    if fits.any():
        return int(np.where(fits, gain, -np.inf).argmax()), True
    return int(gain.argmax()), False


def place_large(items: np.ndarray, totals: np.ndarray, shards: int) -> list[list[int]]:
    """The shards of each large group: one, or one per piece; ``totals`` are the sizes of the whole table.

    Groups that were not cut and pieces are evened out as a zone's groups are.
    """
    scale = np.where(totals > 0, totals / shards, 1.0)
    sizes, residual = items / scale, np.ones((shards, len(totals)))
    out: list[list[int]] = [[] for _ in items]
    for i in _largest_first(sizes):
        shard, fits = _best(sizes[i], residual)
        whole = fits or items[i][ROWS] < 2 or sizes[i][: BYTES + 1].max() <= 1 / PIECES
        parts = 1 if whole else min(int(items[i][ROWS]), int(np.ceil(sizes[i][: BYTES + 1].max() * PIECES)))
        for _ in range(parts):
            shard = _best(sizes[i] / parts, residual)[0]
            residual[shard] -= sizes[i] / parts
            out[i].append(shard)
    owner = np.repeat(np.arange(len(out)), [len(x) for x in out])
    if len(owner):
        pieces = (items / np.array([[len(x)] for x in out]))[owner]
        evened = even_out(pieces, np.concatenate([np.array(x) for x in out]), np.zeros((shards, len(totals))))
        out = [part.tolist() for part in np.split(evened, np.cumsum([len(x) for x in out])[:-1])]
    return out


def even_out(items: np.ndarray, shard: np.ndarray, load: np.ndarray, rounds: int = 4000) -> np.ndarray:
    """Moves single items from the shard with the most bytes to the one with the least while that brings the two
    nearer. Of the items of about the right size it takes the one after which they are nearest in all dimensions.

    ``load`` is what the shards hold besides the items.
    """
    shards, shard = len(load), shard.copy()
    load = load.astype(np.int64).copy()
    np.add.at(load, shard, items.astype(np.int64))
    scale = np.maximum(load.sum(0) / shards, 1)
    size = items[:, BYTES].astype(np.int64)
    order = np.argsort(size, kind="stable")
    for _ in range(rounds):
        high, low = int(load[:, BYTES].argmax()), int(load[:, BYTES].argmin())
        mine = order[shard[order] == high]
        gap = load[high] - load[low]
        at = int(np.searchsorted(size[mine], gap[BYTES] / 2))
        near = mine[max(at - NEAR // 2, 0) : at + NEAR // 2]
        left = np.abs(gap - 2 * items[near].astype(np.int64)) / scale
        better = left[:, BYTES] * scale[BYTES] < gap[BYTES]
        near, left = near[better], left[better]
        if not len(near):
            break
        # bytes come first: rows and tokens decide among items that leave nearly the same gap of bytes
        close = left[:, BYTES] <= left[:, BYTES].min() + 1e-3
        pick = near[close][left[close].sum(1).argmin()]
        shard[pick] = low
        load[high] -= items[pick].astype(np.int64)
        load[low] += items[pick].astype(np.int64)
    return shard


def pack(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shards: int = SHARDS,
         tokens: Column | None = None) -> DataFrame:
    """Every row as `id`, size, text_crc32, shard and slot."""
    with_workers(docs)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = written(
        docs.select(
            F.col(id_col).alias("id"), (F.octet_length(body) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"), (token_estimate(body) if tokens is None else tokens).alias("tokens"),
            F.md5(body).alias("group"), F.monotonically_increasing_id().alias("row"),
        ), "rows",
    )
    sizes = [F.count(F.lit(1)).alias("copies"), F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens")]
    totals = rows.agg(*sizes).first()
    n = totals["copies"]
    zones = min(MOST_ZONES, max(1, -(-n // ZONE_ROWS)))
    rows = rows.join(F.broadcast(_large(rows, sizes, totals, shards)), "group", "left")
    preset = F.element_at("shards", (F.pmod(F.xxhash64("row"), F.size("shards")) + 1).cast("int"))
    rows = rows.withColumn("preset", F.when(F.col("shards").isNotNull(), preset))
    dealt = F.when(F.col("preset").isNull(), F.xxhash64("group")).otherwise(F.xxhash64("row", F.lit("zone")))
    rows = rows.withColumn("zone", F.pmod(dealt, F.lit(zones)).cast("int"))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("row", kind="stable")
        zone = int(frame["zone"].iat[0])
        # zones start at different shards, so what a zone cannot even out does not add up in the first ones
        preset = frame["preset"].fillna(-1).to_numpy().astype(np.int64)
        fixed = preset >= 0
        vectors = np.stack([np.ones(len(frame), np.int64), frame["size"].to_numpy(), frame["tokens"].to_numpy()], 1)
        load = np.zeros((shards, 3), np.int64)
        np.add.at(load, (preset[fixed] - zone) % shards, vectors[fixed])
        group, names = pd.factorize(frame["group"].to_numpy()[~fixed], sort=True)
        items = np.zeros((len(names), 3), np.int64)
        np.add.at(items, group, vectors[~fixed])
        shard = np.where(fixed, preset, 0)
        if len(items):
            found = even_out(items, place(items, shards, load), load)
            shard[~fixed] = (found[group] + zone) % shards
        out = frame[["id", "size", "text_crc32", "zone"]].copy()
        out["shard"] = shard.astype(np.int32)
        out["turn"] = out.groupby("shard").cumcount().astype(np.int64)
        return out

    kind = docs.schema[id_col].dataType.simpleString()
    packed = rows.select("id", "size", "text_crc32", "tokens", "group", "row", "preset", "zone")
    packed = packed.repartition(zones, "zone").groupBy("zone").applyInPandas(
        run, f"id {kind}, size bigint, text_crc32 bigint, zone int, shard int, turn bigint"
    )
    packed = written(packed, "packed")
    counts = packed.groupBy("zone", "shard").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("zone").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("zone", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    # at most MOST_ZONES * shards rows of 16 bytes
    return packed.join(F.broadcast(offsets), ["zone", "shard"]).select(
        "id", "size", "text_crc32", "shard", (F.col("offset") + F.col("turn")).alias("slot")
    )


def _large(rows: DataFrame, sizes: list[Column], totals, shards: int) -> DataFrame:
    """`group` and `shards` of the large groups: 2 * shards * LARGE rows at most, with PIECES * 2 * shards pieces more."""
    spark, n = rows.sparkSession, totals["copies"]
    limits = [(totals[c] or 0) / shards / LARGE for c in ("copies", "bytes")]
    large = rows.groupBy("group").agg(*sizes).where(
        (F.col("copies") > 1) & ((F.col("copies") > limits[0]) | (F.col("bytes") > limits[1]))
    ) if n else None
    found = large.orderBy("group").collect() if n else []
    items = np.array([(r["copies"], r["bytes"], r["tokens"]) for r in found], np.float64).reshape(-1, 3)
    totalled = np.array([n, totals["bytes"] or 0, totals["tokens"] or 0], np.float64)
    placed = [(r["group"], s) for r, s in zip(found, place_large(items, totalled, shards))]
    return spark.createDataFrame(placed, "group string, shards array<int>")
