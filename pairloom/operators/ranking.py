"""Exact ranks in a seeded random order, without sorting the table in one task.

The order is that of ``md5(seed:key)``: a fixed function of the row, so it does not depend on
partitioning and a lost executor recomputes the same. A short prefix of the hash makes buckets of
nearly equal size; a count per bucket places each of them in the whole order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGITS = 4  # hexadecimal digits of a bucket: at most 65,536 buckets
#: Zones at most: their borders, 32 characters each, stay under 64 MB.
MAX_ZONES = 1 << 20


def shuffle_key(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def _keyed(df: DataFrame, key: str, seed: int, digits: int) -> DataFrame:
    return df.withColumn("_k", shuffle_key(key, seed)).withColumn("_bucket", F.substring("_k", 1, digits))


def bucket_offsets(keyed: DataFrame) -> DataFrame:
    """Rows before each bucket, rows up to its end, and rows in all.

    The windows see one row per bucket, 16**digits at most, whatever the size of the table.
    """
    order = Window.orderBy("_bucket")
    counts = keyed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    return counts.select(
        "_bucket",
        (F.sum("_size").over(order) - F.col("_size")).alias("_before"),
        F.sum("_size").over(order).alias("_end"),
        F.sum("_size").over(Window.partitionBy()).alias("_total"),
    )


def zoned_rank(
    df: DataFrame, key: str, seed: int, name: str = "rank", unit: int = 1, digits: int = DIGITS
) -> DataFrame:
    """Add the 1-based rank in the seeded order, and ``zone``. ``key`` must be unique.

    Zones are runs of the order, all of the same size, a multiple of ``unit``; no run of ``unit``
    ranks crosses a border. There are at most ``MAX_ZONES``, so their borders fit a broadcast. The
    borders are found from the keys alone; the rows are shuffled once, by zone, and what follows
    per zone or per run inside a zone needs no further shuffle.
    """
    keyed = _keyed(df, key, seed, digits)
    # the smallest multiple of the unit that makes no more zones than allowed
    size = F.expr(f"{unit}L * greatest(1L, cast(ceil(_total / ({unit}L * {MAX_ZONES}L)) as bigint))")
    placed = bucket_offsets(keyed).withColumn("_zone_rows", size)
    crossed = placed.filter("_before div _zone_rows < (_end - 1) div _zone_rows or _end % _zone_rows = 0")
    inside = Window.partitionBy("_bucket").orderBy("_k", key)
    borders = (
        keyed.select(key, "_k", "_bucket")
        .join(F.broadcast(crossed.select("_bucket", "_before", "_zone_rows")), "_bucket")
        .withColumn("_rank", F.col("_before") + F.row_number().over(inside))
        .filter("_rank % _zone_rows = 0")
        .groupBy("_bucket")
        .agg(F.collect_list("_k").alias("_borders"))
    )
    table = placed.join(borders, "_bucket", "left").select(
        "_bucket", "_zone_rows", F.expr("_before div _zone_rows").alias("_first_zone"), "_borders"
    )
    passed = F.coalesce(F.size(F.filter("_borders", lambda border: border < F.col("_k"))), F.lit(0))
    zoned = keyed.join(F.broadcast(table), "_bucket").withColumn(
        "zone", F.col("_first_zone") + F.when(F.col("_borders").isNull(), 0).otherwise(passed)
    )
    place = F.row_number().over(Window.partitionBy("zone").orderBy("_k", key))
    return zoned.withColumn(name, F.col("zone") * F.col("_zone_rows") + place).drop(
        "_k", "_bucket", "_zone_rows", "_first_zone", "_borders"
    )


def first_rows(df: DataFrame, key: str, seed: int, k: int, digits: int = DIGITS) -> DataFrame:
    """Add ``rank`` and keep the rows ranked 1 to ``k``. Rows with equal keys follow in the order of a hash of
    the whole row.

    The rows are cut out by hashes before any of them is sorted, so at most ``k`` rows are sorted, also where
    a third of the table shares one key: first by the hash of the key, then, of the rows with the hash at the
    edge, by the hash of the row. Rows equal in that, too, are copies, of which any will do.
    """
    keyed = _keyed(df, key, seed, digits)
    chosen, taken = _cut_out(keyed, "_k", k, digits)
    edge, missing = taken
    if missing:
        same = keyed.where(F.col("_k") == edge).withColumn("_row", F.md5(F.to_json(F.struct(*df.columns))))
        inside, (last, more) = _cut_out(same, "_row", missing, digits)
        chosen = chosen.unionByName(inside.drop("_row"))
        if more:
            chosen = chosen.unionByName(same.where(F.col("_row") == last).drop("_row").limit(more))
    offsets = bucket_offsets(chosen).select("_bucket", "_before")
    whole = F.md5(F.to_json(F.struct(*df.columns)))
    inside = Window.partitionBy("_bucket").orderBy("_k", key, whole)
    ranked = chosen.join(F.broadcast(offsets), "_bucket").withColumn(
        "rank", F.col("_before") + F.row_number().over(inside)
    )
    return ranked.drop("_k", "_bucket", "_before")


def _cut_out(df: DataFrame, hashes: str, k: int, digits: int) -> tuple[DataFrame, tuple[str, int]]:
    """The rows with the least hashes, whole groups of equal ones, ``k`` at most; the next hash, and how many of
    its rows are missing to ``k`` (0 if none are).

    Rows are only counted, by a prefix of the hash and then by the hash inside the bucket where ``k`` falls.
    """
    bucketed = df.select(F.col(hashes).alias("_h"), F.substring(hashes, 1, digits).alias("_bucket"))
    placed = bucket_offsets(bucketed).where((F.col("_before") < k) & (F.col("_end") >= k)).first()
    if placed is None:  # fewer rows than asked for, or none asked for
        return (df, ("", 0)) if k > 0 else (df.where(F.lit(False)), ("", 0))
    groups = bucketed.where(F.col("_bucket") == placed["_bucket"]).groupBy("_h").agg(F.count("*").alias("_n"))
    # one row per hash of one bucket of 16**digits
    upto = groups.withColumn("_upto", placed["_before"] + F.sum("_n").over(Window.orderBy("_h")))
    row = upto.where(F.col("_upto") >= k).orderBy("_h").first()
    before = row["_upto"] - row["_n"]
    if row["_upto"] == k:
        return df.where(F.col(hashes) <= row["_h"]), ("", 0)
    return df.where(F.col(hashes) < row["_h"]), (row["_h"], k - before)


def cut_keys(keyed: DataFrame, targets: dict[str, Column], digits: int = DIGITS) -> DataFrame:
    """One row with a hash per target: the rows up to it are as near to the target as whole groups allow.

    ``keyed`` has the hash as ``_k``; each target is a row count, given as an expression over ``_total``.
    Rows with equal keys are on one side of a cut, so the cut lies at the border of two groups: the one
    nearest to the target, the lower of two equally near. With a unique key the counts are exact. Where
    there are two groups, a target above zero gets one at least, and one below the total leaves one.

    Only the hash is read. Passes: rows per bucket, rows per hash in the buckets where the targets fall,
    the least and largest hash. All count before they shuffle, so a hash shared by a third of all rows
    arrives as one row per task.
    """
    keyed = keyed.select("_k", F.substring("_k", 1, digits).alias("_bucket"))
    placed = bucket_offsets(keyed).withColumns(
        {f"_to_{name}": F.least(count.cast("bigint"), F.col("_total")) for name, count in targets.items()}
    )
    holds = F.lit(False)
    for name in targets:
        holds = holds | ((F.col("_before") < F.col(f"_to_{name}")) & (F.col(f"_to_{name}") <= F.col("_end")))
    carried = ["_before", "_total", *(f"_to_{name}" for name in targets)]
    edge = placed.filter(holds).select("_bucket", *carried)  # at most one bucket per target
    hashes = (
        keyed.join(F.broadcast(edge), "_bucket")
        .groupBy("_bucket", "_k")
        .agg(F.count("*").alias("_copies"), *[F.max(c).alias(c) for c in carried])
    )
    inside = Window.partitionBy("_bucket").orderBy("_k")
    running = hashes.withColumn("_upto", F.col("_before") + F.sum("_copies").over(inside))
    found = []
    for name in targets:
        count, here = F.col(f"_to_{name}"), F.struct(F.col("_upto").alias("n"), F.col("_k").alias("k"))
        # a bucket that starts below the target: its prefix sorts above all earlier hashes
        floor = F.struct(F.col("_before").alias("n"), F.col("_bucket").alias("k"))
        found += [
            F.greatest(F.max(F.when(F.col("_upto") <= count, here)), F.max(F.when(F.col("_before") < count, floor))).alias(f"_low_{name}"),
            F.min(F.when(F.col("_upto") >= count, here)).alias(f"_high_{name}"),
            F.max(count).alias(f"_to_{name}"),
        ]
    ends = keyed.agg(F.min("_k").alias("_first"), F.max("_k").alias("_last"))
    row = running.agg(F.max("_total").alias("_total"), *found).crossJoin(F.broadcast(ends))  # one row each
    # just below the last hash, above all others
    under = F.concat(F.expr("left(_last, length(_last) - 1)"), F.chr(F.ascii(F.right("_last", F.lit(1))) - 1), F.lit("g"))
    cuts = []
    for name in targets:
        low, high, count = (F.col(f"_{part}_{name}") for part in ("low", "high", "to"))
        nearest = F.when(count - low["n"] <= high["n"] - count, low).otherwise(high)
        several = F.col("_first") != F.col("_last")
        cuts.append(
            F.when(several & (nearest["n"] == 0), F.col("_first"))
            .when(several & (nearest["n"] == F.col("_total")) & (count < F.col("_total")), under)
            .otherwise(nearest["k"]).alias(name)
        )
    return row.select(*cuts)
