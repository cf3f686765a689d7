"""Benchmark passages in documents: a prefix-filtered set join.

An item's windows are its runs of WINDOW words; an item of fewer words is one window. A document is hit where
one of them occurs word for word. Windows are sets of shingles (runs of SHINGLE words, or all words of a
shorter window). For a window to occur, every shingle of it has to, so one is a sufficient prefix: the rarest
by the number of places it has in all documents. Documents are joined with these prefixes on the shingle's
hash; the window must start in the document (positional bound) and end in it (length bound); then its words
are compared with the document's words at that place.

Document shingles are kept only where a byte map of the benchmark's shingle hashes says that they may matter.
The map is a filter without an effect on the result: if a benchmark outgrows it, more shingles pass to the
join.

A-Z count as a-z; words are runs of ASCII letters, digits and all characters beyond ASCII. Null and empty texts
have no words and are never hit; items with a null id, no text or no words have no windows. Equal texts are
worked on once; every row gets its result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import ascii_lower, let, written

WINDOW = 10
SHINGLE = 5
#: Slots of the byte map for each shingle of the benchmark, and at most: 4 MB in the plan, whose text the driver
#: writes out. Four places a shingle in so few slots let fewer others pass than one place in 256 slots did.
SLOTS_EACH = 16
MAP_SLOTS = 1 << 22
PROBES = 4
#: Windows that are sent to every executor at most, about 300 bytes each: 60 MB. More are joined by a shuffle.
BROADCAST_WINDOWS = 200_000

# What parts words.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of lower-cased text, in order."""
    bare = F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), f"^{GAPS}|{GAPS}$", "")
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, GAPS))


def _hash(words: Column, start: Column, width: int) -> Column:
    """Hash of ``width`` words from the 0-based ``start``."""
    return F.xxhash64(*[F.get(words, start + k) for k in range(width)])


def windows_of(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct windows: `window` (words), `size`, `items` (ids as strings, sorted)."""
    rows = items.select(F.col(item).cast("string").alias("item"), words_of(F.col(text)).alias("words"))
    rows = rows.where(F.col("item").isNotNull() & (F.size("words") > 0))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (WINDOW - 1), F.lit(1)))
    rows = rows.select("item", "words", F.explode(starts).alias("start"))
    rows = rows.select("item", F.slice("words", F.col("start"), F.lit(WINDOW)).alias("window"))
    return rows.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items")).withColumn(
        "size", F.size("window")
    )


def _shingles(windows: DataFrame, widths: list[int]) -> DataFrame:
    """`hash`, `width` and `offset` of every shingle of every window."""
    def placed(width: int) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.col("size") - width),
            lambda o: F.struct(
                _hash(F.col("window"), o, width).alias("hash"), F.lit(width).alias("width"), o.alias("offset")
            ),
        )

    per_width = [F.when(F.least("size", F.lit(SHINGLE)) == width, placed(width)) for width in widths]
    return windows.select("window", "size", "items", F.inline(F.coalesce(*per_width)))


def _slots(h: Column, slots: int, probes: int) -> Column:
    return F.array(*[F.pmod(F.shiftright(h, 16 * k), F.lit(slots)).cast("int") for k in range(probes)])


def _byte_map(shingles: DataFrame) -> tuple[bytes, int, int]:
    """The map, its slots, and how many of them every shingle sets."""
    n = shingles.select("hash").distinct().count()
    slots = 1024
    while slots < SLOTS_EACH * n and slots < MAP_SLOTS:
        slots *= 2
    probes = max(1, min(PROBES, 7 * slots // (10 * max(n, 1))))  # a full map passes fewest with fewer
    out = bytearray(slots)
    set_slots = shingles.select(F.explode(_slots(F.col("hash"), slots, probes)).alias("slot"))
    for (slot,) in set_slots.distinct().collect():  # MAP_SLOTS at most
        out[slot] = 1
    return bytes(out), slots, probes


def _places(words: Column, width: int, byte_map: bytes, slots: int, probes: int) -> Column:
    """0-based starts of the shingles that the byte map lets pass, with what the join needs of each."""
    n = F.size(words) - width

    def passes(h: Column) -> Column:
        # the map stands in the plan once
        return F.forall(_slots(h, slots, probes), lambda at: F.substring(F.lit(byte_map), at + 1, 1) == F.lit(b"\x01"))

    may = F.filter(
        F.when(n >= 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>")),
        lambda i: let(_hash(words, i, width), passes),
    )
    back = WINDOW - width
    return F.transform(
        may,
        lambda i: F.struct(
            _hash(words, i, width).alias("hash"), F.lit(width).alias("width"), i.alias("place"),
            F.greatest(i - back, F.lit(0)).alias("base"),
            F.slice(words, F.greatest(i - back, F.lit(0)) + 1, F.lit(2 * WINDOW - width)).alias("around"),
        ),
    )


def contamination(docs: DataFrame, items: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """For every row of ``docs``: the columns ``keep``, and n_words, n_hit, n_items, items, digest, contaminated.

    `items` holds the ids (as strings, sorted) of items with a window in the text; `digest` is the SHA-256 of
    the text where it is contaminated, else null.
    """
    windows = written(windows_of(items), "windows")
    n_windows = windows.count()
    widths = [r[0] for r in windows.select(F.least("size", F.lit(SHINGLE))).distinct().collect()]  # SHINGLE at most
    kept = [F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)]
    named = [F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)]
    rows = docs.select(*kept, F.col(text).alias("text"), words_of(F.col(text)).alias("words"))
    n_words = F.size("words").cast("long").alias("n_words")
    none = F.array().cast("array<string>")
    if not n_windows:
        zero = F.lit(0).cast("long")
        return rows.select(
            *named, n_words, zero.alias("n_hit"), zero.alias("n_items"), none.alias("items"),
            F.lit(None).cast("string").alias("digest"), F.lit(False).alias("contaminated"),
        )
    shingles = written(_shingles(windows, sorted(widths)), "shingles")
    byte_map, slots, probes = _byte_map(shingles)
    places = F.concat(*[_places(F.col("words"), w, byte_map, slots, probes) for w in sorted(widths)])
    rows = rows.select(*[f"kept_{i}" for i in range(len(keep))], n_words, "text", places.alias("places"))
    digest = F.when(F.size("places") > 0, F.sha2("text", 256)).alias("digest")
    rows = written(rows.select("*", digest).drop("text"), "places")

    texts = rows.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.first("n_words").alias("n_words"), F.first("places").alias("places")
    )
    texts = written(texts.select("digest", "n_words", F.inline("places")), "texts")
    counts = texts.groupBy("hash", "width").agg(F.count(F.lit(1)).alias("n"))
    ranked = shingles.join(counts, ["hash", "width"], "left").groupBy("window", "size", "items").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "hash", "width", "offset")).alias("rarest")
    )
    prefixes = ranked.where(F.col("rarest.n") > 0).select(
        "rarest.hash", "rarest.width", "rarest.offset", "window", "size", "items"
    )
    if n_windows <= BROADCAST_WINDOWS:
        prefixes = F.broadcast(prefixes)
    start = F.col("place") - F.col("offset")
    found = (
        texts.join(prefixes, ["hash", "width"])
        .where((start >= 0) & (start + F.col("size") <= F.col("n_words")))
        .where(F.slice("around", start - F.col("base") + 1, F.col("size")) == F.col("window"))
        .select("digest", start.alias("start"), "size", "items")
    )
    per_text = found.groupBy("digest").agg(
        F.collect_set(F.struct("start", "size")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    covered = F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["size"] - 1)))
    per_text = per_text.select(
        F.col("digest").alias("hit_digest"), F.size(F.array_distinct(covered)).cast("long").alias("hits"),
        F.col("items").alias("hit_items"),
    )
    # rows that cannot be hit have keys of their own, so that nulls do not meet in one task
    key = F.coalesce("digest", F.concat(F.lit("-"), F.xxhash64(*[f"kept_{i}" for i in range(len(keep))], "n_words")))
    joined = rows.drop("places").join(per_text, key == F.col("hit_digest"), "left")
    hits = F.coalesce("hits", F.lit(0)).cast("long")
    return joined.select(
        *named, "n_words", hits.alias("n_hit"),
        F.when(F.col("hit_items").isNull(), 0).otherwise(F.size("hit_items")).cast("long").alias("n_items"),
        F.coalesce("hit_items", none).alias("items"), F.col("hit_digest").alias("digest"),
        (hits > 0).alias("contaminated"),
    )


#: Digests that are sent to every executor at most: 64 MB.
BROADCAST_DIGESTS = 500_000


def without_contaminated(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text holds a window of an item."""
    bad = contamination(docs, items, [], text).where("contaminated").select("digest").distinct()
    bad = written(bad.withColumnRenamed("digest", "bad_digest"), "contaminated")
    if bad.count() <= BROADCAST_DIGESTS:
        bad = F.broadcast(bad)
    return docs.join(bad, F.sha2(F.coalesce(F.col(text), F.lit("")), 256) == F.col("bad_digest"), "left_anti")
