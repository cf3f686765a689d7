"""Near-duplicate texts: an exact Jaccard join of word-shingle sets that uses relations between sets.

1. Texts with equal shingle sets are one class. The rest works on classes, so copies cost nothing.
2. Shingles are counted over all classes and every set is ordered by rarity. Two sets can only reach the
   threshold if they share a shingle among the rarest ``n - ceil(t * n) + 1`` of each (prefix). A shingle that
   occurs in one class only joins nothing, so most sets drop out here. Counting runs on packed blocks of
   shingles, one block per batch of texts and hash range. Shingles of more than STOP_SHARE of the classes come
   last in the order and are not sent to the counting tasks, so no task gets a list that grows with the most
   frequent passage.
3. Each index list (the sets whose prefix holds a shingle) is answered from its leaders: members are compared
   with the leader only, and sets linked to one leader are in one component, with no pair among them formed.
4. Lists that still span several components are read again in blocks by set size: a set meets only blocks whose
   sizes can reach the threshold, and only entries whose positions (and, in long lists, whose whole prefixes)
   can. For such a pair the answers of both sets against the leader give bounds of their overlap (``ox + oy - n`` to ``min(ox, oy) + min(nx - ox, ny -
   oy)``); only where the bounds leave it open are the two sets fetched and compared.

No pair is lost and none is capped. Components follow from the links by label exchange in written rounds.

A text's set: its distinct runs of five words (ASCII white space parts them, A-Z count as a-z); a shorter, not
empty text is one run; null, empty and blank texts have an empty set and are alone. Shingles and sets are told
apart by 64-bit hashes. A row with a null id takes part and gets its component's id, null if no member has one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from pairloom.llm.shared import give_back, let_go, spare_name, with_workers, written
from pairloom.llm.shingles import mix, shingle_sets

#: The threshold as a percentage: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: A shingle in more than this share of the classes goes to the end of the order.
STOP_SHARE = 1 / 200
#: Shingles of one counting range and of one block of texts, about.
RANGE_TOKENS = 1_000_000
FLUSH_TOKENS = 500_000
#: Steps in which a counting range is worked through.
SUBRANGES = 4
#: Tasks of a counting step at most; beyond it a task works through several ranges, one after the other.
MOST_TASKS = 20_000
#: Stop shingles at most: 8 MB that go to every task. Where more are frequent, the most frequent ones are taken; of
#: T shingles in all, one that is left out then occurs T / MOST_STOPS times at most.
MOST_STOPS = 1_000_000

#: Lists of more members carry their prefixes into the second reading; the result does not depend on it.
LONG_LIST = 32

_LAST = np.int64(1) << 40  # count of a stop shingle, for the order


def _set_key(tokens: np.ndarray) -> int:
    """A 63-bit hash of a set of shingles."""
    with np.errstate(over="ignore"):
        total = mix(tokens).sum(dtype=np.uint64) ^ mix(np.array([len(tokens)], np.uint64))[0]
    return int(mix(np.array([total], np.uint64))[0] >> np.uint64(1))


def profiles(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """`id`, `digest` of the text, `n`, `key` (null if n is 0) of every row; `common`, on a few rows: a batch's
    frequent shingles."""
    with_workers(docs)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go("similar_sets")
        for batch in batches:
            sizes, keys, seen = [], [], {}
            for tokens in shingle_sets(batch.column(1)):
                sizes.append(len(tokens))
                keys.append(_set_key(tokens) if len(tokens) else None)
                if len(tokens):
                    seen[keys[-1]] = tokens
            common = [None] * len(sizes)
            if seen:
                tokens, counts = np.unique(np.concatenate(list(seen.values())), return_counts=True)
                often = counts >= max(2, len(seen) * STOP_SHARE / 2)
                common[0] = [
                    {"token": int(t), "count": int(c)} for t, c in zip(tokens[often].view(np.int64), counts[often])
                ]
            kinds = pa.list_(pa.struct([("token", pa.int64()), ("count", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()),
                 pa.array(common, kinds)],
                ["id", "digest", "n", "key", "common"],
            )
            del seen
            give_back()

    schema = f"id {kind}, digest binary, n bigint, key bigint, common array<struct<token bigint, count bigint>>"
    return docs.select(id_col, text, _digest(text).alias("digest")).mapInArrow(run, schema)


def _digest(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def _packed(tokens: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as differences, byte by byte place: the high places compress to nothing."""
    return np.diff(tokens, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


_BLOCK = pa.schema([
    ("part", pa.int64()), ("stop", pa.bool_()), ("tokens", pa.binary()), ("owners", pa.binary()),
    ("keys", pa.binary()), ("sizes", pa.binary()),
])
_BLOCK_DDL = "part bigint, stop boolean, tokens binary, owners binary, keys binary, sizes binary"


def _block(part: int, stop: bool, tokens: np.ndarray, owners: np.ndarray, keys: np.ndarray, sizes: np.ndarray) -> dict:
    used, own = np.unique(owners, return_inverse=True)
    narrow = np.uint16 if len(used) < 1 << 16 else np.uint32
    return {
        "part": part, "stop": stop, "tokens": _packed(tokens), "owners": own.astype(narrow).tobytes(),
        "keys": keys[used].tobytes(), "sizes": sizes[used].astype(np.uint32).tobytes(),
    }


def _open(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, and key and size of the set each belongs to."""
    tokens, keys = _unpacked(row["tokens"]), np.frombuffer(row["keys"], np.int64)
    own = np.frombuffer(row["owners"], np.uint16 if len(keys) < 1 << 16 else np.uint32)
    return tokens, keys[own], np.frombuffer(row["sizes"], np.uint32)[own].astype(np.int64)


def _blocks(docs: DataFrame, text: str, stops: np.ndarray, parts: int) -> DataFrame:
    """Shingles of all texts in packed blocks by hash range; stop shingles by set."""

    def flush(sets: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys = np.fromiter(sets, np.int64, len(sets))
        sizes = np.fromiter(map(len, sets.values()), np.int64, len(sets))
        tokens, owners = np.concatenate(list(sets.values())), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, owners = tokens[order], owners[order]
        is_stop = np.isin(tokens, stops, assume_unique=False) if len(stops) else np.zeros(len(tokens), bool)
        rows = []
        for stop in (False, True):
            t, o = tokens[is_stop == stop], owners[is_stop == stop]
            where = _part_of(t if not stop else mix(keys[o].view(np.uint64)), parts)
            if stop:
                by = np.argsort(where, kind="stable")
                t, o, where = t[by], o[by], where[by]
            edges = np.flatnonzero(np.diff(where, prepend=-1, append=-1))
            rows += [
                _block(int(where[a]), stop, t[a:b], o[a:b], keys, sizes) for a, b in zip(edges[:-1], edges[1:])
            ]
        yield pa.RecordBatch.from_pylist(rows, _BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go("similar_sets")
        sets: dict[int, np.ndarray] = {}
        held = 0
        for batch in batches:
            for tokens in shingle_sets(batch.column(0)):
                key = _set_key(tokens) if len(tokens) else None
                if key is None or key in sets:
                    continue
                sets[key] = tokens
                held += len(tokens)
                if held >= FLUSH_TOKENS:
                    yield from flush(sets)
                    sets, held = {}, 0
                    give_back()
        if sets:
            yield from flush(sets)
        del sets
        give_back()

    return docs.select(text).mapInArrow(run, _BLOCK_DDL)


def _part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


_SHARED_DDL = "bucket bigint, key binary, size binary, token binary, n binary"


def _counted(blocks: DataFrame, buckets: int) -> DataFrame:
    """Of each hash range: the shingles found in two sets or more, with their counts, by bucket of sets."""

    def run(table: pa.Table) -> pa.Table:
        let_go("similar_sets")
        out = shared_tokens(table, buckets)
        bucket = np.concatenate([_part_of(mix(key.view(np.uint64)), buckets) for _, key, _, _ in out])
        token, key, size, n = (np.concatenate(x) for x in zip(*out))
        del out
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
        rows = []
        for a, b in zip(edges[:-1], edges[1:]):
            at = order[a:b]
            rows.append((int(bucket[at[0]]), *(x[at].tobytes() for x in (key, size, token, n))))
        names = ["bucket", "key", "size", "token", "n"]
        kinds = [pa.int64(), *[pa.binary()] * 4]
        columns = list(zip(*rows)) if rows else [[]] * 5
        done = pa.table({name: pa.array(c, k) for name, c, k in zip(names, columns, kinds)})
        del token, key, size, n, bucket, order, rows, columns
        give_back()
        return done

    # as many partitions as hash ranges: a task holds about one
    return blocks.repartition(min(buckets, MOST_TASKS), "part").groupBy("part").applyInArrow(run, _SHARED_DDL)


def shared_tokens(table: pa.Table, parts: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Token, key, size and count of what two sets or more share, from the blocks of one range; stop shingles all.

    The range is worked through in SUBRANGES steps, so that the blocks are never all open at once.
    """
    columns = [table.column(name) for name in _BLOCK.names]

    def opened(stop: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for i, is_stop in enumerate(columns[1]):
            if is_stop.as_py() == stop:
                yield _open({name: column[i].as_py() for name, column in zip(_BLOCK.names, columns)})

    first = int(columns[0][0].as_py())
    width = (1 << 64) // parts
    inner = np.array([first * width + width * i // SUBRANGES for i in range(1, SUBRANGES)], np.uint64)
    out = []
    for step in (*range(SUBRANGES), None):  # None: the stop shingles, which come by set
        pieces = []
        for token, key, size in opened(step is None):
            if step is not None:
                edges = [0, *np.searchsorted(token, inner).tolist(), len(token)]
                token, key, size = (x[edges[step] : edges[step + 1]].copy() for x in (token, key, size))
            pieces.append((token, key, size))
        if not pieces:
            continue
        token, key, size = (np.concatenate(x) for x in zip(*pieces))
        del pieces
        if not len(token):
            continue
        order = np.lexsort((key, token))
        token, key, size = token[order], key[order], size[order]
        new_token = np.concatenate(([True], token[1:] != token[:-1]))
        once = new_token | np.concatenate(([True], key[1:] != key[:-1]))
        token, key, size, new_token = token[once], key[once], size[once], new_token[once]
        if step is None:
            out.append((token, key, size, np.full(len(token), _LAST)))
            continue
        run_of = np.cumsum(new_token) - 1
        n = np.bincount(run_of)[run_of].astype(np.int64)
        out.append((token[n > 1], key[n > 1], size[n > 1], n[n > 1]))
    none = np.zeros(0, np.int64)
    return out or [(none.view(np.uint64), none, none, none)]


_ALIVE = pa.schema([
    ("key", pa.int64()), ("n", pa.int64()), ("first", pa.int64()), ("prefix", pa.list_(pa.int64())),
    ("tokens", pa.binary()),
])


def _alive(shared: DataFrame, buckets: int, percent: int) -> DataFrame:
    """Sets whose prefix holds a shared shingle: size, prefix (and its first position), all shared shingles."""

    def run(table: pa.Table) -> pa.Table:
        let_go("similar_sets")
        kinds = {"key": np.int64, "size": np.int64, "token": np.uint64, "n": np.int64}
        key, size, token, n = (
            np.concatenate([np.frombuffer(x, k) for x in table[c].to_pylist()]) for c, k in kinds.items()
        )
        order = np.lexsort((token, n, key))
        key, size, token, n = key[order], size[order], token[order], n[order]
        fresh = np.concatenate(([True], (key[1:] != key[:-1]) | (token[1:] != token[:-1])))
        key, size, token = key[fresh], size[fresh], token[fresh]
        edges = np.flatnonzero(np.diff(key, prepend=key[0] - 1, append=key[-1] - 1))
        rows = []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            total = int(size[a])
            alone = total - (b - a)
            reach = total - -(-percent * total // 100) + 1 - alone
            if reach > 0:
                own = token[a:b]
                rows.append({
                    "key": int(key[a]), "n": total, "first": alone, "prefix": own[:reach].view(np.int64).tolist(),
                    "tokens": np.sort(own).tobytes(),
                })
        del key, size, token, order, fresh, n
        done = pa.Table.from_pylist(rows, _ALIVE)
        del rows
        give_back()
        return done

    return shared.repartition(min(buckets, MOST_TASKS), "bucket").groupBy("bucket").applyInArrow(
        run, "key bigint, n bigint, first bigint, prefix array<bigint>, tokens binary"
    )


def _overlaps(a: pa.Array, b: pa.Array) -> pa.Array:
    let_go("similar_sets")
    out = np.empty(len(a), np.int64)
    for i, (x, y) in enumerate(zip(a.to_pylist(), b.to_pylist())):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        if len(x) > len(y):
            x, y = y, x
        at = np.searchsorted(y, x)
        out[i] = (y[np.minimum(at, len(y) - 1)] == x).sum() if len(y) else 0
    del x, y
    give_back()
    return pa.array(out)


def _fits(a: str, b: str, percent: int):
    """Whether two sizes allow the threshold."""
    return (100 * F.least(a, b)) >= (percent * F.greatest(a, b))


def _need(a: str, b: str, percent: int):
    """The overlap that sets of two sizes need."""
    return F.ceil(percent * (F.col(a) + F.col(b)) / (100 + percent))


def _linked(percent: int):
    return 100 * F.col("o") >= percent * (F.col("na") + F.col("nb") - F.col("o"))


def _compared(pairs: DataFrame, alive: DataFrame, name: str) -> DataFrame:
    """``pairs`` (a, b, na, nb) with the overlap `o`."""
    left = alive.select(F.col("key").alias("a"), F.col("tokens").alias("ta"))
    right = alive.select(F.col("key").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.join(left, "a").join(right, "b")
    overlap = F.arrow_udf(_overlaps, LongType())
    return written(both.select("a", "b", "na", "nb", overlap("ta", "tb").alias("o")), name)


def components(links: DataFrame) -> DataFrame:
    """`key` and `label` (the least key it is connected with) for the ends of ``links`` (a, b).

    Each round takes the least label of the neighbours and then the label of that label; every round is
    written, so lost executors repeat one round and no lineage grows.
    """
    both = written(
        links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
        .select("col.*").distinct(), "edges",
    )
    labels = written(both.groupBy(F.col("a").alias("key")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("key")).groupBy("a").agg(F.min("label").alias("near"))
        new = labels.join(near, F.col("key") == F.col("a")).select(
            "key", F.col("label").alias("old"), F.least("label", "near").alias("next")
        )
        above = labels.select(F.col("key").alias("next"), F.col("label").alias("above"))
        new = written(new.join(above, "next").select("key", "old", F.least("next", "above").alias("label")), "labels")
        changed = new.where(F.col("old") != F.col("label")).limit(1).count()
        labels = new.select("key", "label")
        if not changed:
            return labels


def _links(alive: DataFrame, percent: int) -> DataFrame:
    """Enough links (a, b) between sets to connect all that are connected."""
    postings = written(
        alive.select("key", "n", "first", F.posexplode("prefix").alias("i", "token")).select(
            "token", "key", "n", "first", (F.col("first") + F.col("i")).alias("pos"),
            F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent)).cast("int").alias("block"),
        ), "postings",
    )
    # the set with the fewest shingles of its own is the least changed copy, so the nearest to all others
    central = F.struct("first", "key")
    lists = postings.groupBy("token").agg(
        F.count(F.lit(1)).alias("c"), F.min(central)["key"].alias("lo"), F.max("key").alias("hi")
    ).where("c > 1")
    same = postings.groupBy("token", "block").agg(F.min(central)["key"].alias("mid"))
    listed = written(postings.join(lists, "token").join(same, ["token", "block"]), "listed")
    sizes = alive.select("key", "n", (F.col("n") - F.col("first")).alias("m"))  # m shingles that others may have
    pairs = (
        listed.select("key", F.explode(F.array("lo", "hi", "mid")).alias("leader"))
        .where(F.col("key") != F.col("leader"))
        .select(F.least("key", "leader").alias("a"), F.greatest("key", "leader").alias("b")).distinct()
        .join(sizes.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("m").alias("ma")), "a")
        .join(sizes.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("m").alias("mb")), "b")
        .where(_fits("na", "nb", percent) & (F.least("ma", "mb") >= _need("na", "nb", percent)))
        .drop("ma", "mb")
    )
    first = _compared(pairs, alive, "first")
    links = first.where(_linked(percent)).select("a", "b")
    labels = components(links)

    # lists that still span components, with what is known of each member against the list's leader
    known = first.select(
        F.explode(F.array(F.struct(F.col("a").alias("key"), F.col("b").alias("lo"), "o"),
                          F.struct(F.col("b").alias("key"), F.col("a").alias("lo"), "o")))
    ).select("col.*")
    entries = listed.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    open_lists = entries.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y"))
    open_lists = open_lists.where("x != y").select("token")
    entries = entries.join(open_lists, "token", "left_semi").join(known, ["key", "lo"], "left")
    leads = sizes.select(F.col("key").alias("lo"), F.col("n").alias("nlo"))
    entries = entries.join(leads, "lo").withColumn("o", F.when(F.col("key") == F.col("lo"), F.col("n")).otherwise(F.col("o")))
    # long lists carry the members' prefixes, which bound a pair's overlap and name the one list that forms it
    whole = alive.select("key", "prefix", (F.col("n") - F.col("first") - F.size("prefix")).alias("rest"))
    long = entries.where(F.col("c") > LONG_LIST).join(whole, "key")
    short = entries.where(F.col("c") <= LONG_LIST).withColumn("prefix", F.lit(None).cast("array<bigint>"))
    entries = long.unionByName(short.withColumn("rest", F.lit(0).cast("bigint")))
    carried = ("key", "n", "first", "pos", "label", "o", "prefix", "rest")
    entries = written(entries.select("token", "block", "nlo", *carried), "entries")

    # the smaller set of a pair meets its own block and the next one
    x = entries.select("token", *[F.col(c).alias(f"x_{c}") for c in carried], "nlo",
                       F.explode(F.array(F.col("block"), F.col("block") + 1)).alias("block"))
    y = entries.select("token", "block", *[F.col(c).alias(f"y_{c}") for c in carried])
    common = F.array_intersect("x_prefix", "y_prefix")
    by_prefix = F.size(common) + F.greatest("x_rest", "y_rest")
    smaller = (F.col("x_n") < F.col("y_n")) | ((F.col("x_n") == F.col("y_n")) & (F.col("x_key") < F.col("y_key")))
    need = _need("x_n", "y_n", percent)
    # nothing before a set's first shared shingle can be common
    before = F.least(F.col("x_pos") - F.col("x_first"), F.col("y_pos") - F.col("y_first"))
    by_place = before + F.least(F.col("x_n") - F.col("x_pos"), F.col("y_n") - F.col("y_pos"))
    most = F.least("x_o", "y_o") + F.least(F.col("x_n") - F.col("x_o"), F.col("y_n") - F.col("y_o"))
    # the bounds stand in the join condition: what they rule out is never a row
    met = x.join(
        y,
        (x["token"] == y["token"]) & (x["block"] == y["block"])
        & smaller & (F.col("x_label") != F.col("y_label"))
        & _fits("x_n", "y_n", percent) & (by_place >= need)
        & (F.col("x_o").isNull() | F.col("y_o").isNull() | (most >= need))
        & (F.col("x_prefix").isNull() | ((by_prefix >= need) & (F.element_at(common, 1) == x["token"]))),
    )
    least = F.col("x_o") + F.col("y_o") - F.col("nlo")
    rest = written(
        met.select(
            F.least("x_key", "y_key").alias("a"), F.greatest("x_key", "y_key").alias("b"), "x_o", "y_o", "nlo",
            F.when(F.col("x_key") < F.col("y_key"), F.col("x_n")).otherwise(F.col("y_n")).alias("na"),
            F.when(F.col("x_key") < F.col("y_key"), F.col("y_n")).otherwise(F.col("x_n")).alias("nb"), need.alias("need"),
        ).groupBy("a", "b").agg(
            F.first("na").alias("na"), F.first("nb").alias("nb"), F.max(F.coalesce(least >= F.col("need"), F.lit(False))).alias("sure")
        ).join(first.select("a", "b"), ["a", "b"], "left_anti"), "rest",
    )
    second = _compared(rest.where(~F.col("sure")).select("a", "b", "na", "nb"), alive, "second")
    return links.unionByName(rest.where("sure").select("a", "b")).unionByName(
        second.where(_linked(percent)).select("a", "b")
    )


def _most_frequent(stops: DataFrame) -> DataFrame:
    """The tokens of ``stops`` (token, n) above the least count that leaves MOST_STOPS or fewer.

    Any choice gives the same links: the order of shingles only has to be the same for all sets.
    """
    by_count = stops.groupBy("n").agg(F.count(F.lit(1)).alias("tokens"))  # one row per count that occurs
    upto = by_count.withColumn("upto", F.sum("tokens").over(Window.orderBy(F.desc("n"))))
    least = upto.agg(F.max(F.when(F.col("upto") > MOST_STOPS, F.col("n")))).first()[0]
    return stops.where(F.col("n") > (least or 0)).select("token")


def _labelled(docs: DataFrame, id_col: str, text: str, percent: int) -> tuple[DataFrame, DataFrame]:
    """The profile of every row, and `key` and `label` of the sets that have links."""
    profile = written(profiles(docs, id_col, text), "profile")
    stats = profile.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count_distinct("key").alias("classes")).first()
    stops = (
        profile.where(F.col("common").isNotNull()).select(F.inline("common")).groupBy("token")
        .agg(F.sum("count").alias("n")).where(F.col("n") > max(2.0, stats["classes"] * STOP_SHARE))
    )
    fixed = np.sort(np.array([r[0] for r in _most_frequent(stops).toLocalIterator()], np.int64).view(np.uint64))
    parts = max(1, -(-stats["tokens"] // RANGE_TOKENS))
    blocks = _blocks(docs, text, fixed, parts)
    alive = written(_alive(_counted(blocks, parts), parts, percent), "alive")
    return profile, components(_links(alive, percent))


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """`id`, `n_shingles` and `component_id` (the least id reachable by links, its own included) of every row."""
    profile, labels = _labelled(docs, id_col, text, percent)
    least = profile.where("n > 0").groupBy("key").agg(F.min("id").alias("least"))
    named = least.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    best = named.where(F.col("label").isNotNull()).groupBy("label").agg(F.min("least").alias("component_id"))
    of_key = named.join(best, "label").select("key", "component_id")
    filled = profile.where("n > 0").select("id", "n", "key").join(of_key, "key", "left")
    alone = profile.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return filled.select("id", "n", "component_id").unionByName(alone).withColumnRenamed("n", "n_shingles")


def first_of_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row of every group of linked texts, and all rows with an empty set; all columns stay.

    A group's row is the one with the least id, null ids last, then with the least digest of its text. Groups are
    told apart by texts alone: rows that share an id, or have none, stay for every group they are the first of.
    """
    profile, labels = _labelled(docs, id_col, text, percent)
    same = profile.where("n > 0").groupBy("key", "id", "digest").agg(F.count(F.lit(1)).alias("copies"))
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "digest", "copies")
    first = same.groupBy("key").agg(F.min(rank).alias("first")).join(labels, "key", "left")
    first = first.groupBy(F.coalesce("label", "key").alias("label")).agg(F.min("first").alias("first"))
    first = written(first.select("first.id", "first.digest", "first.copies"), "first")

    blank = ~F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    digest, row = spare_name(docs, "text_digest"), spare_name(docs, "row")
    rows = docs.where(~blank).withColumn(digest, _digest(text))
    if first.where("copies > 1").limit(1).count():  # rows equal in id and text: one of them
        rows = rows.groupBy(id_col, digest).agg(
            F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias(row)
        ).select(f"{row}.*", digest)
    chosen = rows.join(first, rows[id_col].eqNullSafe(first["id"]) & (rows[digest] == first["digest"]), "left_semi")
    return chosen.select(docs.columns).unionByName(docs.where(blank))
