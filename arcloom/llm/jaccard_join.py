"""Similarity join of documents on word shingles, by prefixes under several global token orders."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arcloom.llm.text import NOT_SPACE, bounded, mix, small_batches, words
from arcloom.operators.graph import connected_components
from arcloom.storage import small_side, written

#: The first pass counts a share of the token space: so many times the share of tokens that a linked set may lack.
PROBE = 1.9
#: Token orders; a pair must meet in a prefix under every one of them before it is verified.
ORDERS = 3
#: A token of at least so many sets comes after all rarer ones in every order, if it is among the HOT_MOST hottest.
#: The orders decide how many candidates there are, never which pairs link.
HOT_SETS = 24
HOT_MOST = 1 << 18
#: So many tokens of a prefix before a shared one are looked at to see whether the pair was given before.
NEAR = 32

_SEEDS = [np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3)]
_MIX = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                               0x94D049BB133111EB, 0xBF58476D1CE4E5B9, 0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD)]


def shingle_sets(col: pa.Array, k: int):
    """``(row, sorted distinct 64-bit hashes)`` of every row's ``k``-word shingles.

    Words are `[^\\x20\\x09-\\x0D]+` of the text with A-Z lower-cased. A text of fewer words than ``k`` has its whole
    sequence as the one shingle; without words the set is empty.
    """
    for i, _, w, rows in words(col, NOT_SPACE):
        h = np.zeros(max(len(w) - k + 1, 0), np.uint64)
        for d in range(k):
            h += mix(w[d : d + len(h)] + _MIX[d % 8]) * _MIX[(d + 3) % 8]
        h = mix(h)
        for r, (a, b) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True)):
            if b - a >= k:
                yield i + r, np.unique(h[a : b - k + 1])
            elif b > a:
                short = np.full(1, b - a, np.uint64)
                for x in w[a:b]:
                    short = mix(short * _MIX[0] + x)
                yield i + r, short
            else:
                yield i + r, np.empty(0, np.uint64)


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(a.astype(np.uint64).view(np.int64))


def _class_key(tokens: np.ndarray) -> int:
    """64 bits that stand for a set: equal sets have equal keys."""
    one = mix(tokens).sum(dtype=np.uint64, keepdims=True)
    two = mix(tokens + _SEEDS[0]).sum(dtype=np.uint64, keepdims=True)
    return int((one ^ two * _MIX[1]).view(np.int64)[0])


def _allowed(n: np.ndarray | int, percent: int):
    """Tokens of a set of ``n`` that a linked set may lack: its prefix is one longer."""
    return n - (n * percent + 99) // 100


def _sets(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """``doc_id, n, key, key2`` of every row."""

    def run(batches):
        for b in small_batches(batches, text_col):
            n = np.zeros(b.num_rows, np.int64)
            key, key2 = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            for row, s in shingle_sets(b.column(text_col), k):
                n[row] = len(s)
                if len(s):
                    key[row], key2[row] = _class_key(s), _class_key(s ^ _SEEDS[2])
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col).cast(pa.int64()), pa.array(n), pa.array(key), pa.array(key2)],
                names=["doc_id", "n", "key", "key2"],
            )

    return docs.select(id_col, text_col).mapInArrow(run, "doc_id long, n long, key long, key2 long")


def _probe_tokens(docs: DataFrame, text_col: str, k: int, share_64ths: int) -> DataFrame:
    """``token, key`` for the tokens that fall into the probed share of the token space; copies once per batch."""
    limit = np.uint64(share_64ths << 58) if share_64ths < 64 else np.uint64(2**64 - 1)

    def run(batches):
        for b in small_batches(batches, text_col):
            tokens, keys, seen = [], [], set()
            for _, s in shingle_sets(b.column(text_col), k):
                if not len(s) or (key := _class_key(s)) in seen:
                    continue
                seen.add(key)
                t = s[: np.searchsorted(s, limit)]
                tokens.append(t)
                keys.append(np.full(len(t), key, np.int64))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [_signed(np.concatenate(tokens)), pa.array(np.concatenate(keys))], names=["token", "key"]
                )

    return docs.select(text_col).mapInArrow(run, "token long, key long")


def _member_tokens(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """``id, tokens`` of each row: the sorted token set as an array."""

    def run(batches):
        for b in small_batches(batches, text_col, 2 << 20):
            ids, lists, ends = [], [], [0]
            doc = b.column(id_col).to_pylist()
            for row, s in shingle_sets(b.column(text_col), k):
                ids.append(doc[row])
                lists.append(s)
                ends.append(ends[-1] + len(s))
            values = _signed(np.concatenate([*lists, np.empty(0, np.uint64)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)],
                names=["id", "tokens"],
            )

    return docs.select(id_col, text_col).mapInArrow(run, "id long, tokens array<long>")


def _hot(tokens: np.ndarray, hot: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(tokens), bool)
    return hot[np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)] == tokens


def _prefix(tokens: np.ndarray, is_hot: np.ndarray, order: int, n: int) -> np.ndarray:
    """The first ``n`` tokens in one global order: by the order's own hash, hot tokens after all others."""
    rank = mix(tokens ^ _SEEDS[order]) >> np.uint64(1)
    rank[is_hot] |= np.uint64(1 << 63)
    first = np.argpartition(rank, n - 1)[:n]
    return tokens[first[np.argsort(rank[first])]]


def _prefixes(members: DataFrame, hot, percent: int, orders: int) -> DataFrame:
    """``id, n, weight, prefix, others``: each set's prefix under the first order, and under each further one.

    ``weight`` is the share of the set's tokens that are hot: the text that copies were made from has the
    highest in its family, so it serves as the centre to compare the others with. ``others`` has 32 bits of each
    token: prefixes that share a token share its bits, so a pair that could link is never refused.
    """

    def run(batches):
        table = hot.value
        for b in batches:
            for i in range(0, b.num_rows, 512):
                s = b.slice(i, 512)
                lists, first, rest, n, weight = s.column("tokens"), [], [], [], []
                for j in range(s.num_rows):
                    t = lists[j].values.to_numpy(zero_copy_only=False).view(np.uint64)
                    is_hot, p = _hot(t, table), int(_allowed(len(t), percent)) + 1
                    first.append(_prefix(t, is_hot, 0, p))
                    rest += [(mix(_prefix(t, is_hot, r, p)) >> np.uint64(32)).astype(np.uint32).view(np.int32) for r in range(1, orders)]
                    n.append(len(t))
                    weight.append(is_hot.mean())
                ends = lambda parts: pa.array(np.cumsum([0, *map(len, parts)]), pa.int32())
                inner = pa.ListArray.from_arrays(ends(rest), pa.array(np.concatenate([*rest, np.empty(0, np.int32)])))
                outer = pa.array(np.arange(s.num_rows + 1) * (orders - 1), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        s.column("id"), pa.array(n, pa.int64()), pa.array(weight, pa.float64()),
                        pa.ListArray.from_arrays(ends(first), _signed(np.concatenate([*first, np.empty(0, np.uint64)]))),
                        pa.ListArray.from_arrays(outer, inner),
                    ],
                    names=["id", "n", "weight", "prefix", "others"],
                )

    return members.mapInArrow(run, "id long, n long, weight double, prefix array<long>, others array<array<int>>")


def _meet(pairs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose prefixes meet under every further order; no set is fetched for it."""
    side = lambda c: prefixes.select(F.col("id").alias(c), F.col("others").alias(f"o{c}"))
    every = F.forall(F.zip_with("oa", "ob", lambda x, y: F.arrays_overlap(x, y)), lambda x: x)
    return pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a").where(every).select("a", "b")


def _verify(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` that link, by their whole sets.

    Each side's set joins by its id; a centre that very many pairs name is a hot key of an equi-join, which
    adaptive execution splits.
    """

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                s = batch.slice(i, 256)
                a, b = s.column("a").to_pylist(), s.column("b").to_pylist()
                left, right, kept = s.column("ta"), s.column("tb"), []
                for j in range(len(a)):
                    x = left[j].values.to_numpy(zero_copy_only=False)
                    y = right[j].values.to_numpy(zero_copy_only=False)
                    if _linked(x, y, percent):
                        kept.append(j)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a[j] for j in kept], pa.int64()), pa.array([b[j] for j in kept], pa.int64())], names=["a", "b"]
                )

    side = lambda c: members.select(F.col("id").alias(c), F.col("tokens").alias(f"t{c}"))
    return pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a").select("a", "b", "ta", "tb").mapInArrow(
        run, "a long, b long"
    )


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _candidates(rows: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs whose sizes allow a link."""
    small, large = F.least("na", "nb"), F.greatest("na", "nb")
    return rows.where((F.col("a") != F.col("b")) & (small * 100 >= large * percent)).select("a", "b").distinct()


def _remaining(lists: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of sets in different components that share a token of ``lists`` and could link by what follows it.

    At the first token that two prefixes share nothing before it on either side is shared, so what follows bounds
    the intersection. A row carries the ``NEAR`` tokens before its own, which stops most repeats at later tokens;
    it does not grow with the text. A list is split by size: sets that could link are in one level or in
    neighbouring ones, and the smaller of the two has its token in the first half of its prefix.
    """
    before = F.slice("prefix", F.greatest(F.lit(1), F.col("pos") - NEAR + 1), F.least("pos", F.lit(NEAR)))
    ranked = lists.join(prefixes.select("id", "prefix"), "id").select("token", "id", "n", "pos", "component", before.alias("near"))
    step = math.log(100 / percent * 1.001)  # a little more than linked sizes may differ by, so rounding loses none
    ranked = written(ranked.withColumn("level", F.floor(F.log("n") / step)), "open")
    side = lambda x, level: ranked.select(
        "token", level.alias("level"), F.col("id").alias(x), *[F.col(c).alias(f"{c[:2]}{x}") for c in ("n", "pos", "component", "near")]
    )
    small = side("a", F.col("level")).where(f"{100 + percent} * (na - poa) >= {2 * percent} * na")
    large = side("b", F.explode(F.array(F.col("level"), F.col("level") - 1)))
    found = small.join(large, ["token", "level"]).where(
        f"(na < nb or na = nb and a < b) and coa <> cob and na * 100 >= nb * {percent} "
        f"and {100 + percent} * least(na - poa, nb - pob) >= {percent} * (na + nb) and not arrays_overlap(nea, neb)"
    )
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def linked_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, percent: int = 85,
    probe: float = PROBE, orders: int = ORDERS, hot_sets: int = HOT_SETS, hot_most: int = HOT_MOST,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Two documents link when ``100 * |intersection| >= percent * |union|`` of their distinct ``k``-word shingles;
    the component is the smallest id reachable by links, itself included. Null, empty and blank texts have an
    empty set and link with nothing; equal sets link with each other. Rows that repeat an id, or have none, are
    linked by their own texts; a component in which no row has an id is null. An empty table gives no rows. The
    result is exact.

    1. Sets: one scan gives each row's size and a 128-bit key; rows of equal sets become one class (its smallest id).
    2. Probe: tokens in a fixed share of the token space are counted by class. A linked class lacks at most
       ``n - ceil(n * percent / 100)`` tokens in its partner, so a class with more tokens of its own than
       that, in the share alone, can't link: most documents end here, and nothing of them is shuffled but the share.
    3. The other classes are indexed under the first order by their prefix (one token more than may be lacking):
       tokens of many sets come last, so passages that many documents share stay out of prefixes. In every
       token's list each set is paired with the list's centre only. Pairs must meet in the prefixes of the other
       orders as well, which are joined by themselves; only then are whole sets fetched and compared.
    4. Lists that still hold several components give the pairs across components that could still link by size and
       by the tokens after the first shared one (``_remaining``). They pass the other orders and the comparison as
       well. A family that its centre has joined gives none, and no link is lost.
    """
    spark = bounded(docs).sparkSession
    rows = written(_sets(docs, id_col, text_col, k), "sets")
    if id_col != "__node" and _unnamed(rows):  # rows named by what they hold; then the smallest id of each component
        named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).withColumn(
            "__node", F.xxhash64("id", "t", F.lit("n"))
        )
        found = linked_components(named.dropDuplicates(["__node"]), "__node", "t", k, percent, probe, orders, hot_sets, hot_most)
        found = written(named.select("id", "__node").join(found.withColumnRenamed("doc_id", "__node"), "__node"), "named")
        least = found.groupBy("component_id").agg(F.min("id").alias("least"))
        return found.join(least, "component_id").select(F.col("id").alias("doc_id"), "n_shingles", F.col("least").alias("component_id"))
    classes = rows.where("n > 0").groupBy("key", "key2", "n").agg(F.min("doc_id").alias("id"))
    alone = (
        _probe_tokens(docs, text_col, k, min(64, math.ceil(probe * 64 * (100 - percent) / 100))).groupBy("token")
        .agg(F.min("key").alias("key"), F.max("key").alias("other")).where("key = other")
        .groupBy("key").agg(F.count("*").alias("alone"))
    )
    keep = (
        classes.join(alone, "key", "left").where(f"coalesce(alone, 0) <= n - ceil(n * {percent} / 100)")
        .select("id")
    )
    keep = written(keep, "keep")
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(small_side(keep), "id", "left_semi")
    members = written(_member_tokens(chosen, "id", "t", k), "members")
    table = (
        members.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("sets"))
        .where(F.col("sets") >= hot_sets).orderBy(F.desc("sets"), "token").limit(hot_most).select("token").toPandas()
    )
    hot = spark.sparkContext.broadcast(np.sort(table["token"].to_numpy(np.int64).view(np.uint64)))
    prefixes = written(_prefixes(members, hot, percent, orders), "prefixes")
    hot.unpersist()
    lists = prefixes.select("id", "n", "weight", F.posexplode("prefix").alias("pos", "token"))
    shared = lists.groupBy("token").agg(
        F.count("*").alias("sets"),
        F.max(F.struct("weight", (-F.col("id")).alias("i"), F.col("n").alias("na"))).alias("c"),
    ).where("sets > 1").select("token", (-F.col("c.i")).alias("a"), F.col("c.na").alias("na"))
    shared = written(shared, "centres")
    stars = lists.join(shared, "token").select("a", "na", F.col("id").alias("b"), F.col("n").alias("nb"))
    stars = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "na", "nb")
    stars = written(_candidates(stars, percent), "stars")
    links = written(_verify(written(_meet(stars, prefixes), "met"), members, percent), "links")
    part = written(connected_components(links), "parts")

    # what the centres have not joined: pairs of a list that lie in different components
    own = lists.join(shared.select("token"), "token", "left_semi").join(
        part.select(F.col("node").alias("id"), "component"), "id", "left"
    ).withColumn("component", F.coalesce("component", "id"))
    own = written(own.drop("weight"), "shared")
    open_ = own.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    rest = _remaining(own.join(open_.select("token"), "token", "left_semi"), prefixes, percent)
    rest = written(rest.join(stars, ["a", "b"], "left_anti"), "rest")
    more = _verify(written(_meet(rest, prefixes), "met"), members, percent)
    part = connected_components(links.unionByName(written(more, "links")))

    joined = classes.join(part, F.col("id") == F.col("node"), "left").select(
        "key", "key2", "n", F.coalesce("component", "id").alias("component_id")
    )
    joined = written(joined, "classes")
    return _label(rows, joined)


def _unnamed(rows: DataFrame) -> bool:
    """Whether some rows have no id or share one."""
    return not rows.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty()


def _label(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Each row with its class's component; an empty set is its own."""
    full = rows.where("n > 0").join(classes, ["key", "key2", "n"])
    empty = rows.where("n = 0").withColumn("component_id", F.col("doc_id"))
    return full.select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(
        empty.select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component: the smallest id's.

    Where rows repeat an id or have none, they are told apart by id and text: the row with the smallest id stays (one
    without an id only if no other has one), among several texts of that id one, and other texts under its id are judged by themselves.
    """
    if not _unnamed(docs.select(F.col(id_col).alias("doc_id"))):
        marked = linked_components(docs, id_col, text_col, **options)
        gone = written(marked.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct(), "gone")
        return docs.join(small_side(gone), F.col(id_col) == F.col("__gone"), "left_anti")
    node = F.xxhash64(F.col(id_col), F.col(text_col), F.lit("n"))
    named = docs.select(node.alias("__node"), F.col(id_col).alias("id"), F.col(text_col).alias("t")).dropDuplicates(["__node"])
    marked = linked_components(named, "__node", "t", **options).withColumnRenamed("doc_id", "__node").drop("n_shingles")
    marked = written(marked.join(named.select("__node", "id"), "__node"), "named")
    stays = marked.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "__node")).alias("s"))
    gone = marked.join(stays, "component_id").where("__node <> s.__node").select(F.col("__node").alias("__gone"))
    gone = written(gone, "gone")
    return docs.join(small_side(gone), node == F.col("__gone"), "left_anti")


def prefix_length(n: int, percent: int) -> int:
    """Tokens of a prefix: one more than a linked set may lack."""
    return n - math.ceil(n * percent / 100) + 1
