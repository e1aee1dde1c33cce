"""Hashed maximum-entropy language model with class-factored softmax, and the unigram base it is compared with."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arcloom.llm.text import NOT_SPACE, bounded, hash_words, mix, passes, small_batches, word_bounds
from arcloom.storage import release, written

#: Word classes: short words by their hash, longer ones by the hash of their last two bytes, and one for the end.
SHORT_CLASSES, LONG_CLASSES = 40, 55
CLASSES = SHORT_CLASSES + LONG_CLASSES + 1
END_CLASS = CLASSES - 1
SHORT_BYTES = 3
#: Slots of hashed features, as powers of two: at least, and at most. Between them there is one for every SLOT_TOKENS
#: training tokens. A weight is kept for each slot and class (4 bytes each, 50 MB at most), which every worker holds.
SLOT_BITS, MOST_SLOT_BITS, SLOT_TOKENS = 14, 17, 512
#: The training documents are dealt by a hash of their text into so many parts; each part gives one gradient update.
ROUNDS = 2
#: The weights start from the features' class counts: BLEND times the log ratio of a class's share at a slot to its share of
#: all tokens, with START imagined tokens per slot. An update moves them by STEP times the log ratio of counted to
#: expected tokens, with DAMP imagined tokens on either side.
BLEND, START, STEP, DAMP = 0.35, 20.0, 0.3, 8.0
#: Tokens of one forward pass, and of one sum of expected counts; longer runs of a slot's tokens are added up one by one.
BATCH, CHUNK, LONG_RUN = 1024, 65536, 64
#: Rows of the table that are added up together, which the processor's cache holds.
SUM_ROWS = 512
#: Partitions of the input that one learner reads, where there are enough of them for all cores: each learner writes its slots.
TOGETHER = 16
#: Blocks that a table of slots is split into, and tables that one task adds up; more are added up in a tree.
BLOCKS, FAN = 64, 16
#: Most frequent words whose counts every executor holds; all other words meet their counts in a join.
COMMON_WORDS = 1 << 17
#: Added to every count, in the base as in the model.
ALPHA = 0.1
_END = np.uint64(0x2545F4914F6CDD1D)
_EDGE = np.uint64(0x6C62272E07BB0142)
_SALT = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]


@cache
def _tail_classes() -> np.ndarray:
    """Class of every long word, by its last two bytes, the first of them times 256."""
    pairs = np.arange(1 << 16)
    data = np.stack([pairs >> 8, pairs & 255], 1).astype(np.uint8).ravel()
    tail = hash_words(data, 2 * pairs, 2 * pairs + 2)
    return SHORT_CLASSES + (tail % np.uint64(LONG_CLASSES)).astype(np.int64)


def tokens(col: pa.Array):
    """``(first row, row starts, word hashes, classes)`` of passes over a column; every row ends in the end token."""
    for i, _, data, rows in passes(col):
        starts, ends = word_bounds(data, NOT_SPACE)
        at = np.searchsorted(starts, rows)
        w = hash_words(data, starts, ends)
        kind = (w % np.uint64(SHORT_CLASSES)).astype(np.int64)
        long = np.flatnonzero(ends - starts > SHORT_BYTES)
        last = ends[long]
        kind[long] = _tail_classes()[data[last - 2].astype(np.int64) << 8 | data[last - 1]]
        where = at[1:]
        yield i, at + np.arange(len(at)), np.insert(w, where, _END), np.insert(kind, where, END_CLASS)


def slot_bits(n_tokens: int) -> int:
    """The slots for so many training tokens, as a power of two."""
    return min(max((int(n_tokens) // SLOT_TOKENS).bit_length(), SLOT_BITS), MOST_SLOT_BITS)


def features(rows: np.ndarray, w: np.ndarray, kind: np.ndarray, bits: int = SLOT_BITS) -> np.ndarray:
    """Slots of each token's features: the classes of the last one, two and three tokens, the last word, the word before it
    (a skip), and both words."""
    n = len(w)
    back_w, back_k = [], []
    for d in (1, 2, 3):
        word, cls = np.empty(n, np.uint64), np.empty(n, np.uint64)
        word[d:], cls[d:] = w[:-d], kind[:-d]
        for i in range(d):  # a row's first tokens
            at = rows[:-1] + i
            at = at[at < rows[1:]]
            word[at], cls[at] = _EDGE, CLASSES
        back_w.append(word)
        back_k.append(cls)
    k1, k2, k3 = back_k
    pair = k1 * np.uint64(128) + k2
    few = np.arange(1 << 14, dtype=np.uint64)
    slot = lambda p: (mix(p) >> np.uint64(64 - bits)).astype(np.int32)
    out = np.empty((n, 6), np.int32)
    out[:, 0] = slot(few[:128] + _SALT[0])[k1.astype(np.int64)]
    out[:, 1] = slot(few + _SALT[1])[pair.astype(np.int64)]
    for i, p in enumerate((pair * np.uint64(128) + k3 + _SALT[2], back_w[0] ^ _SALT[3], back_w[1] ^ _SALT[4], mix(back_w[0]) + back_w[1])):
        out[:, 2 + i] = slot(p)
    return out


@dataclass
class ClassModel:
    """Weights (slot x class) and the classes' log shares, to which a token's slots add."""

    weights: np.ndarray
    bias: np.ndarray
    bits: int

    def _sums(self, slots: np.ndarray):
        """``(first token, exponentials of the class sums, their sum by token)`` batch by batch; the arrays are used again."""
        z, x, ones = np.empty((BATCH, CLASSES), np.float32), np.empty((BATCH, CLASSES), np.float32), np.ones(CLASSES, np.float32)
        for a in range(0, len(slots), BATCH):
            s = slots[a : a + BATCH]
            out, more = z[: len(s)], x[: len(s)]
            np.take(self.weights, s[:, 0], 0, out=out, mode="clip")
            for c in range(1, s.shape[1]):
                out += np.take(self.weights, s[:, c], 0, out=more, mode="clip")
            out += self.bias
            if out.max() > 60 or out.min() < -60:  # beyond what single precision adds up
                out -= out.max(1, keepdims=True)
            np.exp(out, out=out)
            yield a, out, out @ ones

    def log_share(self, slots: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Natural log probability of each token's class given its slots."""
        out = np.empty(len(slots))
        for a, z, total in self._sums(slots):
            own = z[np.arange(len(z)), kind[a : a + len(z)]]
            out[a : a + len(z)] = np.log(np.maximum(own, 1e-37)) - np.log(total)
        return out

    def shares(self, slots: np.ndarray) -> np.ndarray:
        """Probability of every class at each token."""
        out = np.empty((len(slots), CLASSES), np.float32)
        for a, z, total in self._sums(slots):
            np.multiply(z, (1 / total)[:, None], out=out[a : a + len(z)])
        return out


def _expect(table: np.ndarray, slots: np.ndarray, shares: np.ndarray, bits: int, scratch: np.ndarray) -> None:
    """Add the tokens' class shares at all their slots.

    Slots and tokens are sorted as one number, so every slot's tokens are a run; runs of about the same length are added up
    together, their r-th tokens at once, and each sum goes to the table once. ``scratch`` is memory of four-byte items,
    in which the sums are made: at least two rows of the table.
    """
    room = 63 - bits
    key = (slots.T.astype(np.int64) << room | np.arange(len(slots))).ravel()
    key.sort()
    at, token = key >> room, key & ((1 << room) - 1)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    n = np.diff(first, append=len(at))
    order = np.argsort(-np.minimum(n, LONG_RUN + 1).astype(np.int16), kind="stable")
    first, n = first[order], n[order]
    at, long = at[first], int((n > LONG_RUN).sum())
    for s, a, k in zip(at[:long].tolist(), first[:long].tolist(), n[:long].tolist(), strict=True):
        table[s] += np.take(shares, token[a : a + k], 0).sum(0)
    block = scratch.size // (2 * CLASSES)
    sums, more = scratch.reshape(-1).view(np.float32)[: 2 * block * CLASSES].reshape(2, block, CLASSES)
    for a in range(long, len(at), block):
        f, k = first[a : a + block], n[a : a + block]
        own = sums[: len(f)]
        np.take(shares, token[f], 0, out=own, mode="clip")
        for r in range(1, int(k[0])):
            f = f[: int(np.searchsorted(-k, -r))]
            own[: len(f)] += np.take(shares, token[f + r], 0, out=more[: len(f)], mode="clip")
        s = at[a : a + block]
        own += np.take(table, s, 0, out=more[: len(s)], mode="clip")
        table[s] = own


_TABLE = "part int, block int, slots binary, sums binary"


def _emit(part: int, table: np.ndarray, kind):
    """The table's rows that are not all zero, block by block, as rows of `_TABLE`."""
    size = len(table) // BLOCKS
    for i in range(BLOCKS):
        own = table[i * size : (i + 1) * size]
        at = np.flatnonzero(own.any(1))
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([i], pa.int32()),
                 *(pa.array([x.tobytes()], pa.binary()) for x in (at.astype(np.int32), own[at].astype(kind)))],
                names=["part", "block", "slots", "sums"],
            )


def _summed(tables: DataFrame, learners: int, size: int) -> DataFrame:
    """Tables of many learners added up by part and block, in a tree in which a task adds up about FAN of a block."""

    def add(batches):
        found: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for r in range(b.num_rows):
                part, block, at, sums = (b.column(c)[r].as_py() for c in ("part", "block", "slots", "sums"))
                x = found.setdefault((part, block), np.zeros((size, CLASSES)))
                x[np.frombuffer(at, np.int32)] += np.frombuffer(sums, np.float32).reshape(-1, CLASSES)
        for (part, block), x in found.items():
            at = np.flatnonzero(x.any(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()),
                 *(pa.array([y.tobytes()], pa.binary()) for y in (at.astype(np.int32), x[at].astype(np.float32)))],
                names=["part", "block", "slots", "sums"],
            )

    while learners > FAN:
        groups = -(-learners // FAN)
        tables = tables.withColumn("team", F.spark_partition_id() % groups).repartition(groups * BLOCKS, "part", "block", "team")
        tables = tables.drop("team").mapInArrow(add, _TABLE)
        learners = groups
    return tables.repartition(BLOCKS, "part", "block").mapInArrow(add, _TABLE)


def fit(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, bits: int = SLOT_BITS) -> ClassModel:
    """Class weights, learned from every row's whole text.

    One pass counts the classes at every slot, which gives the weights to start from. Then each of ``rounds`` parts of
    the documents, dealt by a hash of the text, gives one gradient update: all learners hold the same weights, sum the
    expected class counts at the slots of their documents, and the sums over all learners move the weights towards the
    counted ones. So nothing depends on how the rows are split but the rounding of sums. The sums are taken in a
    tree of tasks by blocks of slots; the driver gets one table per part and pass, whatever the input.
    """
    spark, n = docs.sparkSession, 1 << bits
    parts = docs.rdd.getNumPartitions()
    learners = max(1, parts // TOGETHER, min(parts, spark.sparkContext.defaultParallelism))
    text = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    text = text.withColumn("part", F.pmod(F.xxhash64("t"), F.lit(rounds)).cast("int"))

    def collected(rows: DataFrame) -> np.ndarray:
        out = np.zeros((n, CLASSES), np.float32)
        for r in rows.select("block", "slots", "sums").collect():  # one row per block
            out[r["block"] * (n // BLOCKS) + np.frombuffer(bytes(r["slots"]), np.int32)] = np.frombuffer(bytes(r["sums"]), np.float32).reshape(-1, CLASSES)
        return out

    def count(batches):
        tables: dict[int, np.ndarray] = {}
        for b in small_batches(batches, "t", 2 << 20):
            own = b.column("part").to_numpy(zero_copy_only=False)
            for i, rows, w, kind in tokens(b.column("t")):
                part = np.repeat(own[i : i + len(rows) - 1], np.diff(rows))
                at = features(rows, w, kind, bits) * np.int32(CLASSES) + kind[:, None].astype(np.int32)
                for p in np.unique(part).tolist():
                    table = tables.setdefault(p, np.zeros(n * CLASSES, np.float32))
                    seen = np.sort(at[part == p], axis=None)
                    first = np.flatnonzero(np.concatenate([[True], seen[1:] != seen[:-1]]))
                    table[seen[first]] += np.diff(first, append=len(seen))
        for p, table in tables.items():
            yield from _emit(p, table.reshape(n, CLASSES), np.float32)

    counts = written(_summed(text.coalesce(learners).mapInArrow(count, _TABLE), learners, n // BLOCKS), "class-counts")
    seen = [collected(counts.where(F.col("part") == p)) for p in range(rounds)]
    every = sum(seen)
    width = features(np.array([0, 1]), np.zeros(1, np.uint64), np.zeros(1, np.int64), bits).shape[1]
    totals = every.sum(0, dtype=np.float64) / width
    prior = ((totals + 0.5) / (totals.sum() + 0.5 * CLASSES)).astype(np.float32)
    weights = BLEND * np.log((every + START * prior) / (every.sum(1, keepdims=True) + START) / prior)
    model = ClassModel(weights.astype(np.float32), np.log(prior), bits)
    del every, weights

    for k in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def expect(batches, shared=shared):
            table, scratch, own = np.zeros((n, CLASSES), np.float32), np.empty(2 * SUM_ROWS * CLASSES, np.float32), shared.value
            for b in small_batches(batches, "t", 2 << 20):
                for _, rows, w, kind in tokens(b.column("t")):
                    slots = features(rows, w, kind, bits)
                    for a in range(0, len(w), CHUNK):
                        _expect(table, slots[a : a + CHUNK], own.shares(slots[a : a + CHUNK]), bits, scratch)
            yield from _emit(0, table, np.float32)

        tables = text.where(F.col("part") == k).coalesce(learners).select("t").mapInArrow(expect, _TABLE)
        expected = collected(_summed(tables, learners, n // BLOCKS))
        damp = DAMP * prior + 0.5
        model.weights = model.weights + STEP * np.log((seen[k] + damp) / (expected + damp))
        shared.destroy()
        del tables, expected, expect
        release(spark)
    return model


def _buckets(keys: np.ndarray) -> tuple[np.uint64, np.ndarray]:
    """For sorted hashes: a shift, and the first key of each value that a shifted hash can have; two to four values a key."""
    bits = len(keys).bit_length() + 1
    shift = np.uint64(64 - bits)
    return shift, np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << shift).astype(np.int32)


def _places(keys: np.ndarray, buckets: tuple[np.uint64, np.ndarray], w: np.ndarray) -> np.ndarray:
    """The place of each hash among the sorted keys, or a place with another key (or none there) if it is not among them."""
    shift, first = buckets
    at = first[(w >> shift).view(np.int64)]
    if len(keys):
        np.minimum(at, len(keys) - 1, out=at)
        left = np.flatnonzero(keys[at] < w)
        while len(left := left[at[left] < len(keys) - 1]):
            at[left] += 1
            left = left[keys[at[left]] < w[left]]
    return at


def count_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``h, kind, n``: the count of every token, end tokens too, in all rows' whole texts."""

    def run(batches):
        for b in small_batches(batches, "t", 8 << 20):
            seen, kinds = [], []
            for _, _, w, kind in tokens(b.column("t")):
                seen.append(w)
                kinds.append(kind)
            h = np.concatenate(seen)
            order = np.argsort(h)
            h = h[order]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            n = np.diff(first, append=len(h))  # equal words are of one class
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[first].view(np.int64)), pa.array(np.concatenate(kinds)[order[first]].astype(np.int32)), pa.array(n)],
                names=["h", "kind", "n"],
            )

    return (
        docs.select(F.col(text_col).alias("t")).mapInArrow(run, "h long, kind int, n long")
        .groupBy("h", "kind").agg(F.sum("n").alias("n"))
    )


def score_documents(train: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of every row of ``docs`` by models learned from every row of ``train``.

    ``doc_id, n_tokens, n_known, train_tokens, base_score, score``. A token is a word `[^\\x20\\x09-\\x0D]+` with A-Z
    lower-cased, or the end of a text. ``base_score`` is the sum of ``log10((c + 0.1) / (N + 0.1 * (V + 1)))``. ``score`` is
    the model's log10 probability: the maximum-entropy probability of each token's class given the tokens before it,
    times the token's share of its class, ``(c + 0.1) / (N_class + 0.1 * (V_class + 1))``; as in the base, all unseen
    words of a class share one part. Null counts as an empty text, which is one end token. Rows are scored by
    themselves, also where ids repeat or are null. Without training rows every token is unseen.

    The common words' counts are broadcast (a fixed number of them); a document's other words join their
    counts by hash. None of these is frequent, so no key is hot, and sums come back by row with partial sums.
    """
    spark = bounded(docs).sparkSession
    counts = written(count_words(train, text_col), "counts")
    totals = counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()  # one row per class
    n_of, v_of = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in totals:
        n_of[r["kind"]], v_of[r["kind"]] = r["n"], r["v"]
    n_all, v_all = int(n_of.sum()), int(v_of.sum())
    weights = spark.sparkContext.broadcast(fit(train, text_col, bits=slot_bits(n_all)))
    top = counts.orderBy(F.desc("n"), "h").limit(COMMON_WORDS).select("h", "n").toArrow()
    key, n = top.column("h").to_numpy().view(np.uint64), top.column("n").to_numpy()
    order = np.argsort(key)
    common = spark.sparkContext.broadcast((key[order], n[order]))
    in_class = np.log10(n_of + ALPHA * (v_of + 1))
    per_token = np.log10(n_all + ALPHA * (v_all + 1))

    def run(batches):
        own, (keys, ns) = weights.value, common.value
        logs, buckets = np.log10(ns + ALPHA), _buckets(keys)
        for b in small_batches(batches, "t", 2 << 20):
            out: dict[str, list] = {c: [] for c in ("n_tokens", "known", "logs", "classes", "tail", "times")}
            for _, rows, w, kind in tokens(b.column("t")):
                model = own.log_share(features(rows, w, kind, own.bits), kind) / np.log(10) - in_class[kind]
                at = _places(keys, buckets, w)
                hit = keys[at] == w if len(keys) else np.zeros(len(w), bool)
                value = np.where(hit, logs[at], 0.0) if len(keys) else np.zeros(len(w))
                out["n_tokens"].append(np.diff(rows))
                out["known"].append(np.add.reduceat(hit.astype(np.int64), rows[:-1]))
                out["logs"].append(np.add.reduceat(value, rows[:-1]))
                out["classes"].append(np.add.reduceat(model, rows[:-1]))
                for a, e in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
                    h, times = np.unique(w[a:e][~hit[a:e]], return_counts=True)
                    out["tail"].append(h.view(np.int64))
                    out["times"].append(times.astype(np.int32))
            ends = np.concatenate([[0], np.cumsum([len(x) for x in out["tail"]])]).astype(np.int32)
            lists = lambda c: pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(out[c])))
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("doc_id"), *(pa.array(np.concatenate(out[c])) for c in ("n_tokens", "known", "logs", "classes")),
                 lists("tail"), lists("times")],
                names=["row", "doc_id", "n_tokens", "known", "logs", "classes", "tail", "times"],
            )

    rows = docs.select(
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")
    ).mapInArrow(run, "row long, doc_id long, n_tokens long, known long, logs double, classes double, tail array<long>, times array<int>")
    rows = written(rows, "rows")
    # a row named by what it holds; rows that hold the same have the same words, so one of them is enough
    tail = (
        rows.groupBy("row").agg(F.first("tail").alias("tail"), F.first("times").alias("times"))
        if _repeats(rows) else rows
    )
    tail = tail.select("row", F.explode(F.arrays_zip("tail", "times")).alias("x")).select(
        "row", F.col("x.tail").alias("h"), F.col("x.times").alias("times")
    )
    joined = tail.join(counts.select("h", "n"), "h", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more"),
        F.sum(F.col("times") * F.log10(F.coalesce(F.col("n"), F.lit(0)) + ALPHA)).alias("rest"),
    )
    sums = F.col("logs") + F.coalesce("rest", F.lit(0.0))
    return rows.drop("tail", "times").join(joined, "row", "left").select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (sums - F.col("n_tokens") * float(per_token)).alias("base_score"),
        (sums + F.col("classes")).alias("score"),
    )


def _repeats(rows: DataFrame) -> bool:
    return not rows.groupBy("row").count().where("count > 1").isEmpty()
