"""Toxicity scores from two class-conditional Kneser-Ney models with a shared backoff."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arcloom.llm.decontaminate import pair_hash
from arcloom.llm.text import ALNUM, bounded, hash_words, passes, small_batches, word_bounds
from arcloom.storage import release, small_side, written

#: Labelled documents of each class that the models learn from, about: a share chosen by a hash of the id.
MAX_TRAIN_DOCS = 3_000
#: Of them, one in so many is held back to turn likelihood ratios into probabilities.
CALIBRATE = 4
DISCOUNT = 0.75
#: Words are hashed into so many slots, as powers of two; so are roots and stems, the first bytes of words.
SLOT_BITS, PART_BITS = 20, 18
PARTS = (6, 4)
#: A word whose log-likelihood ratio exceeds this, whatever stands before it, is a strong sign.
STRONG = 3.0
_START = np.uint64(0x5851F42D4C957F2D)


def _slots(col: pa.Array):
    """``(first row, row starts, word hashes, word, stem and root slots, slots before)`` for passes over a column."""
    for i, _, data, rows in passes(col):
        starts, ends = word_bounds(data, ALNUM)
        w, at = hash_words(data, starts, ends), np.searchsorted(starts, rows)
        short = lambda n: hash_words(data, starts, np.minimum(starts + n, ends)) >> np.uint64(64 - PART_BITS)
        before = np.concatenate([[_START], w[:-1]]).astype(np.uint64) if len(w) else w
        before[at[:-1][np.diff(at) > 0]] = _START
        yield i, at, w, before, (w >> np.uint64(64 - SLOT_BITS)).astype(np.int64), *(short(n).astype(np.int64) for n in PARTS)


class Models:
    """Both models. A level's probability given the level above is ``add + share(above) * shared``.

    Levels: root and stem (a word's first bytes), word, and word after word. Counts below the last level are of
    distinct contexts. ``shared`` counts both classes, so an expression that neither class has seen is judged by
    its stem, and one whose stem is new by nothing.
    """

    def __init__(self, uni: pa.Table, context: pa.Table, pairs: pa.Table) -> None:
        n, m = 1 << SLOT_BITS, 1 << PART_BITS
        col = lambda t, c: t.column(c).to_numpy().astype(np.float64)
        word, stem, root = (uni.column(c).to_numpy() for c in ("w", "stem", "root"))
        up = np.zeros(m, np.int64)
        up[stem] = root
        k = [np.array([np.bincount(s, col(uni, c), size) for c in ("k0", "k1", "ks")]) for s, size in ((word, n), (stem, m), (root, m))]
        parent = np.zeros(n, np.int64)
        parent[word] = stem
        none = np.zeros(m, np.int64)
        top = np.tile(k[2].sum(1, keepdims=True), m)
        self.add, self.shared, self.share = [], [], []
        for own, above, link in ((k[2], top, none), (k[1], k[2], up), (k[0], k[1], parent)):
            total = above[:, link]
            kinds = np.array([np.bincount(link, own[c] > 0, m) for c in (0, 1)])
            kinds[:, 1:] = kinds[:, 1:] if link is not none else kinds[:, :1]
            self.add.append((np.maximum(own[:2] - DISCOUNT, 0) / np.maximum(total[:2], 1)).astype(np.float32))
            self.shared.append(((own[2] + 0.5) / (total[2] + 1)).astype(np.float32))
            some = above[:2] > 0
            self.share.append(np.where(some, (DISCOUNT * kinds + 1e-3) / np.maximum(above[:2], 1), 1).astype(np.float32))
        self.after = np.ones((2, n), np.float32)
        total = np.zeros((2, n))
        slot = context.column("v").to_numpy()
        for c in (0, 1):
            total[c, slot] = col(context, f"c{c}")
            kinds = np.zeros(n)
            kinds[slot] = col(context, f"n{c}")
            some = total[c] > 0
            self.after[c, some] = DISCOUNT * kinds[some] / total[c, some]
        key = pairs.column("pair").to_numpy().view(np.uint64)
        order = np.argsort(key)
        self.pairs = key[order]
        v = pairs.column("v").to_numpy()[order]
        self.found = np.stack([
            np.maximum(col(pairs, f"c{c}")[order] - DISCOUNT, 0) / np.maximum(total[c, v], 1) for c in (0, 1)
        ]).astype(np.float32)
        self.coarse = np.zeros(1 << 22, bool)
        self.coarse[self.pairs >> np.uint64(42)] = True
        self.weights = np.zeros(3)

    def features(self, rows, w, before, word, stem, root) -> np.ndarray:
        """Per row: the log-likelihood ratio by token, and the mean of its strong positive parts."""
        out = np.zeros((len(rows) - 1, 2))
        if not len(w):
            return out
        p = self.add[0][:, root] + self.share[0][:, root] * self.shared[0][root]
        p *= self.add[1][:, stem] + self.share[1][:, root] * self.shared[1][stem]
        p *= self.add[2][:, word] + self.share[2][:, stem] * self.shared[2][word]
        alone = np.log(np.maximum(p, 1e-30))
        p *= self.after[:, (before >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
        if len(self.pairs):
            h = pair_hash(before, w)
            near = np.flatnonzero(self.coarse[h >> np.uint64(42)])
            at = np.minimum(np.searchsorted(self.pairs, h[near]), len(self.pairs) - 1)
            same = self.pairs[at] == h[near]
            p[:, near[same]] += self.found[:, at[same]]
        p = np.log(np.maximum(p, 1e-30))
        ratio = p[1] - p[0]
        sums = np.concatenate([[0.0], np.cumsum(ratio, dtype=np.float64)])
        strong = np.concatenate([[0.0], np.cumsum(np.maximum(alone[1] - alone[0] - STRONG, 0), dtype=np.float64)])
        n = np.maximum(np.diff(rows), 1)
        out[:, 0], out[:, 1] = np.diff(sums[rows]) / n, np.diff(strong[rows]) / n
        return out

    def calibrate(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """Logistic regression of the label on the features, by Newton steps with a small ridge."""
        a = np.column_stack([np.ones(len(x)), x])
        b = np.zeros(a.shape[1])
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
            g = a.T @ (weight * (y - p)) - 1e-3 * b
            h = (a * (weight * p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(len(b))
            b = b + np.linalg.solve(h, g)
        self.weights = b

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = self.weights[0] + x @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _pairs(docs: DataFrame) -> DataFrame:
    """``pair, v, w, stem, root, c0, c1``: counts of neighbouring words by class, in ``t`` of each row with label ``toxic``."""

    def run(batches):
        for b in small_batches(batches, "t", 4 << 20):
            labels = b.column("toxic").to_numpy(zero_copy_only=False)
            for i, rows, w, before, word, stem, root in _slots(b.column("t")):
                if not len(w):
                    continue
                label = np.repeat(labels[i : i + len(rows) - 1], np.diff(rows))
                key, first, inverse = np.unique(pair_hash(before, w), return_index=True, return_inverse=True)
                v = (before >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), *(pa.array(x[first].astype(np.int32)) for x in (v, word, stem, root))]
                    + [pa.array(np.bincount(inverse, label == c, len(key)).astype(np.int64)) for c in (0, 1)],
                    names=["pair", "v", "w", "stem", "root", "c0", "c1"],
                )

    return (
        docs.mapInArrow(run, "pair long, v int, w int, stem int, root int, c0 long, c1 long")
        .groupBy("pair").agg(*(F.min(c).alias(c) for c in ("v", "w", "stem", "root")), *(F.sum(c).alias(c) for c in ("c0", "c1")))
    )


def _features(docs: DataFrame, shared, id_type: str) -> DataFrame:
    def run(batches):
        own = shared.value
        for b in small_batches(batches, "t", 4 << 20):
            x = np.zeros((b.num_rows, 2))
            for i, *slots in _slots(b.column("t")):
                x[i : i + len(slots[0]) - 1] = own.features(*slots)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(x[:, 0]), pa.array(x[:, 1])], names=["doc_id", "x0", "x1"])

    return docs.select("doc_id", "t").mapInArrow(run, f"doc_id {id_type}, x0 double, x1 double")


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    most: int = MAX_TRAIN_DOCS,
) -> Models:
    """Learn from the documents that ``labels`` marks 0 or 1, about ``most`` of each class; other rows teach nothing."""
    spark = bounded(docs).sparkSession
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("toxic")
    )
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    share = F.when(F.col("toxic") == 1, most / max(1, sizes.get(1, 0))).otherwise(most / max(1, sizes.get(0, 0)))
    chosen = small_side(written(known.where(chance < share), "labels"))
    text = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t")).join(chosen, "doc_id")
    text = written(text.repartition(16), "labelled")  # bounded: about twice ``most`` documents
    apart = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(CALIBRATE)) == 0
    pairs = written(_pairs(text.where(~apart).select("t", "toxic")), "pairs")
    uni = pairs.groupBy("w").agg(
        F.min("stem").alias("stem"), F.min("root").alias("root"),
        F.count_if(F.col("c0") > 0).alias("k0"), F.count_if(F.col("c1") > 0).alias("k1"), F.count("*").alias("ks")
    )
    context = pairs.groupBy("v").agg(
        F.sum("c0").alias("c0"), F.sum("c1").alias("c1"),
        F.count_if(F.col("c0") > 0).alias("n0"), F.count_if(F.col("c1") > 0).alias("n1"),
    )
    tables = []
    for table in (uni, context, pairs.select("pair", "v", "c0", "c1")):  # slots and pairs of the bounded sample
        tables.append(table.toArrow())
        release(spark)
    models = Models(*tables)
    shared = spark.sparkContext.broadcast(models)
    held = _features(text.where(apart), shared, dict(text.dtypes)["doc_id"])
    rows = held.join(chosen, "doc_id").select("x0", "x1", "toxic").toArrow().to_pandas()
    shared.destroy()  # the calibrated models are broadcast again
    if len(rows) and rows["toxic"].nunique() == 2:
        y = rows["toxic"].to_numpy(np.float64)
        weight = np.where(y == 1, sizes.get(1, 0) / max(1, y.sum()), sizes.get(0, 0) / max(1, (1 - y).sum()))
        models.calibrate(rows[["x0", "x1"]].to_numpy(np.float64), y, weight * len(y) / weight.sum())
    else:  # nothing to learn from: the share of toxic labels, or 0
        rate = sizes.get(1, 0) / max(1, sum(sizes.values()))
        models.weights[0] = np.log((rate + 1e-6) / (1 - rate + 1e-6))
    return models


def score(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted, ratio`` of every whole text.

    ``ratio`` is the log-likelihood ratio of toxic to ordinary by word, ``score`` the probability made of it, and
    ``predicted`` 1 from 0.5 on. Null and empty texts have ratio 0. Rows that repeat an id are scored by
    themselves; ids may be null.
    """
    shared = bounded(docs).sparkSession.sparkContext.broadcast(models)

    def run(batches):
        own = shared.value
        for b in small_batches(batches, text_col, 4 << 20):
            x = np.zeros((b.num_rows, 2))
            for i, *slots in _slots(b.column(text_col)):
                x[i : i + len(slots[0]) - 1] = own.features(*slots)
            p = own.scores(x)
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col).cast(pa.int64()), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(x[:, 0])],
                names=["doc_id", "score", "predicted", "ratio"],
            )

    return docs.select(id_col, text_col).mapInArrow(run, "doc_id long, score double, predicted int, ratio double")
