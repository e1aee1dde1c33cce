"""Exact dedup and the shingle join against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from arcloom.llm import exact_dedup, jaccard_join

LONG = "lorem ipsum " * 40_000
DOC = "doc_id long, text string, h string, keep_id string, n int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", None, 1) for i, t in rows], DOC)


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def brute_groups(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[norm(t)]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [(5, "a  b"), (3, "a\tb"), (9, "a b "), (4, None), (2, ""), (7, " "), (8, "\n\n"), (None, "a b"), (6, "é\u00a0x"), (1, "é x"), (10, LONG), (11, LONG + " "), (3, "a b"), (None, "only")]


@pytest.mark.parametrize("weak", [False, True])
def test_groups(spark, weak):
    options = {"digest": lambda t: F.pmod(F.length(t), F.lit(3))} if weak else {}  # collisions: the bytes decide
    got = [tuple(r) for r in exact_dedup.exact_groups(table(spark, ROWS), **options).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()]
    assert sorted(got, key=str) == brute_groups(ROWS)


def test_keep_first(spark):
    left = exact_dedup.keep_first(table(spark, ROWS))
    assert left.columns == ["doc_id", "text", "h", "keep_id", "n"]
    assert sorted((r["doc_id"] for r in left.collect()), key=str) == sorted([3, 9, 2, 7, 6, 1, 10, None], key=str)


def test_empty(spark):
    empty = table(spark, ROWS).limit(0)
    assert exact_dedup.exact_groups(empty).count() == 0 and exact_dedup.keep_first(empty).count() == 0
    assert jaccard_join.linked_components(empty).count() == 0 and jaccard_join.keep_one(empty).count() == 0


def shingles(t, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) or frozenset([tuple(w)])


def brute_components(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    comp = list(range(len(rows)))

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            inter = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * inter >= percent * len(sets[a] | sets[b]):
                comp[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[root(n)] = min(least.get(root(n), i), i)
    return sorted(((i, len(sets[n]), least.get(root(n))) for n, (i, _) in enumerate(rows)), key=str)


def family(seed, n, edits, length=60):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(30)]
    base = [r.choice(vocab) for _ in range(length)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = r.choice(vocab)
        out.append(" ".join(w[: len(w) - r.randint(0, 3)]))
    return out


@pytest.mark.parametrize("k,percent,hot", [(4, 85, 24), (5, 80, 2)])
def test_components(spark, k, percent, hot):
    texts = family(1, 40, 3) + family(2, 30, 2, 25) + family(3, 10, 0, 9) + ["a b", "A  b", "a b c", "", None, " \n", "a", "a", "é É", "x " * 50, "x " * 70]
    rows = list(enumerate(texts, 100))
    random.Random(4).shuffle(rows)
    got = [tuple(r) for r in jaccard_join.linked_components(table(spark, rows), k=k, percent=percent, hot_sets=hot).collect()]
    assert sorted(got, key=str) == brute_components(rows, k, percent)


def test_repeated_and_missing_ids(spark):
    rows = [(1, "a b c d e"), (1, "q r s t u"), (None, "a b c d e"), (7, "q r s t u"), (None, "v w"), (2, None)]
    got = [tuple(r) for r in jaccard_join.linked_components(table(spark, rows)).collect()]
    assert sorted(got, key=str) == brute_components(rows, 4, 85)


def test_keep_one(spark):
    rows = [(3, "a b c d e"), (1, "A b c d  e"), (2, "z y x"), (4, None), (5, "")]
    left = jaccard_join.keep_one(table(spark, rows))
    assert left.columns == ["doc_id", "text", "h", "keep_id", "n"] and sorted(r["doc_id"] for r in left.collect()) == [1, 2, 4, 5]


def test_keep_one_tells_rows_apart_by_id_and_text(spark):
    a, b = "one two three four five six", "other words that stand alone here"
    rows = [(1, a), (2, a), (2, b), (None, a), (None, "x y z"), (None, None), (3, b + " too"), (4, "x y z")]
    left = sorted(((r["doc_id"], r["text"]) for r in jaccard_join.keep_one(table(spark, rows)).collect()), key=str)
    assert left == sorted([(1, a), (2, b), (None, None), (3, b + " too"), (4, "x y z")], key=str)


def test_prefix_length():
    assert [jaccard_join.prefix_length(n, 85) for n in (1, 6, 7, 100)] == [1, 1, 2, 16]


def test_other_orders_refuse_pairs_before_sets_are_fetched(spark):
    texts = family(5, 30, 12) + family(6, 30, 12)
    sets = [sorted(s) for _, s in sorted(jaccard_join.shingle_sets(pa.array(texts), 4))]
    members = spark.createDataFrame([(i, [int(x) for x in np.array(s, np.uint64).view(np.int64)]) for i, s in enumerate(sets)], "id long, tokens array<long>")
    hot = spark.sparkContext.broadcast(np.empty(0, np.uint64))
    pairs = [(a, b) for b in range(60) for a in range(b)]
    counts = []
    for orders in (1, 2, 3):
        prefixes = jaccard_join._prefixes(members, hot, 85, orders)
        got = {tuple(r) for r in jaccard_join._meet(spark.createDataFrame(pairs, "a long, b long"), prefixes).collect()}
        none = np.zeros(0, bool)
        head = lambda i, r: set(jaccard_join._prefix(np.array(sets[i], np.uint64), none if not sets[i] else np.zeros(len(sets[i]), bool), r, jaccard_join.prefix_length(len(sets[i]), 85)).tolist())  # noqa: E731, B023
        assert got == {(a, b) for a, b in pairs if all(head(a, r) & head(b, r) for r in range(1, orders))}
        links = {(a, b) for a, b in pairs if 100 * len(set(sets[a]) & set(sets[b])) >= 85 * len(set(sets[a]) | set(sets[b]))}
        assert links <= got
        counts.append(len(got))
    assert counts[0] > counts[1] > counts[2]


def test_texts_of_the_same_hot_sentences(spark):
    r = random.Random(8)
    sentences = [" ".join(f"s{i}x{j}" for j in range(12)) for i in range(24)]
    rows = [(i, " ".join(r.sample(sentences, r.randint(9, 12)))) for i in range(120)]
    rows += [(200 + i, t + " end") for i, (_, t) in enumerate(rows[:20])]
    got = [tuple(x) for x in jaccard_join.linked_components(table(spark, rows), hot_sets=3).collect()]
    assert sorted(got, key=str) == brute_components(rows, 4, 85)


def test_very_long_texts(spark):
    r = random.Random(9)
    base = [f"v{r.randrange(10**6)}" for _ in range(300_000)]
    other = base[:200_000] + [f"u{i}" for i in range(100_000)]  # shares much, links with none
    near = other[:290_000] + [f"t{i}" for i in range(10_000)]
    rows = [(3, " ".join(base)), (2, " ".join(other)), (1, " ".join(near)), (4, " ".join(base[5:])), (5, " ".join(base[:1000]))]
    got = {x["doc_id"]: x["component_id"] for x in jaccard_join.linked_components(table(spark, rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5}
