"""Benchmark decontamination by a generalised suffix automaton over the words of the test items."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructField, StructType

from arcloom.llm.text import ALNUM, bounded, hash_words, mix, passes, small_batches, word_bounds, words
from arcloom.storage import written

#: Words of a window; an item of fewer words is one window.
WINDOW = 10
#: Item words of one automaton (two states a word at most, some 400 bytes each); more items make more automata.
BLOCK_WORDS = 100_000
#: A document of which a larger share of words is hit is dropped by `clean_documents`; else the spans are cut.
MAX_COVERAGE = 0.5


class Automaton:
    """Suffix automaton of several word sequences, with the items at the states where their windows end."""

    def __init__(self, items: Iterable[tuple[str | None, list[int]]], window: int = WINDOW) -> None:
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.short: dict[int, dict[tuple[int, ...], set]] = {}
        self.at: dict[int, set] = {}
        items = [(i, w) for i, w in items if w]
        for _, w in items:
            last = 0
            for x in w:
                last = self._extend(last, x)
        for i, w in items:
            if len(w) < window:
                self.short.setdefault(len(w), {}).setdefault(tuple(w), set()).add(i)
                continue
            for _, state, matched in self._walk(w):
                if matched >= window:
                    self.at.setdefault(self._back(state, window), set()).add(i)
        self.least = min([window, *self.short])
        pairs = {(a, b) for _, w in items for a, b in zip(w, w[1:], strict=False)}
        first = np.array([a for a, _ in pairs], np.uint64)
        self.pairs = np.unique(pair_hash(first, np.array([b for _, b in pairs], np.uint64)))
        self.coarse = np.zeros(1 << 20, bool)
        self.coarse[self.pairs >> np.uint64(44)] = True
        self.single = np.array(sorted({w[0] for w in self.short.get(1, {})}), np.uint64)

    def _extend(self, last: int, x: int) -> int:
        """The state of the sequence so far and ``x``; sequences share their states."""
        nxt, link, length = self.next, self.link, self.length
        if x in nxt[last]:
            q = nxt[last][x]
            return q if length[q] == length[last] + 1 else self._clone(last, x, q)
        new = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and x not in nxt[p]:
            nxt[p][x] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][x]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, x, q)
        return new

    def _clone(self, p: int, x: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = copy
        while p >= 0 and nxt[p].get(x) == q:
            nxt[p][x] = copy
            p = link[p]
        return copy

    def _back(self, state: int, n: int) -> int:
        """The state of the last ``n`` words of a match."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def _walk(self, seq: list[int]) -> Iterator[tuple[int, int, int]]:
        """``(position, state, length)`` of the longest match that ends at each position."""
        nxt, link, length = self.next, self.link, self.length
        state = matched = 0
        for i, x in enumerate(seq):
            while state and x not in nxt[state]:
                state = link[state]
                matched = length[state]
            if x in nxt[state]:
                state = nxt[state][x]
                matched += 1
            else:
                matched = 0
            yield i, state, matched

    def windows(self, seq: list[int]) -> Iterator[tuple[int, int, set]]:
        """``(first, end, items)`` of every window that occurs in the sequence."""
        n = self.window
        for i, state, matched in self._walk(seq):
            if matched >= n and (found := self.at.get(self._back(state, n))):
                yield i - n + 1, i + 1, found
            for m, known in self.short.items():
                if matched >= m and (found := known.get(tuple(seq[i - m + 1 : i + 1]))):
                    yield i - m + 1, i + 1, found

    def match(self, w: np.ndarray, rows: np.ndarray) -> dict[int, tuple[np.ndarray, set]]:
        """Hit words (positions in ``w``) and items of each row that has any; ``rows`` are the rows' starts.

        Only runs in which every two neighbouring words are neighbours in some item go through the automaton:
        no longer match can exist elsewhere.
        """
        out: dict[int, tuple[list, set]] = {}
        if not len(w) or not self.short and not self.at:
            return {}

        def add(first: int, end: int, items: set) -> None:
            row = int(np.searchsorted(rows, first, "right")) - 1
            spans, found = out.setdefault(row, ([], set()))
            spans.append((first, end))
            found.update(items)

        if len(self.single):
            at = np.searchsorted(self.single, w)
            for i in np.flatnonzero(self.single[np.minimum(at, len(self.single) - 1)] == w).tolist():
                add(i, i + 1, self.short[1][(int(w[i]),)])
        if len(w) > 1 and len(self.pairs):
            h = pair_hash(w[:-1], w[1:])
            near = self.coarse[h >> np.uint64(44)]
            near[rows[(rows > 0) & (rows < len(w))] - 1] = False  # the last word of a row and the first of the next
            at = np.flatnonzero(near)
            spot = np.searchsorted(self.pairs, h[at])
            near[at] = self.pairs[np.minimum(spot, len(self.pairs) - 1)] == h[at]
            edge = np.diff(np.concatenate([[0], near.view(np.int8), [0]]))
            firsts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
            long = ends - firsts >= max(2, self.least)
            for a, b in zip(firsts[long].tolist(), ends[long].tolist(), strict=True):
                for first, end, items in self.windows(w[a:b].tolist()):
                    if end - first > 1:
                        add(a + first, a + end, items)
        return {
            row: (np.unique(np.concatenate([np.arange(a, b) for a, b in set(spans)])), found)
            for row, (spans, found) in out.items()
        }


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(0x9FB21C651E98DF25) + mix(b))


def _blocks(items: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple[str | None, list[int]]]]:
    """Items as word hashes, in blocks of at most ``most`` words (one item at least), streamed to the driver."""
    block, size = [], 0
    for row in items.select(F.col(id_col).cast("string"), F.col(text_col)).toLocalIterator():
        for _, _, w, _ in words(pa.array([row[1]], pa.string()), ALNUM):
            if block and size + len(w) > most:
                yield block
                block, size = [], 0
            block.append((row[0], w.tolist()))
            size += len(w)
    yield block


_BUILT: dict[str, Automaton] = {}


def _automaton(key: str, shared, window: int) -> Automaton:
    """The worker's automaton of a broadcast block; one is kept."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Automaton(shared.value, window)
    return _BUILT[key]


def find_hits(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``doc_id, n_words, n_hit, items`` for every row of ``docs``; ``items`` is a sorted array of item ids.

    Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. A window is ``window`` consecutive
    words of an item; an item of fewer words, but not none, is one window. A document word inside any occurrence
    of a window is hit. Null texts have no words; a null item id is matched but not listed; items that repeat an
    id count once. Every row is judged by itself, also where rows repeat an id.

    Documents are scanned once for each block of ``block_words`` item words and never shuffled, unless there are
    several blocks: then the blocks' hits meet by document.
    """
    spark = bounded(docs).sparkSession
    found = []
    for block in _blocks(items, item_id_col, item_text_col, block_words):
        shared, key = spark.sparkContext.broadcast(block), uuid.uuid4().hex

        def run(batches, shared=shared, key=key):
            own = _automaton(key, shared, window)
            for b in small_batches(batches, text_col, 4 << 20):
                n_words = np.zeros(b.num_rows, np.int64)
                hits: list[list[int]] = [[]] * b.num_rows
                ids: list[list[str]] = [[]] * b.num_rows
                for i, j, w, rows in words(b.column(text_col), ALNUM):
                    n_words[i:j] = np.diff(rows)
                    for row, (at, names) in own.match(w, rows).items():
                        hits[i + row] = (at - rows[row]).tolist()
                        ids[i + row] = sorted(x for x in names if x is not None)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).cast(pa.int64()), pa.array(n_words), pa.array(hits, pa.list_(pa.int32())),
                        pa.array(ids, pa.list_(pa.string())), b.column(2),
                    ],
                    names=["doc_id", "n_words", "hits", "items", "t"],
                )

        found.append(
            docs.select(id_col, text_col, F.xxhash64(F.col(text_col)).alias("__t")).mapInArrow(
                run, "doc_id long, n_words long, hits array<int>, items array<string>, t long"
            )
        )
    if len(found) == 1:
        out = found[0]
    else:
        n = len(found)
        every = found[0]
        for f in found[1:]:
            every = every.unionByName(f)
        out = (
            every.groupBy("doc_id", "t", "n_words")
            .agg(
                F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
                F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
                (F.count("*") / n).cast("int").alias("rows"),
            )
            .withColumn("__row", F.explode(F.sequence(F.lit(1), F.col("rows"))))
        )
    return out.select("doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), "items")


def judge(hits: DataFrame) -> DataFrame:
    """The digest columns of `find_hits`."""
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean_documents(
    docs: DataFrame, items: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars",
    item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
    max_coverage: float = MAX_COVERAGE, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` without the test items' windows, in the columns of ``docs``.

    Runs of hit words are cut from the text, from the first byte of the run to its last, until no window of any item is
    left; a document of which more than ``max_coverage`` of the words are hit, as it came, is dropped. ``chars_col``, if
    there is one, gets the new number of code points. Documents without hits stay as they are, null texts too.

    With several blocks of ``block_words`` item words, a row carries the words that each block hits, and their union
    is judged and cut at once; rows that were cut are searched by all blocks again. So the blocks do not show.
    """
    spark, schema, names = bounded(docs).sparkSession, docs.schema, docs.columns
    chars = chars_col if chars_col in names else None
    hits, again = "__hits", "__again"
    blocks = [(spark.sparkContext.broadcast(x), uuid.uuid4().hex) for x in _blocks(items, item_id_col, item_text_col, block_words)]

    def marker(shared, key):
        """Adds a block's hits to those of the blocks before."""

        def run(batches):
            own = _automaton(key, shared, window)
            for b in small_batches(batches, text_col, 4 << 20):
                found = b.column(hits).to_pylist()
                for i, _, data, rows in passes(b.column(text_col)):
                    starts, ends = word_bounds(data, ALNUM)
                    at = np.searchsorted(starts, rows)
                    for row, (hit, _) in own.match(hash_words(data, starts, ends), at).items():
                        found[i + row] = np.union1d(found[i + row] or [], hit - at[row]).astype(np.int64).tolist()
                yield b.set_column(b.schema.get_field_index(hits), hits, pa.array(found, pa.list_(pa.int32())))

        return run

    def cutter(most):
        """Drops rows with a larger share of hits than ``most``, cuts the others' and tells which rows were cut."""

        def run(batches):
            for b in small_batches(batches, text_col, 4 << 20):
                keep, new = np.ones(b.num_rows, bool), {}
                found = b.column(hits).to_pylist()
                for row in [r for r, hit in enumerate(found) if hit]:
                    text = b.column(text_col)[row].as_py()
                    _, starts, ends = _bounds(text)
                    if len(found[row]) > most * len(starts):
                        keep[row] = False
                    else:
                        new[row] = _without(text, starts, ends, np.array(found[row]))
                out = _replaced(b.drop_columns([hits]), names, text_col, chars, new)
                cut = pa.array(np.isin(np.arange(b.num_rows), list(new)))
                yield out.append_column(again, cut).filter(pa.array(keep))

        return run

    def whole(shared, key):
        """All of it, where one block holds every item."""

        def run(batches):
            own = _automaton(key, shared, window)
            for b in small_batches(batches, text_col, 4 << 20):
                keep, new = np.ones(b.num_rows, bool), {}
                for i, _, data, rows in passes(b.column(text_col)):
                    starts, ends = word_bounds(data, ALNUM)
                    at = np.searchsorted(starts, rows)
                    for row, (hit, _) in own.match(hash_words(data, starts, ends), at).items():
                        if len(hit) > max_coverage * (at[row + 1] - at[row]):
                            keep[i + row] = False
                        else:
                            new[i + row] = _cut(own, b.column(text_col)[i + row].as_py())
                yield _replaced(b, names, text_col, chars, new).filter(pa.array(keep))

        return run

    if len(blocks) == 1:
        return docs.mapInArrow(whole(*blocks[0]), schema)
    marked = StructType([*schema.fields, StructField(hits, ArrayType(IntegerType()))])
    told = StructType([*schema.fields, StructField(again, BooleanType())])
    rows, most, done = docs, max_coverage, []
    while True:
        rows = rows.withColumn(hits, F.lit(None).cast("array<int>"))
        for block in blocks:
            rows = rows.mapInArrow(marker(*block), marked)
        rows = written(rows.mapInArrow(cutter(most), told), "cut")
        done.append(rows.where(f"not {again}").drop(again))
        rows, most = rows.where(again).drop(again), 1.0
        if rows.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _replaced(b: pa.RecordBatch, names: list[str], text_col: str, chars: str | None, new: dict[int, str]) -> pa.RecordBatch:
    """``b`` with the new texts of some rows, and their code points in ``chars``."""
    for col, value in ((text_col, str), (chars, len)) if new else ():
        if col:
            values = b.column(col).to_pylist()
            for row, text in new.items():
                values[row] = value(text)
            field = b.schema.field(col)
            b = b.set_column(names.index(col), field, pa.array(values, field.type))
    return b


def _bounds(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text's bytes, and where its words start and end."""
    for _, _, data, _ in passes(pa.array([text], pa.string())):
        starts, ends = word_bounds(data, ALNUM)
    return data, starts, ends


def _without(text: str, starts: np.ndarray, ends: np.ndarray, hit: np.ndarray) -> str:
    """The text without runs of hit words, given the bounds of all words."""
    raw = text.encode()
    kept, at = [], 0
    for r in np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1):
        kept.append(raw[at : starts[r[0]]])
        at = ends[r[-1]]
    return b"".join([*kept, raw[at:]]).decode()


def _cut(own: Automaton, text: str) -> str:
    while True:
        data, starts, ends = _bounds(text)
        hits = own.match(hash_words(data, starts, ends), np.array([0, len(starts)]))
        if not hits:
            return text
        text = _without(text, starts, ends, hits[0][0])


def items_digest(ids: Iterable[str]) -> str:
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
