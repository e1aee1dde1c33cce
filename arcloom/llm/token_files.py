"""Token ids in flat unsigned integer files with 64-bit document offsets, read back by memory mapping."""

from __future__ import annotations

import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arcloom.llm.chunk_cache import ChunkCache
from arcloom.llm.text import small_batches
from arcloom.storage import run_dir

#: A worker holds the ids of at most twice so many words.
CACHE_WORDS = 300_000
#: Marks that end a chunk; behind an ASCII letter they are pieces of their own where the tokenizer says so.
_MARKS = ".,;:!?"
#: What a null id becomes in the files.
NULL_ID = np.iinfo(np.int64).min
#: Input bytes for each part of the files; an estimate from UNKNOWN_BYTES on is Spark's way to say that it has none.
PART_BYTES, UNKNOWN_BYTES = 256 << 20, 1 << 60
#: Text between two chunks that are encoded in one call.
_BETWEEN = "<|startoftext|>"


class WordEncoder:
    """Ids of whole texts by a tokenizers file whose model drops white space.

    No token spans a space or a line feed in such a model, so texts are cut there and equal chunks are encoded
    once. New chunks go in joined by a special token, whose id marks where to cut; a file without that token, or
    one whose tokens may span spaces, encodes whole texts.

    Where the tokenizer gives ASCII letters of either case the same ids, ASCII chunks are lower-cased first, and where
    it sets a mark behind a letter apart, a chunk is its word's ids and the mark's: such chunks share one encoding.
    Text with ``<|`` in it is left as it is, since special tokens are told by their case.
    """

    def __init__(self, path: str, end_id: int, cache: int = CACHE_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.between = self.tokenizer.token_to_id(_BETWEEN)
        whole = self.tokenizer.encode("ab\n cd  e " + _BETWEEN + "f g", add_special_tokens=False).ids
        parts = [self.tokenizer.encode(x, add_special_tokens=False).ids for x in ("ab", "cd", "e", _BETWEEN, "f", "g")]
        self.chunked = self.between is not None and whole == sum(parts, [])
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if max(size, end_id + 1) <= 1 << 16 else "<u4")
        self.end = np.array([end_id], self.dtype).tobytes()
        self.folds = all(self._ids(x) == self._ids(x.lower()) for x in ("".join(map(chr, range(33, 127))), *"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        words = [x + y for x in ("ab", "ab's", "a1b", "'b", "é.b") for y in "abcdefghijklmnopqrstuvwxyz"]
        self.marks = [m for m in _MARKS if all(self._ids(w + m) == self._ids(w) + self._ids(m) for w in words)]
        self.cache = ChunkCache(self._words, cache)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, chunks: list[str]) -> list[bytes]:
        out: dict[str, bytes] = {"": b""}
        odd = [c for c in chunks if "<|" in c]
        plain = [c for c in chunks if c and "<|" not in c]
        groups = [plain[i : i + 256] for i in range(0, len(plain), 256)]
        for g, ids in zip(groups, self._whole([_BETWEEN.join(g) for g in groups]), strict=True):
            a = np.array(ids, self.dtype)
            cuts = np.flatnonzero(a == self.between)
            if len(cuts) != len(g) - 1:
                odd += g
                continue
            raw, width, at = a.tobytes(), self.dtype.itemsize, 0
            for c, end in zip(g, [*cuts.tolist(), len(a)], strict=True):
                out[c] = raw[at * width : end * width]
                at = end + 1
        for c, ids in zip(odd, self._whole(odd), strict=True):
            out[c] = np.array(ids, self.dtype).tobytes()
        return [out[c] for c in chunks]

    def _split_marks(self, chunks: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The word of each chunk, and the number of the mark behind it (``len(self.marks)``: none)."""
        plain = pc.invert(pc.match_substring(chunks, "<|"))
        if self.folds:
            chunks = pc.if_else(pc.and_(plain, pc.string_is_ascii(chunks)), pc.ascii_lower(chunks), chunks)
        mark = np.full(len(chunks), len(self.marks), np.int64)
        if self.marks:
            ends = pc.and_(plain, pc.match_substring_regex(chunks, "[A-Za-z][" + "".join(self.marks) + "]$"))
            last = pc.index_in(pc.utf8_slice_codeunits(chunks, -1, None), pa.array(self.marks, chunks.type))
            mark = pc.if_else(ends, pc.cast(last, pa.int64()), len(self.marks)).to_numpy(zero_copy_only=False)
            chunks = pc.if_else(ends, pc.utf8_slice_codeunits(chunks, 0, -1), chunks)
        return chunks, mark

    def encode_column(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, the end id behind each, and how many each text has; null counts as empty.

        Chunks are cut and told apart in Arrow, so each distinct one of a batch is looked up once.
        """
        col = col.cast(pa.large_string()).fill_null("")
        if not self.chunked:
            lists = self._whole(col.to_pylist())
            flat = np.array([x for ids in lists for x in ids], self.dtype)
            ends = np.cumsum([len(x) for x in lists], dtype=np.int64)
        else:
            parts = pc.split_pattern(pc.replace_substring(col, "\n", " "), " ")
            chunks = parts.flatten().dictionary_encode()
            words, mark = self._split_marks(chunks.dictionary)
            words = words.dictionary_encode()
            found = self.cache.lookup(words.dictionary.to_pylist() + self.marks + [""])
            size = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
            ids = pa.LargeListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int64()), pa.array(np.frombuffer(b"".join(found), self.dtype))
            )
            pairs = np.stack([words.indices.to_numpy(), mark + len(words.dictionary)], 1)  # of each distinct chunk
            index = pairs[chunks.indices.to_numpy()].ravel()
            flat = ids.take(pa.array(index)).flatten().to_numpy(zero_copy_only=False)
            upto = np.concatenate([[0], np.cumsum(size[index])])[::2]
            ends = upto[parts.offsets.to_numpy()[1:] - parts.offsets[0].as_py()]
        counts = np.diff(ends, prepend=0) + 1
        return np.insert(flat, ends, np.frombuffer(self.end, self.dtype)[0]), counts

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text and the end id, as little-endian integers of ``dtype``; null counts as empty."""
        ids, counts = self.encode_column(pa.array(texts, pa.large_string()))
        return [x.tobytes() for x in np.split(ids, np.cumsum(counts)[:-1])] if texts else []


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def _encoder(path: str, end_id: int) -> WordEncoder:
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = WordEncoder(path, end_id)
    return _ENCODERS[path, end_id]


def _open(uri: str):
    """pyarrow file system and path of a folder URI or a plain path."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _parts(docs: DataFrame) -> int:
    """Parts to write: the session's shuffle partitions, or more where the plan's size estimate asks for parts of PART_BYTES."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, size // PART_BYTES) if size < UNKNOWN_BYTES else least  # results do not depend on it


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write all ids in ascending document order; returns the manifest, one row per file set.

    Manifest: ``part, first_id, n_docs, n_tokens, width, base``. ``base`` is the number of ids in all earlier
    parts: the prefix sum over parts. Part ``p`` has ``p.bin`` (ids of ``width`` bytes, little-endian), ``p.off``
    (n_docs + 1 64-bit positions in ``p.bin``, in ids) and ``p.doc`` (64-bit document ids). Rows are dealt by
    ranges of the id and sorted within a part; rows with equal ids are ordered by text; a null id comes first.
    A part is written under a name of the attempt and then renamed, so a repeated task replaces it whole.
    An empty table writes nothing.
    """
    spark = docs.sparkSession

    def run(batches):
        part = TaskContext.get().partitionId()
        own = _encoder(tokenizer_path, end_id)
        files, root = _open(folder)
        files.create_dir(root, recursive=True)
        mine = f"{root}/.{part:06d}-{uuid.uuid4().hex}"
        n_docs = n_ids = 0
        first = None
        with (
            files.open_output_stream(mine + ".bin") as ids_out,
            files.open_output_stream(mine + ".off") as off_out,
            files.open_output_stream(mine + ".doc") as doc_out,
        ):
            off_out.write(np.zeros(1, "<i8").tobytes())
            for b in small_batches(batches, text_col, 2 << 20):
                ids, counts = own.encode_column(b.column(text_col))
                ends = np.cumsum(counts) + n_ids
                doc = b.column(id_col).cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
                ids_out.write(ids.tobytes())
                off_out.write(ends.astype("<i8").tobytes())
                doc_out.write(doc.astype("<i8").tobytes())
                first = int(doc[0]) if first is None else first
                n_docs, n_ids = n_docs + len(counts), int(ends[-1])
        for kind in ("bin", "off", "doc"):
            if n_docs:
                files.move(f"{mine}.{kind}", f"{root}/{part:06d}.{kind}")
            else:
                files.delete_file(f"{mine}.{kind}")
        if n_docs:
            yield pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([first]), pa.array([n_docs]), pa.array([n_ids]), pa.array([own.dtype.itemsize])],
                names=["part", "first_id", "n_docs", "n_tokens", "width"],
            )

    parts = _parts(docs.select(id_col, text_col))
    rows = (
        docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias(text_col))
        .repartitionByRange(parts, F.col(id_col))
        .sortWithinPartitions(id_col, text_col)
        .mapInArrow(run, "part long, first_id long, n_docs long, n_tokens long, width long")
        .collect()  # one row per part
    )
    out, base = [], 0
    for r in sorted(rows, key=lambda r: r["part"]):
        out.append((*r, base))
        base += r["n_tokens"]
    return spark.createDataFrame(out, "part long, first_id long, n_docs long, n_tokens long, width long, base long")


def _mapped(files, path: str, dtype) -> np.ndarray:
    from pyarrow import fs

    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.empty(0, dtype)
    with files.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files of a manifest.

    ``start`` counts the ids of all documents before; ``ids_crc32`` is over the ids as unsigned 32-bit integers.
    """

    def run(batches):
        files, root = _open(folder)
        for b in batches:
            for r in b.to_pylist():
                name = f"{root}/{r['part']:06d}"
                ids = _mapped(files, name + ".bin", np.dtype(f"<u{r['width']}"))
                off, doc = _mapped(files, name + ".off", "<i8"), _mapped(files, name + ".doc", "<i8")
                for i in range(0, len(doc), 4096):
                    o, d = off[i : i + 4097], doc[i : i + 4096]
                    crc = [zlib.crc32(ids[x:y].astype("<u4").tobytes()) for x, y in zip(o[:-1], o[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.array(d), mask=np.array(d) == NULL_ID), pa.array(o[:-1] + r["base"]),
                            pa.array(np.diff(o)), pa.array(crc, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    n = max(1, manifest.count())
    return manifest.repartition(n).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def document_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, ids`` read back from the files."""

    def run(batches):
        files, root = _open(folder)
        for b in batches:
            for r in b.to_pylist():
                name = f"{root}/{r['part']:06d}"
                ids = _mapped(files, name + ".bin", np.dtype(f"<u{r['width']}"))
                off, doc = _mapped(files, name + ".off", "<i8"), _mapped(files, name + ".doc", "<i8")
                for i in range(0, len(doc), 256):
                    o, d = np.array(off[i : i + 257]), np.array(doc[i : i + 256])
                    lists = pa.ListArray.from_arrays(
                        pa.array((o - o[0]).astype(np.int32)), pa.array(ids[o[0] : o[-1]].astype(np.int64))
                    )
                    yield pa.RecordBatch.from_arrays([pa.array(d, mask=d == NULL_ID), lists], names=["doc_id", "ids"])

    n = max(1, manifest.count())
    return manifest.repartition(n).mapInArrow(run, "doc_id long, ids array<long>")


def digest_documents(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write the files into the shared folder of the run and read every document's digest back from them."""
    spark: SparkSession = docs.sparkSession
    folder = run_dir(spark, "tokens")
    return read_token_files(write_token_files(docs, folder, tokenizer_path, end_id), folder)
